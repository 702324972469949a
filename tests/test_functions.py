"""Scalar expressions against hand-worked values."""

import pytest
from pyspark.sql import functions as F

from bedfeed.functions import hl7, location, text, times, values, waveform


def column(spark, items, schema="x string"):
    return spark.createDataFrame([(i,) for i in items], schema).coalesce(1)


def apply(spark, items, expression, schema="x string"):
    return [r[0] for r in column(spark, items, schema).select(expression(F.col("x"))).collect()]


def test_fix_time(spark):
    base = "20230615120000"
    given = [base + o for o in ("-0400", "+0000", "+0530", "-0359", "-0401", "-0459", "-0501", "")]
    expected = [base + o for o in ("-0400", "+0000", "+0530", "-0400", "-0400", "-0500", "-0500", "")]
    assert apply(spark, given, times.fix_time) == expected


def test_parse_time(spark):
    noon = 1686844800 * 10**9  # 2023-06-15 16:00:00 UTC
    cases = {
        "20230615120000-0400": noon,
        "20230615160000+0000": noon,
        "20230615120000": noon,
        "20230615120000.5-0400": noon + 5 * 10**8,
        "20230615120000.123-0400": noon + 123 * 10**6,
        "20230615120000.123456789-0400": noon + 123456789,
        "20230615120000.123456789999-0400": noon + 123456789,
        "20230615213000+0530": noon,
        "20230115120000": 1673802000 * 10**9,  # winter: five hours behind
        "20231105013000": 1699162200 * 10**9,  # ambiguous: the earlier offset
        "20230312023000": 1678606200 * 10**9,  # in the gap: moved forward
        "20230230120000-0500": None,
        "2023061512": None,
        "yesterday at noon": None,
        "": None,
        "99991231235959+0000": None,  # past the range of nanoseconds
    }
    assert apply(spark, list(cases), times.parse_ns) == list(cases.values())


def test_time_forms(spark):
    given = ["20230615120000-0400", " "]
    assert apply(spark, given, lambda c: times.time_repr(c, "epoch")) == [1686844800 * 10**9, -(2**63)]
    assert apply(spark, given, lambda c: times.time_repr(c, "text")) == ["2023-06-15T16:00:00.000000", ""]
    assert apply(spark, given, lambda c: times.time_repr(c).isNull()) == [False, True]
    with pytest.raises(ValueError):
        times.time_repr(F.lit("") if spark else None, "other")


def test_compare_times(spark):
    a, b = "20230615120000-0400", "20230615120001-0401"
    rows = spark.createDataFrame([(a, b), (a, a), (b, a)], "x string, y string").coalesce(1)
    got = rows.select(times.compare_times(F.col("x"), F.col("y")), times.duration_ns(F.col("x"), F.col("y")))
    assert [tuple(r) for r in got.collect()] == [(1, 10**9), (0, 0), (-1, -(10**9))]


def test_epoch_columns(spark):
    got = apply(spark, [1_500_000_001], lambda c: F.unix_micros(times.epoch_to_timestamp(c, "ns")), "x bigint")
    assert got == [1_500_000]
    assert apply(spark, [1.5], lambda c: F.unix_micros(times.epoch_to_timestamp(c, "s")), "x double") == [1_500_000]


def test_field_lists(spark):
    given = ["a", "a^b", "a~b^c", "a&b", "^~\\&", ""]
    assert apply(spark, given, hl7.top_level_list) == [
        ["a"], ["a", "b"], ["a", "b^c"], ["a", "b"], ["^~\\&"], [""],
    ]
    assert apply(spark, given, hl7.flat_text) == ["a", "a^b", "a~b^c", "a^b", "^~\\&", ""]
    assert apply(spark, ["a&x^b~c^d"], hl7.components) == [["a", "b"]]


def test_convert_field(spark):
    def convert(items, logical, as_string=False):
        return apply(spark, items, lambda c: values.convert_field(c, logical, as_string))

    assert convert(["42", "", "x", "1^2"], "INT") == [42, None, None, None]
    assert convert(["3.14"], "FLOAT") == [3.14]
    assert convert(["7", "7.5"], "NUMERIC") == [7.0, 7.5]
    assert convert(["a^b"], "STR") == ["a^b"]
    assert convert(["1^2", "3", ""], "LIST_OF_INT") == [[1, 2], [3], []]
    assert convert(["1^2.5"], "LIST_OF_NUMERIC") == [[1.0, 2.5]]
    assert convert(["1^2"], "LIST_OF_NUMERIC", True) == [["1", "2"]]
    assert apply(spark, ["1^2", "x", "1"], lambda c: values.conversion_error(c, "INT")) == [True, True, False]
    assert apply(spark, ["1", "1.0"], values.is_integral) == [True, False]
    with pytest.raises(ValueError):
        values.convert_field(F.lit("1"), "MONEY")
    with pytest.raises(ValueError):
        values.field_or_default(F.array(), "OBX.99")


def test_field_or_default(spark):
    got = apply(spark, ["OBX|1|NM|a^b", "OBX"], lambda c: values.field_or_default(hl7.fields(c), "OBX.3"))
    assert got == ["a^b", ""]


def test_coerce(spark):
    rows = spark.createDataFrame(
        [("1^2", "NA"), ("1^2", "NM"), ("5", "NM"), ("x", "NM"), ("", "NM"), ("t", "ST")], "v string, t string"
    ).coalesce(1)
    got = rows.select(
        values.values_numeric(F.col("v"), F.col("t")), values.coerce_error(F.col("v"), F.col("t")).isNotNull()
    ).collect()
    assert [tuple(r) for r in got] == [
        ([1.0, 2.0], False), (None, True), ([5.0], False), ([None], True), ([None], False), (None, False),
    ]


def test_signal_names(spark):
    got = apply(spark, [["a"], ["1", "n"], ["1", "n", "S"], ["1", "", "S"], list("abcd")],
                values.signal_identity, "x array<string>")
    assert [tuple(r) if r else None for r in got] == [
        ("a", "NO_SCHEME:a"), ("n", "NO_SCHEME:1"), ("n", "S:1"), ("S:1", "S:1"), None,
    ]
    assert apply(spark, ["mV", "1^mV^S", "", "a^b"], values.signal_uom) == ["mV", "mV", "", None]


def test_bed_wildcard(spark):
    cases = {
        "ER1201": "ER??01", "PA12-01": "PA??-01", "ER123": None, "T434": "T4??", "T434-01": "T4??-01",
        "T4345": None, "N28": "N??", "EMS7": "EMS?", "NICU41A": "NICU4??", "NICU7-01": "NICU7-??",
        "NICU2105": "NICU21??", "4107-06": "4107-??", "ICU 7": "ICU ??", "": "", "X": "X",
    }
    assert apply(spark, list(cases), location.bed_wildcard) == list(cases.values())


def test_bed_forms(spark):
    assert apply(spark, ["G505", "g505", "G505-01"], location.letter_bed) == ["G505-01", "g505", "G505-01"]
    assert apply(spark, ["ICU231", "CV12", "ICU 7", "ICU2-01", "ED5"], location.icu_bed) == [
        "231-01", "CV12-01", "ICU 7", "ICU2-01", "ED5",
    ]


def test_sanitize(spark):
    given = ["plain", "“q” – ‘x’…", "é™😀®", ""]
    assert apply(spark, given, text.sanitize_ascii) == ["plain", "\"q\" - 'x'...", "?(TM)?(R)", ""]
    assert [sorted(c) for c in apply(spark, given, text.non_ascii_chars)] == [
        [], sorted("“”–‘’…"), sorted("é™😀®"), [],
    ]
    custom = {"é": "è", "ü": "ue"}
    assert apply(spark, ["éüè😀a"], lambda c: text.sanitize_ascii(c, custom)) == ["èue??a"]


def test_archive(spark):
    given = ["abc" * 500, "", "x", "héllo 😀", None]
    packed = apply(spark, given, text.archive_payload)
    assert len(packed[0]) < 100 and packed[-1] is None
    assert apply(spark, packed, text.restore_payload) == given
    assert apply(spark, ["a"], lambda c: text.archive_payload(c, "NONE")) == ["a"]
    with pytest.raises(ValueError):
        text.archive_payload(F.lit("a"), "rar")


def gain_by_hand(low, high, dmin=-32767, dmax=32767):
    import math

    if low is None:
        return 1.0, 1
    if low == high:
        return (1.0, 1) if low == 0 else (abs(1 / low), 0)
    gain = (dmax - dmin) / (high - low)
    base = dmin - gain * low
    base = math.ceil(base) if low > 0 else math.floor(base)
    if dmin != base:
        gain = (dmin - base) / low
    if base > 2**31 - 1:
        return (2**31 - 1 - dmin) / abs(low), 2**31 - 1
    if base < -(2**31):
        return (dmax + 2**31) / high, -(2**31)
    return gain, base


def test_gain(spark):
    ranges = [
        (0.0, 0.0), (5.0, 5.0), (-5.0, -5.0), (-1.0, 1.0), (2.0, 4.0), (-4.0, -2.0), (0.0, 1.0), (None, None),
        (1e6, 1e6 + 1e-3), (-1e6 - 1e-3, -1e6),
    ]
    rows = spark.createDataFrame(ranges, "low double, high double").coalesce(1)
    got = rows.select(waveform.adc_gain_baseline(F.col("low"), F.col("high")).alias("g")).select("g.*").collect()
    for r, (low, high) in zip(got, ranges, strict=True):
        gain, base = gain_by_hand(low, high)
        assert r["adc_gain"] == pytest.approx(gain, rel=1e-12) and r["baseline"] == base


def test_formats(spark):
    rows = spark.createDataFrame(
        [(-127, 127), (-128, 1), (-511, 511), (-2047, 2047), (-32767, 32767), (-8388607, 1), (-8388608, 1), (0, 2**31)],
        "low bigint, high bigint",
    ).coalesce(1)
    got = rows.select(waveform.choose_format(F.col("low"), F.col("high"), True)["fmt"]).collect()
    assert [r[0] for r in got] == ["80", "311", "311", "212", "16", "24", "32", None]
    assert waveform.digital_bounds("212") == (-2048, 2047)
    assert waveform.invalid_sample("8") is None and waveform.invalid_sample("16") == -32768
    assert apply(spark, ["311", "zz"], waveform.digital_range)[1] is None


def test_digitize(spark):
    got = apply(spark, [[1.0, None, float("nan"), 2.5]],
                lambda c: waveform.digitize(c, F.lit(2.0), F.lit(1)), "x array<double>")
    assert got == [[3, -32768, -32768, 6]]
