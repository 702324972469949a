"""Messages to rows."""

import json

import pytest
from pyspark.sql import functions as F
from samples import ADT, WAVE

from bedfeed.operators import fields, location, messages, observations, patients, quality
from bedfeed.operators.pipeline import located_messages
from bedfeed.sinks.json_rows import to_json_rows
from bedfeed.sources import feed

HEAD = "MSH|^~\\&|MON||||20310907081510-0400||ORU^R01|C9|P|2.5\nPID|||P9||L^F\nPV1||I|NORTH-4TN-K718\n"
VITALS = HEAD + "\n".join([
    "OBR|1|||182777000^monitoring of patient^SCT|||20310907081500-0400|||NORTH-4TN-K718|||E||||||||Device",
    "OBX|1|NM|1^MDC_ECG_HEART_RATE^MDC||80|bpm||||||||20310907081500-0400",
    "OBX|2|ST|3426^^CAPSULE||M1",
    "OBX|3|ST|3426^^CAPSULE||M2",
    "OBX|4|ST|67933^GIVEN^MDC||\"\"",
    "OBX|5|ST|67933^GIVEN^MDC||ANN",
    "OBX|6|ST|67932^FAMILY^MDC||LEE",
    "OBX|7|ST|9569^^CAPSULE||V7",
    "OBX|8|ST|5^SHORT",
])


def parse(spark, site, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "msg_idx bigint, message string").coalesce(1)
    return located_messages(rows, site)


def test_split_messages(spark):
    files = spark.createDataFrame([("a\r\n\r\nb\rc\r\r\n\n\n\nd\n\n",)], "content string")
    got = feed.split_messages(files).orderBy("msg_idx").collect()
    assert [r["message"] for r in got] == ["a", "b\nc", "\nd"]


def test_segments_and_leaves(spark):
    rows = spark.createDataFrame([("MSH|^~\\&|A\n\n \t\nPID|1|x~y^z&w",)], "message string")
    segments = messages.segment_table(rows)
    assert [r["name"] for r in segments.orderBy("seg_idx").collect()] == ["MSH", "PID"]
    leaves = messages.value_table(segments).where("name = 'PID' and field = 2")
    got = {(r["rep"], r["comp"], r["sub"]): r["value"] for r in leaves.collect()}
    assert got == {(0, 0, 0): "x", (1, 0, 0): "y", (1, 1, 0): "z", (1, 1, 1): "w"}
    kept = messages.value_table(segments).where("name = 'MSH' and field = 1").collect()
    assert [r["value"] for r in kept] == ["^~\\&"]


def test_header(spark, site):
    row = parse(spark, site, WAVE).first()
    assert row["error_code"] is None
    assert (row["hospital"], row["bed_unit"], row["bed_id"]) == ("NORTH", "7K WEST ICU", "K718-01")
    assert (row["pid"], row["visit_id"], row["first_name"], row["last_name"]) == ("R7701", "V1", "ALMA", "ROWAN")
    assert (row["profile"], row["control_id"], row["deployment"], row["hl7_event"]) == ("PROF", "C1", "P", "R01")
    assert row["msh_time_ns"] == 1946549700250000000


def test_waveform_row(spark, site):
    row = observations.observations(parse(spark, site, WAVE)).first()
    assert row["channel"] == "MDC_ECG_ELEC_POTL_I" and row["channel_type"] == "WV_ECG"
    assert row["values_num"] == [1.0, 2.0, None] and row["values_str"] == ["1", "2", "x"]
    assert (row["pd_samp_ms"], row["nsamp"], row["UoM"], row["channel_id"]) == (2.0, 3, "mV", "1.0:77")
    assert row["end_t_ns"] - row["start_t_ns"] == 6 * 10**6


def test_last_duplicate_in_first_place(spark, site):
    extra = [
        WAVE.split("\n")[4].replace("1^MDC_ECG_ELEC_POTL_I^MDC", f"{c}^{n}^S").replace("1^2^x", v)
        for c, n, v in ((1, "A", "1^1"), (2, "B", "2^2"), (1, "A", "3^3"))
    ]
    row = observations.observations(parse(spark, site, "\n".join(WAVE.split("\n")[:4] + extra))).first()
    assert row["channel"] == "B" and row["values_num"] == [2.0, 2.0]


def test_waveform_without_samples(spark, site):
    row = observations.observations(parse(spark, site, "\n".join(WAVE.split("\n")[:4]))).first()
    assert (row["channel"], row["values_str"], row["nsamp"], row["channel_type"]) == ("", [], 0, "other_waveform")


def test_vitals(spark, site):
    parsed = parse(spark, site, VITALS)
    rows = observations.observations(parsed).orderBy("row_idx").collect()
    assert [r["channel"] for r in rows] == [
        "MDC_ECG_HEART_RATE", "CAPSULE:3426", "GIVEN", "FAMILY", "CAPSULE:9569", "SHORT",
    ]
    assert rows[1]["values_str"] == ["M2"] and rows[0]["nsamp"] == 1 and rows[5]["values_str"] == []
    seen = patients.patient_sightings(parsed).orderBy("sighting_idx").collect()
    assert (seen[0]["pid"], seen[0]["first_name"]) == ("P9", "F")
    assert [seen[1][c] for c in ("pid", "visit_id", "first_name", "last_name")] == ["M2", "V7", "ANN", "LEE"]
    assert seen[1]["start_ns"] == 1946549700 * 10**9


def test_device_codes(spark, site):
    text = VITALS.replace("|Device", "|GECarescapeC_5").replace("3426^^CAPSULE", "50101^^CAPSULE").replace(
        "67932^FAMILY^MDC||LEE", "50102^^CAPSULE||BOB^KIM"
    )
    by_prefix = patients.patient_sightings(parse(spark, site, text), match="prefix").where("sighting_idx = 1").first()
    assert (by_prefix["pid"], by_prefix["last_name"], by_prefix["first_name"]) == ("M2", "BOB", "KIM")
    default = patients.patient_sightings(parse(spark, site, text)).where("sighting_idx = 1").first()
    assert (default["pid"], default["first_name"]) == ("", "ANN")


@pytest.mark.parametrize(
    ("text", "code"),
    [
        ("PID|1", "NOT_MSH_FIRST"),
        ("MSH|^~\\&\nPID|1", "MISSING_SEGMENT"),
        (HEAD + "OBX|1|NM|1^A^B||1\nOBR|1", "OBX_WITHOUT_OBR"),
        (HEAD, "NO_OBR"),
        (HEAD + "OBR|1|||5^X^Y", "UNKNOWN_OBR_TYPE"),
        (HEAD + "OBR|1|||69121", "UNKNOWN_OBR_TYPE"),
        (HEAD.replace("ORU^R01", "ORU"), "UNKNOWN_MESSAGE_TYPE"),
        (VITALS.replace("|P9|", "|a^b|"), "BAD_PATIENT_ID"),
        (VITALS.replace("L^F", "a^b^c"), "BAD_PATIENT_NAME"),
        (VITALS.replace("5^SHORT", "SHORT"), "BAD_SIGNAL_NAME"),
        (VITALS.replace("|bpm|", "|a^b|"), "BAD_UNIT"),
        (VITALS.replace("|20310907081500-0400", "|2023"), "BAD_TIME"),
        (VITALS.replace("NORTH-4TN-K718\nOBR", "A^B^C\nOBR"), "LOCATION_SHAPE"),
    ],
)
def test_quarantine(spark, site, text, code):
    row = parse(spark, site, text).first()
    assert row["error_code"] == code and row["error_msg"]


def test_leading_blank_lines_and_later_unknown_obr(spark, site):
    rows = parse(spark, site, "\n\r" + WAVE + "\nOBR|2|||5^X^Y\nOBX|1|NM|bad")
    assert rows.first()["error_code"] is None
    assert observations.observations(rows).count() == 1


def test_json(spark, site):
    rows = {r["control_id"]: r["json"] for r in to_json_rows(parse(spark, site, WAVE, ADT)).collect()}
    wave = json.loads(rows["C1"])
    assert wave[0]["values"] == ["1", "2", "x"] and wave[0]["msh_time"] == 1946549700250000000
    assert not {"pid", "visit_id", "first_name", "last_name", "middle_initial"} & set(wave[0])
    adt = json.loads(rows["A1"])
    assert len(adt) == 1 and adt[0]["hl7_type"] == ["ADT", "A01"] and "channel" not in adt[0]
    empty = HEAD + "OBR|1|||196616^MDC_EVT_ALARM^MDC|||20310907081500-0400"
    assert to_json_rows(parse(spark, site, empty)).first()["json"] == ""


def test_field_query(spark, site):
    text = WAVE + "\nAL1|1|DA|x^y\nAL1|2|FA|z"
    got = fields.extract_fields(parse(spark, site, text), ["msh.1", "MSH.9", "OBX.2", "PV1.3", "AL1.3", "PID.40"])
    assert [r["line"] for r in got.orderBy("line_idx").collect()] == [
        "_OBX.2:NA", "_OBX.2:NM", "MSH.1:|\tMSH.9:ORU^R01", "PV1.3:NORTH-4TN-K718", "AL1.3:x^y", "AL1.3:z", "PID.40:",
    ]
    both = fields.extract_wide(parse(spark, site, text), ["OBR.13", "OBX.2", "AL1"]).orderBy("line_idx").collect()
    assert [(r["kind"], r["_OBR.13"], r["_OBX.2"]) for r in both][:3] == [
        ("OBR", "E1", None), ("OBX", "E1", "NA"), ("OBX", "E1", "NM"),
    ]
    assert both[3]["AL1.None"] == "AL1|1|DA|x^y"


def test_quality_values(spark, site):
    verified = quality.verify_messages(parse(spark, site, WAVE, VITALS, ADT)).orderBy("msg_idx").collect()
    assert len(verified) == 2
    assert verified[0]["errs"] == [] and verified[0]["verify_error"] is None
    assert set(verified[1]["errs"]) == {"ERR: OBX_MISSING_TIME", "ERR: OBR_MISSING_START", "ERR: OBR_MISSING_END"}
    assert verified[1]["event_only"]
    off = WAVE.replace("006-0401", "007-0401")  # one millisecond too long: the bound is strict
    assert quality.verify_messages(parse(spark, site, off)).first()["errs"] == ["ERR: DUR_MISMATCH_SAMPLE_TIMES"]
    delays = quality.message_delays(parse(spark, site, WAVE, VITALS)).orderBy("msg_idx").collect()
    assert [r["delay_ns"] for r in delays] == [244 * 10**6, 10 * 10**9]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("100^R^G505-01^10001^R^^^^5G ICU X^^DEPID", ("", "", "G505-01")),
        ("100^R^B471-01^10001^R^^^^NORTH 4B^^DEPID", ("NORTH", "NORTH 4B", "B471-01")),
        ("100^R^B471-01^10001^R^^^^V DESK^^DEPID", ("NORTH", "V DESK", "B471-01")),
        ("10001021^R^B462-01^10001", ("NORTH", "4B NORTH", "B462-01")),
        ("10007004^R^cv12^10001^^^^^MON", ("MID", "CVPODS", "cv12")),
        ("10007004^R^288^10001", ("MID", "CVICU", "288")),
        ("MID-ANES-CART-AD^^^^^^^^ANES", ("MID", "MID-ANES-CART", "MID-ANES-CART-AD")),
        ("NORTH-4TN-K718^^^^^^^^MON", ("NORTH", "7K WEST ICU", "K718-01")),
        ("ICUW^^ICU231^North Creek Hospital", ("MID", "ICUW", "231-01")),
        ("PACU^^PACU12^North Creek Hospital", ("CREEK", "NC_PACU", "NCPACU12")),
        ("ED^^EDH2^North Creek Hospital", ("CREEK", "ED_UNIT", "EDH2")),
        ("ICU^ICU 17^17^1", ("MID", "ICU", "ICU 17")),
        ("MID^PICU L10", ("MID", "PICU", "MHPICUL110")),
        ("MID^PICU L110", ("MID", "PICU", "MHPICUL110")),
        ("MID^4107-06", ("MID", "41ICU", "4107-06")),
        ("MID^4120-06", ("MID", "20ICU", "4120-06")),
        ("MID^ICU-7", ("MID", "ICU", "ICU-7")),
        ("G5ICU^G505", ("NORTH", "5G ICU", "G505-01")),
        ("NLIC^2035", ("ORTHO", "NLICU", "NL2035")),
        ("POHA^11", ("ORTHO", "EHPOHA", "EHPOHA11")),
        ("NLPACU^21", ("ORTHO", "NLPACU", "NLPACU21")),
        ("MID-4120-01", ("MID", "20ICU", "4120-01")),
        ("NORTH-4TN-K718", ("NORTH", "7K WEST ICU", "K718-01")),
        ("WH-TEST", ("TEST", "TEST", "WH-TEST")),
        ("QQ^N28", ("CREEK", "ED_UNIT", "N28")),
    ],
)
def test_locations(spark, site, text, expected):
    rows = spark.createDataFrame([(text,)], "location_text string")
    row = location.resolve_locations(rows, site).first()
    assert row["location_error"] is None
    assert (row["hospital"], row["bed_unit"], row["bed_id"]) == expected


def test_location_errors(spark, site):
    texts = ["", "a^b^c", "A^^^^^^^^M", "a^b^c^d^e^f^g^h^i^j^k", "x-y", "a-b-c-d", "QQ^ER123", None]
    rows = spark.createDataFrame([(t,) for t in texts], "location_text string")
    assert location.resolve_locations(rows, site).where("location_error is null").count() == 0


def test_single_lookups(spark, site):
    beds = spark.createDataFrame([("K712", "WK7", "10001"), ("X1", "QQ", "NORTH")], "bed_id string, bed_unit string, hospital string")
    out = location.lookup_unit_by_bed(beds, site, default="none")
    out = location.lookup_hospital(location.lookup_canonical_unit(out, site), site).orderBy("bed_id").collect()
    assert [(r["unit_from_bed"], r["canonical_unit"], r["canonical_hospital"]) for r in out] == [
        ("WK7", "7K WEST ICU", "NORTH"), ("none", "", "NORTH"),
    ]
    assert site.canonical_units().count() == 17


def test_samples(spark, site):
    rows = observations.explode_samples(observations.observations(parse(spark, site, WAVE))).orderBy("sample_idx")
    got = rows.collect()
    assert [r["sample_t_ns"] - got[0]["start_t_ns"] for r in got] == [0, 2 * 10**6, 4 * 10**6]


def test_plan_moves_no_message(spark, site):
    """Message-local work has no shuffle: only lookups are joined, by broadcast."""
    rows = observations.observations(parse(spark, site, WAVE))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_own_separators(spark):
    def leaves(text):
        """The tokens of a message by the characters in its fourth to eighth place, in plain Python."""
        f, c, r, _, s = text[3:8]
        out = []
        for segment in text.splitlines():
            if segment.strip():
                for i, field in enumerate(segment.split(f)):
                    whole = segment.startswith("MSH") and i == 1
                    out += [i, "^~\\&"] if whole else [(i, x) for rep in field.split(r) for comp in rep.split(c) for x in comp.split(s)]
        return sorted(map(str, out))

    texts = [
        "MSH|^~\\&|A^B~C&D\rPID|1|x^y&z~#$\nPV1||#", "MSH#$%@!#A$B%C!D\rPID#1#x$y!z%a^b|c&d~e\\f\n\nPV1##|", "MSH^|&~\\^A|B\rPID^1^x|y\\z&q~r",
        "MSH||||||a|b", "MSH*:+?;*a:b+c;d.e[f]", "MSHé^~\\&éa|b^céd",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, message string")
    rows = messages.value_table(messages.segment_table(df, honor_msh_separators=True), honor_msh_separators=True).collect()
    for n, text in enumerate(texts):
        if n != 3:
            found = [str((r.field, r.value)) if (r.name, r.field) != ("MSH", 1) else None for r in rows if r.n == n]
            plain = sorted(x for x in found if x)
            assert plain == [x for x in leaves(text) if x.startswith("(")]
    odd = [None, "", "MSH", "MSH|^", "PID#1", "MSH#$\r%!@"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "n int, message string")
    same = [messages.segment_table(df, honor_msh_separators=x).select("n", "seg_idx", "name", "fields").collect() for x in (True, False)]
    assert same[0] == same[1]


def _plan(spark, df):
    """Optimized plan as text, expressions in full."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        return df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_a_signal_is_searched_once_for_its_samples_and_period(spark):
    text = "MSH|^~\\&|||||20250101000000+0000||ORU^R01"
    parsed = messages.parse_messages(spark.createDataFrame([(1, text)], "msg_idx long, message string"))
    plan = _plan(spark, parsed.select(F.transform("signals", quality._checked).alias("q")))
    assert plan.count(observations.PERIOD_MARK) == 1
    # The last sampled attribute, and the attributes that are not sampled.
    assert plan.count(f"= {observations.ARRAY_TYPE})") == 2
    rows = observations.rows_in_message(F.col("s"), F.lit(True))
    plan = _plan(spark, parsed.select(F.explode("signals").alias("s")).select(rows.alias("r")))
    assert plan.count(f"= {observations.ARRAY_TYPE})") == 2


def test_a_bed_is_brought_to_its_wildcard_form_once(spark, site):
    rows = spark.createDataFrame([("MID-4120-01",), ("MID-ICU-7",)], "location_text string")
    plan = _plan(spark, location.resolve_locations(rows, site))
    # A pattern is tried and replaced: for the bed that gives the unit, and for the bed if it is another.
    assert plan.count("(-?)01$") == 4
    found = [(r["bed_unit"], r["bed_id"]) for r in location.resolve_locations(rows, site).orderBy("location_text").collect()]
    assert found == [("20ICU", "4120-01"), ("ICU", "7")]


def test_checks_find_what_whole_signals_find(spark, site):
    """Quality codes, delays, sightings and errors need no more of the attributes than the depth ``checks`` reads."""
    texts = [
        WAVE, ADT, VITALS, VITALS.replace("||80|bpm|", "||80|a^b|"), VITALS.replace("5^SHORT", "SHORT"),
        VITALS.replace("20310907081500-0400|||NORTH", "20310907081500-0359|||NORTH"),
        VITALS.replace("||||||||20310907081500-0400", "||||||||20310907081500-0401"),
        VITALS.replace("||||||||20310907081500-0400", "||||||||never"), WAVE.replace("|1^2^x|", "|)|"),
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "msg_idx bigint, message string")

    def found(depth):
        located = located_messages(rows, site, depth)
        verified = quality.verify_messages(located, check_start_times=True)
        tables = [
            located.select("msg_idx", "error_code", "bed_id"), patients.patient_sightings(located),
            quality.message_delays(located), verified.select("msg_idx", "errs", "warns", "wave_types", "verify_error"),
        ]
        return [sorted(t.collect(), key=str) for t in tables]

    whole, checks = found("signals"), found("checks")
    assert checks == whole
    assert {r["error_code"] for r in whole[0]} == {None, "BAD_SIGNAL_NAME", "BAD_UNIT", "BAD_TIME"}
    attributes = parse(spark, site, texts[6]).first()["signals"][0]["attributes"]
    assert attributes[0]["obx_time"] == "20310907081500-0400"


def test_a_field_of_an_obr_is_read_once_for_all_its_lines(spark, site):
    texts = spark.createDataFrame([(0, VITALS)], "msg_idx bigint, message string")
    parsed = messages.parse_messages(texts, depth="fields")

    def readings(*names):
        plan = fields.extract_fields(parsed, ["OBR.4", *names])._jdf.queryExecution().optimizedPlan().toString()
        return plan.count(".obr[4]")

    assert readings("OBX.3", "OBX.5", "OBX.14") == readings() > 0
    rows = fields.extract_fields(parsed, ["OBR.4", "OBX.5", "OBX.3"]).orderBy("line_idx").collect()
    assert rows[1]["values"] == {
        "_OBR.4": "182777000^monitoring of patient^SCT", "_OBX.3": "1^MDC_ECG_HEART_RATE^MDC", "_OBX.5": "80",
    }
    assert rows[1]["line"].split("\t") == [f"{k}:{v}" for k, v in sorted(rows[1]["values"].items())]
