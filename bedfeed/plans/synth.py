"""HL7 text and site tables derived from the given tables, as input for the registered queries.

Every event becomes one message: a view is a waveform, a click vitals, an error an alarm, and signups
and purchases are admission messages.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bedfeed.operators.location import SiteTables
from bedfeed.session import compute_once

# Sampling of the waveforms: three samples 4 ms apart.
PERIOD_MS = 4
SAMPLES = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(value: Column) -> Column:
    return F.round(value * 100).cast("bigint")


def hl7_time(ts: Column) -> Column:
    """A zone-less timestamp as HL7 text in UTC with milliseconds."""
    return F.concat(F.date_format(ts, "yyyyMMddHHmmss.SSS"), F.lit("+0000"))


def room(user: Column) -> Column:
    return (F.lit(4100) + user % 25).cast("string")


def bed_number(user: Column) -> Column:
    return F.lpad((user % 20).cast("string"), 2, "0")


def location_text() -> Column:
    user = F.col("user_id")
    return F.concat_ws("-", F.concat(F.lit("H"), user % 5), room(user), bed_number(user))


def _segment(*fields: str | Column) -> Column:
    return F.concat_ws("|", *[F.lit(f) if isinstance(f, str) else f for f in fields])


def _blank(n: int) -> list[str]:
    return [""] * n


def _text(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column))


def head(kind: str | Column, prefix: str = "") -> list[Column]:
    """MSH, PID and PV1 of an event."""
    return [
        _segment(
            "MSH", "^~\\&", "MON", *_blank(3), F.col("_time"), "", kind,
            _text(prefix, "event_id"), "P", "2.6", *_blank(8), "PROF_1^VENDOR^1.3.6^ISO",
        ),
        _segment(
            "PID", "", "", F.concat(_text("P", "user_id"), F.lit("^^^A^MR")), "",
            F.concat(_text("LAST", "user_id"), F.lit("^"), _text("FIRST", "user_id")),
            *_blank(12), F.concat(_text("V", "user_id"), F.lit("^^^A^MR")),
        ),
        _segment("PV1", "", "I", F.col("_bed")),
    ]


def _obr(code: str, end: str | Column, start: Column | None = None) -> Column:
    start = F.col("_time") if start is None else start
    return _segment(
        "OBR", "1", "", "", code, "", "", start, end, "", F.col("_bed"), "", "", "ENV1", *_blank(7), "DEV_1"
    )


def _obx(kind: str, name: str, value: str | Column, unit: str = "", time: Column | str | None = None) -> Column:
    time = F.col("_time") if time is None else time
    return _segment("OBX", "1", kind, name, "1.0.0.1", value, unit, *_blank(7), time, *_blank(6), "7")


def _samples(offset: int) -> Column:
    return F.concat_ws("^", *[(F.col("_cents") + offset + i).cast("string") for i in range(SAMPLES)])


ECG_1 = "131329^MDC_ECG_ELEC_POTL_I^MDC"
ECG_2 = "131330^MDC_ECG_ELEC_POTL_II^MDC"
PERIOD = "67981^MDC_ATTR_TIME_PD_SAMP^MDC"
MILLIVOLT = "266418^MDC_DIM_MILLI_VOLT^MDC"


def waveform_segments() -> list[Column]:
    """One sampled channel. Every third event adds a second channel after it, and every third repeats
    the first channel with other samples."""
    extra = (
        F.when(F.col("event_id") % 3 == 0, _obx("NA", ECG_2, _samples(10), MILLIVOLT))
        .when(F.col("event_id") % 3 == 1, _obx("NA", ECG_1, _samples(5), MILLIVOLT))
    )
    return [
        _obr("69121^MDC_OBS_WAVE_CTS^MDC", F.col("_end")),
        _obx("NA", ECG_1, _samples(0), MILLIVOLT),
        _obx("NM", PERIOD, f"{PERIOD_MS}.0", "264338^MDC_DIM_MILLI_SEC^MDC"),
        extra,
    ]


def vitals_segments() -> list[Column]:
    return [
        _obr("182777000^monitoring of patient^SCT", ""),
        _obx("NM", "147842^MDC_ECG_HEART_RATE^MDC", F.col("_cents").cast("string"), "bpm"),
        _obx("ST", "3426^^CAPSULE", _text("M", "user_id")),
        _obx("ST", "67933^MDC_ATTR_PT_NAME_GIVEN^MDC", _text("GIVEN", "user_id")),
        _obx("ST", "67932^MDC_ATTR_PT_NAME_FAMILY^MDC", _text("FAMILY", "user_id")),
    ]


def alarm_segments() -> list[Column]:
    return [
        _obr("196616^MDC_EVT_ALARM^MDC", ""),
        _obx("ST", "8^ALARM_LEVEL", "HIGH"),
        _obx("CWE", "9^ALARM_STATE^LOCAL", F.concat(F.lit("ON^"), F.col("_cents"))),
    ]


def with_parts(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events with the pieces their messages are made of, and further columns that are named."""
    return events.select(
        "event_id", "user_id", "event_type", *keep,
        hl7_time(F.col("ts")).alias("_time"),
        hl7_time(F.col("ts") + F.expr(f"INTERVAL '{PERIOD_MS * SAMPLES}' MILLISECOND")).alias("_end"),
        cents(F.col("value")).alias("_cents"),
        location_text().alias("_bed"),
    )


def message_segments() -> Column:
    """Segments of an event's message."""

    def segments(kind: str, *lists: list[Column]) -> Column:
        return F.array_compact(F.array(*head(kind), *[s for part in lists for s in part]))

    oru = "ORU^R01^ORU_R01"
    event_type = F.col("event_type")
    return (
        F.when(event_type == "view", segments(oru, waveform_segments()))
        .when(event_type == "click", segments(oru, vitals_segments()))
        .when(event_type == "error", segments(oru, alarm_segments()))
        .when(event_type == "signup", segments("ADT^A01", [_segment("EVN", "A01", F.col("_time"))]))
        .otherwise(segments("ADT^A03", [_segment("EVN", "A03", F.col("_time"))]))
    )


def _joined(events: DataFrame, segments: Column) -> DataFrame:
    """Message texts numbered by their event."""
    parts = with_parts(events).withColumn("msg_idx", F.col("event_id"))
    return compute_once(parts, {"message": F.array_join(segments, "\r")}).select("msg_idx", "message")


def messages_from_events(events: DataFrame) -> DataFrame:
    """One message text per event, numbered by the event."""
    return _joined(events, message_segments())


def contents_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """File contents: the event's message and an update message, with one of three kinds of line end."""
    eol = (
        F.when(F.col("event_id") % 3 == 0, F.lit("\n"))
        .when(F.col("event_id") % 3 == 1, F.lit("\r\n"))
        .otherwise(F.lit("\r"))
    )
    update = F.array(*head("ADT^A08", "B"))
    return with_parts(events, keep).select(
        "event_id", "user_id", *keep,
        F.concat(
            F.array_join(message_segments(), "\n"), F.lit("\n\n"), F.array_join(update, "\n"), F.lit("\n\n"),
        ).alias("_text"),
        eol.alias("_eol"),
    ).select("event_id", "user_id", *keep, F.replace("_text", F.lit("\n"), F.col("_eol")).alias("content"))


def faulty_messages(events: DataFrame) -> DataFrame:
    """Waveform messages of which nine in seventeen cannot be used, each in its own way."""
    case = F.col("event_id") % 17
    msh, pid, pv1 = head("ORU^R01^ORU_R01")
    body = waveform_segments()[:3]
    good = [msh, pid, pv1, *body]
    cases = [
        [pid, msh, pv1, *body],
        [msh, pid, *body],
        [msh, pid, pv1, body[1], body[0]],
        [msh, pid, pv1, _obr("1^OTHER^X", F.col("_end")), *body[1:]],
        [head("ACK^A01")[0], pid, pv1, *body],
        [msh, pid, _segment("PV1", "", "I", "A^B^C"), *body],
        [msh, _segment("PID", "", "", "A^B"), pv1, *body],
        [F.replace(msh, F.col("_time"), F.lit("yesterday")), pid, pv1, *body],
        [msh, pid, pv1, body[0], _obx("NA", "PLAIN", _samples(0))],
    ]
    segments = F.array(*good)
    for n, broken in enumerate(cases):
        segments = F.when(case == n, F.array(*broken)).otherwise(segments)
    return _joined(events, segments)


def doubtful_messages(events: DataFrame) -> DataFrame:
    """Messages that parse but break quality rules: one rule per residue of the event id."""
    case = F.col("event_id") % 13
    msh, pid, pv1 = head("ORU^R01^ORU_R01")
    body = waveform_segments()[:3]
    wave, other = "69121^MDC_OBS_WAVE_CTS^MDC", _segment("PV1", "", "I", "H0-4100-00")
    late = F.replace(F.col("_end"), F.lit("+0000"), F.lit("-0100"))
    alarm = "196616^MDC_EVT_ALARM^MDC"
    no_msh_time = F.replace(msh, F.col("_time"), F.lit(""))
    obr2 = F.replace(_obr(wave, F.col("_end")), F.lit("ENV1"), F.lit("ENV2"))
    state = _obx("ST", "8^ALARM_LEVEL", "HIGH")
    cases = {
        0: [no_msh_time, pid, pv1, *body],
        1: [msh, pid, pv1, body[0], _obx("NA", ECG_1, _samples(0), time=""), body[2]],
        2: [msh, pid, pv1, *body, _obx("ST", "5^NOTE", ")")],
        3: [msh, pid, other, *body],
        4: [msh, pid, pv1, *body, obr2, *body[1:]],
        5: [msh, pid, pv1, _obr(alarm, ""), state],
        6: [msh, pid, pv1, _obr(alarm, "", F.lit("")), state],
        7: [msh, pid, pv1, _obr(alarm, ""), state, _obr(alarm, "", late), state],
        8: [msh, pid, pv1, _obr(wave, F.col("_time")), *body[1:]],
        9: [msh, pid, pv1, _obr(wave, late), *body[1:]],
        10: [msh, pid, pv1, *body, _obr(wave, late, late), *body[1:]],
        11: [msh, pid, pv1, body[0], body[1]],
    }
    segments = F.array(msh, pid, pv1, *body)
    for n, broken in cases.items():
        segments = F.when(case == n, F.array(*broken)).otherwise(segments)
    return _joined(events, segments)


def site_tables(spark: SparkSession, sf_dir: str) -> SiteTables:
    """A site with one hospital per region and one unit per nation; nation n owns room 4100 + n."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    unit = F.concat(F.lit("U"), "n_nationkey")
    return SiteTables(
        beds=nation.select(
            F.concat((F.lit(4100) + F.col("n_nationkey")).cast("string"), F.lit("-??")).alias("bed_wildcard"),
            unit.alias("unit"),
        ),
        units=nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            unit.alias("unit"),
            F.col("r_name").alias("hospital"),
            F.col("n_name").alias("canonical_unit"),
        ),
        hospitals=region.select(
            F.concat(F.lit("H"), "r_regionkey").alias("hospital_raw"), F.col("r_name").alias("hospital")
        ),
    )
