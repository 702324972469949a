"""Queries over message text derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bedfeed.functions import times, values
from bedfeed.operators import fields, location, messages, observations, patients, quality
from bedfeed.operators.pipeline import located_messages, read_messages, read_observations
from bedfeed.plans import synth
from bedfeed.plans.base import query
from bedfeed.plans.synth import table
from bedfeed.session import compute_once, drop_folder, passing_scratch, scratch_dir, shuffles_dropped, spread
from bedfeed.sinks.json_rows import to_json_rows
from bedfeed.sources import feed, lines

TIME_SQL = (
    "strftime({0}, '%Y%m%d%H%M%S') || '.' || "
    "lpad(CAST((epoch_us({0}) // 1000) % 1000 AS VARCHAR), 3, '0') || '+0000'"
)
EVENTS_SQL = f"""
e AS (
  SELECT event_id, user_id, event_type, ts, value,
    CAST(round(value * 100) AS BIGINT) AS c,
    (epoch_us(ts) // 1000) * 1000000 AS ns,
    {TIME_SQL.format('ts')} AS t,
    {TIME_SQL.format('(ts + INTERVAL 12 MILLISECOND)')} AS t_end,
    'H' || (user_id % 5) || '-' || (4100 + user_id % 25) || '-'
      || lpad(CAST(user_id % 20 AS VARCHAR), 2, '0') AS loc,
    (4100 + user_id % 25) || '-' || lpad(CAST(user_id % 20 AS VARCHAR), 2, '0') AS bed_id,
    r_name AS hospital, n_name AS bed_unit
  FROM events
  JOIN nation ON n_nationkey = user_id % 25
  JOIN region ON r_regionkey = n_regionkey
)"""


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events"), "event_id")


def event_messages(spark: SparkSession, sf_dir: str, depth: str = "signals") -> DataFrame:
    """Parsed and located messages of all events."""
    texts = synth.messages_from_events(event_table(spark, sf_dir))
    return located_messages(texts, synth.site_tables(spark, sf_dir), depth)


@query(
    f"""WITH {EVENTS_SQL},
    s AS (
      SELECT unnest(['MSH', 'PID', 'PV1', 'MSH', 'PID', 'PV1']) AS name FROM e
      UNION ALL SELECT 'EVN' FROM e WHERE event_type IN ('signup', 'purchase')
      UNION ALL SELECT 'OBR' FROM e WHERE event_type IN ('view', 'click', 'error')
      UNION ALL SELECT 'OBX' FROM e, range(4) r(i)
        WHERE i < CASE WHEN event_type = 'view' AND event_id % 3 = 2 THEN 2
                       WHEN event_type = 'view' THEN 3 WHEN event_type = 'click' THEN 4
                       WHEN event_type = 'error' THEN 2 ELSE 0 END)
    SELECT name, count(*) AS n FROM s GROUP BY name"""
)
def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments in file contents with mixed line ends."""
    contents = synth.contents_from_events(event_table(spark, sf_dir))
    rows = messages.segment_table(feed.split_messages(contents))
    return messages.message_level(rows, []).select("name", "n")


@query(
    f"""WITH {EVENTS_SQL}
    SELECT 'PID' AS name, f AS field,
      CAST(count(*) * CASE WHEN f IN (3, 18) THEN 5 WHEN f = 5 THEN 2 ELSE 1 END AS BIGINT) AS leaves,
      CAST(sum(CASE WHEN f = 0 THEN 3 WHEN f IN (3, 18) THEN length('P' || user_id) + 3
        WHEN f = 5 THEN length('LAST' || user_id) + length('FIRST' || user_id) ELSE 0 END) AS BIGINT) AS chars
    FROM e, range(19) r(f) GROUP BY f"""
)
def leaf_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf values of the PID fields after splitting repetitions, components and subcomponents."""
    texts = synth.messages_from_events(event_table(spark, sf_dir))
    rows = messages.segment_table(texts).where(F.col("name") == "PID")
    return messages.value_table(rows).groupBy("name", F.col("field").cast("bigint").alias("field")).agg(
        F.count(F.lit(1)).alias("leaves"), F.sum(F.length("value")).cast("bigint").alias("chars")
    )


@query(
    f"""WITH {EVENTS_SQL}
    SELECT 'PID' AS name, f AS field,
      CAST(count(*) * CASE WHEN f IN (3, 18) THEN 5 WHEN f = 5 THEN 2 ELSE 1 END AS BIGINT) AS leaves,
      CAST(sum(CASE WHEN f = 0 THEN 3 WHEN f IN (3, 18) THEN length('P' || user_id) + 3
        WHEN f = 5 THEN length('LAST' || user_id) + length('FIRST' || user_id) ELSE 0 END) AS BIGINT) AS chars,
      CAST(sum(CASE WHEN f = 5 AND event_id % 3 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS held
    FROM e, range(19) r(f) GROUP BY f"""
)
def own_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf values of PID in messages of which a third each uses the default separators, others, and those in another
    order; names hold characters that are separators elsewhere."""
    texts, n = synth.messages_from_events(event_table(spark, sf_dir)), F.col("msg_idx") % 3
    other = F.replace(F.translate("message", "|^~\\&", "#$%@!"), F.lit("LAST"), F.lit("LA^T"))
    turned = F.replace(F.translate("message", "|^~\\&", "^|&~\\"), F.lit("LAST"), F.lit("LA#T"))
    mixed = texts.withColumn("message", F.when(n == 0, F.col("message")).when(n == 1, other).otherwise(turned))
    rows = messages.segment_table(mixed, honor_msh_separators=True).where(F.col("name") == "PID")
    values = messages.value_table(rows, honor_msh_separators=True)
    return values.groupBy("name", F.col("field").cast("bigint").alias("field")).agg(
        F.count(F.lit(1)).alias("leaves"), F.sum(F.length("value")).cast("bigint").alias("chars"),
        F.sum(F.col("value").rlike("LA[#^]T").cast("bigint")).alias("held"),
    )


@query(
    f"""WITH {EVENTS_SQL}
    SELECT CASE event_type WHEN 'view' THEN 'Waveform' WHEN 'click' THEN 'Vitals'
      WHEN 'error' THEN 'Alarm' ELSE 'ADT' END AS msg_kind,
      CASE event_type WHEN 'signup' THEN 'A01' WHEN 'purchase' THEN 'A03' ELSE 'R01' END AS hl7_event,
      count(*) AS n FROM e GROUP BY ALL"""
)
def message_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = synth.messages_from_events(event_table(spark, sf_dir))
    parsed = messages.valid(messages.parse_messages(texts, depth="header"))
    return parsed.groupBy("msg_kind", "hl7_event").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {EVENTS_SQL}
    SELECT CAST(event_id AS VARCHAR) AS control_id, ns AS msh_time_ns, 'MON' AS send_app,
      'P' AS deployment, 'PROF_1' AS profile, 'I' AS patient_class, loc AS location_text FROM e"""
)
def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = synth.messages_from_events(event_table(spark, sf_dir))
    return messages.header(messages.parse_messages(texts, depth="header")).select(
        "control_id", "msh_time_ns", "send_app", "deployment", "profile", "patient_class", "location_text"
    )


@query(
    f"""WITH {EVENTS_SQL}
    SELECT hospital, bed_unit, bed_id, 'P' || user_id AS pid, 'V' || user_id AS visit_id,
      'FIRST' || user_id AS first_name, 'LAST' || user_id AS last_name, ns AS msh_time_ns, count(*) AS n
    FROM e GROUP BY ALL"""
)
def message_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header rows with resolved location and patient identity."""
    return observations.header_rows(event_messages(spark, sf_dir, "header")).groupBy(
        "hospital", "bed_unit", "bed_id", "pid", "visit_id", "first_name", "last_name", "msh_time_ns"
    ).agg(F.count(F.lit(1)).alias("n"))


_LINES_SQL = f"""WITH {EVENTS_SQL},
    obr AS (SELECT event_id, 'OBR' AS kind, '_OBR.4:' || CASE event_type
        WHEN 'view' THEN '69121^MDC_OBS_WAVE_CTS^MDC' WHEN 'click' THEN '182777000^monitoring of patient^SCT'
        ELSE '196616^MDC_EVT_ALARM^MDC' END AS line FROM e WHERE event_type IN ('view', 'click', 'error')),
    x AS (SELECT event_id, unnest(CASE
        WHEN event_type = 'view' AND event_id % 3 = 0 THEN
          ['131329^MDC_ECG_ELEC_POTL_I^MDC', '67981^MDC_ATTR_TIME_PD_SAMP^MDC', '131330^MDC_ECG_ELEC_POTL_II^MDC']
        WHEN event_type = 'view' AND event_id % 3 = 1 THEN
          ['131329^MDC_ECG_ELEC_POTL_I^MDC', '67981^MDC_ATTR_TIME_PD_SAMP^MDC', '131329^MDC_ECG_ELEC_POTL_I^MDC']
        WHEN event_type = 'view' THEN
          ['131329^MDC_ECG_ELEC_POTL_I^MDC', '67981^MDC_ATTR_TIME_PD_SAMP^MDC']
        WHEN event_type = 'click' THEN ['147842^MDC_ECG_HEART_RATE^MDC', '3426^^CAPSULE',
          '67933^MDC_ATTR_PT_NAME_GIVEN^MDC', '67932^MDC_ATTR_PT_NAME_FAMILY^MDC']
        WHEN event_type = 'error' THEN ['8^ALARM_LEVEL', '9^ALARM_STATE^LOCAL'] ELSE [] END) AS name FROM e),
    lines AS (
      SELECT event_id, kind, line FROM obr
      UNION ALL SELECT x.event_id, 'OBX', obr.line || chr(9) || '_OBX.3:' || name FROM x JOIN obr USING (event_id)
      UNION ALL SELECT event_id, 'MSH', 'MSH.1:|' || chr(9) || 'MSH.10:' || event_id FROM e
      UNION ALL SELECT event_id, 'PID', 'PID.5:LAST' || user_id || '^FIRST' || user_id FROM e
      UNION ALL SELECT event_id, 'EVN', 'EVN.1:A0' || CASE event_type WHEN 'signup' THEN '1' ELSE '3' END
        FROM e WHERE event_type IN ('signup', 'purchase'))"""


@query(f"{_LINES_SQL} SELECT event_id AS msg_idx, kind, line FROM lines")
def field_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field query over all segment kinds, as text lines."""
    texts = synth.messages_from_events(event_table(spark, sf_dir))
    wanted = ["OBR.4", "OBX.3", "MSH.1", "MSH.10", "PID.5", "EVN.1"]
    return fields.extract_fields(messages.parse_messages(texts, depth="fields"), wanted).select("msg_idx", "kind", "line")


@query(
    f"""WITH {EVENTS_SQL}
    SELECT location, kind, count(*) AS n FROM (
      SELECT loc AS location, 'PV1' AS kind FROM e
      UNION ALL SELECT loc, 'OBR' FROM e WHERE event_type IN ('view', 'click', 'error')) GROUP BY ALL"""
)
def field_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field query with one column per field."""
    texts = synth.messages_from_events(event_table(spark, sf_dir))
    wide = fields.extract_wide(messages.parse_messages(texts, depth="header"), ["PV1.3", "OBR.10"], only_usable=True)
    return wide.groupBy(F.coalesce(F.col("`PV1.3`"), F.col("`_OBR.10`")).alias("location"), "kind").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    f"""WITH {EVENTS_SQL},
    a AS (
      SELECT e.*, unnest(CASE WHEN event_type = 'click' THEN [
          {{'ch': 'MDC_ECG_HEART_RATE', 'v': CAST(c AS VARCHAR), 'vt': 'NM', 'ct': 'NUM', 'u': 'bpm', 'x': CAST(c AS DOUBLE), 'm': 1}},
          {{'ch': 'CAPSULE:3426', 'v': 'M' || user_id, 'vt': 'ST', 'ct': 'other', 'u': '', 'x': NULL, 'm': 1}},
          {{'ch': 'MDC_ATTR_PT_NAME_GIVEN', 'v': 'GIVEN' || user_id, 'vt': 'ST', 'ct': 'PID', 'u': '', 'x': NULL, 'm': 1}},
          {{'ch': 'MDC_ATTR_PT_NAME_FAMILY', 'v': 'FAMILY' || user_id, 'vt': 'ST', 'ct': 'PID', 'u': '', 'x': NULL, 'm': 1}}]
        ELSE [
          {{'ch': 'ALARM_LEVEL', 'v': 'HIGH', 'vt': 'ST', 'ct': 'other', 'u': '', 'x': NULL, 'm': 1}},
          {{'ch': 'ALARM_STATE', 'v': 'ON,' || c, 'vt': 'CWE', 'ct': 'other', 'u': '', 'x': NULL, 'm': 1}}] END) AS r
      FROM e WHERE event_type IN ('click', 'error'))
    SELECT CAST(event_id AS VARCHAR) AS control_id, hospital, bed_unit, bed_id, 'P' || user_id AS pid,
      CASE event_type WHEN 'click' THEN 'monitoring of patient' ELSE 'MDC_EVT_ALARM' END AS msg_type,
      'DEV_1' AS src, r.ch AS channel, '1.0.0.1:7' AS channel_id, r.ct AS channel_type, ns AS start_t_ns,
      ns AS obx_start_t_ns, r.v AS value_text, r.x AS value_number, r.vt AS value_type, r.u AS uom,
      CAST(r.m AS BIGINT) AS nsamp FROM a"""
)
def vitals_alarm_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per attribute of vitals and alarm messages."""
    rows = observations.observations(event_messages(spark, sf_dir))
    return rows.where(F.col("msg_type") != messages.WAVEFORM_SIGNAL).select(
        "control_id", "hospital", "bed_unit", "bed_id", "pid", "msg_type", "src", "channel", "channel_id",
        "channel_type", "start_t_ns", "obx_start_t_ns", F.array_join("values_str", ",").alias("value_text"),
        F.get("values_num", F.lit(0)).alias("value_number"), "value_type", F.col("UoM").alias("uom"), "nsamp",
    )


_OFFSET_SQL = "CASE event_id % 3 WHEN 0 THEN 10 WHEN 1 THEN 5 ELSE 0 END"


@query(
    f"""WITH {EVENTS_SQL}
    SELECT CAST(event_id AS VARCHAR) AS control_id, hospital, bed_unit, bed_id,
      CASE WHEN event_id % 3 = 0 THEN 'MDC_ECG_ELEC_POTL_II' ELSE 'MDC_ECG_ELEC_POTL_I' END AS channel,
      'WV_ECG' AS channel_type, ns AS start_t_ns, ns + 12000000 AS end_t_ns,
      CAST(3 * (c + {_OFFSET_SQL}) + 3 AS DOUBLE) AS total, 'NA' AS value_type, 'MDC_DIM_MILLI_VOLT' AS uom,
      CAST(4.0 AS DOUBLE) AS pd_samp_ms, CAST(3 AS BIGINT) AS nsamp
    FROM e WHERE event_type = 'view'"""
)
def waveform_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per waveform OBR: its last sampled attribute, with duplicates by name resolved."""
    rows = observations.observations(event_messages(spark, sf_dir))
    total = F.aggregate("values_num", F.lit(0.0), lambda a, v: a + v)
    return rows.where(F.col("msg_type") == messages.WAVEFORM_SIGNAL).select(
        "control_id", "hospital", "bed_unit", "bed_id", "channel", "channel_type", "start_t_ns", "end_t_ns",
        total.alias("total"), "value_type", F.col("UoM").alias("uom"), "pd_samp_ms", "nsamp",
    )


@query(
    f"""WITH {EVENTS_SQL}
    SELECT CAST(event_id AS VARCHAR) AS control_id, i AS sample_idx, ns + i * 4000000 AS sample_t_ns,
      CAST(c + {_OFFSET_SQL} + i AS DOUBLE) AS sample
    FROM e, range(3) r(i) WHERE event_type = 'view'"""
)
def waveform_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = observations.observations(event_messages(spark, sf_dir))
    waves = rows.where(F.col("msg_type") == messages.WAVEFORM_SIGNAL)
    return observations.explode_samples(waves).select(
        "control_id", F.col("sample_idx").cast("bigint").alias("sample_idx"), "sample_t_ns", "sample"
    )


@query(
    f"""WITH {EVENTS_SQL},
    a AS (
      SELECT bed_unit, 'WV_ECG' AS channel_type, CAST(c + {_OFFSET_SQL} + i AS DOUBLE) AS v, event_id, i
        FROM e, range(3) r(i) WHERE event_type = 'view'
      UNION ALL SELECT bed_unit, 'NUM', CAST(c AS DOUBLE), event_id, 0 FROM e WHERE event_type = 'click'
      UNION ALL SELECT bed_unit, 'other', NULL, event_id, 0 FROM e WHERE event_type = 'click'
      UNION ALL SELECT bed_unit, 'PID', NULL, event_id, i FROM e, range(2) r(i) WHERE event_type = 'click'
      UNION ALL SELECT bed_unit, 'other', NULL, event_id, i FROM e, range(2) r(i) WHERE event_type = 'error')
    SELECT bed_unit, channel_type,
      CAST(count(CASE WHEN channel_type <> 'WV_ECG' OR i = 0 THEN 1 END) AS BIGINT) AS n_rows,
      CAST(count(v) AS BIGINT) AS n_values, round(sum(v) / count(v), 6) AS mean_value FROM a GROUP BY ALL"""
)
def rows_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and mean value per bed unit and channel type, from message text."""
    return unit_totals(observations.observations(event_messages(spark, sf_dir)))


def unit_totals(rows: DataFrame) -> DataFrame:
    numbers = F.coalesce("values_num", F.array().cast("array<double>"))
    return rows.select(
        "bed_unit", "channel_type",
        F.aggregate(numbers, F.lit(0.0), lambda a, v: a + v).alias("s"),
        F.size(numbers).cast("bigint").alias("k"),
    ).groupBy("bed_unit", "channel_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("k").alias("n_values"),
        F.round(F.try_divide(F.sum("s"), F.sum("k")), 6).alias("mean_value"),
    )


@query(
    f"""WITH {EVENTS_SQL}
    SELECT event_id AS msg_idx, [
      'NOT_MSH_FIRST', 'MISSING_SEGMENT', 'OBX_WITHOUT_OBR', 'UNKNOWN_OBR_TYPE', 'UNKNOWN_MESSAGE_TYPE',
      'LOCATION_SHAPE', 'BAD_PATIENT_ID', 'BAD_TIME', 'BAD_SIGNAL_NAME'][CAST(event_id % 17 + 1 AS INTEGER)] AS error_code
    FROM e WHERE event_id % 17 < 9"""
)
def quarantined_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that cannot be used, with the reason; all others pass."""
    texts = synth.faulty_messages(event_table(spark, sf_dir))
    located = located_messages(texts, synth.site_tables(spark, sf_dir))
    return messages.quarantine(located).select("msg_idx", "error_code")


_QUALITY_RULES = [
    (0, "ERR: MSH_MISSING_TIME"), (1, "ERR: OBX_MISSING_TIME"), (2, "ERR: BAD_PARSE"),
    (3, "ERR: PV1_OBR_BED_MISMATCH"), (4, "ERR: OBR_MULTIPLE_ENVS"), (5, "ERR: OBR_MISSING_START"),
    (5, "ERR: OBR_MISSING_END"), (6, "ERR: OBR_MISSING_START"), (6, "ERR: OBR_MISSING_END"),
    (6, "ERR: OBR_MISSING_EVENT_TIME"), (7, "ERR: OBR_MISSING_START"), (7, "ERR: OBR_MISSING_END"),
    (7, "WARN: OBR_MULTIPLE_EVENT_TIMES"), (8, "ERR: OBR_END_BEFORE_START"),
    (8, "ERR: DUR_MISMATCH_SAMPLE_TIMES"), (9, "ERR: DUR_MISMATCH_SAMPLE_TIMES"),
    (10, "ERR: OBR_END_BEFORE_START"), (10, "ERR: DUR_MISMATCH_SAMPLE_TIMES"),
]
_START_RULES = [
    *[(r, "WARN: OBR_OBX_START_MISMATCH") for r in (1, 6, 7, 10)],
    (10, "WARN: OBR_MULTIPLE_START"), (10, "WARN: OBR_MULTIPLE_END"),
    *[(r, "WARN: MSH_BEFORE_OBR_START") for r in (1, 2, 3, 4, 5, 7, 8, 9, 10, 12)],
    *[(r, "WARN: MSH_BEFORE_OBR_END") for r in (1, 2, 3, 4, 8, 9, 10, 12)],
]


def _codes_sql(rules: list[tuple[int, str]]) -> str:
    rows = ", ".join(f"({r}, '{code}')" for r, code in rules)
    return f"""WITH {EVENTS_SQL}, rules(r, code) AS (VALUES {rows}),
    codes AS (SELECT e.*, code, CASE WHEN r IN (5, 6, 7) THEN 'MDC_EVT_ALARM' ELSE 'MDC_OBS_WAVE_CTS' END
      AS wave_types FROM e JOIN rules ON event_id % 13 = r
      WHERE code <> 'ERR: PV1_OBR_BED_MISMATCH' OR loc <> 'H0-4100-00')"""


def doubtful(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = synth.doubtful_messages(event_table(spark, sf_dir))
    return located_messages(texts, synth.site_tables(spark, sf_dir), "checks")


@query(f"{_codes_sql(_QUALITY_RULES)} SELECT event_id AS msg_idx, wave_types, code FROM codes")
def quality_by_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality codes of each message."""
    codes = quality.quality_codes(quality.verify_messages(doubtful(spark, sf_dir)))
    return codes.select("msg_idx", F.array_join("wave_types", ",").alias("wave_types"), "code")


@query(
    f"""{_codes_sql(_QUALITY_RULES + _START_RULES)}
    SELECT wave_types, code, count(*) AS messages FROM codes GROUP BY ALL"""
)
def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per quality code, with the rules that compare start times."""
    return quality.quality_summary(quality.verify_messages(doubtful(spark, sf_dir), check_start_times=True))


@query(
    f"""{_codes_sql(_QUALITY_RULES)}, site AS (
      SELECT codes.code, CASE WHEN event_id % 13 = 3 THEN first_unit.n_name ELSE bed_unit END AS bed_unit
      FROM codes, (SELECT n_name FROM nation WHERE n_nationkey = 0) first_unit)
    SELECT bed_unit, code, count(*) AS messages FROM site GROUP BY ROLLUP (bed_unit, code)"""
)
def quality_by_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per unit and quality code with totals."""
    return quality.quality_rollup(quality.verify_messages(doubtful(spark, sf_dir)))


@query(
    f"""WITH {EVENTS_SQL}
    SELECT CAST(count(*) FILTER (event_id % 13 = 11) AS BIGINT) AS unchecked,
      CAST(count(*) FILTER (event_id % 13 IN (5, 6, 7)) AS BIGINT) AS event_only,
      count(*) AS messages FROM e"""
)
def quality_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    verified = quality.verify_messages(doubtful(spark, sf_dir))
    return verified.agg(
        F.count("verify_error").alias("unchecked"),
        F.count(F.when(F.col("event_only"), 1)).alias("event_only"),
        F.count(F.lit(1)).alias("messages"),
    )


@query(
    f"""WITH {EVENTS_SQL}
    SELECT CASE event_type WHEN 'view' THEN 'MDC_OBS_WAVE_CTS' WHEN 'click' THEN 'monitoring of patient'
      ELSE 'MDC_EVT_ALARM' END AS msg_type, count(*) AS signals,
      CAST(sum(CASE WHEN event_type = 'view' THEN -12000000 ELSE 0 END) AS BIGINT) AS total_delay_ns
    FROM e WHERE event_type IN ('view', 'click', 'error') GROUP BY 1"""
)
def signal_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    delays = quality.message_delays(event_messages(spark, sf_dir, "checks"))
    return delays.groupBy("msg_type").agg(
        F.count("delay_ns").alias("signals"), F.sum("delay_ns").alias("total_delay_ns")
    )


@query(
    f"""WITH {EVENTS_SQL}
    SELECT hospital, bed_unit, bed_id, 'P' || user_id AS pid, 'V' || user_id AS visit_id,
      'FIRST' || user_id AS first_name, 'LAST' || user_id AS last_name, ns AS start_ns FROM e
    UNION ALL SELECT hospital, bed_unit, bed_id, 'M' || user_id, '', 'GIVEN' || user_id,
      'FAMILY' || user_id, ns FROM e WHERE event_type = 'click'"""
)
def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient sightings: one per message, and a second from the device codes of vitals."""
    rows = patients.patient_sightings(event_messages(spark, sf_dir, "checks"))
    return rows.select(
        "hospital", "bed_unit", "bed_id", "pid", "visit_id", "first_name", "last_name", "start_ns"
    )


_COMMON_JSON = """'"msh_time":' || ns || ',"hl7_type":["' || k || '"],"profile":"PROF_1","control_id":"'
  || event_id || '","deployment":"P","hospital":"' || hospital || '","bed_unit":"' || bed_unit
  || '","bed_id":"' || bed_id || '"'"""


@query(
    f"""WITH {EVENTS_SQL}, j AS (
      SELECT *, CASE event_type WHEN 'signup' THEN 'ADT","A01' WHEN 'purchase' THEN 'ADT","A03'
        ELSE 'ORU","R01' END AS k FROM e),
    m AS (SELECT *, {_COMMON_JSON} AS common,
      ',"src":"DEV_1","msg_type":"' || CASE event_type WHEN 'view' THEN 'MDC_OBS_WAVE_CTS'
        WHEN 'click' THEN 'monitoring of patient' ELSE 'MDC_EVT_ALARM' END || '","start_t":' || ns
        || ',"end_t":' || CASE WHEN event_type = 'view' THEN CAST(ns + 12000000 AS VARCHAR)
          ELSE '-9223372036854775808' END AS signal,
      '","obx_start_t":' || ns || ',"values":["' AS mid,
      '","ref_range":"","pd_samp_ms":null,"nsamp":1' AS tail FROM j)
    SELECT CAST(event_id AS VARCHAR) AS control_id, CASE event_type
      WHEN 'view' THEN '[{{' || common || signal || ',"channel":"MDC_ECG_ELEC_POTL_I'
        || CASE WHEN event_id % 3 = 0 THEN 'I' ELSE '' END || '","channel_id":"1.0.0.1:7","channel_type":"WV_ECG'
        || mid || (c + {_OFFSET_SQL}) || '","' || (c + {_OFFSET_SQL} + 1) || '","' || (c + {_OFFSET_SQL} + 2)
        || '"],"value_type":"NA","UoM":"MDC_DIM_MILLI_VOLT","ref_range":"","pd_samp_ms":4.0,"nsamp":3}}]'
      WHEN 'click' THEN '[' || array_to_string([
        '{{' || common || signal || ',"channel":"' || x.ch || '","channel_id":"1.0.0.1:7","channel_type":"'
          || x.ct || mid || x.v || '"],"value_type":"' || x.vt || '","UoM":"' || x.u || tail || '}}'
        FOR x IN [
          {{'ch': 'MDC_ECG_HEART_RATE', 'ct': 'NUM', 'v': CAST(c AS VARCHAR), 'vt': 'NM', 'u': 'bpm'}},
          {{'ch': 'CAPSULE:3426', 'ct': 'other', 'v': 'M' || user_id, 'vt': 'ST', 'u': ''}},
          {{'ch': 'MDC_ATTR_PT_NAME_GIVEN', 'ct': 'PID', 'v': 'GIVEN' || user_id, 'vt': 'ST', 'u': ''}},
          {{'ch': 'MDC_ATTR_PT_NAME_FAMILY', 'ct': 'PID', 'v': 'FAMILY' || user_id, 'vt': 'ST', 'u': ''}}]], ',') || ']'
      WHEN 'error' THEN '[' || array_to_string([
        '{{' || common || signal || ',"channel":"' || x.ch || '","channel_id":"1.0.0.1:7","channel_type":"other'
          || mid || x.v || '"],"value_type":"' || x.vt || '","UoM":"' || tail || '}}'
        FOR x IN [{{'ch': 'ALARM_LEVEL', 'v': 'HIGH', 'vt': 'ST'}},
          {{'ch': 'ALARM_STATE', 'v': 'ON","' || c, 'vt': 'CWE'}}]], ',') || ']'
      ELSE '[{{' || common || '}}]' END AS json FROM m"""
)
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One de-identified JSON array per message."""
    return to_json_rows(event_messages(spark, sf_dir)).select("control_id", "json")


# Events of the feed for each further file in every folder.
FILE_EVENTS = 1_000_000
# Events in a packed file: a task reads files by their bytes, and of packed ones it would take too many events.
PACKED_FILE_EVENTS = 10_000


def write_feed(spark: SparkSession, sf_dir: str, one_file: bool = False, packed: bool = False) -> str:
    """All file contents as text files below bed, year, month, day and hour folders: one in a folder, or more if there
    are many events, so that no task writes a whole folder of a large feed. Events are dealt out, not their texts.
    ``packed`` files are smaller and gzipped."""
    path = scratch_dir(spark)
    events = table(spark, sf_dir, "events").withColumns(
        {"y": F.year("ts"), "m": F.month("ts"), "d": F.lit(1), "h": F.lit(0), "room": synth.room(F.col("user_id"))}
    )
    files = 1 if one_file else 1 + events.count() // FILE_EVENTS
    folder = ("room", "y", "m", "d", "h")
    numbered = events.withColumn("n", F.col("event_id") % files)
    dealt = numbered.repartition("room", "y", "m") if files == 1 else numbered.repartition(25 * files, "room", "y", "m", "n")
    contents = synth.contents_from_events(dealt, folder)
    options = {"compression": "gzip", "maxRecordsPerFile": PACKED_FILE_EVENTS} if packed else {}
    with shuffles_dropped(spark):
        contents.select(*folder, F.col("content").alias("value")).write.options(**options).partitionBy(*folder).text(path)
    return path


@query(
    f"""WITH {EVENTS_SQL}
    SELECT 'room=' || (4100 + user_id % 25) AS bed_key, 'h=0' AS dir, msg_kind, count(*) AS messages FROM (
      SELECT user_id, CASE event_type WHEN 'view' THEN 'Waveform' WHEN 'click' THEN 'Vitals'
        WHEN 'error' THEN 'Alarm' ELSE 'ADT' END AS msg_kind FROM e
      UNION ALL SELECT user_id, 'ADT' FROM e) GROUP BY ALL"""
)
def scanned_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written to bed folders, scanned back and split into messages."""
    texts = spread(lines.line_messages(spark, write_feed(spark, sf_dir), ".txt"), "path", "msg_idx")
    parsed = messages.valid(messages.parse_messages(texts))
    return parsed.groupBy("bed_key", "dir", "msg_kind").agg(F.count(F.lit(1)).alias("messages"))


@query(
    f"""WITH {EVENTS_SQL}
    SELECT 'room=' || (4100 + user_id % 25) AS bed_key, count(*) AS messages, CAST(sum(CASE event_type
      WHEN 'view' THEN 1 WHEN 'click' THEN 4 WHEN 'error' THEN 2 ELSE 0 END) AS BIGINT) AS n_rows
    FROM e WHERE event_type IN ('view', 'click', 'error') GROUP BY 1"""
)
def ingested_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and observation rows per bed folder, from files."""
    located = read_messages(spark, write_feed(spark, sf_dir), synth.site_tables(spark, sf_dir), ".txt", by_lines=True)
    rows = observations.flat_signal_rows(located)
    counts = observations.ingest_counts(rows, ("path", "bed_key"))
    return counts.groupBy("bed_key").agg(
        F.sum("messages").alias("messages"), F.sum("rows").alias("n_rows")
    )


@query(
    """SELECT event_id, CASE event_id % 7
      WHEN 0 THEN s + 123456789 WHEN 1 THEN s + 14400000000000 WHEN 2 THEN s + 18000000000000
      WHEN 3 THEN s + 18000000000000 WHEN 4 THEN s + 18000500000000 WHEN 5 THEN s + 18000123456789 END AS ns,
      CASE event_id % 7 WHEN 1 THEN base || '-0400' WHEN 2 THEN base || '-0500' WHEN 0 THEN base || '.123456789+0000'
      WHEN 3 THEN base WHEN 4 THEN base || '.5' WHEN 5 THEN base || '.1234567891234-0500'
      ELSE 'x' || base END AS fixed
    FROM (SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS base, (epoch_us(ts) // 1000000) * 1000000000 AS s
      FROM events)"""
)
def hl7_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time texts with offsets, skewed offsets, fractions, no offset, and malformed ones."""
    base = F.date_format("ts", "yyyyMMddHHmmss")
    text = F.concat(F.lit("x"), base)
    for n, tail in enumerate([".123456789+0000", "-0359", "-0501", "", ".5", ".1234567891234-0500"]):
        text = F.when(F.col("event_id") % 7 == n, F.concat(base, F.lit(tail))).otherwise(text)
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return rows.select(
        "event_id", times.parse_ns(F.col("text")).alias("ns"), times.fix_time(F.col("text")).alias("fixed")
    )


@query(
    """SELECT event_id,
      CASE WHEN event_id % 5 IN (2, 4) THEN NULL ELSE c END AS as_int,
      CAST(CASE WHEN event_id % 5 IN (2, 4) THEN NULL ELSE c END AS DOUBLE) AS as_number,
      CASE event_id % 5 WHEN 2 THEN c || '|' || (c + 1) WHEN 4 THEN c || 'x' ELSE CAST(c AS VARCHAR) END AS as_list,
      CAST(CASE event_id % 5 WHEN 2 THEN 2 * c + 1 WHEN 4 THEN NULL ELSE c END AS DOUBLE) AS list_total,
      event_id % 5 = 4 AS bad_list, event_id % 5 IN (2, 4) AS bad_number
    FROM (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS c FROM events)"""
)
def converted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field texts read as numbers and lists; lists and dirty texts are no numbers."""
    c = synth.cents(F.col("value")).cast("string")
    text = (
        F.when(F.col("event_id") % 5 == 2, F.concat(c, F.lit("^"), (synth.cents(F.col("value")) + 1).cast("string")))
        .when(F.col("event_id") % 5 == 4, F.concat(c, F.lit("x")))
        .otherwise(c)
    )
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    listed = values.convert_field(F.col("text"), "LIST_OF_NUMERIC", as_string=False)
    return rows.select(
        "event_id",
        values.convert_field(F.col("text"), "INT", as_string=False).alias("as_int"),
        values.convert_field(F.col("text"), "NUMERIC", as_string=False).alias("as_number"),
        F.array_join(values.convert_field(F.col("text"), "LIST_OF_STR"), "|").alias("as_list"),
        F.aggregate(listed, F.lit(0.0), lambda a, v: a + v).alias("list_total"),
        values.conversion_error(F.col("text"), "LIST_OF_NUMERIC").alias("bad_list"),
        values.conversion_error(F.col("text"), "NUMERIC").alias("bad_number"),
    )


@query(
    f"""WITH {EVENTS_SQL}
    SELECT hospital, bed_unit, count(DISTINCT bed_id) AS beds, FALSE AS is_cart FROM e GROUP BY ALL"""
)
def bed_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct beds per hospital and unit seen in the feed."""
    return location.bed_inventory(messages.valid(event_messages(spark, sf_dir, "header")))


# ---------------------------------------------------------------- files, fields and times


@query(
    """SELECT 'room=' || (4100 + user_id % 25) AS bed_key, count(DISTINCT (year(ts), month(ts))) AS files,
      TRUE AS ordered FROM events GROUP BY 1"""
)
def feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per bed folder, counted and put in order."""
    files = feed.feed_paths(spark, write_feed(spark, sf_dir, one_file=True), ".txt")
    counts = feed.file_counts(files)
    in_order = W.partitionBy("bed_key").orderBy("place")
    placed = feed.ordered_files(files).select("bed_key", "seg_id", "path", F.monotonically_increasing_id().alias("place"))
    steps = placed.withColumn("last", F.lag(F.struct("seg_id", "path")).over(in_order))
    good = steps.groupBy("bed_key").agg(F.bool_and(F.coalesce(F.col("last") <= F.struct("seg_id", "path"), F.lit(True))).alias("ordered"))
    return counts.join(good, "bed_key")


# Events in a file that is also read whole: a row holds the file, so a larger feed has more files and not larger ones.
WHOLE_FILE_EVENTS = 20_000


@query(
    f"""WITH {EVENTS_SQL}, n AS (SELECT count(*) + count(*) FILTER (event_type IN ('view', 'click', 'error')) AS n FROM e)
    SELECT TRUE AS same, count(*) AS n FROM (
      SELECT event_id FROM e UNION ALL SELECT event_id FROM e WHERE event_type IN ('view', 'click', 'error'))"""
)
def split_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of files read whole and read by pieces: their numbers and texts agree."""
    events = table(spark, sf_dir, "events")
    texts = synth.messages_from_events(events).select("msg_idx", "message")
    shown = events.where(F.col("event_type").isin("view", "click", "error")).select("event_id")
    again = texts.join(shown, F.col("event_id") == F.col("msg_idx")).drop("event_id")
    path = scratch_dir(spark)
    rows = texts.unionByName(again).repartition(max(7, -(-events.count() // WHOLE_FILE_EVENTS)), "msg_idx")
    rows.select(F.concat(F.translate("message", "\r", "\n"), F.lit("\n")).alias("value")).write.text(path)
    whole = feed.split_messages(feed.scan_feed(spark, path, ".txt"))
    pieces = feed.message_rows(feed.scan_feed(spark, path, ".txt", "\n\n"))
    keys = ["path", "msg_idx"]
    a = whole.select(*keys, F.md5(F.btrim("message", F.lit("\n"))).alias("a"))
    b = pieces.select(*keys, F.md5("message").alias("b"))
    return a.join(b, keys, "full").groupBy(F.col("a").eqNullSafe(F.col("b")).alias("same")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {EVENTS_SQL}
    SELECT CASE event_id % 3 WHEN 0 THEN 'LF' WHEN 1 THEN 'CRLF' ELSE 'CR' END AS line_end, TRUE AS same,
      count(*) AS messages FROM e GROUP BY 1"""
)
def split_by_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of files with three kinds of line ends in turn, read by lines: numbers and texts are those of files read
    whole."""
    events = table(spark, sf_dir, "events")
    texts = synth.messages_from_events(events).select("msg_idx", "message")
    kind = F.get(F.array(F.lit("LF"), F.lit("CRLF"), F.lit("CR")), (F.col("msg_idx") % 3).cast("int"))
    end = F.when(kind == "LF", "\n").when(kind == "CRLF", "\r\n").otherwise("\r")
    # The writer ends each row with one more line feed, which a carriage return before it would take in.
    blank = F.when(kind == "CR", F.concat(end, end)).otherwise(end)
    path = scratch_dir(spark)
    marked = F.concat(F.lit("ZLE|"), kind, F.lit("\r"), F.rtrim("message", F.lit("\r")))
    texts.repartition(max(3, -(-events.count() // WHOLE_FILE_EVENTS)), "msg_idx").select(F.concat(F.replace(marked, F.lit("\r"), end), blank).alias("value")).write.text(path)
    whole = feed.split_messages(feed.scan_feed(spark, path, ".txt"))
    by_lines = lines.line_messages(spark, path, ".txt")
    keys = ["path", "msg_idx"]

    def digests(texts: DataFrame, name: str) -> DataFrame:
        """What is compared of a text, so that the join moves no texts: its line end and its digest."""
        line_end = F.regexp_extract("message", "^ZLE\\|([A-Z]+)", 1)
        return texts.select(*keys, F.struct(line_end.alias("line_end"), F.sha2("message", 256).alias("text")).alias(name))

    a = digests(whole.withColumn("message", F.btrim("message", F.lit("\n"))).where("message <> ''"), "a")
    both = a.join(digests(by_lines, "b"), keys, "full")
    line_end = F.coalesce("a", "b")["line_end"]
    return both.groupBy(line_end.alias("line_end"), F.col("a").eqNullSafe(F.col("b")).alias("same")).agg(F.count(F.lit(1)).alias("messages"))


@query(
    f"""WITH {EVENTS_SQL}
    SELECT 'observations' AS kind, count(*) AS n, count(DISTINCT user_id) AS patients
      FROM e, range(4) r(i) WHERE i < CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 4 WHEN 'error' THEN 2 ELSE 0 END
    UNION ALL SELECT 'sightings', 2 * count(*) + count(*) FILTER (event_type = 'click'), NULL FROM e
    UNION ALL SELECT 'quality', count(*), NULL FROM e WHERE event_type IN ('view', 'click', 'error')"""
)
def read_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way from files to tables, run twice on the same files so that the state has two versions.

    Of the first run only the state is used further, and of the files nothing once they were read: both are deleted then.
    """
    path, state = write_feed(spark, sf_dir, packed=True), scratch_dir(spark)
    site = synth.site_tables(spark, sf_dir)
    with passing_scratch(spark):
        read_observations(spark, path, site, state, extension=".txt.gz", by_lines=True)
    found = read_observations(spark, path, site, state, extension=".txt.gz", by_lines=True)
    drop_folder(spark, path)
    none = F.lit(None).cast("bigint")
    out = found["observations"].agg(F.count(F.lit(1)).alias("n"), F.countDistinct("pid").alias("patients")).withColumn("kind", F.lit("observations"))
    for kind in ("sightings", "quality"):
        out = out.unionByName(found[kind].agg(F.count(F.lit(1)).alias("n")).select("n", none.alias("patients"), F.lit(kind).alias("kind")))
    return out


@query(
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE (epoch_us(ts) // 1000000) * 1000000 END AS micros,
      CASE WHEN event_id % 3 = 0 THEN '' ELSE 'MDC|' || event_type END AS unit, '' AS beyond FROM events"""
)
def field_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fields of a segment by number: a time and a list, both blank at times, and a place beyond the end."""
    time = F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lit("+0000"))
    unit = F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("MDC^"), "event_type"))
    blank = F.lit("")
    segment = F.array(
        F.lit("OBX"), F.lit("1"), F.lit("NM"), F.lit("1^X"), blank, F.lit("1"), unit, *[blank] * 7,
        F.when(F.col("event_id") % 4 == 0, blank).otherwise(time),
    )
    rows = compute_once(table(spark, sf_dir, "events").select("event_id", segment.alias("s")), {"s": F.col("s")})
    return rows.select(
        "event_id", F.unix_micros(values.field_or_default(F.col("s"), "OBX.14", as_string=False)).alias("micros"),
        F.array_join(values.field_or_default(F.col("s"), "OBX.6"), "|").alias("unit"),
        values.field_or_default(F.col("s"), "OBX.21").alias("beyond"),
    )


@query(
    """SELECT CAST(sum(c) FILTER (event_id % 5 <> 4) AS BIGINT) AS ints, CAST(sum(c) FILTER (event_id % 5 <> 4) AS DOUBLE) AS floats,
      count(*) AS texts, count(*) AS times
    FROM (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS c FROM events)"""
)
def converted_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole columns of texts cast; what is no number is NULL."""
    cents = synth.cents(F.col("value")).cast("string")
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 5 == 4, F.concat(cents, F.lit("x"))).otherwise(cents).alias("v"), synth.hl7_time(F.col("ts")).alias("t")
    )
    read = rows.select(
        values.convert_column(F.col("v"), "INT").cast("bigint").alias("i"), values.convert_column(F.col("v"), "NUMERIC").alias("f"),
        values.convert_column(F.col("v"), "STR").alias("s"), values.convert_column(F.col("t"), "DATETIME").alias("t"),
    )
    return read.agg(F.sum("i").alias("ints"), F.sum("f").alias("floats"), F.count("s").alias("texts"), F.count("t").alias("times"))


@query(
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.000000') END AS text,
      CASE WHEN event_id % 5 = 0 THEN -9223372036854775808 ELSE (epoch_us(ts) // 1000000) * 1000000000 END AS epoch,
      CASE WHEN event_id % 5 <> 0 THEN (epoch_us(ts) // 1000000) * 1000000 END AS micros FROM events"""
)
def time_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time fields in the three forms of output; every fifth is blank."""
    text = F.when(F.col("event_id") % 5 != 0, F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lit("+0000"))).otherwise("")
    rows = compute_once(table(spark, sf_dir, "events").select("event_id", text.alias("x")), {"x": F.col("x")})
    return rows.select(
        "event_id", times.time_repr(F.col("x"), "text").alias("text"), times.time_repr(F.col("x"), "epoch").alias("epoch"),
        F.unix_micros(times.time_repr(F.col("x"))).alias("micros"),
    )


@query(f"WITH {EVENTS_SQL} SELECT hospital, bed_unit, bed_id, loc AS location_text FROM e GROUP BY ALL")
def bed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location texts with the beds they stand for."""
    return location.bed_mapping(messages.valid(event_messages(spark, sf_dir, "header")))
