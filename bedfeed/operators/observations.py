"""Observation rows: located messages to one row per channel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bedfeed.functions import times, values
from bedfeed.operators.messages import valid
from bedfeed.session import explode_rows, with_value

# Channel name -> channel type.
CHANNEL_TYPES = {
    "MDC_CONC_AWAY_CO2": "WV_CO2",
    "MDC_ECG_ELEC_POTL_I": "WV_ECG",
    "MDC_ECG_ELEC_POTL_II": "WV_ECG",
    "MDC_ECG_ELEC_POTL_III": "WV_ECG",
    "MDC_ECG_ELEC_POTL_V": "WV_ECG",
    "MDC_ECG_ELEC_POTL_V1": "WV_ECG",
    "MDC_ECG_ELEC_POTL_V2": "WV_ECG",
    "MDC_ECG_ELEC_POTL_V3": "WV_ECG",
    "MDC_ECG_ELEC_POTL_V4": "WV_ECG",
    "MDC_ECG_ELEC_POTL_V5": "WV_ECG",
    "MDC_ECG_ELEC_POTL_V6": "WV_ECG",
    "MDC_ECG_ELEC_POTL_aVF": "WV_ECG",
    "MDC_ECG_ELEC_POTL_aVL": "WV_ECG",
    "MDC_ECG_ELEC_POTL_aVR": "WV_ECG",
    "MDC_ECG_ELEC_POTL_MCL": "WV_ECG",
    "MDC_IMPED_TTHOR": "WV_RESP",
    "MDC_PRESS_BLD": "WV_BP",
    "MDC_PRESS_BLD_ART": "WV_BP",
    "MDC_PRESS_BLD_ART_ABP": "WV_BP",
    "MDC_PRESS_BLD_ART_PULM": "WV_BP",
    "MDC_PRESS_BLD_VEN_CENT": "WV_BP",
    "MDC_PULS_OXIM_PLETH": "WV_PPG",
    "MDC_ECG_AMPL_ST_I": "NUM",
    "MDC_ECG_AMPL_ST_II": "NUM",
    "MDC_ECG_AMPL_ST_III": "NUM",
    "MDC_ECG_AMPL_ST_V1": "NUM",
    "MDC_ECG_AMPL_ST_aVF": "NUM",
    "MDC_ECG_AMPL_ST_aVL": "NUM",
    "MDC_ECG_AMPL_ST_aVR": "NUM",
    "MDC_ECG_HEART_RATE": "NUM",
    "MDC_ECG_V_P_C_RATE": "NUM",
    "MDC_BLD_PULS_RATE_INV": "NUM",
    "MDC_PULS_OXIM_PULS_RATE": "NUM",
    "MDC_PRESS_BLD_NONINV_SYS": "NUM",
    "MDC_PRESS_BLD_NONINV_DIA": "NUM",
    "MDC_PRESS_BLD_NONINV_MEAN": "NUM",
    "MDC_PRESS_BLD_ART_SYS": "NUM",
    "MDC_PRESS_BLD_ART_DIA": "NUM",
    "MDC_PRESS_BLD_ART_MEAN": "NUM",
    "MDC_PRESS_BLD_ART_PULM_SYS": "NUM",
    "MDC_PRESS_BLD_ART_PULM_DIA": "NUM",
    "MDC_PRESS_BLD_ART_PULM_MEAN": "NUM",
    "MDC_PRESS_BLD_VEN_CENT_MEAN": "NUM",
    "MDC_PRESS_CUFF": "NUM",
    "MDC_TEMP": "NUM",
    "MDC_PULS_OXIM_SAT_O2": "NUM",
    "MDC_TTHOR_RESP_RATE": "NUM",
    "MDC_CONC_AWAY_CO2_EXP": "NUM",
    "MDC_CONC_AWAY_CO2_INSP": "NUM",
    "CAPSULE_EVT_SPO2_NOT_CALCULATED": "NUM",
    "CAPSULE_STAT_DEV_COMMUNICATION_READINESS": "DEV",
    "CAPSULE_ATTR_PT_CLASS": "PID",
    "CAPSULE_ATTR_PT_ADMIT_DATE": "PID",
    "CAPSULE_ATTR_ID_LOCATION": "POC",
    "CAPSULE_ATTR_ID_POC": "POC",
    "CAPSULE_ATTR_ID_FACILTY": "POC",
    "MDC_ATTR_ID_SOFT": "DEV",
    "MDC_ATTR_PT_DOB": "PID",
    "MDC_ATTR_PT_ID": "PID",
    "MDC_ATTR_PT_NAME_FAMILY": "PID",
    "MDC_ATTR_PT_NAME_GIVEN": "PID",
    "MDC_ATTR_PT_SEX": "PID",
    "MDC_ATTR_PT_TYPE": "PID",
    "MDC_ATTR_TIME_ABS": "PID",
    "MDC_ATTR_TIME_PD_SAMP": "DEV",
    "MDC_ATTR_VAL_BATT_CHARGE": "DEV",
    "MDC_ATTR_ID_BED": "DEV",
}

# Channel type of unlisted channels, the mark of the sampling period, the array value type.
OTHER_TYPE = "other"
OTHER_WAVEFORM_TYPE = "other_waveform"
PERIOD_MARK = "TIME_PD_SAMP"
ARRAY_TYPE = "NA"

OBSERVATION_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in [
            ("msh_time", T.TimestampType()),
            ("msh_time_ns", T.LongType()),
            ("profile", T.StringType()),
            ("hl7_type", T.StringType()),
            ("hl7_event", T.StringType()),
            ("control_id", T.StringType()),
            ("deployment", T.StringType()),
            ("hospital", T.StringType()),
            ("bed_unit", T.StringType()),
            ("bed_id", T.StringType()),
            ("pid", T.StringType()),
            ("visit_id", T.StringType()),
            ("first_name", T.StringType()),
            ("last_name", T.StringType()),
            ("middle_initial", T.StringType()),
            ("src", T.StringType()),
            ("msg_type", T.StringType()),
            ("start_t", T.TimestampType()),
            ("start_t_ns", T.LongType()),
            ("end_t", T.TimestampType()),
            ("end_t_ns", T.LongType()),
            ("channel", T.StringType()),
            ("channel_id", T.StringType()),
            ("channel_type", T.StringType()),
            ("obx_start_t", T.TimestampType()),
            ("obx_start_t_ns", T.LongType()),
            ("values_num", T.ArrayType(T.DoubleType())),
            ("values_str", T.ArrayType(T.StringType())),
            ("value_type", T.StringType()),
            ("UoM", T.StringType()),
            ("ref_range", T.StringType()),
            ("pd_samp_ms", T.DoubleType()),
            ("nsamp", T.LongType()),
            ("seg_id", T.LongType()),
            ("dir", T.StringType()),
            ("file", T.StringType()),
        ]
    ]
)
VALUE_COLUMNS = ("values_num", "values_str", "values", "index")

_COMMON = (
    "msh_time_ns", "profile", "hl7_type", "hl7_event", "control_id", "deployment",
    "hospital", "bed_unit", "bed_id", "pid", "visit_id", "first_name", "last_name", "middle_initial",
)
_FILE = ("path", "bed_key", "seg_id", "dir", "file", "msg_idx")


def channel_table(spark: SparkSession, types: Mapping[str, str] = CHANNEL_TYPES) -> DataFrame:
    return spark.createDataFrame(list(types.items()), "channel string, channel_type string")


def lookup_channel_type(
    df: DataFrame, default: Column | str, types: Mapping[str, str] = CHANNEL_TYPES
) -> DataFrame:
    """Add ``channel_type``. The table is a Python mapping, so its size is known and it is broadcast."""
    fallback = F.lit(default) if isinstance(default, str) else default
    dim = F.broadcast(channel_table(df.sparkSession, types))
    return df.join(dim, "channel", "left").withColumn(
        "channel_type", F.coalesce("channel_type", fallback)
    )


def header_rows(messages: DataFrame) -> DataFrame:
    """One row of common columns per valid message; the whole output for admission messages."""
    messages = valid(messages)
    return messages.select(
        times.ns_to_timestamp(F.col("msh_time_ns")).alias("msh_time"),
        *_COMMON,
        *[c for c in _FILE if c in messages.columns],
    )


def sampled_attribute(attributes: Column) -> Column:
    """The channel of a waveform OBR: its last array-valued attribute."""
    arrays = F.filter(attributes, lambda a: a["value_type"] == ARRAY_TYPE)
    return F.try_element_at(arrays, F.lit(-1))


def sample_period(attributes: Column) -> Column:
    """Sampling period in ms: the last other attribute whose name marks a period."""
    periods = F.filter(
        attributes,
        lambda a: (a["value_type"] != ARRAY_TYPE) & a["name"].contains(PERIOD_MARK),
    )
    return F.try_element_at(periods, F.lit(-1))["value"].try_cast("double")


def rows_in_message(signal: Column, waveform: Column) -> Column:
    """Channel rows of one signal as an array.

    A waveform signal gives exactly one row, blank when it has no array-valued attribute; other signals
    give one row per named attribute.
    """
    attributes = signal["attributes"]
    blank = F.lit("")

    def row(a: Column, period: Column, sampled: bool) -> Column:
        return F.struct(
            F.coalesce(a["name"], blank).alias("channel"),
            F.coalesce(a["channel_id"], blank).alias("channel_id"),
            a["obx_ns"].alias("obx_start_t_ns"),
            a["value"].alias("value"),
            F.coalesce(a["value_type"], blank).alias("value_type"),
            F.coalesce(a["uom"], blank).alias("UoM"),
            F.coalesce(a["ref_range"], blank).alias("ref_range"),
            period.alias("pd_samp_ms"),
            F.lit(sampled).alias("sampled"),
        )

    no_period = F.lit(None).cast("double")
    named = F.filter(attributes, lambda a: a["name"] != "")
    return F.when(
        waveform, F.array(with_value(sampled_attribute(attributes), lambda a: row(a, sample_period(attributes), True)))
    ).otherwise(F.transform(named, lambda a: row(a, no_period, False)))


def flat_signal_rows(messages: DataFrame) -> DataFrame:
    """Signals of valid non-admission messages, exploded to channel rows with raw value text."""
    good = valid(messages).where(F.col("msg_kind") != "ADT")
    file_columns = [c for c in _FILE if c in good.columns]
    kept = [*_COMMON, *file_columns, "msg_kind"]
    signals = explode_rows(good, kept, F.col("signals"), "s", "obr_idx").where(F.col("s.known"))
    kept += ["obr_idx", F.col("s.src").alias("src"), F.col("s.type").alias("msg_type")]
    kept += [F.col("s.start_ns").alias("start_t_ns"), F.col("s.end_ns").alias("end_t_ns")]
    in_signal = rows_in_message(F.col("s"), F.col("msg_kind") == "Waveform")
    return explode_rows(signals, kept, in_signal, "r", "row_idx").select("*", "r.*").drop("r")


def observations(messages: DataFrame, types: Mapping[str, str] = CHANNEL_TYPES) -> DataFrame:
    """Observation rows of located messages, in the fixed schema plus message order columns.

    Numeric values are always cast; the texts stay in ``values_str``. Values of vitals and alarms count
    as one sample.
    """
    rows = lookup_channel_type(
        flat_signal_rows(messages),
        F.when(F.col("msg_kind") == "Waveform", F.lit(OTHER_WAVEFORM_TYPE)).otherwise(F.lit(OTHER_TYPE)),
        types,
    )
    rows = rows.withColumn("values_str", values.values_text(F.col("value"))).withColumns(
        {
            "values_num": values.values_numeric(F.col("value"), F.col("value_type")),
            "nsamp": F.when(F.col("sampled"), F.size("values_str")).otherwise(F.lit(1)).cast("bigint"),
            **{
                c: times.ns_to_timestamp(F.col(f"{c}_ns"))
                for c in ("msh_time", "start_t", "end_t", "obx_start_t")
            },
        }
    )
    order = [c for c in ("msg_idx", "obr_idx", "row_idx") if c in rows.columns]
    return rows.select(*conform(rows), *order)


def conform(df: DataFrame) -> list[Column]:
    """Columns of the fixed schema, cast; columns the table lacks are NULL."""
    return [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in OBSERVATION_SCHEMA
    ]


def explode_samples(rows: DataFrame) -> DataFrame:
    """One row per waveform sample with its own time."""
    keep = [c for c in rows.columns if c not in ("values_num", "values_str")]
    out = explode_rows(rows, keep, F.col("values_num"), "sample", "sample_idx")
    step = F.rint(F.col("sample_idx") * F.col("pd_samp_ms") * 1e6).cast("bigint")
    return out.withColumn("sample_t_ns", F.col("start_t_ns") + step)


def ingest_counts(rows: DataFrame, by: tuple[str, ...] = ("path",)) -> DataFrame:
    """Messages and rows per file. Shorter keys merge files of equal name in different folders."""
    return rows.groupBy(*by).agg(
        F.countDistinct("msg_idx").alias("messages"), F.count(F.lit(1)).alias("rows")
    )


def dedup_observations(rows: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Drop rows that are equal in everything but their values, keeping the first.

    ``order`` lists the columns that say which row is first, and they are not compared; without it the
    rows have no order, and the smallest value is kept. This is an aggregation, so copies collapse before the shuffle and a heavily
    copied row does no harm.
    """
    order = order or []
    loose = [c for c in rows.columns if c in VALUE_COLUMNS]
    keys = [c for c in rows.columns if c not in loose and c not in order]
    if not loose and not order:
        return rows.dropDuplicates()
    picked = F.min(F.struct(*order, *loose)).alias("_first")
    out = rows.groupBy(*keys).agg(picked)
    return out.select(*[c if c in keys else F.col(f"_first.{c}").alias(c) for c in rows.columns])
