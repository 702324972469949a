"""Streams over arriving HL7 files and observation rows.

The message-local operators are the batch functions; only state, duplicates and windowed counts need
streaming forms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bedfeed.operators.location import SiteTables
from bedfeed.operators.observations import VALUE_COLUMNS, observations
from bedfeed.operators.patients import BED, ORDER, PERSON, attribute_patient, first_sightings, patient_sightings
from bedfeed.operators.pipeline import located_messages
from bedfeed.operators.quality import quality_codes, verify_messages
from bedfeed.sinks.json_rows import to_json_rows
from bedfeed.sinks.tables import fixed_columns
from bedfeed.sources.feed import _with_paths, split_messages
from bedfeed.sources.state import update_state


def stream_messages(
    spark: SparkSession, root: str, site: SiteTables, extension: str = ".hl7",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Arriving files as located messages."""
    reader = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{extension}")
        .option("wholetext", True)
    )
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    files = _with_paths(reader.text(root, wholetext=True), root)
    return located_messages(split_messages(files), site)


def stream_observations(messages: DataFrame) -> DataFrame:
    return observations(messages)


def write_observation_stream(
    rows: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ("hospital", "bed_unit"),
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream of observations to a partitioned table, each row once."""
    writer = (
        fixed_columns(rows)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_patient_state(
    messages: DataFrame, state_path: str, checkpoint: str,
    on_rows: Callable[[DataFrame, int], None] | None = None, available_now: bool = False,
) -> StreamingQuery:
    """Advance the patient state with every micro-batch.

    The state version is the batch number, so a repeated batch overwrites its own version and starts from
    the one before. ``on_rows`` gets the batch's observations, attributed to patients, and its number.
    """

    def advance(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if on_rows is None:
            # Parsed messages are wide, and only the first sightings are needed of them.
            firsts = first_sightings(patient_sightings(batch)).drop("_new").persist()
            update_state(spark, state_path, firsts, number)
            firsts.unpersist()
            return
        batch = batch.persist()
        try:
            state = update_state(spark, state_path, patient_sightings(batch), number)
            on_rows(attribute_patient(observations(batch), state.intervals), number)
        finally:
            batch.unpersist()

    writer = messages.writeStream.foreachBatch(advance).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_first_sightings(sightings: DataFrame) -> DataFrame:
    """First sighting of each patient per bed as a running aggregate.

    Its rows are the input of ``patient_intervals``; a late earlier sighting updates its row. Equal times are
    told apart as in a batch, by file, message and sighting.
    """
    rest = [c for c in PERSON if c != "pid"]
    order = [c for c in ORDER if c in sightings.columns]
    first = F.min(F.struct("start_ns", *order, *rest)).alias("f")
    return sightings.groupBy(*BED, "pid").agg(first).select(
        *BED, "pid", *[F.col(f"f.{c}").alias(c) for c in (*rest, "start_ns", *order)]
    )


def stream_dedup(
    rows: DataFrame, keys: list[str] | None = None, time: str = "msh_time", delay: str = "1 hour"
) -> DataFrame:
    """Drop repeated rows that arrive within a delay of each other; values are not compared."""
    keys = keys or [c for c in rows.columns if c not in VALUE_COLUMNS]
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def stream_quality(
    messages: DataFrame, window: str = "1 minute", delay: str | None = "10 minutes",
    check_start_times: bool = False,
) -> DataFrame:
    """Messages per time window and quality code.

    With a ``delay`` windows are closed by a watermark. A watermark knows no rows without a time, so these are
    left to ``stream_untimed_quality``. Without a ``delay`` they are counted here, in a window that is NULL.
    """
    codes = quality_codes(verify_messages(messages, check_start_times)).withColumn(
        "msh_time", F.timestamp_micros(F.call_function("div", F.col("msh_time_ns"), F.lit(1000)))
    )
    if delay is not None:
        codes = codes.withWatermark("msh_time", delay)
        counts = codes.groupBy(F.window("msh_time", window).alias("w"), "code")
        start = F.col("w.start")
    else:
        counts = codes.groupBy(window_start(F.col("msh_time"), window).alias("w"), "code")
        start = F.col("w")
    return counts.agg(F.count(F.lit(1)).alias("messages")).select(start.alias("window_start"), "code", "messages")


def window_start(time: Column, width: str) -> Column:
    """Start of the window of a time, as ``window`` has it, but NULL for NULL."""
    micros = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00' + interval {width})")
    at = F.unix_micros(time)
    return F.timestamp_micros(at - F.pmod(at, micros))


def stream_untimed_quality(messages: DataFrame, check_start_times: bool = False) -> DataFrame:
    """Messages without a time per quality code; the state has one row for each code."""
    untimed = messages.where(F.col("msh_time_ns").isNull())
    codes = quality_codes(verify_messages(untimed, check_start_times))
    return codes.groupBy("code").agg(F.count(F.lit(1)).alias("messages"))


def stream_json(messages: DataFrame) -> DataFrame:
    """Messages as key and JSON value, the shape of a message bus."""
    rows = to_json_rows(messages)
    return rows.select(F.col("control_id").alias("key"), F.col("json").alias("value"))
