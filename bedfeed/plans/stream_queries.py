"""Streaming queries: each runs until its input is used up and returns what it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bedfeed.operators import patients
from bedfeed.operators.pipeline import located_messages
from bedfeed.plans import feed_queries, synth, table_queries
from bedfeed.plans.base import ORACLES, query
from bedfeed.plans.synth import table
from bedfeed.session import TASK_ROWS, scratch_dir, tasks_for
from bedfeed.sources.state import load_state
from bedfeed.sources.tables import read_beds
from bedfeed.streaming import event_time, feeds


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    arriving = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return arriving.repartition(tasks_for(events), "event_id")


def appended(stream: DataFrame) -> DataFrame:
    """Run an append stream to its end into a scratch table."""
    spark = stream.sparkSession
    path, checkpoint = scratch_dir(spark), scratch_dir(spark)
    (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(path)


def completed(stream: DataFrame) -> DataFrame:
    """Run an aggregate stream to its end; the last batch replaces the scratch table."""
    spark = stream.sparkSession
    path = scratch_dir(spark)

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    (
        stream.writeStream.foreachBatch(replace)
        .outputMode("complete")
        .option("checkpointLocation", scratch_dir(spark))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(path)


def stream_located(
    spark: SparkSession, sf_dir: str, texts: Callable[[DataFrame], DataFrame] = synth.messages_from_events
) -> DataFrame:
    return located_messages(texts(event_stream(spark, sf_dir)), synth.site_tables(spark, sf_dir))


@query(ORACLES["waveform_rows"])
def stream_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waveform rows written by a stream."""
    rows = feeds.stream_observations(stream_located(spark, sf_dir))
    total = F.aggregate("values_num", F.lit(0.0), lambda a, v: a + v)
    waves = rows.where(F.col("msg_type") == "MDC_OBS_WAVE_CTS").select(
        "control_id", "hospital", "bed_unit", "bed_id", "channel", "channel_type", "start_t_ns", "end_t_ns",
        total.alias("total"), "value_type", F.col("UoM").alias("uom"), "pd_samp_ms", "nsamp",
    )
    return appended(waves)


@query(ORACLES["rows_per_unit"])
def stream_all_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all kinds written by the stream's own sink, summed up after it."""
    path = scratch_dir(spark)
    feeds.write_observation_stream(
        feeds.stream_observations(stream_located(spark, sf_dir)), path, scratch_dir(spark), available_now=True
    ).awaitTermination()
    return feed_queries.unit_totals(read_beds(spark, path))


@query(ORACLES["json_rows"])
def stream_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON values written by a stream."""
    written = appended(feeds.stream_json(stream_located(spark, sf_dir)))
    return written.select(F.col("key").alias("control_id"), F.col("value").alias("json"))


@query(
    "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1"
)
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events sent twice, the copies dropped by a stream."""
    events = event_stream(spark, sf_dir).withColumn("msh_time", F.col("ts").cast("timestamp"))
    copies = events.select("*", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("index"))
    kept = feeds.stream_dedup(copies, ["event_id", "event_type", "msh_time"], delay="40 days")
    written = appended(kept.select("event_type", "value"))
    return written.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query(
    f"""{feed_queries._codes_sql(feed_queries._QUALITY_RULES)}
    SELECT CASE WHEN event_id % 13 <> 0 THEN CAST(epoch_us(date_trunc('hour', ts)) AS BIGINT) END AS window_start_us,
      code, count(*) AS messages
    FROM codes GROUP BY ALL"""
)
def stream_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per hour and quality code, counted by a stream; those without time are counted without an hour."""
    counts = feeds.stream_quality(
        stream_located(spark, sf_dir, synth.doubtful_messages), window="1 hour", delay=None
    )
    return completed(counts).select(
        F.unix_micros("window_start").alias("window_start_us"), "code", "messages"
    )


@query(ORACLES["patient_intervals"])
def stream_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient intervals from first sightings kept by a stream."""
    seen = table_queries.sightings_of(event_stream(spark, sf_dir))
    firsts = completed(feeds.stream_first_sightings(seen))
    return patients.patient_intervals(firsts).select("bed_id", "pid", "start_ns", "end_ns")


def _state_sql(batches: int) -> str:
    """First sightings of every batch and of the patient each bed had at its end, who is carried into the next."""
    keys = "hospital, bed_unit, bed_id, pid"
    out = f"""WITH {feed_queries.EVENTS_SQL},
    s AS (SELECT hospital, bed_unit, bed_id, 'P' || user_id AS pid, ns, event_id % {batches} AS b FROM e
      UNION ALL SELECT hospital, bed_unit, bed_id, 'M' || user_id, ns, event_id % {batches} FROM e WHERE event_type = 'click')"""
    for b in range(batches):
        carried = f" UNION ALL SELECT {keys}, start_ns FROM c{b - 1}" if b else ""
        out += f""", f{b} AS (SELECT {keys}, min(ns) AS start_ns FROM (SELECT {keys}, ns FROM s WHERE b = {b}{carried}) GROUP BY ALL),
    c{b} AS (SELECT * FROM f{b} QUALIFY row_number() OVER (PARTITION BY hospital, bed_unit, bed_id ORDER BY start_ns DESC, pid DESC) = 1)"""
    return out + " " + " UNION ".join(f"SELECT * FROM f{b}" for b in range(batches))


@query(_state_sql(3))
def stream_patient_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient state advanced by a stream of messages in three batches: the history it leaves."""
    events, path = table(spark, sf_dir, "events"), scratch_dir(spark)
    arriving = in_batches(spark, events, F.col("event_id") % 3, 3)
    messages = located_messages(synth.messages_from_events(arriving), synth.site_tables(spark, sf_dir))
    feeds.stream_patient_state(messages, path, scratch_dir(spark), available_now=True).awaitTermination()
    return load_state(spark, path).history.select("hospital", "bed_unit", "bed_id", "pid", "start_ns").distinct()


# Rows of a batch for each of its files.
FILE_ROWS = 500_000


def in_batches(spark: SparkSession, events: DataFrame, number: Column, batches: int) -> DataFrame:
    """The events as a stream of batches, which are read in the order of their numbers and spread over tasks by rows.

    All batches have the same number of files, by which the stream takes them: one, or more if the smallest is large."""
    path = scratch_dir(spark)
    sizes = dict(events.groupBy(number.cast("bigint")).count().collect())
    files = max(1, min(sizes.get(batch, 0) for batch in range(batches)) // FILE_ROWS)
    for batch in range(batches):
        events.where(number == batch).repartition(files, "event_id").write.mode("append").parquet(path)
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return arriving.repartition(max(cores, -(-max(sizes.values(), default=0) // TASK_ROWS)), "event_id")


@query(
    f"""WITH {table_queries._SEEN_SQL}, f AS (SELECT bed_id, pid, min(ns) AS start_ns FROM s GROUP BY ALL)
    SELECT bed_id, pid, 'V' || pid[2:] AS visit_id, 'F' || pid[2:] AS first_name, 'L' || pid[2:] AS last_name, start_ns,
      lead(start_ns) OVER (PARTITION BY bed_id ORDER BY start_ns) AS end_ns FROM f"""
)
def stream_corrected_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient intervals kept by a stream whose batches are out of order in time, so that starts and ends are corrected."""
    events, path = table(spark, sf_dir, "events"), scratch_dir(spark)
    arriving = in_batches(spark, events, F.col("event_id") * 7 % 4, 4)
    changes = event_time.stream_bed_intervals(table_queries.sightings_of(arriving))
    event_time.write_bed_intervals(changes, path, scratch_dir(spark), available_now=True).awaitTermination()
    return event_time.read_bed_intervals(spark, path).select(
        "bed_id", "pid", "visit_id", "first_name", "last_name", "start_ns", "end_ns"
    )


# Batches follow each other in time, but every tenth event is held back for two batches.
_HELD_BACK = "least(3, epoch_ms(ts) // 432000000 % 4 + CASE WHEN event_id % 10 = 0 THEN 2 ELSE 0 END)"


@query(
    f"""{feed_queries._codes_sql(feed_queries._QUALITY_RULES)},
    c AS (SELECT code, CASE WHEN event_id % 13 <> 0 THEN epoch_ms(ts) END AS ms, {_HELD_BACK} AS b FROM codes),
    marks AS (SELECT b, coalesce(max(max(ms)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3600000, 0) AS mark,
      max(max(ms)) OVER () - 3600000 AS last_mark FROM c GROUP BY b),
    w AS (SELECT ms - ms % 21600000 AS window_ms, code, mark, last_mark FROM c JOIN marks USING (b))
    SELECT window_ms, code, CASE WHEN window_ms IS NULL THEN 'untimed' WHEN window_ms + 21600000 <= mark THEN 'late' ELSE 'closed' END AS status,
      count(*) AS messages
    FROM w WHERE window_ms IS NULL OR window_ms + 21600000 <= last_mark GROUP BY ALL"""
)
def stream_closed_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per six hours and quality code in four batches: windows closed by a watermark, late and untimed messages."""
    events = table(spark, sf_dir, "events")
    held = F.when(F.col("event_id") % 10 == 0, 2).otherwise(0)
    number = F.least(F.lit(3), F.call_function("div", F.unix_millis(F.col("ts").cast("timestamp")), F.lit(432_000_000)) % 4 + held)
    messages = located_messages(
        synth.doubtful_messages(in_batches(spark, events, number, 4)), synth.site_tables(spark, sf_dir)
    )
    counts = event_time.stream_closed_quality(messages, 6 * 3_600_000, "1 hour")
    with event_time.rocksdb(spark):
        written = appended(counts)
    return written.groupBy("window_ms", "code", "status").agg(F.sum("messages").alias("messages"))
