"""Streams with state by event time, against what a batch or plain Python gives for the same rows."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bedfeed.operators.patients import BED, PERSON, patient_intervals
from bedfeed.plans import stream_queries
from bedfeed.streaming import event_time

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = (
    "hospital string, bed_unit string, bed_id string, pid string, visit_id string, first_name string, last_name string, "
    "middle_initial string, start_ns bigint, end_ns bigint, seg_id string, msg_idx bigint, sighting_idx int"
)
HOUR = 3600 * 10**9


def written(spark, batches, schema, path):
    """One file per batch, read one by one."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def sighting(bed, pid, start, n):
    return ("H", None if bed == 3 else "U", f"B{bed}", pid, f"v{n}", f"f{n}", f"l{n % 2}", "", start, None, f"s{n % 5}", n, n % 2)


@pytest.mark.parametrize("seed", [1, 2])
def test_intervals_are_corrected(spark, tmp_path, seed):
    random.seed(seed)
    rows = [
        sighting(random.randrange(4), random.choice(["", "p", "q", "r", "s", "t", None]), random.choice([None, *range(0, 40)]), n)
        for n in range(150)
    ]
    rows = [r[:8] + (None if r[8] is None else r[8] * 7 * HOUR - 30 * HOUR + 1_700_000_000_000_000_001,) + r[9:] for r in rows]
    batches = [rows[:40], rows[40:60], rows[60:110], rows[110:]]
    stream = written(spark, batches, SCHEMA, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    event_time.write_bed_intervals(event_time.stream_bed_intervals(stream), out, str(tmp_path / "c"), available_now=True).awaitTermination()
    columns = [*BED, *PERSON, "start_ns", "end_ns"]
    for upto in range(len(batches)):
        so_far = spark.createDataFrame([r for b in batches[: upto + 1] for r in b], SCHEMA).withColumn("pid", F.coalesce("pid", F.lit("")))
        expected = patient_intervals(so_far).select(columns)
        found = event_time.read_bed_intervals(spark, out, upto).select(columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_a_late_sighting_changes_its_neighbours_only(spark, tmp_path):
    first = [sighting(0, f"p{k}", k * 30 * HOUR, k) for k in range(6)] + [sighting(1, "x", 0, 0)]
    late = [sighting(0, "late", 95 * HOUR, 9), sighting(0, "p5", 200 * HOUR, 10), sighting(0, "p4", 10 * HOUR, 11)]
    stream = written(spark, [first, late], SCHEMA, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    query = event_time.write_bed_intervals(event_time.stream_bed_intervals(stream), out, str(tmp_path / "c"), available_now=True)
    query.awaitTermination()
    changed = spark.read.parquet(f"{out}/v=1").select("pid", "start_ns", "end_ns").collect()
    hours = {r.pid: (r.start_ns // HOUR, r.end_ns // HOUR if r.end_ns is not None else None) for r in changed}
    assert hours == {"late": (95, 150), "p4": (10, 30), "p3": (90, 95), "p0": (0, 10)}
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] >= 8


def test_windows_close_once(spark, tmp_path):
    minute = 60_000
    batches = [
        [(0, "a"), (30_000, "a"), (70_000, "b"), (None, "a")], [(10 * minute, "a"), (65_000, "b"), (None, "a"), (None, "b")],
        [(20_000, "a"), (61_000, "b"), (9 * minute, "a"), (30 * minute, "b")], [(5, "a"), (31 * minute, "b")],
    ]
    schema = "ms bigint, code string"
    stream = written(spark, batches, schema, str(tmp_path / "in"))
    rows = stream.withColumn("t", F.timestamp_millis("ms")).withWatermark("t", "1 minute").select(
        (F.col("ms") - F.pmod("ms", F.lit(minute))).alias("window_ms"), "code", F.lit(1).cast("bigint").alias("messages")
    )
    out = event_time.closed_windows(rows, minute)
    with event_time.rocksdb(spark):
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(
            availableNow=True
        ).start().awaitTermination()
    found = spark.read.schema(event_time.WINDOW_COUNT).parquet(str(tmp_path / "out")).groupBy("window_ms", "code", "status").agg(F.sum("messages"), F.count("*"))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in found.collect()}
    assert got == {
        (None, "a", "untimed"): (2, 2), (None, "b", "untimed"): (1, 1), (0, "a", "closed"): (2, 1), (minute, "b", "closed"): (2, 1),
        (0, "a", "late"): (2, 2), (minute, "b", "late"): (1, 1), (9 * minute, "a", "closed"): (1, 1), (10 * minute, "a", "closed"): (1, 1),
    }
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != event_time.ROCKSDB


def test_batches_of_several_files_and_tasks(spark, monkeypatch):
    """Batches arrive in their order whatever the number of their files, and large ones are spread over more tasks."""
    monkeypatch.setattr(stream_queries, "FILE_ROWS", 50)
    monkeypatch.setattr(stream_queries, "TASK_ROWS", 20)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    arriving = stream_queries.in_batches(spark, events, F.col("event_id") % 3, 3)
    got = []

    def keep(batch, number):
        rows = batch.select("event_id").collect()
        got.append((number, {r[0] % 3 for r in rows}, len(rows), batch.rdd.getNumPartitions()))

    arriving.writeStream.foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
    assert [(number, which) for number, which, _, _ in got] == [(0, {0}), (1, {1}), (2, {2})]
    assert sum(rows for _, _, rows, _ in got) == events.count()
    assert all(tasks == -(-max(rows for _, _, rows, _ in got) // 20) for _, _, _, tasks in got)


def test_first_sightings_of_a_task_are_gathered_over_blocks(monkeypatch):
    def block(*rows):
        columns = ["hospital", "bed_unit", "bed_id", "pid", "start_ns", "seg_id", "msg_idx", "sighting_idx"]
        names = ["visit_id", "first_name", "last_name", "middle_initial"]
        return pd.DataFrame([("H", "U", "B", p, t, None, 0, 0, "", "", "", "") for p, t in rows], columns=columns + names)

    blocks = [block(("P", 5), ("Q", 7)), block(("P", 3)), block(("Q", 9), ("R", 1))]
    (firsts,) = event_time._earliest(iter(blocks))
    assert sorted(zip(firsts["pid"], firsts["start_ns"])) == [("P", 3), ("Q", 7), ("R", 1)]
    monkeypatch.setattr(event_time, "MAX_FIRSTS", 1)
    assert sum(map(len, event_time._earliest(iter(blocks)))) == 5
