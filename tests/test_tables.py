"""Sinks, sources, duplicates, records and streams on small files."""

import json

import pytest
from samples import ADT, WAVE
from pyspark.sql import functions as F

from bedfeed.operators import observations, waveform
from bedfeed.operators.location import bed_inventory, bed_mapping
from bedfeed.operators.pipeline import read_messages, read_observations
from bedfeed.sinks import records, tables as sink
from bedfeed.sources import feed, tables as source
from bedfeed.sources.state import load_state
from bedfeed.streaming import feeds


def rows(spark, items):
    """Items are (bed, channel, values)."""
    return spark.createDataFrame(
        [("H", "", bed, channel, values, 10**9 * i, 4.0) for i, (bed, channel, values) in enumerate(items)],
        "hospital string, bed_unit string, bed_id string, channel string, values_num array<double>, "
        "start_t_ns bigint, pd_samp_ms double",
    )


def test_append_and_load(spark, tmp_path):
    path = str(tmp_path / "t")
    one = rows(spark, [("007", "I", [1.0]), ("A B", "II", [2.0])])
    sink.write_by_bed(one, path)
    sink.write_by_bed(one, path)
    assert source.read_beds(spark, path).count() == 4
    assert source.load_beds(spark, path).count() == 2
    bed = source.load_bed(spark, path, "H", "", "007").collect()
    assert [(r["bed_id"], r["bed_unit"]) for r in bed] == [("007", "")] * 2
    assert [r["bed_id"] for r in source.load_beds(spark, path, 1, 5).collect()] == ["A B"]
    got = one.select(sink.bed_slug(F.col("hospital"), F.lit("a-b c"), F.col("bed_id"))).collect()
    assert got[1][0] == "BED_H-a_b_c-A_B"


def test_single_bed_file(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    rows(spark, [("1", "I", [1.0]), ("1", "II", [1.0])]).write.parquet(good)
    rows(spark, [("1", "I", [1.0]), ("2", "II", [1.0])]).write.parquet(bad)
    key, table = source.load_bed_file(spark, good)
    assert key == ("H", "", "1") and table.count() == 2
    with pytest.raises(ValueError):
        source.load_bed_file(spark, bad)
    spark.range(1).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError):
        source.load_bed_file(spark, str(tmp_path / "other"))


def test_slice_bounds():
    assert source.slice_bounds(10, -3, None) == (0, 10)
    assert source.slice_bounds(10, 20, 3) == (9, 10)
    assert source.slice_bounds(10, 4, 2) == (4, 6)
    assert source.slice_bounds(10, 4, -1) == (4, 10)


def test_file_numbers(spark):
    paths = ["/x/a-12.parquet", "/x/batch_id=3/p.parquet", "/x/part-00000-0c1f-c000.snappy.parquet"]
    found = spark.createDataFrame([(p,) for p in paths], "p string").select(source.file_number(F.col("p")).alias("n"))
    assert [r["n"] for r in found.collect()] == [12, 3, None]


def test_first_rows_stay_whatever_their_values(spark, tmp_path):
    path = str(tmp_path / "batches")
    for n, value in enumerate((9.0, 1.0, 5.0)):
        sink.write_batch(rows(spark, [("1", "I", [value])]), path, n)
    assert [r["values_num"] for r in source.load_batches(spark, path).collect()] == [[9.0]]
    assert [r["values_num"] for r in source.load_batches(spark, path, 1).collect()] == [[1.0]]
    assert [r["values_num"] for r in source.load_batches(spark, path, 2, 5).collect()] == [[5.0]]
    plain = str(tmp_path / "plain")
    sink.write_observations(rows(spark, [("1", "I", [9.0]), ("2", "I", [2.0])]), plain)
    assert source.load_batches(spark, plain).count() == 2
    beds = str(tmp_path / "beds")
    for value in (9.0, 1.0):
        sink.write_by_bed(rows(spark, [("1", "I", [value]), ("2", "I", [value])]), beds)
    loaded = source.load_beds(spark, beds, 1, 1)
    assert [(r["bed_id"], r["values_num"]) for r in loaded.collect()] == [("2", [9.0])]
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan


def test_dedup_keeps_first(spark):
    base = [("1", "I", [5.0], 1), ("1", "I", [3.0], 0), ("1", "I", None, 2), ("2", "I", [1.0], 3)]
    df = spark.createDataFrame(base, "bed_id string, channel string, values_num array<double>, n int")
    kept = observations.dedup_observations(df, order=["n"]).orderBy("bed_id").collect()
    assert [(r["bed_id"], r["values_num"], r["n"]) for r in kept] == [("1", [3.0], 0), ("2", [1.0], 3)]


def test_ranges_skip_missing(spark):
    nan = float("nan")
    data = rows(spark, [("1", "I", [nan, 2.0, None]), ("1", "I", [-1.0]), ("1", "J", [nan])])
    got = {r["channel"]: tuple(r)[1:] for r in waveform.channel_range(data, ["channel"]).collect()}
    assert got == {"I": (-1.0, 2.0, 3 - 1), "J": (None, None, 0)}


def test_export_records(spark, tmp_path):
    data = rows(spark, [("1", "I", [-1.0, 1.0]), ("1", "I", [0.0]), ("1", "J", [7.0])]).withColumn("segment", F.lit("s"))
    records.export_records(data.withColumn("UoM", F.lit("")), str(tmp_path), ["segment"], prefix=F.lit("rec"))
    headers = {r["channel"]: r for r in spark.read.parquet(f"{tmp_path}/headers").collect()}
    assert headers["I"]["record_name"] == "rec_0" and headers["I"]["n_sig"] == 2
    assert headers["I"]["fs"] == 250.0 and headers["I"]["units"] == "mV"
    samples = spark.read.parquet(f"{tmp_path}/samples").collect()
    digital = sorted(v for r in samples if r["channel"] == "I" for v in r["digital"])
    gain, base = headers["I"]["adc_gain"], headers["I"]["baseline"]
    assert digital == [-32767, base, round(gain + base)]


def test_mixed_rates(spark):
    data = rows(spark, [("1", "I", [1.0]), ("1", "I", [2.0]), ("1", "J", [3.0])])
    data = data.withColumns({"UoM": F.lit(""), "pd_samp_ms": F.when(F.col("start_t_ns") == 0, 2.0).otherwise(4.0)})
    headers = {r["channel"]: r for r in waveform.record_headers(data, ["bed_id"]).collect()}
    assert (headers["I"]["fs"], headers["I"]["rate_error"]) == (None, "MIXED_RATE")
    assert (headers["J"]["fs"], headers["J"]["rate_error"]) == (250.0, None)


@pytest.fixture
def folder(tmp_path):
    """Two feeds files deep below bed folders, one at the top, and one of another kind."""
    deep = tmp_path / "feed" / "P" / "HOSP" / "U 1" / "B+2" / "src" / "2025" / "02" / "28" / "15"
    deep.mkdir(parents=True)
    (deep / "part-12.hl7").write_text(WAVE.replace("\n", "\r\n") + "\r\n\r\n" + ADT.replace("\r", "\n") + "\n\n")
    (deep / "part-3.hl7").write_text(WAVE.replace("C1", "C2"))
    (deep / "part-1.txt").write_text("no")
    (tmp_path / "feed" / "part-4.hl7").write_text(WAVE.replace("C1", "C3") + "\n\nPID|bad")
    return str(tmp_path / "feed")


def test_scan(spark, folder):
    files = feed.ordered_files(feed.scan_feed(spark, folder)).collect()
    assert [(r["bed_key"], r["seg_id"], r["dir"], r["file"]) for r in files] == [
        ("HOSP_U 1_B+2", 3, "15", "part-3.hl7"),
        ("HOSP_U 1_B+2", 12, "15", "part-12.hl7"),
        ("all_beds", 4, "feed", "part-4.hl7"),
    ]
    counts = {r["bed_key"]: r["files"] for r in feed.file_counts(feed.scan_feed(spark, folder)).collect()}
    assert counts == {"HOSP_U 1_B+2": 2, "all_beds": 1}
    by_message = feed.message_rows(feed.scan_feed(spark, folder, separator="\n\n"))
    assert by_message.where("seg_id = 4").count() == 2


def test_read_observations(spark, site, folder, tmp_path):
    tables = read_observations(spark, folder, site, str(tmp_path / "state"))
    got = tables["observations"].orderBy("control_id").collect()
    assert [(r["control_id"], r["file"], r["seg_id"], r["pid"]) for r in got] == [
        ("C1", "part-12.hl7", 12, "R7701"), ("C2", "part-3.hl7", 3, "R7701"), ("C3", "part-4.hl7", 4, "R7701"),
    ]
    assert [r["error_code"] for r in tables["quarantine"].collect()] == ["NOT_MSH_FIRST"]
    assert tables["sightings"].count() == 4
    assert {r["pid"] for r in load_state(spark, str(tmp_path / "state")).history.collect()} == {"R7701", ""}
    messages = read_messages(spark, folder, site).where("error_code is null")
    beds = {(r["hospital"], r["bed_unit"]): (r["beds"], r["is_cart"]) for r in bed_inventory(messages).collect()}
    assert beds == {("NORTH", "7K WEST ICU"): (1, False), ("NORTH", "5G ICU"): (1, False)}
    assert [r["bed_id"] for r in bed_mapping(messages).collect()] == ["G505-01", "K718-01"]


def test_streams(spark, site, folder, tmp_path):
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    messages = feeds.stream_messages(spark, folder, site, files_per_trigger=1)
    numbers = []
    feeds.stream_patient_state(
        messages, state, str(tmp_path / "c1"), lambda batch, n: numbers.append((n, batch.count())), available_now=True
    ).awaitTermination()
    assert sorted(numbers) == [(0, numbers[0][1]), (1, numbers[1][1]), (2, numbers[2][1])]
    assert sum(n for _, n in numbers) == 3
    assert load_state(spark, state).version == 2
    feeds.write_observation_stream(
        feeds.stream_observations(messages), out, str(tmp_path / "c2"), available_now=True
    ).awaitTermination()
    assert source.read_beds(spark, out).count() == 3
    query = (
        feeds.stream_json(messages).writeStream.format("parquet").option("path", str(tmp_path / "j"))
        .option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    values = {r["key"]: json.loads(r["value"]) for r in spark.read.parquet(str(tmp_path / "j")).collect()}
    assert set(values) == {"C1", "C2", "C3", "A1"}


def test_frames_of_ragged_channels(spark):
    import random

    random.seed(9)
    rates = {"a": 250.0, "b": 125.0, "c": 62.5, "d": None}
    rows = []
    for rec in range(2):
        for ch, rate in rates.items():
            for n in range(12):
                start = random.randrange(0, 3_000) * 4_000_000 + 1_700_000_000_000_000_000
                values = [random.choice([None, float("nan"), float(random.randint(-50, 50))]) for _ in range(random.choice([0, 1, 7, 300]))]
                rows.append((rec, ch, None if n == 11 else start, 1000.0 / rate if rate else None, values))
    rows += rows[:6]
    schema = "rec int, channel string, start_t_ns long, pd_samp_ms double, values_num array<double>"
    data = spark.createDataFrame(rows, schema).withColumns({"UoM": F.lit(""), "block": F.lit(7), "at": F.lit(7)})
    headers = waveform.record_headers(data, ["rec"]).withColumns({"adc_gain": F.lit(1.0), "baseline": F.lit(0).cast("long")})
    expected, bases, seen = {}, {}, set()
    for rec in range(2):
        bases[rec] = min(r[2] for r in rows if r[0] == rec and r[2] is not None)
    for i, (rec, ch, start, _, values) in sorted(enumerate(rows), key=lambda x: (x[1][2] or 0, x[0])):
        if start is not None and rates[ch]:
            at = round((start - bases[rec]) * rates[ch] / 1e9)
            for j, v in enumerate(values):
                expected.setdefault((rec, ch, at + j), -32768 if v is None or v != v else int(v))
                seen.add((rec, (at + j) // (16 * int(rates[ch] / 62.5))))
    out = waveform.record_frames(data, headers, ["rec"], block_frames=16).collect()
    assert {(r.rec, r.block) for r in out} == seen and len(out) == 3 * len(seen)
    for r in out:
        size = 16 * r.samples_per_frame
        assert r.frame_rate == 62.5 and r.samples_per_frame == rates[r.channel] / 62.5 and r.first_frame == 16 * r.block
        assert r.digital == [expected.get((r.rec, r.channel, r.block * size + k), -32768) for k in range(size)]
    assert waveform.record_frames(data.limit(0), headers, ["rec"]).collect() == []


def test_duplicates_are_looked_for_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    """Files are small next to their rows, so the tasks that look for duplicates go by rows."""
    path, n = str(tmp_path / "t"), F.col("id")
    rows = spark.range(400).select(
        F.lit("H").alias("hospital"), (n % 100).cast("string").alias("control_id"), F.array(n.cast("double")).alias("values_num"), n.alias("row_idx")
    )
    sink.write_observations(rows.coalesce(1), path)
    before = sorted(tuple(r["values_num"]) for r in source.load_batches(spark, path).collect())
    tasks = []
    dedup = source.dedup_observations
    monkeypatch.setattr(source, "DEDUP_ROWS", 10)
    monkeypatch.setattr(source, "dedup_observations", lambda rows, order: tasks.append(rows.rdd.getNumPartitions()) or dedup(rows, order))
    assert sorted(tuple(r["values_num"]) for r in source.load_batches(spark, path).collect()) == before == [(float(i),) for i in range(100)]
    assert tasks == [40]
    beds = str(tmp_path / "b")
    sink.write_by_bed(rows, beds)
    assert source.load_beds(spark, beds).count() == 100
