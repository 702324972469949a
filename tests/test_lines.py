"""Messages read by lines, against files read whole."""

import random

import pytest

from bedfeed.operators.pipeline import read_messages
from bedfeed.plans import feed_queries
from bedfeed.plans.base import QUERIES
from bedfeed.session import spread
from bedfeed.sources import lines
from bedfeed.sources.feed import scan_feed, split_messages
from bedfeed.sources.lines import line_messages

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["path", "bed_key", "dir", "file", "seg_id", "msg_idx", "message"]


def whole(spark, root):
    rows = split_messages(scan_feed(spark, root)).select(*NAMES).collect()
    trimmed = [(*r[:-1], r["message"].strip("\n")) for r in rows]
    return sorted(r for r in trimmed if r[-1])


@pytest.fixture()
def block_size(spark, monkeypatch):
    """Sets the size of the blocks of feed files; the tables made of them are read in the usual ones."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    stored = lines.stored_rows

    def stored_and_reset(rows):
        out = stored(rows)
        spark.conf.set(name, before)
        return out

    monkeypatch.setattr(lines, "stored_rows", stored_and_reset)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


def feed_folder(folder, texts):
    for i, text in enumerate(texts):
        (folder / f"feed-{i}.hl7").write_bytes(text.encode())
    return str(folder)


@pytest.mark.parametrize("size", [7, 60])
def test_any_line_ends_and_block_sizes(spark, tmp_path, block_size, size):
    draw = random.Random(size)
    texts = []
    for _ in range(8):
        line_end = draw.choice([["\n"], ["\r\n"], ["\r"], ["\n", "\r\n", "\r"]])
        pieces = []
        for _ in range(draw.randint(0, 40)):
            pieces.append(draw.choice(["", "", "a", "bcd é", " ", "PID|1|" + "x" * draw.randint(0, 30)]) + draw.choice(line_end))
        texts.append("".join(pieces) + draw.choice(["", "end"]))
    root = feed_folder(tmp_path, texts)
    expected = whole(spark, root)
    block_size(size)
    got = line_messages(spark, root)
    assert got.columns == NAMES
    assert sorted(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("text", [
    "", "\n", "\n\n\n", "a", "\n\na", "\n\n\na\n\n\n\nb", "\r\r\r\na\r\r", "a\n" * 50 + "\n" * 41 + "b", "\n" * 40 + "b\n" * 30,
    "MSH|1\rPID|2\r\r\n\rMSH|2\r\n\r\n\r\n\r\nMSH|3",
])
def test_runs_of_empty_lines_over_blocks(spark, tmp_path, block_size, text):
    root = feed_folder(tmp_path, [text, text + "\n\nZ"])
    expected = whole(spark, root)
    block_size(9)
    assert sorted(map(tuple, line_messages(spark, root).collect())) == expected


def test_a_message_over_many_blocks_is_one_row(spark, tmp_path, block_size):
    long = "\n".join(f"OBX|{i}|NM" for i in range(500))
    root = feed_folder(tmp_path, [f"MSH|1\n\n{long}\r\n\r\nMSH|3\n"])
    block_size(100)
    got = {r["msg_idx"]: r["message"] for r in line_messages(spark, root).collect()}
    assert got == {0: "MSH|1", 1: long, 2: "MSH|3"}


def test_read_messages_by_lines(spark, site, tmp_path):
    text = "MSH|^~\\&|MON||||20310907081510-0400||ORU^R01|C9|P|2.5\rPID|||P9||L^F\rPV1||I|NORTH-4TN-K718\r"
    root = feed_folder(tmp_path, [text + "\r" + text.replace("\r", "\r\n") + "\r\n" + text.replace("\r", "\n")])
    columns = ["msg_idx", "pid", "hospital", "bed_unit", "bed_id", "error_code"]
    by_lines = read_messages(spark, root, site, by_lines=True).select(*columns).collect()
    assert len(by_lines) == 3
    assert sorted(by_lines) == sorted(read_messages(spark, root, site).select(*columns).collect())


def test_large_files_are_no_rows(spark, tmp_path, monkeypatch):
    """The feed queries hold no row as large as a file, and a larger feed means more tasks."""
    seen = []
    written = feed_queries.scratch_dir
    monkeypatch.setattr(feed_queries.feed, "scan_feed", lambda *args: pytest.fail("a file is read whole"))
    monkeypatch.setattr(feed_queries, "FILE_EVENTS", 300)
    monkeypatch.setattr(feed_queries, "scratch_dir", lambda s: seen.append(written(s)) or seen[-1])
    rows = feed_queries.ingested_files(spark, SF_DIR).collect()
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    assert sum(r["messages"] for r in rows) == events.where("event_type in ('view', 'click', 'error')").count()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(seen[0]).select("path", "length")
    assert files.count() > len(rows)


def test_tables_are_spread_by_rows(spark):
    table = spark.range(1000)
    assert spread(table, "id", rows=10).rdd.getNumPartitions() == 100
    assert spread(spark.range(0, 1000, 1, 50), "id", rows=10_000).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(table, "id", rows=10).agg({"id": "sum"}).first()[0] == 499_500


@pytest.mark.parametrize("name", ["quality_by_message", "sightings", "signal_delays", "field_lines"])
def test_messages_are_worked_on_in_tasks_of_bounded_rows(spark, monkeypatch, name):
    """A longer table of events means more tasks, and the work on a message comes after the rows are dealt out."""
    monkeypatch.setattr(feed_queries, "spread", lambda df, *keys: spread(df, *keys, rows=50))
    tasks = -(-spark.read.parquet(f"{SF_DIR}/events.parquet").count() // 50)
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().sparkPlan().toString()
    above, below = plan.split("REPARTITION_BY_NUM")
    assert above.rstrip(" ,").endswith(f", {tasks})")
    assert "split(" in above and "split(" not in below
