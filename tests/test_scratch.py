"""What queries leave on disk: scratch folders and shuffle files."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from samples import WAVE

from bedfeed.operators.pipeline import read_observations
from bedfeed.plans import feed_queries
from bedfeed.session import passing_scratch, scratch_dir, stored_rows


@pytest.fixture
def made(spark):
    """The scratch folders with data that are made in a test."""
    base = Path(spark.conf.get("spark.checkpoint.dir").split(":")[-1])
    before = set(base.rglob("*"))
    return lambda: sorted({p.relative_to(base).parts[0] for p in set(base.rglob("*")) - before if p.is_file()})


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles())
    return {f.getName() for f in files if f.getName().startswith("shuffle_")}


def test_stored_rows_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = stored_rows(spark.range(10_000).repartition(5, "id"))
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert rows.agg(F.count("id"), F.sum("id")).first()[:] == (10_000, 49_995_000)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")


def test_passing_scratch(spark, made):
    outer = scratch_dir(spark)
    with passing_scratch(spark):
        kept = scratch_dir(spark)
        with passing_scratch(spark):
            stored_rows(spark.range(3)).write.parquet(kept)
            spark.range(5).write.parquet(outer)
        assert spark.read.parquet(kept).count() == 3
        assert made() == sorted(Path(p).name for p in (kept, outer))
    with pytest.raises(ValueError), passing_scratch(spark):
        stored_rows(spark.range(3))
        raise ValueError
    assert made() == [Path(outer).name]


def test_runs_of_lines_go_once_they_are_parsed(spark, site, tmp_path, made):
    (tmp_path / "part-1.hl7").write_text(WAVE + "\n\n" + WAVE.replace("C1", "C2"))
    tables = read_observations(spark, str(tmp_path), site, by_lines=True)
    assert len(made()) == 1
    assert sorted(r["control_id"] for r in tables["observations"].collect()) == ["C1", "C2"]


@pytest.fixture
def sf_dir(spark, tmp_path):
    """Ten minutes of events of 7 patients, and nations and regions that own the beds."""
    kinds = F.array(*[F.lit(k) for k in ("view", "click", "error", "signup", "purchase")])
    spark.range(60).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 10).alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.get(kinds, (F.col("id") % 5).cast("int")).alias("event_type"), (F.col("id") / 4).alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(25).select(
        F.col("id").alias("n_nationkey"), F.concat(F.lit("N"), "id").alias("n_name"), (F.col("id") % 5).alias("n_regionkey")
    ).write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(5).select(F.col("id").alias("r_regionkey"), F.concat(F.lit("R"), "id").alias("r_name")).write.parquet(f"{tmp_path}/region.parquet")
    return str(tmp_path)


def test_read_feed_keeps_one_parsed_table(spark, sf_dir, made):
    """Besides the state: neither the feed, nor lines, nor the tables of the first run."""
    found = {r["kind"]: (r["n"], r["patients"]) for r in feed_queries.read_feed(spark, sf_dir).collect()}
    assert found == {"observations": (12 + 4 * 12 + 2 * 12, 7), "sightings": (2 * 60 + 12, None), "quality": (3 * 12, None)}
    base = Path(spark.conf.get("spark.checkpoint.dir").split(":")[-1])
    assert sorted("state" if (base / d / "log").exists() else "rows" for d in made()) == ["rows", "state"]
