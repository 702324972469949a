"""Session helpers: settings that matter, the shared scratch folder, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup table is broadcast only when it was found to have at most this many rows.
BROADCAST_ROWS = 20_000
# Rows that one task takes where the work on a row is costly, such as the parsing of a message.
TASK_ROWS = 50_000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Plans here are built from many small expressions; skip recording a call site for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str | int = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bedfeed")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="bedfeed-")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name below the shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only a local session without that setting gets a
    temporary folder, because other executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_scratch()
    path = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    passing = _passing.get()
    if passing is not None:
        passing.append(path)
    return path


# Scratch folders named so far inside the innermost `passing_scratch`.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more, wherever the scratch folder is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch folders named inside are deleted at the end. Tables that are made inside must not be read after that."""
    folders: list[str] = []
    token = _passing.set(folders)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in folders:
            drop_folder(spark, path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside are deleted when it ends, and not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_scratch(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """The rows, written to a scratch folder and read from there; their shuffles leave no files behind.

    ``zstd`` takes about two thirds of the usual space, but tasks that read the rows go by bytes and so have more rows."""
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_rows(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared scratch folder and read from there, whatever executors are lost."""
    return write_scratch(df, scratch_dir(df.sparkSession))


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A lookup table ready for joins: held as local rows with a broadcast hint when it is small.

    At most ``rows + 1`` rows are fetched to find out; a larger table is returned as it is.
    """
    found = df.limit(rows + 1).collect()
    if len(found) > rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(found, df.schema))


def tasks_for(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """Tasks for costly work on each row of a table: one for every so many rows, and no fewer than there are cores.

    The rows are counted, so the table should be one that is read from files."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def spread(df: DataFrame, *keys: str, rows: int = TASK_ROWS) -> DataFrame:
    """Spread a table over tasks of a bounded number of rows before costly per-row work, so that a longer table means
    more tasks and not longer ones. The pieces it is read in say little: they go by bytes, and files by row groups."""
    return df.repartition(tasks_for(df, rows), *keys)


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated exactly once.

    Spark pushes a filter on a derived column down as a filter on its inputs and so evaluates the
    derivation again. A one-row generator stops that. It only copies: the columns are worked out in a
    projection below it, where Spark shares common parts.
    """
    others = [c for c in df.columns if c not in columns]
    derived = df.select(*others, *[c.alias(name) for name, c in columns.items()])
    return derived.select(*others, F.inline(F.array(F.struct(*columns))))


def with_value(value: Column, rule: Callable[[Column], Column]) -> Column:
    """A rule over a value that is worked out once, however often the rule names it, and of its branches only those taken.

    A named expression is copied to every place that uses it; one bound by a lambda is not. Long rules
    are also kept out of the generated loop over the rows, which the JVM no longer compiles once it is too long.
    """
    return F.get(F.transform(F.array(value), rule), F.lit(0))


def explode_rows(
    df: DataFrame, keep: list, array: Column, value: str, position: str = "_position"
) -> DataFrame:
    """One row per array element, with its position if that is named; empty arrays give no row.

    A plain explode makes Spark filter on the size of the array first and so evaluate it twice. The outer
    form, with its one empty row dropped afterwards, evaluates it once.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, value))
    rows = rows.where(F.col(position).isNotNull())
    return rows.drop(position) if position == "_position" else rows
