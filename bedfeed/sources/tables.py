"""Observation tables read back: batches, one bed, many beds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bedfeed.operators.observations import OBSERVATION_SCHEMA, dedup_observations
from bedfeed.session import tasks_for
from bedfeed.sinks.tables import BED, ROW_ORDER

# Rows of a task that looks for duplicates.
DEDUP_ROWS = 500_000

# The number of a batch folder, or the one at the end of a file name.
_BATCH_FOLDER = r"/batch_id=(\d+)/"
_TRAILING_NUMBER = r"-(\d+)\.[^-/]*$"


def file_number(path: Column) -> Column:
    """Batch folder number, or the number at the end of a file name; NULL for other files."""
    found = [F.regexp_extract(path, pattern, 1) for pattern in (_BATCH_FOLDER, _TRAILING_NUMBER)]
    return F.coalesce(*[f.try_cast("bigint") for f in found])


def slice_bounds(total: int, start: int, count: int | None) -> tuple[int, int]:
    """First and last (exclusive) position of a slice; the start is clamped into the range and a
    missing or negative count means all."""
    first = min(max(0, start), max(total - 1, 0))
    wanted = total if count is None or count < 0 else min(count, total)
    return first, min(first + wanted, total)


def load_batches(
    spark: SparkSession, path: str, file_start: int = 0, num_files: int | None = None,
    schema: T.StructType | None = None, dedup: bool = True,
) -> DataFrame:
    """Read a run of batches, in number order, and drop duplicate rows, keeping the first.

    All files of one number are a batch. Files without a number come after the numbered ones, each as a
    batch of its own, in order of their names. Files outside the slice are not read: the slice is a filter
    on file paths between its first and last batch, the only rows that reach the driver. With a schema that
    lacks the order of the rows in their file, the first of a batch is the one with the smallest value.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    rows = (reader.schema(schema) if schema else reader).parquet(path)
    columns = rows.columns
    file = F.col("_metadata.file_path")
    number = F.coalesce(file_number(file), F.lit(2**63 - 1))
    name = F.when(file_number(file).isNull(), file).otherwise("")
    if file_start > 0 or (num_files is not None and num_files >= 0):
        rows = slice_keys(rows, {"_number": number, "_name": name}, file_start, num_files)
    if dedup:
        rows = _in_tasks(rows.select("*", number.alias("_number"), name.alias("_name"), file.alias("_file")))
        order = ["_number", "_name", "_file", *[c for c in ROW_ORDER if c in columns]]
        rows = dedup_observations(rows, order)
    return rows.select(*columns)


def _in_tasks(rows: DataFrame) -> DataFrame:
    """Rows of files in tasks of a bounded number of rows, if those they are read in may be larger: a file of rows with many
    blank columns is small and its rows are not. Rows are dealt by their places, so that copies do not fall together."""
    tasks = tasks_for(rows, DEDUP_ROWS)
    if tasks <= rows.rdd.getNumPartitions():
        return rows
    return rows.withColumn("_row", F.col("_metadata.row_index")).repartition(tasks, "_file", "_row").drop("_row")


def _at_or_beyond(bound: tuple, keys: dict[str, Column], above: bool) -> Column:
    found = F.lit(True)
    for column, value in reversed(list(zip(keys.values(), bound, strict=True))):
        found = (column > value if above else column < value) | ((column == value) & found)
    return found


def slice_keys(rows: DataFrame, keys: dict[str, Column], start: int, count: int | None) -> DataFrame:
    """Rows whose key lies in a run of the sorted distinct keys.

    The run is a filter on its first and last key, so keys that stand for folders or files prune those.
    """
    distinct = rows.select(*[c.alias(name) for name, c in keys.items()]).distinct()
    first, last = slice_bounds(distinct.count(), start, count)
    if last <= first:
        return rows.limit(0)
    ordered = distinct.orderBy(*keys)
    low, high = (tuple(ordered.offset(n).first()) for n in (first, last - 1))
    return rows.where(_at_or_beyond(low, keys, True) & _at_or_beyond(high, keys, False))


def read_beds(spark: SparkSession, path: str, schema: T.StructType = OBSERVATION_SCHEMA) -> DataFrame:
    """The whole table written per bed, with blank bed keys restored."""
    return spark.read.schema(schema).parquet(path).fillna("", list(BED))


def load_bed(
    spark: SparkSession, path: str, hospital: str, bed_unit: str, bed_id: str,
    schema: T.StructType = OBSERVATION_SCHEMA,
) -> DataFrame:
    """Rows of one bed; only its folder is read."""
    rows = spark.read.schema(schema).parquet(path)
    for column, value in zip(BED, (hospital, bed_unit, bed_id), strict=True):
        rows = rows.where(F.col(column).isNull() if value == "" else F.col(column) == value)
    return rows.fillna("", list(BED))


def load_bed_file(spark: SparkSession, path: str) -> tuple[tuple[str, str, str], DataFrame]:
    """A file that must hold exactly one bed: its key and rows."""
    rows = spark.read.parquet(path)
    missing = [c for c in BED if c not in rows.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    keys = rows.select(*BED).distinct().limit(2).collect()
    if len(keys) != 1:
        raise ValueError(f"{path} should hold one bed")
    return tuple(keys[0]), rows


def load_beds(
    spark: SparkSession, path: str, file_start: int = 0, num_files: int | None = None,
    schema: T.StructType = OBSERVATION_SCHEMA,
) -> DataFrame:
    """Rows of a run of beds in key order, without duplicates. All beds come in one table.

    Only the folders of the run are read. Of duplicates the one in the oldest file stays, and in a file the
    first, if the schema has the order of its rows.
    """
    rows = spark.read.schema(schema).parquet(path)
    blank = {c: F.coalesce(F.col(c), F.lit("")) for c in BED}
    columns = rows.columns
    rows = rows.select("*", F.col("_metadata.file_modification_time").alias("_written"), F.col("_metadata.file_path").alias("_file"))
    if file_start > 0 or (num_files is not None and num_files >= 0):
        rows = slice_keys(rows, blank, file_start, num_files)
    order = ["_written", "_file", *[c for c in ROW_ORDER if c in columns]]
    return dedup_observations(_in_tasks(rows).fillna("", list(BED)), order).select(*columns)
