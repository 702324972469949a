"""Observation tables on disk: Parquet with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedfeed.operators.observations import OBSERVATION_SCHEMA, conform

BED = ("hospital", "bed_unit", "bed_id")
# Where a row stood in its file; tables keep these columns when the rows have them, so that loaders know the first.
ROW_ORDER = ("msg_idx", "obr_idx", "row_idx")


def fixed_columns(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The fixed schema; named columns outside it and the order of the rows are kept."""
    extra = (*extra, *[c for c in ROW_ORDER if c in rows.columns and c not in extra])
    return rows.select(*conform(rows), *[F.col(c) for c in extra if c not in OBSERVATION_SCHEMA.names])


def write_observations(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Append rows to one table, in whatever bed order they come."""
    fixed_columns(rows).write.mode(mode).option("compression", "snappy").parquet(path)


def bed_slug(hospital: Column, unit: Column, bed: Column) -> Column:
    """File-safe name of a bed: ``BED_hospital-unit-bed`` with blanks and dashes as underscores."""
    def safe(c: Column) -> Column:
        return F.translate(c, " -", "__")

    return F.concat(F.lit("BED_"), hospital, F.lit("-"), safe(unit), F.lit("-"), safe(bed))


def write_by_bed(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write one folder per bed.

    ``rebalance`` brings the rows of a bed together so that folders hold few files, and lets Spark split
    a bed that is far larger than the rest over several tasks and files.
    """
    (
        fixed_columns(rows)
        .hint("rebalance", *BED)
        .write.mode(mode)
        .option("compression", "snappy")
        .partitionBy(*BED)
        .parquet(path)
    )


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one numbered batch of mixed beds; writing the same number again replaces it."""
    (
        fixed_columns(rows)
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("batch_id")
        .parquet(path)
    )
