"""Waveform record export: a header table and a sample table per bed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bedfeed.operators.waveform import record_headers, record_samples

BED = ("hospital", "bed_unit", "bed_id")


def export_records(rows: DataFrame, path: str, record: list[str], **options) -> None:
    """Write ``headers`` and ``samples`` below a folder, one folder per bed in each.

    ``record`` names the columns that tell the records of a bed apart. Input rows without samples are
    left out of the sample table but their channels keep a header.
    """
    keys = [*BED, *record]
    headers = record_headers(rows, keys, **options)
    headers_path = f"{path.rstrip('/')}/headers"
    headers.hint("rebalance", *BED).write.mode("overwrite").partitionBy(*BED).parquet(headers_path)
    # Read back what was written, so that the ranges are not computed twice.
    written = rows.sparkSession.read.schema(headers.schema).parquet(headers_path).fillna("", [*BED])
    samples = record_samples(rows, written, keys)
    (
        samples.hint("rebalance", *BED)
        .write.mode("overwrite")
        .partitionBy(*BED)
        .parquet(f"{path.rstrip('/')}/samples")
    )
