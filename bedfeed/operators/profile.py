"""Text profiles of a message archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedfeed.functions import text
from bedfeed.session import explode_rows


def non_ascii_profile(df: DataFrame, column: str) -> DataFrame:
    """Texts per non-ASCII character."""
    chars = explode_rows(df, [], text.non_ascii_chars(F.col(column)), "char")
    return chars.groupBy("char").agg(F.count(F.lit(1)).alias("texts"))


def archive_table(df: DataFrame, column: str, compression: str = "zlib") -> DataFrame:
    """The table with its text column archived as ``payload``, and the size of text and payload."""
    keep = [c for c in df.columns if c != column]
    packed = df.select(
        *keep,
        F.octet_length(column).cast("bigint").alias("text_bytes"),
        text.archive_payload(F.col(column), compression).alias("payload"),
    )
    return packed.withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))


def restore_table(df: DataFrame, column: str, compression: str = "zlib") -> DataFrame:
    """An archived table with its text back."""
    keep = [c for c in df.columns if c not in ("payload", "payload_bytes", "text_bytes")]
    return df.select(*keep, text.restore_payload(F.col("payload"), compression).alias(column))


def archive_ratio(archived: DataFrame, by: list[str]) -> DataFrame:
    """Text size over payload size per group."""
    return archived.groupBy(*by).agg(
        F.sum("text_bytes").alias("text_bytes"),
        F.sum("payload_bytes").alias("payload_bytes"),
        F.try_divide(F.sum("text_bytes"), F.sum("payload_bytes")).alias("ratio"),
    )
