"""Helpers shared by the operators: tables, scratch tables, `let`, byte blocks for numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bedfeed.session import scratch_dir

# Fixed value: the white space that parts words.
SPACE = r"[\x20\x09-\x0D]"

# Bits of a bitmap of ids: 4 MB.
BITMAP_BITS = 1 << 25

# Texts are worked on in blocks of about this many bytes, so that numpy's arrays stay small.
BLOCK_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_ONES = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared scratch folder and read from there, whatever executors are lost."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is not in a table of ids. The ids are stored first: Spark then knows their size and
    broadcasts them only if they are few, without having shuffled the texts."""
    return docs.join(stored(ids.select("doc_id").distinct()), "doc_id", "left_anti")


def could_be_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id may be in a table of ids: all that are, and the more of the others the longer the table.

    What decides is a bitmap of `BITMAP_BITS` bits over a hash of the ids, made and looked up by Spark. Its size is fixed,
    so it can be broadcast whatever the tables hold, and a join after it need not shuffle the texts of all documents.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS))
    place = F.bitmap_bit_position(bit)
    bitmaps = ids.select("doc_id").groupBy(F.bitmap_bucket_number(bit).alias("_bucket")).agg(F.bitmap_construct_agg(place).alias("_bitmap"))
    byte = F.conv(F.hex(F.substring("_bitmap", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = docs.withColumn("_bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(stored(bitmaps)), "_bucket")
    return found.where(F.getbit(byte, (place % 8).cast("int")) == 1).select(*docs.columns)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once; the inputs of a lambda are evaluated again for every element."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def words_of(text: Column) -> Column:
    """The words of a text as an array: what white space parts. Null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with their text as one array of UTF-8 bytes and the offsets of the rows in it.

    A slice has at most `BLOCK_BYTES` of text or a single row. Null is an empty text.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        if texts.null_count:
            texts = texts.fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(texts):
            end = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1
            end = min(max(end, at + 1), len(texts))
            yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            at = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * BLOCK_BYTES)
        _powers.clear()
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _powers.append(np.multiply.accumulate(row))
    return _powers[0][:n], _powers[1][:n]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of all words, A-Z in lower case, and the offsets of the rows in them."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_IS_SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return mix((sums[last] - sums[first]) * down[first]), np.searchsorted(first, offsets)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The row and the 64-bit hash of every k-word shingle; fewer words, but not none, are one shingle."""
    words, starts = word_hashes(data, offsets)
    counts = np.diff(starts)
    rows = np.repeat(np.arange(len(counts)), counts)
    total = np.zeros(len(words), np.uint64)
    step = np.uint64(1)
    for j in range(k):
        step = np.uint64(int(step) * _ODD & _ONES)
        total[: max(0, len(words) - j)] += words[j:] * step
    whole = np.arange(len(words)) + k <= starts[1:][rows]
    out_rows, out = rows[whole], mix(total[whole])
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        one = np.full(len(short), 0, np.uint64)
        step = 1
        for j in range(k - 1):
            step = step * _ODD & _ONES
            has = counts[short] > j
            one[has] += words[starts[short[has]] + j] * np.uint64(step)
        one = mix(one ^ (counts[short].astype(np.uint64) << np.uint64(56)) ^ np.uint64(0x5851F42D4C957F2D))
        out_rows, out = np.concatenate([out_rows, short]), np.concatenate([out, one])
    return out_rows, out
