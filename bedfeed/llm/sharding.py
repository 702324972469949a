"""Histogram sort: shards of nearly equal bytes, with one exchange.

Documents are ordered by a hash of their text, then by doc_id, so copies lie together. The splitters between shards
are found by counting: each round, every unsettled splitter lays a few probes over the range in which it must
lie, all tasks count the bytes between probes, and the sums narrow the ranges. A splitter is settled when its place is
known to the tolerance, or to a single row. A range that holds one text only is searched on by doc_id, so a large
group of copies is split too. Only sums between probes reach the driver: their number depends on the shards alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedfeed.llm.common import stored

PROBES = 32
# Every shard is exchanged in this many parts, so that no task sorts a whole shard.
PARTS = 8
# How far a splitter may lie from its target, as a share of a part.
TOLERANCE = 0.002

_LOW = -(1 << 63)


def placed(hashes: np.ndarray, ids: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """How many of the sorted bounds (hash, doc_id) each row lies at or above."""
    bound_hash = np.array([b[0] for b in bounds], np.int64)
    bound_id = np.array([b[1] for b in bounds], np.int64)
    low, high = np.searchsorted(bound_hash, hashes, "left"), np.searchsorted(bound_hash, hashes, "right")
    for at in np.unique(low[low < high]):
        rows = np.flatnonzero((low == at) & (high > low))
        low[rows] += np.searchsorted(bound_id[at : high[rows[0]]], ids[rows], "right")
    return low


def counted(keys: DataFrame, bounds: list[tuple[int, int]]) -> dict[int, tuple]:
    """For each gap between bounds that has rows: rows, bytes, and the least and greatest hash and doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[int]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes, ids, sizes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("hash", "id", "size"))
            gap = placed(hashes, ids, bounds)
            order = np.argsort(gap, kind="stable")
            gaps, starts = np.unique(gap[order], return_index=True)
            figures = zip(
                gaps.tolist(), np.diff([*starts, len(gap)]).tolist(), np.add.reduceat(sizes[order], starts).tolist(),
                *[f.reduceat(x[order], starts).tolist() for x in (hashes, ids) for f in (np.minimum, np.maximum)], strict=True,
            )
            for g, *f in figures:
                t = total.get(g)
                total[g] = f if t is None else [t[0] + f[0], t[1] + f[1], min(t[2], f[2]), max(t[3], f[3]), min(t[4], f[4]), max(t[5], f[5])]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(names, (g, *f), strict=True)) for g, f in total.items()], schema=pa.schema([(n, pa.int64()) for n in names])
        )

    names = ["gap", "rows", "bytes", "low_hash", "high_hash", "low_id", "high_id"]
    parts = keys.select("hash", "id", "size").mapInArrow(run, ", ".join(f"{n} long" for n in names))
    sums = parts.groupBy("gap").agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.min("low_hash").alias("a"), F.max("high_hash").alias("b"),
        F.min("low_id").alias("c"), F.max("high_id").alias("d"),
    )
    return {r.gap: tuple(r)[1:] for r in sums.collect()}


def _probes(low: int, high: int, n: int) -> list[int]:
    """Up to n values above low and up to high, evenly apart."""
    return sorted({low + 1 + (high - low - 1) * i // max(1, n - 1) for i in range(n)}) if high > low else []


def splitters(keys: DataFrame, parts: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """The parts - 1 bounds (hash, doc_id) between parts of nearly equal bytes; a bound belongs to the part above it."""
    whole = counted(keys, []).get(0)
    if whole is None:
        return [(_LOW, _LOW)] * (parts - 1)
    rows, total, *box = whole
    allowed = tolerance * total / parts
    # For each splitter: the rows and bytes of the range it lies in, the bytes below, the range, the bound below and above.
    start = (rows, total, 0, *box, (_LOW, _LOW), None)
    open_ = {k: start for k in range(1, parts)}
    done: dict[int, tuple[int, int]] = {}
    while open_:
        bounds: set[tuple[int, int]] = set()
        for rows, inside, below, a, b, c, d, low, high in set(open_.values()):
            bounds.update(x for x in (low, high) if x is not None)
            share = PROBES * max(1, sum(1 for v in open_.values() if v[7] == low))
            bounds.update(((h, _LOW) for h in _probes(a, b, share)) if a < b else ((a, i) for i in _probes(c, d, share)))
        ordered = sorted(bounds)
        found = counted(keys, ordered)
        sums = np.cumsum([0] + [found[g][1] if g in found else 0 for g in range(len(ordered) + 1)])
        left = {}
        for k in open_:
            target = total * k / parts
            gap = int(np.searchsorted(sums, target, "right")) - 1
            rows, inside, a, b, c, d = found[gap]
            below = int(sums[gap])
            low = ordered[gap - 1] if gap else (_LOW, _LOW)
            high = ordered[gap] if gap < len(ordered) else None
            least, most = target - below, below + inside - target
            if min(least, most) <= allowed or (a, c) == (b, d) or rows == 1:
                # The range is placed as a whole on the side that brings the splitter nearer to its target.
                first = (a, _LOW) if a < b else (a, c)
                done[k] = first if least <= most else _after(high, b, d)
            else:
                left[k] = (rows, inside, below, a, b, c, d, low, high)
        open_ = left
    return [done[k] for k in range(1, parts)]


def _after(high: tuple[int, int] | None, last_hash: int, last_id: int) -> tuple[int, int]:
    """A bound above all rows of a range: the bound that ends it, or the next possible key after its last."""
    if high is not None:
        return high
    return (last_hash, last_id + 1) if last_id < (1 << 63) - 1 else (last_hash + 1, _LOW)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def histogram_sort(docs: DataFrame, shards: int = 24, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, keep..., shard, slot) for every row of documents (doc_id, text, anything else).

    ``size`` is the UTF-8 length of the text plus 8; shards hold nearly equal sums of it. ``slot`` counts the rows of a
    shard from 0 in the order of text hash and doc_id. Rows of one text share a shard unless a splitter falls in
    their midst. Null texts are empty; a null doc_id sorts first; rows that repeat a doc_id with one text stay
    together. Some shards of a small table may be empty; an empty table gives no rows.
    """
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long")
    known = docs.select("doc_id", text_hash(F.col("text")).alias("hash"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW)).alias("id"), size.alias("size"), *keep)
    known = stored(known)
    bounds = splitters(known, shards * PARTS)
    ordered = sorted(bounds)
    counts = counted(known, ordered)
    rows = [counts[g][0] if g in counts else 0 for g in range(shards * PARTS)]
    before = [sum(rows[g // PARTS * PARTS : g]) for g in range(len(rows))]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = placed(batch.column("hash").to_numpy(), batch.column("id").to_numpy(), ordered).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], names=[*batch.schema.names, "part"])

    kinds = dict(known.dtypes)
    dealt = known.mapInArrow(place, ", ".join(f"{c} {kinds[c]}" for c in known.columns) + ", part int")
    order = Window.partitionBy("part").orderBy("hash", "id")
    offset = F.get(F.array(*[F.lit(b).cast("long") for b in before]), F.col("part"))
    out = dealt.withColumn("slot", offset + F.row_number().over(order) - 1)
    return out.select("doc_id", "size", *keep, F.floor(F.col("part") / PARTS).cast("int").alias("shard"), "slot")
