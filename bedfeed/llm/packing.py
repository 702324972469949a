"""Best-fit packing of documents into sequences of several permitted lengths.

Only the number of pieces of each size matters for a packing, and sizes are bounded by the longest sequence. So the
plan is made from the histogram of sizes (at most one row per size, whatever the corpus): sizes in descending order,
each into the fullest open bins that have room, whole groups of equal bins at a time. A new bin gets the length that
costs least for each token it can expect to hold; at the end every bin shrinks to the smallest length that holds
its contents. The plan is a list of segments (ranks of a size -> consecutive bins), and each piece finds its bin from
its rank among the pieces of its size.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bedfeed.llm.common import stored, words_of

CAPACITIES = (1024, 2048, 4096, 8192)
# What a sequence costs: a fixed part, its tokens, and attention, which grows with their square.
OVERHEAD = 64
ATTENTION = 1 << 17

# Pieces of one size are ranked in groups of about this many rows.
RANK_ROWS = 1_000_000


def cost(capacity: int) -> float:
    return OVERHEAD + capacity + capacity * capacity / ATTENTION


def opened(size: int, left: int, smaller: int, capacities: tuple[int, ...]) -> int:
    """The length of a new bin for the next piece of a size, when `left` pieces of it and `smaller` tokens in smaller
    pieces are still to be placed: the least cost for each token that it can expect to hold, the shorter one at a tie."""

    def per_token(capacity: int) -> float:
        own = min(capacity // size, left) * size
        return cost(capacity) / (own + min(capacity - own, smaller))

    return min((c for c in capacities if c >= size), key=lambda c: (per_token(c), c))


@dataclass
class Plan:
    """Segments: pieces of `size` from rank `first` on go to bins from `bin` on, `each` to a bin, after `used` tokens.
    Bins: from `bin` on, all have the final length `capacity`."""

    segments: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # size, first, bin, each, used
    bins: list[tuple[int, int]] = field(default_factory=list)  # bin, capacity


def planned(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES) -> Plan:
    plan, total = Plan(), 0
    rooms: list[int] = []
    groups: dict[int, deque] = {}  # by room: (first bin, bins, length)

    def put(room: int, group: tuple[int, int, int], front: bool = False) -> None:
        if room not in groups:
            groups[room] = deque()
            insort(rooms, room)
        (groups[room].appendleft if front else groups[room].append)(group)

    smaller = sum(size * count for size, count in histogram.items())
    for size in sorted(histogram, reverse=True):
        count, rank = histogram[size], 0
        smaller -= size * count
        while rank < count:
            left = count - rank
            at = bisect_left(rooms, size)
            if at == len(rooms):
                capacity = opened(size, left, smaller, capacities)
                most = capacities[-1] // size
                bins = (left - most) // (capacity // size) + 1 if left >= most else 1
                put(capacity, (total, bins, capacity))
                total += bins
                continue
            room = rooms[at]
            first, bins, capacity = groups[room].popleft()
            if not groups[room]:
                del groups[room]
                del rooms[at]
            each = room // size
            full, rest = (bins, 0) if left >= bins * each else divmod(left, each)
            if full:
                plan.segments.append((size, rank, first, each, capacity - room))
                put(room - each * size, (first, full, capacity))
            if rest:
                plan.segments.append((size, rank + full * each, first + full, rest, capacity - room))
                put(room - rest * size, (first + full, 1, capacity))
            untouched = bins - full - (rest > 0)
            if untouched:
                put(room, (first + bins - untouched, untouched, capacity), front=True)
            rank += full * each + rest
    for room, found in groups.items():
        plan.bins += [(first, min(c for c in capacities if c >= capacity - room)) for first, _, capacity in found]
    plan.bins.sort()
    plan.segments.sort()
    return plan


def pieces(docs: DataFrame, longest: int) -> DataFrame:
    """(doc_id, piece, start, n_tokens): documents cut at the longest permitted length. Tokens are words and one mark
    for the end of the document, so an empty one or null is one token."""
    tokens = docs.select("doc_id", (F.size(words_of(F.col("text"))) + 1).alias("n"))
    cut = tokens.select("doc_id", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / longest).cast("int"))).alias("piece"))
    start = F.col("piece").cast("long") * longest
    return cut.select("doc_id", "piece", start.alias("start"), F.least(F.lit(longest), F.col("n") - start).cast("int").alias("n_tokens"))


def best_fit(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bin_id, position, capacity) for every piece of documents (doc_id, text, else).

    ``start`` is the piece's first token in its document, ``position`` its first place in the bin ``bin_id``, whose
    length is ``capacity``. Documents longer than the longest capacity give several pieces.

    Null and empty texts are one token. Rows that repeat a doc_id or a whole row are placed each on its own; equal
    sizes are ranked by a hash of the doc_id, then by doc_id and piece. An empty table gives no rows.
    """
    capacities = tuple(sorted(capacities))
    cut = stored(pieces(docs, capacities[-1]))
    salts = max(16, -(-cut.count() // RANK_ROWS))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("n_tokens", "salt").agg(F.count("*").alias("rows"))
    histogram = {r.n_tokens: r.rows for r in counts.groupBy("n_tokens").agg(F.sum("rows").alias("rows")).collect()}
    plan = planned(histogram, capacities)
    before = Window.partitionBy("n_tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("n_tokens", "salt", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("n_tokens", "salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("nth", F.row_number().over(order)).join(offsets, ["n_tokens", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "n_tokens", (F.col("before") + F.col("nth") - 1).alias("rank"))

    size, first, bins, each, used = np.array(plan.segments or [(0, 0, 0, 1, 0)], np.int64).T
    keys = (size << np.int64(44)) + first
    bin_first, bin_capacity = np.array(plan.bins or [(0, 0)], np.int64).T

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("n_tokens").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (own << np.int64(44)) + rank, "right") - 1
            step = rank - first[at]
            found = bins[at] + step // each[at]
            position = used[at] + step % each[at] * own
            capacity = bin_capacity[np.searchsorted(bin_first, found, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "n_tokens")]
                + [pa.array(found), pa.array(position.astype(np.int32)), pa.array(capacity.astype(np.int32))],
                names=["doc_id", "piece", "start", "n_tokens", "bin_id", "position", "capacity"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start long, n_tokens int, bin_id long, position int, capacity int")
