"""Ranked lexical search: the best documents for every item, by pruned products of impact vectors.

A document is a vector with one impact per term it shares with the items; an item is a vector of term counts; the score
is their product. One scan turns the texts into vectors of term counts, which are stored; document frequencies come
from these. Then the vectors are ordered by length and cut into buckets, and for each bucket and item

* the bucket falls if even its longest vector, in the direction of the item, or the largest impacts of the bucket on the
  item's terms, cannot reach the item's limit;
* inside it, the heaviest coordinates are multiplied out and the rest is bounded by Cauchy-Schwarz, which drops vectors;
* what is left is scored exactly, in integers.

The limit of an item is the lowest of the best scores seen so far: first of the longest vectors of the whole table, then
of those the task has seen. Only scores that reach it leave a task, so little is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bedfeed.llm.common import blocks, mix, powers, stored

# Fixed value: what a term is made of, once A-Z are in lower case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Terms of items that are searched for in one pass over the documents; more items make more passes.
BLOCK_TERMS = 200_000
# Vectors of a bucket, and coordinates that are multiplied out before the rest is bounded.
BUCKET = 2048
FOCUS = 6
# The limits start from at least this many of the longest vectors.
HEAD = 8192

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first byte and the byte behind the last one of every term of lowered bytes, and the offsets of the rows."""
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, behind = np.concatenate([[False], inside]), np.concatenate([inside, [False]])
    first = np.flatnonzero(behind & (~before | edge))
    last = np.flatnonzero(before & (~behind | edge))
    return first, last, np.searchsorted(first, offsets)


def hashes_of(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[last] - sums[first]) * down[first])


class Vocabulary:
    """Terms by number. Hashes find them, their bytes decide."""

    def __init__(self, terms: list[bytes]) -> None:
        self.number = {t: i for i, t in enumerate(terms)}
        self.data = np.frombuffer(b"".join(terms), np.uint8)
        self.sizes = np.array([len(t) for t in terms], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        hashes = hashes_of(self.data, self.starts, self.starts + self.sizes)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    def find(self, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The number of the term in each stretch of lowered bytes, -1 for those that are none."""
        if not len(self.hashes) or not len(first):
            return np.full(len(first), -1, np.int64)
        hashes = hashes_of(data, first, last)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        met = np.flatnonzero(self.hashes[at] == hashes)
        found = self.order[at[met]]
        size = last[met] - first[met]
        same = size == self.sizes[found]
        alike = np.flatnonzero(same)
        ends = np.cumsum(size[alike])
        if len(alike):
            step = np.arange(ends[-1]) - np.repeat(ends - size[alike], size[alike])
            equal = data[np.repeat(first[met[alike]], size[alike]) + step] == self.data[np.repeat(self.starts[found[alike]], size[alike]) + step]
            same[alike] = np.logical_and.reduceat(equal, ends - size[alike])
        out = np.full(len(first), -1, np.int64)
        out[met[same]] = found[same]
        for i in met[~same]:
            out[i] = self.number.get(data[first[i] : last[i]].tobytes(), -1)
        return out


def vectors(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """(doc_id, n, terms, times) of documents: all terms with repeats, and those of the vocabulary, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, len(words.sizes))
        for rows, data, offsets in blocks(batches):
            data = _LOWER[data]
            first, last, starts = terms_of(data, offsets)
            found = words.find(data, first, last)
            row = np.repeat(np.arange(rows.num_rows), np.diff(starts))
            cells, times = np.unique((row * size + found)[found >= 0], return_counts=True)
            ends = np.searchsorted(cells, np.arange(rows.num_rows + 1) * size).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").cast(pa.int64()), pa.array(np.diff(starts)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array((cells % size).astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32))),
                ],
                names=["doc_id", "n", "terms", "times"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


@dataclass
class Weights:
    """The table's figures: documents with terms, terms in all, and the weight of every term of the vocabulary."""

    documents: int
    terms: int
    weight: np.ndarray


def weights(found: DataFrame, size: int) -> Weights:
    """Counts over all vectors. What reaches the driver is one row per term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, terms = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            documents, terms = documents + int((n > 0).sum()), terms + int(n.sum())
            held += np.bincount(np.asarray(batch.column("terms").flatten()), minlength=size)
        term = np.concatenate([np.flatnonzero(held), [-1, -2]])
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.concatenate([held[held > 0], [documents, terms]]))], names=["term", "k"])

    sums = {r.term: r.k for r in found.select("n", "terms").mapInArrow(run, "term long, k long").groupBy("term").agg(F.sum("k").alias("k")).collect()}
    documents = sums.get(-1, 0)
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * sums.get(t, 0) + 1))) for t in range(size)]
    return Weights(documents, sums.get(-2, 0), np.array(weight, np.int64))


@dataclass
class Bucket:
    """Impact vectors in the order of their length, longest first: by row, and by term."""

    ids: pa.Array
    norms: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray
    by_term: np.ndarray = field(init=False)
    rows: np.ndarray = field(init=False)
    known: np.ndarray = field(init=False)
    ends: np.ndarray = field(init=False)
    most: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        order = np.argsort(self.terms, kind="stable")
        self.rows = np.repeat(np.arange(len(self.norms)), np.diff(self.starts))[order]
        self.by_term = self.impacts[order]
        self.known, first = np.unique(self.terms[order], return_index=True)
        self.ends = np.append(first, len(order))
        self.most = np.maximum.reduceat(self.by_term, first) if len(order) else np.zeros(0, np.int64)

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where terms lie in the lists of this bucket, and which of them do."""
        at = np.searchsorted(self.known, terms)
        here = at < len(self.known)
        here[here] = self.known[at[here]] == terms[here]
        return at[here], here


def impact_vectors(batch: pa.RecordBatch, of: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, terms, impacts, norms) of the rows of a batch."""
    lists = batch.column("terms")
    sizes = np.diff(np.asarray(lists.offsets)) if batch.num_rows else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    terms, times = np.asarray(lists.flatten()), np.asarray(batch.column("times").flatten()).astype(np.int64)
    m = 75 + 25 * batch.column("n").to_numpy() * of.documents // max(1, of.terms)
    impacts = of.weight[terms] * (1_000_000_000 * times // (1000 * times + 12 * np.repeat(m, sizes)))
    squares = np.concatenate([[0.0], np.cumsum(impacts.astype(np.float64) ** 2)])
    # Sums of differences lose a little; the bounds below leave room for it.
    return starts, terms, impacts, np.sqrt(np.maximum(0, squares[starts[1:]] - squares[starts[:-1]]))


def buckets(batch: pa.RecordBatch, of: Weights) -> Iterator[Bucket]:
    """The vectors of a batch in the order of their length, cut into buckets."""
    starts, terms, impacts, norms = impact_vectors(batch, of)
    sizes = np.diff(starts)
    order = np.argsort(-norms, kind="stable")
    order = order[sizes[order] > 0]
    for at in range(0, len(order), BUCKET):
        rows = order[at : at + BUCKET]
        ends = np.cumsum(sizes[rows])
        cells = np.arange(ends[-1]) - np.repeat(ends - sizes[rows], sizes[rows]) + np.repeat(starts[rows], sizes[rows])
        own = np.concatenate([[0], ends])
        # Within a bucket lengths are summed anew, row by row.
        exact = np.sqrt(np.add.reduceat(impacts[cells].astype(np.float64) ** 2, own[:-1]))
        yield Bucket(batch.column("doc_id").take(pa.array(rows)), exact, own, terms[cells], impacts[cells])


@dataclass
class Item:
    """Terms of an item with their counts, the heaviest first."""

    terms: np.ndarray
    counts: np.ndarray
    # Lengths of the item without its first k terms.
    rest: np.ndarray

    @classmethod
    def of(cls, pairs: list[tuple[int, int]], weight: np.ndarray) -> Item:
        terms, counts = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        order = np.argsort(-counts * weight[terms], kind="stable")
        squares = counts[order].astype(np.float64) ** 2
        return cls(terms[order], counts[order], np.sqrt(np.append(np.cumsum(squares[::-1])[::-1], 0.0)))


def survivors(bucket: Bucket, item: Item, limit: int) -> np.ndarray:
    """Rows of a bucket whose bounds leave it possible that they reach the limit, which is above 0."""
    none = np.zeros(0, np.int64)

    def reaches(bound: np.ndarray | float) -> np.ndarray | bool:
        return bound * (1 + 1e-9) + 1 >= limit

    if not reaches(item.rest[0] * bucket.norms.max()):
        return none
    at, here = bucket.lists(item.terms)
    if not len(at) or not reaches(float((item.counts[here] * bucket.most[at]).sum())):
        return none
    total, squares = np.zeros(len(bucket.norms)), np.zeros(len(bucket.norms))
    focus = np.flatnonzero(here)[:FOCUS]
    for k, place in zip(focus, at[: len(focus)], strict=True):
        rows, impacts = bucket.rows[bucket.ends[place] : bucket.ends[place + 1]], bucket.by_term[bucket.ends[place] : bucket.ends[place + 1]]
        total[rows] += item.counts[k] * impacts
        squares[rows] += impacts.astype(np.float64) ** 2
    # Terms up to the last one of the focus that are in no list add nothing.
    left = item.rest[focus[-1] + 1]
    tail = at[len(focus) :]
    most = float((item.counts[here][len(focus) :] * bucket.most[tail]).sum())
    room = np.sqrt(np.maximum(0, bucket.norms**2 * (1 + 1e-9) - squares))
    return np.flatnonzero(reaches(total + np.minimum(left * room, most)))


def scores(bucket: Bucket, item: Item, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Exact scores of rows; ``counts`` are the item's counts by term."""
    sizes = bucket.starts[rows + 1] - bucket.starts[rows]
    ends = np.cumsum(sizes)
    cells = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(bucket.starts[rows], sizes)
    return np.add.reduceat(counts[bucket.terms[cells]] * bucket.impacts[cells], ends - sizes)


class Best:
    """The best rows of an item so far: highest scores first, then smallest doc_id, those without one last."""

    def __init__(self, top: int, limit: int) -> None:
        self.top, self.limit = top, max(1, limit)
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.named = np.zeros(0, bool)

    def add(self, found: np.ndarray, ids: pa.Array) -> None:
        named = np.asarray(ids.is_valid())
        found, ids = np.append(self.scores, found), np.append(self.ids, ids.fill_null(0).to_numpy())
        named = np.append(self.named, named)
        order = np.lexsort((ids, ~named, -found))[: self.top]
        self.scores, self.ids, self.named = found[order], ids[order], named[order]
        if len(order) == self.top:
            self.limit = max(self.limit, int(self.scores[-1]))


def searched(found: DataFrame, items: dict[int, list[tuple[int, int]]], of: Weights, limits: dict[int, int], top: int, least: float) -> DataFrame:
    """(item, doc_id, score): the best rows of each task among vectors of length ``least`` and more, from the limits up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {i: Item.of(pairs, of.weight) for i, pairs in items.items()}
        best = {i: Best(top, limits.get(i, 0)) for i in items}
        counts = np.zeros(len(of.weight), np.int64)
        for batch in batches:
            for bucket in buckets(batch, of):
                if bucket.norms.max() * (1 + 1e-9) < least:
                    break
                for i, item in known.items():
                    rows = survivors(bucket, item, best[i].limit)
                    if not len(rows):
                        continue
                    counts[item.terms] = item.counts
                    exact = scores(bucket, item, rows, counts)
                    counts[item.terms] = 0
                    high = np.flatnonzero(exact >= best[i].limit)
                    if len(high):
                        best[i].add(exact[high], bucket.ids.take(pa.array(rows[high])))
        for i, b in best.items():
            if len(b.scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b.scores), i)), pa.array(b.ids, mask=~b.named), pa.array(b.scores)], names=["item", "doc_id", "score"]
                )

    return found.mapInArrow(run, "item long, doc_id long, score long")


def head_length(found: DataFrame, of: Weights) -> float:
    """A length that at least `HEAD` vectors have, from counts of lengths by their exponents; 0 for small tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            norms = impact_vectors(batch, of)[3]
            total += np.bincount((4 * np.log2(np.maximum(norms, 1))).astype(np.int64), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], names=["level", "k"])

    levels = found.mapInArrow(run, "level long, k long").groupBy("level").agg(F.sum("k").alias("k")).orderBy(F.desc("level")).collect()
    rows = 0
    for r in levels:
        rows += r.k
        if rows >= HEAD:
            return 2.0 ** (r.level / 4)
    return 0.0


def best_of(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked_block(docs: DataFrame, items: dict[int, dict[str, int]], top: int) -> DataFrame:
    """(item, rank, doc_id, score) for a bounded number of items, given as counts by term."""
    terms = sorted({t for counts in items.values() for t in counts})
    number = {t: i for i, t in enumerate(terms)}
    numbered = {i: [(number[t], k) for t, k in counts.items()] for i, counts in items.items()}
    found = stored(vectors(docs, Vocabulary([t.encode() for t in terms])))
    of = weights(found, len(terms))
    least = head_length(found, of)
    first = best_of(searched(found, numbered, of, {}, top, least), top) if least else None
    limits = {r.item: r.score for r in first.where(F.col("rank") == top).collect()} if least else {}
    return best_of(searched(found, numbered, of, limits, top, 0.0), top)


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term, k): the terms of every row of the items with their counts; ``item`` numbers the rows."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rows = stored(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"))
    words = F.regexp_extract_all(F.translate("text", upper, lower), F.lit(TERM), F.lit(0))
    return rows.select("item", "item_id", F.explode(words).alias("term")).groupBy("item", "item_id", "term").agg(F.count("*").alias("k"))


def ranked(docs: DataFrame, items: DataFrame, top: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of highest score for every row of the items.

    ``docs`` has a whole-number doc_id and text, ``items`` has item_id and text; other columns are not looked at. The
    score sums, over the terms of the item with repeats, the term's weight by its rarity times a share that grows with
    its count in the document and falls with the document's length; all in whole numbers. ``rank`` counts from 1 without
    gaps. Equal scores are in the order of doc_id, rows without a doc_id last; rows that repeat one have ranks of their
    own. Only scores above 0 count, so an item may have fewer rows, and one that is empty or null, or has no term in
    common with any document, has none. Null and empty documents have no terms and no rank. Every row of the items is an
    item, also if it repeats an item_id. Empty tables give no rows.

    Items are worked on in blocks of about `BLOCK_TERMS` terms, so that what the driver and the tasks hold is bounded.
    """
    terms = stored(item_terms(items))
    total = terms.count()
    parts = max(1, math.ceil(total / BLOCK_TERMS))
    docs = docs.select("doc_id", "text")
    out = None
    for part in range(parts):
        own: dict[int, dict[str, int]] = {}
        for r in terms.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).collect():
            own.setdefault(r.item, {})[r.term] = r.k
        rows = ranked_block(docs, own, top)
        rows = rows if parts == 1 else stored(rows)
        out = rows if out is None else out.unionByName(rows)
    names = terms.select("item", "item_id").distinct()
    return out.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
