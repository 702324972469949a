"""What filters do to each other, in every order, from one table of counts.

Spark flags every document once and counts the rows of each part by the set of filters they fail: at most 2**k cells a
part. These counts are a tensor of two places, pass and fail, along one axis for each filter. What a step of an order
keeps, removes or finds gone already is that tensor contracted with a vector per axis that selects pass, fail or both,
so all orders come from the counts alone, without looking at a document again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedfeed.llm.common import let, stored, words_of
from bedfeed.session import compute_once, spread

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
# Parts contracted at a time.
PARTS_AT_ONCE = 64
LETTERS = "ABCDE"


def selectors(filters: int) -> tuple[list[tuple[int, ...]], dict[str, np.ndarray]]:
    """All orders of the filters, and for each figure the vectors that select along each axis.

    The vectors have the shape (orders * steps, filters, 2).
    """
    orders = list(permutations(range(filters)))
    chosen: dict[str, list[list[tuple[int, int]]]] = {"kept": [], "removed": [], "failing": [], "alone": []}
    for order in orders:
        for step, f in enumerate(order):
            before = order[:step]
            chosen["kept"].append([PASS if g in before or g == f else ALL for g in range(filters)])
            chosen["removed"].append([PASS if g in before else FAIL if g == f else ALL for g in range(filters)])
            chosen["failing"].append([FAIL if g == f else ALL for g in range(filters)])
            chosen["alone"].append([FAIL if g == f else PASS for g in range(filters)])
    return orders, {name: np.array(rows, np.int64) for name, rows in chosen.items()}


def contracted(counts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Sums (part, row, measure) of counts (part, 2, ..., 2, measure) over the cells that each row of vectors selects."""
    filters = chosen.shape[1]
    axes = "abcdefgh"[:filters]
    vectors = [chosen[:, g] for g in range(filters)]
    return np.einsum(f"p{axes}m,{','.join('r' + a for a in axes)}->prm", counts, *vectors, optimize="greedy")


def audited(cells: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from (part, mask, n, good, toxic) with one row per part and mask.

    Bit g of ``mask`` says that the filter ``letters[g]`` fails. Every part has all orders and steps, zeros included.
    An empty table gives no rows.
    """
    k = len(letters)
    rows = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    kinds = ", ".join(f"{name} long" for name in FIGURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, chosen = selectors(k)
        steps = len(orders) * k
        names = pa.array(["".join(letters[f] for f in order) for order in orders for _ in range(k)])
        at = np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders))
        axis = np.array([f for order in orders for f in order])
        for whole in batches:
            for first in range(0, whole.num_rows, PARTS_AT_ONCE):
                batch = whole.slice(first, PARTS_AT_ONCE)
                lists = batch.column("cells")
                part = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                mask, *measures = (np.asarray(x) for x in lists.flatten().flatten())
                counts = np.zeros((batch.num_rows, 1 << k, 3), np.int64)
                for m, values in enumerate(measures):
                    counts[part, mask, m] = values
                # Bit g of the mask is axis g: the last axis of a reshaped array runs fastest.
                counts = counts.reshape(batch.num_rows, *[2] * k, 3).transpose(0, *range(k, 0, -1), k + 1)
                kept, removed, failing, alone = (contracted(counts, chosen[name]) for name in ("kept", "removed", "failing", "alone"))
                taken = np.zeros((batch.num_rows, k), np.int64)
                np.add.at(taken, (slice(None), axis), removed[:, :, 0])
                figures = (
                    kept[:, :, 0], removed[:, :, 0], failing[:, :, 0] - removed[:, :, 0], alone[:, :, 0], removed[:, :, 1], removed[:, :, 2],
                    taken[:, axis],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("part").take(pa.array(np.repeat(np.arange(batch.num_rows), steps))),
                        pa.concat_arrays([names] * batch.num_rows), pa.array(np.tile(at, batch.num_rows)), *[pa.array(f.ravel()) for f in figures],
                    ],
                    names=["part", "filter_order", "step", *FIGURES],
                )

    return rows.mapInArrow(run, f"part string, filter_order string, step int, {kinds}")


def failures(text: Column) -> Column:
    """The bits of the filters A to D that a text fails: few words, few distinct words, many capitals, odd characters."""

    def bits(*failed: Column) -> Column:
        return sum((F.when(f, 1 << g).otherwise(0) for g, f in enumerate(failed)), F.lit(0))

    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return let(words_of(text), lambda words: bits(
        F.size(words) < 100,
        F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * 80,
        capitals * 100 > F.length(text).cast("long") * 10,
        text.rlike("[#$%&*|]"),
    ))


def flagged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask, n): rows with one doc_id, part and text are one row with their number ``n``.

    ``mask`` has the bits of filters A to D; ``digest`` is the SHA-256 of the text.
    """
    text = F.coalesce("text", F.lit(""))
    rows = spread(docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text")))
    rows = compute_once(rows, {"mask": failures(F.col("text")), "digest": F.unhex(F.sha2("text", 256))})
    return rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))


def cells_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): the rows of each part by the filters A to E that they fail, bit by bit."""
    rows = stored(flagged(docs))
    named, nameless = rows.where("doc_id is not null"), rows.where("doc_id is null")
    firsts = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    # The doc_id is part of both keys, so a text that a third of the rows share is spread over all tasks.
    known = named.join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    again = F.when(F.col("first").isNull(), 1 << LETTERS.index("E")).otherwise(0)
    known = known.select("part", (F.col("mask") + again).alias("mask"), "n", "good", "toxic")
    every = known.unionByName(nameless.select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic")))
    sums = [F.sum("n").alias("n")] + [F.sum(F.col("n") * F.coalesce(m, F.lit(0))).alias(m) for m in ("good", "toxic")]
    return every.groupBy("part", "mask").agg(*sums)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of five filters and step: what the step keeps, removes and finds gone, and what is lost.

    ``docs`` has doc_id (any type with an order), text and lang; ``labels`` has doc_id, quality and toxic; other columns
    are not looked at. Failing are A: under 100 words, B: less than 80 distinct words in a hundred, C: more than 10
    capitals A-Z in a hundred code points, D: one of ``#$%&*|``, E: a smaller doc_id has the same text. Parts are the
    values of lang.

    A null text is empty, a null lang the part of the empty string. A row without a doc_id never fails E, makes no
    other fail it and has no label. Rows that repeat a doc_id are rows of their own; with one text, none is smaller than
    the other. Of labels that repeat a doc_id, one that says 1 is enough; null labels say nothing. Empty documents
    give no rows; empty labels give zeros.
    """
    return audited(cells_of(docs, labels), LETTERS)
