"""Candidates by bands of sketches, and links among them that full sets confirm, for any kind of sketch.

The rows of a band that could be linked are tied together by no more ties than connect them; the components of the ties
are families, and within a family full sets are compared, skipping what is already connected. Large bands and families
are cut into pieces, and every two pieces meet in a task of their own: no pairs of a group are ever listed, no task holds
a whole group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedfeed.llm.common import could_be_of, stored
from bedfeed.llm.components import components
from bedfeed.llm.near_dedup import PIECE, _full_sets, _root, linker, whole_runs


def band_ties(could: Callable[..., np.ndarray], percent: int):
    """Ties (a, b) that connect the rows of each run which could be linked, between its two pieces or within one.

    ``could`` judges pairs of sketches, given with the sizes of the sets and the threshold; sizes that are too far apart
    for a link are not shown to it.
    """

    def of_rows(rows: pa.Table) -> tuple[list[int], list[int]]:
        keys = rows.column("key").to_numpy()
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], rows.take(pa.array(order))
        ids, sizes = rows.column("doc_id").to_numpy(), rows.column("n_shingles").to_numpy()
        side = rows.column("side").to_numpy()
        sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint16).reshape(len(keys), -1)
        roots, a, b = np.arange(len(keys)), [], []
        at = np.arange(len(keys))
        for step in range(1, len(keys)):
            at = at[at + step < len(keys)]
            at = at[keys[at] == keys[at + step]]
            if not len(at):
                break
            for part in np.array_split(at, len(at) // 5000 + 1):
                i = part[(roots[part] != roots[part + step]) & ((side[part] < 0) | (side[part] != side[part + step]))]
                i = i[100 * np.minimum(sizes[i], sizes[i + step]) >= percent * np.maximum(sizes[i], sizes[i + step])]
                j = i + step
                yes = could(sketch[i], sketch[j], sizes[i], sizes[j], percent)
                for x, y in zip(i[yes].tolist(), j[yes].tolist(), strict=True):
                    x_root, y_root = _root(roots, x), _root(roots, y)
                    if x_root != y_root:
                        roots[max(x_root, y_root)] = min(x_root, y_root)
                        a.append(ids[y])
                        b.append(ids[x])
            while (roots != (up := roots[roots])).any():
                roots = up
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_runs(batches, "key"):
            a, b = of_rows(rows)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def candidate_ties(bands: DataFrame, classes: DataFrame, could: Callable[..., np.ndarray], percent: int) -> DataFrame:
    """Ties (a, b) between classes (doc_id, n_shingles, sketch) that share a band (doc_id, band) and could be linked."""
    shared = bands.groupBy("band").agg(F.count("*").alias("rows")).where("rows > 1")
    cuts = F.ceil(F.col("rows") / PIECE).cast("int")
    met = bands.join(shared, "band").select("doc_id", "band", cuts.alias("cuts"))
    met = met.join(classes.select("doc_id", "n_shingles", "sketch"), "doc_id")
    # A band of one piece is one run; else every row goes to the runs of its piece with each other one. `side` tells
    # the pieces of a run apart, where it has two.
    own = F.pmod(F.xxhash64("doc_id"), F.col("cuts")).cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    key = F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
    met = met.select(key.alias("key"), "doc_id", "n_shingles", "sketch", side.alias("side"))
    return met.repartition("key").sortWithinPartitions("key").mapInArrow(band_ties(could, percent), "a long, b long")


def links(docs: DataFrame, k: int, percent: int, classes: DataFrame, ties: DataFrame) -> DataFrame:
    """Links (a, b) between classes (doc_id, n_shingles) that connect everything that true links connect.

    Ties (a, b) connect at least what true links connect.
    """
    families = stored(components(ties).select(F.col("node").alias("doc_id"), F.col("component").alias("family")))
    # A document's set is at least `percent` of a linked one's, so it lies in the same or the next size level. The
    # levels of a large family are cut into pieces by a hash; every two pieces that can hold a link meet in one task.
    level = F.floor(F.log(F.col("n_shingles")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    large = families.groupBy("family").agg((F.count("*") > PIECE).alias("large"))
    members = families.join(classes.select("doc_id", "n_shingles"), "doc_id").join(large, "family")
    members = members.withColumn("level", F.when(F.col("large"), level).otherwise(0))
    cuts = members.groupBy("family", "level").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("cuts"))
    after = cuts.select("family", (F.col("level") - 1).alias("level"), F.col("cuts").alias("next_cuts"))
    before = cuts.select("family", (F.col("level") + 1).alias("level"), F.col("cuts").alias("last_cuts"))
    cuts = stored(cuts.join(after, ["family", "level"], "left").join(before, ["family", "level"], "left").na.fill(0))
    member = members.join(cuts, ["family", "level"]).withColumn("cut", F.pmod(F.xxhash64("doc_id"), "cuts").cast("int"))

    def pieces(steps: int, cuts: str) -> Column:
        first = (F.col("level") + steps).cast("long") * (1 << 32)
        return F.when(F.col(cuts) > 0, F.sequence(first, first + F.col(cuts) - 1)).otherwise(F.array().cast("array<long>"))

    own = F.col("level").cast("long") * (1 << 32) + F.col("cut")
    others = F.concat(pieces(0, "cuts"), pieces(1, "next_cuts"), pieces(-1, "last_cuts"))
    placed = member.select("doc_id", "family", own.alias("piece"), others.alias("others"))
    texts = could_be_of(docs.select("doc_id", "text"), placed).join(placed, "doc_id")
    texts = texts.withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "piece", "_text"]).drop("_text")
    sets = _full_sets(texts.select(F.col("doc_id").alias("node"), "family", "piece", "others", "text"), k)
    met = sets.withColumn("other", F.explode("others")).select(
        "node", "family", "piece", "registers", "hashes",
        F.least("piece", "other").alias("piece_a"), F.greatest("piece", "other").alias("piece_b"),
    )
    return met.groupBy("family", "piece_a", "piece_b").applyInPandas(linker(percent), "a long, b long")
