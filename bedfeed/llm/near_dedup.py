"""MinHash near-duplicates with HyperMinHash sketches.

The shingles of a text fall into buckets by their first hash bits. A bucket keeps its smallest hash in 16 bits: the
number of leading zeros and the bits after the first one. Bands of registers find candidates; an estimate from
the registers, corrected for registers that are equal by chance, drops what is far off; full sets decide.

Equal shingle sets are one class from the start, so exact copies never meet each other. The rows of a band that could
be linked, by a short sketch, are tied together by no more ties than connect them; the components of the ties are
families. Within a family full sets are compared, skipping what is already connected, and only links that connect
something new are written. Bands and families that are large are cut into pieces, and every two pieces meet in a
task of their own. So no pairs of a group are ever listed, no task holds a whole group, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedfeed.llm.common import blocks, mix, shingle_hashes, stored, without
from bedfeed.llm.components import components

BUCKET_BITS = 8
MANTISSA_BITS = 10
BAND_ROWS = 5
# A band of 5 registers matches with 0.8**5, so 51 bands miss a link at the threshold once in 6e8.
BANDS = (1 << BUCKET_BITS) // BAND_ROWS
# Rows of a piece of a large band or family; two pieces meet in a task.
PIECE = 1000
# Sets of this size and more bring only their first registers to the bands.
LONG_SET = 128
SHORT_SKETCH = 64


def doc_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every row, in order, and the offsets of the rows in them."""
    rows, hashes = shingle_hashes(data, offsets, k)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    rows, hashes = rows[new], hashes[new]
    return hashes, np.searchsorted(rows, np.arange(len(offsets)))


def registers(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of 16-bit registers per set; 0 is an empty bucket. The hashes of a set are in ascending order."""
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    cell = rows * (1 << BUCKET_BITS) + bucket
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    rest = (hashes[first] << np.uint64(BUCKET_BITS)) >> np.uint64(11)
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    shift = bits - 1 - MANTISSA_BITS
    after = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64))
    zeros = 53 - bits
    value = ((zeros + 1) << MANTISSA_BITS) | (after & np.uint64((1 << MANTISSA_BITS) - 1)).astype(np.int64)
    out = np.zeros((len(starts) - 1) << BUCKET_BITS, np.uint16)
    out[cell[first]] = value
    return out.reshape(len(starts) - 1, 1 << BUCKET_BITS)


# Two registers of different sets agree by chance when their leading zeros and their mantissas agree: the zeros
# agree with probability 1/3 and the mantissas with 2**-10, for sets that fill the bucket alike.
CHANCE = 1 / 3 / (1 << MANTISSA_BITS)


def estimate(one: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The corrected Jaccard estimate of a sketch against many, and the number of registers it rests on."""
    used = ((one != 0) | (many != 0)).sum(1)
    equal = ((one != 0) & (one == many)).sum(1)
    share = equal / np.maximum(used, 1)
    return (share - CHANCE) / (1 - CHANCE), used


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, registers): the size, a 128-bit sum and the sketch of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches):
            hashes, starts = doc_sets(data, offsets, k)
            sums = []
            for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
                total = np.zeros(len(hashes) + 1, np.uint64)
                np.cumsum(mix(hashes ^ np.uint64(salt)), out=total[1:])
                sums.append((total[starts[1:]] - total[starts[:-1]]).view(np.int64))
            found = registers(hashes, starts)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").cast(pa.int64()), pa.array(np.diff(starts).astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]),
                 pa.array([r.tobytes() for r in found], pa.binary())],
                names=["doc_id", "n_shingles", "set_a", "set_b", "registers"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, registers binary")


def band_keys(classes: DataFrame) -> DataFrame:
    """(doc_id, band): the hash of each band that has a filled register."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            bands = found[:, : BANDS * BAND_ROWS].reshape(batch.num_rows, BANDS, BAND_ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2])
            for j in range(BAND_ROWS):
                key = mix((key << np.uint64(16)) ^ (key >> np.uint64(48)) ^ bands[:, :, j])
            row, band = np.nonzero(bands.any(2))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(key[row, band].view(np.int64))], names=["doc_id", "band"])

    return classes.select("doc_id", "registers").mapInArrow(run, "doc_id long, band long")


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of rows with whole runs of equal keys, from batches that are in the order of the key."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = now if rest is None else pa.concat_tables([rest, now])
        keys = now.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if cut:
            yield now.slice(0, cut)
        rest = now.slice(cut)
    if rest is not None:
        yield rest


def could_link(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of short sketches leave a link possible: five deviations below the threshold still do."""
    long = (size_a >= LONG_SET) | (size_b >= LONG_SET)
    full = (a != 0) & (a == b)
    some = (a != 0) | (b != 0)
    equal = np.where(long, full[:, :SHORT_SKETCH].sum(1), full.sum(1))
    used = np.where(long, some[:, :SHORT_SKETCH].sum(1), some.sum(1))
    share = (equal / np.maximum(used, 1) - CHANCE) / (1 - CHANCE)
    limit = percent / 100
    unseen = np.maximum(0.2, 1 - used * (1 + limit) / (size_a + size_b))
    fits = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    return fits & (share >= limit - 5 * np.sqrt(limit * (1 - limit) * unseen / np.maximum(used, 1)))


def band_ties(percent: int):
    """Ties (a, b) that connect the rows of each run which could be linked, between its two pieces or within one."""

    def of_rows(rows: pa.Table) -> tuple[list[int], list[int]]:
        keys = rows.column("key").to_numpy()
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], rows.take(pa.array(order))
        ids, sizes = rows.column("doc_id").to_numpy(), rows.column("n_shingles").to_numpy()
        side = rows.column("side").to_numpy()
        sketch = np.zeros((len(keys), 1 << BUCKET_BITS), np.uint16)
        for i, x in enumerate(rows.column("sketch").to_pylist()):
            sketch[i, : len(x) // 2] = np.frombuffer(x, np.uint16)
        roots, a, b = np.arange(len(keys)), [], []
        at = np.arange(len(keys))
        for step in range(1, len(keys)):
            at = at[at + step < len(keys)]
            at = at[keys[at] == keys[at + step]]
            if not len(at):
                break
            for part in np.array_split(at, len(at) // 5000 + 1):
                i = part[(roots[part] != roots[part + step]) & ((side[part] < 0) | (side[part] != side[part + step]))]
                j = i + step
                yes = could_link(sketch[i], sketch[j], sizes[i], sizes[j], percent)
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


def candidate_ties(classes: DataFrame, percent: int) -> DataFrame:
    """Ties (a, b) between classes that share a band and could be linked."""
    bands = band_keys(classes)
    shared = bands.groupBy("band").agg(F.count("*").alias("rows")).where("rows > 1")
    cuts = F.ceil(F.col("rows") / PIECE).cast("int")
    met = bands.join(shared, "band").select("doc_id", "band", cuts.alias("cuts"))
    sketch = F.when(F.col("n_shingles") >= LONG_SET, F.substring("registers", 1, 2 * SHORT_SKETCH)).otherwise(F.col("registers"))
    met = met.join(classes.select("doc_id", "n_shingles", sketch.alias("sketch")), "doc_id")
    # A band of one piece is one run; else every row goes to the runs of its piece with each other one. `side` tells
    # the pieces of a run apart, where it has two.
    own = F.pmod(F.xxhash64("doc_id"), F.col("cuts")).cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    key = F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
    met = met.select(key.alias("key"), "doc_id", "n_shingles", "sketch", side.alias("side"))
    return met.repartition("key").sortWithinPartitions("key").mapInArrow(band_ties(percent), "a long, b long")


def _full_sets(docs: DataFrame, k: int) -> DataFrame:
    """(node, piece keys as they are, n, registers, hashes) of documents, with their whole sets of shingles."""
    keep = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches):
            hashes, starts = doc_sets(data, offsets, k)
            sketch = registers(hashes, starts)
            yield pa.RecordBatch.from_arrays(
                [rows.column(c) for c in keep]
                + [pa.array([r.tobytes() for r in sketch], pa.binary()),
                   pa.array([hashes[starts[i] : starts[i + 1]].tobytes() for i in range(len(sketch))], pa.binary())],
                names=[*keep, "registers", "hashes"],
            )

    kinds = dict(docs.dtypes)
    return docs.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", registers binary, hashes binary")


def _root(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def linker(percent: int):
    """The links among the rows of one piece, or between two, that connect something new."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        ids, left = rows["node"].to_numpy(), (rows["piece"] == rows["piece_a"]).to_numpy()
        within = bool((rows["piece_a"] == rows["piece_b"]).iloc[0])
        sketch = np.frombuffer(b"".join(rows["registers"]), np.uint16).reshape(len(rows), -1)
        sets = [np.frombuffer(x, np.uint64) for x in rows["hashes"]]
        sizes = np.array([len(s) for s in sets])
        roots = np.arange(len(rows))
        out = []
        for i in range(len(rows) - 1):
            other = np.flatnonzero(roots[i + 1 :] != roots[i]) + i + 1
            if not within:
                other = other[left[other] != left[i]]
            fits = 100 * np.minimum(sizes[other], sizes[i]) >= percent * np.maximum(sizes[other], sizes[i])
            other = other[fits]
            if not len(other):
                continue
            about, used = estimate(sketch[i], sketch[other])
            other = other[about >= percent / 100 - 6 * np.sqrt(0.16 / np.maximum(used, 1))]
            for j in other:
                if roots[j] == roots[i]:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                    out.append((ids[j], ids[i]))
                    roots[roots == roots[j]] = roots[i]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def links(docs: DataFrame, k: int, percent: int, classes: DataFrame) -> DataFrame:
    """Links (a, b) between classes that connect everything that true links connect."""
    ties = candidate_ties(classes, percent)
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
    texts = docs.select("doc_id", "text").join(placed, "doc_id")
    texts = texts.withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "piece", "_text"]).drop("_text")
    sets = _full_sets(texts.select(F.col("doc_id").alias("node"), "family", "piece", "others", "text"), k)
    met = sets.withColumn("other", F.explode("others")).select(
        "node", "family", "piece", "registers", "hashes",
        F.least("piece", "other").alias("piece_a"), F.greatest("piece", "other").alias("piece_b"),
    )
    return met.groupBy("family", "piece_a", "piece_b").applyInPandas(linker(percent), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of documents (doc_id, text, anything else).

    ``n_shingles`` is the number of distinct shingles of ``k`` words, A-Z in lower case. ``component_id`` is the
    smallest doc_id that links of at least ``percent`` in a hundred reach, and ``kept`` says that it is the own one.

    A text without words, an empty one and null have no shingles and are linked with nothing. Fewer words than
    ``k`` are one shingle. Rows that repeat a doc_id are one document, linked with all that any of their texts is
    linked with, if that doc_id is the smallest with these shingles. A null doc_id with words is linked through its text like any other, but never names a
    component; if nothing else is there, its component is null and it is kept.
    """
    drawn = stored(sketches(docs, k))
    key = ["n_shingles", "set_a", "set_b"]
    named = drawn.where("n_shingles > 0 and doc_id is not null")
    classes = named.groupBy(*key).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"))
    more = stored(classes.where("copies > 1").select(*key, "class_id"))
    owned = stored(drawn.join(more, key, "left").withColumn("class_id", F.when(F.col("n_shingles") > 0, F.coalesce("class_id", "doc_id")).otherwise(F.col("doc_id"))))
    firsts = owned.where("n_shingles > 0 and doc_id = class_id").dropDuplicates(["doc_id", "set_a", "set_b"]).select("doc_id", "n_shingles", "registers")
    found = components(links(docs, k, percent, firsts)).select(F.col("node").alias("class_id"), "component")
    out = owned.select("doc_id", "n_shingles", "class_id").join(found, "class_id", "left")
    component = F.coalesce("component", "class_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def first_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id, with all its columns.

    Of rows that repeat a kept doc_id, one stays. Of rows without a doc_id, one of each text stays. Documents without
    words stay.
    """
    found = stored(near_duplicates(docs, k, percent).select("doc_id", "kept"))
    out = without(docs.where("doc_id is not null"), found.where("not kept and doc_id is not null"))
    again = stored(found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.head(1):
        out = without(out, again).unionByName(out.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns))
    return out.select(*docs.columns).unionByName(_nameless(docs))


def _nameless(docs: DataFrame) -> DataFrame:
    rows = docs.where("doc_id is null")
    return rows.dropDuplicates(["text"]) if rows.head(1) else rows
