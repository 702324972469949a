"""MinHash fingerprints of texts, and what an edit or another text leaves of them.

A fingerprint holds, for each of a number of universal hash permutations, 16 bits of the least permuted shingle. The
share of equal slots of two fingerprints estimates the Jaccard similarity of the shingle sets.

Near-duplicates are found by bands of slots, joined in Spark, and confirmed by the Jaccard similarity of full sets.

The edited text of a document ends with the beginning of the next document, so documents must meet their successors.
Histogram splitters cut the order of doc_id in parts of nearly equal bytes, one exchange brings each part to a task
in order, and the first row of a part goes to the part before it as well. Texts are packed while they travel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedfeed.llm.banding import candidate_ties, links
from bedfeed.llm.common import blocks, mix, shingle_hashes, stored
from bedfeed.llm.components import components
from bedfeed.llm.near_dedup import doc_sets
from bedfeed.llm.sharding import placed, splitters

SLOTS = 64
# Bands of 3 slots match with 0.8**3, so 21 of them miss a link at the threshold 3 times in 10 million.
BAND_SLOTS = 3
BANDS = SLOTS // BAND_SLOTS
# Pairs whose likeness is this many deviations below the threshold are no candidates.
DEVIATIONS = 6
# Bytes of text in a part of the order; beyond `MOST_PARTS` parts they grow.
PART_BYTES = 16 << 20
MOST_PARTS = 20_000
# How far a part may be off its size, as a share of it.
TOLERANCE = 0.1
# Bytes of text worked on at a time.
AT_ONCE = 1 << 20

_LOW = -(1 << 63)
_KEYS = mix(np.arange(1, 2 * SLOTS + 1, dtype=np.uint64))
# The permutations x -> factor * x + term modulo 2**64; odd factors have an inverse.
FACTORS, TERMS = _KEYS[:SLOTS] | np.uint64(1), _KEYS[SLOTS:]
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def minhash(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The slots of each row's shingles; repeats do not matter. Rows without any have all bits set."""
    full = np.flatnonzero(np.diff(starts))
    out = np.full((len(starts) - 1, SLOTS), 0xFFFF, np.uint16)
    if len(full):
        permuted = np.empty_like(shingles)
        for j in range(SLOTS):
            np.multiply(shingles, FACTORS[j], out=permuted)
            permuted += TERMS[j]
            out[full, j] = (np.minimum.reduceat(permuted, starts[full]) * _FOLD) >> np.uint64(48)
    return out


def text_slots(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The slots of each text of a block, and its number of shingles with repeats."""
    rows, shingles = shingle_hashes(data, offsets, k)
    if len(rows) and (np.diff(rows) < 0).any():
        order = np.argsort(rows, kind="stable")
        rows, shingles = rows[order], shingles[order]
    starts = np.searchsorted(rows, np.arange(len(offsets)))
    return minhash(shingles, starts), np.diff(starts)


def likeness(a: np.ndarray, b: np.ndarray, count_a: np.ndarray, count_b: np.ndarray) -> np.ndarray:
    """The share of equal slots; texts without words are like each other and like nothing else."""
    share = (a == b).mean(1)
    share[(count_a > 0) != (count_b > 0)] = 0.0
    return share


def packed(slots: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in slots.astype(">u2")], pa.binary())


def fingerprints(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, fingerprint) for every row of documents (doc_id, text, anything else).

    The fingerprint has 2 bytes for each of `SLOTS` permutations, over shingles of ``k`` words, A-Z in lower case; fewer
    words are one shingle. Texts without words, empty and null ones have all bits set.
    Rows that repeat a doc_id or a whole row each give a row, equal texts equal fingerprints, and an empty table none.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), packed(text_slots(data, offsets, k)[0])], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint binary")


def signed_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, sketch): the size, a 128-bit sum and the slots of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches):
            shingles, starts = doc_sets(data, offsets, k)
            sums = []
            for salt in (0x452821E638D01377, 0xBE5466CF34E90C6C):
                total = np.append(np.uint64(0), np.cumsum(mix(shingles ^ np.uint64(salt)), dtype=np.uint64))
                sums.append((total[starts[1:]] - total[starts[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").cast(pa.int64()), pa.array(np.diff(starts).astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), packed(minhash(shingles, starts))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, sketch binary")


def band_hashes(classes: DataFrame) -> DataFrame:
    """(doc_id, band) for every band of the slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            slots = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), ">u2").reshape(batch.num_rows, -1)
            bands = slots[:, : BANDS * BAND_SLOTS].reshape(batch.num_rows, BANDS, BAND_SLOTS).astype(np.uint64)
            key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bands.shape[:2])
            for j in range(BAND_SLOTS):
                key = (key << np.uint64(16)) | bands[:, :, j]
            ids = np.repeat(batch.column("doc_id").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(key.ravel().view(np.int64))], names=["doc_id", "band"])

    return classes.select("doc_id", "sketch").mapInArrow(run, "doc_id long, band long")


def could_be_alike(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    limit = percent / 100
    return (a == b).mean(1) >= limit - DEVIATIONS * np.sqrt(limit * (1 - limit) / SLOTS)


def alike(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, group_id) for every row of documents (a whole-number doc_id, text, anything else).

    ``n_shingles`` is the number of distinct shingles of ``k`` words; ``group_id`` is the smallest doc_id that links of a
    Jaccard similarity of at least ``percent`` in a hundred reach. Bands of fingerprint slots bring candidates together;
    equal sets are one class from the start, large bands and groups are worked on in pieces, and full sets decide.

    A null or empty text, or one without words, has no shingles and is its own group. Rows that repeat a doc_id are one
    document. A row without a doc_id belongs to the group of its text, but names none; alone, its group is null. An
    empty table gives no rows.
    """
    drawn = stored(signed_sets(docs, k))
    key = ["n_shingles", "set_a", "set_b"]
    copies = drawn.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"))
    more = stored(copies.where("copies > 1").select(*key, "class_id"))
    classed = drawn.join(more, key, "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    firsts = classed.where("n_shingles > 0 and doc_id = class_id").dropDuplicates(["doc_id", "set_a", "set_b"]).select("doc_id", "n_shingles", "sketch")
    ties = candidate_ties(band_hashes(firsts), firsts, could_be_alike, percent)
    found = components(links(docs, k, percent, firsts, ties)).select(F.col("node").alias("class_id"), "component")
    return classed.join(found, "class_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "class_id").alias("group_id"))


def in_order(docs: DataFrame) -> DataFrame:
    """(part, ahead, doc_id, hash, size, packed): every text in the part of its place in the order of (doc_id, text hash).

    The partitions hold whole parts in order. Each part ends with the row that follows its last one, with ``ahead`` 1:
    the first row of the next part that has any, and behind the last part that of the first. ``packed`` is the text,
    compressed; ``size`` is its length in bytes.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("hash", F.xxhash64("text"))
    keys = stored(docs.select(F.coalesce("doc_id", F.lit(_LOW)).alias("hash"), F.col("hash").alias("id"), F.octet_length("text").cast("long").alias("size")))
    total = keys.agg(F.sum("size")).first()[0] or 0
    parts = min(MOST_PARTS, total // PART_BYTES + 1)
    bounds = sorted(splitters(keys, parts, TOLERANCE))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = placed(batch.column("hash").to_numpy(), batch.column("id").to_numpy(), bounds)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), batch.column("hash"), batch.column("id")], names=["part", "hash", "id"])

    least = keys.select("hash", "id").mapInArrow(numbered, "part int, hash long, id long").groupBy("part").agg(F.min(F.struct("hash", "id")).alias("key"))
    found = sorted((r.part, r.key.hash, r.key.id) for r in least.collect())
    before = np.zeros(parts, np.int32)
    first = np.zeros((2, parts), np.int64)
    for i, (part, *key) in enumerate(found):
        before[part], first[:, part] = found[i - 1][0], key

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            ids, hashes = batch.column("doc_id").fill_null(_LOW).to_numpy(), batch.column("hash").to_numpy()
            part = placed(ids, hashes, bounds).astype(np.int32)
            texts = [x.as_buffer() for x in batch.column("text").cast(pa.large_binary())]
            small = pa.array([codec.compress(x, asbytes=True) for x in texts], pa.binary())
            every = np.arange(len(part))
            again = np.flatnonzero((first[0][part] == ids) & (first[1][part] == hashes))
            take = pa.array(np.concatenate([every, again]))
            columns = [batch.column("doc_id"), batch.column("hash"), pa.array([x.size for x in texts], pa.int64()), small]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([part, before[part[again]]])), pa.array(np.repeat(np.array([0, 1], np.int32), [len(every), len(again)]))]
                + [c.take(take) for c in columns],
                names=["part", "ahead", "doc_id", "hash", "size", "packed"],
            )

    dealt = docs.mapInArrow(deal, "part int, ahead int, doc_id long, hash long, size long, packed binary")
    return dealt.repartitionById(parts, "part").sortWithinPartitions("part", "ahead", F.asc_nulls_first("doc_id"), "hash")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array, list[bytes]]]:
    """(ahead, doc_id, texts) of the rows, about `AT_ONCE` bytes of text at a time."""
    codec = pa.Codec("zstd")
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        ahead = batch.column("ahead").to_numpy()
        step = np.searchsorted(np.cumsum(sizes), np.arange(AT_ONCE, int(sizes.sum()) + AT_ONCE, AT_ONCE), "right")
        for a, b in zip([0, *step], [*step, len(sizes)], strict=True):
            if a < b:
                small = batch.column("packed").slice(a, b - a)
                texts = [codec.decompress(p.as_buffer(), decompressed_size=int(s), asbytes=True) if s else b"" for p, s in zip(small, sizes[a:b], strict=True)]
                yield ahead[a:b], batch.column("doc_id").slice(a, b - a), texts


def _block(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def edited(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Each text but the last one, its last quarter replaced by as much of the next, and the code points of all."""
    data, offsets = _block(texts)
    points = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    starts = np.searchsorted(points, offsets)
    chars = np.diff(starts)
    cut = chars[:-1] // 4
    keep = points[starts[:-2] + chars[:-1] - cut] - offsets[:-2]
    more = points[starts[1:-1] + np.minimum(cut, chars[1:])] - offsets[1:-1]
    return [t[:a] + n[:b] for t, n, a, b in zip(texts, texts[1:], keep.tolist(), more.tolist())], chars


def edit_likeness(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every document.

    Documents (a whole-number doc_id, text, anything else) follow each other in the order of doc_id, those without one
    first, and after the last comes the first; rows that repeat a doc_id are in the order of a hash of their text. The
    edited text is the text with its last quarter of code points (rounded down) replaced by as many from the beginning
    of the next, or all of it. ``near_edited`` and ``near_next`` are the shares of slots in which the fingerprint agrees
    with that of the edited text and that of the next document: 1 if neither has words, 0 if only one has.

    Null and empty texts are edited to themselves. A single row is its own successor. Rows that repeat a whole row each
    give a row; an empty table gives none. Rows that agree in doc_id and text stay in one part of the order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for ahead, ids, texts in _unpacked(batches):
            slots, counts = text_slots(*_block(texts), k)
            if held is not None:
                ahead, ids, texts = np.append(held[0], ahead), pa.concat_arrays([held[1], ids]), held[2] + texts
                slots, counts = np.concatenate([held[3], slots]), np.append(held[4], counts)
            held = ahead[-1:], ids.slice(len(ids) - 1), texts[-1:], slots[-1:], counts[-1:]
            if len(texts) < 2:
                continue
            changed, chars = edited(texts)
            own = np.flatnonzero(ahead[:-1] == 0)
            changed = [changed[i] for i in own]
            new, new_counts = text_slots(*_block(changed), k)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(own)), pa.array(chars[own].astype(np.int64)), pa.array([hashlib.sha256(t).digest() for t in changed], pa.binary()),
                    packed(slots[own]), packed(new),
                    pa.array(likeness(slots[own], new, counts[own], new_counts)),
                    pa.array(likeness(slots[own], slots[own + 1], counts[own], counts[own + 1])),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return in_order(docs).drop("hash", "part").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
    )
