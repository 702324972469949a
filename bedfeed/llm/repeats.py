"""Repeated byte strings across a corpus, by suffix order and longest previous factors.

A byte goes if it lies in a string of `length` bytes that also starts earlier: where the longest previous factor of a
position is at least that long. Positions can only have a previous factor if their windows have the same least hash
of `GRAM` bytes (the anchor). The steps:

1. Whole copies of an earlier document are known by a digest of their text.
2. Neighbouring windows of a text mostly share their anchor; such a run is a cell. Cells are dealt out by anchor. An
   anchor that occurs once drops out, a cell that equals an earlier one is repeated as a whole.
3. What is left are the first cells of each kind whose anchor occurs again. Their bytes are dealt out by anchor, all their
   windows are put into suffix order, and the previous and next smaller positions of each give the longest
   previous factors.
4. The repeated stretches of each document are merged and cut out.

Anchors that are frequent never gather in one task: step 2 sends the repetitions that a task has seen itself by cell,
step 3 sends the windows of frequent anchors one by one, each kind once from a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedfeed.llm.common import blocks, mix, powers, stored
from bedfeed.llm.near_dedup import whole_runs

GRAM = 32
# Cells that a task compares among themselves before it sends them on.
HELD_CELLS = 400_000
# An anchor of more first cells than this is frequent.
FREQUENT = 20_000
# Windows that are put into suffix order at once.
SORTED_WINDOWS = 200_000

_LOW = -(1 << 63)
_PLACE = np.uint64((1 << 32) - 1)


def cells_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, start, windows, anchor, cell) of the runs of windows with one anchor, starts counted in the row."""
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    gram = data.astype(np.uint64) + np.uint64(1)
    base, step = 0x9E3779B97F4A7C15, 1
    while step < GRAM:
        gram = gram[:-step] * np.uint64(base) + gram[step:]
        base, step = base * base % (1 << 64), 2 * step
    gram = mix(gram)
    width = length - GRAM + 1
    least = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[: n - length + 1], least[width - step : width - step + n - length + 1])
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[rows]
    place = (least[starts] & _PLACE).astype(np.int64)
    new = np.ones(len(rows), bool)
    new[1:] = (place[1:] != place[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    windows = np.diff([*first, len(rows)]) if len(first) else np.zeros(0, np.int64)
    rows, starts, anchor = rows[first], starts[first], gram[place[first]]
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    cell = mix((sums[starts + windows - 1 + length] - sums[starts]) * down[starts] + windows.astype(np.uint64))
    return rows, starts - offsets[rows], windows, anchor, cell


_CELLS = ["key", "anchor", "cell", "doc", "start", "windows", "known", "repeated"]


def _cells(docs: DataFrame, length: int) -> DataFrame:
    """The cells of all documents (doc, text). `repeated`: an earlier one of the task is equal. `known`: the anchor
    occurs again in the task. Of each anchor a task sends its first cell by anchor, further ones by themselves."""

    def sent(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        doc, start, windows, anchor, cell = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((start, doc, cell, anchor))
        doc, start, windows, anchor, cell = (x[order] for x in (doc, start, windows, anchor, cell))
        again = np.zeros(len(doc), bool)
        again[1:] = anchor[1:] == anchor[:-1]
        known = again.copy()
        known[:-1] |= again[1:]
        repeated = again.copy()
        repeated[1:] &= cell[1:] == cell[:-1]
        # What is repeated needs no comparison, so it is dealt out by its place.
        key = np.where(again, mix(anchor ^ mix(np.where(repeated, doc.astype(np.uint64) ^ mix(start.astype(np.uint64)), cell))), anchor)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x.view(np.int64)) for x in (key, anchor, cell)), pa.array(doc), pa.array(start.astype(np.int32)),
             pa.array(windows.astype(np.int32)), pa.array(known), pa.array(repeated)],
            names=_CELLS,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for rows, data, offsets in blocks(batches):
            row, *rest = cells_of(data, offsets, length)
            if len(row):
                held.append([rows.column("doc").to_numpy()[row], *rest])
                count += len(row)
            if count >= HELD_CELLS:
                yield sent(held)
                held, count = [], 0
        if held:
            yield sent(held)

    kinds = "key long, anchor long, cell long, doc long, start int, windows int, known boolean, repeated boolean"
    return docs.select("doc", "text").mapInArrow(run, kinds)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From cells in order of key, anchor, cell and place: those that are repeated, and those whose anchor is."""
    for rows in whole_runs(batches, "key"):
        key, anchor, cell = (rows.column(c).to_numpy() for c in ("key", "anchor", "cell"))
        again = np.zeros(len(key), bool)
        again[1:] = (key[1:] == key[:-1]) & (anchor[1:] == anchor[:-1])
        known = rows.column("known").to_numpy() | again
        known[:-1] |= again[1:]
        repeated = again
        repeated[1:] &= cell[1:] == cell[:-1]
        repeated = repeated | rows.column("repeated").to_numpy()
        keep = np.flatnonzero(known | repeated)
        if len(keep):
            out = [rows.column(c).to_numpy()[keep] for c in ("anchor", "doc", "start", "windows")]
            yield pa.RecordBatch.from_arrays([*map(pa.array, out), pa.array(repeated[keep])], names=["anchor", "doc", "start", "windows", "repeated"])


_STRINGS = "key long, doc long, start int, windows int, string binary, repeated boolean"


def _strings(length: int):
    """The bytes of the cells of each document; a cell of a frequent anchor is cut into its windows, each kind of which
    is sent once, the rest is known to be repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches):
            whole, docs = data.tobytes(), rows.column("doc").to_numpy()
            cells = rows.column("cells")
            bounds = cells.offsets.to_numpy()
            start, windows, anchor, frequent = (cells.values.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            out: list[tuple] = []
            seen: set[bytes] = set()
            # In order of documents and places, so that what is seen first is the earliest of this slice.
            for i in np.argsort(docs, kind="stable").tolist():
                own = np.arange(bounds[i], bounds[i + 1])
                for j in own[np.argsort(start[own], kind="stable")].tolist():
                    at = int(offsets[i]) + int(start[j])
                    if not frequent[j]:
                        out.append((int(anchor[j]), int(docs[i]), int(start[j]), int(windows[j]), whole[at : at + int(windows[j]) - 1 + length], False))
                        continue
                    for w in range(int(windows[j])):
                        string = whole[at + w : at + w + length]
                        again = string in seen
                        out.append((int(docs[i]) if again else _digest(string), int(docs[i]), int(start[j]) + w, 1, b"" if again else string, again))
                        seen.add(string)
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "doc", "start", "windows", "string", "repeated"]
            )

    return run


def _digest(string: bytes) -> int:
    """A 64-bit hash of bytes, the same in every process."""
    x = np.frombuffer(string, np.uint8).astype(np.uint64) + np.uint64(1)
    up, _ = powers(len(x))
    return int(mix(np.array([(x * up).sum()], np.uint64)).view(np.int64)[0])


def longest_previous_factors(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The longest previous factor of each position, up to the depth to which `order` sorts.

    `order` lists the positions in suffix order, `common[i]` how far the suffixes at order[i - 1] and order[i] agree. The
    longest earlier match of a position is with the previous or with the next smaller position in that order; what
    they have in common is the least of `common` on the way, which the stack carries along.
    """
    out = np.zeros(len(order), np.int64)
    stack: list[tuple[int, int]] = []  # position, what it has in common with the one below
    for i, place in enumerate([*order.tolist(), -1]):
        shared = int(common[i]) if 0 < i < len(order) else 0
        while stack and stack[-1][0] > place:
            top, below = stack.pop()
            # `place` is the next smaller position of `top`, the one below it the previous smaller.
            out[top] = max(below, shared)
            shared = min(below, shared)
        stack.append((place, shared))
    return out


def _repeated_windows(strings: list[bytes], keys: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """For all windows of strings in order of place, whether the longest previous factor within their key is whole."""
    text = np.frombuffer(b"".join(strings), np.uint8)
    begins = np.cumsum([0, *(len(s) for s in strings)])[:-1]
    first = np.cumsum(windows) - windows
    place = np.arange(int(windows.sum())) - np.repeat(first - begins, windows)
    table = np.empty((len(place), 8 + length), np.uint8)
    table[:, :8] = np.repeat(keys, windows).astype(">i8").view(np.uint8).reshape(-1, 8)
    table[:, 8:] = np.lib.stride_tricks.sliding_window_view(text, length)[place]
    flat = table.view(f"S{8 + length}").reshape(-1)
    order = np.argsort(flat, kind="stable")
    equal = np.zeros(len(order), bool)
    equal[1:] = (table[order[1:]] == table[order[:-1]]).all(1)
    # Suffixes that are not equal to the full depth have no whole factor in common: only runs of equal ones matter.
    some = equal.copy()
    some[:-1] |= equal[1:]
    kept = np.flatnonzero(some)
    out = np.zeros(len(order), bool)
    if len(kept):
        rank = np.empty(len(order), np.int64)
        places = np.sort(order[kept])
        rank[places] = np.arange(len(places))
        out[places] = longest_previous_factors(rank[order[kept]], np.where(equal[kept], length, 0)) >= length
    return out


def _stretches(length: int):
    """From strings in order of key and place, the repeated stretches (doc, start, end) of documents."""

    def stretches(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        doc, start, windows = (rows.column(c).to_numpy().astype(np.int64) for c in ("doc", "start", "windows"))
        done = rows.column("repeated").to_numpy()
        parts = [(doc[done], start[done], start[done] + windows[done] - 1 + length)]
        open_ = np.flatnonzero(~done)
        if len(open_):
            doc, start, windows, keys = doc[open_], start[open_], windows[open_], rows.column("key").to_numpy()[open_]
            strings = rows.column("string").take(pa.array(open_)).to_pylist()
            hit = _repeated_windows(strings, keys, windows, length)
            row = np.repeat(np.arange(len(windows)), windows)
            at = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows) + start[row]
            row, at = row[hit], at[hit]
            gap = np.flatnonzero((row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)) + 1
            if len(row):
                first, last = np.r_[0, gap], np.r_[gap, len(row)] - 1
                parts.append((doc[row[first]], at[first], at[last] + length))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=["doc", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for rows in whole_runs(batches, "key"):
            keys = rows.column("key").to_numpy()
            cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            size = np.add.reduceat(rows.column("windows").to_numpy(), cuts)
            at = 0
            for cut, n in zip([*cuts[1:].tolist(), len(keys)], size.tolist(), strict=True):
                count += n
                if count >= SORTED_WINDOWS or cut == len(keys):
                    held.append(rows.slice(at, cut - at))
                    at = cut
                    if count >= SORTED_WINDOWS:
                        yield from stretches(pa.concat_tables(held))
                        held, count = [], 0
        if held:
            yield from stretches(pa.concat_tables(held))

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in blocks(batches):
        found = rows.column("found")
        spans, kept = [], []
        for i in range(rows.num_rows):
            own = data[offsets[i] : offsets[i + 1]]
            marked = np.zeros(len(own) + 1, np.int64)
            for x in found[i].as_py() or ():
                marked[x["start"]] += 1
                marked[x["end"]] -= 1
            gone = np.cumsum(marked) > 0
            edges = np.flatnonzero(np.diff(np.r_[False, gone].astype(np.int8)))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
            kept.append(own[~gone[:-1]].tobytes())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(np.diff(offsets)), pa.array(spans, span), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"]
        )


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for the documents (doc_id, text, anything else).

    ``spans`` are the stretches of bytes (start, end) that strings of `length` bytes cover which also start earlier: in
    a document of a smaller doc_id, or before in the same one. ``kept`` are the other bytes.

    Null and empty texts have no bytes and no spans. A null doc_id comes before all others. Rows that repeat both doc_id
    and text give one row; rows that share a doc_id only are documents of their own, in order of a hash of their text.
    """
    kind = dict(docs.dtypes)["doc_id"]
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW)).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    narrow = stored(base.select("doc_id", "id", "hash", F.md5(F.encode("text", "utf-8")).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")))
    same = narrow.where(F.col("n_bytes") >= length).groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    later = stored(narrow.join(stored(same.select("digest", "first")), "digest").where("id > first").select("doc_id", "id", "hash", "n_bytes").distinct())
    ids = narrow.join(later.select("id", "hash"), ["id", "hash"], "left_anti")
    firsts = base.join(later.select("id", "hash"), ["id", "hash"], "left_anti")
    if ids.groupBy("id").count().where("count > 1").head(1):
        # The places of documents follow the order of doc_id and hash: ranges are in order, and so are rows within.
        ranked = ids.select("id", "hash").distinct().repartitionByRange("id", "hash").sortWithinPartitions("id", "hash")
        places = stored(ranked.withColumn("doc", F.monotonically_increasing_id()))
        firsts = firsts.dropDuplicates(["id", "hash"]).join(places, ["id", "hash"]).select("doc_id", "doc", "text")
    else:
        firsts = firsts.select("doc_id", F.col("id").alias("doc"), "text")

    cells = _cells(firsts, length).repartition("key").sortWithinPartitions("key", "anchor", "cell", "doc", "start")
    met = stored(cells.mapInArrow(_met, "anchor long, doc long, start int, windows int, repeated boolean"))
    open_ = met.where("not repeated")
    frequent = stored(open_.groupBy("anchor").count().where(F.col("count") > FREQUENT).select("anchor", F.lit(True).alias("frequent")))
    open_ = open_.join(frequent, "anchor", "left").select("doc", F.struct("start", "windows", "anchor", F.coalesce("frequent", F.lit(False)).alias("frequent")).alias("cell"))
    of_doc = open_.groupBy("doc").agg(F.collect_list("cell").alias("cells"))
    # Both joins below shuffle the texts in the same way, so Spark writes that shuffle once and reads it twice.
    strings = firsts.join(of_doc, "doc").select("doc_id", "doc", "text", "cells").mapInArrow(_strings(length), _STRINGS)
    strings = strings.repartition("key").sortWithinPartitions("key", "doc", "start")
    found = strings.mapInArrow(_stretches(length), "doc long, start long, end long")
    whole = met.where("repeated").select("doc", F.col("start").cast("long"), (F.col("start") + F.col("windows") - 1 + length).cast("long").alias("end"))
    spans = found.unionByName(whole).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    out = f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    cut = firsts.join(spans, "doc", "left").select("doc_id", "doc", "text", "found").mapInArrow(_cut_out, out)
    gone = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return cut.unionByName(later.select("doc_id", "n_bytes", gone.alias("spans"), F.lit(b"").alias("kept")))
