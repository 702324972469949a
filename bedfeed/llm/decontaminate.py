"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window of n words has w = n - k + 1 shingles of k words; the smallest of their hashes is its fingerprint. Equal
windows have equal fingerprints, so joining the fingerprints of documents and benchmark misses no shared window. In
a text neighbouring windows mostly share their fingerprint: a document gives one row per run of equal ones, about
two for every w + 1 words. A run that meets a fingerprint of the benchmark brings its words along, and its windows
are then compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedfeed.llm.common import let, stored
from bedfeed.session import compute_once

# Windows of the benchmark up to this number are broadcast; beyond it they are joined by a shuffle.
BROADCAST_WINDOWS = 500_000

# Fixed value: what parts words, once A-Z are in lower case.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; plain ASCII takes the quick way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD), "")


def _minima(hashes: Column, n: int) -> Column:
    """The fingerprint of every window of n words, from the hashes of the words."""
    k = (n + 1) // 2

    def shingles(words: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(F.lit(n), *[F.get(words, i + j) for j in range(k)]))

    return let(shingles(hashes), lambda s: F.transform(
        F.sequence(F.lit(0), F.size(s) - (n - k + 1)), lambda i: F.array_min(F.slice(s, i + 1, n - k + 1))
    ))


_RUN = "array<struct<n:int,start:int,length:int,fingerprint:bigint>>"


def _runs(words: Column, lengths: list[int]) -> Column:
    """The runs of windows with one fingerprint, for every window length."""

    def of(minima: Column, n: int) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(minima) - 1), lambda i: (i == 0) | (F.get(minima, i) != F.get(minima, i - 1)))
        return let(starts, lambda s: F.transform(s, lambda at, j: F.struct(
            F.lit(n).alias("n"), at.alias("start"),
            (F.coalesce(F.get(s, j + 1), F.size(minima)) - at).alias("length"), F.get(minima, at).alias("fingerprint"),
        )))

    def all_of(hashes: Column) -> Column:
        none = F.array().cast(_RUN)
        each = [F.when(F.size(hashes) >= n, let(_minima(hashes, n), lambda m, n=n: of(m, n)).cast(_RUN)).otherwise(none) for n in lengths]
        return F.concat(none, *each)

    return let(F.transform(words, lambda w: F.xxhash64(w)), all_of)


def _window_texts(words: Column, first: Column, count: Column, n: int | Column) -> Column:
    return F.transform(F.sequence(first, first + count - 1), lambda i: F.concat_ws(" ", F.slice(words, i + 1, n)))


def benchmark_windows(items: DataFrame, n: int) -> DataFrame:
    """(window, n, fingerprint, items): each distinct window of the benchmark and the ids, as text, of its items."""
    words = compute_once(items.select(F.col("item_id").cast("string").alias("item"), plain_words(F.col("text")).alias("words")), {"words": F.col("words")})
    size = F.least(F.lit(n), F.size("words"))
    words = words.where(F.size("words") > 0).select("item", "words", size.alias("n"))
    texts = _window_texts(F.col("words"), F.lit(0), F.size("words") - F.col("n") + 1, F.col("n"))
    found = words.select("item", "n", F.explode(texts).alias("window"))
    found = found.groupBy("window", "n").agg(F.array_sort(F.collect_set("item")).alias("items"))
    hashes = F.transform(F.split("window", " "), lambda w: F.xxhash64(w))
    fingerprint = F.coalesce(*[F.when(F.col("n") == m, _minima(hashes, m)[0]) for m in range(1, n + 1)])
    return found.select("window", "n", "items", fingerprint.alias("fingerprint"))


_SPANS = "array<struct<start:int,end:int>>"


def _merged(spans: Column) -> Column:
    """Stretches that spans of one length cover, from the spans in order: those before and after a gap tell."""

    def of(s: Column) -> Column:
        begins = F.filter(s, lambda x, i: (i == 0) | (x["start"] > F.get(s, i - 1)["end"]))
        stops = F.filter(s, lambda x, i: (i == F.size(s) - 1) | (x["end"] < F.get(s, i + 1)["start"]))
        return F.zip_with(begins, stops, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))

    return let(spans, of).cast(_SPANS)


def _folded(spans: Column) -> Column:
    """The same for spans of several lengths, which do not end in the order in which they start."""

    def add(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        return F.when((F.size(done) > 0) & (last["end"] >= x["start"]), joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(spans.cast(_SPANS), F.array().cast(_SPANS), add).cast(_SPANS)


def contamination(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) for every row of documents (doc_id, text, anything else).

    ``spans`` are the merged stretches of words (start, end) that windows of the benchmark (item_id, text) cover,
    ``n_hit`` their words, ``items`` the sorted ids, as text, of the items whose windows occur. An item with fewer
    words than ``window`` is one window; one without words is none.

    Null and empty texts have no words, an empty benchmark hits nothing. Rows that repeat a doc_id or a whole row
    are judged each on its own. A null item_id counts for hits but is named nowhere.
    """
    known = stored(benchmark_windows(items, window))
    lengths = {r.n: r.windows for r in known.groupBy("n").agg(F.count("*").alias("windows")).collect()}
    small = sum(lengths.values()) <= BROADCAST_WINDOWS

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    rows = compute_once(rows, {"words": plain_words(F.col("text"))}).select("row", "doc_id", "words")
    # The first run of a row is empty: it carries the number of words and keeps rows without a hit.
    head = F.array(F.struct(F.lit(0).alias("n"), F.lit(0).alias("start"), F.lit(0).alias("length"), F.col("row").alias("fingerprint"))).cast(_RUN)
    runs = compute_once(rows, {"runs": F.concat(head, _runs(F.col("words"), sorted(lengths)))})
    runs = runs.select("row", "doc_id", "words", F.explode("runs").alias("run"))
    prints = side(known.select("fingerprint", F.lit(True).alias("met")).distinct())
    near = runs.join(prints, F.col("run.fingerprint") == F.col("fingerprint"), "left").where("met or run.length = 0")
    met = near.select(
        "row", "doc_id", F.when(F.col("run.length") == 0, F.size("words")).alias("n_words"), "run.n", "run.start", "run.length",
        F.slice("words", F.col("run.start") + 1, F.when(F.col("run.length") > 0, F.col("run.length") + F.col("run.n") - 1).otherwise(0)).alias("context"),
    )
    texts = F.when(F.col("length") > 0, _window_texts(F.col("context"), F.lit(0), F.col("length"), F.col("n"))).otherwise(F.array(F.lit(None).cast("string")))
    each = met.select("row", "doc_id", "n_words", "n", "start", F.posexplode(texts).alias("at", "window"))
    hits = each.join(side(known.select("window", "items")), "window", "left").where("items is not null or n_words is not null")
    span = F.when(F.col("items").isNotNull(), F.struct((F.col("start") + F.col("at")).alias("start"), (F.col("start") + F.col("at") + F.col("n")).alias("end")))
    found = hits.groupBy("row", "doc_id").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(span)).alias("found"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    spans = compute_once(found, {"spans": (_folded if len(lengths) > 1 else _merged)(F.col("found"))})
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return spans.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "spans")


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    """At least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def clean_of(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """The documents that are not contaminated, with all their columns, whatever their names. Rows that share a doc_id go
    or stay together; rows without one stay only if they are clean themselves. Null and empty texts stay; an empty table
    gives an empty one."""
    # A row without a doc_id is known by its text, of which alone the verdict depends.
    digest = F.when(F.col("doc_id").isNull(), F.sha2("text", 256))
    found = contamination(docs.select(F.struct("doc_id", digest.alias("digest")).alias("doc_id"), "text"), items, window)
    bad = found.where(is_contaminated(F.col("n_words"), F.col("n_hit"))).select(F.col("doc_id.doc_id").alias("bad_id"), F.col("doc_id.digest").alias("bad_digest"))
    bad = stored(bad.distinct())
    named = docs.select(*[F.col(c).alias(f"c_{i}") for i, c in enumerate(docs.columns)], F.col("doc_id").alias("id"), digest.alias("digest"))
    clean = named.join(bad, F.col("id").eqNullSafe(F.col("bad_id")) & F.col("digest").eqNullSafe(F.col("bad_digest")), "left_anti")
    return clean.select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(docs.columns)])
