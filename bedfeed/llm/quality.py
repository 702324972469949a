"""Quality rules per document and per host, in DataFrame functions only.

A document fails for good when it is too short or repeats itself. Milder rules (symbols, repeated lines, odd word
lengths) are no reason by themselves: prose of a good host may break one. Their failures are summed up by host, the
rates are shrunk towards the rate of all hosts with a beta prior fitted to the spread of the hosts, and a host
whose shrunk rate is above the limit loses the benefit of the doubt: its documents that break that rule go. A document
that breaks no rule stays, whatever its host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedfeed.llm.common import SPACE, let, stored
from bedfeed.session import compute_once

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"

# The milder rules.
RULES = {
    "many_symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "odd_words": "word_chars < 3 * n_words or word_chars > 12 * n_words",
}
# A host is known for a rule when more than this share of its documents breaks it, after shrinking.
HOST_LIMIT = 0.3


def _repeated(words: Column) -> Column:
    """The number of words in windows of three words that are found twice or more."""

    def covered(threes: Column) -> Column:
        def flagged(s: Column) -> Column:
            last = F.size(s) - 1
            same = F.filter(F.sequence(F.lit(0), last), lambda j: (
                ((j > 0) & (F.get(s, j)["h"] == F.get(s, j - 1)["h"])) | ((j < last) & (F.get(s, j)["h"] == F.get(s, j + 1)["h"]))
            ))
            return F.array_sort(F.transform(same, lambda j: F.get(s, j)["at"]))

        def count(at: Column) -> Column:
            return F.aggregate(
                F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x
            )

        order = F.array_sort(F.transform(threes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(threes)) < F.size(threes), let(let(order, flagged), count)).otherwise(F.lit(0).cast("long"))

    def threes(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) >= 3, let(let(hashes, threes), covered)).otherwise(F.lit(0).cast("long"))


def _figures(text: Column) -> Column:
    def of(parts: Column) -> Column:
        return let(F.array_remove(parts, ""), lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            (F.char_length(text) - F.size(parts) + 1).cast("long").alias("word_chars"),
            (F.size(F.split(text, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
            let(F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")), lambda lines: F.struct(
                F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            )).alias("lines"),
            _repeated(words).alias("n_repeat_words"),
        ))

    return let(F.split(text, SPACE), of)


def measured(docs: DataFrame) -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed.

    Columns of these names are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    kept = [c for c in docs.columns if c not in (*names, "base_failed", "_q")]
    parts = compute_once(docs.select(*kept), {"_q": let(F.coalesce("text", F.lit("")), _figures)})
    out = parts.select(*kept, *[F.col(f"_q.lines.{n}" if "lines" in n else f"_q.{n}").alias(n) for n in names])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def host_rates(rows: DataFrame, host: str = "source") -> DataFrame:
    """One row per host of measured documents: its documents, and for every rule the raw and the shrunk rate.

    The prior of a rule is the beta distribution whose mean and spread fit the rates of all hosts (the moments of
    the beta-binomial). Hosts that differ no more than chance allows get a prior that is almost a point.
    """
    counts = [F.sum(F.when(F.expr(rule), 1).otherwise(0)).alias(f"bad_{name}") for name, rule in RULES.items()]
    hosts = stored(rows.where(F.col(host).isNotNull()).groupBy(host).agg(F.count("*").alias("docs"), *counts))
    sums = hosts.agg(
        F.count("*").alias("hosts"), F.sum("docs").alias("docs"), F.sum(F.col("docs").cast("double") ** 2).alias("squares"),
        *[F.sum(f"bad_{name}").alias(name) for name in RULES],
    ).first()
    if not sums.hosts:
        return hosts.select(host, "docs", *[F.lit(0.0).alias(f"{kind}_{name}") for name in RULES for kind in ("rate", "shrunk")])
    means = {name: sums[name] / sums.docs for name in RULES}
    spread = hosts.agg(*[F.sum(F.col("docs") * (F.col(f"bad_{name}") / F.col("docs") - means[name]) ** 2).alias(name) for name in RULES]).first()
    out = [F.col(host), F.col("docs")]
    for name in RULES:
        mean, free = means[name], sums.docs - sums.squares / sums.docs - (sums.hosts - 1)
        between = 0.0
        if 0 < mean < 1 and free > 0:
            between = (spread[name] / (mean * (1 - mean)) - (sums.hosts - 1)) / free
        between = min(max(between, 1e-6), 1 - 1e-6)
        weight = 1 / between - 1
        out.append((F.col(f"bad_{name}") / F.col("docs")).alias(f"rate_{name}"))
        out.append(((F.col(f"bad_{name}") + weight * mean) / (F.col("docs") + weight)).alias(f"shrunk_{name}"))
    return hosts.select(*out)


def judged(rows: DataFrame, rates: DataFrame, host: str = "source") -> DataFrame:
    """Measured documents with ``host_rules``, the rules that count against their host, and ``kept``."""
    known = [F.when(F.col(f"shrunk_{name}") > HOST_LIMIT, F.lit(name)) for name in RULES]
    key = f"_{host}_key"
    verdicts = rates.select(F.col(host).alias(key), F.array_compact(F.array(*known)).alias("host_rules")).where(F.size("host_rules") > 0)
    out = rows.drop("host_rules", "kept").join(verdicts, F.col(host) == F.col(key), "left").drop(key)
    out = out.withColumn("host_rules", F.coalesce("host_rules", F.array().cast("array<string>")))
    broken = [F.array_contains("host_rules", name) & F.expr(rule) for name, rule in RULES.items()]
    bad = broken[0]
    for rule in broken[1:]:
        bad = bad | rule
    return out.withColumn("kept", ~F.col("base_failed") & ~bad)


def quality_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, the figures of `measured`, base_failed, host_rules, kept) for every row of documents.

    Null and empty texts have no words and so fail. Documents without a host are judged by their own words alone.
    Rows that repeat a doc_id or a whole row are judged, and count for their host, each on its own.
    """
    rows = measured(docs.select("doc_id", host, "text")).drop("text")
    rows = stored(rows)
    return judged(rows, host_rates(rows, host), host)


def quality_filter(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that the rules keep, with the columns they came with.

    Null and empty texts go. Repeated rows are judged each on its own; an empty table gives an empty one.
    Figures are worked out again instead of being joined back: texts are never shuffled.
    """
    flags = measured(docs.select(host, "text")).drop("text")
    rates = stored(host_rates(stored(flags), host))
    named = docs.select(*[F.col(c).alias(f"c_{i}") for i, c in enumerate(docs.columns)], F.col("text"), F.col(host))
    kept = judged(measured(named), rates, host).where("kept")
    return kept.select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(docs.columns)])
