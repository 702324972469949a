"""The registered queries of the operators of this subpackage, with SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from bedfeed.llm import (
    decontaminate, filter_audit, fingerprints, html, lexical, near_dedup, oracles, packing, pii, quality, repeats, secrets, sharding, token_counts,
)
from bedfeed.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _of_rule(k: int) -> Callable[[Column], Column]:
    return lambda span: span["rule"] == k


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rule"] < secrets.BASE)
    counts = [F.size(F.filter("spans", _of_rule(k))).cast("long").alias(f"n_{secrets.RULES[k].kind}") for k in range(secrets.BASE)]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.span_text(base), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans")
    )


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_rules(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("host_rules", ",").alias("host_rules"),
    )


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"))


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


@query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.span_texts(pii.personal_spans(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"), 100)
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 13)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    found = sharding.histogram_sort(docs, 24, ("text_crc32",))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


@query
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    groups = fingerprints.alike(docs, k=5, percent=80).dropDuplicates(["doc_id"])
    found = fingerprints.edit_likeness(docs, k=5).join(groups, "doc_id", "left")
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    return found.select("doc_id", "n_chars", *hexed, "near_edited", "near_next", "n_shingles", "group_id")


ORACLES["op1_secret_scan"] = oracles.SECRETS
ORACLES["op2_quality_rules"] = oracles.QUALITY
ORACLES["op8_decontamination"] = oracles.DECONTAMINATION
ORACLES["op9_near_duplicates"] = oracles.NEAR_DUPLICATES
ORACLES["op11_filter_audit"] = oracles.FILTER_AUDIT
ORACLES["op12_lexical_search"] = oracles.LEXICAL_SEARCH
QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
