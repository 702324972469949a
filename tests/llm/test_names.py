"""Stages on tables whose columns are named like those of their own helpers, with nulls and repeated rows."""

import pytest

from bedfeed.llm import decontaminate, pii, quality

NAMES = ["_key", "_cuts", "_id", "_digest", "_host", "key", "cuts", "cut_id", "digest", "bad_id", "id", "clean", "row", "kind"]
MAIL = "write to ann.lee@mail.org or bob@mail.org today"
PASSAGE = " ".join(f"word{i}" for i in range(20))


def documents(spark, rows, *names):
    columns = ", ".join(["doc_id long", "text string", "n_chars int", *[f"`{n}` string" for n in names]])
    return spark.createDataFrame([(i, t, None if t is None else len(t), *names) for i, t in rows], columns)


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_redacted_with_clashing_names(spark):
    rows = [(1, MAIL), (1, MAIL), (1, "mail x@y.org"), (None, MAIL), (2, None), (3, ""), (4, "nothing here")]
    docs = documents(spark, rows, *NAMES)
    out = pii.redacted(docs)
    assert out.dtypes == docs.dtypes
    clean = "write to <EMAIL> or <EMAIL> today"
    expected = [(1, clean), (1, clean), (1, "mail <EMAIL>"), (None, clean), (2, None), (3, ""), (4, "nothing here")]
    assert texts(out) == sorted(expected, key=str)
    for r in out.collect():
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
        assert [r[n] for n in NAMES] == NAMES


def test_clean_of_with_clashing_names(spark):
    items = spark.createDataFrame([("a", PASSAGE)], "item_id string, text string")
    rows = [(1, PASSAGE), (1, "a clean text"), (None, PASSAGE), (None, "clean"), (2, None), (3, ""), (4, "clean"), (4, "clean")]
    docs = documents(spark, rows, *NAMES)
    out = decontaminate.clean_of(docs, items)
    assert out.dtypes == docs.dtypes
    assert texts(out) == sorted([(None, "clean"), (2, None), (3, ""), (4, "clean"), (4, "clean")], key=str)


@pytest.mark.parametrize("host", ["_host", "source"])
def test_quality_by_any_host_column(spark, host):
    good = " ".join(f"word{i}" for i in range(60))
    docs = documents(spark, [(1, good), (2, None), (3, ""), (4, good)], host, "kept", "c_0")
    out = quality.quality_filter(docs, host)
    assert out.dtypes == docs.dtypes
    assert texts(out) == [(1, good), (4, good)]


@pytest.mark.parametrize("stage", ["redacted", "clean_of", "quality"])
def test_empty_tables(spark, stage):
    docs = documents(spark, [], "source")
    items = spark.createDataFrame([], "item_id string, text string")
    out = {"redacted": lambda: pii.redacted(docs), "clean_of": lambda: decontaminate.clean_of(docs, items), "quality": lambda: quality.quality_filter(docs)}[stage]()
    assert out.collect() == []
    assert out.dtypes == docs.dtypes
