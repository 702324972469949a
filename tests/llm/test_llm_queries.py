"""The registered queries against their SQL twins, and the columns that the others promise."""

import oracle
import pytest

from bedfeed.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op3": "doc_id piece start n_tokens bin_id position capacity",
    "op4": "page_id url text n_chars",
    "op5": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op6": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op7": "doc_id n_words n_tokens n_unknown",
    "op10": "doc_id size text_crc32 law shard slot grown_shard",
    "op13": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next n_shingles group_id",
}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert oracle.compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"pipeline"}))
def test_columns(spark, name):
    out = QUERIES[name](spark, SF_DIR)
    assert " ".join(out.columns) == COLUMNS[name.split("_")[0]]
    table, key = ("pages", "page_id") if name.startswith("op4") else ("documents", "doc_id")
    ids = spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key)
    assert out.select(key).distinct().exceptAll(ids).count() == 0 and ids.exceptAll(out.select(key).distinct()).count() == 0
