"""Queries over whole texts, against brute force on every token of the operator."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricewright.operators import matching
from pricewright.plans import catalog_queries

SF = "/root/testdata/sf0.001"


def tokens(text):
    x = re.sub(r"[()\[\]{},/+]", " ", (text or "").lower())
    x = re.sub(r"[^a-z0-9가-힣 \t\n\x0b\f\r\-@.]", " ", x.replace("×", " x "))
    return {w for w in (m.strip("-") for m in re.findall("[a-z0-9가-힣-]+", x)) if len(w) >= 2}


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """The small tables, with a document of short words only, one without a text, and rows that repeat an id."""
    path = f"file://{tmp_path_factory.mktemp('whole')}"
    spark.read.parquet(f"{SF}/benchmark.parquet").unionByName(spark.createDataFrame([(900, "an ox-cart on a hill")], "item_id long, text string")).write.parquet(f"{path}/benchmark.parquet")
    more = spark.createDataFrame([(9000, "On an old hill, an OX-CART a b"), (9001, None), (9002, "hill"), (9002, "an on")], "doc_id long, text string")
    spark.read.parquet(f"{SF}/documents.parquet").unionByName(more, allowMissingColumns=True).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def sets(spark, sf):
    docs = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        docs.setdefault(r.doc_id, set()).update(tokens(r.text))
    return {r.item_id: tokens(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}, docs


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_block_match_on_whole_texts(spark, sf, sets, broadcast):
    items, docs = sets
    want = {(i, d, len(a & b)) for i, a in items.items() for d, b in docs.items() if len(a & b) >= 2}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = [(r.item_id, r.doc_id, r.common) for r in catalog_queries.QUERIES["token_block_match_whole"](spark, sf).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == len(set(got)) and set(got) == want
    assert {(900, 9000, 4), (900, 9002, 3)} <= want
    assert {i for i, _, _ in want} == set(items)


def test_frequency_on_whole_texts(spark, sf, sets):
    want = Counter(w for b in sets[1].values() for w in b)
    got = catalog_queries.QUERIES["token_frequency_whole"](spark, sf).collect()
    assert len(got) == len(want) and {r.token: r.n for r in got} == want


def test_common_tokens_of_null_and_nothing(spark):
    a = spark.createDataFrame([(1, ["x", "y", "y"]), (2, [])], "a int, tokens array<string>")
    b = spark.createDataFrame([(None, ["x", "y"]), (7, ["y", "y"]), (8, None)], "b int, tokens array<string>")
    assert {tuple(r) for r in matching.common_tokens(a, b, "a", "b").collect()} == {(1, None, 2), (1, 7, 1)}
    assert matching.common_tokens(a, b.where(F.lit(False)), "a", "b").count() == 0
