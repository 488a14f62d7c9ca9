"""The registered queries on a small folder of tables with nulls, empty and repeated texts, and on empty tables."""

import math
import zlib

import pytest
from pyspark.sql import functions as F

from pricewright.llm import queries

SF = "/root/testdata/sf0.001"
PER_DOCUMENT = {
    "op1_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op2_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op4_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op5_line_dedup": ["doc_id", "n_lines", "n_removed", "n_runs", "longest_run", "kept_sha256"],
    "op5_line_dedup_all": ["doc_id", "n_lines", "n_removed", "n_runs", "kept_sha256"],
    "op6_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op9_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "guarantee"],
    "op10_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op12_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op13_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('tables')}"
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame([(-5, None, None, None, None), (-4, "", "en", "s1", 0), (-3, " \n", "en", "s1", 2), (-2, "x" * 5000 + " y", None, "s2", 5002)], docs.schema)
    docs = docs.where("doc_id < 40").unionByName(more).unionByName(more.where("doc_id = -2")).withColumn("n_words", F.lit("clash")).coalesce(2)
    docs.write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "pages", "benchmark", "embeddings"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    docs.limit(0).write.parquet(f"{path}/none/documents.parquet")
    for name in ("labels", "pages", "benchmark", "embeddings"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{path}/none/{name}.parquet")
    return path


@pytest.mark.parametrize("name", sorted(PER_DOCUMENT))
def test_one_row_for_each_document(spark, folder, name):
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    got = queries.QUERIES[name](spark, folder)
    assert got.columns == PER_DOCUMENT[name]
    assert sorted(r.doc_id for r in got.collect()) == ids


def test_mixing(spark, folder):
    rows = queries.QUERIES["op3_source_mixing"](spark, folder).collect()
    tokens = {r.doc_id: len((r.text or "").split()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert sum(r.taken for r in rows) <= queries.MIX_SHARE * (sum(tokens.values()) + tokens[-2])
    assert all(0 < r.taken <= r.n_tokens == tokens[r.doc_id] for r in rows) and sum(r.taken < r.n_tokens for r in rows) > 0


def test_packing(spark, folder):
    rows = queries.QUERIES["op8_packing"](spark, folder).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024


def test_sharding(spark, folder):
    """Sizes and checksums of whole texts, counts at most one apart, slots without gaps, equal texts together."""
    texts = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    rows = sorted(queries.QUERIES["op13_sharding"](spark, folder).collect(), key=lambda r: (r.doc_id, r.size))
    assert [(r.doc_id, r["size"], r.text_crc32) for r in rows] == sorted((d, len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in texts)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and {len(slots.get(s, [])) for s in range(40)} <= {len(rows) // 40, -(-len(rows) // 40)}
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_clusters(spark, folder):
    rows = queries.QUERIES["op11_ball_tree"](spark, folder).collect()
    vectors = {r.vec_id: [math.floor(256 * x) for x in r.embedding] for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    assert {r.vec_id for r in rows} == set(vectors) and {r.inertia for r in rows} == {sum(r.distance for r in rows)}
    found = {r.cluster: r.centroid_sha256 for r in rows}
    assert len(found) <= 40 and all(found[r.cluster] == r.centroid_sha256 for r in rows)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, folder, name):
    assert queries.QUERIES[name](spark, f"{folder}/none").count() == 0
