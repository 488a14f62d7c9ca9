"""Each stage of the pipeline on its own input, against what the operators' brute-force tests define."""

from pyspark.sql import functions as F

import corpus_pipeline as pipeline

from .test_corpus import kept_lines, shingles

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns = docs, docs.columns
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r for r in kept.collect()}
        kept = stage(spark, kept, SF).cache()
        if name != "packing":
            assert kept.columns == columns
            after = {r.doc_id: r for r in kept.collect()}
            assert len(after) == kept.count() and set(after) <= set(before) and 0 < len(after)
            assert len(after) < len(before) or name in ("line dedup", "near duplicates")  # these may drop none of so few
        if name == "line dedup":
            want = kept_lines([(d, r.text) for d, r in before.items()], 1, 1)
            want = {d: x[0] for (d, _), x in want.items() if not (x[1] and x[1] == x[2])}
            assert {d: r.text for d, r in after.items()} == want
            assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "near duplicates":
            sets = {d: shingles(r.text) for d, r in before.items()}
            links = lambda a, b: 100 * len(a & b) >= 80 * len(a | b) and a
            ids = sorted(after)
            assert not any(links(sets[a], sets[b]) for i, a in enumerate(ids) for b in ids[:i])
            assert all(any(links(sets[d], sets[e]) for e in sets if e < d) for d in set(before) - set(after))
        if name == "mixing":
            total = sum(len(r.text.split()) for r in before.values())
            taken = sum(len(r.text.split()) for r in after.values())
            assert 0.5 * total < taken < total
    assert {r.doc_id for r in kept.collect()} == set(after)


def test_run_is_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    key = lambda d: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in d.collect())
    assert key(pipeline.run(spark, SF)) == key(docs)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, taken string, row string"
#: Names of columns that the stages use for themselves, and one that has to be quoted.
CLASHING = ["_id", "_hash", "_i", "_t", "_times", "_last", "_row", "_stays", "component", "text_hash", "kept_text", "guarantee", "stratum", "a.b", "x`y"]


def test_stages_keep_columns_of_any_name(spark):
    text = "\n".join(f"line {i} of a text that has enough words {i * 7}" for i in range(30))
    docs = spark.createDataFrame([(1, text, "en", "s1", 9), (2, text + " x", "en", "s1", 9), (2, text + " x", "en", "s1", 9), (3, "other " * 30, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    for name, stage in pipeline.STAGES:
        columns, docs = docs.columns, stage(spark, docs, SF)
        if name != "packing":
            assert docs.columns == columns, name
            rows = [r.asDict() for r in docs.collect()]
            assert rows and all(r[c] == f"own {c}" for r in rows for c in CLASHING), name
    assert docs.count() > 0


def test_near_duplicates_of_repeated_ids(spark):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    texts = [(1, a), (5, a + " x"), (5, b), (5, b), (6, b + " y"), (7, ""), (8, None), (7, ""), (None, a), (9, "q")]
    docs = spark.createDataFrame([(d, t, "en", "s1", len(t or ""), "t", "r") for d, t in texts], SCHEMA)
    got = sorted(((r.doc_id or 0), r.text or "") for r in pipeline.near_duplicates(spark, docs, SF).collect())
    assert got == sorted([(1, a), (5, b), (7, ""), (7, ""), (8, ""), (0, a), (9, "q")])


def test_mixing_cuts_the_last_document(spark):
    docs = spark.createDataFrame([(i, " one\t two\n" * 50 + "end", "en", "s1", 503, "t", "r") for i in range(10)], SCHEMA)
    got = pipeline.mix(spark, docs, SF)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sum(len(r.text.split()) for r in rows) == int(0.8 * 1010) and all(r.n_chars == len(r.text) and docs.first().text.startswith(r.text) for r in rows)


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0, name


def test_stages_of_nulls_and_repeated_rows(spark):
    text = "\n".join(f"line {i} of a text that has enough words {i * 7}" for i in range(30))
    rows = [(1, text), (1, text), (None, text + " more"), (2, None), (3, ""), (4, "few words"), (5, text + "\nand one line more")]
    docs = spark.createDataFrame([(d, t, None, None, None, "t", "r") for d, t in rows], SCHEMA)
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() > 0, name
