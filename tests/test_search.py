"""Similarity as a column, samples by places, and the bounded search for storage proxies, each against the plain way."""

import difflib
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from pricewright.functions import similarity
from pricewright.functions import storage as S
from pricewright.operators import matching, stats
from pricewright.operators import storage_match as M


def plain_ratio(a, b):
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


def test_similarity_equals_the_plain_one(spark):
    """100,000 random pairs of texts of up to 24 letters from alphabets of 2 to 12, and pairs that share pieces."""
    rng = random.Random(5)
    word = lambda n, k: "".join(rng.choice("abcdefgh-1가é"[:k]) for _ in range(rng.randint(0, n)))
    pairs = [(word(24, k), word(24, k)) for k in (2, 4, 8, 12) for _ in range(20_000)]
    for _ in range(20_000):
        x, y, z = word(8, 12), word(8, 12), word(8, 12)
        pairs.append((x + y + z, y + x + z[:3]))
    d = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").repartition(8)
    got = d.select("i", similarity.ratio(F.col("a"), F.col("b")).alias("r"), similarity.bound(F.col("a"), F.col("b")).alias("m")).collect()
    assert len(got) == 100_000
    for r in got:
        want = plain_ratio(*pairs[r.i])
        assert abs(r.r - want) < 1e-12 and r.m >= want - 1e-12, pairs[r.i]


def test_similarity_of_nothing(spark):
    d = spark.createDataFrame([(None, "a"), ("a", None), ("", ""), ("", "a"), ("a", "")], "a string, b string")
    assert [tuple(r) for r in d.select(similarity.ratio(F.col("a"), F.col("b")), similarity.bound(F.col("a"), F.col("b"))).collect()] == [(None, None), (None, None), (1.0, 1.0), (0.0, 0.0), (0.0, 0.0)]
    long = spark.createDataFrame([("ab" * 300, "ba" * 310)], "a string, b string")
    assert long.select(similarity.ratio(F.col("a"), F.col("b"))).first()[0] == pytest.approx(plain_ratio("ab" * 300, "ba" * 310))


def test_pairs_of_names_by_family(spark):
    """What fuzzy_family_match returns, against every pair of names that share a word."""
    from pricewright.plans.catalog_queries import QUERIES

    sf = "/root/testdata/sf0.001"
    names = sorted({r.p_name for r in spark.read.parquet(f"{sf}/part.parquet").select("p_name").collect()})
    want = {(a, b): plain_ratio(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if set(a.split(" ")) & set(b.split(" "))}
    got = {(r.a, r.b): r.ratio for r in QUERIES["fuzzy_family_match"](spark, sf).collect()}
    assert got == {k: pytest.approx(v) for k, v in want.items() if v >= 0.6} and got


def test_a_hot_budget_is_counted_not_gathered(spark):
    """A million rows of one budget beside a few others: the same samples as by sorting all, and no task sees them together."""
    hot = spark.range(0, 1_000_000, numPartitions=8).select(F.lit("G").alias("usage"), F.lit(1000.0).alias("budget"), "id")
    few = spark.createDataFrame([("G", 400.0, -1), ("G", 1600.0, -2), ("G", 1600.0, -3), ("G", 5000.0, -4), ("H", 10.0, -5), ("G", None, -6)], "usage string, budget double, id long")
    grid = spark.createDataFrame([("G", 1500), ("G", 3000), ("G", 8000), ("H", 0)], "usage string, point long")
    got = stats.samples(hot.unionByName(few), grid, "usage", "budget", "id", 100, 3, 12).collect()
    by = {}
    for r in got:
        by.setdefault((r.usage, r.point), []).append(r.id)
    rows = [("G", 1000.0, i) for i in range(20)] + [("G", 400.0, -1), ("G", 1600.0, -2), ("G", 1600.0, -3), ("G", 5000.0, -4), ("H", 10.0, -5)]
    for (usage, point), ids in by.items():
        want = [i for _, _, i in sorted((abs(b - point), b, i) for u, b, i in rows if u == usage)[:12]]
        assert sorted(ids) == sorted(want), point
    assert set(by) == {("G", 1500), ("G", 3000), ("G", 8000), ("H", 0)}


def drives(rng, n, hot):
    """Names of drives; a share of `hot` is of one brand, the rest of others or none."""
    out = []
    for i in range(n):
        brand = "Samsung" if rng.random() < hot else rng.choice(["Lexar", "Kingston", "WD", "Crucial", "SanDisk", ""])
        words = rng.sample(["evo", "plus", "black", "blue", "canvas", "fury", "ironwolf", "firecuda", "barracuda", "rocket"], rng.randint(0, 3))
        size = rng.choice(["250GB", "500GB", "1TB", "2TB", "4TB", ""])
        bus = rng.choice(["NVMe", "SATA", "M.2 NVMe", "SSD", ""])
        more = rng.choice(["", "", "", "pro", "heatsink", "portable"])
        out.append(" ".join(x for x in (brand, *words, more, bus, size, rng.choice(["", "SSD"])) if x) or f"drive {i}")
    return out


def test_bounded_search_finds_what_all_pairs_find(spark):
    """A brand with 30 % of both sides: the same benchmarks, scores and pools as by scoring every pair, and far fewer scored."""
    rng = random.Random(11)
    products = sorted(set(drives(rng, 300, 0.3)))
    bench = [(i, name, float(rng.randint(1, 60) * 100)) for i, name in enumerate(drives(rng, 400, 0.3))]
    left = spark.createDataFrame([(p,) for p in products], "_p string")
    left = M.cut(S.features(left, "_p").select("_p", "f"))
    right = S.features(spark.createDataFrame(bench, "_b int, bench_name string, _value double"), "bench_name")
    right = M.cut(right.withColumn("_order", F.struct("bench_name", "_b")).withColumnRenamed("f", "b"))
    seen = Observation("scored")
    got = {r._p: tuple(r) for r in M._by_spec_proxy(left, right, seen).collect()}

    every = left.withColumnRenamed("f", "p").crossJoin(right.where("b.storage")).where(F.arrays_overlap("p.brands", "b.named")).withColumn("capacity", M.capacity()).where(M.spec_fits())
    plain = lambda c: F.filter(c, lambda x: ~x.isin(S.COLOUR_SERIES))
    every = every.withColumn("q", M.spec_points() + M.SERIES_POINTS * F.size(F.array_intersect(plain(F.col("p.series")), plain(F.col("b.series")))))
    best = every.groupBy(F.col("_p").alias("_i")).agg(F.max("q").alias("_best"))
    pool = every.join(best, F.col("_p") == F.col("_i")).where(F.col("q") >= F.col("_best") - M.POOL)
    pool = pool.withColumns({"match_score": 350 + F.col("q"), "match_type": F.lit("brand_spec_proxy")})
    want = {r._p: tuple(r) for r in M._taken(pool, F.lit(1)).collect()}
    assert got == want and len(got) > 150
    assert 0 < seen.get["scored"] < every.count() / 10


def test_repeated_ids_of_benchmarks(spark):
    products = spark.createDataFrame([("Samsung SSD 1TB",)], "title string")
    for ids in ((1, 1), (1, None)):
        bench = spark.createDataFrame([(i, "Samsung 990 PRO 1TB NVMe", 5.0) for i in ids], "id int, name string, score double")
        with pytest.raises(ValueError, match="must be unique"):
            M.match_storage(products, bench, "title", "id", "name", "score")


def test_median_representative_of_a_hot_group(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"g{i % 50}", rng.randint(0, 2), float(rng.randint(0, 30)), f"n{i:05d}") for i in range(6000)] + [(None, 1, 2.0, "x"), ("none", None, 1.0, "y")]
    d = spark.createDataFrame(rows, "g string, top int, v double, name string").repartition(4)
    got = {r.g: r.name for r in matching.median_representative(d, ["g"], F.col("top"), "v", "name").collect()}
    want = {r.g: r.name for r in matching.candidate_representative(d.where("top is not null"), ["g"], F.col("top"), "v", "name").collect()}
    assert got == want
