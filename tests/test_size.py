"""What keeps the cost of a row and the size of a task from growing."""

import pytest
from pyspark.sql import functions as F

from pricewright.functions import memory, specs
from pricewright.operators import estimates, integrate, matching, part_match
from pricewright.operators import quality as Q
from pricewright.operators import variants as V
from pricewright.plans import catalog_queries, market_queries
from pricewright.sources import cards as C


def test_sources_are_spread_over_all_cores(spark, tmp_path):
    """A file of short rows is one block, and one task would make all of its texts."""
    spark.range(100).selectExpr("id as p_partkey").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    d = market_queries.made(spark, str(tmp_path), "select p_partkey from {part}")
    assert d.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and d.count() == d.distinct().count() == 100


def test_names_are_squeezed_once(spark):
    """However many tests a name goes through."""
    for reason, most in ((Q.name_reason("RAM", F.col("x")), 1), (Q.cooler_reason(F.col("x"), F.lit("")), 1), (Q.is_benefit(F.col("x")), 1)):
        assert str(reason).count("\\s+") <= most


def test_pages_go_on_together(spark):
    """Cards of many pages, each with its page and number, whatever goes on at once."""
    pages = spark.range(450).selectExpr("id", "if(id % 3 = 0, null, repeat(concat('<li id=\"productItem', id, '\">', id, '</li>'), cast(id % 3 as int))) as html").coalesce(1)
    found = C.cards(pages, "id").collect()
    assert sorted((r.id, r.n, r.card.full) for r in found) == [(i, n, str(i)) for i in range(450) for n in range(i % 3)]


@pytest.mark.parametrize("category,most", [("RAM", 4), ("SSD", 7)])
def test_units_are_spelled_once(category, most):
    """A text's units are brought to one spelling once for each attribute that is read from it, not for each form and test."""
    spec = specs.refined_spec(category, F.col("n"), F.col("d"), F.col("f"))
    assert str(spec).count("㎔") <= most


def test_kits_are_found_once():
    assert str(memory.kit_capacity(F.col("x"))).count("㎔") == 1


def test_links_are_chosen_once():
    """A card's identity, and the options it offers, don't name the work behind them again."""
    assert str(V.identity(F.col("card"), "https://shop.example")).count("javascript") == 1
    assert str(V._cheapest(F.col("o"))).count("array_sort") == 1


def test_drive_offers_are_read_once():
    assert str(V.drive_offer(F.col("o"))).count("tokens") == 1


def _plan(d):
    return d._jdf.queryExecution().optimizedPlan().toString()


def test_lines_of_estimates_are_read_once(spark):
    html = "<table><tr><th>PC 주요부품</th><th>개당 가격</th><th>수량</th></tr><tr><td>SSD</td><td>disk</td><td>1,000원</td><td>2개</td></tr><tr><td>SSD</td><td>disk</td><td>x</td><td>y</td></tr></table>"
    d = estimates.part_lines(C.part_tables(spark.createDataFrame([(1, html)], "k long, html string"), "k"), ["k"])
    assert [tuple(r) for r in d.collect()] == [(1, "SSD", 0, "disk", 1000, 2)]
    assert _plan(d).count("\\s*원?$") == 1


def test_pairs_of_a_task_are_bounded(spark, monkeypatch):
    """More documents make more tasks."""
    monkeypatch.setattr(matching, "PAIRS_A_TASK", 10, raising=False)
    few = spark.createDataFrame([("a", ["x", "y"]), ("b", ["y"])], "item string, tokens array<string>")
    d = matching.common_tokens(few, spark.range(100).selectExpr("id", "array('x', 'y', 'z') as tokens"), "item", "id")
    assert {tuple(r) for r in d.collect()} == {(k, i, n) for i in range(100) for k, n in (("a", 2), ("b", 1))}
    assert "RepartitionByExpression" in _plan(d) and ", 21" in _plan(d)


@pytest.mark.parametrize("query", ["ols_fit_predict", "quantile_clamp"])
def test_no_task_holds_all_values(spark, monkeypatch, query):
    """percentile() sends every distinct value of a group to one task."""
    for f in ("percentile", "median"):
        monkeypatch.setattr(catalog_queries.F, f, lambda *a, **b: pytest.fail("gathers values"))
    assert catalog_queries.QUERIES[query](spark, "/root/testdata/sf0.001").count() > 0


def test_names_of_memory_are_normalised_once():
    assert str(memory.module_info(F.col("x"))).count("[^a-z0-9가-힣") == 1


def test_names_of_chips_are_normalised_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(part_match, "stored", lambda d: plans.append(_plan(d)) or d)
    names = spark.createDataFrame([(1, "AMD Ryzen 5 5600X", "10")], "id long, name string, score string")
    d = part_match.match_chips(names.select("id", "name"), names.selectExpr("name as b", "score"), "CPU", "id", "name", "b", "score")
    assert [r.match_score for r in d.collect()] == [102] and plans and all(p.count("[^a-z0-9가-힣") == 1 for p in plans)


def _tables(monkeypatch, *modules):
    """Rows and plan of each table that is written on the way."""
    made = []
    for m in modules:
        monkeypatch.setattr(m, "stored", lambda d, write=m.stored: made.append((d.count(), _plan(d))) or write(d))
    return made


def test_chips_are_matched_by_name(spark, monkeypatch):
    """Once, however many products have it; products without a name or a match stay."""
    made = _tables(monkeypatch, part_match)
    products = spark.range(60).selectExpr("id", "element_at(array('AMD Ryzen 5 5600X', 'nothing', null), cast(id % 3 as int) + 1) as name")
    bench = spark.createDataFrame([("AMD Ryzen 5 5600X", "10"), ("Ryzen 5 5600X box", "9")], "bench string, score string")
    d = part_match.match_chips(products, bench, "CPU", "id", "name", "bench", "score", with_candidates=True)
    assert sorted((r.id, r.bench_name, r.candidates) for r in d.collect()) == [(i, *(("AMD Ryzen 5 5600X", 2) if i % 3 == 0 else (None, None))) for i in range(60)]
    assert max(n for n, _ in made) == 3


@pytest.mark.parametrize("part,names,found", [
    ("GPU", ["ASUS RTX 4070", "board"], {0: ("ASUS", "NVIDIA", 70, "model_key_exact"), 1: (None, None, None, "none")}),
    ("SSD", ["Lexar NM790 NVMe SSD 1TB", "drive"], {0: (None, None, 90, "model_exact"), 1: (None, None, None, "none")}),
])
def test_listings_are_matched_by_name(spark, monkeypatch, part, names, found):
    """So are brands: the rows themselves are only written as they come and as they go. A row without a name is one as well."""
    made = _tables(monkeypatch, integrate, part_match)
    listing = spark.range(60).selectExpr("id", f"element_at(array('{names[0]}', '{names[1]}', null), cast(id % 3 as int) + 1) as name", "id * 10 as price")
    bench = spark.createDataFrame([("GeForce RTX 4070", "70", 1), ("Lexar NM790 NVMe SSD 1TB", "90", 2)], "Bench_Name string, Score string, row int")
    rows, report = integrate.match_data(listing, [bench], part)
    got = {r.id: (r.price, getattr(r, "brand", None), getattr(r, "chipset_brand", None), r.bench_score, r.match_type) for r in rows.collect()}
    assert rows.count() == 60 and got == {i: (10 * i, *found[min(i % 3, 1)]) for i in range(60)}
    assert {(r.match_type, r.n) for r in report.collect()} == {(found[0][3], 20), ("none", 40)}
    whole = [plan for n, plan in made if n == 60]
    assert len(whole) == 2 and not any("asus" in p for p in whole)


def test_memory_is_matched_by_what_is_told(spark, monkeypatch):
    """Equal names that tell other sizes are matched apart, those without a name by what they tell."""
    made = _tables(monkeypatch, integrate, part_match)
    listing = spark.range(60).selectExpr("id", "if(id % 3 = 0, null, 'kit') as name", "'DDR4' as memory_type", "if(id % 3 = 2, null, 3600) as memory_clock", "16 as capacity", "1 as module_count", "id as price")
    bench = spark.createDataFrame([("Crucial DDR4-3600 CL18 16GB", "24.6", 1)], "Bench_Name string, Score string, row int")
    rows, _ = integrate.match_data(listing, [bench], "RAM")
    assert sorted((r.id, r.price, r.match_type, r.bench_score) for r in rows.collect()) == [(i, i, *(("ram_spec_proxy", 25) if i % 3 < 2 else ("none", None))) for i in range(60)]
    assert sum(n == 60 for n, _ in made) == 2
