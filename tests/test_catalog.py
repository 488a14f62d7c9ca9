"""Features on known names, the golden listing, operators on small tables, queries against DuckDB."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from pricewright.functions import text as T
from pricewright.operators import estimates, integrate, matching, quality, stats
from pricewright.plans import catalog_queries, listing_queries, market_queries  # noqa: F401
from pricewright.sources import catalog
from pricewright.streaming import pages

SF = "/root/testdata/sf0.001"


def value(spark, f, x):
    return spark.createDataFrame([(x,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "f,x,want",
    [
        (T.normalize_text, "인텔 코어(울트라7) RTX+5090", "intel core ultra 7 rtx 5090"),
        (T.normalize_text, None, ""),
        (T.cpu_model_key, "AMD 라이젠7-6세대 9800X3D (그래니트 릿지)", "amd-ryzen-7-9800x3d"),
        (T.cpu_model_key, "인텔 코어 울트라7 시리즈2 270K Plus (애로우레이크 리프레시)", "intel-ultra-7-270k-plus"),
        (T.cpu_model_key, "Intel Core i5-12400F", "intel-core-i5-12400f"),
        (T.gpu_model_key, "지포스 RTX 4070 Ti SUPER 16GB", "nvidia-rtx-4070-ti-super"),
        (T.gpu_model_key, "라데온 RX 9070 XT", "amd-rx-9070-xt"),
        (T.gpu_vram_gb, "RTX 4070 D6 12GB", 12),
        (T.ram_ddr_type, "G.Skill F4-3200C16", "DDR4"),
        (T.ram_speed, "G.Skill F4-3200C16", 3200),
        (T.ram_cl, "G.Skill F4-3200C16", 16),
        (T.ram_capacity_gb, "DDR5 8GB 32GB", 32.0),
        (T.capacity_gb, "990 PRO M.2 NVMe (2TB)", 2000),
        (T.normalize_socket, "LGA 1700", "1700"),
        (T.cooler_sockets, "LGA1151, LGA1700 / AM5, AM5", "115X,1700,AMD5"),
        (T.parse_price, "1,234,000원", 1234000),
        (T.parse_price, "-", None),
    ],
)
def test_features(spark, f, x, want):
    assert value(spark, f, x) == want


LISTING = """price,name,brand,product_code,socket_type,memory_type,product_url,created_at
350000,인텔 코어i5-14세대 14400F (벌크),INTEL,11,1700,DDR5,u,2026-01-02 03:04:05
1e5,"AMD 라이젠7 9800X3D, 정품",AMD,12,AMD5,DDR5,u,soon
x,unknown,,13,,,u,
"""


def test_listing_by_name_of_column(spark, tmp_path):
    (tmp_path / "data_CPU.csv").write_text("\ufeff" + LISTING, encoding="utf-8")
    d = catalog.read_listing(spark, f"file://{tmp_path}/data_CPU.csv", "CPU")
    rows = d.collect()
    assert d.columns == catalog.expected("CPU") and [(r.price, r.product_code) for r in rows] == [(350000, 11), (None, 12), (None, 13)]
    assert [str(r.created_at) for r in rows] == ["2026-01-02 03:04:05", "None", "None"] and rows[1].name.endswith(", 정품")
    named = spark.read.option("header", True).csv(f"file://{tmp_path}/data_CPU.csv")
    assert named.where(~T.product_brand(F.col("name"), "CPU").eqNullSafe(F.col("brand"))).count() == 0
    (tmp_path / "data_GPU.csv").write_text("name,price\na,1\n")
    with pytest.raises(ValueError, match="gpu_length.*recommended_power"):
        catalog.read_listing(spark, f"file://{tmp_path}/data_GPU.csv", "GPU")
    assert integrate.name_column(["x", "title"]) == "title"
    assert catalog.insert_after(named, "z", F.lit(1), "price").columns[:3] == ["price", "z", "name"]
    filled = catalog.with_expected(named, "GPU")
    assert filled.columns == catalog.expected("GPU") and filled.where("gpu_length is not null").count() == 0


def test_folder_to_store(spark, tmp_path):
    folder = f"file://{tmp_path}"
    (tmp_path / "data_power.csv").write_text("price,name,size,wattage,product_code,product_url\n50000,a,ATX,600,1,u\n50000,a,SFX,700,2,u\n60000,b,,500,3,u\n70000,c,ATX,6.5,4,u\n0,d,ATX,1,5,u\n\"1,000\",e,ATX,1,6,u\n")
    (tmp_path / "data_Case.csv").write_text("name,price,size,gpu_length,cooler_length,product_code,product_url\nx,1,ATX,300,160,1,u\n")
    (tmp_path / "notes.csv").write_text("a\n1\n")
    tables, unknown = catalog.scan_folder(spark, folder)
    assert sorted(tables) == ["pc_case", "power"] and unknown == ["notes.csv"]
    kept = catalog.storable(tables["power"], "power", ["product_code"]).collect()
    assert [tuple(r) for r in kept] == [("a", 50000, "ATX", 600, "1", "u")]
    assert len(catalog.create_missing(spark, f"{folder}/store")) == 9 and catalog.create_missing(spark, f"{folder}/store") == []
    power = catalog.store_table(spark, f"{folder}/store", "power")
    assert power.publish(catalog.storable(tables["power"], "power", ["product_code"])) == 2
    assert power.read().count() == 1 and power.read(1).count() == 0 and catalog.store_table(spark, f"{folder}/store", "gpu").read().schema == catalog.store_schema("gpu")


def test_ratios_to_store(spark, tmp_path):
    from decimal import Decimal

    eighth = [Decimal("0.125000")] * 8
    schema = "usage string, budget long, " + ", ".join(f"{r} decimal(8,6)" for r in catalog.RATIOS)
    first = spark.createDataFrame([("OFFICE", 500000, *eighth), ("GAMING", 500000, *eighth), ("HIGH_END", 9000000, *eighth)], schema)
    path = f"file://{tmp_path}/ratios"
    assert catalog.load_ratios(spark, first, path).count() == 3
    catalog.write_csv(estimates.cents(first.where("usage != 'OFFICE'").unionByName(spark.createDataFrame([("OFFICE", 1000000, *eighth)], schema)).withColumn("budget", F.col("budget") + F.when(F.col("usage") == "HIGH_END", 1).otherwise(0))), f"{path}-csv")
    again = catalog.read_ratios(spark, f"{path}-csv")
    assert again.where("cpu_ratio != 0.125").count() == 0
    stored = catalog.load_ratios(spark, again, path)
    assert sorted((r.usage, r.budget) for r in stored.collect()) == [("GAMING", 500000), ("HIGH_END", 9000001), ("OFFICE", 500000), ("OFFICE", 1000000)]
    assert stored.select("updated_at").distinct().count() == 2
    with pytest.raises(ValueError, match="HIGH_END: 1"):
        catalog.load_ratios(spark, first.where("usage != 'HIGH_END'"), path)
    bad = spark.createDataFrame([("OFFICE", 1, *([Decimal("0.2")] * 8)), ("OFFICE", 1, *eighth), ("X", -1, *eighth)], schema)
    assert {(r.fault, r.n) for r in estimates.ratio_faults(bad).collect()} == {("SUM", 1), ("DUPLICATE", 1), ("USAGE", 1), ("BUDGET", 1), ("HIGH_END", 1), ("NO_GAMING", 1)}
    assert catalog.store_table(spark, path, catalog.RATIO_TABLE).read().count() == 4


def test_reasons(spark):
    assert value(spark, lambda c: quality.name_reason("RAM", c), "DDR5 On-die ECC 32GB") is None
    assert value(spark, lambda c: quality.name_reason("RAM", c), "DDR5 ECC REG") == "server_or_notebook"
    assert value(spark, lambda c: quality.name_reason("SSD", c), " ") == "invalid"
    assert value(spark, lambda c: quality.price_reason(F.lit("CPU"), c.cast("double")), "10") == "below_min"
    assert value(spark, lambda c: quality.to_integer(c), "1,234") is None and value(spark, lambda c: quality.to_integer(c), "1.5") is None


def test_rounding_sums_to_one(spark):
    d = spark.createDataFrame([(1 / 3, 1 / 3, 1 / 3), (0.1234567, 0.5, 0.3765433)], "a double, b double, c double")
    for r in stats.round_to_one(d, ["a", "b", "c"]).collect():
        assert r.a + r.b + r.c == 1


def test_similarity_and_cascade(spark):
    import difflib

    d = spark.createDataFrame([("p41pl", "p41"), ("sn850x", "sn850")], "a string, b string")
    for r in matching.ratios_by_pair(d, "a", "b").collect():
        assert r.ratio == pytest.approx(difflib.SequenceMatcher(None, r.a, r.b).ratio())
    p = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    one, two = spark.createDataFrame([(1, "x")], "id int, v string"), spark.createDataFrame([(1, "y"), (2, "z")], "id int, v string")
    assert {tuple(r) for r in matching.cascade(p, "id", [("a", one), ("b", two)]).select("id", "v", "tier").collect()} == {(1, "x", "a"), (2, "z", "b"), (3, None, None)}


def test_publish_swaps(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert catalog.publish(spark.range(3), path) and catalog.publish(spark.range(5), path) and not catalog.publish(spark.range(9), path, complete=False)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["t"]


def test_stream_drops_repeated_pages(spark, tmp_path):
    card = '<li id="productItem1" class="x">{}</li>'
    d = spark.createDataFrame([(1, card.format("a"), "2024-01-01 00:00:00"), (2, card.format(" a"), "2024-01-01 00:01:00"), (3, card.format("b"), "2024-01-01 00:02:00"), (4, "<li>c</li>", "2024-01-01 00:02:00"), (5, "", "2024-01-01 00:02:00")], "id int, html string, captured string")
    d.withColumn("captured", F.to_timestamp("captured")).write.parquet(f"{tmp_path}/in")
    q = pages.fresh_pages(spark, f"{tmp_path}/in", "id int, html string, captured timestamp").writeStream.format("memory").queryName("fresh").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.id in (1, 2), r.signature) for r in spark.table("fresh").collect() if r.signature) == [(False, "b"), (True, "a")]
    assert sorted(r.id for r in spark.table("fresh").where("signature is null").collect()) == [4, 5]


@pytest.mark.parametrize("name", sorted(catalog_queries.QUERIES))
def test_query(spark, name):
    got = catalog_queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted(repr(tuple(r)) for r in got.select(*columns).collect())
    if name not in catalog_queries.ORACLES:
        assert rows or name == "fuzzy_family_match"
        return
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    r = con.execute(catalog_queries.ORACLES[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == columns
    assert rows == sorted(repr(tuple(x[names.index(c)] for c in columns)) for x in r.fetchall())
