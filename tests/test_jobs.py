"""Whole jobs and what they rest on: listings with counters, line numbers over files, exact orders, versions of tables, page
streams, strong builds, against brute force."""

import itertools
import os
import random
import statistics
import threading
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.folders import kept, scratch, shared_folder, stored
from pricewright.operators import builds, estimates, integrate, listing, ordered
from pricewright.plans import listing_queries as L
from pricewright.sources import catalog, versions
from pricewright.sources.cards import signature
from pricewright.streaming import pages as P

# Line numbers and orders


def test_lines_are_numbered_over_files_however_they_are_split(spark, tmp_path):
    """Three files of different sizes, in blocks of a few KB: numbers follow names and lines, and so does keep-first."""
    lines, folder = [], tmp_path / "in"
    folder.mkdir()
    for name, n in (("c.csv", 50), ("a.csv", 900), ("b.csv", 300)):
        rows = [f"{name[0]}{i},{'x' * (i % 40)}" for i in range(n)]
        (folder / name).write_text("\n".join(rows) + "\n")
    for name in ("a", "b", "c"):
        lines += [x for x in (folder / f"{name}.csv").read_text().split("\n") if x]
    want = {x.split(",")[0]: i for i, x in enumerate(lines)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2k", "5k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            d = ordered.numbered_lines(spark.read.schema("k string, v string").csv(f"file://{folder}"), "row")
            assert {r.k: r.row for r in d.collect()} == want, size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_first_estimate_stays_over_files(spark, tmp_path):
    """Of one id in three files the first line of the file whose name is first stays."""
    cells = lambda i, price: ["OFFICE", "1", f"pc{i}", str(8 * price), *[x for p in range(8) for x in (f"part{i}", str(price), "1", str(price), "0")], "u", "d"]
    for name, i in (("z.csv", 1), ("m.csv", 2), ("b.csv", 3)):
        (tmp_path / name).write_text("usage" + ",x" * 45 + "\n" + ",".join(cells(i, 1000 + i)) + "\n\n")
    d = estimates.cleaned(estimates.validated(estimates.read_estimates(spark, f"file://{tmp_path}")))
    assert [r.product_name for r in d.where("reason is null").collect()] == ["pc3"] and d.where("reason = 'DUPLICATE_ID'").count() == 2


def test_parsing_stands_once_in_the_plan(spark):
    """No rule brings the parsing of the cells with it."""
    d = estimates.cleaned(estimates.validated(spark.createDataFrame([(0, *["x"] * 46)], "row long, " + ", ".join(f"_c{i} string" for i in range(46)))))
    plan = d.where("reason is null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 60


@pytest.mark.parametrize("n", [1, 2, 7, 5000])
def test_quantiles(spark, n):
    """Ties, even counts, one value for a third of the rows, nulls; several groups and none."""
    rng = random.Random(n)
    rows = [(g, None if i % 50 == 49 else 7.0 if i % 3 == 0 else float(rng.randint(0, 40)) if g == "a" else rng.gauss(0, 1000)) for g in ("a", "b", None) for i in range(n)]
    d = spark.createDataFrame(rows, "g string, v double").repartition(5)
    at = {"low": 0.02, "mid": 0.5, "high": 0.98, "least": 0.0, "most": 1.0}
    got = {r.g: r for r in ordered.exact_quantiles(d, ["g"], "v", at).collect()}
    for g in ("a", "b", None):
        vs = [v for h, v in rows if h == g and v is not None]
        assert got[g].n == len(vs)
        for k, p in at.items():
            assert got[g][k] == pytest.approx(float(np.quantile(vs, p)), abs=1e-9), (g, k)
    every = ordered.exact_quantiles(d, [], "v", {"mid": 0.5}).collect()
    assert len(every) == 1 and every[0].mid == pytest.approx(statistics.median(v for _, v in rows if v is not None))


def test_running_sums(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["x", "y", None]), rng.randint(0, 300), rng.randint(0, 9), i) for i in range(2000)]
    d = spark.createDataFrame(rows, "g string, v int, w int, i int").repartition(6)
    got = {r.i: r.before for r in ordered.running_sum(d, ["g"], ["v", "i"], F.col("w"), "before").collect()}
    sums, want = {}, {}
    for g, _, w, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[3])):
        want[i] = sums.get(g, 0)
        sums[g] = want[i] + w
    assert got == want


# Listings


@pytest.mark.parametrize("category", sorted(L.SOUND))
def test_counters_add_up(spark, category):
    pages = L.made(spark, "/root/testdata/sf0.001", L.pages(category))
    rows, counts = listing.saved_pages(pages, category)
    d = L.listing._judged(pages, category, "page_id", "html", "https://x.example")
    fates = {r.fate: r["count"] for r in d.groupBy("fate").count().collect()}
    assert counts["cards"] == sum(fates.values()) == 200 and counts["kept_products"] == fates.get(None, 0)
    assert listing.removed(counts) == sum(n for f, n in fates.items() if f)
    assert rows.count() == counts["rows_after"] <= counts["rows_before"] and rows.columns == catalog.expected(category)


def test_listing_of_nothing(spark):
    rows, counts = listing.saved_pages(spark.createDataFrame([(1, None), (2, "<li>x</li>")], "page_id int, html string"), "GPU")
    assert rows.count() == 0 and set(counts.values()) == {0}


# Pages


def page(*texts, modern=False):
    if modern:
        return "".join(f'<div data-x="1" class="a dnw-product-list-item b"><p>{t}</p></div>' for t in texts)
    return "<ul>" + "".join(f'<li class="prod_item" id="productItem{i}">{t}</li>' for i, t in enumerate(texts)) + "</ul>"


def test_signatures(spark):
    """Attributes and the modern layout count; pages without cards have none."""
    htmls = [page("a", "b"), page("a", "c"), page("a", "b", modern=True), page("c", modern=True), "<li>a</li>", "", None, page(*"abcdefghij"), page(*"abcdefghxy"), page("x" * 200 + "1"), page("x" * 200 + "2")]
    d = spark.createDataFrame(list(enumerate(htmls)), "i int, html string")
    got = [r.s for r in d.select("i", signature(F.col("html")).alias("s")).orderBy("i").collect()]
    assert got[0] == got[2] == "a||b" and got[1] == "a||c" and got[3] == "c" and got[4:7] == [None] * 3 and got[7] == got[8] and got[9] == got[10]
    kept = P.distinct_pages(d.withColumn("job", F.lit(1)), "job", ["i"])
    assert sorted(r.i for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 9]


def test_page_stream_with_restart(spark, tmp_path):
    """A repeat, in the same batch or after a restart, asks for the next way; state goes when its time is over."""
    schema = "job string, page long, attempt int, html string, captured timestamp"
    at = lambda m: datetime(2026, 1, 1, 10, m)

    def run(rows, late=False):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        d = P.page_verdicts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), keep=600, delay="1 minute")
        q = d.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").outputMode("append").start(f"{tmp_path}/out")
        q.processAllAvailable()
        q.stop()
        return {(r.job, r.page, r.attempt): (r.verdict, r.next_way) for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    got = run([("cpu", 1, 0, page("a"), at(0)), ("cpu", 2, 0, page("a"), at(1)), ("gpu", 1, 0, page("a"), at(1)), ("cpu", 3, 0, "<li>none</li>", at(1)), ("cpu", 4, 3, None, at(1))])
    assert got == {("cpu", 1, 0): ("saved", None), ("cpu", 2, 0): ("repeat", "turned"), ("gpu", 1, 0): ("saved", None), ("cpu", 3, 0): ("empty", "turned"), ("cpu", 4, 3): ("lost", None)}
    got = run([("cpu", 2, 1, page("a"), at(2)), ("cpu", 1, 1, page("a"), at(2)), ("cpu", 2, 2, page("b", modern=True), at(3)), ("cpu", 5, 3, page("a"), at(3))])
    assert got["cpu", 2, 1] == ("repeat", "captured again") and got["cpu", 1, 1] == ("again", None) and got["cpu", 2, 2] == ("saved", None) and got["cpu", 5, 3] == ("lost", None)
    run([("x", 1, 0, page("z"), at(40))])  # the watermark passes, so the states of the first pages go
    got = run([("x", 2, 0, page("y"), at(41)), ("cpu", 9, 0, page("a"), at(41))])
    assert got["cpu", 9, 0] == ("saved", None)


# Tables in versions


def test_readers_beside_a_writer(spark, tmp_path):
    table = versions.Table(spark, f"file://{tmp_path}/t", spark.range(1).selectExpr("id", "id as version").schema, versions.not_null(["id"]))
    assert table.create() and not table.create()
    stop, seen = threading.Event(), []

    def read():
        while not stop.is_set():
            rows = versions.Table(spark, f"file://{tmp_path}/t").read().collect()
            seen.append(({r.version for r in rows}, len(rows)))

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 9):
        assert table.publish(spark.range(100 * v, numPartitions=3).selectExpr("id", f"{v}L as version")) == v + 1
    stop.set()
    reader.join()
    assert seen and all(n == 0 or (len(vs) == 1 and n == 100 * min(vs)) for vs, n in seen)
    assert table.clean(2) == [1, 2, 3, 4, 5, 6, 7] and table.versions() == [8, 9] and table.read().count() == 800


def test_second_writer_is_refused(spark, tmp_path):
    """Ten writers come from the same version: one publishes, the others leave no data behind."""
    path = f"file://{tmp_path}/t"
    versions.Table(spark, path).publish(spark.range(1))
    out = []

    def write(i):
        try:
            out.append(versions.Table(spark, path).publish(spark.range(i, i + 1), base=1))
        except versions.Conflict:
            out.append(None)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(10, 20)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(out, key=str) == [2] + [None] * 9
    assert len([x for x in (tmp_path / "t" / "data").iterdir() if x.is_dir()]) == 2 and versions.Table(spark, path).read().first().id in range(10, 20)


def test_constraints(spark, tmp_path):
    eighth = ", ".join(f"0.125 as {r}" for r in estimates.RATIOS)
    good = spark.sql(f"select 'OFFICE' as usage, 1 as budget, {eighth}, current_timestamp() as updated_at")
    table = catalog.store_table(spark, f"file://{tmp_path}", catalog.RATIO_TABLE)
    assert table.publish(good) == 1
    bad = [good.withColumn("budget", F.lit(0)), good.unionByName(good), good.withColumn("usage", F.lit(None).cast("string")), good.withColumn("cpu_ratio", F.lit(0.2)), good.withColumn("cpu_ratio", F.lit(1.1)).withColumn("gpu_ratio", F.lit(-0.85))]
    names = [["CHECK budget > 0"], ["UNIQUE usage, budget"], ["NOT NULL usage"], ["CHECK ratios add up to 1"], ["CHECK ratios between 0 and 1"]]
    for d, want in zip(bad, names, strict=True):
        with pytest.raises(versions.Broken) as e:
            table.publish(d)
        assert list(e.value.counts) == want
    assert table.versions() == [1] and table.read().count() == 1 and len(list((tmp_path / catalog.RATIO_TABLE / "data").iterdir())) == 1
    assert len(catalog.create_missing(spark, f"file://{tmp_path}")) == 8


def test_a_folder_is_loaded_past_a_failure(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "data_power.csv").write_text("name,price,size,wattage,product_code,product_url\na,50000,ATX,600,1,u\na,50000,SFX,700,2,u\n")
    (folder / "integrated_SSD.csv").write_text("name,price\nx,1\n")
    (folder / "data_Case.csv").write_text("name,price,size,gpu_length,cooler_length,product_code,product_url\nx,1,ATX,300,160,1,u\n")
    (folder / "notes.csv").write_text("a\n1\n")
    with pytest.raises(catalog.LoadFailed) as e:
        catalog.load_folder(spark, f"file://{folder}", f"file://{tmp_path}/store")
    assert list(e.value.failures) == ["integrated_SSD.csv"]
    assert catalog.store_table(spark, f"file://{tmp_path}/store", "pc_case").read().count() == 1
    (folder / "integrated_SSD.csv").unlink()
    done = catalog.load_folder(spark, f"file://{folder}", f"file://{tmp_path}/store")
    assert done == [("data_Case.csv", "pc_case", 1, 1), ("data_power.csv", "power", 2, 1)]
    power = catalog.store_table(spark, f"file://{tmp_path}/store", "power").read()
    assert power.first().product_code == "1"
    told = {r.column: r for r in catalog.profile(power.unionByName(power), ["name", "price"]).collect()}
    assert (told["wattage"].low, told["wattage"].high, told["wattage"].distinct, told["wattage"].nulls) == ("600", "600", 1, 0) and told["name, price"].nulls == 1


# Builds


def brute_build(p, cpu_score, gpu_score):
    best = None
    rank = builds.SIZES.index
    for c, m, r, f in itertools.product(p["cpu"], p["mainboard"], p["ram"], p["cooler"]):
        if c["score"] < cpu_score or c["socket"] != m["socket"] or not c["memory"] == m["memory"] == r["memory"]:
            continue
        if {"1151V2": "115X"}.get(c["socket"], c["socket"]) not in [x.strip() for x in f["socket"].split(",")]:
            continue
        for k, g, w in itertools.product(p["case"], p["gpu"], p["power"]):
            if g["score"] >= gpu_score and rank(m["size"]) <= rank(k["size"]) and g["length"] <= k["gpu_length"] and f["cooler_length"] <= k["cooler_length"] and w["wattage"] >= g["power"]:
                total = sum(x["price"] for x in (c, m, r, f, k, g, w)) + min(x["price"] for x in p["ssd"])
                best = total if best is None else min(best, total)
    return best


@pytest.mark.parametrize("seed", range(4))
def test_strong_build_against_all_builds(spark, seed):
    rng = random.Random(seed)
    price = lambda: rng.randint(1, 400) if seed else rng.randint(1, 5)
    socket, memory, size = (lambda: rng.choice(["1700", "AMD5", "1151V2"])), (lambda: rng.choice(["DDR4", "DDR5"])), (lambda: rng.choice(builds.SIZES))
    rows = {
        "cpu": [{"socket": socket(), "memory": memory(), "score": rng.uniform(0, 100)} for _ in range(8)],
        "mainboard": [{"socket": socket(), "memory": memory(), "size": size()} for _ in range(10)],
        "ram": [{"memory": memory()} for _ in range(4)],
        "ssd": [{} for _ in range(3)],
        "cooler": [{"socket": rng.choice(["1700,AMD5", "115X", "AMD5, 115X", "1700"]), "cooler_length": rng.randint(100, 170)} for _ in range(6)],
        "case": [{"size": size(), "gpu_length": rng.randint(200, 400), "cooler_length": rng.randint(110, 180)} for _ in range(6)],
        "gpu": [{"length": rng.randint(180, 380), "power": rng.choice([400, 550, 700]), "score": rng.uniform(0, 100)} for _ in range(6)],
        "power": [{"wattage": rng.choice([450, 550, 600, 700, 850])} for _ in range(5)],
    }
    for part, xs in rows.items():
        for i, x in enumerate(xs):
            x |= {"name": f"{part}{i}", "price": price()}
    parts = {k: spark.createDataFrame(xs) for k, xs in rows.items()}
    parts["case"] = parts["case"].unionByName(spark.createDataFrame([{"name": "odd", "price": None, "size": "ATX", "gpu_length": 999, "cooler_length": 999}, {"name": "odd2", "price": 0, "size": "XXL", "gpu_length": 999, "cooler_length": None}], parts["case"].schema))
    for least in (0, 40, 101):
        got = builds.cheapest_strong_build(parts, least, least).collect()
        want = brute_build(rows, least, least)
        assert [r.total_price for r in got] == ([] if want is None else [want])
        for r in got:
            one = {p: next(x for x in rows[p] if x["name"] == r[f"{p}_name"]) for p in builds.PARTS}
            assert brute_build({p: [x] for p, x in one.items()}, least, least) == want and all(one[p]["price"] == r[f"{p}_price"] for p in one)
            ratios = estimates.high_end(spark.createDataFrame([r])).first()
            assert ratios.budget == want and sum(ratios[x] for x in estimates.RATIOS) == 1


def test_a_board_may_be_smaller_than_the_case_takes(spark):
    one = {"cpu": "socket string, memory string, score int", "mainboard": "socket string, memory string, size string", "ram": "memory string", "ssd": "", "cooler": "socket string, cooler_length int", "case": "size string, gpu_length int, cooler_length int", "gpu": "length int, power int, score int", "power": "wattage int"}
    of = {"cpu": ("1700", "DDR5", 9), "mainboard": ("1700", "DDR5", "MATX"), "ram": ("DDR5",), "ssd": (), "cooler": ("1700", 150), "case": ("ATX", 300, 160), "gpu": (300, 500, 9), "power": (500,)}
    parts = {k: spark.createDataFrame([("n", 10, *of[k])], "name string, price int" + (f", {s}" if s else "")) for k, s in one.items()}
    assert builds.cheapest_strong_build(parts, 1, 1).first().total_price == 80
    assert builds.cheapest_strong_build(parts | {"case": parts["case"].withColumn("size", F.lit("ITX"))}, 1, 1).count() == 0


# Listings with scores


def test_memory_is_integrated_by_every_tier(spark):
    """A direct part, a proxy by specification, an estimate and none; the first of a name's benchmarks counts, readable or not; tables
    between steps are gone."""
    bench = [("G.Skill F4-3200C16D-107GVK 16GB", "30.4", 1), ("G.Skill F4-3200C16D-107GVK 16GB", "99", 2), ("Corsair DDR4-3200 CL16 16GB", "n/a", 1), ("Corsair DDR4-3200 CL16 16GB", "20", 2), ("Crucial DDR4-3600 CL18 16GB", "24.6", 3)]
    bench += [(f"Kingston DDR4-{s} CL{c} {g}GB kit{i}", str(10 + i % 9), 4 + i) for i, (s, c, g) in enumerate(itertools.product([2666, 3200], [14, 16, 18, 20, 22], [8, 32, 4, 64, 128, 2]))]
    lists = [spark.createDataFrame(bench, "Bench_Name string, Score string, row int")]
    rows = [("G.SKILL RIPJAWS F4-3200C16D-107GVK", None, None, None, 1), ("Some maker kit", "DDR4", 3600, 16, 1), ("ADATA DDR5", "DDR5", 6000, 16, 1), ("nothing", None, None, None, 1)]
    d = spark.createDataFrame(rows, "title string, memory_type string, memory_clock int, capacity int, module_count int").withColumns({"price": F.lit(5), "bench_score": F.lit("old")})
    shared = shared_folder(spark).removeprefix("file:").replace("///", "/")
    before = set(os.listdir(shared))
    got, told = integrate.match_data(d, lists, "RAM")
    assert got.columns == ["title", "memory_type", "memory_clock", "capacity", "module_count", "price", "bench_score", *integrate.FOUND]
    found = {r.title: (r.match_type, r.bench_score, r.bench_name) for r in got.collect()}
    assert found["G.SKILL RIPJAWS F4-3200C16D-107GVK"] == ("ram_direct", 30, "G.Skill F4-3200C16D-107GVK 16GB")
    assert found["Some maker kit"] == ("ram_spec_proxy", 25, "Crucial DDR4-3600 CL18 16GB")
    assert found["ADATA DDR5"][0] == "ram_spec_estimate" and found["ADATA DDR5"][2] == integrate.ESTIMATED and found["nothing"] == ("none", None, None)
    assert {(r.match_type, r.n, r.rate) for r in told.collect()} == {(k, 1, 25.0) for k in ("ram_direct", "ram_spec_proxy", "ram_spec_estimate", "none")}
    assert len([x for x in set(os.listdir(shared)) - before if x.startswith("market-")]) == 1


def test_brands_stand_after_the_price(spark):
    d = spark.createDataFrame([("ASUS 지포스 RTX 4070", 5, 1), ("MSI Radeon RX 7600", 6, 2), ("board", 7, 3)], "`제품명` string, price int, more int")
    got = integrate.with_brands(d, "GPU")
    assert got.columns == ["제품명", "price", "brand", "chipset_brand", "more"]
    assert [(r.brand, r.chipset_brand) for r in got.collect()] == [("ASUS", "NVIDIA"), ("MSI", "AMD"), (None, None)]
    assert integrate.with_brands(d, "Mainboard").columns == ["제품명", "price", "brand", "more"] and integrate.with_brands(d, "Case").columns == d.columns
    with pytest.raises(ValueError, match="no benchmarks"):
        integrate.match_data(d, [], "Case")


def test_files_begin_with_a_byte_order_mark(spark, tmp_path):
    d = spark.createDataFrame([("가, \"b\"", 1), ("c", 2)], "name string, n int").repartition(2)
    catalog.write_csv(d, f"file://{tmp_path}/m")
    files = list((tmp_path / "m").glob("part-*"))
    assert files and all(f.read_bytes().startswith(b"\xef\xbb\xbfname,n\n") for f in files)
    got = catalog.read_text(spark, f"file://{tmp_path}/m", ["name", "n"], strict=True)
    assert sorted(tuple(r) for r in got.collect()) == [("c", "2"), ("가, \"b\"", "1")]
    catalog.write_csv(d, f"file://{tmp_path}/p", marked=False)
    assert all(f.read_bytes().startswith(b"name,n\n") for f in (tmp_path / "p").glob("part-*"))


def test_folders_where_none_is_named(tmp_path):
    """In one process a temporary folder serves, always the same one; on a cluster that is an error."""
    from types import SimpleNamespace

    def session(master, path=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: path), sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))

    one = shared_folder(session("local[2]"))
    assert one == shared_folder(session("local[2]")) and os.path.isdir(one.removeprefix("file://"))
    assert shared_folder(session("spark://x", "hdfs://shared/")) == "hdfs://shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://x"))


def test_scratch_leaves_what_is_kept(spark):
    shared = shared_folder(spark).removeprefix("file:").replace("///", "/")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    with scratch(spark) as made:
        stored(spark.range(3))
        d = kept(made, stored(spark.range(5)))
    assert d.count() == 5 and len(set(os.listdir(shared)) - before) == 1
