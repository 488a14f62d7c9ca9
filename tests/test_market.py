"""Parts, cards and estimates: features on known texts, expansion of cards, matching and ratios on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from pricewright.functions import memory, specs
from pricewright.functions import text as T
from pricewright.operators import estimates, part_match, quality, variants
from pricewright.sources import cards, catalog


def value(spark, f, *x):
    names = [f"x{i}" for i in range(len(x))]
    got = spark.createDataFrame([x], ", ".join(f"{n} string" for n in names)).select(f(*[F.col(n) for n in names]).alias("v")).first()[0]
    return json.loads(json.dumps(got.asDict(recursive=True))) if hasattr(got, "asDict") else got


@pytest.mark.parametrize(
    "f,x,want",
    [
        (memory.kit_capacity, "64GB(32Gx2)", 64),
        (memory.kit_capacity, "32GBx2", 64),
        (memory.kit_capacity, "2x32GB", 64),
        (memory.kit_capacity, "96GB(48Gx2)", 96),
        (memory.kit_capacity, "16GB 32GB", None),
        (memory.kit_capacity, None, None),
        (memory.capacity_label, "48GB(24Gx2)", {"gb": 48, "label": "48GB(24Gx2)"}),
        (memory.capacity_label, "2 x 16G", {"gb": 32, "label": "32GB(16Gx2)"}),
        (memory.capacity_label, "none", None),
        (memory.is_unit_price, "26,568원/1GB", True),
        (memory.is_unit_price, "2,550,510원", False),
        (memory.base_name, "G.SKILL DDR5-6000 64GB(32GBx2)", "G.SKILL DDR5-6000"),
        (memory.base_name, "64GB", "64GB"),
        (memory.part_numbers, "G.SKILL DDR4-3200 CL16-18-18 F4-3200C16D-16GVK 3200mhz", ["16-18-18", "f4-3200c16d-16gvk"][1:]),
        (specs.drive_base_name, "WD BLACK SN850X 4TB", "WD BLACK SN850X"),
        (specs.name_drive_capacity, "삼성전자 990 PRO M.2 NVMe (2TB)", 2000),
        (specs.drive_label, "2000", "2TB"),
        (specs.pcie_type, "PCI Express 5.0 x16", "PCIE5.0X16"),
        (specs.recommended_power, "RTX 4070 / 650W 이상", 650),
        (specs.recommended_power, "권장 파워: 1,000W", 1000),
        (specs.recommended_power, "650W 이상", None),
        (quality.is_msata, "M.2 SATA", False),
        (quality.is_msata, "m-SATA 128GB", True),
        (quality.is_benefit, "[ssg.com] i5", True),
        (quality.to_integer, "1,234", None),
        (quality.to_integer, "12.0", 12),
        (quality.score_value, "1,234.5", 1234.5),
        (quality.score_value, "0", None),
        (quality.storage_reason, "중고 SSD 외장 케이스", "used"),
        (quality.storage_reason, "SATA 도킹 스테이션", "accessory"),
        (quality.storage_reason, "Samsung PM9A3 U.2", "enterprise"),
        (T.cpu_model_key, "인텔 코어i5-14세대 14400F", "intel-core-i5-14400f"),
        (T.cpu_model_key, "Intel Processor N100", None),
        (T.cpu_model_key, "Intel Processor 300T", "intel-processor-300t"),
        (T.cpu_model_key, "인텔 제온 E-2336", "intel-xeon-e2336"),
        (T.cpu_model_key, "Intel Xeon E5-2680", None),
        (T.cpu_model_key, "셀러론 G5905", "intel-celeron-g5905"),
        (T.cpu_model_key, "라이젠5 PRO 4650G", "amd-ryzen-5-pro-4650g"),
        (T.cpu_model_key, "스레드리퍼 PRO 5995WX", "amd-threadripper-pro-5995wx"),
        (T.cpu_model_key, "EPYC 7302P", "amd-epyc-7302p"),
        (T.gpu_model_key, "라데온 AI PRO R9700", "amd-ai-pro-r9700"),
        (T.gpu_model_key, "인텔 ARC B580", "intel-arc-b580"),
        (T.gpu_model_key, "지포스 RTX 4090 D", "nvidia-rtx-4090-d"),
        (T.is_mobile, "RTX 4070 노트북", True),
        (T.cooler_sockets, "LGA1151V2 / LGA115X, AM4", "115X,AMD4"),
        (estimates.money, "1,234원", 1234),
        (estimates.money, "1,234원 할인", None),
        (estimates.quantity, "2 EA", 2),
        (estimates.quantity, "33", None),
        (estimates.title_usage, "게이밍 추천PC", "GAMING"),
        (estimates.title_usage, "사무용 게이밍", None),
    ],
)
def test_features(spark, f, x, want):
    if f is specs.drive_label:
        f = lambda c: specs.drive_label(c.cast("int"))
    assert value(spark, f, x) == want


def test_part_tokens_and_brands(spark):
    assert value(spark, lambda c: T.part_tokens(c, "CPU"), "AMD 라이젠7-6세대 9800X3D (정품)") == ["9800x3d", "ryzen"]
    assert value(spark, lambda c: T.chip_brands(c, "GPU"), "지포스 GT 1030") == ["nvidia"]
    assert value(spark, lambda c: T.chip_brands(c, "CPU"), None) == []


@pytest.mark.parametrize(
    "category,name,details,want",
    [
        ("CPU", "x", "소켓: LGA1700 / DDR5, DDR4", {"socket_type": "1700", "memory_type": "DDR5"}),
        ("CPU", "x", "소켓: LGA2011", None),
        ("GPU", "RTX 4070", "PCIe4.0x16 / 650W 이상 / 가로(길이): 304.5mm", {"recommended_power": 650, "pcie_type": "PCIE4.0X16", "gpu_length": 304}),
        ("Mainboard", "B650 DDR5-6000", "소켓 AM5 / DDR5 / M-ATX / 6400MHz", {"socket_type": "AMD5", "memory_type": "DDR5", "pcie_type": None, "size": "MATX", "memory_clock": 6000}),
        ("RAM", "DDR5-6000 32GB(16Gx2)", "램개수: 2개", {"memory_type": "DDR5", "memory_clock": 6000, "capacity": 32, "module_count": 2}),
        ("RAM", "DDR5-6000", "램개수: 2개", None),
        ("SSD", "990 PRO", "저장 용량: 1TB", {"capacity": 1000}),
        ("Power", "850W", "SFX-L / 850W", {"size": "SFXL", "wattage": 850}),
        ("Case", "c", "지원보드규격: E-ATX, M-ATX VGA 길이: 300~410mm CPU 쿨러 높이: 165mm", {"size": "EATX", "gpu_length": 410, "cooler_length": 165}),
        ("Case", "c", "지원보드규격: ATX", None),
        ("Cooler", "공랭 쿨러", "LGA1700, AM5 / 높이: 155mm", {"socket_type": "1700,AMD5", "cooler_length": 155}),
        ("Cooler", "수랭", "LGA1700, AM5 / 높이: 155mm", None),
    ],
)
def test_refined_spec(spark, category, name, details, want):
    assert value(spark, lambda n, d: specs.refined_spec(category, n, d, d), name, details) == want


@pytest.mark.parametrize(
    "f,name,details,want",
    [
        (quality.cooler_reason, "CPU 쿨러", "2U 서버", "server"),
        (quality.cooler_reason, "쿨러 브라켓", "", "accessory"),
        (quality.cooler_reason, "", "x", "invalid"),
        (quality.cooler_reason, "공랭 쿨러", "155mm", None),
        (quality.case_reason, "미들타워", "RISER CABLE 포함", None),
        (quality.case_reason, "라이저 케이블", "", "accessory"),
        (quality.case_reason, "케이스", "4U", "rackmount"),
        (quality.case_reason, "IPC 섀시", None, "rackmount"),
    ],
)
def test_reasons(spark, f, name, details, want):
    assert value(spark, f, name, details) == want


PAGE = """<html><body><ul>
<li id="productItem1" class="prod_item"><p class="prod_name"><a href="//shop.example/info/?pcode=11">G.SKILL DDR5-6000 CL30 TRIDENT 64GB(32GBx2)</a></p>
<div class="spec_list"><a>DDR5</a><span>6000MHz</span><span>램개수: 2개</span></div>
<div class="prod_pricelist"><ul><li><p>64GB(32Gx2)<p class="price_sect"><strong>819,980</strong>원</p><span>12,812원/1GB</span></li>
<li><p>32GB(16Gx2)</p><p class="price_sect"><strong>449,890</strong>원</p></li><li>32GB(16Gx2) <strong>439,890</strong>원</li><li>8GB <strong>100</strong>원</li></ul></div></li>
<li id="productItem2" class="prod_item"><p class="prod_name"><a href="/info/?pcode=12">CORSAIR DDR4-3200 16GB</a></p><div class="spec_list">DDR4 / 램개수: 1개</div><p class="price_sect"><strong>59,000</strong>원</p></li>
<li id="productItem3" class="prod_item ad_prod_item"><p class="prod_name"><a href="/x">AD</a></p></li>
<li id="productItem4" class="prod_item"><p class="prod_name"><a href="javascript:go()">no spec</a></p><p class="price_sect"><strong>1</strong></p></li></ul></body></html>"""
MODERN = """<div class="dnw-product-list-item"><div class="dnw-product-image"><a href="/info/?pcode=77" aria-label="삼성전자 990 PRO M.2 NVMe (4TB) 상세보기"><img alt="x"></a></div>
<div class="dnw-product-info"><a href="/info/?pcode=77">12,000원[혜택]</a> 스펙</div><div data-testid="ProductListPriceCompare"><ul>
<li><span>4TB</span><a aria-label="4TB 891,000원">x</a></li><li><span>2TB</span><a>467,800 원</a></li><li><span>2TB</span> 500,000원 223원/1GB</li><li><span>64GB</span> 20,000원</li></ul></div></div>
<div class="dnw-product-list-item"><div class="dnw-product-image"><img alt="WD BLACK SN850X 1TB"></div><span class="price">99,000원</span><div data-pcode="88"></div></div>
<div class="dnw-product-list-item"><div class="dnw-product-image"><img alt="Drive"></div><span class="price">99,000원</span> 용량: 512GB</div>
<div class="dnw-product-list-item"><div class="dnw-product-image"><img alt="Drive"></div></div>"""


def test_cards(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, MODERN), (3, None), (4, "<li id='productItem9'><b>cut")], "page_id long, html string")
    found = cards.cards(pages)
    ram = variants.listed(found.where("page_id = 1"), "RAM")
    assert [(r.name, r.price, r.code, r.url) for r in ram.orderBy("n").collect()] == [
        ("G.SKILL DDR5-6000 CL30 TRIDENT 64GB(32GBx2)", 819980, "11", "https://shop.example/info/?pcode=11"),
        ("CORSAIR DDR4-3200 16GB", 59000, "12", "https://shop.example/info/?pcode=12"),
        ("no spec", 1, None, None),
    ]
    rows = variants.memory_rows(ram, ["n"]).collect()
    assert [(r.n, r.mode, r.name, r.price, r.capacity, r.module_count) for r in rows] == [
        (0, "multi-option", "G.SKILL DDR5-6000 CL30 TRIDENT (64GB(32Gx2))", 819980, 64, 2),
        (0, "multi-option", "G.SKILL DDR5-6000 CL30 TRIDENT (32GB(16Gx2))", 439890, 32, 2),
        (1, "single", "CORSAIR DDR4-3200 16GB", 59000, 16, 1),
        (2, "spec-missing", None, None, None, None),
    ]
    ssd = variants.listed(found.where("page_id = 2"), "SSD")
    assert [(r.name, r.code) for r in ssd.orderBy("n").collect()] == [("삼성전자 990 PRO M.2 NVMe (4TB)", "77"), ("WD BLACK SN850X 1TB", "88"), ("Drive", None), ("Drive", None)]
    rows = variants.drive_rows(ssd, ["n"]).collect()
    assert [(r.n, r.mode, r.name, r.price, r.capacity) for r in rows] == [
        (0, "multi-option", "삼성전자 990 PRO M.2 NVMe (4TB)", 891000, 4000),
        (0, "multi-option", "삼성전자 990 PRO M.2 NVMe (2TB)", 467800, 2000),
        (1, "single-name", "WD BLACK SN850X 1TB", 99000, 1000),
        (2, "fallback", "Drive (512GB)", 99000, 512),
        (3, "capacity-missing", None, None, None),
    ]
    assert found.where("page_id > 2").count() == 1


DETAIL = """<h1>사무용 추천PC</h1><table><tr><td>menu</td></tr></table><table><tr><th>PC 주요부품</th><th>상품</th><th>개당 가격</th><th>수량</th></tr>
<tr><td>CPU</td><td><a href="#" title="Intel Core i5-14400F">i5</a></td><td>200,000원</td><td><input value="1"></td></tr>
<tr><td>메모리</td><td>DDR5 16GB</td><td>50,000원</td><td>1개</td><tr><td>메모리</td><td>DDR5 8GB</td><td>30,000원</td><td>1개</td></tr>
<tr><td>메인보드</td><td>board</td><td>100,000</td><td>1</td></tr><tr><td>SSD</td><td>disk</td><td>80,000</td><td>1</td></tr>
<tr><td>파워</td><td>power</td><td>60,000</td><td>1</td></tr><tr><td>케이스</td><td>case</td><td>40,000</td><td>1</td></tr><tr><td colspan=4>내장그래픽 기본쿨러</td></tr></table>"""


def test_estimate_pages(spark):
    pages = spark.createDataFrame([(1, DETAIL), (2, "<table><tr><td>x</td></tr></table>"), (3, None)], "page_id long, html string")
    found = cards.part_tables(pages)
    assert [r.page_id for r in found.collect()] == [1]
    lines = estimates.part_lines(found, ["page_id"])
    merged = estimates.merged_parts(lines, ["page_id"])
    got = {r.part: (r.name, r.unit_price, r.quantity, r.price) for r in merged.collect()}
    assert got["RAM"] == ("DDR5 16GB | DDR5 8GB", None, 2, 80000) and got["CPU"] == ("Intel Core i5-14400F", 200000, 1, 200000)
    whole = estimates.build_checked(merged, found.select("page_id", F.lit("OFFICE").alias("usage"), F.col("parts.text").alias("table_text")), ["page_id"]).first()
    assert (whole.reason, whole.parts_total) == (None, 560000) and [p.name for p in whole.p if p.part in ("GPU", "COOLER")] == ["내장그래픽", "CPU 기본 쿨러"]
    gaming = estimates.build_checked(merged, found.select("page_id", F.lit("GAMING").alias("usage"), F.col("parts.text").alias("table_text")), ["page_id"]).first()
    assert gaming.reason == "MISSING_GPU" and gaming.p is None
    items = spark.createDataFrame([(1, '<ul id="recom_search_ul"><li><a href="/p?ProductNo=5">long</a><div class="txt_box"><p class="name"> 게이밍  PC </p></div><ul><li>in</li></ul></li><li>none</li></ul>')], "page_id long, html string")
    assert [(r.item.href, r.item.title) for r in cards.listed_estimates(items).collect()] == [("/p?ProductNo=5", "게이밍 PC")]


def test_estimate_records_round_trip(spark, tmp_path):
    """Pages to lines of 46 cells, written, read back and found valid; every page that gives none says why."""
    title = "<h1 class='x'>{}</h1>"
    pages = spark.createDataFrame([(1, DETAIL), (2, "<table><tr><td>x</td></tr></table>"), (3, None), (4, title.format("게이밍 PC") + DETAIL), (5, title.format("사무용 PC") + DETAIL), (6, DETAIL.replace("사무용 ", ""))], "page_id long, html string")
    items = spark.createDataFrame([(i, "GAMING" if i == 6 else "OFFICE", str(i), f"pc, {i}", f"u{i}") for i in range(1, 8)], "page_id long, usage string, product_id string, product_name string, product_url string")
    found = estimates.records(pages, items)
    assert found.columns == ["page_id", "reason", *estimates.RECORD] and len(estimates.RECORD) == estimates.CELLS
    assert {r.page_id: r.reason for r in found.collect()} == {1: None, 2: "NO_TABLE", 3: "NO_TABLE", 4: "USAGE_CONFLICT", 5: None, 6: "MISSING_GPU", 7: "NO_TABLE"}
    catalog.write_csv(estimates.written_lines(found), f"file://{tmp_path}/e")
    back = estimates.cleaned(estimates.validated(estimates.read_estimates(spark, f"file://{tmp_path}/e"))).collect()
    assert sorted((r.product_id, r.reason, r.budget) for r in back) == [("1", None, 560000), ("5", "DUPLICATE_CONFIG", 560000)] or sorted((r.product_id, r.reason, r.budget) for r in back) == [("1", "DUPLICATE_CONFIG", 560000), ("5", None, 560000)]


def test_estimate_file(spark, tmp_path):
    """Cells by position; the header, in any case, and empty lines are left out; reasons are the first check that fails."""
    parts = [("cpu", "100", "1", "100", "0"), ("gpu", "", "1", "200", "0"), ("board", "50", "1", "50", "0"), ("ram", "20", "2", "40", "0"), ("ssd", "30", "1", "30", "0"), ("power", "10", "1", "10", "0"), ("case", "10", "1", "10", "0"), ("fan", "0", "0", "0", "0")]

    def line(usage="GAMING", pid="1", total="440", change=None):
        cells = [list(p) for p in parts]
        for i, k, v in change or []:
            cells[i][k] = v
        return ",".join([usage, pid, '"a, b"', total, *(c for p in cells for c in p), "u", "d"])

    rows = ["Usage," + ",".join(f"c{i}" for i in range(45)), line(), "", line(pid="1"), line(pid="2"), line("VIDEO"), line(pid="3", total="441"), line(pid="4", total="450"), line(pid="5", change=[(0, 3, "x")]), line(pid="6", change=[(1, 3, "0"), (0, 1, ""), (0, 3, "300")])]
    rows += [line("office", "6", '"4,40"', [(0, 0, " CPU  x")]), line(pid="7", change=[(2, 2, "-1")]), line(pid="8", change=[(2, 3, "0")]), line(pid="9", change=[(3, 1, "25")]), "GAMING,10,short"]
    (tmp_path / "e.csv").write_text("\n".join(rows), encoding="utf-8")
    d = estimates.cleaned(estimates.validated(estimates.read_estimates(spark, f"file://{tmp_path}/e.csv")))
    got = [(r.product_id, r.reason) for r in d.orderBy("row").collect()]
    assert got == [("1", None), ("1", "DUPLICATE_ID"), ("2", "DUPLICATE_CONFIG"), ("1", "USAGE"), ("3", "DUPLICATE_CONFIG"), ("4", "SUM"), ("5", "NUMBER"), ("6", "NO_GPU"), ("6", None), ("7", "NEGATIVE"), ("8", "FREE_MAINBOARD"), ("9", "UNIT_PRICE"), ("10", "CELLS")]


def test_ratio_rows_sum_to_one(spark):
    import random

    r = random.Random(4)
    rows = []
    for i in range(300):
        prices = [r.randrange(1, 400_000) for _ in range(8)]
        rows.append((i, r.choice(["OFFICE", "GAMING"]) if i else "OFFICE", sum(prices), [(p, p) for p in prices]))
    d = spark.createDataFrame(rows, "row long, usage string, budget long, parts array<struct<unit_price:long,price:long>>")
    table = estimates.ratio_table(d)
    got = table.collect()
    assert len(got) > 6 and all(sum(x[c] for c in estimates.RATIOS) == 1 for x in got)
    office = {tuple(x[c] for c in estimates.RATIOS) for x in got if x.usage == "OFFICE"}
    assert len(office) == 1
    budgets = [b for _, u, b, _ in rows if u == "GAMING"]
    points = sorted(x.budget for x in got if x.usage == "GAMING")
    assert points[0] == -(-min(budgets) // 500_000) * 500_000 and points[-1] == max(budgets) // 500_000 * 500_000
    lone = spark.createDataFrame([(1, "GAMING", 700_001), (2, "GAMING", 800_000)], "row long, usage string, budget long")
    assert [x.point for x in estimates.budget_points(lone).collect()] == [1_000_000]
    best = spark.createDataFrame([(300, 500, 100, 80, 90, 70, 60, 30)], ", ".join(f"{p.lower()}_price long" for p in estimates.PARTS))
    one = estimates.high_end(best).first()
    assert one.budget == 1230 and sum(one[c] for c in estimates.RATIOS) == 1 and one.gpu_ratio > 0


def test_samples_against_all_pairs(spark):
    import random

    from pricewright.operators import stats

    r = random.Random(8)
    rows = [(i, r.choice("ab"), r.choice([r.randrange(0, 30_000), r.randrange(10_000, 10_400)])) for i in range(400)] + [(900, "c", 5)]
    d = spark.createDataFrame(rows, "id long, usage string, budget long")
    grid = spark.createDataFrame([(u, p) for u in "abcd" for p in (-5000, 0, 1000, 10_000, 10_137, 25_000, 90_000)], "usage string, point long")
    for radius, least, nearest in ((500, 8, 12), (100, 3, 3)):
        want = set()
        for u in "abc":
            for p in (-5000, 0, 1000, 10_000, 10_137, 25_000, 90_000):
                own = sorted((abs(b - p), b, i) for i, v, b in rows if v == u)
                near = [x for x in own if x[0] <= radius]
                want |= {(u, p, i) for _, _, i in (near if len(near) >= least else own[:nearest])}
        got = stats.samples(d, grid, "usage", "budget", "id", radius, least, nearest).select("usage", "point", "id").collect()
        assert len(got) == len(want) and {tuple(x) for x in got} == want


def test_memory_match(spark):
    bench = [("G.Skill F4-3200C16-8GVK 8GB", "12"), ("Kingston KVR DDR4 2666 8GB", "8"), ("Corsair DDR4-3200 CL18 8GB", "14"), ("Crucial DDR4-3200 CL22 8GB", "10"), ("bad", "x")]
    b = spark.createDataFrame(bench, "name string, score string")
    rows = [(1, "G.SKILL RIPJAWS F4-3200C16-8GVK", None, None, None, None), (2, "Corsair VENGEANCE", "DDR4", 3200, 16, 2), (3, "ADATA DDR4-3200 8GB", None, None, None, None), (4, "ADATA DDR5-6000 8GB", None, None, None, None), (5, None, None, None, None, None)]
    p = spark.createDataFrame(rows, "id long, name string, memory_type string, memory_clock int, capacity int, module_count int")
    got = {r.id: (r.tier, r.bench_name, r.bench_score, r.match_score) for r in part_match.match_memory(p, b, "id", "name", "name", "score", memory_type="memory_type", memory_clock="memory_clock", capacity="capacity", module_count="module_count").collect()}
    assert got[1] == ("ram_direct", "G.Skill F4-3200C16-8GVK 8GB", 12.0, 600)
    assert got[2] == ("ram_spec_proxy", "Corsair DDR4-3200 CL18 8GB", 14.0, 350)
    assert got[3] == ("ram_spec_proxy", "G.Skill F4-3200C16-8GVK 8GB", 12.0, 300)
    assert got[4] == got[5] == (None, None, None, None)


def test_chip_match(spark):
    b = spark.createDataFrame([("AMD Ryzen 7 9800X3D", "40,000"), ("AMD Ryzen 7 9800X3D 8-Core", "39000"), ("Intel Core i7-13700H Laptop", "1"), ("x", None)], "name string, score string")
    p = spark.createDataFrame([(1, "AMD 라이젠7-6세대 9800X3D"), (2, "인텔 코어 i7-13700H"), (3, None)], "id long, title string")
    got = {r.id: (r.bench_name, r.bench_score, r.match_score) for r in part_match.match_chips(p, b, "CPU", "id", "title", "name", "score").collect()}
    assert got == {1: ("AMD Ryzen 7 9800X3D", 40000.0, 102), 2: (None, None, None), 3: (None, None, None)}
    rate = part_match.match_rate(part_match.match_chips(p.withColumn("one", F.lit(1)), b, "CPU", "id", "title", "name", "score"), "one").first()
    assert (rate.n, rate.matched, rate.rate) == (3, 1, 33.33)
