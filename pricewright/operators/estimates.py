"""From estimates of whole builds to budget ratios: scan, validation with reasons, dedup, samples, blend, rounding, checks.

An estimate is a line of 46 cells: usage, product id, product name, total, eight groups of five cells (name, unit price,
quantity, price, ratio), url, date. A row that fails a check keeps the first reason; reports are one aggregate of it.

Samples don't pair estimates with grid points, see stats.samples(); OFFICE blends all of its estimates, once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.functions.text import normalize_name, once, squeeze
from pricewright.folders import stored
from pricewright.sources.cards import part_tables

from .ordered import exact_quantiles, numbered_lines
from .stats import kernel, round_to_one, samples

#: The parts of a build in order, the usages that estimates and ratios have, in order.
PARTS = ["CPU", "GPU", "MAINBOARD", "RAM", "SSD", "POWER", "CASE", "COOLER"]
ESTIMATED_USAGES = ["OFFICE", "GAMING"]
RATIO_USAGES = ["OFFICE", "GAMING", "HIGH_END"]
MAY_BE_FREE = ["GPU", "COOLER"]
CELLS, FIRST_PART, PART_CELLS = 46, 4, 5
STEP, RADIUS, LEAST_LOCAL, NEAREST, TOLERANCE, MEAN_SHARE = 500_000, 250_000, 8, 12, 1, 0.6
RATIOS = [f"{p.lower()}_ratio" for p in PARTS]
#: Words of titles that tell a usage.
USAGE_WORDS = {"OFFICE": ["사무용", "업무용", "오피스용"], "GAMING": ["게이밍", "게임용"], "VIDEO_EDITING": ["영상편집", "영상 편집", "이미지/영상편집", "영상작업"]}
#: Parameters of an address that hold a product's number.
ID_PARAMETERS = ["ProductNo", "productNo"]
#: What must be in a build, and what a page says where a part is built in or comes along.
REQUIRED = ["CPU", "MAINBOARD", "RAM", "SSD", "POWER", "CASE"]
BUILT_IN_GRAPHICS = r"(?i)내장\s*(그래픽|VGA)"
BUNDLED_COOLER = r"(?i)기본\s*쿨러|번들\s*쿨러|쿨러\s*포함|쿨러포함"


def read_estimates(spark: SparkSession, path: str) -> DataFrame:
    """_c0 to _c45 and row: cells by position; header and empty lines are left out. Lines are numbered over all files in order of
    the files' names, for keep-first rules, however the files are split."""
    schema = ", ".join(f"_c{i} string" for i in range(CELLS))
    d = numbered_lines(spark.read.schema(schema).option("header", False).option("multiLine", False).csv(path), "row")
    first = F.lower(F.trim(F.coalesce("_c0", F.lit(""))))
    some = F.coalesce(*[F.col(f"_c{i}") for i in range(CELLS)]).isNotNull()
    return d.where(some & (first != "usage"))


def whole(cell: Column) -> Column:
    """A cell's number without commas, cut to whole; null where there is none."""
    return F.replace(F.trim(cell), F.lit(","), F.lit("")).try_cast("decimal(38,6)").cast("bigint")


def validated(rows: DataFrame) -> DataFrame:
    """row, usage, product_id, product_name, budget, parts (array of struct part, name, unit_price, quantity, price), reason:
    null or the first check that fails: CELLS, USAGE, NUMBER, TOTAL, NEGATIVE, FREE_<part>, UNIT_PRICE, SUM, NO_GPU."""
    at = lambda i: F.col(f"_c{i}")
    parts = []
    for i, part in enumerate(PARTS):
        k = FIRST_PART + PART_CELLS * i
        told = F.trim(F.coalesce(at(k + 1), F.lit(""))) != ""
        parts.append(F.struct(F.lit(part).alias("part"), F.trim(F.coalesce(at(k), F.lit(""))).alias("name"), whole(at(k + 1)).alias("unit_price"), whole(at(k + 2)).alias("quantity"), whole(at(k + 3)).alias("price"), told.alias("told")))
    d = rows.select("row", F.upper(F.trim("_c0")).alias("usage"), F.trim("_c1").alias("product_id"), F.trim("_c2").alias("product_name"), whole(at(3)).alias("budget"), F.array(*parts).alias("parts"), at(CELLS - 1).isNull().alias("_short"))
    price = F.transform("parts", lambda p: p.price)
    total = F.aggregate(price, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    number = F.exists("parts", lambda p: p.quantity.isNull() | p.price.isNull() | (p.told & p.unit_price.isNull()))
    apart = F.exists("parts", lambda p: p.told & (F.abs(p.unit_price * p.quantity - p.price) > TOLERANCE))
    checks = [
        ("CELLS", F.col("_short") & F.element_at("parts", -1)["price"].isNull()),
        ("USAGE", ~F.col("usage").isin(ESTIMATED_USAGES) | F.col("usage").isNull()),
        ("NUMBER", F.col("budget").isNull() | number),
        ("TOTAL", F.col("budget") <= 0),
        ("NEGATIVE", F.exists("parts", lambda p: (p.quantity < 0) | (p.price < 0))),
        *[(f"FREE_{part}", F.get(price, i) == 0) for i, part in enumerate(PARTS) if part not in MAY_BE_FREE],
        ("UNIT_PRICE", apart),
        ("SUM", F.abs(total - F.col("budget")) > TOLERANCE),
        ("NO_GPU", (F.col("usage") == "GAMING") & (F.get(price, PARTS.index("GPU")) <= 0)),
    ]
    reason = F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in checks])
    # Written: a filter on the reason would else be pushed down with the parsing of all cells behind each check.
    return stored(d.withColumn("reason", reason).withColumn("parts", F.transform("parts", lambda p: p.dropFields("told"))).drop("_short"))


def config(parts: Column) -> Column:
    """What two builds of equal parts share: names squeezed and in lower case, prices, quantities."""
    return F.transform(parts, lambda p: F.struct(normalize_name(p["name"]).alias("name"), p.price.alias("price"), p.quantity.alias("quantity")))


def cleaned(valid: DataFrame) -> DataFrame:
    """`valid` with reason set to DUPLICATE_ID for all but the first row of an id within a usage, then DUPLICATE_CONFIG for all but the first
    of the same parts. First rows are found by aggregates, so a hot id or build isn't gathered."""
    ok = valid.where("reason is null")
    first = ok.groupBy(F.col("usage").alias("_u"), F.col("product_id").alias("_p")).agg(F.min("row").alias("_first"))
    d = valid.join(first, F.col("reason").isNull() & (F.col("usage") == F.col("_u")) & F.col("product_id").eqNullSafe(F.col("_p")), "left")
    d = d.withColumn("reason", F.when(F.col("row") > F.col("_first"), "DUPLICATE_ID").otherwise(F.col("reason"))).drop("_u", "_p", "_first")
    key = F.sha2(F.to_json(F.struct("usage", config(F.col("parts")).alias("c"))), 256)
    d = stored(d.withColumn("_key", key))
    first = d.where("reason is null").groupBy(F.col("_key").alias("_k")).agg(F.min("row").alias("_first"))
    d = d.join(first, F.col("reason").isNull() & (F.col("_key") == F.col("_k")), "left")
    return d.withColumn("reason", F.when(F.col("row") > F.col("_first"), "DUPLICATE_CONFIG").otherwise(F.col("reason"))).drop("_key", "_k", "_first")


def shares(estimates: DataFrame) -> DataFrame:
    """row, usage, budget and the share of each part in the budget."""
    return estimates.select("row", "usage", "budget", *[(F.get("parts", i)["price"] / F.col("budget")).alias(r) for i, r in enumerate(RATIOS)])


def budget_points(estimates: DataFrame, step: int = STEP) -> DataFrame:
    """usage, point: multiples of the step, for OFFICE from under the least budget to over the largest, else from over the
    least to under the largest; where that leaves none, the one nearest the median (half to even), one step at least."""
    r = exact_quantiles(estimates, ["usage"], "budget", {"lo": 0.0, "hi": 1.0, "mid": 0.5})
    down, up = (lambda c: F.floor(c / step) * step), (lambda c: F.ceil(c / step) * step)
    office = F.col("usage") == "OFFICE"
    low = F.when(office, F.greatest(F.lit(step), down(F.col("lo")))).otherwise(up(F.col("lo"))).cast("bigint")
    high = F.when(office, up(F.col("hi"))).otherwise(down(F.col("hi"))).cast("bigint")
    one = F.array(F.greatest(F.lit(step), F.bround(F.col("mid") / step) * step).cast("bigint"))
    grid = F.when(high >= low, F.sequence(low, F.greatest(low, high), F.lit(step).cast("bigint"))).otherwise(one)
    return r.select("usage", F.explode(grid).alias("point"))


def ratio_table(estimates: DataFrame, step: int = STEP, radius: int = RADIUS, least: int = LEAST_LOCAL, nearest: int = NEAREST) -> DataFrame:
    """usage, budget, eight ratios as decimal(8,6) that add up to 1, for each point of each usage's grid. OFFICE blends
    all of its estimates alike, once; other usages weigh those of a point by their distance."""
    rows = stored(shares(estimates))
    points = stored(budget_points(rows, step))
    # OFFICE is blended whole, so its rows look for no neighbours and have no point.
    office = rows.where("usage = 'OFFICE'").withColumns({"point": F.lit(None).cast("bigint"), "distance": F.lit(0.0)})
    others = samples(rows.where("usage != 'OFFICE'"), points.where("usage != 'OFFICE'"), "usage", "budget", "row", radius, least, nearest)
    each = others.withColumn("distance", F.col("distance").cast("double")).unionByName(office)
    each = each.withColumn("w", F.when(F.col("usage") == "OFFICE", 1.0).otherwise(kernel(F.col("distance"), step)))
    each = stored(each.select("usage", "point", "w", F.posexplode(F.array(*RATIOS)).alias("i", "x")))
    key = ["usage", "point", "i"]
    mean = each.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg((F.sum(F.col("x") * F.col("w")) / F.sum("w")).alias("mean"))
    on = F.lit(True)
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    mixed = exact_quantiles(each, key, "x", {"median": 0.5}).join(mean, on).withColumn("x", MEAN_SHARE * F.col("mean") + (1 - MEAN_SHARE) * F.col("median"))
    wide = mixed.groupBy("usage", "point").agg(*[F.max(F.when(F.col("i") == i, F.col("x"))).alias(r) for i, r in enumerate(RATIOS)])
    office = points.where("usage = 'OFFICE'").withColumnRenamed("usage", "_u").join(wide.drop("point"), F.col("usage") == F.col("_u")).select("usage", F.col("point").alias("budget"), *RATIOS)
    return one_in_all(office.unionByName(wide.where("point is not null").select("usage", F.col("point").alias("budget"), *RATIOS)))


def one_in_all(ratios: DataFrame) -> DataFrame:
    """The ratios shared out to a sum of 1 and rounded to six places, what is left over to the largest."""
    total = sum((F.col(r) for r in RATIOS[1:]), F.col(RATIOS[0]))
    return round_to_one(ratios.withColumns({r: F.col(r) / total for r in RATIOS}).select("usage", "budget", *RATIOS), RATIOS)


def high_end(build: DataFrame) -> DataFrame:
    """The one ratio row of the cheapest build that is strong enough: `build` has a price for each part (cpu_price ...)."""
    total = sum((F.col(f"{p.lower()}_price") for p in PARTS), F.lit(0))
    return one_in_all(build.select(F.lit("HIGH_END").alias("usage"), total.cast("bigint").alias("budget"), *[(F.col(f"{p.lower()}_price") / total).alias(f"{p.lower()}_ratio") for p in PARTS]))


def in_order(ratios: DataFrame) -> DataFrame:
    """By usage as RATIO_USAGES has them, then by budget."""
    rank = F.array_position(F.array(*map(F.lit, RATIO_USAGES)), F.col("usage"))
    return ratios.orderBy(rank, "budget")


def ratio_faults(ratios: DataFrame) -> DataFrame:
    """fault, n: what would keep a ratio table from being published; no rows if it is sound. By row: USAGE, BUDGET, RANGE,
    SUM; of the whole: DUPLICATE, HIGH_END (not one, or without graphics), and NO_<usage>."""
    total = sum((F.col(r) for r in RATIOS[1:]), F.col(RATIOS[0]))
    none = F.lit(False)
    for r in RATIOS:
        none = none | F.col(r).isNull() | (F.col(r) < 0) | (F.col(r) > 1)
    rows = [("USAGE", ~F.col("usage").isin(RATIO_USAGES)), ("BUDGET", F.col("budget").isNull() | (F.col("budget") <= 0)), ("RANGE", none), ("SUM", total.cast("decimal(12,6)") != 1)]
    each = ratios.select(F.explode(F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(True)), F.lit(k)) for k, t in rows]))).alias("fault")).groupBy("fault").agg(F.count("*").alias("n"))
    twice = ratios.groupBy("usage", "budget").count().where("count > 1").select(F.lit("DUPLICATE").alias("fault")).groupBy("fault").agg(F.count("*").alias("n"))
    best = F.col("usage") == "HIGH_END"
    whole_ = ratios.agg(F.count_if(best).alias("h"), F.count_if(best & (F.col("gpu_ratio") > 0)).alias("g"), *[F.count_if(F.col("usage") == u).alias(u) for u in ESTIMATED_USAGES])
    tests = [F.when((F.col("h") != 1) | (F.col("g") != 1), F.lit("HIGH_END")), *[F.when(F.col(u) == 0, F.lit(f"NO_{u}")) for u in ESTIMATED_USAGES]]
    table = whole_.select(F.explode(F.array_compact(F.array(*tests))).alias("fault")).withColumn("n", F.lit(1).cast("long"))
    return each.unionByName(twice).unionByName(table)


def estimate_id(url: Column, host: str = "") -> Column:
    """The product number in an estimate's address; null if it has none, or is another site's than `host`'s."""
    own = F.lit(True) if not host else F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")).rlike(rf"(?i)(^|\.){re.escape(host)}$")
    return F.when(own, F.coalesce(*[F.nullif(F.regexp_extract(url, rf"[?&]{p}=([^&#]*)", 1), F.lit("")) for p in ID_PARAMETERS]))


def estimate_url(product_id: Column, page: str) -> Column:
    """The address of a product's page."""
    return F.concat(F.lit(f"{page}?{ID_PARAMETERS[0]}="), product_id)


def title_usage(title: Column) -> Column:
    """The usage that a title speaks of, blanks and case aside; null for none or several."""
    t = F.lower(F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)\s+", ""))
    said = F.array_compact(F.array(*[F.when(t.rlike("|".join(w.replace(" ", "") for w in words)), F.lit(u)) for u, words in USAGE_WORDS.items()]))
    return F.when(F.size(said) == 1, F.get(said, 0))


def usage_conflict(title: Column, usage: Column) -> Column:
    """Whether a title speaks of another usage than the one it is listed under."""
    return F.coalesce(title_usage(title) != usage, F.lit(False))


#: The headings of a table of parts, and the part of each.
PART_NAMES = {
    "CPU": "CPU", "그래픽카드": "GPU", "메인보드": "MAINBOARD", "메모리": "RAM", "RAM": "RAM", "SSD": "SSD", "파워": "POWER", "파워서플라이": "POWER",
    "케이스": "CASE", "쿨러": "COOLER", "CPU쿨러": "COOLER", "CPU 쿨러": "COOLER",
}


def part_lines(tables: DataFrame, keys: list[str]) -> DataFrame:
    """keys, part, line, name, unit_price, quantity: the lines of tables (part_tables() of sources/cards.py) that name a part, an
    amount after it, and a quantity of 1 to 32 right after that. The name is the longest text between."""
    names = F.create_map(*[F.lit(x) for kv in PART_NAMES.items() for x in kv])
    named = lambda cells: F.try_element_at(names, F.get(cells, F.lit(0))["text"])

    def told(cells: Column, line: Column, prices: Column, at: Column) -> Column:
        after = F.get(cells, at + 1)
        typed = F.filter(F.transform(after["values"], lambda v: F.when(F.trim(v).rlike(r"^\d+$"), F.trim(v).try_cast("int"))), lambda n: n.between(1, 32))
        between = F.transform(F.slice(cells, F.lit(2), at - 1), lambda c, i: F.struct(F.length(c["name"]).alias("n"), (-i).alias("i"), c["name"].alias("name")))
        name = F.coalesce(F.array_max(between)["name"], named(cells))
        amount = F.coalesce(F.try_element_at(typed, F.lit(1)), quantity(after["text"]))
        return F.when(at > 0, F.struct(named(cells).alias("part"), line.alias("line"), name.alias("name"), F.get(prices, at - 1).alias("unit_price"), amount.alias("quantity")))

    def read(cells: Column, line: Column) -> Column:
        prices = F.transform(F.slice(cells, F.lit(2), F.size(cells)), lambda c: money(c["text"]))
        at = lambda prices: F.array_position(F.transform(prices, lambda p: p.isNotNull()), F.lit(True)).cast("int")
        return F.when(named(cells).isNotNull(), once(prices, lambda p: once(at(p), lambda i: told(cells, line, p, i))))

    # Lines are read within their table and filtered there: a filter above would be pushed down with the reading of each.
    found = F.filter(F.transform("parts.lines", read), lambda x: x["quantity"].isNotNull())
    return tables.select(*keys, F.explode(found).alias("_x")).select(*keys, "_x.*")


def merged_parts(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines (keys, part, line, name, unit_price, quantity) as one row a part: names joined in order of lines, quantity and
    total summed, no unit price where lines were merged."""
    total = F.sum(F.col("unit_price") * F.col("quantity"))
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "name"))), lambda x: x["name"]), " | ")
    return lines.groupBy(*keys, "part").agg(names.alias("name"), F.when(F.count("*") == 1, F.min("unit_price")).alias("unit_price"), F.sum("quantity").cast("long").alias("quantity"), total.cast("long").alias("price"))


def build_checked(merged: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys, reason, parts_total, and p, an array in order of PARTS of struct part, name, unit_price, quantity, price, ratio.

    `pages` has keys, usage and table_text. Reasons, the first that holds: MISSING_<part>, ZERO_<part> of the required parts,
    then of graphics, which an OFFICE build may have built in, then of the cooler, which may come with the processor;
    such parts are filled in at no cost. ratio is in percent with four places."""
    kind = "struct<name:string,unit_price:bigint,quantity:bigint,price:bigint>"
    one = lambda p: F.max(F.when(F.col("part") == p, F.struct("name", F.col("unit_price").cast("bigint").alias("unit_price"), "quantity", "price")))
    wide = merged.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*[one(p).alias(p) for p in PARTS])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    d = pages.join(wide, on, "left").drop(*[f"_{k}" for k in keys])
    text = F.coalesce(F.col("table_text"), F.lit(""))
    free = lambda name: F.struct(F.lit(name).alias("name"), F.lit(0).cast("bigint").alias("unit_price"), F.lit(0).cast("bigint").alias("quantity"), F.lit(0).cast("bigint").alias("price")).cast(kind)
    built_in = F.col("GPU").isNull() & (F.col("usage") == "OFFICE") & text.rlike(BUILT_IN_GRAPHICS)
    bundled = F.col("COOLER").isNull() & F.concat(F.coalesce("CPU.name", F.lit("")), F.lit(" "), text).rlike(BUNDLED_COOLER)
    tests = []
    for p in [*REQUIRED, "GPU", "COOLER"]:
        allowed = {"GPU": built_in, "COOLER": bundled}.get(p, F.lit(False))
        tests += [(f"MISSING_{p}", F.col(p).isNull() & ~F.coalesce(allowed, F.lit(False))), (f"ZERO_{p}", F.col(f"{p}.price") <= 0)]
    d = stored(d.withColumn("reason", F.coalesce(*[F.when(F.coalesce(t, F.lit(False)), F.lit(k)) for k, t in tests])))
    d = d.withColumns({"GPU": F.when(built_in, free("내장그래픽")).otherwise(F.col("GPU").cast(kind)), "COOLER": F.when(bundled, free("CPU 기본 쿨러")).otherwise(F.col("COOLER").cast(kind))})
    total = sum((F.col(f"{p}.price") for p in PARTS), F.lit(0).cast("bigint"))
    d = d.withColumn("parts_total", F.when(F.col("reason").isNull(), total))
    each = F.array(*[F.struct(F.lit(p).alias("part"), F.col(f"{p}.name").alias("name"), F.col(f"{p}.unit_price").alias("unit_price"), F.col(f"{p}.quantity").alias("quantity"), F.col(f"{p}.price").alias("price"), F.round(100 * F.col(f"{p}.price") / F.col("parts_total"), 4).alias("ratio")) for p in PARTS])
    return d.select(*keys, "usage", "reason", "parts_total", F.when(F.col("reason").isNull(), each).alias("p"))


def money(text: Column) -> Column:
    """'1,234원' -> 1234: null unless the whole text is an amount."""
    return once(squeeze(text), lambda t: F.when(t.rlike(r"^[\d,]+\s*원?$"), F.regexp_replace(t, "[^0-9]", "").try_cast("bigint")))


def quantity(text: Column) -> Column:
    """'2개', '2 EA', '2' -> 2; 1 to 32."""
    n = once(squeeze(text), lambda t: F.when(t.rlike(r"(?i)^(\d+)\s*(개|EA)?$"), F.regexp_extract(t, r"^(\d+)", 1).try_cast("int")))
    return once(n, lambda n: F.when(n.between(1, 32), n))


def cents(ratios: DataFrame) -> DataFrame:
    """The ratio table as text for CSV: six places always."""
    return ratios.select("usage", F.col("budget").cast("string").alias("budget"), *[F.col(r).cast("decimal(8,6)").cast("string").alias(r) for r in RATIOS])


#: The columns of an estimate's line, in order.
RECORD = ["usage", "product_id", "product_name", "parts_total", *[f"{p}_{k}" for p in PARTS for k in ("name", "unit_price", "quantity", "price", "ratio")], "product_url", "collected_at"]


def records(pages: DataFrame, items: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, reason and the columns of RECORD: each listed item's page as the line that read_estimates() reads back.

    `items` has key, usage, product_id, product_name, product_url. Reasons, the first that holds: NO_TABLE (no page, or none with a
    table of parts), USAGE_CONFLICT (a title on the page speaks of another usage, or several do of different ones), those of
    build_checked(), ZERO_TOTAL. A line with a reason has nulls for its parts."""
    tables = stored(part_tables(pages, key, html))
    said = F.array_distinct(F.array_compact(F.transform("parts.titles", title_usage)))
    d = items.join(tables.select(F.col(key).alias("_k"), F.col("parts.text").alias("table_text"), said.alias("_said")), F.col(key) == F.col("_k"), "left").drop("_k")
    conflict = (F.size("_said") > 1) | ((F.size("_said") == 1) & (F.get("_said", 0) != F.col("usage")))
    checked = build_checked(merged_parts(part_lines(tables, [key]), [key]), d.select(key, "usage", "table_text"), [key]).withColumnRenamed("reason", "_reason").drop("usage")
    d = d.join(checked.withColumnRenamed(key, "_c"), F.col(key) == F.col("_c"), "left").drop("_c")
    early = F.when(F.col("table_text").isNull(), "NO_TABLE").when(conflict, "USAGE_CONFLICT")
    d = d.withColumn("reason", F.coalesce(early, F.col("_reason"), F.when(F.col("parts_total") <= 0, "ZERO_TOTAL")))
    part = lambda i, k: F.when(F.col("reason").isNull(), F.get("p", i)[k])
    cells = [part(i, k).alias(f"{x}_{k}") for i, x in enumerate(PARTS) for k in ("name", "unit_price", "quantity", "price", "ratio")]
    total = F.when(F.col("reason").isNull(), F.col("parts_total")).alias("parts_total")
    return d.select(key, "reason", "usage", "product_id", "product_name", total, *cells, "product_url", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("collected_at"))


def written_lines(found: DataFrame) -> DataFrame:
    """The lines of records() that have no reason, as text for CSV."""
    return found.where("reason is null").select(*[F.col(c).cast("string").alias(c) for c in RECORD])
