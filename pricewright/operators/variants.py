"""From a product card to priced rows: identity, name, price, and one row for each capacity that a card offers.

Everything is an expression on the nested card of sources/cards.py: a card's offers are sorted and made distinct inside
its row, so expansion needs no shuffle. `mode` says how a card was read, or why it gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.functions import memory, specs
from pricewright.functions.storage import ram_module_count
from pricewright.functions.text import once, parse_price, squeeze

from .quality import PRICE_BANDS, is_benefit, price_reason

#: Amounts in won, prices for one GB, what a picture's label ends in, and the parameters that hold a code.
WON = r"(\d{1,3}(?:,\d{3})+|\d{4,})\s*원"
UNIT_AMOUNTS = [r"(?i)\d{1,3}(?:,\d{3})+\s*원\s*/\s*(?:1)?\s*GB", r"(?i)\d{4,}\s*원\s*/\s*(?:1)?\s*GB"]
MORE = r"\s*상세보기\s*$"
CODE_PARAMETERS = ["pcode", "PCode", "productCode", "productcode"]
#: Points of a link by what it holds and where it stands.
WITH_CODE, TO_DETAILS, NAMES_CODE, BY_NAME, BY_IMAGE = 200, 80, 50, 60, 40
DETAILS_PATH = "/info"
NAME_POINTS = {"info": 100, "h3": 80, "h4": 70}
OTHER_POINTS, LETTERS, MOST_LETTERS, LEAST_PRICE = 60, 20, 80, 5000
SIZE_ONLY = r"(?i)^\d+(?:\.\d+)?\s*(GB|TB|W|MM)$"
LABELLED = r"(?i)(?<![\w.])(\d+(?:\.\d+)?)\s*(TB|GB)(?![\w/])"


def absolute(url: Column, site: str) -> Column:
    """A link as an address of its own; null for none and for scripts."""

    def of(u: Column) -> Column:
        joined = F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(u.rlike("(?i)^[a-z][a-z0-9+.-]*:"), u).when(u.startswith("/"), F.concat(F.lit(site.rstrip("/")), u))
        return F.when((u != "") & ~u.rlike("(?i)^javascript:"), joined.otherwise(F.concat(F.lit(site.rstrip("/") + "/"), u)))

    return once(squeeze(url), of)


def product_code(url: Column) -> Column:
    """The code in a link's parameters; null if none of them holds one."""

    def of(url: Column) -> Column:
        found = [F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("QUERY"), F.lit(p)), F.lit("")), "[^0-9A-Za-z_-]", "") for p in CODE_PARAMETERS]
        other = F.regexp_extract(url, r"(?i)[?&]pcode=([0-9A-Za-z_-]+)", 1)
        return F.coalesce(*[once(c, lambda c: F.nullif(c, F.lit(""))) for c in (*found, other)])

    return once(url, of)


def identity(card: Column, site: str) -> Column:
    """Struct of code and url: of the link with most points, the first of equals; without a code in it, the card's own
    code attribute and no url."""
    links = F.filter(F.transform(card["links"], lambda a: F.struct(a["place"].alias("place"), absolute(a["href"], site).alias("url"))), lambda a: a["url"].isNotNull())
    links = F.filter(links, lambda a: a["place"].isin("name", "image") | F.lower(a["url"]).contains("pcode="))
    links = F.transform(links, lambda a: F.struct(a["place"].alias("place"), a["url"].alias("url"), product_code(a["url"]).alias("code")))

    def points(a: Column) -> Column:
        u = F.lower(a["url"])
        has = [(a["code"].isNotNull(), WITH_CODE), (u.contains(DETAILS_PATH), TO_DETAILS), (u.contains("pcode="), NAMES_CODE), (a["place"] == "name", BY_NAME), (a["place"] == "image", BY_IMAGE)]
        return sum((F.when(test, n).otherwise(0) for test, n in has), F.lit(0))

    scored = F.transform(links, lambda a, i: F.struct((-points(a)).alias("p"), i.alias("i"), a["url"].alias("url"), a["code"].alias("code")))
    own = F.nullif(F.regexp_extract(card["code_attribute"], "[0-9A-Za-z_-]+", 0), F.lit(""))
    return once(F.array_min(scored), lambda x: F.struct(F.coalesce(x["code"], own).alias("code"), F.when(x["code"].isNotNull(), x["url"]).alias("url")))


def canonical_name(card: Column) -> Column:
    """The name that a card's picture goes by: of its link, else of its text; benefits and scraps aren't names."""
    labels = F.transform(F.filter(card["links"], lambda a: (a["place"] == "image") & a["label"].isNotNull()), lambda a: squeeze(F.regexp_replace(squeeze(a["label"]), MORE, "")))
    names = F.concat(labels, F.transform(card["pictures"], squeeze))
    return F.try_element_at(F.filter(names, lambda n: (F.length(n) >= 3) & ~is_benefit(n)), F.lit(1))


def scored_name(card: Column) -> Column:
    """Of the texts of links with a code, the one with most points for place, length and letters."""
    links = F.filter(card["links"], lambda a: F.coalesce(a["href"], F.lit("")).contains("pcode="))
    texts = F.transform(links, lambda a: F.struct(a["place"].alias("place"), squeeze(a["text"]).alias("t")))
    texts = F.filter(texts, lambda a: (F.length(a["t"]) >= 3) & ~is_benefit(a["t"]) & ~a["t"].rlike(SIZE_ONLY))

    def points(a: Column) -> Column:
        place = F.lit(OTHER_POINTS)
        for k, n in NAME_POINTS.items():
            place = F.when(a["place"] == k, n).otherwise(place)
        return place + F.least(F.length(a["t"]), F.lit(MOST_LETTERS)) + F.when(a["t"].rlike("[가-힣A-Za-z]"), LETTERS).otherwise(0)

    return F.array_max(F.transform(texts, lambda a: F.struct(points(a).alias("p"), a["t"].alias("t"))))["t"]


def amounts(text: Column) -> Column:
    """Amounts in won in a text."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WON), F.lit(1)), parse_price)


def listed(cards: DataFrame, category: str, site: str = "https://shop.example") -> DataFrame:
    """`cards` (with the column card) and name, price, code, url, details (joined), full."""
    card = F.col("card")
    legacy = card["mode"] == "legacy"
    modern = canonical_name(card) if category == "SSD" else F.coalesce(canonical_name(card), scored_name(card))
    least = max(LEAST_PRICE, PRICE_BANDS[category][0] // 2)
    told = F.filter(F.flatten(F.transform(card["prices"], amounts)), lambda v: v >= least)
    anywhere = F.filter(amounts(card["full"]), lambda v: v >= least)
    both = card["legacy_name"].isNotNull() & card["legacy_price"].isNotNull()
    return cards.withColumns(
        {
            "name": F.when(legacy, F.when(both, squeeze(card["legacy_name"]))).otherwise(modern),
            "price": F.when(legacy, F.when(both, parse_price(card["legacy_price"]))).otherwise(F.coalesce(F.array_min(told), F.array_min(anywhere))),
            "_who": identity(card, site),
            "details": F.array_join(F.array_distinct(F.concat(card["details"], F.array(card["full"]))), " / "),
            "full": card["full"],
        }
    ).withColumns({"code": F.col("_who.code"), "url": F.col("_who.url")}).drop("_who")


def _within(category: str, price: Column) -> Column:
    low, high = PRICE_BANDS[category]
    return price.between(low, high)


def _whole_prices(strongs: Column) -> Column:
    """Prices in bold that are neither for one GB nor out of memory's band."""
    values = F.transform(F.filter(strongs, lambda s: ~memory.is_unit_price(s["context"])), lambda s: parse_price(s["text"]))
    return F.filter(values, lambda v: _within("RAM", v))


def offer_price(offer: Column) -> Column:
    """A kit's price: in bold, else in a label, else in the text without prices for one GB; the largest of several."""
    labels = F.filter(offer["labels"], lambda x: ~memory.is_unit_price(x))
    text = offer["text"]
    for p in UNIT_AMOUNTS:
        text = F.regexp_replace(text, p, " ")
    inside = lambda values: F.array_max(F.filter(values, lambda v: _within("RAM", v)))
    return F.coalesce(F.array_max(_whole_prices(offer["strongs"])), inside(F.flatten(F.transform(labels, amounts))), inside(amounts(text)))


def _cheapest(options: Column) -> Column:
    """Of options (gb, modules, price, i, label) the cheapest of each gb and modules, large ones first."""
    same = lambda x, y: (x["gb"] == y["gb"]) & x["modules"].eqNullSafe(y["modules"])
    return F.reverse(once(F.array_sort(options), lambda s: F.filter(s, lambda x, i: (i == 0) | ~same(x, F.get(s, i - 1)))))


def _expanded(d: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each of `rows`; a card without any keeps its mode and has nulls."""
    return d.select(*keep, "mode", F.explode_outer("rows").alias("_r")).select(*keep, "mode", "_r.*")


def memory_rows(cards: DataFrame, keep: list[str]) -> DataFrame:
    """keep, mode, and name, price, memory_type, memory_clock, capacity, module_count for each kit that a card offers."""
    return _expanded(memory_options(cards), keep)


def memory_options(cards: DataFrame) -> DataFrame:
    """`cards` (as listed() gives them) with mode, and rows: the kits that a card offers, null where it has none.

    Modes with rows: multi-option, single. Without: spec-missing, ambiguous-capacity, capacity-missing, price-missing,
    invalid-price, module-count-missing."""
    d = cards.withColumn("_base", memory.base_specs(F.col("name"), F.col("details"), specs.memory_clock(F.col("name"), F.col("details"))))
    card = F.col("card")

    def option(o: Column, i: Column) -> Column:
        more = (ram_module_count(o["text"]).alias("modules"), offer_price(o).alias("price"), i.alias("i"))
        return once(memory.capacity_label(o["text"]), lambda label: F.struct(label["gb"].alias("gb"), *more, label["label"].alias("label")))

    # Sorting puts a missing number of modules first, as if it were 0.
    found = F.filter(F.transform(card["offers"], option), lambda o: o["gb"].between(2, 4096) & o["price"].isNotNull())
    d = d.withColumns({"_options": _cheapest(found), "_root": memory.base_name(F.col("name"))})
    kit = lambda name, price, gb, modules: F.struct(name.alias("name"), price.alias("price"), F.col("_base.memory_type").alias("memory_type"), F.col("_base.memory_clock").alias("memory_clock"), gb.alias("capacity"), modules.alias("module_count"))
    many = F.transform(F.filter("_options", lambda o: F.coalesce(o["modules"], F.col("_base.module_count")).isNotNull()), lambda o: kit(F.concat(F.col("_root"), F.lit(" ("), o["label"], F.lit(")")), o["price"], o["gb"], F.coalesce(o["modules"], F.col("_base.module_count"))))
    own = F.array_join(F.filter(card["details"], lambda x: squeeze(x) != squeeze(card["full"])), " / ")
    gb = F.coalesce(memory.kit_capacity(F.col("name")), memory.kit_capacity(own))
    d = d.withColumns({"_many": many, "_gb": gb, "_all": memory.kit_capacities(F.col("full")), "_price": F.array_max(_whole_prices(card["strongs"]))})
    several = F.size(F.array_distinct("_all")) > 1
    capacity = F.coalesce("_gb", F.when(F.size("_all") == 1, F.get("_all", 0)))
    d = d.withColumn("_whole", capacity)
    capacity = F.col("_whole")
    named = F.when(F.size(memory.kit_capacities(F.col("name"))) > 0, squeeze(F.col("name"))).otherwise(F.concat(squeeze(F.col("name")), F.lit(" ("), capacity.cast("string"), F.lit("GB)")))
    mode = (
        F.when(F.col("_base").isNull(), "spec-missing")
        .when(F.size("_many") > 0, "multi-option")
        .when(several & F.col("_gb").isNull(), "ambiguous-capacity")
        .when(capacity.isNull(), "capacity-missing")
        .when(F.col("_price").isNull(), "price-missing")
        .when(price_reason(F.lit("RAM"), F.col("_price")).isNotNull(), "invalid-price")
        .when(F.col("_base.module_count").isNull(), "module-count-missing")
        .otherwise("single")
    )
    one = F.array(kit(named, F.col("_price"), capacity, F.col("_base.module_count")))
    return d.withColumn("mode", mode).withColumn("rows", F.when(F.col("mode") == "multi-option", F.col("_many")).when(F.col("mode") == "single", one))


def _drive_gb(text: Column, pattern: str) -> Column:
    gb = memory._gb(F.regexp_extract(text, pattern, 1), F.upper(F.regexp_extract(text, pattern, 2)))
    return once(gb, lambda gb: F.when(gb.between(specs.LEAST_DRIVE_GB, specs.MOST_DRIVE_GB), gb))


def drive_offer(offer: Column) -> Column:
    """Struct of gb, label and price of one offer: capacity and price of the same line, never of different ones."""
    whole = r"(?i)^(\d+(?:\.\d+)?)\s*(TB|GB)$"
    return once(F.filter(F.transform(offer["links"], lambda a: squeeze(a["label"])), lambda x: x != ""), lambda spoken: _drive_offer(offer, spoken, whole))


def _drive_offer(offer: Column, spoken: Column, whole: str) -> Column:
    by = lambda texts, p: F.filter(F.transform(texts, lambda x: F.struct(_drive_gb(x, p).alias("gb"), F.concat(F.regexp_extract(x, p, 1), F.upper(F.regexp_extract(x, p, 2))).alias("label"))), lambda x: x["gb"].isNotNull())
    at = F.coalesce(F.try_element_at(by(F.transform(offer["tokens"], squeeze), whole), F.lit(1)), F.try_element_at(by(spoken, LABELLED), F.lit(1)))
    least = PRICE_BANDS["SSD"][0]
    price = lambda text: F.array_min(F.filter(amounts(text), lambda v: v >= least))
    free = r"(?i)(\d+(?:\.\d+)?)\s*(TB|GB)"

    def of_this(x: Column, at: Column) -> Column:
        """A label that names another capacity than the line's is another line's."""
        other = memory._gb(F.regexp_extract(x, free, 1), F.upper(F.regexp_extract(x, free, 2)))
        return F.replace(F.upper(x), F.lit(" "), F.lit("")).contains(at["label"]) | ~x.rlike(free) | (other == at["gb"])

    first = lambda texts: F.try_element_at(F.filter(F.transform(texts, price), lambda v: v.isNotNull()), F.lit(1))
    cost = lambda at: F.coalesce(first(F.filter(spoken, lambda x: of_this(x, at))), first(F.transform(offer["links"], lambda a: squeeze(a["text"]))), price(squeeze(offer["text"])))
    return once(at, lambda at: F.struct(at["gb"].alias("gb"), at["label"].alias("label"), cost(at).alias("price")))


def drive_rows(cards: DataFrame, keep: list[str]) -> DataFrame:
    """keep, mode, and name, price, capacity for each capacity of a drive that a card offers."""
    return _expanded(drive_options(cards), keep)


def drive_options(cards: DataFrame) -> DataFrame:
    """`cards` (as listed() gives them) with mode, and rows: the capacities that a card offers, null where it has none.

    Modes with rows: multi-option, single-name, fallback. Without: single-invalid-price, capacity-missing, fallback-invalid-price."""
    card = F.col("card")
    offers = F.filter(F.transform(card["offers"], lambda o: drive_offer(o)), lambda o: o["gb"].isNotNull() & o["price"].isNotNull())
    options = F.transform(offers, lambda o, i: F.struct(o["gb"].alias("gb"), F.lit(0).alias("modules"), o["price"].alias("price"), i.alias("i"), o["label"].alias("label")))
    row = lambda name, price, gb: F.struct(name.alias("name"), price.alias("price"), gb.alias("capacity"))
    d = cards.withColumn("_options", _cheapest(options)).withColumn("_root", specs.drive_base_name(F.col("name")))
    many = F.transform(F.filter("_options", lambda o: _within("SSD", o["price"])), lambda o: row(F.concat(F.col("_root"), F.lit(" ("), o["label"], F.lit(")")), o["price"], o["gb"]))
    d = d.withColumns({"_many": many, "_own": specs.name_drive_capacity(F.col("name")), "_gb": specs.drive_capacity(F.col("name"), F.col("details"), F.col("full"))})
    fair = F.coalesce(_within("SSD", F.col("price")), F.lit(False))
    mode = (
        F.when(F.size("_many") > 0, "multi-option")
        .when(F.col("_own").isNotNull() & ~fair, "single-invalid-price")
        .when(F.col("_own").isNotNull(), "single-name")
        .when(F.col("_gb").isNull(), "capacity-missing")
        .when(~fair, "fallback-invalid-price")
        .otherwise("fallback")
    )
    named = F.concat(F.col("name"), F.lit(" ("), specs.drive_label(F.col("_gb")), F.lit(")"))
    is_ = lambda m: F.col("mode") == m
    rows = F.when(is_("multi-option"), F.col("_many")).when(is_("single-name"), F.array(row(F.col("name"), F.col("price"), F.col("_own")))).when(is_("fallback"), F.array(row(named, F.col("price"), F.col("_gb"))))
    return d.withColumn("mode", mode).withColumn("rows", rows)
