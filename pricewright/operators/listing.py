"""A category's captured pages as its listing: cards, filters, attributes, variants, keep-first, with named counters.

One plan does it all. Each card gets its fate, the first test that turns it away, or null; counters are aggregates that
observe the cards and the rows as they pass, so counting reads nothing twice. `CARDS` of the counters is the sum of the
cards that went and those that gave rows.

The rows are written once; the counters are there with them. A task that runs again (a lost executor, a stage that is
repeated) may count its cards again, so counters are a report and no input of any step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pricewright.functions import specs
from pricewright.sources import cards as C
from pricewright.folders import stored

from . import quality as Q
from . import variants as V

#: Attributes between price and product_code, in order.
ATTRIBUTES = {
    "CPU": ["socket_type", "memory_type"], "GPU": ["recommended_power", "pcie_type", "gpu_length"], "Mainboard": ["socket_type", "memory_type", "pcie_type", "size", "memory_clock"],
    "RAM": ["memory_type", "memory_clock", "capacity", "module_count"], "SSD": ["capacity"], "Power": ["size", "wattage"], "Case": ["size", "gpu_length", "cooler_length"], "Cooler": ["socket_type", "cooler_length"],
}
#: Fates of names that count as memory for other machines.
OTHER_MEMORY = ["name:old_generation", "name:unsupported_memory", "name:server_or_notebook", "name:used"]
NO_SPECS = ["spec", "kit:ambiguous-capacity", "kit:capacity-missing", "kit:spec-missing", "kit:module-count-missing", "drive:capacity-missing"]
NO_PRICE = ["kit:price-missing", "kit:invalid-price", "drive:single-invalid-price", "drive:fallback-invalid-price"]


def _tag(tag: str, reason: Column) -> Column:
    """Null where the reason is."""
    return F.concat(F.lit(f"{tag}:"), reason)


def fate(category: str) -> Column:
    """Why a card of listed() gives no rows: the first test that fails, null if it gives some. Needs mode and rows where the category
    has variants, spec where it hasn't."""
    name, price, full = F.col("name"), F.col("price"), F.col("full")
    tests = [F.when(F.coalesce(name, F.lit("")) == "", "name-missing"), F.when(price.isNull(), "price-missing"), _tag("name", Q.name_reason(category, name))]
    if category == "SSD":
        tests += [_tag("storage", Q.storage_reason(name)), F.when(Q.is_msata(F.concat(name, F.lit(" / "), full)), "msata")]
    if category in ("RAM", "SSD"):
        tests.append(F.when(F.size(F.coalesce("rows", F.array())) == 0, F.concat(F.lit("kit:" if category == "RAM" else "drive:"), F.col("mode"))))
        return F.coalesce(*tests)
    tests.append(_tag("price", Q.price_reason(F.lit(category), price)))
    if category == "Cooler":
        tests.append(_tag("cooler", Q.cooler_reason(name, full)))
    if category == "Case":
        tests.append(_tag("case", Q.case_reason(name, full)))
    return F.coalesce(*tests, F.when(F.col("spec").isNull(), "spec"))


def counters(category: str) -> dict[str, Column]:
    """Name and aggregate over cards (fate, code, and mode and rows of variants)."""
    f = F.col("fate")
    is_, begins = (lambda *x: F.count_if(F.coalesce(f.isin(*x), F.lit(False)))), (lambda t: F.coalesce(f.startswith(t), F.lit(False)))
    passed = ~F.coalesce(f.isin("name-missing", "price-missing"), F.lit(False))
    out = {
        "cards": F.count(F.lit(1)),
        "kept_products": F.count_if(f.isNull()),
        "name_missing": is_("name-missing"),
        "price_unread": is_("price-missing"),
        "product_identity_missing": F.count_if(F.col("code").isNull()),
        "price_before": F.count_if(passed),
        "price_removed": F.count_if(begins("price:") | F.coalesce(f.isin(NO_PRICE), F.lit(False))),
        "price_too_high_removed": is_("price:above_max"),
        "consumer_name_removed": F.count_if(begins("name:")),
        "invalid_name_removed": F.count_if(begins("name:") | begins("storage:") | (begins("case:") & (f != "case:rackmount"))),
        "spec_removed": is_(*NO_SPECS),
    }
    modes = lambda m: F.count_if(f.isNull() & (F.col("mode") == m))
    rows = lambda m: F.sum(F.when(f.isNull() & m, F.size("rows")).otherwise(0))
    own = {
        "Mainboard": lambda: {"mainboard_bundle_removed": is_("name:bundle")},
        "Cooler": lambda: {"cooler_server_removed": is_("cooler:server"), "cooler_accessory_removed": F.count_if(begins("cooler:") & (f != "cooler:server"))},
        "Case": lambda: {"case_rackmount_removed": is_("case:rackmount")},
        "RAM": lambda: {
            "ram_consumer_removed": is_(*OTHER_MEMORY), "ram_multi_option_products": modes("multi-option"), "ram_multi_option_rows": rows(F.col("mode") == "multi-option"), "ram_single_products": modes("single"),
            "ram_ambiguous_removed": is_("kit:ambiguous-capacity"), "ram_capacity_missing": is_("kit:capacity-missing"), "ram_price_missing": is_("kit:price-missing"),
            "ram_spec_missing": is_("kit:spec-missing"), "ram_module_count_missing": is_("kit:module-count-missing"),
        },
        "SSD": lambda: {
            "ssd_enterprise_removed": is_("name:enterprise", "storage:enterprise"), "ssd_benefit_removed": is_("storage:benefit"), "ssd_used_removed": is_("storage:used"), "ssd_accessory_removed": is_("storage:accessory"),
            "ssd_base_valid_products": F.count_if(passed & ~begins("name:") & ~begins("storage:")), "ssd_unsupported_interface_removed": is_("msata"), "ssd_capacity_missing": is_("drive:capacity-missing"),
            "ssd_single_name_products": modes("single-name"), "ssd_multi_option_products": modes("multi-option"), "ssd_multi_option_rows": rows(F.col("mode") == "multi-option"), "ssd_fallback_products": modes("fallback"),
        },
    }
    out["price_after"] = rows(F.lit(True)) if category in ("RAM", "SSD") else F.count_if(f.isNull() | begins("cooler:") | begins("case:") | (f == "spec"))
    return out | own.get(category, dict)()


def _judged(pages: DataFrame, category: str, page: str, html: str, site: str) -> DataFrame:
    """Cards with code, url, rows (name, price and attributes of each variant) and fate."""
    d = V.listed(C.cards(pages, page, html), category, site)
    if category == "RAM":
        d = V.memory_options(d)
    elif category == "SSD":
        d = V.drive_options(d)
    else:
        d = d.withColumn("spec", specs.refined_spec(category, F.col("name"), F.col("details"), F.col("full")))
        one = F.struct(F.col("name"), F.col("price").cast("long").alias("price"), *[F.col(f"spec.{a}").alias(a) for a in ATTRIBUTES[category]])
        d = d.withColumns({"rows": F.array(one), "mode": F.lit("single")})
    return d.withColumn("fate", fate(category)).select(page, "n", "code", "url", "mode", "rows", "fate")


def saved_pages(pages: DataFrame, category: str, page: str = "page_id", html: str = "html", site: str = "https://shop.example") -> tuple[DataFrame, dict[str, int]]:
    """The category's listing (name, price, attributes, product_code, product_url, created_at), the first of each name and price in order of
    page, card and offer; and its counters."""
    seen, made, left = Observation("cards"), Observation("rows"), Observation("kept")
    want = counters(category)
    d = _judged(pages, category, page, html, site).observe(seen, *[c.alias(k) for k, c in want.items()]).where("fate is null")
    d = d.select(page, "n", "code", "url", F.posexplode("rows").alias("i", "r"))
    columns = ["name", "price", *ATTRIBUTES[category]]
    d = d.select(page, "n", "i", *[F.col(f"r.{c}").alias(c) for c in columns], F.col("code").alias("product_code"), F.col("url").alias("product_url")).observe(made, F.count(F.lit(1)).alias("n"))
    d = Q.keep_first(d, ["name", "price"], [page, "n", "i"]).observe(left, F.count(F.lit(1)).alias("n"))
    rows = stored(d.select(*columns, "product_code", "product_url", F.current_timestamp().alias("created_at")))
    got = {k: int(seen.get.get(k) or 0) for k in want}
    return rows, got | {"rows_before": int(made.get.get("n") or 0), "rows_after": int(left.get.get("n") or 0)}


def removed(counts: dict[str, int]) -> int:
    """Cards that gave no rows."""
    return counts["cards"] - counts["kept_products"]
