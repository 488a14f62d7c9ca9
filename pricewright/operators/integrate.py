"""A part's listing with its benchmarks' scores: one call from listing and benchmark lists to integrated rows and a report.

Benchmark lists are united first: of rows with one name the first stays, in order of lists and lines, before scores are
cleaned, so a name whose first score is unreadable has none. Names are matched once, however many rows have one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.functions import text
from pricewright.folders import kept, scratch, stored

from .ordered import small
from .part_match import match_chips, match_memory
from .quality import keep_first, score_value
from .storage_match import match_storage

MATCHED = ["CPU", "GPU", "SSD", "RAM"]
#: Parts that have a maker's brand, and what a listing's own columns tell of memory.
BRANDED = ["CPU", "GPU", "Mainboard"]
MEMORY_COLUMNS = ["memory_type", "memory_clock", "capacity", "module_count"]
#: Columns that may hold a product's name, in order; what an estimated score is named after.
NAME_COLUMNS = ["name", "product_name", "title", "제품명"]
ESTIMATED = "[ESTIMATED_FROM_BENCHMARK_CALIBRATION]"
#: What matching adds beside the score: how, to what, how well, out of how many.
FOUND = ["match_type", "bench_name", "match_score", "candidates"]


def name_column(columns: list[str]) -> str:
    """The column that holds products' names."""
    found = [c for c in NAME_COLUMNS if c in columns]
    if not found:
        raise ValueError(f"none of {NAME_COLUMNS} among {columns}")
    return found[0]


def united(lists: list[DataFrame], name: str, score: str, line: str) -> DataFrame:
    """bench_name, bench_score of several lists, each name once: its first row by list and `line`, if that has a score."""
    each = [d.select(F.col(name).alias("bench_name"), F.col(score).cast("string").alias("bench_score"), F.lit(i).alias("_list"), F.col(line).alias("_line")) for i, d in enumerate(lists)]
    d = keep_first(reduce(DataFrame.unionByName, each), ["bench_name"], ["_list", "_line"])
    return d.select("bench_name", score_value(F.col("bench_score")).alias("bench_score")).where("bench_score is not null")


def _brands(name: Column, part: str) -> dict[str, Column]:
    made = {"brand": text.product_brand(name, part)} if part in BRANDED else {}
    return made | ({"chipset_brand": text.chipset_brand(name)} if part == "GPU" else {})


def with_brands(listing: DataFrame, part: str) -> DataFrame:
    """`listing` with brand right after price, and for graphics cards chipset_brand after it."""
    made = _brands(F.col(name_column(listing.columns)), part)
    columns = [c for c in listing.columns if c not in made]
    at = columns.index("price") + 1 if "price" in columns else 1
    out: list[Column] = [F.col(f"`{c}`") for c in columns]
    return listing.select(*out[:at], *[c.alias(k) for k, c in made.items()], *out[at:])


def match_data(listing: DataFrame, lists: list[DataFrame], part: str, bench_name: str = "Bench_Name", bench_score: str = "Score", line: str = "row") -> tuple[DataFrame, DataFrame]:
    """The listing of a part with brand, chipset_brand, bench_score (whole, half to even) and FOUND; and the report: match_type
    (none for rows without a score), n, rate (percent of all rows), no_brand, no_chipset (rows without)."""
    if part not in MATCHED:
        raise ValueError(f"{part} has no benchmarks, only {MATCHED} have")
    with scratch(listing.sparkSession) as made:
        rows = kept(made, _matched(listing, lists, part, bench_name, bench_score, line))
    return rows, report(rows)


def _matched(listing: DataFrame, lists: list[DataFrame], part: str, bench_name: str, bench_score: str, line: str) -> DataFrame:
    name = name_column(listing.columns)
    bench = stored(united(lists, bench_name, bench_score, line).withColumn("_id", F.col("bench_name")))
    rows = stored(listing)
    # What a row's match and brands hang on, each combination once; rows take theirs from a table that is small where names repeat.
    keys = {name: "_name"} | ({c: f"_{c}" for c in MEMORY_COLUMNS if c in listing.columns} if part == "RAM" else {})
    own = rows.select(*[F.col(c).alias(k) for c, k in keys.items()]).distinct().withColumn("_row", F.monotonically_increasing_id())
    brands = _brands(F.col("_name"), part)
    own = stored(own.select("*", *[c.alias(f"_{k}") for k, c in brands.items()]))
    if part in ("CPU", "GPU"):
        d = match_chips(own, bench, part, "_row", "_name", "bench_name", "bench_score", with_candidates=True)
        kind = F.when(F.col("bench_score").isNotNull(), "model_key_exact").otherwise("none")
    elif part == "SSD":
        d = match_storage(own, bench, "_name", "_id", "bench_name", "bench_score").withColumn("candidates", F.lit(None).cast("long"))
        kind = F.col("match_type")
    else:
        told = {c: k for c, k in keys.items() if c != name}
        d = match_memory(own, bench, "_row", "_name", "bench_name", "bench_score", **told)
        d = d.withColumn("bench_name", F.when(F.col("tier") == "ram_spec_estimate", ESTIMATED).otherwise(F.col("bench_name")))
        kind = F.coalesce("tier", F.lit("none"))
    made = {"score": F.bround(F.col("bench_score").cast("double")).cast("long")} | dict(zip(FOUND, (kind, F.col("bench_name"), F.col("match_score").cast("long"), F.col("candidates").cast("long")), strict=True))
    found = small(stored(d.select(*keys.values(), *[f"_{k}" for k in brands], *[c.alias(f"_{k}") for k, c in made.items()])))
    d = rows.join(found, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]))
    columns = [F.col(f"_{c}").alias(c) if c in brands else F.col(f"`{c}`") for c in with_brands(listing, part).columns if c not in ("bench_score", *FOUND)]
    return stored(d.select(*columns, F.col("_score").alias("bench_score"), *[F.col(f"_{k}").alias(k) for k in FOUND]))


def report(rows: DataFrame) -> DataFrame:
    """match_type, n, rate, no_brand, no_chipset of integrated rows."""
    none = lambda c: F.count_if(F.col(c).isNull()) if c in rows.columns else F.lit(0)
    counts = rows.groupBy(F.when(F.col("bench_score").isNull(), "none").otherwise(F.col("match_type")).alias("match_type")).agg(F.count("*").alias("n"), none("brand").cast("long").alias("no_brand"), none("chipset_brand").cast("long").alias("no_chipset"))
    every = F.sum("n").over(Window.partitionBy(F.lit(0)))  # a row for each way of matching
    return counts.select("match_type", "n", F.round(100 * F.col("n") / every, 1).alias("rate"), "no_brand", "no_chipset")
