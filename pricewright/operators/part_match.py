"""Matching of processors, graphics cards and memory to benchmarks.

Products are matched by the features of their names; every tier is an equi-join on exploded keys, and each product takes the best of what it
meets by a complete order, so results don't depend on how rows lie. A product without a match stays, with nulls.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.functions import memory, text
from pricewright.folders import stored

from .matching import cascade, known_conflict
from .ordered import exact_quantiles
from .quality import score_value
from .stats import normal_sums, solve

KEYS = {"CPU": text.cpu_key_of, "GPU": text.gpu_key_of}
#: Points of a chip match, and of memory by tier.
CHIP_MATCH, BOTH_VRAM, ONE_VRAM = 100, 30, 5
SAME_PART, EACH_PART, SAME_BRAND = 500, 50, 50
SPEC_MATCH, ESTIMATED = 300, 100
SPEED_RADIUS, LEAST_ROWS = 100, 50


def chip_features(df: DataFrame, part: str, name: str) -> DataFrame:
    """`df` with a struct f: key (model), brands, mobile, vram (graphics only), tokens."""

    def told(t: Column) -> Column:
        vram = text.vram_of(t) if part == "GPU" else F.lit(None).cast("int")
        return F.struct(KEYS[part](t).alias("key"), text.chips_of(t, part).alias("brands"), text.mobile_of(t).alias("mobile"), vram.alias("vram"), text.tokens_of(t, part).alias("tokens"))

    return df.withColumn("f", text.once(text.normalize_text(F.col(name)), told))


def match_chips(products: DataFrame, benchmarks: DataFrame, part: str, product_id: str, name: str, bench_name: str, bench_score: str, with_candidates: bool = False) -> DataFrame:
    """`products` with bench_name, bench_score and match_score of the best benchmark of the same model, or nulls; with_candidates: and
    candidates, how many benchmarks it was the best of.

    Models must agree, brands may not conflict, both or neither are mobile, and memory sizes that both tell are equal.
    Score: 100, 30 more if both tell the memory size, 5 if one does, 1 for each word in common. Best by score, then the
    benchmark's score, then its name. Names are matched once, however many products have one (so `product_id` only says what
    the rows are); many benchmarks of one model are few rows."""
    b = chip_features(benchmarks.select(F.col(bench_name).alias("bench_name"), score_value(F.col(bench_score)).alias("bench_score")).where("bench_score is not null"), part, "bench_name")
    names = chip_features(products.select(F.col(name).alias("_of")).distinct(), part, "_of")
    # Written before they are filtered: a filter on the key would be pushed down, and bring all features with it.
    d, b = stored(names).where("f.key is not null"), stored(b)
    b = b.select(F.col("f.key").alias("_key"), F.col("f").alias("g"), "bench_name", "bench_score").where("_key is not null")
    vram = F.when(F.col("f.vram").isNotNull() & F.col("g.vram").isNotNull(), BOTH_VRAM).when(F.col("f.vram").isNotNull() | F.col("g.vram").isNotNull(), ONE_VRAM).otherwise(0)
    agrees = ~known_conflict(F.col("f.brands"), F.col("g.brands")) & (F.col("f.mobile") == F.col("g.mobile")) & F.coalesce(F.col("f.vram") == F.col("g.vram"), F.lit(True))
    met = d.join(b, (F.col("f.key") == F.col("_key")) & agrees).withColumn("match_score", F.lit(CHIP_MATCH) + vram + F.size(F.array_intersect("f.tokens", "g.tokens")))
    best = F.min(F.struct((-F.col("match_score")).alias("m"), (-F.col("bench_score")).alias("s"), F.col("bench_name").alias("name")))
    found = met.groupBy("_of").agg(best.alias("x"), F.count("*").alias("candidates"))
    found = found.select("_of", F.col("x.name").alias("bench_name"), (-F.col("x.s")).alias("bench_score"), (-F.col("x.m")).cast("long").alias("match_score"), *(["candidates"] if with_candidates else []))
    return products.join(found, F.col(name) == F.col("_of"), "left").drop("_of")


def memory_benchmarks(benchmarks: DataFrame, bench_name: str, bench_score: str) -> DataFrame:
    b = benchmarks.select(F.col(bench_name).alias("bench_name"), score_value(F.col(bench_score)).alias("bench_score")).where("bench_score is not null")
    return memory.module_features(b, "bench_name", "g")


def direct_matches(products: DataFrame, b: DataFrame, product_id: str) -> DataFrame:
    """Same part number, no conflict of brands or generations: 500, 50 for each number in common, 50 for a brand in
    common; best by that, then the benchmark's score, then its name."""
    left = products.select(product_id, "f", F.explode("f.parts").alias("_p"))
    right = b.select("bench_name", "bench_score", "g", F.explode("g.parts").alias("_q"))
    met = left.join(right, F.col("_p") == F.col("_q")).where(~known_conflict(F.col("f.brands"), F.col("g.brands")) & F.coalesce(F.col("f.ddr") == F.col("g.ddr"), F.lit(True)))
    points = F.lit(SAME_PART) + EACH_PART * F.size(F.array_intersect("f.parts", "g.parts")) + F.when(F.arrays_overlap("f.brands", "g.brands"), SAME_BRAND).otherwise(0)
    best = F.min(F.struct((-points).alias("m"), (-F.col("bench_score")).alias("s"), F.col("bench_name").alias("name")))
    found = met.groupBy(product_id).agg(best.alias("x"), F.count_distinct("bench_name", "bench_score").alias("candidates"))
    return found.select(product_id, F.col("x.name").alias("bench_name"), (-F.col("x.s")).alias("bench_score"), (-F.col("x.m")).cast("long").alias("match_score"), "candidates")


def spec_matches(products: DataFrame, b: DataFrame, product_id: str) -> DataFrame:
    """Same generation and module capacity, a speed that is sold within 100: the median of the pool's scores, of the product's
    brands if they are in it, else of all. The name is that of the benchmark nearest the median.

    Products are cut to their distinct specifications, benchmarks to counts of equal scores, so what is joined doesn't
    grow with the products."""
    near = F.filter(F.array(*[F.lit(s) for s in text.RAM_SPEEDS]), lambda s: F.abs(s - F.col("f.speed")) <= SPEED_RADIUS)
    spec = F.struct(F.col("f.ddr").alias("ddr"), F.col("f.speed").alias("speed"), F.round("f.module_gb", 2).alias("gb"), F.col("f.brands").alias("brands"))
    known = products.where("f.ddr is not null and f.speed > 0 and f.module_gb > 0")
    keys = known.select(spec.alias("spec"), F.col("f.ddr").alias("_ddr"), F.round("f.module_gb", 2).alias("_gb"), F.explode(near).alias("_speed")).distinct()
    pool = b.where("g.ddr is not null and g.speed > 0 and g.capacity_gb > 0")
    pool = pool.groupBy(F.col("g.ddr").alias("ddr"), F.col("g.speed").alias("speed"), F.round("g.capacity_gb", 2).alias("gb"), F.col("g.brands").alias("brands"), "bench_score").agg(F.count("*").alias("n"), F.min("bench_name").alias("name"))
    met = keys.join(pool, (F.col("_ddr") == F.col("ddr")) & (F.col("_speed") == F.col("speed")) & (F.col("_gb") == F.col("gb")))
    met = met.select("spec", F.arrays_overlap("spec.brands", "brands").alias("own"), "bench_score", "n", "name")
    pools = met.groupBy("spec", "own").agg(F.percentile("bench_score", F.lit(0.5), F.col("n")).alias("median"), F.sum("n").alias("candidates"))
    pools = pools.groupBy("spec").agg(F.max(F.struct("own", "median", "candidates")).alias("x"))
    # All of the pool where none is the product's brand; own is false for all of it then.
    pools = pools.select(F.col("spec").alias("_spec"), F.col("x.own").alias("_own"), "x.median", "x.candidates")
    near_ = F.min(F.struct(F.abs(F.col("bench_score") - F.col("median")).alias("d"), "name"))
    chosen = met.join(pools, (F.col("spec") == F.col("_spec")) & (F.col("own") == F.col("_own"))).groupBy("_spec", "_own").agg(near_.alias("x"), F.first("median").alias("median"), F.first("candidates").alias("candidates"))
    chosen = chosen.select("_spec", F.col("x.name").alias("bench_name"), F.bround("median").alias("bench_score"), (F.lit(SPEC_MATCH) + F.when(F.col("_own"), SAME_BRAND).otherwise(0)).cast("long").alias("match_score"), "candidates")
    return known.select(product_id, spec.alias("spec")).join(chosen, F.col("spec") == F.col("_spec")).drop("spec", "_spec")


def _regressors(speed: Column, cl: Column, gb: Column) -> list[Column]:
    return [F.log2(speed / F.lit(2133.0)), F.lit(100.0) / cl, F.log2(F.greatest(gb.cast("double"), F.lit(1.0)) / 8.0)]


def estimator(b: DataFrame) -> tuple[list[float], float, float] | None:
    """Coefficients, least and largest estimate from the benchmarks that tell speed, latency and capacity; None if they
    are fewer than 50. One row of sums comes to the driver."""
    rows = b.where("g.speed > 0 and g.cl > 0 and g.capacity_gb > 0")
    fit = solve(normal_sums(rows, _regressors(F.col("g.speed"), F.col("g.cl"), F.col("g.capacity_gb")), F.col("bench_score")), 4, LEAST_ROWS)
    if fit is None:
        return None
    ends = exact_quantiles(rows, [], "bench_score", {"low": 0.02, "high": 0.98}).first()
    low, high = ends.low, ends.high
    return fit, max(1.0, low - 2.0), max(high + 8.0, 30.0)


def estimates(products: DataFrame, fit: tuple[list[float], float, float] | None, product_id: str) -> DataFrame:
    """What the fit gives for a product's speed, latency (or the usual one) and capacity (or 16), within its limits."""
    known = products.where("f.speed > 0")
    if fit is None:
        known = known.where("false")
    weights, low, high = fit or ([0.0] * 4, 0.0, 0.0)
    gb = F.coalesce(F.when(F.col("f.module_gb") > 0, F.col("f.module_gb")), F.lit(memory.USUAL_CAPACITY))
    x = _regressors(F.col("f.speed"), memory.latency(F.col("f.cl"), F.col("f.ddr"), F.col("f.speed")), gb)
    value = sum((F.lit(w) * c for w, c in zip(np.array(weights[1:]).tolist(), x, strict=True)), F.lit(weights[0]))
    value = F.bround(F.greatest(F.lit(low), F.least(F.lit(high), value)))
    return known.select(product_id, F.lit(None).cast("string").alias("bench_name"), value.alias("bench_score"), F.lit(ESTIMATED).cast("long").alias("match_score"), F.lit(0).cast("long").alias("candidates"))


def match_memory(products: DataFrame, benchmarks: DataFrame, product_id: str, name: str, bench_name: str, bench_score: str, **told: str) -> DataFrame:
    """`products` with bench_name, bench_score, match_score, candidates and tier: ram_direct, ram_spec_proxy,
    ram_spec_estimate or null. `told` names the products' columns memory_type, memory_clock, capacity, module_count."""
    b = stored(memory_benchmarks(benchmarks, bench_name, bench_score))
    d = stored(memory.module_features(products, name, "f", **{k: F.col(v) for k, v in told.items()}))
    tiers = [("ram_direct", direct_matches(d, b, product_id)), ("ram_spec_proxy", spec_matches(d, b, product_id)), ("ram_spec_estimate", estimates(d, estimator(b), product_id))]
    return cascade(d, product_id, tiers).drop("f")


def match_rate(matched: DataFrame, by: str) -> DataFrame:
    """by, n, matched, rate (percent, two places)."""
    one = F.count("bench_score")
    return matched.groupBy(by).agg(F.count("*").alias("n"), one.alias("matched"), F.round(100 * one / F.count("*"), 2).alias("rate"))
