"""Entity matching: blocked equi-joins, residual predicates, and the best of what remains.

Blocking keys are exploded so that Spark sees equi-joins; nothing compares all pairs. The picks are windows by
product, with complete tie-breaks, so results don't depend on partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.functions import similarity
from pricewright.folders import stored

from .ordered import exact_quantiles, small


#: Pairs that one task of common_tokens() counts at most.
PAIRS_A_TASK = 1_000_000


def best_match(products: DataFrame, scores: DataFrame, key: str, product_id: str, score: Column, order: list, agrees: Column | None = None) -> DataFrame:
    """Left outer equi-join on `key`; of the partners that agree, the best by score, then `order`."""
    right = scores.withColumnRenamed(key, "_key")
    on = F.col(key) == F.col("_key")
    joined = products.join(right, on if agrees is None else on & agrees, "left").withColumn("match_score", score)
    w = Window.partitionBy(product_id).orderBy(F.col("match_score").desc_nulls_last(), *order)
    return joined.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_key")


def block_on_tokens(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tokens: str = "tokens") -> DataFrame:
    """left_id, right_id, common: pairs that share a token, with how many they share."""
    a = left.select(left_id, F.explode(tokens).alias("_t")).distinct()
    b = right.select(right_id, F.explode(tokens).alias("_u")).distinct()
    return a.join(b, F.col("_t") == F.col("_u")).groupBy(left_id, right_id).agg(F.count("*").alias("common"))


def common_tokens(few: DataFrame, many: DataFrame, few_id: str, many_id: str, tokens: str = "tokens") -> DataFrame:
    """few_id, many_id, common: as block_on_tokens, for whole texts whose common words stand nearly everywhere. Rows of
    `many` meet by their id, never by a word, so no word makes a large task: words that `few` doesn't have go first, and
    where `few` is broadcast, pairs are counted where the words of their id are. A task has so many rows of `many` that it
    counts PAIRS_A_TASK pairs at most, or one row's; more rows make more tasks, no larger ones."""
    a = stored(few.select(few_id, F.explode(tokens).alias("_t")).distinct())
    rows = max(1, PAIRS_A_TASK // max(1, a.select(few_id).distinct().count()))
    b = many.select(many_id, F.explode(tokens).alias("_u"))
    b = b.join(small(a.select("_t").distinct()), F.col("_t") == F.col("_u"), "left_semi").repartition(1 + many.count() // rows, many_id).distinct()
    return b.join(small(a), F.col("_t") == F.col("_u")).groupBy(few_id, many_id).agg(F.count("*").alias("common"))


def known_conflict(a: Column, b: Column) -> Column:
    """Both sides know something and it isn't the same; unknown agrees with anything."""
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def capacity_distance(a: Column, b: Column) -> Column:
    """abs(ln a/b); null where either isn't over 0."""
    return F.when((a > 0) & (b > 0), F.abs(F.log(a.cast("double") / b)))


def median_representative(df: DataFrame, group: list[str], top: Column, value: str, name: str) -> DataFrame:
    """Of each group's rows with the highest `top`, the one nearest their median value, then by name. Aggregates and an
    exact quantile, so a group of any size is no task's."""
    d = stored(df.withColumn("_top", top).where(F.col("_top").isNotNull()))
    same = lambda side: [F.col(c).alias(f"_{side}{i}") for i, c in enumerate(group)]
    on = lambda side: reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{side}{i}")) for i, c in enumerate(group)])
    highest = d.groupBy(*same("a")).agg(F.max("_top").alias("_max"))
    best = stored(d.join(small(highest), on("a") & (F.col("_top") == F.col("_max"))).select(*df.columns))
    middle = exact_quantiles(best, group, value, {"_mid": 0.5}).select(*same("b"), "_mid")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    nearest = F.struct(F.abs(F.col(value) - F.col("_mid")).alias("d"), F.col(name).alias("n"), row.alias("row"))
    return best.join(small(middle), on("b")).groupBy(*same("c")).agg(F.min(nearest).alias("_x")).select("_x.row.*")


def candidate_representative(df: DataFrame, group: list[str], top: Column, value: str, name: str) -> DataFrame:
    """As median_representative, by windows: for groups that are one product's few candidates."""
    best = df.withColumn("_top", top).withColumn("_max", F.max("_top").over(Window.partitionBy(*group))).where("_top = _max")
    best = best.withColumn("_mid", F.median(value).over(Window.partitionBy(*group)))
    w = Window.partitionBy(*group).orderBy(F.abs(F.col(value) - F.col("_mid")), name)
    return best.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_top", "_max", "_mid")


def cascade(products: DataFrame, product_id: str, tiers: list[tuple[str, DataFrame]]) -> DataFrame:
    """Rows of the first tier (name, matches) that has a product; tier is null for products that none has."""
    left, out = products, None
    for name, matches in tiers:
        hit = left.join(matches, product_id).withColumn("tier", F.lit(name))
        out = hit if out is None else out.unionByName(hit, allowMissingColumns=True)
        left = left.join(matches.select(product_id).distinct(), product_id, "left_anti")
    return out.unionByName(left.withColumn("tier", F.lit(None).cast("string")), allowMissingColumns=True)


def band_median(products: DataFrame, scores: DataFrame, product_id: str, equal: str, near: str, radius: float, value: str) -> DataFrame:
    """Median of the values of partners with the same `equal` and `near` within the radius. The band is an equi-join
    on buckets as wide as the radius (own, below, above), so a range never becomes a nested loop. What is joined are the
    distinct keys of both sides with counts of equal values, so it doesn't grow with the rows that share them."""
    bucket = lambda c: F.floor(c / radius)
    keys = products.select(F.col(equal).alias("_e"), F.col(near).alias("_n")).distinct()
    a = keys.select("_e", "_n", F.explode(F.array(*[bucket(F.col("_n")) + i for i in (-1, 0, 1)])).alias("_b"))
    b = scores.groupBy(F.col(equal).alias("_f"), F.col(near).alias("_m"), F.col(value).alias("_v")).agg(F.count("*").alias("_k"))
    on = (F.col("_e") == F.col("_f")) & (F.col("_b") == bucket(F.col("_m"))) & (F.abs(F.col("_n") - F.col("_m")) <= radius)
    of = a.join(b, on).groupBy("_e", "_n").agg(F.percentile("_v", F.lit(0.5), F.col("_k")).alias("band_median"), F.sum("_k").alias("pool"))
    return products.select(product_id, equal, near).join(of, (F.col(equal) == F.col("_e")) & (F.col(near) == F.col("_n"))).select(product_id, "band_median", "pool")


def without_conflicts(df: DataFrame, key: str, label: str) -> DataFrame:
    """Rows of keys that stand under one label only."""
    twice = df.groupBy(key).agg(F.count_distinct(label).alias("_c")).where("_c > 1").select(key)
    return df.join(twice, key, "left_anti")


def ratios_by_pair(pairs: DataFrame, a: str, b: str, least: float = 0.0) -> DataFrame:
    """a, b, ratio: similarity of each distinct pair of texts, once, of those that reach `least`. Letters in common rule most
    pairs out before anything is compared."""
    some = pairs.select(a, b).distinct().where(similarity.bound(F.col(a), F.col(b)) >= least)
    return stored(some).withColumn("ratio", similarity.ratio(F.col(a), F.col(b))).where(F.col("ratio") >= least)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], replace: Column) -> DataFrame:
    """`old` without the rows that `replace` names or whose key is new, and `new`."""
    return old.where(~replace).join(new.select(*keys), keys, "left_anti").unionByName(new)


