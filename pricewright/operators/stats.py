"""Budget statistics: grids, adaptive samples, kernel-weighted blends, exact rounding, least squares."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.folders import stored

from .ordered import running_sum, small


def budget_grid(df: DataFrame, usage: str, budget: str, step: int) -> DataFrame:
    """usage, point: multiples of `step` from the one under the least budget to the one over the largest."""
    r = df.groupBy(usage).agg(F.min(budget).alias("lo"), F.max(budget).alias("hi"))
    lo, hi = (F.floor(F.col("lo") / step) * step).cast("bigint"), (F.ceil(F.col("hi") / step) * step).cast("bigint")
    return r.select(usage, F.explode(F.sequence(lo, hi, F.lit(step).cast("bigint"))).alias("point"))


def samples(df: DataFrame, grid: DataFrame, usage: str, budget: str, row_id: str, radius: int, least: int, nearest: int) -> DataFrame:
    """For each grid point the rows within the radius if there are `least` of them, else the `nearest` by distance, budget
    and id. With `distance`. Rows without a budget are no samples.

    Rows are first counted by usage and budget, however many share one. One order over these counts and the points'
    marks says how many rows stand before each, so a point knows how many are within its radius without reading them, and
    the neighbours of one that has too few are the budgets whose places are next to its own: at most `nearest` on either
    side, found by equal buckets of places. Of a budget that many rows share, the first by id are taken."""
    if least > nearest:
        raise ValueError("least must not be over nearest")
    known = df.where(F.col(budget).isNotNull())
    held = known.groupBy(F.col(usage).alias("_u"), F.col(budget).alias("_v")).agg(F.count("*").alias("_n"))
    mark = lambda i, v, side: F.struct(F.lit(i).alias("i"), v.cast(held.schema["_v"].dataType).alias("v"), F.lit(side).alias("side"))
    at = F.col("point")
    # Marks stand before (0) or after (2) the rows (1) of an equal budget.
    marks = grid.select(F.col(usage).alias("_u"), at.cast("double").alias("_point"), F.explode(F.array(mark(0, at - radius, 0), mark(1, at, 0), mark(2, at + radius, 2))).alias("_m"))
    marks = marks.select("_u", F.col("_m.v").alias("_v"), F.lit(0).cast("long").alias("_n"), F.col("_m.side").alias("_side"), "_point", F.col("_m.i").alias("_i"))
    both = held.select("_u", "_v", "_n", F.lit(1).alias("_side"), F.lit(None).cast("double").alias("_point"), F.lit(None).cast("int").alias("_i")).unionByName(marks)
    both = stored(running_sum(both, ["_u"], ["_v", "_side"], F.col("_n"), "_before"))
    of = lambda i: F.max(F.when(F.col("_i") == i, F.col("_before")))
    counts = both.where("_i is not null").groupBy("_u", "_point").agg((of(2) - of(0)).alias("_local"), of(1).alias("_k"))
    points = stored(grid.select(F.col(usage).alias("_g"), "point").distinct().join(counts, F.col("_g").eqNullSafe(F.col("_u")) & (F.col("point").cast("double") == F.col("_point"))).drop("_g", "_point"))

    columns = [*df.columns, "point", "distance"]
    distance = F.abs(F.col(budget) - F.col("point"))
    bucket = lambda c: F.floor(c / radius)
    full = points.where(F.col("_local") >= least).select("_u", "point", F.explode(F.array(*[bucket(F.col("point")) + i for i in (-1, 0, 1)])).alias("_b"))
    local = known.join(small(full), (F.col(usage) == F.col("_u")) & (bucket(F.col(budget)) == F.col("_b"))).withColumn("distance", distance).where(F.col("distance") <= radius).select(*columns)

    places = both.where("_i is null").select(F.col("_u").alias("_w"), F.col("_v").alias("_budget"), "_n", F.col("_before").alias("_first"), (F.col("_before") + F.col("_n") - 1).alias("_last"))
    thin = points.where(F.col("_local") < least).select("_u", "point", "_k")
    near = lambda c: F.floor(c / nearest)
    sides = []
    for place, edge, step, test in (("_first", F.col("_k"), 1, (F.col("_first") >= F.col("_k")) & (F.col("_first") < F.col("_k") + nearest)), ("_last", F.col("_k") - 1, -1, (F.col("_last") < F.col("_k")) & (F.col("_last") >= F.col("_k") - nearest))):
        asked = thin.select("_u", "point", "_k", F.explode(F.array(near(edge), near(edge) + step)).alias("_b"))
        sides.append(places.join(small(asked), (F.col("_w") == F.col("_u")) & (near(F.col(place)) == F.col("_b"))).where(test).select("_u", "point", "_budget", "_n"))
    by = Window.partitionBy("_u", "point").orderBy(F.abs(F.col("_budget") - F.col("point")), "_budget").rowsBetween(Window.unboundedPreceding, -1)
    taken = sides[0].unionByName(sides[1]).withColumn("_take", F.lit(nearest) - F.coalesce(F.sum("_n").over(by), F.lit(0))).where("_take > 0")
    taken = stored(taken.select(F.col("_u").alias("_t"), "_budget", "point", "_take"))
    wanted = taken.select(F.col("_t").alias("_s"), F.col("_budget").alias("_c")).distinct()
    heads = known.join(small(wanted), (F.col(usage) == F.col("_s")) & (F.col(budget) == F.col("_c")), "left_semi")
    heads = heads.withColumn("_n", F.row_number().over(Window.partitionBy(usage, budget).orderBy(row_id))).where(F.col("_n") <= nearest)
    far = heads.join(small(taken), (F.col(usage) == F.col("_t")) & (F.col(budget) == F.col("_budget"))).where("_n <= _take").withColumn("distance", distance)
    return local.unionByName(far.select(*columns))


def blend(value: Column, weight: Column, share: float = 0.6) -> Column:
    """share of the weighted mean and the rest of the median, as an aggregate."""
    return share * F.sum(value * weight) / F.sum(weight) + (1 - share) * F.median(value)


def kernel(distance: Column, scale: float) -> Column:
    return 1 / (1 + F.pow(distance / scale, F.lit(2)))


def round_to_one(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Each column rounded half up; what is missing to 1 goes to the largest, the first of equals."""
    kind = f"decimal({digits + 2},{digits})"
    rounded = df.select("*", *[F.round(F.col(c).cast("decimal(38,18)"), digits).cast(kind).alias(f"_{c}") for c in columns])
    rest = F.lit(1).cast(kind) - sum((F.col(f"_{c}") for c in columns[1:]), F.col(f"_{columns[0]}"))
    top = F.array_position(F.array(*[F.col(f"_{c}") for c in columns]), F.greatest(*[F.col(f"_{c}") for c in columns]))
    fixed = {c: (F.col(f"_{c}") + F.when(top == i + 1, rest).otherwise(F.lit(0).cast(kind))).cast(kind) for i, c in enumerate(columns)}
    return rounded.withColumns(fixed).drop(*[f"_{c}" for c in columns])


def normal_sums(df: DataFrame, features: list[Column], target: Column) -> DataFrame:
    """One row: n, the sums of products of the features (a constant first) and of each with the target."""
    x = [F.lit(1.0), *features]
    out = [F.sum(x[i] * x[j]).alias(f"x{i}{j}") for i in range(len(x)) for j in range(i, len(x))]
    return df.agg(F.count(target).alias("n"), *out, *[F.sum(c * target).alias(f"y{i}") for i, c in enumerate(x)])


def solve(sums: DataFrame, k: int, least: int = 50) -> list[float] | None:
    """Coefficients of the least-squares fit from one row of sums; None if there are too few rows."""
    r = sums.first()
    if r is None or (r["n"] or 0) < least:
        return None
    m = np.array([[r[f"x{min(i, j)}{max(i, j)}"] for j in range(k)] for i in range(k)])
    return np.linalg.lstsq(m, np.array([r[f"y{i}"] for i in range(k)]), rcond=None)[0].tolist()
