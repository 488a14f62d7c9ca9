"""Orders over all partitions: numbers of lines over files, running sums, exact quantiles.

Nothing here gathers a group: an order is made by ranges, sums of ranges are a small table, and each row adds its range's
to its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.folders import stored

#: Rows up to which a table of sums is sent to every task; beyond, it is shuffled.
BROADCAST_ROWS = 100_000
#: What a sketch's rank may be off by is a group's rows divided by this.
ACCURACY = 2000


def small(df: DataFrame) -> DataFrame:
    """`df`, to be sent to every task if it is counted and found to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def numbered_lines(lines: DataFrame, number: str) -> DataFrame:
    """`lines` (read from text files) with their number, from 0, over all files by name and place in the file.

    Tasks read blocks of files in an order that depends on sizes. A line's place in its task says its place in the block, a
    block's start in the file and the file's name say which blocks come before, and how many lines these have is a table with
    a row for each block."""
    columns = lines.columns
    at = {"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"), "_at": F.monotonically_increasing_id()}
    d = stored(lines.select(*columns, *[c.alias(k) for k, c in at.items()]))
    blocks = d.groupBy(F.col("_file").alias("_f"), F.col("_start").alias("_s")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    files = blocks.groupBy(F.col("_f").alias("_g")).agg(F.sum("_n").alias("_n"))
    up_to = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.withColumn("_before", up_to(Window.orderBy("_g"))).drop("_n")  # a row for each file
    blocks = blocks.withColumn("_in_file", up_to(Window.partitionBy("_f").orderBy("_s"))).join(files, F.col("_f") == F.col("_g"))
    blocks = stored(blocks.select("_f", "_s", (F.col("_before") + F.col("_in_file") - F.col("_first")).alias("_shift")))
    d = d.join(small(blocks), (F.col("_file") == F.col("_f")) & (F.col("_start") == F.col("_s")))
    return d.select(*[F.col(f"`{c}`") for c in columns], (F.col("_at") + F.col("_shift")).alias(number))


def running_sum(df: DataFrame, within: list[str], by: list[str], weight: Column, name: str) -> DataFrame:
    """`df` with the sum of `weight` of the rows before it in the order of `by` among those of equal `within`. Rows that are
    equal in both are in any order."""
    keys = [F.col(c).asc_nulls_first() for c in (*within, *by)]
    d = df.withColumn("_w", weight).repartitionByRange(*keys).sortWithinPartitions(*keys)
    d = stored(d.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    runs = d.groupBy(F.col("_part").alias("_p"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(within)]).agg(F.sum("_w").alias("_sum"))
    before = Window.partitionBy(*([f"_k{i}" for i in range(len(within))] or [F.lit(0)])).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum"))  # a row for each range and group
    on = F.col("_part") == F.col("_p")
    for i, c in enumerate(within):
        on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    here = F.coalesce(F.sum("_w").over(Window.partitionBy("_part", *within).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    d = d.withColumn("_here", here).join(small(runs), on)
    return d.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_here")).alias(name))


def exact_quantiles(df: DataFrame, group: list[str], value: str, at: dict[str, float]) -> DataFrame:
    """group, n, and a column for each of `at` (name: share): exact quantiles, interpolated between two neighbours.

    A sketch gives each group an interval that surely holds the two ranks, one aggregate counts the rows below it, and
    only what lies in the interval is ordered, by ranges and once for each distinct value. So neither a group's size nor
    how often it repeats a value makes a task larger."""
    names = list(at)
    kept = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group)] or [F.lit(0).alias("_g0")]
    d = df.where(F.col(value).isNotNull()).select(*kept, F.col(value).cast("double").alias("_v"))
    keys = [f"_g{i}" for i in range(len(kept))]
    slack = 2.0 / ACCURACY
    marks = lambda p: F.percentile_approx("_v", F.array(F.lit(max(0.0, p - slack)), F.lit(min(1.0, p + slack))), F.lit(ACCURACY))
    ends = d.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), *[marks(p).alias(f"_m{i}") for i, p in enumerate(at.values())])
    each = []
    for i, p in enumerate(at.values()):
        rank = F.lit(p) * (F.col("_n") - 1)
        # Few rows, or a share at an end: the interval is open there.
        low = F.when((F.lit(p - slack) <= 0) | (F.col("_n") < ACCURACY), F.col("_min")).otherwise(F.col(f"_m{i}")[0])
        high = F.when((F.lit(p + slack) >= 1) | (F.col("_n") < ACCURACY), F.col("_max")).otherwise(F.col(f"_m{i}")[1])
        each.append(F.struct(F.lit(i).alias("i"), low.alias("low"), high.alias("high"), rank.alias("rank")))
    ends = stored(ends.select(*[F.col(k).alias(f"{k}_") for k in keys], "_n", F.explode(F.array(*each)).alias("_q")))
    same = lambda a, b: _all(F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b, strict=True))
    inside = d.join(small(ends), same(keys, [f"{k}_" for k in keys]))
    # Below the interval all values are one; within it, each is its own.
    spot = F.when(F.col("_v") < F.col("_q.low"), F.lit(None)).otherwise(F.col("_v"))
    held = inside.where(F.col("_v") <= F.col("_q.high")).groupBy(*keys, F.col("_q.i").alias("_i"), spot.alias("_v")).agg(F.count("*").alias("_c"), F.first("_q.rank").alias("_rank"), F.first("_n").alias("_n"))
    d = running_sum(held, [*keys, "_i"], ["_v"], F.col("_c"), "_before")
    low, high = F.floor("_rank"), F.ceil("_rank")
    has = lambda r: F.max(F.when((F.col("_before") <= r) & (r < F.col("_before") + F.col("_c")), F.col("_v")))
    d = d.groupBy(*keys, "_i").agg(has(low).alias("_a"), has(high).alias("_b"), F.first("_rank").alias("_rank"), F.first("_n").alias("_n"))
    share = F.col("_rank") - F.floor("_rank")
    d = d.withColumn("_x", F.when(share == 0, F.col("_a")).otherwise((1 - share) * F.col("_a") + share * F.col("_b")))
    wide = d.groupBy(*keys).agg(F.first("_n").alias("n"), *[F.max(F.when(F.col("_i") == i, F.col("_x"))).alias(f"_x{i}") for i in range(len(names))])
    return wide.select(*[F.col(k).alias(c) for k, c in zip(keys[: len(group)], group, strict=True)], "n", *[F.col(f"_x{i}").alias(k) for i, k in enumerate(names)])


def _all(tests) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out
