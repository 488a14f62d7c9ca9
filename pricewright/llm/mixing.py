"""Mixing sources to target weights by hierarchical budgeting over a domain - language - source tree.

A node may give at most the tokens below it times `epochs`. From the root down a node's budget is split among its
children by weight; what a child can't give is shared out again among its siblings (water-filling), so a shortage
reaches the ancestors' siblings only if the whole subtree is exhausted. Each leaf then takes the prefix of a seeded
order: whole epochs first, then the documents of the last epoch in the order of md5(seed:epoch:id) until the budget
is met; the last document is taken in part.

The order is a hash, so a leaf of any size is cut into 256 parts by the first two hex digits: part sums give where
each part starts, and running sums are needed within a part only. No leaf is gathered in one task.

Defined cases: null domain, language or source is the node '(none)'; a null text has 0 tokens and is never taken;
rows that repeat an id and a text follow each other, in an order of no consequence; a source may stand under
several languages: those are different leaves; an empty table gives no rows. Weights are relative among siblings,
1 where none is given, and must be over 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, named, written

SEED = "mix-1"
LEVELS = ("domain", "lang", "source")
NONE = "(none)"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def leaf_budgets(leaves: DataFrame, share: float, epochs: int, weights: dict[tuple[str, ...], float]) -> DataFrame:
    """`leaves` (LEVELS, supply: tokens) with budget: whole tokens, share of all tokens in total at most."""
    d = leaves.withColumn("cap", F.col("supply").cast("double") * epochs)
    budget = F.sum("supply").over(Window.partitionBy(F.lit(0))) * F.lit(share)
    d = d.withColumn("b", budget)
    for i in range(len(LEVELS)):
        up, here = list(LEVELS[:i]), list(LEVELS[: i + 1])
        path = F.concat_ws("\x1f", *here)
        given = {"\x1f".join(k): v for k, v in weights.items() if len(k) == i + 1}
        table = F.create_map(*[F.lit(x) for kv in given.items() for x in kv]) if given else None
        w = F.coalesce(table[path], F.lit(1.0)) if given else F.lit(1.0)
        nodes = d.groupBy(*here).agg(F.sum("cap").alias("c"), F.first("b").alias("b")).withColumn("w", w)
        # Children in the order in which they run dry: those before the first that doesn't are taken whole.
        order = Window.partitionBy(*(up or [F.lit(0)])).orderBy(F.col("c") / F.col("w"), *here)
        spent = F.coalesce(F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        weight = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
        nodes = nodes.withColumns({"spent": spent, "rest": weight})
        nodes = nodes.withColumn("level", (F.col("b") - F.col("spent")) / F.col("rest"))
        nodes = nodes.withColumn("dry", F.col("c") <= F.col("level") * F.col("w"))
        level = F.min(F.when(~F.col("dry"), F.struct((F.col("c") / F.col("w")).alias("o"), "level"))).over(Window.partitionBy(*(up or [F.lit(0)])))
        nodes = nodes.withColumn("b2", F.when(F.col("dry"), F.col("c")).otherwise(level["level"] * F.col("w"))).select(*[F.col(h).alias(f"_{h}") for h in here], "b2")
        on = [F.col(h) == F.col(f"_{h}") for h in here]
        d = d.join(nodes, on).drop("b", *[f"_{h}" for h in here]).withColumnRenamed("b2", "b")
    return d.select(*LEVELS, "supply", F.floor(F.col("b") + 1e-6).cast("long").alias("budget"))


def mix(docs: DataFrame, domain: Column, share: float = 0.5, epochs: int = 2, weights: dict[tuple[str, ...], float] | None = None, seed: str = SEED, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """row (struct of `columns`), domain, lang, source, epoch, n_tokens, taken: a row for each document and epoch it is taken in."""
    level = {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}
    leaf = [F.coalesce(c.cast("string"), F.lit(NONE)).alias(f"_{k}") for k, c in level.items()]
    slim = docs.select(F.struct(*[named(c).alias(c) for c in columns]).alias("_row"), F.col("doc_id").alias("_id"), *leaf, words(F.col("text")).alias("n_tokens"), F.xxhash64("text").alias("_t"))
    slim = slim.withColumnsRenamed({f"_{k}": k for k in LEVELS})
    slim = written(slim, "mixing")
    budgets = written(leaf_budgets(slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("supply")), share, epochs, weights or {}), "budgets")
    on = [F.col(k) == F.col(f"_{k}") for k in LEVELS]
    b = budgets.select(*[F.col(k).alias(f"_{k}") for k in LEVELS], "supply", "budget").where("supply > 0 and budget > 0")
    d = slim.where("n_tokens > 0").join(b, on).drop(*[f"_{k}" for k in LEVELS])
    last = F.floor((F.col("budget") - 1) / F.col("supply")).cast("int")
    d = d.select("*", F.explode(F.sequence(F.lit(0), last)).alias("epoch"), last.alias("_last"))
    d = d.withColumn("_key", F.md5(F.concat_ws(":", F.lit(seed), F.col("epoch").cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary")))
    whole = d.where("epoch < _last").withColumn("taken", F.col("n_tokens"))
    part = d.where("epoch = _last").withColumns({"_left": F.col("budget") - F.col("supply") * F.col("_last"), "_part": F.substring("_key", 1, 2)})
    sums = part.groupBy(*LEVELS, "_part").agg(F.sum("n_tokens").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*LEVELS).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(*[F.col(k).alias(f"_{k}") for k in LEVELS], F.col("_part").alias("_p"), before.alias("_start"))
    part = part.join(starts, [*on, F.col("_part") == F.col("_p")]).where("_start < _left")
    own = Window.partitionBy(*LEVELS, "_part").orderBy("_key", "_t", "n_tokens")
    run = F.col("_start") + F.sum("n_tokens").over(own.rowsBetween(Window.unboundedPreceding, 0))
    part = part.withColumn("taken", F.least("n_tokens", F.col("_left") - run + F.col("n_tokens"))).where("taken > 0")
    out = [F.col("_row").alias("row"), *LEVELS, "epoch", "n_tokens", "taken"]
    return whole.select(*out).unionByName(part.select(*out))
