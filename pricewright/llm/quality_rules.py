"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each document gets integer counts (features()). From them follow a fixed base rule and ratios in which a larger
value is worse. Each stratum has one ladder of growing unions of cutoffs: the ratios that serve on a tuning share of its
labels, best first, each from its lenient cutoff to the one that serves best. On the other labels, a union is certified
if the exact binomial tail P(Bin(n, alpha) <= k) of its k good documents lost is at most delta / (2 #strata) (Bonferroni),
and testing along the ladder stops at the first that isn't (fixed sequence, which needs no further correction, since the
order comes from other labels). Of the certified unions the one that serves best on the tuning share is taken: such a stratum
loses at most alpha of its good documents that pass the base rule ('stratum').

A stratum whose labels are too few to certify even a union that loses none takes the cutoffs of a ladder over the labels
of all strata, tested at delta / 2. That guarantee is another one ('pooled'): such strata together lose at most alpha of the
good documents of all strata that have labels, in the shares these have among the labels; one of them may lose more of its
own. With confidence 1 - delta all statements of both kinds hold together; a row says which one its verdict rests on.

Defined cases: a null text counts as empty (and fails the base rule, which wants 20 words); a null stratum is the
stratum ''; a stratum without labels has no cutoff; repeated rows are judged alike, each on its own; labels
with a null id or label are ignored; a document labelled several times counts once, as good if all its labels say so, and
rows that repeat a document count once. Columns of the
input are kept by apply() whatever their names; features() says what becomes of names like those of its counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import UPPER, WORD, row_of, text_or_empty, written

WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
ALPHA, DELTA, TUNING_SHARE = 0.02, 0.05, 4
#: Strata whose cutoffs are broadcast at most (a row of some 100 bytes each); more are joined by shuffle.
BROADCAST_STRATA = 50_000
#: What a good document lost weighs against a bad one caught, when a certified cutoff is chosen.
COST = 20
#: Cutoffs of each ratio, from lenient to strict; a document at or over the cutoff is rejected.
LADDERS = {
    "symbol_ratio": [0.5, 0.3, 0.2, 0.1, 0.05],
    "dup_line_ratio": [0.9, 0.7, 0.5, 0.3],
    "repeat_ratio": [0.9, 0.7, 0.5, 0.3, 0.2],
    "upper_ratio": [0.9, 0.7, 0.5, 0.3],
    "bang_ratio": [0.3, 0.2, 0.1, 0.05],
    "word_length": [40.0, 30.0, 20.0, 15.0],
}


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def features(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns `keep` and the counts of each document; one row in, one row out, no shuffle. A kept column that is called
    like a count comes out as doc_<name>."""
    # An array that a later step reads more than once stays a column of its own, so Catalyst evaluates it once.
    # What the caller keeps travels in one struct, so no name of a step can clash with it.
    kept = ["_keep"]
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    d = docs.select(F.struct(*[F.col(k) for k in keep], *([] if keep else [F.lit(0).alias("_")])).alias("_keep"), text_or_empty().alias("_text"))
    d = d.select(
        *kept,
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_w"),
        lines.alias("_l"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        _removed(text, SYMBOLS).cast("long").alias("n_symbols"),
        _removed(text, UPPER).cast("long").alias("n_upper"),
        _removed(text, "!?").cast("long").alias("n_bang"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_upper", "n_bang", "n_lines", "n_dup_lines"]
    d = d.select(
        *kept,
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"),
        F.size("_w").cast("long").alias("n_words"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        "word_chars",
        "n_symbols",
        "n_upper",
        "n_bang",
    )
    # Hashes of 2, 4 and 8 consecutive words by doubling.
    span = 1
    while span < WINDOW:
        n = F.greatest(F.size("_h") - span, F.lit(0))
        d = d.select(*kept, *counts, F.zip_with(F.slice("_h", 1, n), F.slice("_h", span + 1, n), lambda a, b: F.xxhash64(a, b)).alias("_h"))
        span *= 2
    some = F.size(F.array_distinct("_h")) < F.size("_h")
    d = d.select(*kept, *counts, F.when(some, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))
    n = F.size("_s") - 1
    twins = F.zip_with(F.slice("_s", 1, n), F.slice("_s", 2, n), lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)))
    d = d.select(*kept, *counts, F.when(F.col("_s").isNotNull(), F.sort_array(F.array_distinct(F.flatten(F.array_compact(twins))))).alias("_p"))
    n = F.size("_p") - 1
    gaps = F.zip_with(F.slice("_p", 1, n), F.slice("_p", 2, n), lambda a, b: F.least(b - a, F.lit(WINDOW)).cast("long"))
    covered = F.when(F.col("_p").isNull(), F.lit(0).cast("long")).otherwise(F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda acc, x: acc + x))
    told = [*counts, "n_repeat_words"]
    out = [F.col("_keep").getField(k).alias(f"doc_{k}" if k in told else k) for k in keep]
    return d.select(*out, *counts, covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratios() -> dict[str, Column]:
    """By name, each a double, 0 where its base is 0."""

    def over(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(0.0))

    return {
        "symbol_ratio": over("n_symbols", "word_chars"),
        "dup_line_ratio": over("n_dup_lines", "n_lines"),
        "repeat_ratio": over("n_repeat_words", "n_words"),
        "upper_ratio": over("n_upper", "word_chars"),
        "bang_ratio": over("n_bang", "word_chars"),
        "word_length": over("word_chars", "n_words"),
    }


def _ln_gamma(x: Column) -> Column:
    """Stirling's series eight steps up, where it is exact to 1e-10, taken back by the recurrence."""
    z = x + 8
    back = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - back


def binomial_tail(k: Column, n: Column, p: Column) -> Column:
    """P(Bin(n, p) <= k) where k < n p, else 1. Terms are summed down from k, where they are largest; past
    12 sqrt(n) + 60 of them the rest is below the precision of a double."""
    k, n = k.cast("double"), n.cast("double")
    top = _ln_gamma(n + 1) - _ln_gamma(k + 1) - _ln_gamma(n - k + 1) + k * F.log(p) + (n - k) * F.log(1 - p)
    last = F.least(k, F.ceil(12 * F.sqrt(n)) + 60).cast("long")

    def step(acc: Column, i: Column) -> Column:
        t = acc.t * (k - i + 1) / (n - k + i) * (1 - p) / p
        return F.struct(t.alias("t"), (acc.s + t).alias("s"))

    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))
    total = F.when(k > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(last, F.lit(1).cast("long"))), start, step, lambda acc: acc.s)).otherwise(1.0)
    return F.when((n > 0) & (k < n * p), F.exp(top) * total).otherwise(1.0)


def thresholds(feats: DataFrame, labels: DataFrame, stratum: str, alpha: float = ALPHA, delta: float = DELTA, ladders: dict[str, list[float]] = LADDERS) -> DataFrame:
    """(stratum, guarantee, one nullable cutoff a ratio) from features with doc_id and `stratum`, and labels (doc_id, quality)."""
    # One trial for each document, or the binomial would count some twice.
    lab = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg((F.min("quality") == 1).alias("_good"))
    tune = F.pmod(F.xxhash64("doc_id"), F.lit(TUNING_SHARE)) == 0
    of = ratios()
    names = list(ladders)
    passed = F.array(*[sum((F.when(of[name] >= c, 1).otherwise(0) for c in ladders[name]), F.lit(0)) for name in names])
    # Counts by the cutoffs exceeded: a bounded table for each stratum, whatever the number of labels.
    counted = (
        feats.join(lab, "doc_id")
        .where(~base_failed())
        .select("doc_id", F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), "_good", tune.alias("tune"), passed.alias("passed"))
        .distinct()
        .groupBy("stratum", "passed")
        .agg(
            F.count_if(F.col("_good") & ~F.col("tune")).alias("good"),
            F.count_if(F.col("_good") & F.col("tune")).alias("tune_good"),
            F.count_if(~F.col("_good") & F.col("tune")).alias("tune_bad"),
        )
    )
    counted = written(counted, "labelled")
    n_strata = F.count("*").over(Window.partitionBy())
    own = counted.groupBy("stratum").agg(F.sum("good").alias("n")).select("stratum", "n", n_strata.alias("n_strata"))
    # The pool of all strata is the null stratum, as one more ladder.
    cells = counted.unionByName(counted.withColumn("stratum", F.lit(None).cast("string")))
    gain = F.col("tune_bad") - COST * F.col("tune_good")

    def rejects(c: Column) -> Column:
        """`passed` counts from the strictest cutoff up, steps from the most lenient one down."""
        return F.get("passed", c.rule) + c.step > F.get(F.array(*[F.lit(len(ladders[name])) for name in names]), c.rule)

    # The ladder: rules by their best gain, each from its first cutoff to its best one.
    steps = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i + 1).alias("step")) for r, name in enumerate(names) for i in range(len(ladders[name]))])
    single = cells.withColumn("s", F.explode(F.filter(steps, rejects))).groupBy("stratum", "s").agg(F.sum(gain).alias("gain")).where("gain > 0")
    best = single.groupBy("stratum", "s.rule").agg(F.max(F.struct("gain", (-F.col("s.step")).alias("lenient"))).alias("x"))
    order = best.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct((-F.col("x.gain")).alias("gain"), "rule", (-F.col("x.lenient")).alias("last")))).alias("rules"))
    chain = F.flatten(F.transform("rules", lambda r: F.transform(F.sequence(F.lit(1), r.last), lambda s: F.struct(r.rule.alias("rule"), s.alias("step")))))
    order = order.select(F.col("stratum").alias("_of"), chain.alias("chain"))

    # Each label counts at the first step of the ladder that rejects it, so unions are sums over steps.
    first = F.array_position(F.transform("chain", rejects), F.lit(True))
    bins = cells.join(order, F.col("stratum").eqNullSafe(F.col("_of"))).withColumn("first", first)
    bins = bins.groupBy("stratum", "chain").agg(F.collect_list(F.struct("first", "good", gain.alias("gain"))).alias("bins"), F.sum("good").alias("n"))

    def within(field: str) -> Column:
        return F.aggregate(F.filter("bins", lambda b: (b["first"] > 0) & (b["first"] <= F.col("t"))), F.lit(0).cast("long"), lambda acc, b: acc + b[field])

    # Half of delta is for the pool, half is shared by the strata: all statements together fail with delta at most.
    each = F.lit(delta / 2) / F.col("n_strata")
    level = F.when(F.col("stratum").isNull(), F.lit(delta / 2)).otherwise(each)
    tested = (
        bins.crossJoin(own.agg(F.count("*").alias("n_strata")))
        .withColumn("t", F.explode(F.sequence(F.lit(1), F.size("chain"))))
        .select("stratum", "chain", "t", "n", "n_strata", within("good").alias("k"), within("gain").alias("gain"))
        .withColumn("ok", binomial_tail(F.col("k"), F.col("n"), F.lit(alpha)) <= level)
    )
    stop = F.coalesce(F.min(F.when(~F.col("ok"), F.col("t"))), F.lit(1 << 20))
    taken = tested.groupBy("stratum", "chain").agg(stop.alias("stop"), F.collect_list(F.struct("gain", (-F.col("t")).alias("short"))).alias("all"))
    taken = taken.withColumn("x", F.array_max(F.filter("all", lambda x: (-x.short < F.col("stop")) & (x.gain > 0)))).where("x is not null")
    taken = taken.select("stratum", F.slice("chain", F.lit(1), -F.col("x.short")).alias("taken"))

    def cutoff(r: int, name: str) -> Column:
        last = F.array_max(F.transform(F.filter("taken", lambda c: c.rule == r), lambda c: c.step))
        return F.get(F.array(*[F.lit(float(c)) for c in ladders[name]]), last - 1).alias(f"max_{name}")

    limits = taken.select("stratum", *[cutoff(r, name) for r, name in enumerate(names)])
    few = F.pow(F.lit(1.0 - alpha), F.col("n")) > each
    use = own.select("stratum", F.when(~few, F.col("stratum")).alias("_use"), F.when(few, F.lit("pooled")).otherwise(F.lit("stratum")).alias("kind"))
    chosen = use.join(limits.withColumnRenamed("stratum", "_from"), F.col("_use").eqNullSafe(F.col("_from")), "left")
    some = F.coalesce(*[f"max_{name}" for name in names]).isNotNull()
    return chosen.select("stratum", F.when(some, F.col("kind")).alias("guarantee"), *[f"max_{name}" for name in names])


def judge(feats: DataFrame, limits: DataFrame, stratum: str, ladders: dict[str, list[float]] = LADDERS) -> DataFrame:
    """`feats` with guarantee (what the cutoffs of the row's stratum rest on: stratum, pooled, or null for none), base_failed, kept and
    reasons (array of the ratios at or over their cutoff)."""
    of = ratios()
    over = [F.when(of[name] >= F.col(f"max_{name}"), F.lit(name)) for name in ladders]
    key = written(limits.withColumnRenamed("stratum", "_stratum"), "limits")
    # A row for each stratum: by shuffle every document of a stratum would meet in one task.
    key = F.broadcast(key) if key.count() <= BROADCAST_STRATA else key
    joined = feats.join(key, F.coalesce(F.col(stratum), F.lit("")) == F.col("_stratum"), "left")
    return (
        joined.withColumn("base_failed", base_failed())
        .withColumn("reasons", F.array_compact(F.array(*over)))
        .withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0))
        .drop("_stratum", *[f"max_{name}" for name in ladders])
    )


def apply(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **params) -> DataFrame:
    """The kept rows of `docs`, with the columns they came with. Features are written beside their rows first: a filter
    on them would otherwise be pushed below the steps that share arrays and work them out again and again."""
    row = docs.select(row_of(docs).alias("_row"), "doc_id", "text", stratum)
    feats = written(features(row, "_row", "doc_id", stratum), "quality")
    limits = thresholds(feats, labels, stratum, **params)
    return judge(feats, limits, stratum).where("kept").select("_row.*")
