"""Storage products against benchmark rows: identity by model, family or series, then two proxies by brand.

Candidates of a model meet on exploded tokens (equi-joins); every rule is a column expression over the pair's two structs of
features. A tier sees only what the tiers before it left. Of the candidates with the best score the one nearest their median
value is taken, so that no product inherits an outlier.

The last tier, any drive of the brand with like specifications, is a search by bounds. Benchmarks of a brand that agree in all
that is compared but their series are a block. A product's score in a block is known but for the series they share, and that part
has a bound, so the best score of a product is at least its best block's without them. Blocks whose bound is under the best
by more than the pool allows are never opened. Of an opened block, only benchmarks that share a series with the product
are scored one by one, found by (block, series); the others all have the block's score. Products and benchmarks that say the same
are one, blocks of a brand are dealt to `DEALT` tasks, and pools that are the same are worked out once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pricewright.functions import similarity
from pricewright.functions import storage as S
from pricewright.functions.text import numeric_backbone
from pricewright.operators.matching import block_on_tokens, candidate_representative
from pricewright.folders import shared_folder

#: Thresholds of the rules; spellings that are one family.
FARTHEST, FAMILY_SIMILARITY, FAMILY_FARTHEST, POOL = 4.0, 0.80, 2.0, 15
ONE_FAMILY = [["as2280p4", "as2280p4x"], ["as350", "as350x"]]
RELATED = [["wd", "sandisk"], ["solidigm", "intel"]]
#: Codes less alike than this say nothing, and codes whose digits differ are no more alike than that.
LEAST_ALIKE, OTHER_DIGITS = 0.65, 0.6
SERIES_POINTS = 15
#: Tasks over which the blocks of a brand, and a block's series, are dealt.
DEALT = 16

PAIR = "struct<similarity:double,alike:double,left:string,right:string,proxy:double>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def first_letters(x: Column) -> Column:
    return F.regexp_extract(x, "^[a-z]*", 0)


def model_pairs(sets: DataFrame) -> DataFrame:
    """Of sets of codes _x, _y, each two once: pair, struct of the most similar codes of both (similarity, at most 0.6 where
    their digits differ, alike without that, left, right; of equals the first by spelling) and the best proxy score of codes
    that begin with the same letters. Null where no codes are alike by 0.65. Each two codes are compared once, and only if the
    letters they share allow it."""
    each = sets.select("_x", "_y", F.explode("_x").alias("a")).select("_x", "_y", "a", F.explode("_y").alias("b"))
    codes = each.select("a", "b").distinct().where(similarity.bound(F.col("a"), F.col("b")) >= LEAST_ALIKE)
    codes = cut(cut(codes).withColumn("raw", similarity.ratio(F.col("a"), F.col("b"))).where(F.col("raw") >= LEAST_ALIKE).withColumnsRenamed({"a": "_a", "b": "_c"}))
    m, n = _digits(F.col("a")), _digits(F.col("b"))
    other = (m != "") & (n != "") & (m != n)
    alike = F.when(other, F.least("raw", F.lit(OTHER_DIGITS))).otherwise(F.col("raw"))
    number = lambda x: x.try_cast("decimal(38,0)").cast("double")
    near = F.when((m != "") & (F.length(m) == F.length(n)), 18 / (1 + F.abs(number(m) - number(n)) / 10)).otherwise(0.0)
    same = (first_letters(F.col("a")) != "") & (first_letters(F.col("a")) == first_letters(F.col("b")))
    found = each.join(codes, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_c")))
    best = F.min(F.struct((-alike).alias("s"), F.col("a").alias("left"), F.col("b").alias("right"), F.col("raw").alias("raw")))
    found = found.groupBy("_x", "_y").agg(best.alias("m"), F.max(F.when(same, 100 * F.col("raw") + near)).alias("proxy"))
    return found.select("_x", "_y", F.struct((-F.col("m.s")).alias("similarity"), F.col("m.raw").alias("alike"), F.col("m.left").alias("left"), F.col("m.right").alias("right"), F.col("proxy").alias("proxy")).cast(PAIR).alias("pair"))


def _both(k: str) -> Column:
    return F.array_intersect(F.col(f"p.{k}"), F.col(f"b.{k}"))


def _among(c: Column, words: list[str]) -> Column:
    return F.array_intersect(c, F.array(*map(F.lit, words)))


def _n(c: Column) -> Column:
    return F.size(c)


def _sum(parts: list[Column]) -> Column:
    return sum(parts[1:], parts[0])


def relation() -> Column:
    """same, related, conflict, or unknown where a side names no brand."""
    p, b = F.col("p.brands"), F.col("b.brands")
    kin = [(F.array_contains(p, x) & F.array_contains(b, y)) | (F.array_contains(p, y) & F.array_contains(b, x)) for x, y in RELATED]
    return F.when((_n(p) == 0) | (_n(b) == 0), "unknown").when(F.arrays_overlap(p, b), "same").when(kin[0] | kin[1], "related").otherwise("conflict")


def capacity() -> Column:
    """struct(kind, distance): unknown, benchmark_unknown, exact, fallback (a ratio of 4 at most) or too_far."""
    p, b = F.col("p.capacities"), F.col("b.capacities")
    nearest = F.array_min(F.flatten(F.transform(p, lambda x: F.transform(b, lambda y: F.struct(F.abs(F.log(y / x)).alias("distance"), (F.greatest(x, y) / F.least(x, y)).alias("ratio"))))))
    kind = F.when(_n(p) == 0, "unknown").when(_n(b) == 0, "benchmark_unknown").when(F.arrays_overlap(p, b), "exact").when(nearest.ratio <= FARTHEST, "fallback").otherwise("too_far")
    return F.struct(kind.alias("kind"), F.when(kind.isin("benchmark_unknown", "exact"), 0.0).otherwise(nearest.distance).alias("distance"), nearest.ratio.alias("ratio"))


def _sides_agree() -> Column:
    return ~((F.col("p.internal") & F.col("b.external")) | (F.col("p.external") & F.col("b.internal")))


def _differ_in_variants() -> Column:
    p, b = F.col("p.variants"), F.col("b.variants")
    return (p != b) & (_n(_among(F.array_union(p, b), S.VARIANTS_THAT_DECIDE)) > 0)


def _said_variants_differ() -> Column:
    p, b = F.col("p.variants"), F.col("b.variants")
    return (_n(p) > 0) & (_n(b) > 0) & (p != b)


def _said_colours_differ() -> Column:
    p, b = _among(F.col("p.series"), S.COLOUR_SERIES), _among(F.col("b.series"), S.COLOUR_SERIES)
    return (_n(p) > 0) & (_n(b) > 0) & ~F.arrays_overlap(p, b)


def _heatsink(equal: int, not_equal: int) -> Column:
    return F.when(F.col("p.heatsink") == F.col("b.heatsink"), equal).otherwise(not_equal)


def identity() -> Column:
    """struct(kind, score), null for pairs that aren't the same product. Needs p, b, pair, relation, model_n, series_n."""
    rel, pair = F.col("relation"), F.col("pair")
    models, series = _both("models"), _both("series")
    same, related = rel == "same", rel == "related"
    plain = F.filter(series, lambda x: ~x.isin(S.COLOUR_SERIES))

    rare = F.aggregate(models, F.lit(0), lambda acc, x: acc + F.when(F.col("model_n")[x] <= 2, 60).when(F.col("model_n")[x] <= 10, 35).when(F.col("model_n")[x] <= 50, 15).otherwise(0))
    weak = _n(_among(models, S.NEEDS_SERIES)) == _n(models)
    short = F.forall(models, lambda x: F.length(x) <= 3) & (rel == "unknown")
    bound = _n(_among(models, S.NEEDS_BRAND)) == _n(models)
    exact_bad = _said_variants_differ() | _differ_in_variants() | (weak & ~(same & (_n(series) > 0))) | short | (bound & ~same)
    exact = _sum([F.lit(1000), 80 * _n(models), F.when(same, 70).when(related, 30).otherwise(5), rare, 15 * _n(plain), _heatsink(20, -25)])

    listed = F.array_sort(F.array(pair.left, pair.right)).isin(*[F.array(*map(F.lit, x)) for x in ONE_FAMILY])
    digits = numeric_backbone(pair.left)
    need = F.when((digits != "") & (digits == numeric_backbone(pair.right)), FAMILY_SIMILARITY)
    need = need.when(same & (pair.left.startswith(pair.right) | pair.right.startswith(pair.left)), FAMILY_SIMILARITY).when(related, 0.92).otherwise(0.90)
    safe = F.when(listed, same).otherwise((same | related) & (pair.alike >= need))
    is_family = (pair.similarity >= FAMILY_SIMILARITY) & (F.least(F.length(pair.left), F.length(pair.right)) >= 4)
    family_good = safe & (same | related | (_n(series) > 0)) & ~_said_variants_differ()
    family = _sum([F.lit(820), (100 * pair.similarity).cast("int"), F.when(same, 50).when(related, 20).otherwise(0), 10 * _n(series)])

    p_models, b_models = _n(F.col("p.models")) > 0, _n(F.col("b.models")) > 0
    telling = F.filter(plain, lambda x: F.col("series_n")[x] <= 60)
    series_good = same & ~(p_models & b_models) & (_n(telling) > 0) & ~_differ_in_variants()
    by_series = _sum([F.lit(650), 30 * _n(telling), 15 * _n(_both("variants")), F.when(~p_models & b_models, -120).when(p_models & ~b_models, -40).otherwise(0), _heatsink(30, -40)])

    result = lambda kind, score: F.struct(F.lit(kind).alias("kind"), score.cast("int").alias("score"))
    none = F.lit(None).cast("struct<kind:string,score:int>")
    out = F.when((rel == "conflict") | ~_sides_agree(), none)
    out = out.when(_n(models) > 0, F.when(~exact_bad, result("model_exact", exact)))
    out = out.when(is_family, F.when(family_good, result("model_family", family)))
    return out.when(series_good, result("series_exact", by_series))


def cut(df: DataFrame) -> DataFrame:
    """The rows as a checkpoint in the folder of spark.checkpoint.dir: rules over features then start from columns, not
    from the expressions behind them."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def _paired(ids: DataFrame, products: DataFrame, bench: DataFrame, guard: Column, similar: Column | None = None) -> DataFrame:
    """Candidates that pass the guard, which is a matter of columns; where `similar`, with the similarity of their codes, which
    is worked out once for each two sets of codes that occur."""
    d = ids.join(products.select("_p", F.col("f").alias("p")), "_p").join(bench, "_b")
    d = cut(d.withColumns({"relation": relation(), "capacity": capacity()}).where(guard))
    if similar is None:
        return d
    codes = cut(model_pairs(cut(d.where(similar).select(F.col("p.models").alias("_x"), F.col("b.models").alias("_y")).distinct())))
    return cut(d.join(codes, (F.col("p.models") == F.col("_x")) & (F.col("b.models") == F.col("_y")), "left").drop("_x", "_y"))


def _taken(scored: DataFrame, top: Column) -> DataFrame:
    d = candidate_representative(scored, ["_p"], top, "_value", "_order")
    return d.select("_p", "_b", "bench_name", F.col("_value").alias("bench_score"), "match_score", "match_type", F.col("capacity.kind").alias("capacity_match"))


def _by_identity(products: DataFrame, bench: DataFrame) -> DataFrame:
    def keys(d: DataFrame, k: str) -> DataFrame:
        numbers = F.filter(F.transform("f.models", numeric_backbone), lambda x: x != "")
        tagged = [F.transform(c, lambda x, t=t: F.concat(F.lit(t), x)) for t, c in (("m:", F.col("f.models")), ("n:", numbers), ("s:", F.col("f.series")))]
        return d.select(k, F.concat(*tagged).alias("tokens"))

    d = _paired(block_on_tokens(keys(products, "_p"), keys(bench.withColumn("f", F.col("b")), "_b"), "_p", "_b").select("_p", "_b"), products, bench, (F.col("relation") != "conflict") & _sides_agree(), _n(_both("models")) == 0)
    d = d.withColumn("identity", identity()).where("identity is not null")
    kind, near = F.col("capacity.kind"), F.col("capacity.distance")
    loose = (F.col("identity.kind") == "model_exact") & (kind != "too_far")
    d = d.where(loose | kind.isin("exact", "benchmark_unknown") | ((kind == "fallback") & (F.col("capacity.ratio") <= FAMILY_FARTHEST)))
    more = F.when(kind == "exact", 120).when(kind == "benchmark_unknown", 90).when(kind == "fallback", F.greatest(F.lit(10), 70 - (35 * near).cast("int"))).otherwise(0)
    d = d.withColumns({"match_score": F.col("identity.score") + more, "match_type": F.col("identity.kind")})
    return _taken(d, F.struct("match_score", kind == "exact", F.col("identity.kind") == "model_exact"))


def _fits() -> Column:
    return _sides_agree() & ~_said_variants_differ() & ~_said_colours_differ() & (F.col("capacity.kind") != "too_far")


def _by_model_proxy(products: DataFrame, bench: DataFrame) -> DataFrame:
    """Products and benchmarks of a brand meet only on the letters that a code of both begins with."""
    def keys(d: DataFrame, k: str, f: str) -> DataFrame:
        letters = F.array_distinct(F.filter(F.transform(f"{f}.models", first_letters), lambda x: x != ""))
        return d.select(k, F.flatten(F.transform(f"{f}.brands", lambda x: F.transform(letters, lambda y: F.concat(x, F.lit("|"), y)))).alias("tokens"))

    plug = ~F.coalesce(F.col("p.interface") != F.col("b.interface"), F.lit(False))
    ids = block_on_tokens(keys(products, "_p", "f"), keys(bench, "_b", "b"), "_p", "_b").select("_p", "_b")
    d = _paired(ids, products, bench, _fits() & plug, F.lit(True)).where("pair.proxy is not null")
    kind = F.col("capacity.kind")
    more = F.when(kind == "exact", 35).when(kind == "fallback", F.greatest(F.lit(5), 20 - (8 * F.col("capacity.distance")).cast("int"))).when(kind == "benchmark_unknown", 10).otherwise(0)
    colours = F.when(_n(_among(_both("series"), S.COLOUR_SERIES)) > 0, 30).otherwise(0)
    score = _sum([F.lit(520), F.col("pair.proxy").cast("int"), 12 * _n(_both("series")), colours, more])
    d = d.withColumns({"match_score": score, "match_type": F.lit("brand_model_proxy")})
    return _taken(d, F.col("match_score"))


def _plain(series: Column) -> Column:
    return F.filter(series, lambda x: ~x.isin(S.COLOUR_SERIES))


def spec_points() -> Column:
    """What a benchmark's specifications are worth to a product, without the series they share. Needs p, b and capacity."""
    p, b, kind = F.col("p.interface"), F.col("b.interface"), F.col("capacity.kind")
    return _sum([
        F.when(p.isNotNull() & b.isNotNull(), 80).when(p.isNotNull() | b.isNotNull(), 35).otherwise(15),
        F.when(kind == "exact", 100).when(kind == "fallback", F.greatest(F.lit(25), 75 - (18 * (F.col("capacity.ratio") - 1)).cast("int"))).when(kind == "benchmark_unknown", 20).otherwise(5),
        F.when(_n(_among(_both("series"), S.COLOUR_SERIES)) > 0, 25).otherwise(0),
        F.when((_n(F.col("p.variants")) > 0) & (F.col("p.variants") == F.col("b.variants")), 15).otherwise(0),
    ])


def spec_fits() -> Column:
    p, b = F.col("p.interface"), F.col("b.interface")
    return _fits() & F.when(p == "nvme", F.coalesce(b == "nvme", F.lit(False))).otherwise(F.coalesce(p == b, F.lit(True)))


#: What the last tier compares; of a block's series, the colours only.
COMPARED = ["brands", "interface", "capacities", "series", "variants", "external", "internal"]


def _by_spec_proxy(products: DataFrame, bench: DataFrame, scored: Observation | None = None) -> DataFrame:
    plain = _plain(F.col("p.series"))
    classes = products.where(F.size("f.brands") > 0).select("_p", F.struct(*[F.col(f"f.{k}") for k in COMPARED]).alias("p"))
    classes = cut(classes.groupBy("p").agg(F.min("_p").alias("pid")).join(classes.withColumnRenamed("p", "_c"), F.col("p") == F.col("_c")).select("_p", "pid", "p"))
    asked = classes.select("pid", "p").distinct()

    told = F.struct(F.col("b.named").alias("brands"), *[(_among(F.col("b.series"), S.COLOUR_SERIES) if k == "series" else F.col(f"b.{k}")).alias(k) for k in COMPARED[1:]])
    rows = bench.where("b.storage").select("_b", "_value", "_order", told.alias("k"), F.array_sort(_plain(F.col("b.series"))).alias("plain"))
    blocks = cut(rows.groupBy("k").agg(F.max(F.size("plain")).alias("most"), F.min("_b").alias("kid")))
    members = cut(rows.join(blocks.select(F.col("k").alias("_k"), "kid"), F.col("k") == F.col("_k")).select("_b", "_value", "_order", "kid", "plain"))
    series = cut(members.groupBy("kid", "plain").agg(F.min("_b").alias("cid")))

    # Each brand's blocks are dealt whole to every one of its tasks, its products to one of them.
    dealt = F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)))
    left = asked.select("pid", "p", F.explode("p.brands").alias("_brand"), F.pmod(F.xxhash64("pid"), F.lit(DEALT)).cast("int").alias("_d"))
    right = blocks.select("kid", F.col("k").alias("b"), "most", F.explode("k.brands").alias("_named")).withColumn("_e", dealt)
    met = left.join(right, (F.col("_brand") == F.col("_named")) & (F.col("_d") == F.col("_e"))).withColumn("capacity", capacity()).where(spec_fits())
    met = met.withColumn("base", spec_points()).withColumn("bound", F.col("base") + SERIES_POINTS * F.least(F.size(plain), F.col("most")))
    met = cut(met.select("pid", "kid", "base", "bound", plain.alias("words")).dropDuplicates(["pid", "kid"]))

    postings = series.select(F.col("kid").alias("_k"), F.col("cid"), F.explode("plain").alias("_w"))

    def opened(some: DataFrame) -> DataFrame:
        """pid, kid, cid, base, quality of the benchmarks of blocks that share a series with the product."""
        d = some.select("pid", "kid", "base", F.explode("words").alias("word")).join(postings, (F.col("kid") == F.col("_k")) & (F.col("word") == F.col("_w")))
        return d.groupBy("pid", "kid", "cid").agg(F.first("base").alias("base"), F.count("*").alias("_n")).withColumn("quality", F.col("base") + SERIES_POINTS * F.col("_n"))

    first = met.groupBy(F.col("pid").alias("_i")).agg(F.max("base").alias("least"), F.max(F.struct("bound", "kid")).alias("top"))
    first = cut(first.select("_i", "least", F.col("top.kid").alias("_top")))
    ahead = met.join(first, F.col("pid") == F.col("_i"))
    one = cut(opened(ahead.where("kid = _top and bound > base")))
    best = one.groupBy(F.col("pid").alias("_j")).agg(F.max("quality").alias("_q"))
    kept = ahead.join(best, F.col("pid") == F.col("_j"), "left").withColumn("best", F.greatest("least", F.coalesce("_q", F.lit(0)))).where(F.col("bound") >= F.col("best") - POOL)
    kept = cut(kept.select("pid", "kid", "base", "bound", "best", "words", (F.col("kid") == F.col("_top")).alias("_done")))
    two = opened(kept.where("not _done and bound > base"))
    every = one.unionByName(two)
    every = cut(every.observe(scored, F.count(F.lit(1)).alias("scored")) if scored is not None else every)

    final = kept.select("pid", "best").unionByName(every.select("pid", F.col("quality").alias("best"))).groupBy(F.col("pid").alias("_i")).agg(F.max("best").alias("_best"))
    whole = kept.join(final, F.col("pid") == F.col("_i")).where(F.col("base") >= F.col("_best") - POOL).select("pid", F.col("kid").alias("of"), F.lit(True).alias("block"))
    part = every.join(final, F.col("pid") == F.col("_i")).where((F.col("quality") >= F.col("_best") - POOL) & (F.col("base") < F.col("_best") - POOL)).select("pid", F.col("cid").alias("of"), F.lit(False).alias("block"))
    pools = whole.unionByName(part).groupBy("pid").agg(F.array_sort(F.collect_set(F.struct("block", "of"))).alias("pool"))
    pools = cut(pools)

    values = members.join(series.withColumnsRenamed({"kid": "_k", "plain": "_s"}), (F.col("kid") == F.col("_k")) & (F.col("plain") == F.col("_s")))
    values = values.select("_value", "_order", "_b", F.explode(F.array(F.struct(F.lit(True).alias("block"), F.col("kid").alias("of")), F.struct(F.lit(False).alias("block"), F.col("cid").alias("of")))).alias("_of"))
    values = cut(values.groupBy("_of", "_value").agg(F.count("*").alias("_n"), F.min("_order").alias("_order")))
    filled = cut(pools.select("pool").distinct().select("pool", F.explode("pool").alias("_x")).join(values, F.col("_x") == F.col("_of")).select("pool", "_value", "_n", "_order"))
    middle = filled.groupBy(F.col("pool").alias("_pool")).agg(F.percentile("_value", F.lit(0.5), F.col("_n")).alias("_mid"))
    nearest = F.min(F.struct(F.abs(F.col("_value") - F.col("_mid")).alias("d"), F.col("_order").alias("o")))
    chosen = filled.join(middle, F.col("pool") == F.col("_pool")).groupBy(F.col("_pool").alias("_pool")).agg(nearest.alias("_x"))
    d = pools.join(chosen, F.col("pool") == F.col("_pool")).select(F.col("pid").alias("_i"), F.col("_x.o._b").alias("_b"))
    d = classes.join(d, F.col("pid") == F.col("_i")).join(bench, "_b").withColumn("capacity", capacity())
    score = F.lit(350) + spec_points() + SERIES_POINTS * F.size(F.array_intersect(plain, _plain(F.col("b.series"))))
    return d.select("_p", "_b", "bench_name", F.col("_value").alias("bench_score"), score.alias("match_score"), F.lit("brand_spec_proxy").alias("match_type"), F.col("capacity.kind").alias("capacity_match"))


def _counts(bench: DataFrame, k: str, name: str) -> DataFrame:
    """_b, name: how many rows have each of the row's tokens, as a map."""
    each = bench.select("_b", F.explode(f"f.{k}").alias("_t"))
    n = each.groupBy("_t").agg(F.count("*").alias("_n"))
    return each.join(n, "_t").groupBy("_b").agg(F.map_from_entries(F.collect_list(F.struct("_t", "_n"))).alias(name))


def match_storage(products: DataFrame, benchmarks: DataFrame, product_name: str, bench_id: str, bench_name: str, bench_score: str, scored: Observation | None = None) -> DataFrame:
    """Each product's columns with bench_id, bench_name, bench_score, match_score, match_type and capacity_match;
    match_type is 'none', the others null, where no tier has a row. Names that repeat are matched once. Ids of
    benchmarks must be unique, else an error; benchmarks without a score are left out. `scored` observes how many benchmarks the last
    tier scored one by one."""
    left = products.select(F.col(product_name).alias("_p")).where("_p is not null").distinct()
    left = cut(S.features(left, "_p").select("_p", "f"))
    bench = benchmarks.where(F.col(bench_score).isNotNull()).select(F.col(bench_id).alias("_b"), F.col(bench_name).alias("bench_name"), F.col(bench_score).alias("_value"))
    bench = cut(S.features(bench, "bench_name"))
    twice = bench.agg(F.count_if(F.col("_b").isNull()).alias("nulls"), (F.count("_b") - F.count_distinct("_b")).alias("more")).first()
    if twice.nulls or twice.more:
        raise ValueError(f"benchmarks' ids must be unique: {twice.nulls} null, {twice.more} repeated")
    bench = bench.join(_counts(bench, "models", "model_n"), "_b", "left").join(_counts(bench, "series", "series_n"), "_b", "left")
    bench = cut(bench.withColumn("_order", F.struct("bench_name", "_b")).withColumnRenamed("f", "b"))
    found = None
    for tier in (_by_identity, _by_model_proxy, _by_spec_proxy):
        hit = cut(tier(left, bench, scored) if tier is _by_spec_proxy else tier(left, bench))
        found = hit if found is None else found.unionByName(hit)
        left = left.join(hit.select("_p"), "_p", "left_anti")
    found = found.withColumnRenamed("_b", "bench_id")
    out = products.join(found, F.col(product_name) == F.col("_p"), "left").drop("_p")
    return out.withColumn("match_type", F.coalesce("match_type", F.lit("none")))
