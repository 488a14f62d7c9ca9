"""Queries over the star schema, one for each operator of the library, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricewright.functions import text as T
from pricewright.operators import matching as M
from pricewright.operators import quality as Q
from pricewright.operators import stats as S
from pricewright.operators.storage_match import match_storage
from pricewright.operators.ordered import exact_quantiles
from pricewright.sources import cards as C
from pricewright.streaming import pages as P

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


BANDS = {"ECONOMY": (905, 990), "STANDARD": (910, 985), "PROMO": (920, 980)}


@query("""with b(k, lo, hi) as (values ('ECONOMY', 905.0, 990.0), ('STANDARD', 910.0, 985.0), ('PROMO', 920.0, 980.0))
select p_partkey, case when p_retailprice < lo then 'below_min' when p_retailprice > hi then 'above_max' end as reason
from part left join b on k = p_type""")
def price_band_filter(spark, sf):
    return t(spark, sf, "part").select("p_partkey", Q.price_reason(F.col("p_type"), F.col("p_retailprice"), BANDS).alias("reason"))


@query("""select p_partkey, case when trim(p_name) = '' then 'invalid' when regexp_matches(upper(p_name), '(^|[^A-Z0-9_])USED([^A-Z0-9_]|$)') then 'used'
when regexp_matches(upper(p_name), 'U\\.[23]|SAS|E1\\.[SL]|E3\\.[SL]|ENTERPRISE|DATACENTER') then 'enterprise' end as reason from part""")
def name_classifier(spark, sf):
    return t(spark, sf, "part").select("p_partkey", Q.name_reason("SSD", F.col("p_name")).alias("reason"))


@query("""select l_orderkey, l_linenumber, case when l_quantity % 1 = 0 then l_quantity::bigint end as quantity,
case when l_extendedprice % 1 = 0 then l_extendedprice::bigint end as price from lineitem""")
def integer_coercion(spark, sf):
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", Q.to_integer(F.col("l_quantity")).alias("quantity"), Q.to_integer(F.col("l_extendedprice")).alias("price"))


@query("""select l_orderkey, l_linenumber, nullif(l_discount, 0.05) as discount from lineitem
where nullif(l_discount, 0.05) is not null and nullif(l_discount, 0.05) > 0 and l_quantity > 0 and l_extendedprice > 0""")
def not_null_positive(spark, sf):
    d = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.nullif(F.col("l_discount"), F.lit(0.05)).alias("discount"))
    return Q.complete(d, ["discount"]).where("discount > 0 and l_quantity > 0 and l_extendedprice > 0").select("l_orderkey", "l_linenumber", "discount")


@query("select p_name, p_size, min(p_partkey) as p_partkey from part group by p_name, p_size")
def dedup_keep_first(spark, sf):
    return Q.keep_first(t(spark, sf, "part").select("p_name", "p_size", "p_partkey"), ["p_name", "p_size"], ["p_partkey"])


@query("""select p_partkey, case when p_name ilike '%asus%' then 'ASUS' when p_name ilike '%msi%' then 'MSI' when regexp_matches(lower(p_name), 'gigabyte|aorus') then 'GIGABYTE'
when p_name ilike '%asrock%' then 'ASROCK' when p_name ilike '%biostar%' then 'BIOSTAR' when p_name ilike '%colorful%' then 'COLORFUL' when p_name ilike '%maxsun%' then 'MAXSUN'
when p_name ilike '%axle%' then 'AXLE' when p_name ilike '%afox%' then 'AFOX' end as brand from part""")
def brand_priority_extract(spark, sf):
    return t(spark, sf, "part").select("p_partkey", T.product_brand(F.col("p_name"), "Mainboard").alias("brand"))


@query("""select p_partkey, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(p_name), '[a-z0-9]{2,}'))), ' ') as tokens from part""")
def token_features(spark, sf):
    return t(spark, sf, "part").select("p_partkey", F.array_join(T.tokens(F.col("p_name")), " ").alias("tokens"))


@query("select page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') as page, regexp_extract(url, '^https?://([^/?#]*)', 1) as host from pages")
def url_identity(spark, sf):
    return t(spark, sf, "pages").select("page_id", F.try_parse_url("url", F.lit("QUERY"), F.lit("page")).alias("page"), F.try_parse_url("url", F.lit("HOST")).alias("host"))


@query("""with c as (select page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>')) as x from pages)
select page_id, replace(regexp_extract(x, 'href="([^"]*)"', 1), '&amp;', '&') as href, trim(replace(regexp_extract(x, '">([^<]*)</a>', 1), '&amp;', '&')) as name from c""")
def html_cards(spark, sf):
    return C.linked_items(t(spark, sf, "pages")).select("page_id", "item.href", "item.name")


@query("""select page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) as href from pages""")
def card_variant_explode(spark, sf):
    return t(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)">'), F.lit(1))).alias("href"))


@query("""select page_id, case when page_id % 5 < 4 then 'Item ' || page_id % 37 || case when page_id % 2 = 0 then ' 새' else '' end || case when page_id % 5 > 1 then '||Second ' || page_id % 3 else '' end end as signature from pages
qualify page_id % 5 = 4 or row_number() over (partition by signature order by page_id) = 1""")
def page_signature_dedup(spark, sf):
    """Pages as listings of both layouts, with attributes; every fifth has no cards and stays."""
    p = F.col("page_id")
    n = F.concat(F.lit("Item "), (p % 37).cast("string"), F.when(p % 2 == 0, F.lit(" <b>새</b>")).otherwise(""))
    two = F.concat(F.lit("Second "), (p % 3).cast("string"))
    legacy = F.concat(F.lit('<ul><li class="prod_item x" id="productItem1" data-n="1"><a href="#">'), n, F.lit('</a></li><li id="productItem2" class="ad_prod_item">ad</li></ul>'))
    modern = F.concat(F.lit('<div class="dnw-product-list-item a"> '), n, F.lit('</div><div class="b dnw-product-list-item"><p>'), two, F.lit("</p></div>"))
    html = F.when(p % 5 < 2, legacy).when(p % 5 < 4, modern).otherwise(F.lit("<li>no card</li>"))
    d = t(spark, sf, "pages").select("page_id", html.alias("html")).withColumn("job", F.lit("x"))
    return P.distinct_pages(d, "job", ["page_id"]).select("page_id", "signature")


@query("""with s as (select p_name as k, p_brand as b, median(l_extendedprice) as bench from lineitem join part on l_partkey = p_partkey group by 1, 2),
m as (select p_partkey, b, bench, row_number() over (partition by p_partkey order by case when b = p_brand then 130 when b is not null then 100 end desc nulls last, bench desc, b) as n
from part left join s on k = p_name and substr(b, 1, 7) = substr(p_brand, 1, 7))
select p_partkey, b as bench_brand, bench as bench_score from m where n = 1""")
def model_key_match(spark, sf):
    part = t(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    sold = t(spark, sf, "lineitem").select("l_partkey", "l_extendedprice").join(part, F.col("l_partkey") == F.col("p_partkey"))
    bench = sold.groupBy("p_name", F.col("p_brand").alias("bench_brand")).agg(F.median("l_extendedprice").alias("bench_score"))
    agrees = F.substring("bench_brand", 1, 7) == F.substring("p_brand", 1, 7)
    score = F.when(F.col("bench_brand") == F.col("p_brand"), 130).when(F.col("bench_brand").isNotNull(), 100)
    best = M.best_match(part, bench, "p_name", "p_partkey", score, [F.col("bench_score").desc(), "bench_brand"], agrees)
    return best.select("p_partkey", "bench_brand", "bench_score")


#: The tokens of a text, as T.tokens() finds them in Latin ones: letters, digits and inner hyphens, two characters at least.
_TOKENS = "unnest(list_distinct(list_filter(list_transform(regexp_extract_all(lower(text), '[a-z0-9가-힣-]+'), lambda x: trim(x, '-')), lambda x: length(x) >= 2)))"


@query(f"""with b as (select distinct item_id, {_TOKENS} as w from benchmark), d as (select distinct doc_id, {_TOKENS} as w from documents)
select item_id, doc_id, count(*) as common from b join d using (w) group by 1, 2 having count(*) >= 2""")
def token_block_match_whole(spark, sf):
    """Passages and documents that share two tokens at least, of all tokens of the whole texts."""
    words = T.tokens(F.col("text")).alias("tokens")
    few, many = t(spark, sf, "benchmark").select("item_id", words), t(spark, sf, "documents").select("doc_id", words)
    return M.common_tokens(few, many, "item_id", "doc_id").where("common >= 2")


@query()
def fuzzy_family_match(spark, sf):
    names = t(spark, sf, "part").select("p_name").distinct().withColumn("tokens", F.split("p_name", " "))
    pairs = M.block_on_tokens(names.withColumnRenamed("p_name", "a"), names.withColumnRenamed("p_name", "b"), "a", "b").where("a < b")
    return M.ratios_by_pair(pairs, "a", "b", 0.6)


@query("""with c as (select distinct p_brand as b, p_size as s from part where p_size % 5 = 0),
m as (select p_partkey, s, abs(ln(p_size / s)) as dist, row_number() over (partition by p_partkey order by abs(ln(p_size / s)), s) as n from part join c on b = p_brand where abs(ln(p_size / s)) <= ln(4.0))
select p_partkey, s as nearest, round(dist, 6) as dist from m where n = 1""")
def capacity_nearest(spark, sf):
    part = t(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    have = part.where("p_size % 5 = 0").select(F.col("p_brand").alias("_b"), F.col("p_size").alias("nearest")).distinct()
    d = part.join(have, F.col("p_brand") == F.col("_b")).withColumn("dist", M.capacity_distance(F.col("p_size"), F.col("nearest"))).where(F.col("dist") <= F.log(F.lit(4.0)))
    return Q.keep_first(d, ["p_partkey"], ["dist", "nearest"]).select("p_partkey", "nearest", F.round("dist", 6).alias("dist"))


@query("""select a.p_partkey, median(b.p_retailprice) as band_median, count(*) as pool from part a join part b on a.p_brand = b.p_brand and abs(a.p_size - b.p_size) <= 3 group by 1""")
def spec_band_median(spark, sf):
    part = t(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return M.band_median(part, part, "p_partkey", "p_brand", "p_size", 3, "p_retailprice")


@query("""with a as (select *, max(p_size) over (partition by p_brand) as top from part), m as (select *, median(p_retailprice) over (partition by p_brand) as mid from a where p_size = top),
n as (select *, row_number() over (partition by p_brand order by abs(p_retailprice - mid), p_name, p_partkey) as n from m) select p_brand, p_partkey, p_retailprice from n where n = 1""")
def median_representative(spark, sf):
    part = t(spark, sf, "part").select("p_brand", "p_partkey", "p_name", "p_size", "p_retailprice").withColumn("name", F.struct("p_name", "p_partkey"))
    return M.median_representative(part, ["p_brand"], F.col("p_size"), "p_retailprice", "name").select("p_brand", "p_partkey", "p_retailprice")


@query("""with a as (select l_partkey as p_partkey, max(l_extendedprice) as v from lineitem where l_returnflag = 'R' group by 1), b as (select l_partkey as p_partkey, max(l_extendedprice) as v from lineitem where l_quantity >= 45 group by 1)
select p.p_partkey, coalesce(a.v, b.v) as v, case when a.v is not null then 'direct' when b.v is not null then 'proxy' end as tier from part p left join a using (p_partkey) left join b using (p_partkey)""")
def tier_cascade(spark, sf):
    sold = t(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice", "l_returnflag", "l_quantity")
    tier = lambda test: sold.where(test).groupBy("p_partkey").agg(F.max("l_extendedprice").alias("v"))
    return M.cascade(t(spark, sf, "part").select("p_partkey"), "p_partkey", [("direct", tier("l_returnflag = 'R'")), ("proxy", tier("l_quantity >= 45"))])


@query(f"select w as token, count(*) as n from (select distinct doc_id, {_TOKENS} as w from documents) group by 1")
def token_frequency_whole(spark, sf):
    """In how many documents each token of the whole texts stands; rows that repeat an id are one document."""
    words = t(spark, sf, "documents").select("doc_id", F.explode(T.tokens(F.col("text"))).alias("token")).distinct()
    return words.groupBy("token").agg(F.count("*").alias("n"))


@query("""with x as (select ln(l_quantity) / ln(2) as a, l_discount as b, l_tax as c, l_extendedprice as y from lineitem)
select count(y) as n, sum(1)::double as x00, round(sum(a), 2) as x01, round(sum(b), 2) as x02, round(sum(c), 2) as x03, round(sum(a*a), 2) as x11, round(sum(a*b), 2) as x12, round(sum(a*c), 2) as x13,
round(sum(b*b), 2) as x22, round(sum(b*c), 2) as x23, round(sum(c*c), 2) as x33, round(sum(y), 0) as y0, round(sum(a*y), 0) as y1, round(sum(b*y), 0) as y2, round(sum(c*y), 0) as y3 from x""")
def ols_normal_sums(spark, sf):
    sums = S.normal_sums(t(spark, sf, "lineitem"), [F.log2("l_quantity"), F.col("l_discount"), F.col("l_tax")], F.col("l_extendedprice"))
    return sums.select("n", *[F.round(c, 2 if c[0] == "x" else 0).cast("double").alias(c) for c in sums.columns[1:]])


@query()
def ols_fit_predict(spark, sf):
    d = t(spark, sf, "lineitem")
    x = [F.log2("l_quantity"), F.col("l_discount"), F.col("l_tax")]
    w = S.solve(S.normal_sums(d, x, F.col("l_extendedprice")), 4) or [0.0] * 4
    lo_hi = exact_quantiles(d, [], "l_extendedprice", {"lo": 0.02, "hi": 0.98}).first()
    raw = F.lit(w[0]) + sum((F.lit(c) * f for c, f in zip(w[2:], x[1:], strict=True)), F.lit(w[1]) * x[0])
    return d.select("l_orderkey", "l_linenumber", F.round(F.least(F.greatest(raw, F.lit(lo_hi.lo if lo_hi else 0.0)), F.lit(lo_hi.hi if lo_hi else 0.0)), 2).alias("predicted"))


@query("select o_orderpriority, round(quantile_cont(o_totalprice, 0.02), 4) as q02, round(quantile_cont(o_totalprice, 0.98), 4) as q98, round(median(o_totalprice), 4) as mid from orders group by 1")
def quantile_clamp(spark, sf):
    d = t(spark, sf, "orders")
    of = exact_quantiles(d, ["o_orderpriority"], "o_totalprice", {"q02": 0.02, "q98": 0.98, "mid": 0.5}).withColumnRenamed("o_orderpriority", "_p")
    every = d.select("o_orderpriority").distinct()
    return every.join(of, F.col("o_orderpriority").eqNullSafe(F.col("_p")), "left").select("o_orderpriority", *[F.round(c, 4).alias(c) for c in ("q02", "q98", "mid")])


STEP, RADIUS = 50_000, 25_000


def _estimates(spark, sf) -> DataFrame:
    c = t(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("usage"))
    return t(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("budget")).join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "usage", "budget")


_GRID = """e as (select o_orderkey, c_mktsegment as usage, o_totalprice as budget from orders join customer on o_custkey = c_custkey),
g as (select usage, unnest(generate_series((floor(min(budget) / 50000) * 50000)::bigint, (ceil(max(budget) / 50000) * 50000)::bigint, 50000)) as point from e group by 1)"""
_NEAR = _GRID + """, n as (select e.*, point, abs(budget - point) as distance, sum((abs(budget - point) <= 25000)::int) over (partition by e.usage, point) as local,
row_number() over (partition by e.usage, point order by abs(budget - point), budget, o_orderkey) as r from e join g on e.usage = g.usage),
s as (select * from n where case when local >= 8 then distance <= 25000 else r <= 12 end)"""


@query(f"with {_GRID} select * from g")
def budget_grid(spark, sf):
    return S.budget_grid(_estimates(spark, sf), "usage", "budget", STEP)


def _sampled(spark, sf) -> DataFrame:
    e = _estimates(spark, sf)
    return S.samples(e, S.budget_grid(e, "usage", "budget", STEP), "usage", "budget", "o_orderkey", RADIUS, 8, 12)


@query(f"with {_NEAR} select usage, point, count(*) as n, round(avg(distance), 2) as mean_distance from s group by 1, 2")
def local_or_nearest_samples(spark, sf):
    return _sampled(spark, sf).groupBy("usage", "point").agg(F.count("*").alias("n"), F.round(F.avg("distance"), 2).alias("mean_distance"))


@query(f"""with {_NEAR}, p as (select l_orderkey, sum(case when l_returnflag = 'A' then l_extendedprice else 0 end) / sum(l_extendedprice) as share from lineitem group by 1)
select usage, point, round(0.6 * sum(share / (1 + pow(distance / 50000, 2))) / sum(1 / (1 + pow(distance / 50000, 2))) + 0.4 * median(share), 4) as ratio from s join p on l_orderkey = o_orderkey group by 1, 2""")
def kernel_ratio_blend(spark, sf):
    share = t(spark, sf, "lineitem").groupBy("l_orderkey").agg((F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice")).otherwise(0)) / F.sum("l_extendedprice")).alias("share"))
    d = _sampled(spark, sf).join(share, F.col("o_orderkey") == F.col("l_orderkey"))
    return d.groupBy("usage", "point").agg(F.round(S.blend(F.col("share"), S.kernel(F.col("distance"), STEP)), 4).alias("ratio"))


@query("""with a as (select c_mktsegment as usage, o_orderpriority as p, sum(o_totalprice) as v from orders join customer on o_custkey = c_custkey group by 1, 2),
r as (select usage, p, round((v / sum(v) over (partition by usage))::decimal(38,18), 6)::decimal(8,6) as x from a),
k as (select *, row_number() over (partition by usage order by x desc, p) as n, sum(x) over (partition by usage) as total from r)
select usage, p as priority, (x + case when n = 1 then 1 - total else 0 end)::decimal(8,6)::varchar as ratio from k""")
def ratio_round_residual(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("usage"))
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    o = t(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("usage", "o_orderpriority").agg(F.sum("o_totalprice").alias("v"))
    o = o.withColumn("x", F.col("v") / F.sum("v").over(Window.partitionBy("usage")))
    wide = o.groupBy("usage").pivot("o_orderpriority", names).agg(F.coalesce(F.first("x"), F.lit(0.0))).na.fill(0.0)
    fixed = S.round_to_one(wide.withColumnsRenamed({n: f"r{i}" for i, n in enumerate(names)}), [f"r{i}" for i in range(5)])
    long = F.array(*[F.struct(F.lit(n).alias("priority"), F.col(f"r{i}").cast("string").alias("ratio")) for i, n in enumerate(names)])
    return fixed.select("usage", F.inline(long)).where("ratio <> '0.000000'")


@query("""select event_id, user_id, event_type from events where user_id not in (select user_id from events group by 1 having count(distinct event_type) > 4)""")
def usage_conflict_anti(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "event_type")
    twice = e.groupBy("user_id").agg(F.count_distinct("event_type").alias("c")).where("c > 4").select("user_id")
    return e.join(twice, "user_id", "left_anti")


@query("""select l_orderkey, l_returnflag, string_agg(l_partkey::varchar, ' | ' order by l_linenumber, l_partkey) as names, sum(l_quantity) as quantity, round(sum(l_extendedprice), 2) as total, case when count(*) = 1 then max(l_extendedprice) end as unit_price from lineitem group by 1, 2""")
def merge_repeated_parts(spark, sf):
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x.l_partkey.cast("string")), " | ")
    return t(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(
        parts.alias("names"), F.sum("l_quantity").alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("total"), F.when(F.count("*") == 1, F.max("l_extendedprice")).alias("unit_price")
    )


@query("select p_brand, p_size, min(p_retailprice) as price, arg_min(p_partkey, {'p': p_retailprice, 'k': p_partkey}) as p_partkey from part group by 1, 2")
def min_price_variant(spark, sf):
    return t(spark, sf, "part").groupBy("p_brand", "p_size").agg(F.min("p_retailprice").alias("price"), F.min_by("p_partkey", F.struct("p_retailprice", "p_partkey")).alias("p_partkey"))


@query("""select coalesce(case when l_quantity < 5 then 'few' when l_discount > 0.08 then 'discount' when l_returnflag = 'R' then 'returned' end, 'kept') as reason, count(*) as n from lineitem group by 1""")
def reject_report(spark, sf):
    reason = F.when(F.col("l_quantity") < 5, "few").when(F.col("l_discount") > 0.08, "discount").when(F.col("l_returnflag") == "R", "returned")
    return Q.reason_report(t(spark, sf, "lineitem"), reason)


@query("""with c as (select o_orderkey, o_orderstatus, o_orderpriority, (select 1) as one, count(l_linenumber) as n from orders join lineitem on l_orderkey = o_orderkey group by 1, 2, 3)
select min(o_orderkey) as o_orderkey, o_orderstatus, o_orderpriority, n from c group by o_orderstatus, o_orderpriority, n""")
def config_dedup(spark, sf):
    n = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("l_linenumber").alias("n"))
    d = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    d = Q.keep_first(d, ["o_orderkey"], ["o_orderstatus"]).join(n, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")
    return Q.keep_first(d, ["o_orderstatus", "o_orderpriority", "n"], ["o_orderkey"])


@query("""with o as (select c_mktsegment as usage, c_nationkey as k, round(sum(c_acctbal), 2) as v from customer group by 1, 2), n as (select usage, k, v + 1 as v from o where k % 3 = 0)
select o.* from o left join n using (usage, k) where usage not in ('BUILDING') and n.v is null union all select * from n""")
def ratio_upsert(spark, sf):
    old = t(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("usage"), F.col("c_nationkey").alias("k")).agg(F.round(F.sum("c_acctbal"), 2).alias("v"))
    return M.upsert(old, old.where("k % 3 = 0").withColumn("v", F.col("v") + 1), ["usage", "k"], F.col("usage") == "BUILDING")


@query("select p_brand, min(p_retailprice) as low, max(p_retailprice) as high, count(*) filter (nullif(p_type, 'PROMO') is null) as missing, count(distinct p_name) as names from part group by 1")
def validation_summary(spark, sf):
    return t(spark, sf, "part").groupBy("p_brand").agg(
        F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high"), F.count_if(F.nullif(F.col("p_type"), F.lit("PROMO")).isNull()).alias("missing"), F.count_distinct("p_name").alias("names")
    )


@query("select event_id, user_id from (select event_id, user_id, row_number() over (partition by user_id order by value desc, event_id) as n from events) where n <= 150")
def cap_per_group(spark, sf):
    d = t(spark, sf, "events").select("event_id", "user_id", "value")
    return Q.cap_per_group(d, ["user_id"], [F.col("value").desc(), "event_id"], 150).select("event_id", "user_id")


@query("""with b as (select 'Lexar NM' || (100 + p_size) || ' NVMe SSD 1TB' as bench_name, floor(median(p_retailprice))::double as bench_score from part where p_size % 2 = 0 group by p_size),
r as (select * from b order by abs(bench_score - (select median(bench_score) from b)), bench_name limit 1)
select p_partkey, b.bench_name, b.bench_score, 1350 as match_score, 'model_exact' as match_type from part join b on bench_name = 'Lexar NM' || (100 + p_size) || ' NVMe SSD 1TB' where p_size % 2 = 0
union all select p_partkey, bench_name, bench_score, 530, 'brand_spec_proxy' from part, r where p_size % 2 = 1""")
def storage_match(spark, sf):
    """Parts as storage listings: even sizes stand for a model each, odd ones name none and get a proxy of their brand."""
    part = t(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    model = F.concat(F.lit("Lexar NM"), F.col("p_size") + 100, F.lit(" NVMe SSD 1TB"))
    bench = part.where("p_size % 2 = 0").groupBy("p_size").agg(F.floor(F.median("p_retailprice")).cast("double").alias("score")).select("p_size", model.alias("name"), "score")
    titled = part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, model).otherwise("Lexar NVMe SSD 1TB").alias("title"))
    return match_storage(titled, bench, "title", "p_size", "name", "score").select("p_partkey", "bench_name", "bench_score", "match_score", "match_type")
