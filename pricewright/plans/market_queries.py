"""Queries of the part, card and estimate operators.

The star schema has no such texts, so they are made from its columns: each query's source is one SQL text that Spark and
DuckDB both read. The SQL beside a query works from those columns, not from the texts, so it shares no rule with the operators.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.functions import memory, specs
from pricewright.functions import text as T
from pricewright.functions.storage import part_brands
from pricewright.operators import builds as B
from pricewright.operators import estimates as E
from pricewright.operators import matching as M
from pricewright.operators import part_match as P
from pricewright.operators import quality as Q
from pricewright.operators import stats as S
from pricewright.operators import variants as V
from pricewright.sources import cards as C
from pricewright.sources import catalog
from pricewright.folders import new_folder

from .catalog_queries import ORACLES, query, t


#: Tasks for each core over which a source's rows are spread.
TASKS_A_CORE = 3


def spread(df: DataFrame) -> DataFrame:
    """`df` over all cores: a table of short rows is a file of few blocks, however much is made of each row."""
    return df.repartition(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)


def made(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """Rows of a source: the tables in braces are those of `sf`."""
    return spark.sql(sql, **{n: spread(t(spark, sf, n)) for n in ("part", "orders", "supplier", "events") if f"{{{n}}}" in sql})


def duck(sql: str) -> str:
    """A source as DuckDB reads it."""
    return sql.replace("{part}", "part").replace("{orders}", "orders").replace("{supplier}", "supplier").replace("{events}", "events")


def pick(expression: str, values: list) -> str:
    """The value whose turn it is."""
    shown = [f"'{v}'" if isinstance(v, str) else str(v) for v in values]
    return f"(case ({expression}) % {len(values)} " + " ".join(f"when {i} then {v}" for i, v in enumerate(shown)) + " end)"


# Processors and graphics cards

CPUS = f"""select p_partkey, p_type, p_size, {pick('p_partkey', ['3', '5', '7', '9'])} as tier, cast(5000 + 100 * (p_size % 10) as string) as number,
{pick('p_size', ['', 'x', 'x3d'])} as ending, p_partkey % 11 = 0 as mobile from {{part}}"""
CPU_TITLES = f"select p_partkey, 'AMD 라이젠' || tier || '-6세대 ' || number || upper(ending) || ' ' || p_type || case when mobile then ' 노트북' else '' end as title from ({CPUS}) c"
CPU_SCORES = f"""select tier, number, ending, p_type, 'AMD Ryzen ' || tier || ' ' || number || upper(ending) || ' ' || p_type as name,
case when min(p_partkey) % 7 = 0 then 'n/a' else '1,' || cast(100 + sum(p_size) % 900 as string) end as score from ({CPUS}) c where p_partkey % 3 > 0 group by tier, number, ending, p_type"""
BEST = "row_number() over (partition by p_partkey order by match_score desc, bench_score desc, bench_name) = 1"


@query(f"""with p as ({duck(CPUS)}), b as ({duck(CPU_SCORES)}),
j as (select p_partkey, name as bench_name, replace(score, ',', '')::double as bench_score, (102 + (p.p_type = b.p_type)::int)::bigint as match_score
from p join b on p.tier = b.tier and p.number = b.number and p.ending = b.ending where not mobile and score <> 'n/a' qualify {BEST})
select p.p_partkey, bench_name, bench_score, match_score from p left join j using (p_partkey)""")
def chip_match_cpu(spark, sf):
    return P.match_chips(made(spark, sf, CPU_TITLES), made(spark, sf, CPU_SCORES), "CPU", "p_partkey", "title", "name", "score").drop("title")


GPUS = f"select p_partkey, {pick('p_partkey', ['ASUS', 'MSI', 'ZOTAC', 'MANLI'])} as maker, cast(3050 + 10 * (p_size % 8) as string) as number, {pick('p_size', ['8', '12', '16'])} as gb, p_partkey % 3 < 2 as told from {{part}}"
GPU_TITLES = f"select p_partkey, maker || ' 지포스 RTX ' || number || ' OC' || case when told then ' D6 ' || gb || 'GB' else '' end as title from ({GPUS}) c"
GPU_SCORES = f"""select number, gb, told, 'GeForce RTX ' || number || case when told then ' ' || gb || 'GB' else '' end as name, cast(10000 + sum(p_partkey) % 5000 as string) as score
from (select number, told, case when told then gb end as gb, p_partkey from ({GPUS}) c where p_partkey % 5 > 0) d group by number, gb, told"""


@query(f"""with p as ({duck(GPUS)}), b as ({duck(GPU_SCORES)}),
j as (select p_partkey, name as bench_name, score::double as bench_score, (103 + case when p.told and b.told then 31 when p.told or b.told then 5 else 0 end)::bigint as match_score
from p join b on p.number = b.number where not (p.told and b.told and p.gb <> b.gb) qualify {BEST})
select p.p_partkey, bench_name, bench_score, match_score from p left join j using (p_partkey)""")
def chip_match_gpu(spark, sf):
    return P.match_chips(made(spark, sf, GPU_TITLES), made(spark, sf, GPU_SCORES), "GPU", "p_partkey", "title", "name", "score").drop("title")


@query(f"""with p as ({duck(CPUS)}), b as (select distinct tier, number, ending from ({duck(CPU_SCORES)}) s where score <> 'n/a'),
m as (select p.tier, count(*) as n, count(b.tier) filter (not mobile) as matched from p left join b on p.tier = b.tier and p.number = b.number and p.ending = b.ending group by p.tier)
select tier, n, matched, round(100 * matched / n, 2) as rate from m""")
def match_rate(spark, sf):
    products = made(spark, sf, CPU_TITLES).withColumn("tier", F.regexp_extract("title", "라이젠(.)", 1))
    return P.match_rate(P.match_chips(products, made(spark, sf, CPU_SCORES), "CPU", "p_partkey", "title", "name", "score"), "tier")


@query(f"""with c as ({duck(CPUS)}), g as ({duck(GPUS)}) select p_partkey, 'amd-ryzen-' || tier || '-' || c.number || ending as cpu_key, 'nvidia-rtx-' || g.number as gpu_key,
case when told then gb::int end as vram, mobile, 'nvidia' as chip, list_sort(['ryzen', c.number || ending, lower(p_type)])::varchar as tokens from c join g using (p_partkey)""")
def chip_features(spark, sf):
    d = made(spark, sf, CPU_TITLES).join(made(spark, sf, GPU_TITLES).withColumnRenamed("title", "card"), "p_partkey")
    return d.select("p_partkey", T.cpu_model_key(F.col("title")).alias("cpu_key"), T.gpu_model_key(F.col("card")).alias("gpu_key"), T.gpu_vram_gb(F.col("card")).alias("vram"), T.is_mobile(F.col("title")).alias("mobile"), F.array_join(part_brands(F.col("card"), "GPU"), ",").alias("chip"), T.part_tokens(F.col("title"), "CPU").cast("string").alias("tokens"))


# Memory

KITS = f"""select p_partkey, p_size, p_partkey % 4 as kind, case when p_partkey % 4 = 0 then 'G.SKILL RIPJAWS F4-3200C16D-' || cast(100 + p_size as string) || 'GVK' else {pick('p_partkey', ['x', 'Corsair VENGEANCE', 'ADATA XPG', 'Kingston FURY'])} end as title,
{pick('p_partkey', ['', 'DDR4', 'DDR4', 'ddr5'])} as ddr, {pick('p_partkey', [0, 3200, 3600, 6000])} as clock, {pick('p_partkey', [0, 32, 16, 32])} as gb, {pick('p_partkey', [1, 2, 1, 2])} as modules from {{part}}"""
KIT_TITLES = f"select p_partkey, title, nullif(ddr, '') as ddr, nullif(clock, 0) as clock, nullif(gb, 0) as gb, modules from ({KITS}) k"
KIT_SCORES = f"""select maker, speed, cl, gb, score, part, case when part is null then maker || ' DDR4-' || cast(speed as string) || ' CL' || cast(cl as string) || ' ' || cast(gb as string) || 'GB' else 'G.Skill F4-3200C16D-' || part || 'GVK 16GB' end as name from (
select {pick('p_partkey', ['Corsair', 'Crucial'])} as maker, {pick('p_size', [2666, 3200, 3600, 3666])} as speed, {pick('p_partkey', [14, 16, 18, 20, 22])} as cl, {pick('p_partkey', [8, 16, 32])} as gb, 10 + (p_partkey * 7) % 23 as score, cast(null as string) as part from {{part}}
union all select 'G.Skill', 3200, 16, 16, 20 + p_size % 9, cast(100 + p_size as string) from {{part}} where p_size % 2 = 0 group by p_size) b"""
KIT_TOLD = f"select name, cast(score as string) as score from ({KIT_SCORES}) s"


def _determinant(rows: list[list[str]]) -> str:
    """Leibniz's formula as SQL."""
    n = len(rows)
    sign = lambda p: (-1) ** sum(p[i] > p[j] for i in range(n) for j in range(i + 1, n))
    return " + ".join(f"({sign(p)}) * " + " * ".join(rows[i][p[i]] for i in range(n)) for p in permutations(range(n)))


def _least_squares(x: list[str], y: str, table: str) -> str:
    """Coefficients w0.. of y by x from `table`, by Cramer's rule on the normal equations."""
    n = len(x)
    sums = ", ".join([f"sum(({x[i]}) * ({x[j]})) as a{i}{j}" for i in range(n) for j in range(n)] + [f"sum(({x[i]}) * ({y})) as b{i}" for i in range(n)])
    m = [[f"a{i}{j}" for j in range(n)] for i in range(n)]
    solved = [f"({_determinant([[f'b{i}' if j == k else m[i][j] for j in range(n)] for i in range(n)])}) / ({_determinant(m)}) as w{k}" for k in range(n)]
    return f"select {', '.join(solved)} from (select {sums} from {table}) s"


#: The SQL of ols_fit_predict, by Cramer's rule as well.
ORACLES["ols_fit_predict"] = f"""with x as (select l_orderkey, l_linenumber, ln(l_quantity) / ln(2) as a, l_discount as b, l_tax as c, l_extendedprice as y from lineitem),
fit as ({_least_squares(['1', 'a', 'b', 'c'], 'y', 'x')}), ends as (select quantile_cont(y, 0.02) as lo, quantile_cont(y, 0.98) as hi from x)
select l_orderkey, l_linenumber, round(least(greatest(w0 + w1 * a + w2 * b + w3 * c, lo), hi), 2) as predicted from x, fit, ends"""

MEMORY_SQL = f"""with k as ({duck(KITS)}), b as ({duck(KIT_SCORES)}),
direct as (select p_partkey, name as bench_name, score::double as bench_score, 600 as match_score, 1 as candidates from k join b on kind = 0 and part = (100 + p_size)::varchar),
own as (select median(score) as m, count(*) as n from b where maker = 'Corsair' and speed = 3200 and gb = 16),
every as (select median(score) as m, count(*) as n from b where speed in (3600, 3666) and gb = 16),
spec as (select p_partkey, (select arg_min(name, (abs(score - m), name)) from b, own where maker = 'Corsair' and speed = 3200 and gb = 16) as bench_name, round_even(m, 0) as bench_score, 350 as match_score, n as candidates from k, own where kind = 1 and n > 0
union all select p_partkey, (select arg_min(name, (abs(score - m), name)) from b, every where speed in (3600, 3666) and gb = 16), round_even(m, 0), 300, n from k, every where kind = 2 and n > 0),
fit as ({_least_squares(['1', 'log2(speed / 2133.0)', '100.0 / cl', 'log2(gb / 8.0)'], 'score', 'b')}),
ends as (select greatest(1, quantile_cont(score, 0.02) - 2) as lo, greatest(30, quantile_cont(score, 0.98) + 8) as hi from b),
guess as (select p_partkey, null as bench_name, round_even(greatest(lo, least(hi, w0 + w1 * log2(v / 2133.0) + w2 * 100.0 / cl + w3 * log2(16 / 8.0))), 0) as bench_score, 100 as match_score, 0 as candidates
from (select p_partkey, case when kind = 0 then 3200 else 6000 end as v, case when kind = 0 then 16 else 46 end as cl from k where kind = 3 or kind = 0 and p_size::int % 2 = 1 or kind = 0 and p_size % 2 = 0 and p_partkey not in (select p_partkey from direct)) q, fit, ends)
select p_partkey, 'ram_direct' as tier, bench_name, bench_score, match_score::bigint as match_score, candidates::bigint as candidates from direct
union all select p_partkey, 'ram_spec_proxy', bench_name, bench_score, match_score, candidates from spec
union all select p_partkey, 'ram_spec_estimate', bench_name, bench_score, match_score, candidates from guess"""


@query(MEMORY_SQL)
def memory_match(spark, sf):
    d = P.match_memory(made(spark, sf, KIT_TITLES), made(spark, sf, KIT_TOLD), "p_partkey", "title", "name", "score", memory_type="ddr", memory_clock="clock", capacity="gb", module_count="modules")
    return d.select("p_partkey", "tier", "bench_name", "bench_score", "match_score", "candidates")


@query(f"""with k as ({duck(KITS)}) select p_partkey, case kind when 0 then 'gskill' when 1 then 'corsair' when 2 then 'adata' else 'kingston' end as brand, case when kind = 3 then 'DDR5' else 'DDR4' end as ddr, case when kind = 0 then 3200 else clock end as speed,
case when kind = 0 then 16 end as cl, nullif(gb, 0)::double as capacity_gb, modules, nullif(gb, 0)::double / modules as module_gb, case when kind = 0 then 'f4-3200c16d-' || (100 + p_size) || 'gvk' else '' end as parts from k""")
def memory_features(spark, sf):
    info = memory.module_info(F.col("title"), F.col("ddr"), F.col("clock"), F.col("gb"), F.col("modules"))
    d = made(spark, sf, KIT_TITLES).select("p_partkey", info.alias("f"))
    return d.select("p_partkey", F.array_join("f.brands", ",").alias("brand"), *[F.col(f"f.{c}").alias(c) for c in ("ddr", "speed", "cl", "capacity_gb", "modules", "module_gb")], F.array_join("f.parts", ",").alias("parts"))


LABELS = f"select p_partkey, each, n, form, case form when 0 then cast(each * n as string) || 'GB (' || cast(each as string) || 'Gx' || cast(n as string) || ')' when 1 then cast(each as string) || 'GB × ' || cast(n as string) when 2 then cast(n as string) || ' x ' || cast(each as string) || 'G' when 3 then cast(each as string) || '㎇' else 'none' end as label from (select p_partkey, {pick('p_size', [8, 16, 24, 32, 48])} as each, 1 + p_partkey % 4 as n, p_partkey % 5 as form from {{part}}) p"


@query(f"""select p_partkey, case when form < 3 then each * n when form = 3 then each end::int as capacity, case form when 0 then each * n || 'GB(' || each || 'Gx' || n || ')' when 1 then each * n || 'GB(' || each || 'GBx' || n || ')' when 2 then each * n || 'GB(' || each || 'Gx' || n || ')' when 3 then each || 'GB' end as label,
case when form < 3 then n::int end as modules, 'Kit' as base from ({duck(LABELS)}) l""")
def memory_labels(spark, sf):
    c = F.col("label")
    named = F.concat(F.lit("Kit "), F.when(F.col("form") == 0, F.regexp_replace(c, " ", "")).when(F.col("form") == 3, F.replace(c, F.lit("㎇"), F.lit("GB"))).otherwise(""))
    return made(spark, sf, LABELS).select("p_partkey", memory.kit_capacity(c).alias("capacity"), memory.capacity_label(c)["label"].alias("label"), specs.ram_module_count(c).alias("modules"), memory.base_name(named).alias("base"))


# What listings say

SPECS = f"""select p_partkey, p_size, 100 + p_size as n, {pick('p_partkey', ['1700', '1851', 'AM5', 'LGA 2011'])} as socket, {pick('p_partkey', ['DDR4', 'DDR5', 'DDR3'])} as ddr, {pick('p_partkey', ['ATX', 'M-ATX', 'E-ATX', 'Mini-ITX'])} as size,
{pick('p_size', [500, 1000, 2000, 4000])} as gb, p_partkey % 5 as fault from {{part}}"""
TEXTS = f"""select p_partkey, fault, '소켓: ' || replace(socket, ' ', '-') || ' / ' || ddr || ' / ' || size || ' / PCI-Express 4.0 x16 / 최대 ' || cast(4000 + 10 * p_size as string) || 'MHz' as board,
'RTX 카드 / ' || case when fault = 0 then '' else '권장 파워 ' || cast(5 * n as string) || 'W / ' end || 'PCIe5.0 x8 / 가로(길이): ' || cast(2 * n as string) || '.5mm' as card,
'지원보드규격: ' || size || ', ATX / VGA 길이: ' || cast(n as string) || '~' || cast(n + 100 as string) || 'mm / CPU 쿨러 높이: ' || cast(n as string) || case when fault = 1 then 'm' else 'mm' end as box,
case when fault = 2 then '수랭' else '공랭' end || ' / LGA1151 LGA1700 AM4 / 높이: ' || cast(n as string) || '.9mm' as cooler,
'SFX-L 규격 / ' || cast(5 * n as string) || 'W' as power,
case when fault = 3 then 'NVMe' else '용량: ' || case when gb < 1000 then cast(gb as string) || 'GB' else cast(gb / 1000 as int) || 'TB' end end || ' / DRAM 1GB' as drive,
'Kit DDR' || case when fault = 4 then '3' else '5' end || '-' || cast(4000 + 10 * p_size as string) || ' ' || cast(n as string) || 'GB' as kit, '램 개수: 2개 / DDR' || case when fault = 4 then '2' else '5' end as told from ({SPECS}) s"""
SPECS_SQL = f"""with s as ({duck(SPECS)}), r as (
select p_partkey, 'CPU' as category, case when socket <> 'LGA 2011' then case socket when 'AM5' then 'AMD5' else socket end || '|' || ddr end as spec from s
union all select p_partkey, 'Mainboard', case when socket <> 'LGA 2011' and ddr <> 'DDR3' then case socket when 'AM5' then 'AMD5' else socket end || '|' || ddr || '|PCIE4.0X16|' || case size when 'M-ATX' then 'MATX' when 'E-ATX' then 'EATX' when 'Mini-ITX' then 'ITX' else size end || '|' || (4000 + 10 * p_size) end from s
union all select p_partkey, 'GPU', case when fault > 0 then 5 * n || '|PCIE5.0X8|' || 2 * n end from s
union all select p_partkey, 'Case', case size when 'E-ATX' then 'EATX' else 'ATX' end || '|' || (n + 100) || '|' || n from s
union all select p_partkey, 'Cooler', case when fault <> 2 then '115X,1700,AMD4|' || n end from s
union all select p_partkey, 'Power', 'SFXL|' || 5 * n from s
union all select p_partkey, 'SSD', case when fault <> 3 then gb::varchar end from s
union all select p_partkey, 'RAM', case when fault <> 4 then 'DDR5|' || (4000 + 10 * p_size) || '|' || n || '|2' end from s)
select p_partkey, category, spec from r"""


@query(SPECS_SQL)
def part_specs(spark, sf):
    d = made(spark, sf, TEXTS)
    of = {"CPU": ("board", "board"), "Mainboard": ("fault", "board"), "GPU": ("fault", "card"), "Case": ("fault", "box"), "Cooler": ("fault", "cooler"), "Power": ("fault", "power"), "SSD": ("fault", "drive"), "RAM": ("kit", "told")}
    told = lambda k, n, c: F.to_csv(specs.refined_spec(k, F.col(n).cast("string"), F.col(c), F.col(c)), {"sep": "|"})
    rows = [F.struct(F.lit(k).alias("category"), told(k, n, c).alias("spec")) for k, (n, c) in of.items()]
    return d.select("p_partkey", F.explode(F.array(*rows)).alias("x")).select("p_partkey", "x.*")


REASONED = f"""select p_partkey, w, 'CPU 쿨러 ' || {pick('p_partkey', ['공랭', '가이드', '서버용', '1.5U', 'S1U'])} as cooler, {pick('p_partkey', ['미들타워', 'RISER CABLE', '4U', 'IPC 섀시', '케이스 9U'])} as box,
'SSD ' || {pick('p_partkey', ['M.2 SATA', '변환 어댑터', 'U.2', '중고 케이블', 'm-sata'])} as drive, {pick('p_partkey', ['B650 보드', 'B650 RTX 패키지', 'B650 패키지', 'USED board', '12,000원 [혜택]'])} as board,
{pick('p_partkey', ['DDR5 온다이 ECC 32GB', 'DDR5 ECC', 'DDR3 8GB', 'SDRAM', 'DDR4 노트북'])} as kit, {pick('p_partkey', ['1700', '1851', '2066', '', 'AMD5'])} as socket from (select p_partkey, p_partkey % 5 as w from {{part}}) p"""


@query(f"""select p_partkey, {pick('w', ['-', 'accessory', 'server', 'server', '-'])} as cooler, {pick('w', ['-', 'accessory', 'rackmount', 'rackmount', '-'])} as box, {pick('w', ['-', 'accessory', 'enterprise', 'used', '-'])} as drive, w = 4 as msata,
{pick('w', ['-', 'bundle', '-', 'used', 'benefit'])} as board, {pick('w', ['-', 'server_or_notebook', 'old_generation', 'unsupported_memory', 'server_or_notebook'])} as kit, w not in (2, 3) as cpu_socket, w <> 3 as cooler_socket from ({duck(REASONED)}) r""")
def part_reasons(spark, sf):
    told = lambda c: F.coalesce(c, F.lit("-"))
    return made(spark, sf, REASONED).select(
        "p_partkey",
        told(Q.cooler_reason(F.col("cooler"), F.lit(""))).alias("cooler"),
        told(Q.case_reason(F.col("box"), F.lit("RISER CABLE"))).alias("box"),
        told(Q.storage_reason(F.col("drive"))).alias("drive"),
        Q.is_msata(F.col("drive")).alias("msata"),
        told(Q.name_reason("Mainboard", F.col("board"))).alias("board"),
        told(Q.name_reason("RAM", F.col("kit"))).alias("kit"),
        Q.valid_socket("CPU", F.col("socket")).alias("cpu_socket"),
        Q.valid_socket("Cooler", F.col("socket")).alias("cooler_socket"),
    )


# Cards

KIT_CARDS = f"""select p_partkey, kind, a, p, '<ul><li id="productItem' || cast(p_partkey as string) || '"><p class="prod_name"><a href="/info/?pcode=' || cast(p_partkey as string) || '">G.SKILL ' || case when kind = 2 then '' else 'DDR5-6000 ' end || 'TRIDENT' || case when kind = 1 then ' 16GB' else '' end || '</a></p><div class="spec_list"><a>램 개수: 1개</a></div>' ||
case when kind = 0 then '<div class="prod_pricelist"><ul><li>' || cast(2 * a as string) || 'GB(' || cast(a as string) || 'Gx2)<p class="price_sect"><strong>' || cast(2 * p as string) || '</strong>원</p> 4,000원/1GB</li><li>' || cast(a as string) || 'GB <p class="price_sect"><strong>' || cast(p as string) || '</strong>원</p></li><li>' || cast(a as string) || 'GB <a aria-label="' || cast(a as string) || 'GB ' || cast(p + 10 as string) || '원">x</a></li></ul></div>'
when kind = 3 then '<p class="price_sect"><strong>900</strong></p>' else '<p class="price_sect"><strong>' || cast(p as string) || '</strong></p>' end || '</li></ul>' as html from (select p_partkey, p_partkey % 4 as kind, {pick('p_size', [8, 16, 32])} as a, 20000 + 1000 * p_size as p from {{part}}) c"""


@query(f"""with c as ({duck(KIT_CARDS)}), r as (
select p_partkey, 'multi-option' as mode, 'G.SKILL DDR5-6000 TRIDENT (' || 2 * a || 'GB(' || a || 'Gx2))' as name, 2 * p as price, 2 * a as capacity, 2 as module_count from c where kind = 0
union all select p_partkey, 'multi-option', 'G.SKILL DDR5-6000 TRIDENT (' || a || 'GB)', p, a, 1 from c where kind = 0
union all select p_partkey, 'single', 'G.SKILL DDR5-6000 TRIDENT 16GB', p, 16, 1 from c where kind = 1
union all select p_partkey, 'spec-missing', null, null, null, null from c where kind = 2
union all select p_partkey, 'capacity-missing', null, null, null, null from c where kind = 3)
select p_partkey, p_partkey::varchar as code, mode, name, price::bigint as price, capacity::int as capacity, module_count::int as module_count from r""")
def memory_cards(spark, sf):
    found = V.listed(C.cards(made(spark, sf, KIT_CARDS), "p_partkey"), "RAM")
    return V.memory_rows(found, ["p_partkey", "code"]).select("p_partkey", "code", "mode", "name", "price", "capacity", "module_count")


DRIVE_CARDS = f"""select p_partkey, kind, p, '<div class="dnw-product-list-item" data-pcode="' || cast(p_partkey as string) || '"><div class="dnw-product-image"><a aria-label="Drive ' || cast(p_partkey as string) || case when kind < 2 then ' 2TB' else '' end || ' 상세보기"><img alt="x"></a></div><span class="price">' || cast(p as string) || '원</span>' ||
case kind when 0 then '<div data-testid="ProductListPriceCompare"><ul><li><span>2TB</span><a aria-label="2TB ' || cast(2 * p as string) || '원">x</a></li><li><span>500GB</span><a>' || cast(p as string) || ' 원</a></li><li><span>500GB</span> ' || cast(p + 5 as string) || '원</li><li><span>128GB</span> 30000원</li></ul></div>'
when 2 then '<p>저장용량: 1TB</p>' else '' end || '</div>' as html from (select p_partkey, p_partkey % 5 as kind, 30000 + 100 * p_size as p from {{part}}) c"""


@query(f"""with c as ({duck(DRIVE_CARDS)}), r as (
select p_partkey, 'multi-option' as mode, 'Drive ' || p_partkey || ' (2TB)' as name, 2 * p as price, 2000 as capacity from c where kind = 0
union all select p_partkey, 'multi-option', 'Drive ' || p_partkey || ' (500GB)', p, 500 from c where kind = 0
union all select p_partkey, 'single-name', 'Drive ' || p_partkey || ' 2TB', p, 2000 from c where kind = 1
union all select p_partkey, 'fallback', 'Drive ' || p_partkey || ' (1TB)', p, 1000 from c where kind = 2
union all select p_partkey, 'capacity-missing', null, null, null from c where kind > 2)
select p_partkey, p_partkey::varchar as code, mode, name, price::bigint as price, capacity::int as capacity from r""")
def drive_cards(spark, sf):
    found = V.listed(C.cards(made(spark, sf, DRIVE_CARDS), "p_partkey"), "SSD")
    return V.drive_rows(found, ["p_partkey", "code"]).select("p_partkey", "code", "mode", "name", "price", "capacity")


LISTS = "select p_partkey, '<ul id=\"recom_search_ul\"><li><a href=\"/d?ProductNo=' || cast(p_partkey as string) || '\">x</a><div class=\"txt_box\"><p class=\"name\"> ' || p_type || case p_partkey % 3 when 0 then ' 게이밍 PC' when 1 then ' 사무용  PC' else ' 게이밍 사무용' end || '</p></div></li><li>none</li></ul>' as html from {part}"


@query("""select p_partkey, '/d?ProductNo=' || p_partkey as href, p_type || case p_partkey % 3 when 0 then ' 게이밍 PC' when 1 then ' 사무용 PC' else ' 게이밍 사무용' end as title, p_partkey % 3 = 1 as conflict, p_partkey::varchar as product_id, 'https://shop.example/detail?ProductNo=' || p_partkey as url from part""")
def estimate_lists(spark, sf):
    d = C.listed_estimates(made(spark, sf, LISTS), "p_partkey")
    found = E.estimate_id(V.absolute(F.col("item.href"), "https://www.shop.example"), "shop.example")
    return d.select("p_partkey", "item.href", "item.title", E.usage_conflict(F.col("item.title"), F.lit("GAMING")).alias("conflict"), found.alias("product_id"), E.estimate_url(found, "https://shop.example/detail").alias("url"))


_LINE = lambda part, name, price, n: f"'<tr><td>{part}</td><td>' || {name} || '</td><td>' || cast({price} as string) || '원</td><td>' || cast({n} as string) || '개</td></tr>'"
BUILDS = """select p_partkey, p_type, p_partkey % 5 as kind, 1000 * (100 + p_size) as u from {part}"""
TABLES = f"""select p_partkey, '<table><tr><th>PC 주요부품</th><th>개당 가격</th><th>수량</th></tr>' || {_LINE('CPU', "'cpu ' || p_type", 'u', 1)} || {_LINE('메모리', "'ram a'", 'u + 1', 2)} || {_LINE('메모리', "'ram b'", 'u + 2', 1)} || {_LINE('메인보드', "'board'", 'u + 3', 1)} ||
{_LINE('SSD', "'disk'", 'u + 4', 1)} || {_LINE('파워', "'power'", 'u + 5', 1)} || case when kind = 4 then '' else {_LINE('케이스', "'case'", 'u + 6', 1)} end || case when kind in (1, 2) then '' else {_LINE('그래픽카드', "'card'", '2 * u', 1)} end || case when kind = 3 then '' else {_LINE('CPU쿨러', "'fan'", 'u + 7', 1)} end ||
'</table><p>' || '</p>' as html, kind from (select p_partkey, p_type, kind, u from ({BUILDS}) b) c"""
SAID = f"select p_partkey, case when p_partkey % 2 = 0 then 'OFFICE' else 'GAMING' end as usage, case kind when 1 then '내장 그래픽' when 3 then '기본쿨러' else '' end as table_text from ({BUILDS}) b"


@query(f"""with b as (select *, case when p_partkey % 2 = 0 then 'OFFICE' else 'GAMING' end as usage from ({duck(BUILDS)}) x),
r as (select *, case when kind = 4 then 'MISSING_CASE' when kind = 2 or kind = 1 and usage = 'GAMING' then 'MISSING_GPU' end as reason, 2 * (u + 1) + u + 2 as ram, case when kind in (1, 2) then 0 else 2 * u end as gpu, case when kind = 3 then 0 else u + 7 end as cooler from b),
s as (select *, 5 * u + 18 + ram + gpu + cooler as total from r)
select p_partkey, usage, reason, case when reason is null then total end::bigint as parts_total, case when reason is null then 'ram a | ram b' end as ram_name, case when reason is null then ram end::bigint as ram_price, case when reason is null then round(100 * ram / total, 4) end as ram_ratio, case when reason is null then gpu end::bigint as gpu_price from s""")
def estimate_builds(spark, sf):
    tables = C.part_tables(made(spark, sf, TABLES), "p_partkey")
    merged = E.merged_parts(E.part_lines(tables, ["p_partkey"]), ["p_partkey"])
    d = E.build_checked(merged, made(spark, sf, SAID), ["p_partkey"])
    ram, gpu = (F.get("p", E.PARTS.index(x)) for x in ("RAM", "GPU"))
    return d.select("p_partkey", "usage", "reason", "parts_total", ram["name"].alias("ram_name"), ram["price"].alias("ram_price"), ram["ratio"].alias("ram_ratio"), gpu["price"].alias("gpu_price"))


# Estimates and ratios

SHARES = [7, 11, 5, 4, 3, 2, 2, 1]
_UNIT = lambda i: f"({SHARES[i]} * (20 + (k * {i + 3}) % 17) * (1 + cast(floor(o_totalprice / 20000) as bigint)))"
_N = lambda i: 2 if i == 3 else 1
AMOUNTS = "select k, o_totalprice, case when k % 101 = 0 then 'VIDEO' when k % 2 = 0 then 'office ' else 'GAMING' end as usage, k - case when k % 50 = 3 then 2 else 0 end as id, " + ", ".join(
    f"case when {i} = 1 and k % 6 = 0 then 0 when {i} = 0 and k % 113 = 0 then 0 else {_UNIT(i)} end as u{i}" for i in range(8)
) + " from (select cast(o_orderkey as bigint) as k, o_totalprice from {orders}) o"
TOTAL = " + ".join(f"{_N(i)} * u{i}" for i in range(8))
CELLS = f"select k as row, usage as _c0, cast(id as string) as _c1, 'PC' as _c2, case when k % 109 = 0 then '' else cast({TOTAL} + case when k % 103 = 0 then 5 when k % 7 = 0 then 1 else 0 end as string) end as _c3, " + ", ".join(
    f"' Part  {i} ' as _c{4 + 5 * i}, case when k % 3 = 0 then '' else cast(u{i} as string) end as _c{5 + 5 * i}, cast(case when k % 107 = 0 then -{_N(i)} else {_N(i)} end as string) as _c{6 + 5 * i}, cast({_N(i)} * u{i} as string) as _c{7 + 5 * i}, '0' as _c{8 + 5 * i}" for i in range(8)
) + f", 'u' as _c44, 'd' as _c45 from ({AMOUNTS}) a"
STEP, RADIUS = 1000, 500
CLEAN_SQL = f"""a as ({duck(AMOUNTS)}), v as (select k, upper(trim(usage)) as usage, id, {TOTAL} + case when k % 103 = 0 then 5 when k % 7 = 0 then 1 else 0 end as budget, {', '.join(f'{_N(i)} * u{i} as p{i}' for i in range(8))},
case when k % 101 = 0 then 'USAGE' when k % 109 = 0 then 'NUMBER' when k % 107 = 0 then 'NEGATIVE' when k % 113 = 0 then 'FREE_CPU' when k % 103 = 0 then 'SUM' when k % 2 = 1 and u1 = 0 then 'NO_GPU' end as bad from a),
i as (select *, case when bad is null and row_number() over (partition by usage, id, bad is null order by k) > 1 then 'DUPLICATE_ID' else bad end as worse from v),
c as (select *, case when worse is null and row_number() over (partition by usage, {', '.join(f'p{i}' for i in range(8))}, worse is null order by k) > 1 then 'DUPLICATE_CONFIG' else worse end as reason from i)"""


def _cleaned(spark, sf) -> DataFrame:
    return E.cleaned(E.validated(made(spark, sf, CELLS)))


@query(f"with {CLEAN_SQL} select coalesce(reason, 'kept') as reason, count(*) as n from c group by 1")
def estimate_reasons(spark, sf):
    return Q.reason_report(_cleaned(spark, sf), F.col("reason"))


_LO = f"case when usage = 'OFFICE' then greatest({STEP}, floor(min(budget) / {STEP}) * {STEP}) else ceil(min(budget) / {STEP}) * {STEP} end::bigint"
_HI = f"case when usage = 'OFFICE' then ceil(max(budget) / {STEP}) * {STEP} else floor(max(budget) / {STEP}) * {STEP} end::bigint"
RATIO_SQL = f"""with {CLEAN_SQL}, e as (select * from c where reason is null),
g as (select usage, unnest(generate_series({_LO}, {_HI}, {STEP})) as point from e group by usage),
n as (select e.*, point, abs(budget - point) as d, count(*) filter (abs(budget - point) <= {RADIUS}) over (partition by e.usage, point) as near, row_number() over (partition by e.usage, point order by abs(budget - point), budget, k) as r from e join g on e.usage = g.usage),
s as (select *, case when usage = 'OFFICE' then 1 else 1 / (1 + pow(d / {STEP}, 2)) end as w from n where usage = 'OFFICE' or case when near >= 8 then d <= {RADIUS} else r <= 12 end),
x as (select usage, point as budget, {', '.join(f'0.6 * sum(p{i} / budget * w) / sum(w) + 0.4 * median(p{i} / budget) as x{i}' for i in range(8))} from s group by usage, point),
y as (select usage, budget, {', '.join(f"round((x{i} / ({' + '.join(f'x{j}' for j in range(8))}))::decimal(38,18), 6)::decimal(8,6) as y{i}" for i in range(8))} from x),
z as (select *, 1 - ({' + '.join(f'y{i}' for i in range(8))}) as rest, greatest({', '.join(f'y{i}' for i in range(8))}) as top from y)
select usage, budget, {', '.join(f"(y{i} + case when y{i} = top{''.join(f' and y{j} <> top' for j in range(i))} then rest else 0 end)::decimal(8,6)::varchar as {E.RATIOS[i]}" for i in range(8))} from z"""


@query(RATIO_SQL)
def budget_ratios(spark, sf):
    table = E.ratio_table(_cleaned(spark, sf).where("reason is null"), STEP, RADIUS)
    return E.in_order(table).select("usage", "budget", *[F.col(r).cast("string").alias(r) for r in E.RATIOS])


POOL = f"select p_partkey, p_partkey % 8 as kind, {pick('p_size', ['1700', 'AMD5', '1151V2'])} as socket, {pick('p_size', ['ATX', 'MATX', 'EATX', 'ITX'])} as size, {pick('p_size', ['DDR4', 'DDR5'])} as memory, 100 + p_size as length, 120 + (p_size * 7) % 50 as height, 10 * p_size as watt, (p_partkey * 37) % 101 as score, cast((p_partkey * 7919) % 100003 as bigint) as price, cast(p_partkey as string) as name from {{part}}"
_RANK = lambda c: f"list_position(['ITX', 'MATX', 'ATX', 'EATX'], {c})"
#: All builds of the cheapest offers of each kind, compared by inequalities.
BUILD_SQL = f"""with q as ({duck(POOL)}), cheap as (select * from q qualify row_number() over (partition by kind, case when kind < 3 then socket end, case when kind in (0, 1, 2) then memory end, case when kind in (1, 4) then size end,
case when kind in (4, 5) then length end, case when kind in (3, 4) then height end, case when kind in (5, 6) then watt end, case when kind = 3 then socket end, kind in (0, 5) and score < {{score}} order by price, name) = 1),
strong as (select * from cheap where kind not in (0, 5) or score >= {{score}}),
card as (select g.length, g.price + w.price as price, g.price as gpu, w.price as power from strong g join strong w on g.kind = 5 and w.kind = 6 and w.watt >= g.watt),
disk as (select min(price) as price from q where kind = 7)
select c.price + m.price + r.price + f.price + k.price + card.price + disk.price as total_price, c.price as cpu, gpu, m.price as mainboard, r.price as ram, disk.price as ssd, power, k.price as "case", f.price as cooler
from strong c join strong m on c.kind = 0 and m.kind = 1 and m.socket = c.socket and m.memory = c.memory join (select memory, min(price) as price from q where kind = 2 group by 1) r on r.memory = c.memory
join strong f on f.kind = 3 and f.socket = c.socket join strong k on k.kind = 4 and {_RANK('m.size')} <= {_RANK('k.size')} and f.height <= k.height join card on card.length <= k.length, disk order by 1 limit 1"""


def _pool(spark, sf) -> dict[str, DataFrame]:
    q = made(spark, sf, POOL)
    of = lambda i, *more: q.where(F.col("kind") == i).select("name", "price", *more)
    sockets = F.when(F.col("socket") == "1151V2", "115X").otherwise(F.col("socket"))
    return {
        "cpu": of(0, "socket", "memory", "score"), "mainboard": of(1, "socket", "memory", "size"), "ram": of(2, "memory"), "cooler": of(3, F.concat(F.lit("AMD4, "), sockets).alias("socket"), F.col("height").alias("cooler_length")),
        "case": of(4, "size", F.col("length").alias("gpu_length"), F.col("height").alias("cooler_length")), "gpu": of(5, "length", F.col("watt").alias("power"), "score"), "power": of(6, F.col("watt").alias("wattage")), "ssd": of(7),
    }


@query(f"select total_price::bigint as total_price from ({BUILD_SQL.format(score=0)}) b")
def cheapest_build(spark, sf):
    return B.cheapest_strong_build(_pool(spark, sf), 0, 0).select("total_price")


@query(f"select total_price::bigint as total_price, {', '.join(f'"{p}"::bigint as {p}_price' for p in B.PARTS)}, 40.0::double as cpu_score from ({BUILD_SQL.format(score=40)}) b")
def strong_build(spark, sf):
    """The cheapest build whose processor and card score 40 at least, with the price of each of its parts."""
    return B.cheapest_strong_build(_pool(spark, sf), 40, 40).select("total_price", *[f"{p}_price" for p in B.PARTS], "cpu_score")


@query(f"""with b as ({BUILD_SQL.format(score=40)}), y as (select total_price, {', '.join(f'round((b."{p}"::double / total_price)::decimal(38,18), 6)::decimal(8,6) as y{i}' for i, p in enumerate(B.PARTS))} from b),
z as (select *, 1 - ({' + '.join(f'y{i}' for i in range(8))}) as rest, greatest({', '.join(f'y{i}' for i in range(8))}) as top from y)
select 'HIGH_END' as usage, total_price::bigint as budget, {', '.join(f"(y{i} + case when y{i} = top{''.join(f' and y{j} <> top' for j in range(i))} then rest else 0 end)::decimal(8,6)::varchar as {r}" for i, r in enumerate(E.RATIOS))} from z""")
def high_end_ratios(spark, sf):
    """The ratio row of the cheapest strong build."""
    build = B.cheapest_strong_build(_pool(spark, sf), 40, 40)
    return E.high_end(build).select("usage", "budget", *[F.col(r).cast("string").alias(r) for r in E.RATIOS])


STORED = f"select 'OFFICE' as usage, 500 as budget union all select 'GAMING', 500 union all select 'HIGH_END', 900 union all select 'VIDEO_EDITING', 100"
LOADED = "select case when p_size % 2 = 0 then 'OFFICE' else 'GAMING' end as usage, 100 * p_size as budget from {part} group by p_size union all select 'HIGH_END', max(100 * p_size) + 1 from {part}"


@query(f"""with n as ({duck(LOADED)}), o as ({STORED}) select usage, budget::bigint as budget, '0.125000' as cpu_ratio, true as fresh from n
union all select usage, budget, '0.250000', false from o where usage in ('OFFICE', 'GAMING') and (usage, budget) not in (select (usage, budget) from n)""")
def ratio_store(spark, sf):
    """New ratios by CSV and back, loaded over old ones; all ratios are equal but the old ones' first two."""
    folder = new_folder(spark)
    even = lambda d, first: d.select("usage", F.col("budget").cast("long").alias("budget"), *[F.lit(first if i == 0 else 0.0 if i == 1 and first == 0.25 else 0.125).cast("decimal(8,6)").alias(r) for i, r in enumerate(E.RATIOS)])
    catalog.store_table(spark, folder, catalog.RATIO_TABLE).publish(even(spark.sql(STORED), 0.25).withColumn("updated_at", F.lit("2020-01-01").cast("timestamp")))
    catalog.write_csv(E.cents(even(made(spark, sf, LOADED), 0.125)).select(*reversed(["usage", "budget", *E.RATIOS])), f"{folder}/ratios-csv")
    d = catalog.load_ratios(spark, catalog.read_ratios(spark, f"{folder}/ratios-csv"), folder)
    return d.select("usage", "budget", F.col("cpu_ratio").cast("string").alias("cpu_ratio"), (F.col("updated_at") > "2021-01-01").alias("fresh"))


#: Ratios of which some have a usage, a budget or shares that may not be, and some stand twice; there are two strongest builds.
FAULTY = """select case when p_partkey % 11 = 0 then 'X' when p_partkey <= 2 then 'HIGH_END' when p_partkey % 2 = 0 then 'OFFICE' else 'GAMING' end as usage, case when p_partkey % 13 = 0 then -1 when p_partkey % 7 = 0 then 500 else 1000 * p_partkey end as budget,
case when p_partkey % 17 = 0 then 0.2 when p_partkey % 19 = 0 then 1.5 when p_partkey % 23 = 0 then null else 0.125 end as first from {part}"""


@query(f"""with r as ({duck(FAULTY)}), e as (
select 'USAGE' as fault, count(*) filter (usage = 'X') as n from r union all select 'BUDGET', count(*) filter (budget < 0) from r union all select 'RANGE', count(*) filter (first is null or first > 1) from r
union all select 'SUM', count(*) filter (first is null or first <> 0.125) from r union all select 'DUPLICATE', count(*) from (select usage, budget from r group by 1, 2 having count(*) > 1) d union all select 'HIGH_END', 1)
select fault, n::bigint as n from e where n > 0""")
def ratio_fault_counts(spark, sf):
    """What keeps an unsound ratio table from being published."""
    d = made(spark, sf, FAULTY)
    ratios = d.select("usage", F.col("budget").cast("long").alias("budget"), *[(F.col("first") if i == 0 else F.lit(0.125)).cast("decimal(8,6)").alias(r) for i, r in enumerate(E.RATIOS)])
    return E.ratio_faults(ratios)


LISTED = f"select p_partkey, cast(case when p_partkey % 9 = 0 then 0 else 1000 * p_size end as string) as price, p_name || case when p_partkey % 2 = 0 then ', \"new\"' else '' end as name, case when p_partkey % 7 = 0 then null else 'ATX' end as size, cast(p_size as string) || case when p_partkey % 8 = 0 then '.5' when p_partkey % 8 = 4 then '.0' else '' end as wattage, cast(p_partkey as string) as product_code, 'u' as product_url from {{part}}"


@query(f"""select name, price::bigint as price, size, floor(wattage::double)::bigint as wattage, product_code, product_url from ({duck(LISTED)}) l where price <> '0' and size is not null and p_partkey % 8 <> 0
qualify row_number() over (partition by name, price order by p_partkey) = 1""")
def listing_store(spark, sf):
    """Listings to CSV and back, found in their folder by name, checked and published."""
    folder = new_folder(spark)
    d = made(spark, sf, LISTED)
    catalog.write_csv(d.drop("p_partkey"), f"{folder}/csv/data_power.csv")
    tables, _ = catalog.scan_folder(spark, f"{folder}/csv")
    store = catalog.store_table(spark, f"{folder}/store", "power")
    store.create()
    store.publish(catalog.storable(tables["power"], "power", [F.col("product_code").cast("long")]))
    return store.read()


@query("""select event_id, user_id, day from (select event_id, user_id, ts::date::varchar as day, event_type from events) e
where (user_id, day) not in (select (user_id, ts::date::varchar) from events group by 1 having count(distinct event_type) > 1)""")
def usage_conflicts(spark, sf):
    """Events of users and days that stand under one type only."""
    e = t(spark, sf, "events").select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    e = e.withColumn("_k", F.concat_ws("/", F.col("user_id").cast("string"), "day"))
    return M.without_conflicts(e, "_k", "event_type").select("event_id", "user_id", "day")


@query("""select l_orderkey, l_returnflag as part, string_agg(l_partkey::varchar, ' | ' order by l_linenumber, l_partkey::varchar) as name, case when count(*) = 1 then min(floor(l_extendedprice))::bigint end as unit_price,
sum(l_quantity)::bigint as quantity, sum(floor(l_extendedprice) * l_quantity)::bigint as price from lineitem group by 1, 2""")
def merged_part_lines(spark, sf):
    d = t(spark, sf, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("part"), F.col("l_linenumber").alias("line"), F.col("l_partkey").cast("string").alias("name"), F.floor("l_extendedprice").alias("unit_price"), F.col("l_quantity").cast("long").alias("quantity"))
    return E.merged_parts(d, ["l_orderkey"])
