"""Queries of whole jobs: listings of all categories from pages, with their counters, and listings with benchmarks' scores.

As in market_queries, pages are made from columns of `part`; the SQL works from those columns alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.functions import text as T
from pricewright.operators import integrate, listing
from pricewright.operators.storage_match import match_storage

from .catalog_queries import query
from .market_queries import BEST, CPU_SCORES, CPU_TITLES, CPUS, GPU_SCORES, GPU_TITLES, GPUS, duck, made, pick

#: What a sound card of each category tells, and the attributes it gives.
SOUND = {
    "CPU": ("소켓: 1700 / DDR5", "1700|DDR5"),
    "GPU": ("권장 파워 550W / PCIe5.0 x8 / 가로(길이): 300.5mm", "550|PCIE5.0X8|300"),
    "Mainboard": ("소켓: 1700 / DDR5 / ATX / PCI-Express 4.0 x16 / 최대 6000MHz", "1700|DDR5|PCIE4.0X16|ATX|6000"),
    "RAM": ("램 개수: 1개", "DDR5|6000|16|1"),
    "SSD": ("NVMe", "1000"),
    "Power": ("SFX-L 규격 / 650W", "SFXL|650"),
    "Case": ("지원보드규격: ATX / VGA 길이: 300mm / CPU 쿨러 높이: 160mm", "ATX|300|160"),
    "Cooler": ("공랭 / LGA1700 AM4 / 높이: 150.9mm", "1700,AMD4|150"),
}
#: Names by kind: 2 is used, 6 and 7 are the category's own faults; what is no fault of a category is sound there.
OWN = {"Mainboard": {6: " RTX 패키지"}, "SSD": {6: " U.2 1TB", 7: " 변환 어댑터 1TB", 5: "", 8: " mSATA 1TB"}, "Case": {6: " 4U", 7: " RISER CABLE"}, "Cooler": {6: " 가이드", 7: " 서버용"}}


def _name(category: str) -> str:
    if category == "RAM":
        return "case kind when 5 then 'KIT DDR5 16GB no' when 6 then 'KIT DDR3-1600 16GB no' else 'KIT DDR5-6000 16GB no' end || cast(p_size as string) || case when kind = 2 then ' 중고' else '' end"
    plain = " 1TB" if category == "SSD" else ""
    ends = {2: f" 중고{plain}"} | OWN.get(category, {})
    return f"'{category} item ' || cast(p_size as string) || case kind " + " ".join(f"when {k} then '{v}'" for k, v in ends.items()) + f" else '{plain}' end"


#: As a number, and as a page writes it.
PRICE = "case kind when 3 then 900 when 4 then 99000000 else 100000 + 1000 * p_size end"
WRITTEN = "case kind when 3 then '900' when 4 then '99,000,000' else cast(100 + p_size as string) || ',000' end"
KINDS = "select p_partkey, p_size, p_partkey % 10 as kind from {part}"


def pages(category: str) -> str:
    """A page for each part: 0 has no name, 1 no price, 3 and 4 prices out of band, 5 no attributes, 9 no code."""
    told = SOUND[category][0]
    return f"""select p_partkey as page_id, '<ul><li id="productItem' || cast(p_partkey as string) || '"><p class="prod_name"><a href="/info/' || case when kind = 9 then '' else '?pcode=' || cast(p_partkey as string) end || '">' ||
case when kind = 0 then '' else {_name(category)} end || '</a></p><div class="spec_list">' || case when kind = 5 then '' else '{told}' end || '</div>' || case when kind = 1 then '' else '<p class="price_sect"><strong>' || {WRITTEN} || '</strong></p>' end || '</li></ul>' as html from ({KINDS}) k"""


#: Kinds that give no rows, by the counters that tell them; kinds 0 and 1 have no name and price together.
GONE = {
    "CPU": {"price_removed": [3, 4], "spec_removed": [5]},
    "GPU": {"price_removed": [3, 4], "spec_removed": [5]},
    "Mainboard": {"price_removed": [3, 4], "spec_removed": [5], "mainboard_bundle_removed": [6]},
    "RAM": {"ram_price_missing": [3, 4], "ram_spec_missing": [5], "ram_consumer_removed": [2, 6], "price_removed": [3, 4], "spec_removed": [5]},
    "SSD": {"price_removed": [3, 4], "ssd_capacity_missing": [5], "ssd_enterprise_removed": [6], "ssd_accessory_removed": [7], "ssd_unsupported_interface_removed": [8], "spec_removed": [5]},
    "Power": {"price_removed": [3, 4]},
    "Case": {"price_removed": [3, 4], "spec_removed": [5], "case_rackmount_removed": [6]},
    "Cooler": {"price_removed": [3, 4], "spec_removed": [5], "cooler_accessory_removed": [6], "cooler_server_removed": [7]},
}
#: Kinds of every category; invalid names beside those of the name filter.
NAMES = {"Mainboard": [2, 6], "RAM": [2, 6], "SSD": [2, 6]}
INVALID = {"Case": [7], "SSD": [7]}
AFTER_PRICE = {"RAM": [], "SSD": [], "Cooler": [5, 6, 7], "Case": [5, 6, 7]}


def _kept(category: str) -> str:
    gone = sorted({0, 1, 2, *(k for ks in GONE[category].values() for k in ks), *INVALID.get(category, [])})
    return f"kind not in ({', '.join(map(str, gone))})"


def _in(kinds: list[int]) -> str:
    return f"kind in ({', '.join(map(str, kinds))})" if kinds else "false"


def _power(column: str) -> str:
    """A power supply without attributes is listed all the same, with what can be read."""
    return f"case when kind = 5 then '|' else {column} end"


def _rows_sql(category: str) -> str:
    spec = f"'{SOUND[category][1]}'"
    spec = _power(spec) if category == "Power" else spec
    return f"""select '{category}' as category, {_name(category)} as name, ({PRICE})::bigint as price, {spec} as spec, case when kind <> 9 then p_partkey::varchar end as product_code from ({duck(KINDS)}) k where {_kept(category)}
qualify row_number() over (partition by {_name(category)}, {PRICE} order by p_partkey) = 1"""


@query(" union all ".join(f"({_rows_sql(c)})" for c in SOUND))
def listing_rows(spark, sf) -> DataFrame:
    """The listings of all categories."""
    out = []
    for c in SOUND:
        rows, _ = listing.saved_pages(made(spark, sf, pages(c)), c)
        told = F.to_csv(F.struct(*[F.col(a) for a in listing.ATTRIBUTES[c]]), {"sep": "|"})
        out.append(rows.select(F.lit(c).alias("category"), "name", "price", told.alias("spec"), "product_code"))
    return reduce(DataFrame.unionByName, out)


def _counters_sql(category: str) -> str:
    names = NAMES.get(category, [2])
    kept = _kept(category)
    counts = {"cards": "true", "kept_products": kept, "name_missing": "kind in (0, 1)", "price_before": "kind > 1", "consumer_name_removed": _in(names), "invalid_name_removed": _in(names + INVALID.get(category, [])), "product_identity_missing": "kind = 9"}
    counts |= {k: _in(v) for k, v in GONE[category].items()}
    counts["price_after"] = f"({kept}) or {_in(AFTER_PRICE.get(category, [5]) if category != 'Power' else [])}"
    counts["rows_before"] = kept
    if category not in ("RAM", "SSD"):
        counts["price_too_high_removed"] = "kind = 4"
    told = [f"select '{category}' as category, '{k}' as counter, count(*) filter ({test}) as n from k" for k, test in counts.items()]
    told.append(f"select '{category}', 'rows_after', count(*) from r where category = '{category}'")
    return " union all ".join(told)


@query(f"with k as ({duck(KINDS)}), r as ({' union all '.join(f'({_rows_sql(c)})' for c in SOUND)}) select category, counter, n::bigint as n from ({' union all '.join(_counters_sql(c) for c in SOUND)}) x where n > 0")
def listing_counters(spark, sf) -> DataFrame:
    """The counters of all categories, without those that are 0 and those that only count variants."""
    out = []
    for c in SOUND:
        _, counts = listing.saved_pages(made(spark, sf, pages(c)), c)
        out += [(c, k, n) for k, n in counts.items() if n and k not in VARIANTS]
    return spark.createDataFrame(out, "category string, counter string, n long")


VARIANTS = ["ram_single_products", "ssd_single_name_products", "ssd_base_valid_products"]


# Models of every family

#: Names and keys; # is a number of so many digits from the part's size.
CPU_NAMES = [
    ("인텔 코어 울트라7 시리즈2 2##K Plus", "intel-ultra-7-2##k-plus"), ("Intel Core i5-120##F", "intel-core-i5-120##f"), ("Intel Processor 3##", "intel-processor-3##"), ("프로세서 3##T", "intel-processor-3##t"),
    ("인텔 제온 E-23##G", "intel-xeon-e23##g"), ("Intel 펜티엄 G64##", "intel-pentium-g64##"), ("Intel Celeron G59##", "intel-celeron-g59##"), ("AMD Ryzen 9 PRO 79##", "amd-ryzen-9-pro-79##"), ("AMD 라이젠7 98##X3D", "amd-ryzen-7-98##x3d"),
    ("AMD 라이젠 스레드리퍼 PRO 59##WX", "amd-threadripper-pro-59##wx"), ("AMD EPYC 73##P", "amd-epyc-73##p"), ("AMD 애슬론 2##GE", "amd-athlon-2##ge"), ("Some board", None),
]
GPU_NAMES = [
    ("ASUS 지포스 RTX 40## Ti SUPER", "nvidia-rtx-40##-ti-super", "NVIDIA"), ("MSI GTX 16## SUPER", "nvidia-gtx-16##-super", "NVIDIA"), ("GeForce GT 10##", "nvidia-gt-10##", "NVIDIA"), ("사파이어 라데온 RX 79## XTX", "amd-rx-79##-xtx", "AMD"),
    ("Radeon AI PRO R97##", "amd-ai-pro-r97##", "AMD"), ("Intel Arc B5##", "intel-arc-b5##", "INTEL"), ("AMD card with gt and arc", None, None),
]
SIZED = "select p_partkey, p_size, lpad(cast(p_size as string), 2, '0') as nn from {part}"


def _numbered(expression: str, values: list[str | None]) -> str:
    return f"replace((case ({expression}) % {len(values)} " + " ".join(f"when {i} then " + ("null" if v is None else f"'{v}'") for i, v in enumerate(values)) + " end), '##', nn)"


CHIP_NAMES = f"select p_partkey, {_numbered('p_partkey', [n for n, _ in CPU_NAMES])} as cpu, {_numbered('p_partkey', [n for n, _, _ in GPU_NAMES])} as gpu from ({SIZED}) s"


@query(f"select p_partkey, {_numbered('p_partkey', [k for _, k in CPU_NAMES])} as cpu_key, {_numbered('p_partkey', [k for _, k, _ in GPU_NAMES])} as gpu_key, {_numbered('p_partkey', [c for _, _, c in GPU_NAMES])} as chipset from ({duck(SIZED)}) s")
def chip_families(spark, sf) -> DataFrame:
    """Keys of every family of processors and graphics, and whose chip it is."""
    cpu, gpu = F.col("cpu"), F.col("gpu")
    return made(spark, sf, CHIP_NAMES).select("p_partkey", T.cpu_model_key(cpu).alias("cpu_key"), T.gpu_model_key(gpu).alias("gpu_key"), T.chipset_brand(gpu).alias("chipset"))


# Storage by every tier

#: 0: the model itself; 1: a model of its family; 2: its series; 3: a model that begins alike, if it is alike enough; 4: any drive
#: of the brand; 5: no brand.
DRIVES = f"""select p_partkey, p_size, p_partkey % 6 as kind, case p_partkey % 6 when 0 then 'Lexar NM' || cast(100 + p_size as string) || ' NVMe SSD 1TB' when 1 then 'Samsung PM' || cast(1000 + p_size as string) || 'A NVMe SSD 1TB'
when 2 then 'Seagate ' || {pick('p_size', ['IronWolf', 'Nytro', 'Barbican'])} || ' SSD 1TB' when 3 then 'Crucial P7' || lpad(cast(p_size as string), 2, '0') || ' NVMe SSD 1TB' when 4 then 'Patriot NVMe SSD 1TB' else 'drive 1TB' end as name from {{part}}"""
DRIVE_SCORES = f"""select name, cast(score as double) as score from (
select 'Lexar NM' || cast(100 + p_size as string) || ' NVMe SSD 1TB' as name, 1000 + p_size as score from {{part}} group by p_size
union all select 'Samsung PM' || cast(1000 + p_size as string) || ' NVMe SSD 1TB', 2000 + p_size from {{part}} group by p_size
union all select 'Seagate ' || x || ' SSD 1TB', 3000 from (select distinct {pick('p_size', ['IronWolf', 'Nytro', 'Barbican'])} as x from {{part}}) y
union all select 'Crucial P700 NVMe SSD 1TB', 4000 union all select 'Patriot Burst NVMe SSD 1TB', 5000 union all select 'Patriot Old SATA SSD 1TB', 6000) s"""
#: The letters of P7nn and P700 in matching blocks are three of four or two.
DRIVES_SQL = f"""select p_partkey, case kind when 0 then 'model_exact' when 1 then 'model_family' when 2 then 'series_exact' when 3 then case when p_size < 10 or p_size % 10 = 0 then 'brand_model_proxy' else 'brand_spec_proxy' end when 4 then 'brand_spec_proxy' else 'none' end as match_type,
case kind when 0 then name when 1 then replace(name, 'A NVMe', ' NVMe') when 2 then name when 3 then 'Crucial P700 NVMe SSD 1TB' when 4 then 'Patriot Burst NVMe SSD 1TB' end as bench_name,
case kind when 0 then 1000 + p_size when 1 then 2000 + p_size when 2 then 3000 when 3 then 4000 when 4 then 5000 end::double as bench_score,
case kind when 0 then 1350 when 1 then 820 + 92 + 50 + 120 when 2 then 650 + 30 + 30 + 120 when 3 then case when p_size < 10 or p_size % 10 = 0 then 520 + floor(75 + 18 / (1 + p_size / 10.0)) + 35 else 530 end when 4 then 530 end::bigint as match_score from ({duck(DRIVES)}) d"""


@query(DRIVES_SQL)
def storage_tiers(spark, sf) -> DataFrame:
    """Storage matched by model, family, series, a model that begins alike, brand, and not at all."""
    d = match_storage(made(spark, sf, DRIVES), made(spark, sf, DRIVE_SCORES).withColumn("id", F.col("name")), "name", "id", "name", "score")
    return d.select("p_partkey", "match_type", "bench_name", "bench_score", F.col("match_score").cast("long").alias("match_score"))


# Listings with scores

#: Two lists of processors: the second has all names, with other scores; one that the first has stays, readable or not.
FIRST_LIST = f"select name, score, row_number() over (order by name) as row from ({CPU_SCORES}) s where tier in ('3', '5')"
SECOND_LIST = f"select name, '7' || cast(length(name) as string) as score, row_number() over (order by name) as row from ({CPU_SCORES}) s"
CHIP_ROWS = f"""with p as ({duck(CPUS)}), l as ({duck(FIRST_LIST)}), m as ({duck(SECOND_LIST)}), u as (select name, score from l union all select name, score from m where name not in (select name from l)),
b as (select tier, number, ending, p_type, s.name, u.score from ({duck(CPU_SCORES)}) s join u on u.name = s.name where u.score <> 'n/a'),
j as (select p_partkey, name as bench_name, replace(score, ',', '')::double as bench_score, (102 + (p.p_type = b.p_type)::int)::bigint as match_score, count(*) over (partition by p_partkey) as candidates
from p join b on p.tier = b.tier and p.number = b.number and p.ending = b.ending where not mobile qualify {BEST})
select 'CPU' as part, p.p_partkey, 'AMD' as brand, null as chipset, j.bench_score, case when j.bench_score is null then 'none' else 'model_key_exact' end as match_type, bench_name, match_score, candidates from p left join j using (p_partkey)"""
CARD_ROWS = f"""with p as ({duck(GPUS)}), b as ({duck(GPU_SCORES)}),
j as (select p_partkey, name as bench_name, score::double as bench_score, (103 + case when p.told and b.told then 31 when p.told or b.told then 5 else 0 end)::bigint as match_score, count(*) over (partition by p_partkey) as candidates
from p join b on p.number = b.number where not (p.told and b.told and p.gb <> b.gb) qualify {BEST})
select 'GPU' as part, p.p_partkey, maker as brand, 'NVIDIA' as chipset, j.bench_score, case when j.bench_score is null then 'none' else 'model_key_exact' end as match_type, bench_name, match_score, candidates from p left join j using (p_partkey)"""
DRIVE_ROWS = f"select 'SSD' as part, p_partkey, null as brand, null as chipset, bench_score, match_type, bench_name, match_score, null as candidates from ({DRIVES_SQL}) d"


def _integrated(spark, sf) -> list[tuple[str, DataFrame, DataFrame]]:
    priced = lambda sql, name: made(spark, sf, sql).withColumnRenamed(name, "name").withColumn("price", F.lit(1))
    lined = lambda sql: made(spark, sf, sql).withColumn("row", F.lit(0))
    jobs = {
        "CPU": (priced(CPU_TITLES, "title"), [made(spark, sf, FIRST_LIST), made(spark, sf, SECOND_LIST)]),
        "GPU": (priced(GPU_TITLES, "title"), [lined(GPU_SCORES)]),
        "SSD": (priced(DRIVES, "name"), [lined(DRIVE_SCORES)]),
    }
    return [(part, *integrate.match_data(listed, lists, part, "name", "score")) for part, (listed, lists) in jobs.items()]


INTEGRATED = f"select part, p_partkey, brand, chipset, bench_score::bigint as bench_score, match_type, bench_name, match_score::bigint as match_score, candidates::bigint as candidates from (({CHIP_ROWS}) union all ({CARD_ROWS}) union all ({DRIVE_ROWS})) x"


@query(INTEGRATED)
def integrated_parts(spark, sf) -> DataFrame:
    """Processors, cards and drives with brands, scores and how they were found."""
    out = []
    for part, rows, _ in _integrated(spark, sf):
        told = {c: F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in ("brand", "chipset_brand")}
        out.append(rows.select(F.lit(part).alias("part"), "p_partkey", told["brand"].alias("brand"), told["chipset_brand"].alias("chipset"), "bench_score", *integrate.FOUND))
    return reduce(DataFrame.unionByName, out)


@query(f"""with r as ({INTEGRATED}) select part, case when bench_score is null then 'none' else match_type end as match_type, count(*)::bigint as n, round(100 * count(*) / sum(count(*)) over (partition by part), 1)::double as rate, count(*) filter (brand is null and part in ('CPU', 'GPU'))::bigint as no_brand, 0::bigint as no_chipset from r group by 1, 2""")
def integration_report(spark, sf) -> DataFrame:
    """How many rows of each part were matched how."""
    return reduce(DataFrame.unionByName, [r.select(F.lit(part).alias("part"), "match_type", "n", "rate", "no_brand", F.col("no_chipset").cast("long").alias("no_chipset")) for part, _, r in _integrated(spark, sf)])
