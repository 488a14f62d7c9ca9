"""Storage features and the match cascade, on known names."""

import pytest
from pyspark.sql import functions as F

from pricewright.functions import storage as S
from pricewright.operators.storage_match import match_storage

CASE = "지원보드규격: E-ATX / ATX / M-ATX / VGA 길이: 300~400mm / CPU쿨러 높이: 180mm"


def value(spark, f, x):
    return spark.createDataFrame([(x,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "f,x,want",
    [
        (S.brands, "CT4000P310SSD8", ["crucial"]),
        (S.named_brands, "CT4000P310SSD8", []),
        (S.brands, "Apacer AS350X", ["apacer"]),
        (S.brands, None, []),
        (S.models, "Crucial CT4000P310SSD8", ["p310"]),
        (S.models, "XP2300F256G", ["xp2300f"]),
        (S.models, "Solidigm P41PL 1TB", ["p41"]),
        (S.models, "삼성전자 990 PRO M.2 NVMe (1TB)", ["990"]),
        (S.models, None, []),
        (S.series, "WD BLACK SN850X NVMe", ["black"]),
        (S.variants, "ADATA SX8200PNP", ["pro"]),
        (S.revisions, "CL4-8D512 V2", ["8d", "v2"]),
        (S.capacities, "SHPP41-1000GM 1024GB", [1000]),
        (S.capacities, "XP2300F256G", [256]),
        (S.capacities, "60GB 2T0", [2000]),
        (S.interface, 'Apacer AS350 2.5"', "sata"),
        (S.interface, "990 PRO PCIe", "nvme"),
        (S.interface, None, None),
        (S.power_size, "SFX-L 750W M-ATX", "SFXL"),
        (S.case_size, CASE, "EATX"),
        (S.case_size, "미니타워", None),
        (S.case_gpu_length, CASE, 400),
        (S.case_cooler_length, CASE, 180),
        (S.case_cooler_length, "CPU쿨러 높이: 158m", 158),
        (S.ram_module_count, "32GB(16G×2)", 2),
        (S.ram_module_count, "램개수: 4개 2x16GB", 4),
        (S.ram_module_count, None, None),
    ],
)
def test_features(spark, f, x, want):
    assert value(spark, f, x) == want


def test_cascade(spark):
    bench = spark.createDataFrame(
        [
            (1, "Samsung 990 PRO NVMe 1TB", 9000.0),
            (2, "Samsung 990 EVO NVMe 1TB", 7000.0),
            (3, "Samsung PM9C1 NVMe 512GB", 5000.0),
            (4, "KIOXIA EXCERIA SATA 480GB", 3000.0),
            (5, "Patriot VP4300 NVMe 2TB", 8000.0),
            (6, "WD Blue SN570 NVMe 1TB", 6000.0),
            (7, "Lexar Alpha NVMe SSD 1TB", 4000.0),
            (8, "Lexar Beta NVMe SSD 1TB", 4400.0),
            (9, "Lexar Gamma NVMe SSD 1TB", 9999.0),
            (10, "Lexar Delta NVMe SSD 1TB", None),
        ],
        "id int, name string, score double",
    )
    names = {
        "a": ("삼성전자 990 PRO M.2 NVMe (1TB)", 1, "model_exact", "exact"),
        "b": ("Samsung PM9C1A NVMe 512GB", 3, "model_family", "exact"),
        "c": ("KIOXIA EXCERIA SATA (480GB)", 4, "series_exact", "exact"),
        "d": ("WD Blue SN580 NVMe (1TB)", 6, "brand_model_proxy", "exact"),
        "e": ("Lexar NM790 NVMe (1TB)", 8, "brand_spec_proxy", "exact"),
        "f": ("Nobody ZZ1 NVMe (1TB)", None, "none", None),
        "g": (None, None, "none", None),
    }
    products = spark.createDataFrame([(k, v[0]) for k, v in names.items()], "pid string, title string")
    got = {r.pid: (r.title, r.bench_id, r.match_type, r.capacity_match) for r in match_storage(products, bench, "title", "id", "name", "score").collect()}
    assert got == names
    assert match_storage(products.limit(0), bench, "title", "id", "name", "score").count() == 0
    assert {r.match_type for r in match_storage(products, bench.limit(0), "title", "id", "name", "score").collect()} == {"none"}
