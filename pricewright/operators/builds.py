"""The cheapest build of compatible parts that is strong enough, with every part that is in it.

Parts of a build: processor and board share a socket, processor, board and memory a generation; the cooler's sockets hold the
processor's; the case takes the board's size, the card's length and the cooler's height; the power supply gives what the card
needs; processor and card score at least as much as asked for.

Prices add up, so each side is cut to what can be in a cheapest build before any join: the cheapest offer for each
compatibility key, and where a limit is one-sided (length, height, watts, size), the cheapest offer up to each value of it,
a running minimum over the values that occur. Sides are then joined by equal keys and by the value that the other side asks for;
nothing is joined by an inequality, and no table is larger than the distinct values of its keys. An argmin carries its parts along.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.functions.text import BOARD_SOCKETS

#: Parts in the order of the ratios; board sizes from small to large; sockets that coolers name otherwise.
PARTS = ["cpu", "gpu", "mainboard", "ram", "ssd", "power", "case", "cooler"]
SIZES = ["ITX", "MATX", "ATX", "EATX"]
COOLER_SOCKET = {"1151V2": "115X"}
#: The scores that a strong build has at least.
CPU_SCORE, GPU_SCORE = 30_000.0, 20_000.0


def size_rank(size: Column) -> Column:
    """0 for the smallest; null for a size that isn't known."""
    return F.nullif(F.array_position(F.array(*map(F.lit, SIZES)), size).cast("int"), F.lit(0)) - 1


def cooler_socket(socket: Column) -> Column:
    """A processor's socket as coolers name it."""
    return F.coalesce(*[F.when(socket == k, F.lit(v)) for k, v in COOLER_SOCKET.items()], socket)


def _offer(part: str) -> Column:
    """Price and name of an offer, which order it, as an argmin takes them along."""
    return F.struct(F.col("price").cast("long").alias("price"), F.struct(F.col("name").alias("name"), F.col("price").cast("long").alias("price")).alias(part))


def cheapest(offers: DataFrame, part: str, *keys: str) -> DataFrame:
    """keys, best: the cheapest offer of each combination of keys, of equal ones the first by name; offers without a price or a
    key are none."""
    known = offers.where(F.col("price").isNotNull())
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return known.groupBy(*keys).agg(F.min(_offer(part)).alias("best"))


def up_to(offers: DataFrame, values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value, best for each of `values` (keys, value): the cheapest of the offers (keys, value, best) whose value is at
    most that. One ordered pass over both sides' distinct values; null where there is none."""
    asked = values.select(*keys, value).distinct().withColumns({"best": F.lit(None).cast(offers.schema["best"].dataType), "_asks": F.lit(1)})
    both = offers.select(*keys, value, "best").withColumn("_asks", F.lit(0)).unionByName(asked)
    so_far = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(value, "_asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("best", F.min("best").over(so_far)).where("_asks = 1 and best is not null").drop("_asks")


def _sum(bests: dict[str, list[str]]) -> Column:
    """One offer of several: prices added, parts side by side. `bests`: of each column the parts it holds."""
    price = reduce(lambda a, b: a + b, [F.col(f"{c}.price") for c in bests])
    return F.struct(price.alias("price"), *[F.col(f"{c}.{p}").alias(p) for c, parts in bests.items() for p in parts])


def _powered(gpu: DataFrame, power: DataFrame, score: float) -> DataFrame:
    """length, best: cards that are strong enough, each with the cheapest supply that feeds it; the cheapest of each length."""
    cards = cheapest(gpu.where(F.col("score") >= score), "gpu", "length", "power")
    # The least watts that do are the greatest values that do when they are counted downwards.
    supplies = cheapest(power, "power", "wattage").select((-F.col("wattage")).alias("need"), "best")
    fed = up_to(supplies, cards.select((-F.col("power")).alias("need")), [], "need").withColumnsRenamed({"best": "supply", "need": "_need"})
    both = cards.join(fed, F.col("power") == -F.col("_need")).withColumn("one", _sum({"best": ["gpu"], "supply": ["power"]}))
    return both.groupBy("length").agg(F.min("one").alias("best"))


def _platforms(parts: dict[str, DataFrame], cases: DataFrame, score: float) -> DataFrame:
    """size, cooler_length, best for each of the cases': processor, board, memory and cooler that fit."""
    cpu = cheapest(parts["cpu"].where(F.col("score") >= score), "cpu", "socket", "memory").withColumnRenamed("best", "_cpu")
    ram = cheapest(parts["ram"], "ram", "memory").withColumnRenamed("best", "_ram")
    board = cheapest(parts["mainboard"].withColumn("rank", size_rank(F.col("size"))), "mainboard", "socket", "memory", "rank")
    kinds = board.select("socket", "memory").distinct()
    # Sizes are four: each kind of board is asked for up to each of them.
    sizes = kinds.select("socket", "memory", F.explode(F.array(*map(F.lit, range(len(SIZES))))).alias("rank"))
    board = up_to(board, sizes, ["socket", "memory"], "rank").withColumnRenamed("best", "_board")
    base = board.join(cpu, ["socket", "memory"]).join(ram, "memory")
    base = base.select(cooler_socket(F.col("socket")).alias("socket"), "rank", _sum({"_cpu": ["cpu"], "_ram": ["ram"], "_board": ["mainboard"]}).alias("best"))
    base = base.groupBy("socket", "rank").agg(F.min("best").alias("_base"))
    each = parts["cooler"].select("name", "price", F.explode(F.split(F.col("socket"), r"\s*,\s*")).alias("socket"), F.col("cooler_length").alias("height")).withColumn("socket", cooler_socket(F.col("socket")))
    cooler = cheapest(each, "cooler", "socket", "height")
    # Sockets are a short fixed list, so each height of a case is asked of each.
    sockets = F.array(*[F.lit(x) for x in dict.fromkeys(COOLER_SOCKET.get(x, x) for x in BOARD_SOCKETS)])
    asked = cases.select(F.col("cooler_length").alias("height")).distinct().withColumn("socket", F.explode(sockets))
    cooler = up_to(cooler, asked, ["socket"], "height").withColumnRenamed("best", "_cooler")
    met = base.join(cooler, "socket").withColumn("one", _sum({"_base": ["cpu", "ram", "mainboard"], "_cooler": ["cooler"]}))
    return met.groupBy("rank", "height").agg(F.min("one").alias("platform"))


def cheapest_strong_build(parts: dict[str, DataFrame], cpu_score: float = CPU_SCORE, gpu_score: float = GPU_SCORE) -> DataFrame:
    """One row, or none if no build is possible: total_price, {part}_name and {part}_price for each of PARTS, and the
    thresholds cpu_score and gpu_score. Of equal totals the one whose parts come first by price and name.

    `parts`: name and price, and cpu (socket, memory, score), gpu (length, power, score), mainboard (socket, memory, size), ram
    (memory), ssd, power (wattage), case (size, gpu_length, cooler_length), cooler (socket: a list with commas, cooler_length)."""
    case = cheapest(parts["case"].withColumn("rank", size_rank(F.col("size"))), "case", "rank", "gpu_length", "cooler_length").withColumnRenamed("best", "_case")
    cards = up_to(_powered(parts["gpu"], parts["power"], gpu_score), case.select(F.col("gpu_length").alias("length")), [], "length").withColumnsRenamed({"best": "_card", "length": "_length"})
    platforms = _platforms(parts, case, cpu_score).withColumnsRenamed({"rank": "_rank", "height": "_height"})
    d = case.join(cards, F.col("gpu_length") == F.col("_length")).join(platforms, (F.col("rank") == F.col("_rank")) & (F.col("cooler_length") == F.col("_height")))
    d = d.select(_sum({"_case": ["case"], "_card": ["gpu", "power"], "platform": ["cpu", "ram", "mainboard", "cooler"]}).alias("one"))
    disk = cheapest(parts["ssd"], "ssd").where("best is not null").withColumnRenamed("best", "_disk")
    # Both sides are one row.
    d = d.agg(F.min("one").alias("_rest")).where("_rest is not null").withColumn("_one", F.lit(1)).join(disk.withColumn("_one", F.lit(1)), "_one")
    told = [F.col(f"{'_disk' if p == 'ssd' else '_rest'}.{p}.{k}").alias(f"{p}_{k}") for p in PARTS for k in ("name", "price")]
    return d.select((F.col("_rest.price") + F.col("_disk.price")).alias("total_price"), *told, F.lit(float(cpu_score)).alias("cpu_score"), F.lit(float(gpu_score)).alias("gpu_score"))
