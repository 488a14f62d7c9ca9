"""What listings say about a part beyond its name: sockets, buses, power, clocks, sizes, capacities.

Each function reads free text and gives null where it finds nothing; refined_spec() gives a category's attributes at once,
and null for a row that lacks one it must have.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import memory
from .storage import capacity_text, case_cooler_length, case_gpu_length, case_size, power_size, ram_module_count
from .text import BOARD_SOCKETS, cooler_sockets, normalize_socket, once, squeeze

#: How the power that a card needs is told, best evidence first, and what shows that a text is about a card.
POWER_LABELS = [r"정격\s*파워", r"권장\s*파워", r"추천\s*파워", r"권장\s*전원", r"추천\s*전원"]
CARD_WORDS = ["RTX", "GTX", "RADEON", "RX", "PCIE", "GDDR", "그래픽카드"]
#: Labels of a drive's capacity, and the capacities that are sold, by which one of several is chosen.
CAPACITY_LABELS = [r"SSD\s*용량", r"저장\s*용량", r"저장용량", "용량"]
LEAST_DRIVE_GB, MOST_DRIVE_GB = 256, 8192
SOLD_DRIVES_GB = [256, 480, 500, 512, 960, 1000, 1024, 1920, 2000, 2048, 3840, 4000, 4096, 7680, 8000, 8192]
LEAST_CLOCK, MOST_CLOCK = 1600, 10000
#: Board sizes as they are written; only the last two letters of the first are no size of their own.
BOARD_SIZES = {"E-ATX": "EATX", "ATX": "ATX", "M-ATX": "MATX", "MICRO-ATX": "MATX", "MINI-ITX": "ITX"}
SOCKET_LABEL = r"(?i)소켓\s*[:\-]?\s*([a-zA-Z0-9\-]+)"
LENGTH_LABELS = [r"(?i)가로\s*\(?길이\)?[^0-9]*([\d.]+)\s*mm", r"(?i)길이[^0-9]*([\d.]+)\s*mm"]
HEIGHT_LABEL = r"(?i)높이[^0-9]*([\d.]+)\s*mm"
AIR_COOLED = "공랭"


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """The group where the pattern stands first, else null."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def _joined(name: Column, details: Column) -> Column:
    return F.concat(F.coalesce(name, F.lit("")), F.lit(" / "), F.coalesce(details, F.lit("")))


def _whole(number: Column) -> Column:
    return number.try_cast("double").cast("int")


def pcie_type(text: Column) -> Column:
    """'PCI Express 5.0 x16' -> 'PCIE5.0X16'."""
    t = F.replace(F.regexp_replace(F.upper(text), "[ _-]", ""), F.lit("PCIEXPRESS"), F.lit("PCIE"))
    return once(t, lambda t: _found(t, r"PCIE[0-9.]+X[0-9]+", 0))


def recommended_power(text: Column) -> Column:
    """Watts, as labelled; in a text about a card '550W 이상' counts as well."""
    labelled = lambda t: [_found(t, label + r"[^0-9]{0,30}([0-9]{3,4})\s*W").try_cast("int") for label in POWER_LABELS]
    plain = lambda compact: F.when(compact.rlike("|".join(CARD_WORDS)), _found(compact, "([0-9]{3,4})W이상").try_cast("int"))
    return once(F.replace(F.upper(squeeze(text)), F.lit(","), F.lit("")), lambda t: F.coalesce(*labelled(t), once(F.replace(t, F.lit(" "), F.lit("")), plain)))


def memory_clock(name: Column, details: Column) -> Column:
    """MHz as in the name's 'DDR5-6000', else the largest that is told, 1600 to 10000."""
    ok = lambda n: n.between(LEAST_CLOCK, MOST_CLOCK)
    own = _found(squeeze(name), r"(?i)DDR[45]\s*[- ]\s*(\d{4,5})").try_cast("int")
    told = F.concat(*[F.regexp_extract_all(squeeze(c), F.lit(r"(?i)(?<!\d)(\d{4,5})\s*MHz"), F.lit(1)) for c in (details, name)])
    return F.coalesce(once(own, lambda n: F.when(ok(n), n)), F.array_max(F.filter(F.transform(told, lambda x: x.try_cast("int")), ok)))


def _drive_candidates(text: Column) -> Column:
    pattern = F.lit(r"(?<![A-Z0-9])(\d+(?:\.\d+)?)\s*(TB|GB)(?![A-Z0-9])")
    gb = once(capacity_text(text), lambda t: F.zip_with(F.regexp_extract_all(t, pattern, F.lit(1)), F.regexp_extract_all(t, pattern, F.lit(2)), memory._gb))
    return F.filter(gb, lambda x: x.between(LEAST_DRIVE_GB, MOST_DRIVE_GB))


def _largest_sold(candidates: Column) -> Column:
    """The largest that is sold, else the largest."""
    return once(candidates, lambda c: F.coalesce(F.array_max(F.filter(c, lambda x: x.isin(SOLD_DRIVES_GB))), F.array_max(c)))


def drive_capacity(name: Column, details: Column, full: Column) -> Column:
    """GB, 256 to 8192: of the name, else of a labelled field, else of whatever the texts hold."""
    fair = lambda gb: F.when(gb.between(LEAST_DRIVE_GB, MOST_DRIVE_GB), gb)

    def labelled(t: Column) -> Column:
        patterns = [label + r"\s*[:：/]?\s*(\d+(?:\.\d+)?)\s*(TB|GB)" for label in CAPACITY_LABELS]
        return F.coalesce(*[once(memory._gb(F.regexp_extract(t, p, 1), F.regexp_extract(t, p, 2)), fair) for p in patterns])

    return F.coalesce(_largest_sold(_drive_candidates(name)), *[once(capacity_text(t), labelled) for t in (details, full)], _largest_sold(F.concat(_drive_candidates(details), _drive_candidates(full))))


def name_drive_capacity(name: Column) -> Column:
    return _largest_sold(_drive_candidates(name))


def drive_label(gb: Column) -> Column:
    """2000 -> '2TB', 512 -> '512GB'."""
    return F.when(gb % 1000 == 0, F.concat((gb / 1000).cast("int").cast("string"), F.lit("TB"))).otherwise(F.concat(gb.cast("string"), F.lit("GB")))


def drive_base_name(name: Column) -> Column:
    """A drive's name without the capacity at its end; the name itself if nothing else is in it."""
    cut = lambda n: squeeze(F.regexp_replace(F.regexp_replace(n, memory.NAME_ENDS[0], ""), memory.NAME_ENDS[2], ""))
    return once(squeeze(name), lambda n: once(cut(n), lambda c: F.when(c != "", c).otherwise(n)))


def board_size(text: Column) -> Column:
    found = F.upper(_found(text, "(?i)(E-ATX|ATX|M-ATX|Micro-ATX|Mini-ITX)"))
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in BOARD_SIZES.items() for x in kv]), found)


def _ddr(text: Column, digits: str) -> Column:
    return F.upper(_found(text, f"(?i)(DDR{digits})"))


def _every_of(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def refined_spec(category: str, name: Column, details: Column, full: Column) -> Column:
    """Struct of the category's attributes; null where one that it must have isn't found."""
    both = _joined(name, details)
    known = lambda *keys: lambda s: _every_of([s[k].isNotNull() for k in keys])
    always = lambda s: F.lit(True)
    socket = once(_found(details, SOCKET_LABEL), normalize_socket)
    if category == "CPU":
        out, must = {"socket_type": socket, "memory_type": _ddr(details, "[0-9]+")}, lambda s: s["socket_type"].isin(BOARD_SOCKETS)
    elif category == "GPU":
        out, must = {"recommended_power": recommended_power(both), "pcie_type": pcie_type(both), "gpu_length": F.coalesce(*[_whole(_found(details, p)) for p in LENGTH_LABELS])}, known("recommended_power")
    elif category == "Mainboard":
        out = {"socket_type": socket, "memory_type": _ddr(details, "[0-9]+"), "pcie_type": pcie_type(details), "size": board_size(details), "memory_clock": memory_clock(name, details)}
        must = lambda s: s["socket_type"].isin(BOARD_SOCKETS) & s["memory_type"].isin("DDR4", "DDR5")
    elif category == "RAM":
        out = {"memory_type": F.coalesce(_ddr(name, "[45]"), _ddr(details, "[45]")), "memory_clock": memory_clock(name, details), "capacity": memory.kit_capacity(both), "module_count": ram_module_count(both)}
        must = known(*out)
    elif category == "SSD":
        out, must = {"capacity": drive_capacity(name, details, full)}, known("capacity")
    elif category == "Power":
        out, must = {"size": power_size(both), "wattage": _found(details, r"(?i)([0-9]{3,4})\s*W").try_cast("int")}, always
    elif category == "Case":
        source = F.coalesce(F.nullif(full, F.lit("")), details)
        out = {"size": case_size(source), "gpu_length": case_gpu_length(source), "cooler_length": case_cooler_length(source)}
        must = known(*out)
    elif category == "Cooler":
        out = {"socket_type": cooler_sockets(both), "cooler_length": _whole(_found(details, HEIGHT_LABEL))}
        must = lambda s: both.contains(AIR_COOLED) & known("socket_type", "cooler_length")(s)
    else:
        raise ValueError(f"no such category: {category}")
    # The attributes are found once, however often the tests name them.
    return once(F.struct(*[c.alias(k) for k, c in out.items()]), lambda s: F.when(F.coalesce(must(s), F.lit(False)), s))
