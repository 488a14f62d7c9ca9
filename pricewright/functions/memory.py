"""Features of memory modules: part numbers, capacities of kits, and what a listing's own columns say.

Capacities of kits are read by consuming: a form that is found is blanked out before the next one looks, so the 32 of
'64GB(32Gx2)' doesn't count as a kit of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import brands_of, capacity_text, ram_module_count
from .text import ddr_of, latency_of, normalize_text, once, ram_capacity_gb, speed_of, squeeze

#: Words that are no part numbers, and specifications that look like some.
PLAIN_WORDS = ["ddr4", "ddr5", "memory", "ram", "rgb", "black", "white", "package", "패키지", "정품", "벌크"]
SPECIFICATIONS = [r"ddr[345][\-]?\d{4}", r"cl\d+(?:-\d+)*", r"\d{3,4}mhz", "ddr[345]"]
#: CAS latency to expect where none is told: (generation, from this speed on, latency), fastest first.
USUAL_LATENCY = [("DDR5", 6400, 48), ("DDR5", 5600, 46), ("DDR5", 0, 40), ("", 3600, 18), ("", 3200, 22), ("", 0, 19)]
USUAL_CAPACITY = 16.0
#: How kits tell their capacity, on text as capacity_text() writes it: pattern, then the groups of the value, its
#: unit and the number of modules (0: the value is the whole kit's). What one form finds isn't looked at by the next.
KIT_FORMS = [
    (r"(?<![A-Z0-9])(\d+(?:\.\d+)?)\s*(GB|TB)\s*\(\s*(\d+(?:\.\d+)?)\s*(GB|TB|G|T)?\s*X\s*(\d+)\s*\)", 1, 2, 0),
    (r"(\d+(?:\.\d+)?)\s*(TB|GB|T|G)\s*X\s*(\d+)", 1, 2, 3),
    (r"(\d+)\s*X\s*(\d+(?:\.\d+)?)\s*(TB|GB|T|G)", 2, 3, 1),
    (r"(?<![A-Z0-9])(\d+(?:\.\d+)?)\s*(TB|GB)(?![A-Z0-9])", 1, 2, 0),
]
#: Capacities at the end of a name, in the order in which they are cut off.
NAME_ENDS = [r"(?i)\s*\(\s*\d+(?:\.\d+)?\s*(?:GB|TB)\s*\)\s*$", r"(?i)\s+\d+(?:\.\d+)?\s*(?:GB|TB)\s*\([^)]*x[^)]*\)\s*$", r"(?i)\s+\d+(?:\.\d+)?\s*(?:GB|TB)\s*$"]
UNIT_PRICES = ["원/GB", "원/1GB", "1GB당"]


def part_numbers(name: Column) -> Column:
    """Sorted distinct tokens of five characters or more, of letters and digits, that aren't specifications."""
    return parts_of(normalize_text(name))


def parts_of(t: Column) -> Column:
    """As part_numbers, of normalised text."""
    words = F.regexp_extract_all(t, F.lit(r"[a-z0-9][a-z0-9\-./]+"), F.lit(0))
    words = F.transform(words, lambda w: F.trim(w, F.lit("-./")))
    plain = "^(?:" + "|".join(SPECIFICATIONS) + ")$"
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: (F.length(w) >= 5) & w.rlike("[a-z]") & w.rlike("[0-9]") & ~w.isin(PLAIN_WORDS) & ~w.rlike(plain))))


def module_info(name: Column, memory_type: Column | None = None, memory_clock: Column | None = None, capacity: Column | None = None, module_count: Column | None = None) -> Column:
    """Struct of brands, ddr, speed, cl, capacity_gb, modules, module_gb, parts. A listing's columns go before what the name
    says; a kit's capacity is shared among its modules, of which there is one at least."""
    return once(normalize_text(name), lambda t: info_of(t, name, memory_type, memory_clock, capacity, module_count))


def module_features(df: DataFrame, name: str, into: str, **told: Column) -> DataFrame:
    """`df` with module_info() as the column `into`. The name is normalised once."""
    return df.withColumn(into, module_info(F.col(name), **told))


def info_of(t: Column, name: Column, memory_type: Column | None = None, memory_clock: Column | None = None, capacity: Column | None = None, module_count: Column | None = None) -> Column:
    """As module_info, of normalised text and the name itself."""
    none = F.lit(None)
    told = lambda c: none if c is None else F.trim(c.cast("string"))
    ddr = F.coalesce(F.upper(told(memory_type)).cast("string"), ddr_of(t))
    speed = F.coalesce(told(memory_clock).try_cast("double").cast("int"), speed_of(t))
    total = told(capacity).try_cast("double")
    count = F.greatest(F.coalesce(told(module_count).try_cast("double").cast("int"), F.lit(1)), F.lit(1))
    gb = F.coalesce(total, ram_capacity_gb(name))
    return F.struct(
        brands_of(t).alias("brands"),
        ddr.alias("ddr"),
        speed.alias("speed"),
        latency_of(t).alias("cl"),
        gb.alias("capacity_gb"),
        count.alias("modules"),
        F.coalesce(total / count, gb).alias("module_gb"),
        parts_of(t).alias("parts"),
    )


def latency(cl: Column, ddr: Column, speed: Column) -> Column:
    """`cl`, or what is usual for the generation and speed."""
    usual = F.lit(None).cast("int")
    for generation, least, value in reversed(USUAL_LATENCY):
        test = (speed >= least) & (F.coalesce(ddr == generation, F.lit(False)) if generation else F.lit(True))
        usual = F.when(test, value).otherwise(usual)
    return F.coalesce(cl, usual)


def _gb(value: Column, unit: Column) -> Column:
    n = value.try_cast("double") * F.when(F.substring(unit, 1, 1) == "T", 1000).otherwise(1)
    return F.bround(n).cast("int")


def kit_capacities(text: Column) -> Column:
    """Distinct whole GB of the kits that a text names, 1 to 4096, in the order of KIT_FORMS."""

    def found(t: Column, forms: list[tuple[str, int, int, int]]) -> Column:
        (pattern, value, unit, count), *rest = forms
        every = lambda g: F.regexp_extract_all(t, F.lit(pattern), F.lit(g))
        gb = F.zip_with(every(value), every(unit), _gb)
        if count:
            modules = F.transform(every(count), lambda x: x.try_cast("int"))
            gb = F.zip_with(gb, modules, lambda x, n: F.when(n.between(1, 16), x * n))
        here = F.filter(gb, lambda x: x.between(1, 4096))
        return F.concat(here, once(F.regexp_replace(t, pattern, " "), lambda left: found(left, rest))) if rest else here

    return F.array_distinct(once(capacity_text(text), lambda t: found(t, KIT_FORMS)))


def kit_capacity(text: Column) -> Column:
    """The only capacity that a text names; null if it names none or several."""
    return once(kit_capacities(text), lambda found: F.when(F.size(found) == 1, F.get(found, 0)))


def capacity_label(text: Column) -> Column:
    """Struct of gb and label of the first form that a text holds: '48GB(24Gx2)' -> (48, '48GB(24Gx2)'), '2 x 16G' ->
    (32, '32GB(16Gx2)'), '32GB' -> (32, '32GB'). Null if it holds none."""
    return once(capacity_text(text), _capacity_label)


def _capacity_label(t: Column) -> Column:
    out = []
    for i, (pattern, value, unit, count) in enumerate(KIT_FORMS):
        g = lambda k, p=pattern: F.regexp_extract(t, p, k)
        gb = _gb(g(value), g(unit))
        if count:
            n = g(count).try_cast("int")
            ok, gb = n.between(1, 16), gb * n
            label = F.concat(gb.cast("string"), F.lit("GB("), g(value), g(unit), F.lit("x"), n.cast("string"), F.lit(")"))
        else:
            ok, label = F.lit(True), F.concat(g(value), g(unit))
            if i == 0:
                label = F.concat(label, F.lit("("), g(3), F.coalesce(F.nullif(g(4), F.lit("")), F.lit("G")), F.lit("x"), g(5), F.lit(")"))
        out.append(F.when(t.rlike(pattern) & ok & (gb > 0), F.struct(gb.alias("gb"), label.alias("label"))))
    return F.coalesce(*out)


def is_unit_price(text: Column) -> Column:
    """Whether a price is for one GB, as in '26,568원/1GB'."""
    t = F.replace(F.upper(squeeze(text)), F.lit(" "), F.lit(""))
    return t.rlike("|".join(UNIT_PRICES))


def base_name(name: Column) -> Column:
    """A kit's name without the capacity at its end, in brackets or not; the name itself if nothing else is in it."""

    def cut(n: Column) -> Column:
        for end in NAME_ENDS:
            n = F.regexp_replace(n, end, "")
        return squeeze(n)

    return once(squeeze(name), lambda n: once(cut(n), lambda c: F.when(c != "", c).otherwise(n)))


def base_specs(name: Column, details: Column, clock: Column) -> Column:
    """Struct of memory_type (of the name, else of the details), memory_clock and module_count; null without the first two."""
    first = lambda c: F.nullif(F.upper(F.regexp_extract(c, "(?i)DDR[45]", 0)), F.lit(""))
    kind = F.coalesce(first(name), first(details))
    both = F.concat(F.coalesce(name, F.lit("")), F.lit(" / "), F.coalesce(details, F.lit("")))
    return F.when(kind.isNotNull() & clock.isNotNull(), F.struct(kind.alias("memory_type"), clock.alias("memory_clock"), ram_module_count(both).alias("module_count")))
