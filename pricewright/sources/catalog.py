"""Listing tables, captured pages, stores of tables, and publishing.

Text files are read as text by name of column; numbers and dates are tried, so a cell that is none becomes null and
never an error. A store is a folder with a Parquet table for each name of STORE.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewright.operators import quality
from pricewright.operators.estimates import RATIOS, ratio_faults
from pricewright.operators.matching import upsert
from pricewright.operators.ordered import numbered_lines

from .versions import Constraint, Table, check, not_null, unique

#: Columns between name, price and product_code, product_url, created_at of each category.
COLUMNS = {
    "CPU": ["socket_type", "memory_type"], "GPU": ["recommended_power", "pcie_type", "gpu_length"], "Mainboard": ["socket_type", "memory_type", "pcie_type", "size", "memory_clock"],
    "RAM": ["memory_type", "memory_clock", "capacity", "module_count"], "SSD": ["capacity"], "Power": ["size", "wattage"], "Case": ["size", "gpu_length", "cooler_length"], "Cooler": ["socket_type", "cooler_length"],
}
WHOLE = {"price", "product_code", "recommended_power", "gpu_length", "memory_clock", "capacity", "module_count", "wattage", "cooler_length", "bench_score"}
#: Columns of the stored tables between name, price and product_code, product_url; those that must be over 0.
STORE = {
    "cpu": ["brand", "socket_type", "memory_type", "bench_score"],
    "gpu": ["brand", "chipset_brand", "recommended_power", "pcie_type", "gpu_length", "bench_score"],
    "mainboard": ["brand", "socket_type", "memory_type", "pcie_type", "size", "memory_clock"],
    "ram": ["memory_type", "memory_clock", "capacity", "module_count", "bench_score"],
    "ssd": ["capacity", "bench_score"],
    "power": ["size", "wattage"],
    "pc_case": ["size", "gpu_length", "cooler_length"],
    "cooler": ["socket_type", "cooler_length"],
}
FRACTIONS = {("ram", "bench_score")}
#: Usages whose old ratios go when new ones are loaded.
REPLACED_USAGES = ["VIDEO_EDITING", "HIGH_END"]


def expected(category: str) -> list[str]:
    return ["name", "price", *COLUMNS[category], "product_code", "product_url", "created_at"]


def store_columns(table: str) -> list[str]:
    return ["name", "price", *STORE[table], "product_code", "product_url"]


def store_schema(table: str) -> T.StructType:
    kind = lambda c: T.DoubleType() if (table, c) in FRACTIONS else T.LongType() if c in WHOLE and c != "product_code" else T.StringType()
    return T.StructType([T.StructField(c, kind(c)) for c in store_columns(table)])


def read_text(spark: SparkSession, path: str, required: list[str] | None = None, strict: bool = False) -> DataFrame:
    """A CSV file with a header, every column as text. Columns are found by name, in any order; required ones that are
    missing are an error that names all of them, and with `strict` so are others."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    missing, more = sorted(set(required or []) - set(df.columns)), sorted(set(df.columns) - set(required or []))
    if missing or (strict and more):
        raise ValueError(f"columns of {path}: missing {missing}, not known {more}")
    return df


def read_listing(spark: SparkSession, path: str, category: str) -> DataFrame:
    """A listing by name of column: whole numbers and dates that can be read as such, null where they can't."""
    names = expected(category)
    df = read_text(spark, path, names)
    return df.select(*[(F.col(n).try_cast("bigint") if n in WHOLE else F.try_to_timestamp(n) if n == "created_at" else F.col(n)).alias(n) for n in names])


def with_expected(df: DataFrame, category: str) -> DataFrame:
    """The category's columns in order, those that are missing as nulls; others go."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in expected(category)])


def insert_after(df: DataFrame, column: str, value: Column, after: str) -> DataFrame:
    """`df` with a column right after another one; one of that name is replaced."""
    names = [c for c in df.columns if c != column]
    at = names.index(after) + 1
    return df.withColumn(column, value).select(*names[:at], column, *names[at:])


def table_of_file(name: str) -> str:
    base = re.sub(r"data_|integrated_|\.csv", "", name).lower()
    return {"case": "pc_case"}.get(base, base)


def _fs(spark: SparkSession, path: str):
    P = spark._jvm.org.apache.hadoop.fs.Path
    return P(path).getFileSystem(spark._jsc.hadoopConfiguration()), P


def scan_folder(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], list[str]]:
    """The CSV files of a folder in order of their names, by table, with the columns that the table stores; and the names
    of files that are no table's, which are passed over."""
    fs, P = _fs(spark, folder)
    names = sorted(s.getPath().getName() for s in fs.listStatus(P(folder)))
    tables, unknown = {}, []
    for name in (n for n in names if n.lower().endswith(".csv")):
        table = table_of_file(name)
        if table in STORE:
            tables[table] = read_text(spark, f"{folder}/{name}", store_columns(table)).select(*store_columns(table))
        else:
            unknown.append(name)
    return tables, unknown


def storable(df: DataFrame, table: str, order: list) -> DataFrame:
    """Rows that a table takes: numbers that are whole (never cut), no nulls, prices and all other numbers over 0, the first
    by `order` of each name and price."""
    numbers = [c for c in store_columns(table) if c in WHOLE and c != "product_code"]
    typed = {c: F.col(c).cast("string").try_cast("double") if (table, c) in FRACTIONS else quality.to_integer(F.col(c)) for c in numbers}
    d = quality.complete(df.withColumns(typed), store_columns(table)).where(quality.all_positive(*numbers))
    return quality.keep_first(d, ["name", "price"], order).select(*store_columns(table))


#: The table of ratios beside the listings', and its columns.
RATIO_TABLE = "recommendation_budget_ratios"
RATIO_SCHEMA = T.StructType([T.StructField("usage", T.StringType()), T.StructField("budget", T.LongType()), *[T.StructField(r, T.DecimalType(8, 6)) for r in RATIOS], T.StructField("updated_at", T.TimestampType())])
TABLES = [*STORE, RATIO_TABLE]


def constraints(table: str) -> list[Constraint]:
    """What holds of every version of a table."""
    if table == RATIO_TABLE:
        within = " and ".join(f"{r} between 0 and 1" for r in RATIOS)
        return [*not_null(RATIO_SCHEMA.names), unique("usage", "budget"), check("budget > 0", "budget > 0"), check("ratios between 0 and 1", within), check("ratios add up to 1", f"{' + '.join(RATIOS)} = 1")]
    numbers = [c for c in store_columns(table) if c in WHOLE and c != "product_code"]
    return [*not_null(store_columns(table)), unique("name", "price"), *[check(f"{c} > 0", f"{c} > 0") for c in numbers]]


def store_table(spark: SparkSession, folder: str, table: str) -> Table:
    """A table of the store in `folder`, with its columns and constraints."""
    if table not in TABLES:
        raise ValueError(f"no such table: {table}")
    return Table(spark, f"{folder.rstrip('/')}/{table}", RATIO_SCHEMA if table == RATIO_TABLE else store_schema(table), constraints(table))


def create_missing(spark: SparkSession, folder: str) -> list[str]:
    """Empty tables for those of TABLES that the folder doesn't have; their names."""
    return [t for t in TABLES if store_table(spark, folder, t).create()]


class LoadFailed(RuntimeError):
    """Files that could not be loaded, each with what went wrong."""

    def __init__(self, failures: dict[str, str]):
        super().__init__("; ".join(f"{k}: {v}" for k, v in sorted(failures.items())))
        self.failures = failures


def load_folder(spark: SparkSession, csv_folder: str, store: str) -> list[tuple[str, str, int, int]]:
    """Loads every CSV file of a folder into the store: file, table, rows read, rows stored. The first line of each name and
    price stays. A file that fails doesn't keep the others from being loaded; afterwards LoadFailed names all that did. Files
    that are no table's are passed over."""
    fs, P = _fs(spark, csv_folder)
    done, failures = [], {}
    for name in sorted(s.getPath().getName() for s in fs.listStatus(P(csv_folder))):
        table = table_of_file(name)
        if not name.lower().endswith(".csv") or table not in STORE:
            continue
        try:
            lines = numbered_lines(read_text(spark, f"{csv_folder}/{name}", store_columns(table)), "_row")
            target = store_table(spark, store, table)
            number = target.publish(storable(lines, table, ["_row"]))
            done.append((name, table, lines.count(), target.read(number).count()))
        except Exception as e:  # noqa: BLE001  whatever it is, the other files are loaded and it is raised with the rest
            failures[name] = str(e).split("\n")[0]
    if failures:
        raise LoadFailed(failures)
    return done


def profile(df: DataFrame, unique_by: list[str]) -> DataFrame:
    """column, rows, nulls, distinct, low, high of every column, and a row for `unique_by` together whose `nulls` are the rows
    beyond the first of each. One aggregate; low and high are text."""
    def told(c: str, value: Column, nulls: Column) -> Column:
        return F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), nulls.alias("nulls"), F.count_distinct(value).alias("distinct"), F.min(value).cast("string").alias("low"), F.max(value).cast("string").alias("high"))

    each = [told(c, F.col(f"`{c}`"), F.count_if(F.col(f"`{c}`").isNull())) for c in df.columns]
    key = F.struct(*[F.col(f"`{c}`") for c in unique_by])
    both = F.struct(F.lit(", ".join(unique_by)).alias("column"), F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) - F.count_distinct(key)).alias("nulls"), F.count_distinct(key).alias("distinct"), F.lit(None).cast("string").alias("low"), F.lit(None).cast("string").alias("high"))
    return df.agg(F.array(*each, both).alias("x")).select(F.inline("x"))


#: What spreadsheets know UTF-8 by; Spark passes over it at the start of a file.
BYTE_ORDER_MARK = "\ufeff"


def write_csv(df: DataFrame, path: str, marked: bool = True) -> None:
    """A folder of CSV files with headers, in place of what was there; quotes are doubled. `marked`: each file begins with a byte-order
    mark, which is written as the beginning of its header."""
    first, *others = df.columns
    named = df.toDF(BYTE_ORDER_MARK + first, *others) if marked else df
    named.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_ratios(spark: SparkSession, path: str) -> DataFrame:
    """A ratio table from CSV whose header has exactly the ratio columns, in any order; numbers that aren't, have over six
    places or are out of range become nulls, which ratio_faults() tells."""
    df = read_text(spark, path, ["usage", "budget", *RATIOS], strict=True)
    exact = lambda c: F.when(F.trim(c).rlike(r"^\d+(\.\d{1,6}0*)?$"), F.trim(c).try_cast("decimal(8,6)"))
    return df.select(F.upper(F.trim("usage")).alias("usage"), quality.to_integer(F.trim("budget")).alias("budget"), *[exact(F.col(r)).alias(r) for r in RATIOS])


def load_ratios(spark: SparkSession, new: DataFrame, store: str) -> DataFrame:
    """The stored ratios after loading `new`, which must be sound: usages of REPLACED_USAGES are replaced, other rows by usage
    and budget; updated_at is the time of loading for rows that came with it. Published as a whole or not at all."""
    faults = ratio_faults(new).collect()  # a row for each kind of fault
    if faults:
        raise ValueError("; ".join(f"{f.fault}: {f.n}" for f in sorted(faults)))
    table = store_table(spark, store, RATIO_TABLE)
    base = table.current()
    stamped = new.withColumn("updated_at", F.current_timestamp())
    if base:
        stamped = upsert(table.read(base), stamped, ["usage", "budget"], F.col("usage").isin(REPLACED_USAGES))
    return table.read(table.publish(stamped, base))


def publish(df: DataFrame, path: str, complete: bool = True) -> bool:
    """Full refresh by write-then-swap: the new table is written whole, then takes the old one's place. Nothing is replaced
    unless `complete` (every page was captured). If a rename fails, the old table is put back and an error raised; between the
    two renames, a moment on file systems that rename folders at once, there is no table."""
    if not complete:
        return False
    new, old = f"{path}.{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(new)
    fs, P = _fs(df.sparkSession, path)
    had = fs.exists(P(path))
    if had and not fs.rename(P(path), P(old)):
        fs.delete(P(new), True)
        raise OSError(f"can't move {path} away")
    if not fs.rename(P(new), P(path)):
        if had and not fs.rename(P(old), P(path)):
            raise OSError(f"can't move {new} to {path}, and the old table is at {old}")
        fs.delete(P(new), True)
        raise OSError(f"can't move {new} to {path}")
    if had:
        fs.delete(P(old), True)
    return True
