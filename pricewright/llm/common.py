"""Shared helpers of the llm operators: table access and cutting of lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricewright.folders import shared_folder

#: ASCII white space: what separates words.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


#: Whether a SQL execution's shuffle files go when it ends; they would otherwise stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows that go to and from Python at once.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def configured(spark: SparkSession, **settings: str) -> Iterator[None]:
    """The session with other settings, as long as it lasts."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def written(df: DataFrame, tag: str, batch: int | None = None) -> DataFrame:
    """The same rows from a Parquet table in the shared folder: later stages restart from it, not from its lineage. The
    shuffle files of the writing go with it, since nothing reads them again. `batch`: rows at most that go to Python at
    once, where rows are large."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    with configured(spark, **{CLEANUP: "true"}, **({BATCH: str(batch)} if batch else {})):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df_or_path: DataFrame | str, spark: SparkSession | None = None) -> None:
    """Deletes a table of `written` that no later plan reads."""
    if isinstance(df_or_path, str):
        paths = [df_or_path]
    else:
        spark = df_or_path.sparkSession
        paths = {p.rpartition("/")[0] for p in df_or_path.inputFiles()}
    for p in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(p)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def named(column: str) -> Column:
    """A column by its name, whatever characters are in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def row_of(df: DataFrame) -> Column:
    """All columns of `df` as one struct, so that others beside it can't clash with them."""
    return F.struct(*[named(c).alias(c) for c in df.columns])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


#: Rows of a small table up to which it is sent to every task; beyond, it is shuffled.
BROADCAST_ROWS = 100_000


def numbered(df: DataFrame, by: list[str], within: list[str], number: str, tag: str, also: str | None = None) -> DataFrame:
    """`df` with the place of each row, from 0, in the order of `by` among the rows of equal `within`; nulls come first. `also`: a
    column for the number of rows of equal `within`. One range shuffle: the rows are written in order, each with its place in its
    task, and a table with a row for each task and group says how many stand before."""
    order = [F.col(c).asc_nulls_first() for c in (*within, *by)]
    d = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), tag)
    part = F.shiftright("_at", 33)  # the upper bits of such an id are the task's number, the lower the row's in it
    runs = d.groupBy(part.alias("_part"), *[F.col(c).alias(f"_w{i}") for i, c in enumerate(within)]).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    same = [f"_w{i}" for i in range(len(within))] or [F.lit(0)]
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy(*same).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = written(runs.select("*", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(Window.partitionBy(*same)).alias("_all")), f"{tag}-runs")
    on = part == F.col("_part")
    for i, c in enumerate(within):
        on = on & F.col(c).eqNullSafe(F.col(f"_w{i}"))
    d = d.join(F.broadcast(runs) if runs.count() <= BROADCAST_ROWS else runs, on)
    return d.select(*[named(c) for c in df.columns], (F.col("_at") + F.col("_shift")).alias(number), *([F.col("_all").alias(also)] if also else []))
