"""Folders that all machines of a cluster see, and tables that are written there between steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Temporary folders of applications that have no shared one, by application; a session's own setting can't be changed.
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where it is unset, a temporary one, but only if driver and executors are
    one process; on a cluster that is an error, since a machine's own folder would hold a part of a table only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = "file://" + tempfile.mkdtemp(prefix="pricewright-")
        path = _local[app]
    return path.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/market-{uuid.uuid4().hex}"


#: Folders that stored() made within the innermost scratch().
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def stored(df: DataFrame) -> DataFrame:
    """The same rows from a Parquet table in the shared folder. What follows starts from columns: expressions behind them
    are worked out once, not wherever they are named, and plans stay short."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    if (made := _made.get()) is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that stored() writes within go at the end, but for those that kept() takes out of the list that this yields. What
    reads them must have run by then."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        for path in made:
            dropped(spark, path)


def kept(made: list[str], df: DataFrame) -> DataFrame:
    """`df`, read from a table of stored(), whose folder stays when the scope `made` ends."""
    files = df.inputFiles()
    mine = [p for p in made if any(p.rpartition("/")[2] in f for f in files)]
    made[:] = [p for p in made if p not in mine]
    return df
