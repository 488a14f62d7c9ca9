"""Tables in versions, with constraints: readers always see a whole table, a second writer is refused.

A table is a folder: `data` holds a Parquet folder for each version, `versions` a small file for each version that is
published, named by its number. The file comes into being whole and only if no file of its name is there: by a link on
local disks, by a rename elsewhere, which file systems of clusters refuse where the target exists. The largest number is the table.
A writer says from which version it comes; where another one has published since, it is refused and its data go.

Constraints are data: each is a test of rows or a set of columns that may not repeat. All are judged by one aggregate over
the data as written, and nothing is published that breaks one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER_WIDTH = 12


class Conflict(RuntimeError):
    """Another writer has published a version since."""


class Broken(ValueError):
    """Rows that break constraints; `counts` says how many break which."""

    def __init__(self, counts: dict[str, int]):
        super().__init__("; ".join(f"{k}: {n}" for k, n in counts.items()))
        self.counts = counts


@dataclass(frozen=True)
class Constraint:
    """A test that all rows pass (SQL), or columns whose values stand once."""

    name: str
    test: str = ""
    unique: tuple[str, ...] = ()

    def broken(self) -> Column:
        """How many rows break it, as an aggregate. A test that isn't true is broken."""
        if self.unique:
            return F.count(F.lit(1)) - F.count_distinct(F.struct(*[F.col(f"`{c}`") for c in self.unique]))
        return F.count_if(~F.coalesce(F.expr(self.test), F.lit(False)))


def not_null(columns: list[str]) -> list[Constraint]:
    return [Constraint(f"NOT NULL {c}", f"`{c}` is not null") for c in columns]


def check(name: str, test: str) -> Constraint:
    return Constraint(f"CHECK {name}", test)


def unique(*columns: str) -> Constraint:
    return Constraint(f"UNIQUE {', '.join(columns)}", unique=columns)


def broken(df: DataFrame, constraints: list[Constraint]) -> dict[str, int]:
    """Constraints that rows break and how many do, by one aggregate."""
    if not constraints:
        return {}
    counts = df.agg(*[c.broken().alias(f"c{i}") for i, c in enumerate(constraints)]).first()
    return {c.name: n for c, n in zip(constraints, counts, strict=True) if n}


class Table:
    """A table in versions at `path`."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None, constraints: list[Constraint] | None = None):
        self.spark, self.path, self.schema, self.constraints = spark, path.rstrip("/"), schema, constraints or []
        self._P = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._P(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self._P("/".join((self.path, *parts)))

    def versions(self) -> list[int]:
        """Numbers of the versions that can be read, in order."""
        if not self._fs.exists(self._at("versions")):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at("versions"))]
        return sorted(int(n) for n in names if n.isdigit())

    def current(self) -> int:
        """The number of the newest version, 0 if there is none."""
        return max(self.versions(), default=0)

    def _told(self, number: int) -> dict:
        stream = self._fs.open(self._at("versions", f"{number:0{NUMBER_WIDTH}d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, number: int | None = None) -> DataFrame:
        """A version, the newest if none is named. An error if there is none."""
        number = self.current() if number is None else number
        if not number:
            raise FileNotFoundError(f"no version of {self.path}")
        told = self._told(number)
        schema = T.StructType.fromJson(told["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.path}/data/{told['data']}")

    def publish(self, df: DataFrame, base: int | None = None) -> int:
        """Writes `df` as the version after `base` (the newest, if none is named) and returns its number; raises Broken, or
        Conflict, and leaves the table as it was."""
        base = self.current() if base is None else base
        if self.schema is not None:
            df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema])
        name = uuid.uuid4().hex
        data = f"{self.path}/data/{name}"
        df.write.parquet(data)
        counts = broken(self.spark.read.schema(df.schema).parquet(data), self.constraints)
        if counts:
            self._fs.delete(self._P(data), True)
            raise Broken(counts)
        if not self._put(base + 1, json.dumps({"data": name, "schema": json.loads(df.schema.json())})):
            self._fs.delete(self._P(data), True)
            raise Conflict(f"version {base + 1} of {self.path} is there already")
        return base + 1

    def _put(self, number: int, text: str) -> bool:
        """Makes the version's file, whole and only if there is none."""
        self._fs.mkdirs(self._at("versions"))
        own, target = self._at("data", f"_{uuid.uuid4().hex}"), self._at("versions", f"{number:0{NUMBER_WIDTH}d}")
        out = self._fs.create(own, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                jvm = self.spark._jvm
                paths = [jvm.java.nio.file.Paths.get(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)) for p in (target, own)]
                try:
                    jvm.java.nio.file.Files.createLink(*paths)
                except Exception as e:
                    if "FileAlreadyExists" in str(e):
                        return False
                    raise
                return True
            return not self._fs.exists(target) and self._fs.rename(own, target)
        finally:
            self._fs.delete(own, False)

    def create(self) -> bool:
        """An empty first version, if there is no version; whether it was made."""
        if self.current():
            return False
        try:
            self.publish(self.spark.createDataFrame([], self.schema), 0)
        except Conflict:
            return False
        return True

    def clean(self, keep: int = 2) -> list[int]:
        """Deletes all but the newest versions, which readers may still hold; numbers of those that went."""
        gone = self.versions()[: -max(1, keep)]
        for n in gone:
            data = self._told(n)["data"]
            self._fs.delete(self._at("versions", f"{n:0{NUMBER_WIDTH}d}"), False)
            self._fs.delete(self._at("data", data), True)
        return gone
