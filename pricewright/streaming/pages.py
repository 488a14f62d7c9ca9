"""Captured pages: which of them are new, in a batch and as a stream.

A listing's page is captured in up to four ways, tried in order (`WAYS`). A capture whose cards another page has shown
already is a repeat: the site didn't turn the page, and the next way has its turn. A page without cards has no
signature; in a batch it is kept, and in the stream it asks for the next way as well. When no way is left the page is lost,
and with it the job is incomplete.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pricewright.operators.quality import keep_first
from pricewright.sources.cards import signature

#: Ways to capture a page in order: as the page asked for its data, by turning the page, by that data again, by its address.
WAYS = ["captured", "turned", "captured again", "address"]
VERDICTS = "job string, page long, attempt int, signature string, verdict string, next_way string"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def distinct_pages(pages: DataFrame, job: str, order: list[str], html: str = "html") -> DataFrame:
    """`pages` with signature, the first by `order` of each signature of a job; pages without cards are all kept."""
    d = pages.withColumn("signature", signature(F.col(html)))
    return keep_first(d.where("signature is not null"), [job, "signature"], order).unionByName(d.where("signature is null"))


def _next_way(attempt: Column) -> Column:
    return F.get(F.array(*map(F.lit, WAYS)), attempt + 1)


class FirstPage(StatefulProcessor):
    """For each signature of a job the page that showed it first. State goes when no capture of it came for `keep` seconds of
    event time."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "page long, attempt int, expires long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        told = []
        held = self.held.get() if self.held.exists() else None
        for d in rows:
            for page, attempt, captured in sorted(zip(d["page"].tolist(), d["attempt"].tolist(), d["captured"], strict=True), key=lambda r: (r[2], r[0], r[1])):
                expires = int(captured.timestamp() * 1000) + self.keep * 1000
                if held is None:
                    held = (page, attempt, expires)
                    told.append((key[0], page, attempt, key[1], "saved", None))
                elif page == held[0]:
                    # The same capture once more, or another way to a page that is there.
                    told.append((key[0], page, attempt, key[1], "again", None))
                else:
                    way = WAYS[attempt + 1] if attempt + 1 < len(WAYS) else None
                    told.append((key[0], page, attempt, key[1], "repeat" if way else "lost", way))
                held = (held[0], held[1], max(held[2], expires))
        self.held.update(held)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(held[2])
        yield pd.DataFrame(told, columns=[x.split()[0] for x in VERDICTS.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def page_verdicts(captures: DataFrame, keep: int = 3600, delay: str = "10 minutes") -> DataFrame:
    """A stream of captures (job, page, attempt, html, captured) as verdicts: job, page, attempt, signature, verdict, next_way.

    saved: the first page with these cards; again: that page once more; repeat: another page's cards, or empty: none, where
    next_way has its turn; lost: no way is left. Signatures of a job are keys of their own, so a job with many pages is dealt
    to many tasks."""
    spark = captures.sparkSession
    if "StateStoreProvider" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or "") or "HDFS" in spark.conf.get("spark.sql.streaming.stateStore.providerClass"):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    d = captures.select("job", F.col("page").cast("long").alias("page"), F.col("attempt").cast("int").alias("attempt"), "captured", signature(F.col("html")).alias("signature"))
    d = d.withWatermark("captured", delay)
    way = _next_way(F.col("attempt"))
    none = d.where("signature is null").select("job", "page", "attempt", "signature", F.when(way.isNotNull(), "empty").otherwise("lost").alias("verdict"), way.alias("next_way"))
    some = d.where("signature is not null").groupBy("job", "signature").transformWithStateInPandas(FirstPage(keep), VERDICTS, "Append", "EventTime")
    return some.unionByName(none)


def fresh_pages(spark: SparkSession, path: str, schema: str, delay: str = "1 hour") -> DataFrame:
    """A stream of pages from a folder of Parquet files, each signature once within the watermark; needs a column `captured`. Pages
    without cards are all kept: their key is their own text and time."""
    pages = spark.readStream.schema(schema).parquet(path)
    d = pages.withColumn("signature", signature(F.col("html")))
    own = F.when(F.col("signature").isNull(), F.concat_ws("|", F.col("captured").cast("string"), F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in pages.columns])), 256)))
    return d.withColumn("_own", own).withWatermark("captured", delay).dropDuplicatesWithinWatermark(["signature", "_own"]).drop("_own")
