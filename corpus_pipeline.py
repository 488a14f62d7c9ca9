"""A training-data pipeline over `documents`: quality rules, line dedup, near duplicates, mixing, packing.

Every stage but the last returns the columns of `documents`, whatever else is among them and whatever it is called, and works on
all rows that the stage before it kept. Each stage's docstring says what becomes of nulls, empty texts and repeated rows; an empty
table passes as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.llm import jaccard_join, line_dedup, mixing, packing, quality_rules
from pricewright.llm.common import WORD, dropped, row_of, table, written
from pricewright.llm.queries import MIX_WEIGHTS, source_domain

#: Share of the tokens that reach the mixing stage; each document is taken once at most, so a pack has no copies.
MIX_SHARE = 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified cutoff rejects go. A null or empty text has no words, so it goes; rows with a null id
    or language, and rows that repeat one, are judged each by its own text."""
    return quality_rules.apply(docs, table(spark, sf_dir, "labels"))


def _columns(d: DataFrame, docs: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """The columns of `docs` from the struct `row`, but for those that are changed."""
    return d.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines go; a document of which nothing is left goes with them. Null and empty texts have no lines
    and stay; null ids come first, and rows that repeat an id and a text are one place, so they are treated alike."""
    d = line_dedup.dedup(docs).where("n_removed = 0 or n_removed < n_lines")
    changed = {"text": F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text")), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))}
    return _columns(d, docs, changed)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays, of texts with one id the one with the least
    hash, of rows that repeat an id and a text one. Nothing links texts without words and null ids: all of them stay."""
    groups = written(jaccard_join.join(docs), "groups").where("component is not null")
    key = F.struct("doc_id", "text_hash")
    stays = groups.groupBy("component").agg(F.min(key).alias("_stays"), F.count("*").alias("_n")).where("_n > 1")
    others = groups.join(stays.withColumnRenamed("component", "_c"), F.col("component") == F.col("_c")).where(key != F.col("_stays"))
    others = others.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    others = written(others, "others")
    others = F.broadcast(others) if others.count() <= jaccard_join.BROADCAST_IDS else others
    rows = docs.select(row_of(docs).alias("row"))
    here = (F.col("row.doc_id") == F.col("_id")) & (F.xxhash64(F.coalesce("row.text", F.lit(""))) == F.col("_hash"))
    kept = rows.join(others, here, "left_anti")
    twice = written(groups.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).count().where("count > 1").select("_id", "_hash"), "twice")
    if not twice.isEmpty():
        one = kept.join(twice, here, "left_semi").withColumns({"_i": F.col("row.doc_id"), "_t": F.col("row.text")}).dropDuplicates(["_i", "_t"]).select("row")
        kept = kept.join(twice, here, "left_anti").unionByName(one)
    return _columns(kept, docs, {})


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a document that is taken in part the first words stay, with what stands between them. Texts without words, null ones too,
    have no tokens and go; a null language or source is a leaf of its own; each row counts, also one that repeats another."""
    d = mixing.mix(docs, source_domain(), MIX_SHARE, 1, MIX_WEIGHTS, columns=tuple(docs.columns)).select("row", "n_tokens", "taken")
    first = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), F.lit(0)), F.lit(1), F.col("taken").cast("int")), "")
    d = d.withColumn("cut", F.when(F.col("taken") < F.col("n_tokens"), first))
    changed = {"text": F.coalesce("cut", "row.text"), "n_chars": F.coalesce(F.length("cut").cast("long"), F.col("row.n_chars"))}
    return _columns(d, docs, changed)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and where they are put. A null or empty text is the closing token alone; a null id is carried, and rows
    that repeat an id are documents of their own."""
    return packing.packed(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
