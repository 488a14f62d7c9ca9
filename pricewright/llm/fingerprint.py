"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text is the multiset of its paragraphs (lines). Each paragraph is hashed to a wide vector; the fingerprint is the
sum of the vectors, lane by lane, modulo powers of two: EXACT lanes of 64 bits from a cryptographic hash of the
whole paragraph, and LIKE lanes of 32 bits that count its 8-byte windows with a random sign. So the order of
paragraphs doesn't matter, and a paragraph is inserted or deleted by adding or subtracting its vector (add(),
subtract()). Equal multisets have equal fingerprints; the LIKE lanes of two fingerprints estimate the likeness
2 a.b / (a.a + b.b) of the texts' window counts.

edits() compares each text with its edited form and with the next text by id. Documents are dealt into ranges that end at
quantiles of the ids (sqrt(n) of them, 4096 at most; an id of very many rows is dealt on by a hash of the text), and the first of
each range is sent to the range before it as well, so every text moves once and no task sees the whole order.

Defined cases: a null or empty text is one empty paragraph; likeness is 1 for equal fingerprints, else 0 where
neither text has a window; null ids come first, equal ids are ordered by a hash of the text; the next of the last is
the first, of a single row the row itself; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written

EXACT, LIKE = 8, 128
SLICE = 1 << 20


def _like(texts: list[bytes]) -> np.ndarray:
    """(texts, LIKE) int32: signed counts of 8-byte windows, cut off at a paragraph's end."""
    out = np.zeros((len(texts), LIKE), dtype=np.int64)
    buf = np.frombuffer(b"".join(t + b"\n" for t in texts) + bytes(8), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    for at in range(0, len(buf) - 8, SLICE):
        n = min(SLICE, len(buf) - 8 - at)
        part = buf[at : at + n + 8]
        w = np.ndarray((n,), dtype="<u8", buffer=part, strides=(1,)).astype(np.uint64)
        breaks = np.flatnonzero(part == 10)
        for k in range(1, 8):
            # Places k before a break keep k bytes; nearer breaks are dealt with first and cut more.
            p = breaks - k
            p = p[(p >= 0) & (p < n)]
            w[p] &= np.uint64((1 << 8 * k) - 1)
        keep = np.flatnonzero(part[:n] != 10)
        # A cut window has bytes past another break only if it starts before that break: cut there as well.
        h = w[keep] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        lane = (h >> np.uint64(57)).astype(np.int64)
        sign = ((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64) * 2 - 1
        doc = np.searchsorted(ends, keep + at, side="right")
        low = int(doc[0]) if len(doc) else 0
        high = int(doc[-1]) + 1 if len(doc) else 0
        if high > low:
            got = np.bincount((doc - low) * LIKE + lane, weights=sign, minlength=(high - low) * LIKE)
            out[low:high] += got.astype(np.int64).reshape(high - low, LIKE)
    return out.astype(np.int32)


def _exact(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), EXACT), dtype=np.uint64)
    for i, t in enumerate(texts):
        digests = b"".join(hashlib.blake2b(p, digest_size=8 * EXACT).digest() for p in t.split(b"\n"))
        out[i] = np.frombuffer(digests, dtype="<u8").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)
    return out


class Prints:
    """Fingerprints of some texts, lane by lane."""

    def __init__(self, exact: np.ndarray, like: np.ndarray):
        self.exact, self.like = exact, like

    @classmethod
    def of(cls, texts: list[str]) -> Prints:
        raw, at, like = [t.encode() for t in texts], 0, []
        while at < len(raw):
            to, held = at + 1, len(raw[at])
            while to < len(raw) and held + len(raw[to]) < SLICE:
                held += len(raw[to])
                to += 1
            like.append(_like(raw[at:to]))
            at = to
        return cls(_exact(raw), np.concatenate(like) if like else np.zeros((0, LIKE), np.int32))

    def __getitem__(self, at: slice) -> Prints:
        return Prints(self.exact[at], self.like[at])

    def add(self, other: Prints) -> Prints:
        with np.errstate(over="ignore"):
            return Prints(self.exact + other.exact, self.like + other.like)

    def subtract(self, other: Prints) -> Prints:
        with np.errstate(over="ignore"):
            return Prints(self.exact - other.exact, self.like - other.like)

    def written(self) -> list[str]:
        return [base64.b64encode(e.astype("<u8").tobytes() + s.astype("<i4").tobytes()).decode() for e, s in zip(self.exact, self.like, strict=True)]

    @classmethod
    def parsed(cls, prints: list[str]) -> Prints:
        raw = [base64.b64decode(p) for p in prints]
        return cls(np.array([np.frombuffer(r[: 8 * EXACT], "<u8") for r in raw]), np.array([np.frombuffer(r[8 * EXACT :], "<i4") for r in raw]))

    def likeness(self, other: Prints) -> np.ndarray:
        a, b = self.like.astype(np.float64), other.like.astype(np.float64)
        norm = (a * a).sum(axis=1) + (b * b).sum(axis=1)
        got = np.clip(2 * (a * b).sum(axis=1) / np.where(norm > 0, norm, 1), 0, 1)
        same = (self.exact == other.exact).all(axis=1) & (self.like == other.like).all(axis=1)
        return np.where(same, 1.0, got)


def fingerprints(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """id, fingerprint; one row for each row, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(Prints.of(batch.column(1).to_pylist()).written(), pa.string())], names=[id_column, "fingerprint"])

    return docs.select(id_column, text_or_empty().alias("_text")).mapInArrow(run, f"`{id_column}` {dict(docs.dtypes)[id_column]}, fingerprint string")


FIRST_ID, RANGES = -(1 << 63), 4096


def _place(key: Column, hashed: Column, splits: list[int]) -> Column:
    """The range of a row in the order of key and hash. A key that several splits share, since very many rows have it, is dealt
    to as many ranges by its hash."""
    ends = F.split(F.lit(",".join(map(str, splits))), ",").cast("array<bigint>")
    twins = [0] * len(splits)
    for i in reversed(range(len(splits))):
        twins[i] = 1 + (twins[i + 1] if i + 1 < len(splits) and splits[i + 1] == splits[i] else 0)
    many = F.split(F.lit(",".join(map(str, twins))), ",").cast("array<int>")

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc.lo + acc.hi) / 2).cast("int")
        right = F.get(ends, mid) < key
        lo, hi = F.when(right, mid + 1).otherwise(acc.lo), F.when(right, acc.hi).otherwise(mid)
        return F.struct(F.when(acc.lo < acc.hi, lo).otherwise(acc.lo).alias("lo"), F.when(acc.lo < acc.hi, hi).otherwise(acc.hi).alias("hi"))

    steps = F.sequence(F.lit(1), F.lit(max(1, len(splits).bit_length())))
    below = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(splits)).alias("hi")), halve, lambda acc: acc.lo)
    share = (hashed.cast("double") / 2.0**64 + 0.5) * F.get(many, below)
    last = F.get(many, below) - 1
    return F.when(F.get(ends, below) == key, below + 1 + F.least(F.floor(share).cast("int"), last)).otherwise(below)


def _with_next(docs: DataFrame, id_column: str) -> DataFrame:
    """_to, _own, _id, _text: ranges of ids, each sorted and followed by the first row of the range after it. Ranges end
    at quantiles of the ids, so clusters, far ones and ids of very many rows make no large range."""
    d = docs.select(F.col(id_column).cast("long").alias("_id"), text_or_empty().alias("_text"))
    d = d.select("_id", F.coalesce("_id", F.lit(FIRST_ID)).alias("_k"), F.xxhash64("_text").alias("_hash"), "_text")
    k = min(RANGES, max(2, math.isqrt(d.select("_id").count())))
    quantiles = F.percentile_approx("_k", [i / k for i in range(1, k)], 10 * k)
    splits = d.agg(quantiles.alias("q")).first().q or [0]  # k at most
    d = d.select("_id", "_k", "_hash", "_text", _place(F.col("_k"), F.col("_hash"), splits).alias("_range"))
    first = F.min(F.struct(F.col("_k").alias("k"), F.col("_hash").alias("h")))
    heads = written(d.groupBy("_range").agg(first.alias("h")), "heads")
    # At most RANGES rows: a window over them, and a broadcast of them, stay small at any size.
    before = F.lag("_range").over(Window.orderBy("_range"))
    last = F.max("_range").over(Window.partitionBy(F.lit(0)))
    heads = heads.select(F.col("_range").alias("_r"), F.col("h.k").alias("_i"), F.col("h.h").alias("_j"), F.coalesce(before, last).alias("_to"), before.isNull().cast("int").alias("_wrap"))
    copies = d.join(F.broadcast(heads), (F.col("_range") == F.col("_r")) & (F.col("_k") == F.col("_i")) & (F.col("_hash") == F.col("_j")), "left")
    own = F.struct(F.col("_range").alias("to"), F.lit(0).alias("wrap"), F.lit(True).alias("own"))
    sent = F.struct(F.col("_to").alias("to"), (F.col("_wrap") + 1).alias("wrap"), F.lit(False).alias("own"))
    rows = copies.select("_id", "_k", "_hash", "_text", F.explode(F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, sent))).alias("x"))
    rows = rows.select(F.col("x.to").alias("_to"), F.col("x.wrap").alias("_wrap"), F.col("x.own").alias("_own"), "_id", "_k", "_hash", "_text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "_to").sortWithinPartitions("_to", "_wrap", "_k", "_hash")


def edits(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    names = [id_column, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                yield from zip(*(part.column(n).to_pylist() for n in ("_to", "_own", "_id", "_text")), strict=True)

    def flush(chunk: list[tuple]) -> pa.RecordBatch | None:
        texts = [r[3] for r in chunk]
        pairs = [i for i in range(len(chunk) - 1) if chunk[i][1] and chunk[i][0] == chunk[i + 1][0]]
        edited = []
        for i in pairs:
            k = len(texts[i]) // 4
            edited.append(texts[i][: len(texts[i]) - k] + texts[i + 1][:k])
        here, there = Prints.of(texts), Prints.of(edited)
        at = np.array(pairs, dtype=np.int64)
        cols = [
            [chunk[i][2] for i in pairs],
            [len(texts[i]) for i in pairs],
            [hashlib.sha256(e.encode()).hexdigest() for e in edited],
            here[at].written(),
            there.written(),
            here[at].likeness(there),
            here[at].likeness(here[at + 1]),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names) if pairs else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = [], 0
        for row in rows(batches):
            chunk.append(row)
            held += len(row[3])
            if len(chunk) > 500 or held > SLICE:
                # The last row waits for the one after it.
                if len(chunk) > 1 and (out := flush(chunk)):
                    yield out
                chunk, held = chunk[-1:], len(row[3])
        if len(chunk) > 1 and (out := flush(chunk)):
            yield out

    schema = f"`{id_column}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _with_next(docs, id_column).mapInArrow(run, schema)
