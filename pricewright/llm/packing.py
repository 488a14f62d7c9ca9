"""Best-fit packing by minimum bin slack.

Texts become ids of a byte-level BPE followed by an end id; longer ones are cut into pieces of `capacity`, the first
piece taking what is left over. A packing depends on nothing but how many pieces there are of each length, a table
of at most `capacity` rows, so that is all the driver gets: again and again the longest piece left is joined by the
fullest combination that a bitset subset-sum over the lengths left can reach, and that bin is used as often as the
counts allow. Pieces are then ranked within their length (in buckets of ids, never one task for a length) and the
rank says the sequence and the place. Pieces that fill a sequence alone, which grow with the longest texts, need no rank: each is a
sequence of its own, numbered below 0 where it is read.

Defined cases: a null text counts as empty and is one piece, the end id alone; ties and repeated rows are ranked by
id, then piece, then a checksum of their ids: rows that agree in all of these are interchangeable; an empty table
has no pieces; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written

CAPACITY, END = 1024, 2
SPECIAL = "<|endoftext|>"


def vocabulary() -> tuple[str, str, str]:
    """Files of the public tokenizer (whole form, ranks) and its pattern."""
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN


class Encoder:
    """Ids as tokenizers gives them. The same vocabulary as ranks is five times as fast and gives the same ids for any
    text without the special token's string; texts that have it go to the whole form."""

    def __init__(self, files: tuple[str, str, str] | None = None):
        import tiktoken

        self.whole, ranks, pattern = files or vocabulary()
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.slow = None

    def __call__(self, text: str) -> list[int]:
        if SPECIAL not in text:
            return self.fast.encode_ordinary(text)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.whole)
        return self.slow.encode(text, add_special_tokens=False).ids


def pieces(docs: DataFrame, id_column: str = "doc_id", capacity: int = CAPACITY, end: int = END, files: tuple[str, str, str] | None = None, with_ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32 (and ids)."""
    kind = dict(docs.dtypes)[id_column]
    schema = f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(files)
        for batch in batches:
            at, piece, start, length, crc, all_ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.array([*encode(text.as_py()), end], dtype="<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(min(first, len(ids)), len(ids) + 1, capacity)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    at.append(i)
                    piece.append(p)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        all_ids.append(ids[a:b].astype("i4"))
            cols = [batch.column(0).take(pa.array(at, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = [id_column, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(id_column, text_or_empty().alias("_text")).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(times, pieces by length) for each kind of bin; every piece is used exactly once.

    Bits of `reach` are the sums that pieces left can make. A length with c pieces left enters as blocks of 1, 2, 4,
    ... of them, and the sums before each block are kept to trace the fullest one back. Each kind of bin is used
    until a length runs short, so their number is bounded by the lengths, not by the pieces."""
    left = {n: c for n, c in counts.items() if c > 0}
    out, full = [], (1 << (capacity + 1)) - 1
    while left:
        longest = max(left)
        room = capacity - longest
        bin_ = {longest: 1}
        reach, trail = 1, []
        limit = (1 << (room + 1)) - 1
        for n in sorted((n for n in left if n <= room), reverse=True):
            c, block = min(left[n] - (n == longest), room // n), 1
            while c > 0:
                k = min(block, c)
                trail.append((reach, n, k))
                reach |= (reach << (n * k)) & limit & full
                c -= k
                block *= 2
            if reach >> room:
                break
        want = reach.bit_length() - 1
        for before, n, k in reversed(trail):
            if not before >> want & 1:
                want -= n * k
                bin_[n] = bin_.get(n, 0) + k
        times = min(left[n] // k for n, k in bin_.items())
        out.append((times, bin_))
        for n, k in bin_.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return out


def pack(cut: DataFrame, id_column: str = "doc_id", capacity: int = CAPACITY, buckets: int | None = None) -> DataFrame:
    """`cut` (as pieces() gives it, from a written table) with sequence_id and offset. `buckets` of each length follow the
    number of pieces, from 64 to 1024, so the driver counts `capacity` times 1024 of them at most."""
    full, cut = cut.where(F.col("length") == capacity), cut.where(F.col("length") < capacity)
    alone = full.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if buckets is None:
        buckets = min(1024, max(64, 1 << (cut.count() >> 20).bit_length()))
    bucket = F.pmod(F.xxhash64(id_column, "piece", "ids_crc32"), F.lit(buckets)).alias("_bucket")
    cut = cut.select("*", bucket)
    sums = cut.groupBy("length", "_bucket").agg(F.count("*").alias("n"))
    counted = {(r.length, r._bucket): r.n for r in sums.collect()}  # capacity * buckets rows at most
    by_length: dict[int, int] = {}
    first: dict[tuple[int, int], int] = {}
    for key in sorted(counted):
        first[key] = by_length.get(key[0], 0)
        by_length[key[0]] = first[key] + counted[key]
    # For each length, runs of ranks: (rank where it starts, first sequence, pieces a sequence, place of the first).
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used, sequence = dict.fromkeys(by_length, 0), 0
    for times, bin_ in plan(by_length, capacity):
        place = 0
        for n, k in bin_.items():
            runs.setdefault(n, []).append((used[n], sequence, k, place))
            used[n] += times * k
            place += n * k
        sequence += times
    tables = {n: np.array(r, dtype=np.int64) for n, r in runs.items()}
    own = Window.partitionBy("length", "_bucket").orderBy(id_column, "piece", "ids_crc32")
    ranked = cut.select("*", F.row_number().over(own).cast("long").alias("_rank"))
    schema = ", ".join(f"`{n}` {t}" for n, t in cut.drop("_bucket").dtypes) + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, group, rank = (batch.column(n).to_numpy() for n in ("length", "_bucket", "_rank"))
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.lexsort((group, length))
            ends = np.flatnonzero((np.diff(length[order]) != 0) | (np.diff(group[order]) != 0)) + 1
            for rows in np.split(order, ends) if len(order) else ():
                n = int(length[rows[0]])
                at = rank[rows] - 1 + first[n, int(group[rows[0]])]
                t = tables[n]
                r = t[np.searchsorted(t[:, 0], at, side="right") - 1]
                inside = at - r[:, 0]
                seq[rows] = r[:, 1] + inside // r[:, 2]
                off[rows] = r[:, 3] + inside % r[:, 2] * n
            kept = [n for n in batch.schema.names if n not in ("_bucket", "_rank")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(seq), pa.array(off)], names=[*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema).unionByName(alone)


def packed(docs: DataFrame, id_column: str = "doc_id", capacity: int = CAPACITY, **params) -> DataFrame:
    return pack(written(pieces(docs, id_column, capacity, **params), "pieces"), id_column, capacity)
