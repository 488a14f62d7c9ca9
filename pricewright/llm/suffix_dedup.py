"""Substring dedup: every byte covered by a string of `length` bytes that starts elsewhere as well.

Texts are cut by content: of the K-byte strings in a window of `length` bytes the one with the smallest hash is the
window's anchor, so equal windows have equal anchors. An anchor with the windows that chose it makes a segment. Anchors
that stand once in the corpus can't be in a repeated window and are put aside by one aggregate of their hashes.
Segments that are equal as a whole are merged before any are gathered, however many documents share them: where two
or more are equal all their windows are repeated. What is left, segments that share an anchor but differ around it,
goes with one copy of each merged segment to shards by anchor; a shard is sorted by external induced sorting
(suffix_sort), and a window whose common prefix with a neighbour in suffix order reaches `length` is repeated.
Windows are judged on the input, and never cross documents.

A shard closes between anchors, so one anchor's segments are sorted together. An anchor whose differing segments have
over HOT bytes (a passage in very many documents, each with its own surroundings) is not sorted: its windows are told apart by
64-bit hashes and counted by an aggregate, so no task holds them together. A task's memory is bounded by SHARD + HOT bytes and the
arrays over them.

Defined cases: a null text counts as empty; texts shorter than `length` bytes lose nothing; rows that repeat an id and
a text are places of their own, so a repeated row of `length` bytes or more loses all; ids may be null; an empty
table gives no rows; long texts are cut into overlapping slices of 1 MB while anchors are searched. Anchors, equal
segments and rows are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, text_or_empty, written
from .suffix_sort import suffixes

LENGTH, K = 200, 48
SLICE, SHARD, HOT = 1 << 20, 4 << 20, 16 << 20
#: What is broadcast at most; larger tables are joined by shuffle.
BROADCAST_BYTES = 16 << 20
U = np.uint64
_seed = np.random.default_rng(7)
BYTE = _seed.integers(1, 2**63, 256, dtype=np.int64).astype(U)
BASE = int(_seed.integers(1, 2**62)) * 8 + 5


def _powers(n: int, cache: dict[str, np.ndarray] = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    if len(cache.get("p", ())) < n:
        cache["p"] = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, U(BASE))]), dtype=U)
        cache["q"] = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, U(pow(BASE, -1, 2**64)))]), dtype=U)
    return cache["p"], cache["q"]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def _least(h: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest value of each window of w, and how far on it first stands."""
    at, span = np.zeros(len(h), dtype=np.uint8), 1
    while span < w:
        step = min(span, w - span)
        later = h[step:] < h[:-step]
        at = np.where(later, at[step:] + np.uint8(step), at[:-step])
        h = np.minimum(h[:-step], h[step:])
        span += step
    return h, at


def anchors(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, ...]:
    """(text number, first window, last window, anchor hash, content hash) of each segment in `buf`, where texts of at
    least `length` bytes lie one after another at `starts`; places count from a text's start."""
    p, q = _powers(SLICE * 2 if len(buf) < SLICE * 2 else len(buf) + 1)
    sums = np.concatenate([[U(0)], np.cumsum(BYTE[buf] * p[: len(buf)], dtype=U)])
    grams = _mix((sums[k:] - sums[:-k]) * q[: len(buf) - k + 1])
    _, off = _least(grams, length - k + 1)
    n = sizes - length + 1
    text = np.repeat(np.arange(len(starts)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)  # of each window, in buf
    anchor = place + off[place]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    lo, hi, t = place[first], place[last], text[first]
    content = _mix((sums[hi + length] - sums[lo]) * q[lo] + (hi - lo).astype(U))
    return t, lo - starts[t], hi - starts[t], grams[anchor[first]], content


def _keyed(docs: DataFrame, id_column: str) -> DataFrame:
    return docs.select(F.col(id_column), F.xxhash64(F.coalesce(F.col(id_column).cast("long"), F.lit(-(1 << 63))), F.xxhash64(text_or_empty())).alias("u"), text_or_empty().alias("text"))


def _segments(keyed: DataFrame, length: int) -> DataFrame:
    """h (anchor), c (content), u (row), lo, hi (first and last window)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for u, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = text.as_py().encode()
                # Slices share length - 1 bytes, so each window lies in one.
                for at in range(0, len(raw) - length + 1, SLICE):
                    part = raw[at : at + SLICE + length - 1]
                    held.append((u, at, part))
                    size += len(part)
                    if size >= SLICE:
                        yield flush(held)
                        held, size = [], 0
            if held:
                yield flush(held)

    def flush(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(x) for _, _, x in held])
        t, lo, hi, h, c = anchors(np.frombuffer(b"".join(x for _, _, x in held), np.uint8), np.cumsum(sizes) - sizes, sizes, length)
        u, at = np.array([x[0] for x in held], np.int64), np.array([x[1] for x in held], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(u[t]), pa.array(lo + at[t]), pa.array(hi + at[t])], names=["h", "c", "u", "lo", "hi"])

    return keyed.select("u", "text").mapInArrow(run, "h long, c long, u long, lo long, hi long")


def _fetched(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """h, u, lo, alone, bytes: the bytes of segments, cut out of their texts."""
    lists = written(wanted.groupBy(F.col("u").alias("_u")).agg(F.collect_list(F.struct("h", "lo", "hi", "alone")).alias("s")), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done: set[tuple[int, int]] = set()
            for u, text, segments in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                raw, rows = text.as_py().encode(), []
                for s in segments.as_py():
                    if (u, s["lo"]) not in done:
                        done.add((u, s["lo"]))
                        rows.append((s["h"], u, s["lo"], s["alone"], raw[s["lo"] : s["hi"] + length]))
                for i in range(0, len(rows), 5000):
                    cols = list(zip(*rows[i : i + 5000], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()), strict=True)], names=["h", "u", "lo", "alone", "bytes"])

    return keyed.join(lists, F.col("u") == F.col("_u")).select("u", "text", "s").mapInArrow(run, "h long, u long, lo long, alone boolean, bytes binary")


def repeated_windows(segments: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Places, in the joined segments (each followed by one separator), of windows that stand twice or more."""
    with tempfile.TemporaryDirectory() as folder:
        size = sum(len(s) + 1 for s in segments) + 1
        text = np.memmap(f"{folder}/text", dtype=np.uint16, mode="w+", shape=(size,))
        room, at = np.zeros(len(segments), np.int64), 0
        for i, s in enumerate(segments):
            room[i] = at + len(s) - length  # its last window
            text[at : at + len(s)] = np.frombuffer(s, np.uint8).astype(np.uint16) + 2
            text[at + len(s)] = 1
            at += len(s) + 1
        text[at] = 0
        found, before = [], -1
        for pos, lcp in suffixes(text, folder, length):
            hit = np.flatnonzero(lcp >= length)
            if len(hit):
                both = np.concatenate([pos[hit], np.where(hit > 0, pos[np.maximum(hit - 1, 0)], before)])
                # A common prefix that runs over a separator is no window.
                found.append(both[both <= room[np.minimum(np.searchsorted(room + length, both), len(room) - 1)]])
            before = int(pos[-1])
        del text
    every = np.sort(np.concatenate([np.zeros(0, np.int64), *found]))
    return every[np.concatenate([[True], every[1:] != every[:-1]])[: len(every)]]


def _sorted_out(rows: DataFrame, length: int) -> DataFrame:
    """u, s, e: bytes of the segments that stand alone which repeated windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("h", "u", "lo", "alone", "bytes")), strict=True):
                if size >= SHARD and row[0] != last:
                    yield from shard(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
                last = row[0]
        if held:
            yield from shard(held)

    def shard(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        where = repeated_windows([r[4] for r in held], length)
        begins = np.cumsum([0, *(len(r[4]) + 1 for r in held)])
        of = np.searchsorted(begins, where, side="right") - 1
        out = []
        for i in np.unique(of):
            _, u, lo, alone, _ = held[i]
            if alone:
                p = where[of == i] - begins[i] + lo
                cuts = np.flatnonzero(np.diff(p) > length)
                out += [(u, int(a), int(b) + length) for a, b in zip(p[np.append(0, cuts + 1)], p[np.append(cuts, len(p) - 1)], strict=True)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["u", "s", "e"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "h").sortWithinPartitions("h", "u", "lo").mapInArrow(run, "u long, s long, e long")


def _counted_out(rows: DataFrame, length: int) -> DataFrame:
    """As _sorted_out, by counting the windows' hashes; for anchors with more segments than a task may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for u, lo, alone, raw in zip(*(batch.column(n).to_pylist() for n in ("u", "lo", "alone", "bytes")), strict=True):
                buf = np.frombuffer(raw, np.uint8)
                p, q = _powers(SLICE * 2)
                sums = np.concatenate([[U(0)], np.cumsum(BYTE[buf] * p[: len(buf)], dtype=U)])
                w = _mix((sums[length:] - sums[:-length]) * q[: len(buf) - length + 1])
                n = len(w)
                yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(np.full(n, u, np.int64)), pa.array(lo + np.arange(n)), pa.array(np.full(n, alone))], names=["w", "u", "s", "alone"])

    windows = written(rows.select("u", "lo", "alone", "bytes").mapInArrow(run, "w long, u long, s long, alone boolean"), "windows")
    twice = written(windows.groupBy(F.col("w").alias("_w")).count().where("count > 1").select("_w"), "twice")
    return windows.where("alone").join(twice, F.col("w") == F.col("_w"), "left_semi").select("u", "s", (F.col("s") + length).alias("e"))


def _merged(covers: DataFrame) -> DataFrame:
    """_u, runs (array of struct s, e: maximal, in order), from covers u, s, e."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
        now, runs, out = None, [], []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([u for u, _ in out], pa.int64()), pa.array([[{"s": a, "e": b} for a, b in r] for _, r in out], kind)], names=["_u", "runs"])

        for batch in batches:
            for u, s, e in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if u != now:
                    if runs:
                        out.append((now, runs))
                    now, runs = u, []
                    if len(out) > 2000:
                        yield rows()
                        out = []
                if runs and s <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], e)
                else:
                    runs.append([s, e])
        if runs:
            out.append((now, runs))
        yield rows()

    parts = int(covers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return covers.repartition(parts, "u").sortWithinPartitions("u", "s").mapInArrow(run, "_u long, runs array<struct<s: long, e: long>>")


def repeats(docs: DataFrame, id_column: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """_u (the row's key), runs: the covered bytes of each row that has any."""
    keyed = _keyed(docs, id_column)
    every = written(_segments(keyed, length), "segments")
    low = F.col("h").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")  # 31 bits make smaller rows; chance company does no harm
    # Tables that are joined to are written, so that a join reads shuffles on both sides and can split a hot anchor.
    often = written(every.groupBy(low.alias("_h")).count().where("count > 1").select("_h"), "often")
    active = written(every.join(often, low == F.col("_h"), "left_semi"), "active")
    dropped(every)
    dropped(often)
    classes = written(active.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("u", "lo", "hi")).alias("rep")), "classes")
    bytes_ = F.sum(F.col("rep.hi") - F.col("rep.lo") + length)
    mixed = written(classes.groupBy(F.col("h").alias("_h")).agg(F.count("*").alias("n"), (bytes_ > HOT).alias("hot")).where("n > 1").select("_h", "hot"), "mixed")
    wanted = classes.join(mixed, F.col("h") == F.col("_h")).select("h", "rep.u", "rep.lo", "rep.hi", (F.col("n") == 1).alias("alone"), "hot")
    parts = _sorted_out(_fetched(keyed, wanted.where("not hot"), length), length)
    if not mixed.where("hot").isEmpty():
        parts = parts.unionByName(_counted_out(_fetched(keyed, wanted.where("hot"), length), length))
    equal = classes.where("n > 1").select(F.col("h").alias("_h"), F.col("c").alias("_c"))
    whole = active.join(equal, (F.col("h") == F.col("_h")) & (F.col("c") == F.col("_c")), "left_semi").select("u", F.col("lo").alias("s"), (F.col("hi") + length).alias("e"))
    return written(_merged(parts.unionByName(whole)), "runs")


def dedup(docs: DataFrame, id_column: str = "doc_id", length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 (and runs, kept: the remaining bytes)."""
    runs = repeats(docs, id_column, length)
    runs = F.broadcast(runs) if 32 * (runs.agg(F.sum(F.size("runs") + 1)).first()[0] or 0) < BROADCAST_BYTES else runs
    kind = dict(docs.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [id_column, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]
        for batch in batches:
            cols: list[list] = [[] for _ in names[1:]]
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                raw, at, kept = text.as_py().encode(), 0, []
                spans = found.as_py() or []
                for x in spans:
                    kept.append(raw[at : x["s"]])
                    at = x["e"]
                rest = b"".join([*kept, raw[at:]])
                for c, v in zip(cols, (len(raw), len(raw) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest), strict=False):
                    c.append(v)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=False))], names=names)

    keyed = _keyed(docs, id_column).join(runs, F.col("u") == F.col("_u"), "left").select(id_column, "text", "runs")
    return keyed.mapInArrow(run, f"`{id_column}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
