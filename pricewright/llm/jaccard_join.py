"""N-gram Jaccard self-join by token-combination prefixes.

A document's set holds the hashes of its 5-word shingles. Equal sets are one node: copies emit the same rows, which
fall together. All tokens have one global order: rare tokens first,
frequent ones last, by hash within each. A set of n tokens may miss d = n - ceil(t n) of them in a partner. Rare tokens
form a class in which one shared token is a signature; frequent tokens are dealt to classes in which two shared tokens
are one. A prefix that holds c_i tokens of class i shares no signature only if it misses c_i - k_i + 1 of each class,
so it is extended until those add up to d + 1: then two sets that link share a signature. Towards partners that
aren't smaller the set may miss fewer tokens; signatures of that shorter prefix are low, and a pair is compared only
where the smaller set's signature is.

Tokens are counted in two steps, over all documents. The first counts those whose hash is among the lowest FIRST
share, which are enough for most prefixes; the second counts the others in the documents whose prefix needs more rare
tokens, since only there can they become signatures. What is frequent is kept in two bitmaps of fixed size, in which a
chance collision only makes a rare token cost more. The number of classes follows the size of the set by powers of
two; a set that may have partners below its power of two emits the signatures of that level too.

Signatures are shuffled once, sorted, and those of one set only fall out as each task reads its share in order, so a
signature of any number of sets is never gathered. What is left groups sets. Instead of all pairs of a group, each round
compares every member with one leader of its group and size; links merge components, and members that are in the
leader's component already are done. In the first round copies of a group meet the same leader; later ones take another
leader for each signature. After STARS rounds the pairs of a group that are still in different components are compared,
none left out, so components are exact; groups with much the same members are one by then.

In every round 512-bit sketches of the sets, which never exaggerate their difference, rule out most of the pairs that
don't link before anything is read for them; only the sets of the pairs left are made from their texts. New links are
merged into the components of the rounds before by a graph of those components alone. Tables go after their last reader.

Hashes have 64 bits, nodes 63. Defined cases: null and empty texts and texts without words have an
empty set and link with nothing, their own or another's; fewer than five words are one shingle; a null id links with
nothing and its component is null; rows that repeat an id each get the component of
their own text (text_hash, xxhash64 of the text, tells them apart); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH, CLEANUP, configured, dropped, written

SHINGLE, PERCENT = 5, 80
FIRST, FREQUENT, BITS = 0.32, 24, 22
STARS = 2
#: Pairs of an open group that one task compares, about.
TASK_PAIRS = 1 << 20
#: Longs of a sketch: bits that say of a set's tokens in each bucket whether they are odd in number.
SKETCH = 8
#: Ids of documents that are broadcast at most (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Texts and pairs of sets that go to Python at once, and texts that are shingled before their sets go on. A text may have tens of
#: thousands of tokens, so a few rows are megabytes.
TEXT_ROWS, LINKED_ROWS, SET_ROWS = 2000, 32, 200
U = np.uint64
CUT = U(int(FIRST * 2**64))
LEAST_LEVEL, CLASS_SHIFT = 4, 4
_seed = np.random.default_rng(20240501)
#: A random value for each byte, lower case for A-Z; odd factors for the words of a shingle.
BYTE = _seed.integers(1, 2**63, 256, dtype=np.int64).astype(U)
BYTE[65:91] = BYTE[97:123]
FACTOR = _seed.integers(1, 2**63, SHINGLE, dtype=np.int64).astype(U) | U(1)
BASE = int(_seed.integers(1, 2**62)) * 8 + 5
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
SLICE = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def _powers(n: int, cache: dict[str, np.ndarray] = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of BASE and of its inverse modulo 2**64."""
    if len(cache.get("p", ())) < n:
        size = max(n, SLICE * 2)
        inverse = pow(BASE, -1, 2**64)
        cache["p"] = np.cumprod(np.concatenate([[U(1)], np.full(size - 1, U(BASE))]), dtype=U)
        cache["q"] = np.cumprod(np.concatenate([[U(1)], np.full(size - 1, U(inverse))]), dtype=U)
    return cache["p"], cache["q"]


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted and each once; for some hundred values sorting is quicker than np.unique's hashing."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text its distinct shingle hashes, sorted; memory follows the longest text or SLICE."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        to, held = at + 1, len(texts[at])
        while to < len(texts) and held + len(texts[to]) < SLICE:
            held += len(texts[to]) + 1
            to += 1
        out += _sets(texts[at:to])
        at = to
    return out


def _sets(texts: list[bytes]) -> list[np.ndarray]:
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    gap = SPACE[buf]
    edge = np.diff(np.concatenate([[True], gap]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    p, q = _powers(len(buf) + 1)
    sums = np.concatenate([[U(0)], np.cumsum(BYTE[buf] * p[: len(buf)], dtype=U)])
    word = mix((sums[stop] - sums[start]) * q[start])
    first = np.searchsorted(start, np.concatenate([[0], ends]))
    out = []
    last = len(word) - SHINGLE + 1
    grams = mix(sum((word[k : last + k] * FACTOR[k] for k in range(SHINGLE)), np.zeros(max(last, 0), U))) if last > 0 else np.zeros(0, U)
    for a, b in zip(first, first[1:], strict=False):
        n = b - a
        if n >= SHINGLE:
            out.append(distinct(grams[a : b - SHINGLE + 1]))
        elif n:
            out.append(mix(np.array([(word[a:b] * FACTOR[:n]).sum(dtype=U) + U(n)], dtype=U)))
        else:
            out.append(np.zeros(0, U))
    return out


def needed(n: int) -> int:
    """Tokens of n that a linked partner shares at least."""
    return -(-PERCENT * n // 100)


Bitmaps = tuple[np.ndarray, np.ndarray | None]


def _often(tokens: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    bucket = tokens & U((1 << BITS) - 1)
    return (bitmap[(bucket >> U(6)).astype(np.int64)] >> (bucket & U(63))) & U(1) == 1


def wanted(tokens: np.ndarray) -> int:
    """Tokens of which one at least is in every linked partner."""
    return len(tokens) - needed(len(tokens)) + 1


def smaller(tokens: np.ndarray) -> int:
    """The same for partners that aren't smaller, which share at least 2 t / (1 + t) of the tokens."""
    n = len(tokens)
    return n + (-2 * PERCENT * n) // (100 + PERCENT) + 1


def signatures(tokens: np.ndarray, bitmaps: Bitmaps, want: int | None = None) -> np.ndarray:
    """Of one set (sorted hashes); want: wanted() or smaller(); bitmaps: bit words of the frequent tokens, of the first share and of the others."""
    n = len(tokens)
    level = n.bit_length() - 1
    levels = {level} | ({level - 1} if 100 * (1 << level) >= PERCENT * n else set())
    first, others = tokens[tokens < CUT], tokens[tokens >= CUT]
    a, b = _often(first, bitmaps[0]), _often(others, bitmaps[1])
    rare = np.concatenate([first[~a], others[~b]])
    rest = np.concatenate([first[a], others[b]])
    want = want or wanted(tokens)
    singles, combos = 0, []
    for lv in levels:
        if lv < LEAST_LEVEL:
            # Small sets: every token is a class of its own, in the same order.
            singles = max(singles, min(want, n))
            if singles > len(rare):
                combos.append(rest[: singles - len(rare)])
            continue
        if len(rare) >= want:
            singles = max(singles, want)
            continue
        singles = len(rare)
        classes = (rest >> U(24)) & U((1 << (lv - CLASS_SHIFT)) - 1)
        # Each token but the first of its class adds one.
        adds = np.ones(len(rest), dtype=np.int64)
        adds[np.unique(classes, return_index=True)[1]] = 0
        end = int(np.searchsorted(np.cumsum(adds), want - len(rare))) + 1
        order = np.argsort(classes[:end], kind="stable")
        t, c = rest[:end][order], classes[:end][order]
        for group in np.split(t, np.flatnonzero(np.diff(c)) + 1):
            i, j = np.triu_indices(len(group), 1)
            combos.append(mix(group[i] * FACTOR[0] + group[j] * FACTOR[1] + U(lv)))
    return np.unique(np.concatenate([rare[:singles], *combos]))


def low_signatures(tokens: np.ndarray, bitmaps: Bitmaps) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of a set, and which of them are low. Most sets have rare tokens enough in the first share."""
    want = wanted(tokens)
    first = tokens[: np.searchsorted(tokens, CUT)]
    rare = first[~_often(first, bitmaps[0])]
    if len(rare) >= want:
        return rare[:want], np.arange(want) < smaller(tokens)
    every = signatures(tokens, bitmaps)
    return every, np.isin(every, signatures(tokens, bitmaps, smaller(tokens)), assume_unique=True)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and sets, some rows at a time."""
    for batch in batches:
        for at in range(0, len(batch), SET_ROWS):
            part = batch.slice(at, SET_ROWS)
            yield part.column(0).to_pylist(), shingle_sets([t.encode() for t in part.column(1).to_pylist()])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, U)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


LOW = -(1 << 63)
#: Nodes that a task remembers to leave out the copies it meets again; more are forgotten, and cost a row more.
SEEN = 1 << 16


def node(tokens: np.ndarray) -> int | None:
    """What equal sets have in common, 63 bits; null for the empty set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little") >> 1 if len(tokens) else None


class Once:
    """Of sets that come by, those that didn't lately; never the empty one."""

    def __init__(self):
        self.seen: dict[int, None] = {}

    def __call__(self, sets: list[np.ndarray]) -> list[tuple[int, np.ndarray]]:
        out = []
        for s in sets:
            n = node(s)
            if n is not None and n not in self.seen:
                out.append((n, s))
                self.seen[n] = None
        while len(self.seen) > SEEN:
            del self.seen[next(iter(self.seen))]
        return out


def nodes(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids, sets in _each(iter([batch])):
                told = batch.column(2).slice(at, len(ids))
                at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), told, pa.array([len(s) for s in sets], pa.int64()), pa.array([node(s) for s in sets], pa.int64())], names=["doc_id", "text_hash", "n_shingles", "node"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, "doc_id long, text_hash long, n_shingles long, node long")


def counted_tokens(docs: DataFrame, first: np.ndarray | None) -> DataFrame:
    """31 bits of each token of the first share; given the first bitmap, of each other token of the documents whose
    rare tokens of the first share are too few."""
    shared = docs.sparkSession.sparkContext.broadcast(first)

    def some(s: np.ndarray, bits: np.ndarray | None) -> np.ndarray:
        low = s[s < CUT]
        if bits is None:
            return low
        return s[s >= CUT] if len(s) and np.count_nonzero(~_often(low, bits)) < wanted(s) else s[:0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for _, sets in _each(batches):
            got = np.concatenate([np.zeros(0, U), *(some(s, bits) for s in sets)])
            yield pa.RecordBatch.from_arrays([pa.array((got & U(0x7FFFFFFF)).astype(np.int32))], names=["token"])

    return docs.mapInArrow(run, "token int")


def frequent_bits(docs: DataFrame, first: np.ndarray | None = None) -> np.ndarray:
    """A bitmap: 2**BITS bits, whatever the number of tokens. Counts are by 31 bits of the hash: tokens that fall
    together may count as frequent, which costs more and loses nothing."""
    with configured(docs.sparkSession, **{BATCH: str(TEXT_ROWS), CLEANUP: "true"}):
        often = counted_tokens(docs, first).groupBy("token").count().where(F.col("count") >= FREQUENT)
        bucket = F.col("token").bitwiseAND(F.lit((1 << BITS) - 1))
        words = often.select(F.shiftright(bucket, 6).alias("w"), F.expr(f"shiftleft(1L, (token & {(1 << BITS) - 1}) & 63)").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
        rows = words.collect()  # 2**BITS / 64 at most
    bitmap = np.zeros(1 << BITS >> 6, dtype=U)
    for r in rows:
        bitmap[r.w] = U(r.b & 0xFFFFFFFFFFFFFFFF)
    return bitmap


def posted(docs: DataFrame, bitmaps: Bitmaps) -> DataFrame:
    """sig, tag, n (tokens). The tag is the node, in its sign bit whether the signature is a low one (also towards
    partners that aren't smaller), so low ones sort first."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, once = shared.value, Once()
        for _, sets in _each(batches):
            new = once(sets)
            sigs = [low_signatures(s, bits) for _, s in new]
            n = [len(x) for x, _ in sigs]
            flat = np.concatenate([np.zeros(0, U), *(x for x, _ in sigs)])
            low = np.concatenate([np.zeros(0, bool), *(x for _, x in sigs)])
            tags = np.repeat(np.array([i for i, _ in new], np.int64), n) | np.where(low, np.int64(LOW), np.int64(0))
            rows = pa.RecordBatch.from_arrays([pa.array(c) for c in (flat.view(np.int64), tags, np.repeat(np.array([len(s) for _, s in new], np.int32), n))], names=["sig", "tag", "n"])
            for at in range(0, len(rows), 100_000):
                yield rows.slice(at, 100_000)

    return docs.mapInArrow(run, "sig long, tag long, n int")


def grouped(posts: DataFrame) -> DataFrame:
    """sig, id, n, low of the signatures that two sets have, one of them as a low one; equal rows become one.

    Rows come sorted by signature, low ones first. A row is kept if its group starts with a low one and has another; the
    first of a group waits for that, so a task holds one batch and one row more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, whether its group starts with it, and whether that has a low start
        for batch in batches:
            sig, tag, n = (c.to_numpy() for c in batch.columns)
            starts, opens = True, False
            if held is not None:
                sig, tag, n = (np.concatenate([[a], b]).astype(b.dtype) for a, b in zip(held[:3], (sig, tag, n), strict=True))
                starts, opens = held[3:]
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (tag[1:] != tag[:-1])
            sig, tag, n = sig[new], tag[new], n[new]
            if not len(sig):
                continue
            same = sig[1:] == sig[:-1]
            start = np.concatenate([[starts], ~same])
            low = tag < 0
            first = np.maximum.accumulate(np.where(start, np.arange(len(sig)), 0))
            open_ = low[first]
            if not starts:
                open_[first == 0] = opens
            keep = open_ & (~start | np.concatenate([same, [False]]))
            if held is not None and not starts:
                keep[0] = False  # it went with its batch
            held = (sig[-1], tag[-1], n[-1], bool(start[-1]), bool(open_[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(tag[keep] & np.int64(~LOW)), pa.array(n[keep]), pa.array(low[keep])], names=["sig", "id", "n", "low"])

    return posts.repartition("sig").sortWithinPartitions("sig", "tag").mapInArrow(run, "sig long, id long, n int, low boolean")


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Bits in which two sets differ are no more than the tokens in which they do."""
    bucket = (mix(tokens) >> U(32)) % U(64 * SKETCH)
    odd = np.bincount(bucket.astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(U)


def sketches(docs: DataFrame) -> DataFrame:
    """id (the node), size (its tokens), bits0.. (the sketch)."""
    names = ["id", "size", *(f"bits{i}" for i in range(SKETCH))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = Once()
        for _, sets in _each(batches):
            new = once(sets)
            bits = np.array([sketch(s) for _, s in new], U).reshape(-1, SKETCH).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in new], pa.int64()), pa.array([len(s) for _, s in new], pa.int32()), *(pa.array(np.ascontiguousarray(c)) for c in bits.T)], names=names)

    return docs.mapInArrow(run, "id long, size int, " + ", ".join(f"{n} long" for n in names[2:]))


def full_sets(docs: DataFrame) -> DataFrame:
    """id (the node), tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = Once()
        for _, sets in _each(batches):
            new = once(sets)
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in new], pa.int64()), _lists([s for _, s in new])], names=["id", "tokens"])

    return docs.mapInArrow(run, "id long, tokens array<long>")


def _apart(x: list[str], y: list[str], size_x: str, size_y: str):
    """Whether sketches don't rule a link out: sets that link differ in (1 - t) / (1 + t) of their sizes' sum at most."""
    differ = sum((F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(x, y, strict=True)), F.lit(0))
    return (100 + PERCENT) * differ <= (100 - PERCENT) * (F.col(size_x) + F.col(size_y))


def possible(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """The distinct pairs a, b that sketches don't rule out."""
    x, y = (sketched.select(*[F.col(c).alias(f"{c}_{s}") for c in sketched.columns]) for s in "xy")
    both = pairs.distinct().join(x, F.col("a") == F.col("id_x")).join(y, F.col("b") == F.col("id_y"))
    return both.where(_apart([f"bits{i}_x" for i in range(SKETCH)], [f"bits{i}_y" for i in range(SKETCH)], "size_x", "size_y")).select("a", "b")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b whose sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = []
            for i in range(len(batch)):
                s, t = x[i].values.to_numpy(), y[i].values.to_numpy()
                # Both have distinct tokens, so what stands twice is in both.
                every = np.sort(np.concatenate([s, t]), kind="stable")
                both = int(np.count_nonzero(every[1:] == every[:-1]))
                keep.append(100 * both >= PERCENT * (len(s) + len(t) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    d = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b")
    return d.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """id, comp (the smallest id) of every id in `links`: least labels spread along links, then along labels."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("far"))
        new = written(step.join(jump, "comp", "left").select("id", "old", F.least("comp", F.coalesce("far", "comp")).alias("comp")), "labels")
        dropped(labels)
        done = new.where("old != comp").isEmpty()
        labels = new.select("id", "comp")
        if done:
            dropped(both)
            return labels


def extended(known: DataFrame | None, links: DataFrame) -> DataFrame:
    """id, comp after `links`, from the components known before: what links join are those, each a node of its own."""
    if known is None:
        return components(links)
    a = known.select(F.col("id").alias("a"), F.col("comp").alias("ca"))
    b = known.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
    between = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a != b")
    labels = components(between)
    to = labels.select(F.col("id").alias("_old"), F.col("comp").alias("_new"))
    moved = known.join(to, F.col("comp") == F.col("_old"), "left").select("id", F.coalesce("_new", "comp").alias("comp"))
    fresh = labels.join(known.select(F.col("id").alias("_old")), F.col("id") == F.col("_old"), "left_anti")
    out = written(moved.unionByName(fresh), "components")
    dropped(labels)
    dropped(known)
    return out


def families(left: DataFrame) -> DataFrame:
    """Open groups (sig, id, n, low, comp) as key, salts, id, n, low, comp: every two ids that share a signature share a key.

    Documents that are much alike meet at each of their signatures. Groups whose member with the least hash is the
    same become one, if all its pairs are no more than theirs together, so such documents meet a few times. A group of
    many pairs is dealt to `salts` tasks."""
    size = [F.count("*").alias("_c"), F.sum(F.col("low").cast("long")).alias("_l")]
    of = left.groupBy(F.col("sig").alias("_sig")).agg(F.min(F.xxhash64("id")).alias("_fam"), *size)
    merged = left.join(of.select("_sig", "_fam"), F.col("sig") == F.col("_sig")).groupBy(F.col("_fam").alias("_f"), "id").agg(F.max("low").alias("low"))
    merged = merged.groupBy("_f").agg(*size).select("_f", (F.col("_c") * F.col("_l")).alias("_as_one"))
    alone = of.groupBy("_fam").agg(F.sum(F.col("_c") * F.col("_l")).alias("_apart"))
    better = alone.join(merged, F.col("_fam") == F.col("_f")).where("_as_one <= _apart").select("_f", "_as_one")
    keys = of.join(better, F.col("_fam") == F.col("_f"), "left").select("_sig", F.when(F.col("_f").isNull(), F.xxhash64(F.lit("one"), "_sig")).otherwise(F.col("_f")).alias("key"), F.ceil(F.coalesce("_as_one", F.col("_c") * F.col("_l")) / F.lit(TASK_PAIRS)).alias("salts"))
    rows = left.join(keys, F.col("sig") == F.col("_sig")).groupBy("key", "id").agg(F.max("salts").alias("salts"), F.first("n").alias("n"), F.max("low").alias("low"), F.first("comp").alias("comp"))
    return rows.withColumn("salts", F.greatest("salts", F.lit(1).cast("long")))


def _fits(a: str, b: str):
    return (100 * F.least(a, b) >= PERCENT * F.greatest(a, b))


def _chosen(known: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the documents in `ids` (_rep), broadcast only up to BROADCAST_IDS of them."""
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return known.join(few, F.col("doc_id") == F.col("_rep"), "left_semi")


def _star(g: DataFrame, r: int) -> DataFrame:
    """a, b: each member of a group with the leader of its group and size, where they aren't in one component."""
    band = F.floor(F.log("n") / F.log(F.lit(1.25)))
    lead = g.groupBy(F.col("sig").alias("_sig"), band.alias("_band")).agg(F.min_by(F.struct("id", "n", "comp"), F.xxhash64("id", *([F.col("sig"), F.lit(r)] if r else []))).alias("x"))
    pairs = g.join(lead, (F.col("sig") == F.col("_sig")) & (band == F.col("_band"))).where(F.col("comp") != F.col("x.comp"))
    return pairs.where(_fits("n", "x.n")).select(F.least("id", "x.id").alias("a"), F.greatest("id", "x.id").alias("b"))


def _rest(left: DataFrame, sketched: DataFrame) -> DataFrame:
    """a, b: every pair of an open group that is in two components and that sketches don't rule out."""
    bits = sketched.drop("size").withColumnRenamed("id", "_id")
    left = families(left).join(bits, F.col("id") == F.col("_id"))
    x, y = (left.select(*[F.col(c).alias(f"{c}_{s}") for c in ("key", "salts", "id", "n", "low", "comp", *bits.columns[1:])]) for s in "xy")
    near = _apart([f"{c}_x" for c in bits.columns[1:]], [f"{c}_y" for c in bits.columns[1:]], "n_x", "n_y")
    x = x.where("low_x").withColumn("salt_x", F.pmod(F.xxhash64("id_x"), F.col("salts_x")))
    y = y.withColumn("salt_y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts_y") - 1)))
    # The smaller set's signature must be a low one; of equal sizes either's.
    once = F.expr("n_x < n_y or n_x = n_y and (not low_y or id_x < id_y)")
    pairs = x.join(y, (F.col("key_x") == F.col("key_y")) & (F.col("salt_x") == F.col("salt_y")) & once & (F.col("comp_x") != F.col("comp_y")) & _fits("n_x", "n_y") & near)
    return pairs.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()


def join(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id: the smallest id that links lead to, component: what tells components
    apart where ids repeat (null: linked with nothing and equal to nothing)."""
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keys = written(nodes(slim), "nodes", batch=TEXT_ROWS)
    known = slim.where("doc_id is not null")
    first = frequent_bits(known)
    groups = written(grouped(posted(known, (first, frequent_bits(known, first)))), "groups", batch=TEXT_ROWS)
    # One text of each node that shares a signature.
    members = groups.select(F.col("id").alias("node")).distinct()
    one = written(keys.where("doc_id is not null").join(members, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("_rep")), "members")
    # Rows that repeat an id and a text would give a set several times.
    twice = not keys.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    single = lambda d: d.dropDuplicates(["id"]) if twice else d
    sketched = written(single(sketches(_chosen(known, one.select("_rep").distinct()))), "sketches", batch=TEXT_ROWS)
    tried: list[DataFrame] = []
    comp = None
    for r in range(STARS + 1):
        if comp is None:
            g = groups.withColumn("comp", F.col("id"))
        else:
            g = groups.join(comp.withColumnRenamed("id", "_i"), F.col("id") == F.col("_i"), "left").select("sig", "id", "n", "low", F.coalesce("comp", "id").alias("comp"))
        if r < STARS:
            pairs = possible(_star(g, r), sketched)
        else:
            open_ = g.groupBy("sig").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.max("low").alias("_any")).where("_lo < _hi and _any").select(F.col("sig").alias("_sig"))
            left = written(g.join(open_, F.col("sig") == F.col("_sig"), "left_semi"), "open")
            dropped(groups)
            pairs = _rest(left, sketched)
        for before in tried:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        tried.append(pairs)
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        ends = written(one.join(ends, "node", "left_semi").select("_rep").distinct(), "ends")
        sets = written(single(full_sets(_chosen(known, ends))), "sets", batch=TEXT_ROWS)
        links = written(linked(pairs, sets), "links", batch=LINKED_ROWS)
        dropped(sets)
        comp = extended(comp, links)
        dropped(links)
    for t in (left, sketched, one, *tried):
        dropped(t)
    named_by = comp.withColumnRenamed("id", "node")
    named = keys.where("doc_id is not null and node is not null").select("node", "doc_id").join(named_by, "node", "left")
    # Written, so that the join reads shuffles on both sides and a large component can be split among tasks.
    named = written(named.groupBy(F.coalesce("comp", "node").alias("_comp")).agg(F.min("doc_id").alias("_least")), "named")
    of = keys.join(named_by, "node", "left").withColumn("_c", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "node"))).join(named, F.col("_c") == F.col("_comp"), "left")
    return of.select("doc_id", "text_hash", "n_shingles", F.coalesce("_least", "doc_id").alias("component_id"), F.col("_c").alias("component"))
