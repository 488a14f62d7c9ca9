"""Ball-tree clustering, the Merkle manifest and balanced label propagation against brute force, with nulls, ties and repeated rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.llm import ball_tree, merkle, sharding

NAN, INF = float("nan"), float("inf")


def brute_clusters(rows, k, rounds, size, scale, seed):
    """[(id, cluster, distance)] of kept rows, as a sorted list; rows: (id, vector)."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and np.isfinite(x) and abs(float(x)) * scale <= ball_tree.LIMIT for x in v):
            kept.append((i, [int(np.floor(float(x) * scale)) for x in v]))
    name = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    starts = sorted(kept, key=lambda r: (r[0] is None, name(r[0]), r[1]))[:k]
    centroids = [x for _, x in starts]
    away = lambda p, c: sum((a - b) ** 2 for a, b in zip(p, c, strict=True))
    nearest = lambda p: min((away(p, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, p in kept:
            groups[nearest(p)[1]].append(p)
        for n, ps in groups.items():
            centroids[n] = [sum(x) // len(ps) for x in zip(*ps, strict=True)]
    out = [(i, nearest(p)[1], nearest(p)[0], tuple(centroids[nearest(p)[1]])) for i, p in kept]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def clusters(d, **how):
    rows = ball_tree.cluster(d, **how).collect()
    per = Counter()
    for r in rows:
        per[r.cluster] += r.distance
    assert all(r.cluster_inertia == per[r.cluster] and r.inertia == sum(per.values()) for r in rows)
    return sorted(((r.vec_id, r.cluster, r.distance, tuple(r.centroid)) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("spread", [0.02, 3.0, 40_000.0])
def test_clusters(spark, spread):
    """Tight groups, loose ones, and components too large for exact doubles; with what isn't kept, ties and repeated rows."""
    rng = random.Random(int(spread * 100))
    middles = [[rng.uniform(-5, 5) * max(1, spread) for _ in range(6)] for _ in range(9)]
    rows = [(i, [m + rng.gauss(0, spread) for m in middles[i % 9]]) for i in range(700)]
    rows += [(i, rows[0][1]) for i in range(700, 900)]  # one vector many times
    rows += [(1000 + i, [float(rng.randint(-1, 1)) for _ in range(6)]) for i in range(100)]  # many ties
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0] * 5 + [None]), (2004, [1.0] * 5 + [NAN]), (2005, [1.0] * 5 + [INF]), (2006, [1e30] * 6), (2007, [-0.001] * 6)]
    rng.shuffle(rows)
    d = spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, embedding array<double>, cluster string").repartition(3).withColumns({"id": F.lit(1), "x": F.lit(2)})
    assert clusters(d, k=12, rounds=3, size=6) == brute_clusters(rows, 12, 3, 6, 256, 2)


def test_fewer_vectors_than_centroids(spark):
    rows = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (None, [2.0, 2.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert clusters(d, k=40, size=2) == brute_clusters(rows, 40, 5, 2, 256, 2)
    assert ball_tree.cluster(d.limit(0)).count() == 0


def test_separate_groups_are_assigned_as_balls(spark):
    rng = np.random.default_rng(1)
    points = (np.repeat(np.arange(10) * 1000, 200)[:, None] + rng.integers(0, 20, (2000, 8))).astype(np.int32)
    order, spans, child, radius, sums = ball_tree.ball_tree(points)
    assert sorted(order) == list(range(2000)) and (sums[0] == points.sum(0)).all()
    for (lo, hi), r, s in zip(spans, radius, sums, strict=True):
        here = points[order[lo:hi]]
        assert (here.sum(0) == s).all() and np.sqrt((((here - s / (hi - lo)) ** 2).sum(1)).max()) <= r + 1e-9
    centroids = np.repeat(np.arange(10) * 1000 + 10, 8).reshape(10, 8)
    given, places, own = ball_tree.Block(points[order], spans, child, radius, sums).nearest(centroids)
    assert sum(spans[b, 1] - spans[b, 0] for b, _ in given) > 1500
    assert all((points[order][spans[b, 0] : spans[b, 1]] // 1000 == c).all() for b, c in given) and (points[order][places][:, 0] // 1000 == own).all()


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def way(tree, i):
    out = []
    for nodes in tree[:-1]:
        run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
        out.append((i % 8, run[: i % 8] + run[i % 8 + 1 :]))
        i //= 8
    return out


def brute_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, text, lang)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: digest([field(r[0]), field(r[2]), field(text)])
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r, leaf(r, r[1])))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = [levels([x[1] for x in groups[g]]) for g in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(names):
        for i, (r, own) in enumerate(groups[g]):
            steps = way(trees[k], i) + way(top, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            now = leaf(r, r[1].lower()) if tampered else own
            for at, others in steps:
                now = digest(others[:at] + [now] + others[at:])
            out.append((r[0], own, trees[k][-1][0], top[-1][0], digest([x for _, o in steps for x in o]), now, now == top[-1][0]))
    return sorted(out, key=str)


def manifest(d):
    told = lambda text: merkle.digest(F.col("doc_id"), F.col("lang"), text)
    held = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0, told(F.lower("text"))).otherwise(told(F.col("text")))
    return merkle.Manifest(d, told(F.col("text")), also={"held": held})


@pytest.mark.parametrize("sizes", [{"en": 5000, "de": 8, "fr": 9, None: 65, "": 1}, {"en": 1}, {"en": 1, "de": 1}, {f"l{i}": 1 + i % 3 for i in range(70)}])
def test_manifest(spark, sizes):
    """Trees of more levels than a band has, full ones, runs of one, lone leaves; null and empty names and texts; repeated rows."""
    rows = [(i * 7 + n, f"Text {i}", lang) for n, (lang, size) in enumerate(sizes.items()) for i in range(size)]
    if len(rows) > 2:
        rows += [(1, None, "en"), (2, "", "en"), (2, "", "en"), (2, "Other", "en"), (None, "No id", "en"), (None, None, None), (3, "Üß A" * 1000, "de")]
    random.Random(1).shuffle(rows)
    d = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, tree string, i int").repartition(5)
    trees = manifest(d)
    got = trees.verified("held").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_manifest(rows)
    some = trees.proofs().where("key = 7 or key is null").collect()
    assert all(merkle.fold(r.digest, r.steps) == trees.root for r in some) and (some or len(rows) < 8)


def test_empty_manifest(spark):
    trees = manifest(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert trees.root is None and trees.verified("held").count() == 0 and trees.proofs().count() == 0


def test_parents_in_any_order():
    """Children that come in any order and in several tasks give the same tree, whatever is open when a task ends."""
    leaves = [digest([str(i)]) for i in range(700)]
    want = levels(leaves)
    rng = random.Random(2)
    todo = [("t", 700, 1, i // 8, {i % 8: x}) for i, x in enumerate(leaves)]
    found = {}
    while todo:
        rng.shuffle(todo)
        left = []
        for part in (todo[: len(todo) // 2], todo[len(todo) // 2 :]) if len(todo) > 4 else (todo,):
            c = merkle.Combine()
            for event in part:
                c.add(*event)
            for r in c.rows(end=True).itertuples(index=False):
                slots = {s["at"]: s["digest"] for s in r.slots}
                if r.digest is None:
                    left.append((r.tree, r.size, r.level, r.i, slots))
                else:
                    found[r.level, r.i] = r.digest
        todo = left
    assert found == {(level, i): x for level, nodes in enumerate(want) if level for i, x in enumerate(nodes)}


def placed(spark, rows, shards, keys=None):
    d = spark.createDataFrame([(i, x, 0) for i, x in rows], "doc_id long, text string, shard int").withColumns({"key": F.lit("clash"), "keys": F.lit("clash")}).repartition(3)
    out = sharding.shard(d, keys if keys is not None else F.array(F.sha2(F.coalesce("text", F.lit("")), 256)), {"text": F.coalesce("text", F.lit(""))}, shards=shards).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in rows)
    count = Counter(r.shard for r in out)
    assert sorted((count[s] for s in range(shards)), reverse=True) == sorted(sharding.quotas(len(rows), shards), reverse=True)
    for s in range(shards):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(count[s]))
    groups = defaultdict(Counter)
    for r in out:
        groups[r.text][r.shard] += 1
    return list(groups.values())


def test_copies_share_a_shard(spark):
    rows = [(i, f"copy {i // 3}" if i < 300 else f"single {i}") for i in range(800)] + [(None, None), (None, ""), (1, "again"), (1, "again")]
    assert max(len(g) for g in placed(spark, rows, 16)) == 1


def test_no_room_beside_links(spark):
    """All documents are linked, so shards are full at the start: what moves is exchanged."""
    groups = placed(spark, [(i, f"pair {i % 290}") for i in range(580)], 12)
    assert sum(len(g) > 1 for g in groups) < 30


def test_a_group_larger_than_shards(spark):
    """A third of the rows, for shards of 30 rows each: whole in no shard, yet in not many more than it needs."""
    rows = [(i, "hot" if i % 3 == 0 else f"copy {i // 6}" if i < 600 else f"single {i}") for i in range(1200)]
    groups = placed(spark, rows, 40)
    assert max(len(g) for g in groups) <= 20  # of 40; 14 at least
    assert sum(len(g) > 1 for g in groups) <= 3


def test_links_by_several_keys(spark):
    keys = F.array(F.concat(F.lit("a"), (F.col("doc_id") / 2).cast("int")), F.concat(F.lit("b"), ((F.col("doc_id") + 1) / 4).cast("int")))
    d = [(i, f"t{i // 4}" if i < 200 else f"s{i}") for i in range(400)]
    groups = placed(spark, d, 8, F.when(F.col("doc_id") < 200, keys).otherwise(F.array(F.col("text"))))
    assert sum(len(g) for g in groups if sum(g.values()) > 1) < 110  # 50 groups of 4, 2 shards each at most in the mean


def test_few_rows(spark):
    placed(spark, [(1, "a"), (2, "a"), (3, None)], 8)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard(empty, F.array("text"), {}, shards=8).count() == 0


def test_flows_keep_quotas():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(2, 8)
        quota = [rng.randint(5, 30) for _ in range(n)]
        load = [rng.randint(0, q) for q in quota]
        wishes, left = [], list(load)
        for _ in range(rng.randint(0, 60)):
            a, b = rng.sample(range(n), 2)
            if left[a]:
                w = rng.randint(1, left[a])
                left[a] -= w
                wishes.append((a, b, len(wishes), w))
        last = sharding.granted(wishes, load, quota)
        after = list(load)
        for a, b, c, w in wishes:
            if c <= last[a, b]:
                after[a] -= w
                after[b] += w
        assert all(x <= q for x, q in zip(after, quota, strict=True))
