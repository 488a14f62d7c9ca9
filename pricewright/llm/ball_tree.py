"""Centroid clustering by ball-tree filtering: exact rounds of nearest-centroid assignment over trees that are local to a block.

Vectors become integers once, and each block of them a metric tree, written as one row: the points in the tree's order,
and for each ball where its points lie, its count, integer sum and radius. A round sends the centroids, k rows whatever the
number of vectors, to every block. Down a tree, a centroid stays a candidate of a ball if the triangle inequality lets
it be nearest to some point of the ball: its distance from the ball's middle less the radius must not be over the least
distance plus the radius. A ball with one candidate is given to it whole, by its count and sum; a leaf with several is
descended into, and its points' squared distances are compared as integers. Bounds allow for rounding, so a ball is never
given to a centroid that isn't the nearest of all its points, and ties go to the smaller number at the points.

A task sends one row for each centroid and component on, so a round shuffles nothing that grows with the vectors but the
number of tasks. Equal vectors, however many, make balls of radius 0.

Defined cases: a vector that is null, has another number of components, or one that is null, not finite or so large that its
integer is beyond `LIMIT` (squared distances would not fit a long) isn't kept and has no row. A null id is carried; its
vector starts no centroid unless there are too few others. Equal ids are ordered by components as starts, and each row is
assigned by itself. With fewer vectors than centroids every vector is a start. No vectors: no rows. Sums of distances over a
long are null. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH, configured, dropped, written

#: Vectors of a block, points of a leaf, blocks that go to Python at once, the largest component.
BLOCK, LEAF, BLOCKS, LIMIT = 2048, 24, 16, 1 << 27
#: Components under which all terms of a squared distance are whole numbers that a double holds exactly.
EXACT = 1 << 22
LONG = (1 << 63) - 1


def ball_tree(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """order of the points, and of each ball: its first and its end in that order, its first child (the second follows; -1: none),
    its radius, its sum. Balls stand level by level."""
    order = np.arange(len(points))
    spans, child, radius, sums = [(0, len(points))], [], [], []
    i = 0
    while i < len(spans):
        lo, hi = spans[i]
        here = points[order[lo:hi]].astype(np.int64)
        total = here.sum(0)
        apart = here - total / (hi - lo)
        far = np.einsum("ij,ij->i", apart, apart)
        r = float(np.sqrt(far.max()))
        if hi - lo <= leaf or r == 0 or (here == here[0]).all():
            child.append(-1)
        else:
            a = apart[far.argmax()]
            away = apart - a
            b = apart[np.einsum("ij,ij->i", away, away).argmax()]
            half = (hi - lo) // 2
            order[lo:hi] = order[lo:hi][np.argpartition(apart @ (a - b), half)]
            child.append(len(spans))
            spans += [(lo, lo + half), (lo + half, hi)]
        radius.append(r)
        sums.append(total)
        i += 1
    return order, np.array(spans, np.int64), np.array(child, np.int64), np.array(radius), np.array(sums, np.int64)


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of integer points to integer centroids, exactly."""
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) < EXACT:
        p, c = points.astype(np.float64), centroids.astype(np.float64)
        return (np.einsum("ij,ij->i", p, p)[:, None] - 2 * (p @ c.T) + np.einsum("ij,ij->i", c, c)).astype(np.int64)
    p = points.astype(np.int64)
    return np.stack([((p - c) ** 2).sum(1) for c in centroids], 1)


class Block:
    """A block's points and tree, as one row of a table holds them."""

    SCHEMA = "ids array<{}>, points binary, spans array<long>, child array<long>, radius array<double>, sums array<long>"

    def __init__(self, points: np.ndarray, spans: np.ndarray, child: np.ndarray, radius: np.ndarray, sums: np.ndarray):
        self.points, self.spans, self.child, self.radius, self.sums = points, spans, child, radius, sums

    @classmethod
    def read(cls, batch: pa.RecordBatch, i: int, size: int) -> Block:
        at = lambda name: batch.column(name)[i].values.to_numpy(zero_copy_only=False)
        points = np.frombuffer(batch.column("points")[i].as_py(), np.int32).reshape(-1, size)
        return cls(points, at("spans").reshape(-1, 2), at("child"), at("radius"), at("sums").reshape(-1, size))

    def nearest(self, centroids: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
        """(ball, centroid) of balls that one centroid has whole; the places and the centroids of the other points."""
        c = centroids.astype(np.float64)
        c2 = np.einsum("ij,ij->i", c, c)
        balls, may = np.zeros(1, np.int64), np.ones((1, len(c)), bool)
        given, leaves, seen = [], [], np.zeros(len(c), bool)
        while len(balls):
            m = self.sums[balls] / (self.spans[balls, 1] - self.spans[balls, 0])[:, None]
            m2 = np.einsum("ij,ij->i", m, m)[:, None]
            d2, slack = m2 - 2 * (m @ c.T) + c2, 1e-12 * (m2 + c2) + 1e-9
            r = self.radius[balls][:, None] * (1 + 1e-9) + 1e-9
            least = np.where(may, np.sqrt(np.maximum(d2 + slack, 0)) + r, np.inf).min(1)
            may &= np.sqrt(np.maximum(d2 - slack, 0)) - r <= least[:, None]
            one = may.sum(1) == 1
            given += zip(balls[one].tolist(), may[one].argmax(1).tolist(), strict=True)
            child = self.child[balls]
            end = ~one & (child < 0)
            leaves += balls[end].tolist()
            seen |= may[end].any(0)
            down = ~one & (child >= 0)
            balls, may = np.concatenate([child[down], child[down] + 1]), np.concatenate([may[down], may[down]])
        if not leaves:
            return given, np.zeros(0, np.int64), np.zeros(0, np.int64)
        places = np.concatenate([np.arange(*self.spans[b]) for b in leaves])
        some = np.flatnonzero(seen)
        return given, places, some[squared(self.points[places], centroids[some]).argmin(1)]


def _blocks(vectors: DataFrame, kind: str, size: int) -> DataFrame:
    """Vectors id, x as blocks with trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK:
                rows = pa.Table.from_batches(held)
                while rows.num_rows >= BLOCK:
                    yield block(rows.slice(0, BLOCK))
                    rows = rows.slice(BLOCK)
                held, n = rows.to_batches(), rows.num_rows
        if n:
            yield block(pa.Table.from_batches(held))

    def block(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        points = rows.column("x").combine_chunks().flatten().to_numpy().astype(np.int32).reshape(-1, size)
        order, spans, child, radius, sums = ball_tree(points)
        ids = rows.column("id").take(pa.array(order)).combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        told = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([points[order].tobytes()], pa.binary())]
        told += [pa.array([x.ravel()]) for x in (spans, child, radius, sums)]
        return pa.RecordBatch.from_arrays(told, names=["ids", "points", "spans", "child", "radius", "sums"])

    return vectors.mapInArrow(run, Block.SCHEMA.format(kind))


def _moved(blocks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, int, int]:
    """The next centroids; how many vectors came in whole balls, and how many were compared one by one."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count, whole, single = np.zeros((k, size), np.int64), np.zeros(k, np.int64), 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                b = Block.read(batch, i, size)
                given, places, own = b.nearest(centroids)
                for ball, c in given:
                    n = int(b.spans[ball, 1] - b.spans[ball, 0])
                    sums[c] += b.sums[ball]
                    count[c] += n
                    whole += n
                np.add.at(sums, own, b.points[places].astype(np.int64))
                count += np.bincount(own, minlength=k)
                single += len(places)
        told = np.concatenate([sums.ravel(), count, [whole, single]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(told))), pa.array(told)], names=["i", "v"])

    with configured(blocks.sparkSession, **{BATCH: str(BLOCKS)}):
        # Sums of a task fit a long; those of all may not.
        got = {r.i: int(r.v) for r in blocks.mapInArrow(run, "i long, v long").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    new = centroids.copy()
    for c in range(k):
        n = got[k * size + c]
        if n:
            new[c] = [got[c * size + j] // n for j in range(size)]
    return new, got[k * size + k], got[k * size + k + 1]


def _assigned(blocks: DataFrame, centroids: np.ndarray, kind: str) -> DataFrame:
    """id, cluster, distance of every vector."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = Block.read(batch, i, size)
                given, places, own = b.nearest(centroids)
                cluster = np.empty(len(b.points), np.int32)
                for ball, c in given:
                    cluster[b.spans[ball, 0] : b.spans[ball, 1]] = c
                cluster[places] = own
                distance = ((b.points.astype(np.int64) - centroids[cluster]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, pa.array(cluster), pa.array(distance)], names=["id", "cluster", "distance"])

    return written(blocks.mapInArrow(run, f"id {kind}, cluster int, distance long"), "assigned", batch=BLOCKS)


def integers(vector: Column, size: int, scale: int) -> Column:
    """The vector as whole numbers; null if it isn't kept."""
    fits = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) * scale <= LIMIT, F.lit(False)))
    return F.when((F.size(vector) == size) & fits, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int")))


def cluster(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """id, cluster, distance (squared, to its centroid), cluster_inertia and inertia (distances summed), centroid (its
    components), for each kept vector. Starts are the k vectors with the least sha256 of seed:id."""
    spark, kind = vectors.sparkSession, vectors.select(id_column).schema[0].dataType.simpleString()
    kept = vectors.select(F.col(id_column).alias("id"), integers(F.col(vector_column), size, scale).alias("x")).where("x is not null")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = kept.orderBy(key.asc_nulls_last(), "x").limit(k).select("x").collect()  # k rows
    schema = f"`{id_column}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not starts:
        return spark.createDataFrame([], schema)
    centroids = np.array([r.x for r in starts], np.int64)
    blocks = written(_blocks(kept, kind, size), "balls")
    for _ in range(rounds):
        centroids, _, _ = _moved(blocks, centroids)
    rows = _assigned(blocks, centroids, kind)
    dropped(blocks)
    inertia = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # a row for each centroid
    told = lambda n: n if n <= LONG else None
    of = spark.createDataFrame([(c, told(s), told(sum(inertia.values())), centroids[c].tolist()) for c, s in inertia.items()], "_c int, cluster_inertia long, inertia long, centroid array<long>")
    return rows.join(F.broadcast(of), F.col("cluster") == F.col("_c")).select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def centroid_sha256(centroid: Column) -> Column:
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ","), 256)
