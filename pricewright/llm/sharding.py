"""Sharding by balanced label propagation: linked documents move towards their neighbours' shards, under quotas.

Documents that share a key (equal texts, or any column of keys) are linked. Rows are numbered and dealt to shards in turn, so
shards have the same number of rows to within one at the start, and `quota` of each shard never changes. Documents with the
same keys and the same lane (their number modulo a multiple of the shards) are a vertex of the graph, weighted by their number:
a key with any number of rows has at most `LANES` vertices a shard and set of keys. Keys link vertices as hyperedges: a key's weight in each
shard is one row, and no pair of documents is made.

A round is two joins: vertices with their keys give each key's weight by shard, and these, joined back, each vertex's votes.
A vertex wants the shard with most votes, more than its own (of equal votes a hash of its keys decides, so two that want each
other's shard don't swap). Where a neighbourhood is larger than a shard, it wants one of as many of its best shards as that needs.
Wishes are counted by (from, to, class of gain and hash), a table whose size depends on the shards alone; on it, the driver takes back the
classes of least gain that flow to shards over their quota until none is. So exchanges of equal weight pass even where all shards
are full. A shard that could take little of what wanted it is left out of the next round. Rounds end when nothing moves.

Linked documents in a shard are never more than its quota. The rows without links then fill the shards up to their quotas
exactly: numbered once more, they are cut at the sums of what is left. Each shard's rows are numbered in order of id.

Defined cases: a null text is empty, texts that are empty are equal; null ids come first; rows that repeat an id are rows of their
own; fewer rows than shards leave shards without any. Only the named columns are read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, numbered, written

SHARDS, ROUNDS, LANES = 40, 12, 8
#: Classes of a wish: a gain's power of two, and a hash. Wishes that may be taken at all.
SALT, LEAST_TAKEN = 16, 0.1


def quotas(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def granted(wishes: list[tuple[int, int, int, int]], load: list[int], quota: list[int]) -> dict[tuple[int, int], int]:
    """For (from, to) the last class that may move, from wishes (from, to, class, weight), the best classes first. Classes are
    taken back, the last first, from flows to shards that would be over their quota."""
    flows: dict[int, list] = defaultdict(list)
    after, last = list(load), {}
    held = defaultdict(list)
    for a, b, c, w in sorted(wishes, key=lambda x: x[2]):
        held[a, b].append((c, w))
        after[a] -= w
        after[b] += w
    for (a, b), cs in held.items():
        last[a, b] = cs[-1][0]
        heapq.heappush(flows[b], (-cs[-1][0], a))
    over = [s for s in range(len(quota)) if after[s] > quota[s]]
    while over:
        s = over.pop()
        while after[s] > quota[s]:
            _, a = heapq.heappop(flows[s])
            c, w = held[a, s].pop()
            after[s] -= w
            after[a] += w
            last[a, s] = c - 1 if held[a, s] else -1
            if held[a, s]:
                heapq.heappush(flows[s], (-held[a, s][-1][0], a))
            if after[a] > quota[a] and a not in over:
                over.append(a)
    return last


class Labels:
    """The graph's vertices (`vertices`: v, n, shard) and their keys (`links`: v, key), and the rounds over them."""

    def __init__(self, rows: DataFrame, quota: list[int]):
        """rows: keys (array), lane, shard of the documents."""
        self.quota, self.shards = quota, len(quota)
        every = rows.groupBy("keys", "lane").agg(F.count("*").alias("n"), F.first("shard").alias("shard"))
        every = written(every.withColumn("v", F.struct("keys", "lane")), "vertices")
        one = every.select("v", "n", F.explode("keys").alias("key"))
        shared = written(one.groupBy(F.col("key").alias("_key")).agg(F.sum("n").alias("_n")).where("_n > 1").select("_key"), "shared-keys")
        self.links = written(one.join(shared, F.col("key") == F.col("_key"), "left_semi").select("v", "key"), "links")
        own = self.links.select(F.col("v").alias("_v")).distinct()
        self.vertices = written(every.select("v", "n", "shard").join(own, F.col("v") == F.col("_v"), "left_semi"), "labels")
        dropped(every)
        dropped(shared)
        self.closed: list[int] = []

    def load(self) -> list[int]:
        of = {r.shard: r.n for r in self.vertices.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # a row for each shard
        return [of.get(s, 0) for s in range(self.shards)]

    def wishes(self, turn: int) -> DataFrame:
        """v, n, shard, to, class of the vertices, `to` null for those that stay."""
        here = self.links.join(self.vertices.withColumnRenamed("v", "_v"), F.col("v") == F.col("_v")).drop("_v")
        weight = here.groupBy(F.col("key").alias("_key"), F.col("shard").alias("at")).agg(F.sum("n").alias("w"))
        weight = written(weight.groupBy("_key").agg(F.collect_list(F.struct("at", "w")).alias("weights")), "weights")  # shards at most, in a row
        votes = self.links.join(weight, F.col("key") == F.col("_key")).select("v", F.explode("weights").alias("x")).groupBy("v", "x.at").agg(F.sum("x.w").alias("w"))
        # A hash of the keys and the round orders shards of equal votes; vertices of the same keys have the same.
        tie = F.xxhash64(F.col("v.keys"), F.col("at"), F.lit(turn))
        ranked = votes.groupBy(F.col("v").alias("_v")).agg(F.reverse(F.array_sort(F.collect_list(F.struct("w", tie.alias("tie"), "at")))).alias("votes"))
        d = self.vertices.join(ranked, F.col("v") == F.col("_v")).drop("_v")
        closed = F.array(*map(F.lit, self.closed)).cast("array<int>")
        own = F.filter("votes", lambda x: x.at == F.col("shard"))[0]
        all_ = F.aggregate("votes", F.lit(0).cast("long"), lambda s, x: s + x.w)
        some = F.ceil(all_ / max(1, min(self.quota))).cast("int")
        # A neighbourhood that fits a shard leaves one that takes no more of it; a larger one keeps what it has.
        mine = lambda x: (x.at == F.col("shard")) & ((some > 1) | ~F.array_contains(closed, F.col("shard")))
        best = F.slice(F.filter("votes", lambda x: mine(x) | ~F.array_contains(closed, x.at)), F.lit(1), some)
        mix = F.xxhash64(F.col("v"), F.lit(turn))
        to = F.get(best, F.pmod(mix, F.greatest(F.size(best), F.lit(1)).cast("long")).cast("int"))
        d = d.select("v", "n", "shard", own.alias("own"), F.exists(best, lambda x: x.at == F.col("shard")).alias("stays"), to.alias("to"))
        gain = F.greatest(F.col("to.w") - F.col("own.w") + F.col("n"), F.lit(1))
        kind = (63 - F.floor(F.log2(gain.cast("double")))) * SALT + F.pmod(F.shiftright(mix, 20), F.lit(SALT))
        moves = ~F.col("stays") & F.col("to").isNotNull()
        return d.select("v", "n", "shard", F.when(moves, F.col("to.at")).alias("to"), F.when(moves, kind.cast("int")).alias("kind"))

    def round(self, turn: int) -> int:
        """One round; the weight that moved."""
        wishes = written(self.wishes(turn), "wishes")
        rows = wishes.where("to is not null").groupBy("shard", "to", "kind").agg(F.sum("n").alias("n")).collect()  # bounded by the shards
        if not rows:
            self.closed = []
            dropped(wishes)
            return 0
        last = granted([(r.shard, r.to, r.kind, r.n) for r in rows], self.load(), self.quota)
        into = defaultdict(lambda: [0, 0])
        for r in rows:
            into[r.to][0] += r.n
            into[r.to][1] += r.n * (r.kind <= last[r.shard, r.to])
        self.closed = [s for s, (want, got) in into.items() if got < LEAST_TAKEN * want]
        limit = F.array(*[F.lit(last.get((a, b), -1)) for a in range(self.shards) for b in range(self.shards)])
        passes = F.col("kind") <= F.get(limit, F.col("shard") * self.shards + F.col("to"))
        before, self.vertices = self.vertices, written(wishes.select("v", "n", F.when(passes, F.col("to")).otherwise(F.col("shard")).alias("shard")), "labels")
        dropped(before)
        dropped(wishes)
        return sum(got for _, got in into.values())


def shard(docs: DataFrame, keys: Column, columns: dict[str, Column], id_column: str = "doc_id", shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """id, `columns`, shard, slot (place in the shard, from 0) of every row; rows that share one of their `keys` (an array) are
    linked. Each shard has the same number of rows to within one."""
    rows = written(docs.select(F.col(id_column).alias("key"), keys.alias("keys"), *[c.alias(f"c_{k}") for k, c in columns.items()]), "rows")
    every = numbered(rows, ["key", "keys"], [], "number", "rows-in-order")
    quota = quotas(every.count(), shards)
    every = every.withColumns({"shard": F.pmod("number", F.lit(shards)).cast("int"), "lane": F.pmod("number", F.lit(shards * LANES)).cast("int")})
    labels = Labels(every.select("keys", "lane", "shard"), quota)
    idle = 0
    for turn in range(rounds):
        # A round in which nothing moves is followed by one in which no shard is left out.
        idle = idle + 1 if labels.round(turn) == 0 else 0
        if idle == 2 or (idle and not labels.closed):
            break
    label = labels.vertices.select(F.col("v").alias("_v"), F.col("shard").alias("_shard"))
    placed = written(every.drop("shard").join(label, F.struct("keys", "lane") == F.col("_v"), "left").drop("_v", "lane"), "placed")
    linked = placed.where("_shard is not null").drop("number").withColumnRenamed("_shard", "shard")
    free = [q - n for q, n in zip(quota, labels.load(), strict=True)]
    single = numbered(placed.where("_shard is null").drop("_shard", "number"), ["key", "keys"], [], "free", "rows-without-links")
    ends = F.array(*[F.lit(sum(free[: s + 1])) for s in range(shards)])
    single = single.withColumn("shard", F.size(F.filter(ends, lambda e: e <= F.col("free")))).drop("free")
    out = numbered(linked.unionByName(single), ["key", "keys"], ["shard"], "slot", "shards")
    for t in (rows, every, placed):
        dropped(t)
    return out.select(F.col("key").alias(id_column), *[F.col(f"c_{k}").alias(k) for k in columns], "shard", "slot")


def cut(placed: DataFrame, key: str) -> DataFrame:
    """key, n, shards, least, inside, all: of each key with several rows, how many shards it lies in, how many it needs, and how
    many of its pairs of rows share a shard."""
    per = placed.groupBy(key, "shard").agg(F.count("*").alias("n"))
    size = placed.groupBy("shard").count().agg(F.max("count")).first()[0] or 1
    pairs = lambda n: n * (n - 1) / 2
    d = per.groupBy(key).agg(F.sum("n").alias("n"), F.count("*").alias("shards"), F.sum(pairs(F.col("n"))).alias("inside"))
    return d.where("n > 1").select(key, "n", "shards", F.ceil(F.col("n") / size).alias("least"), "inside", pairs(F.col("n")).alias("all"))
