"""Merkle manifest: a tree of digests for each group of documents, one tree over the groups, proofs, and their verification.

A leaf is the sha256 of a document's fields (`digest`). Within a group (a language) leaves stand in order of id; while several
nodes remain, every ARITY consecutive ones become their parent, the sha256 of their digests' hexadecimal text, and the last
run may be shorter. What remains is the group's subroot; subroots in order of group, null first, likewise give the root.

Upwards, nodes are events of a combine by parent: a partial parent holds the digests of those children that have come, each
with its place. How many it waits for follows from the group's size alone, so no level waits for another: a parent whose last
child comes becomes an event for its own parent at once. Leaves come in ranges of their order, so nearly every parent is complete
within a task, which holds the few parents that are open. What is left open at the end of a task, two ends a level, is
shuffled by the ancestor `BAND` levels up and combined again, until all are complete; these are few rows a task, not levels of the
tree.

Downwards, a complete parent is the link of its children to what a proof needs of it: the digests of its other children. Links
are joined by ancestor, `BAND` levels at a time from the root, and a group of a join has at most ARITY ** BAND nodes,
however large the language. A proof is a list of steps from the leaf up, each with the place of the node among the run's others.

Defined cases: a null field counts as "-"; null ids come first, equal ids stand in order of their leaf's digest, and rows that are equal
are leaves of their own with proofs of their own; a null group is a group. A leaf that is alone is its group's subroot, and a
subroot that is alone the root: their proofs are shorter or empty, and an empty proof's digest is that of no bytes. No rows: no
leaves and no root. Only the named columns are read, whatever others are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, numbered, written

ARITY, BAND = 8, 4
SLOT = "array<struct<at: int, digest: string>>"
LINK = f"tree string, size long, level int, i long, slots {SLOT}, digest string"
STEPS = "array<struct<at: int, others: array<string>>>"
#: Names of the tree over all groups and of the null group's; those of others start with "+", which stands after both.
ALL, NULL = "", "!"


def field(c: Column) -> Column:
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def parent_digest(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def nodes_at(size: int, level: int) -> int:
    for _ in range(level):
        size = -(-size // ARITY)
    return size


class Combine:
    """Open parents of a task by (tree, level, number), with the digests of the children that have come."""

    def __init__(self):
        self.open: dict[tuple[str, int, int], tuple[int, dict[int, str]]] = {}
        self.done: list[tuple] = []

    def add(self, tree: str, size: int, level: int, i: int, slots: dict[int, str]) -> None:
        """Children of the parent i of a level; whatever becomes complete by them becomes a child in turn."""
        while True:
            held = self.open.setdefault((tree, level, i), (size, {}))[1]
            held.update(slots)
            below = nodes_at(size, level - 1)
            if len(held) < min(ARITY, below - ARITY * i):
                return
            del self.open[tree, level, i]
            places = sorted(held)
            own = parent_digest([held[k] for k in places])
            self.done.append((tree, size, level, i, [{"at": k, "digest": held[k]} for k in places], own))
            if below <= ARITY:
                return  # the top of its tree
            level, i, slots = level + 1, i // ARITY, {i % ARITY: own}

    def rows(self, end: bool = False) -> pd.DataFrame:
        """The complete parents so far; at the end, those that are open as well, without a digest."""
        out, self.done = self.done, []
        if end:
            out += [(*key[:1], size, *key[1:], [{"at": k, "digest": v} for k, v in sorted(held.items())], None) for key, (size, held) in self.open.items()]
        return pd.DataFrame(out, columns=["tree", "size", "level", "i", "slots", "digest"])


def _first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """tree, size, i, digest: leaves in order."""
    c = Combine()
    for b in batches:
        for tree, size, i, leaf in zip(b["tree"], b["size"].tolist(), b["i"].tolist(), b["digest"], strict=True):
            c.add(tree, size, 1, i // ARITY, {i % ARITY: leaf})
        yield c.rows()
    yield c.rows(end=True)


def _again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial parents."""
    c = Combine()
    for b in batches:
        for tree, size, level, i, slots in zip(b["tree"], b["size"].tolist(), b["level"].tolist(), b["i"].tolist(), b["slots"], strict=True):
            c.add(tree, size, level, i, {s["at"]: s["digest"] for s in slots})
        yield c.rows()
    yield c.rows(end=True)


def _ancestor(level: Column, i: Column) -> Column:
    """The number of a node's ancestor at the highest level of the node's band; levels 1 to BAND are the first."""
    return F.floor(i / F.pow(F.lit(float(ARITY)), BAND - 1 - F.pmod(level - 1, F.lit(BAND)))).cast("long")


def height(size: Column) -> Column:
    """The level of the topmost node of a tree."""
    return sum(((size > ARITY**k).cast("int") for k in range(1, 21)), (size > 1).cast("int"))


def links(leaves: DataFrame) -> DataFrame:
    """Every parent of the trees of `leaves` (tree, size of the tree, i, digest), with its children's digests in order."""
    tables, todo = [], written(leaves.where("size > 1").select("tree", "size", "i", "digest").mapInPandas(_first, LINK), "links")
    while True:
        tables.append(todo)
        left = todo.where("digest is null")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, [t.where("digest is not null") for t in tables])
        todo = written(left.repartition("tree", _ancestor(F.col("level"), F.col("i"))).mapInPandas(_again, LINK), "links")


def _tops(leaves: DataFrame, parents: DataFrame) -> DataFrame:
    """tree, size, digest: the topmost node of each tree."""
    top = parents.where(F.col("level") == height(F.col("size")))
    return top.select("tree", "size", "digest").unionByName(leaves.where("size = 1").select("tree", "size", "digest"))


def _down(held: dict[tuple[int, int], list], foot: int, top: tuple[int, int], above: list) -> Iterator[tuple[int, list]]:
    """(number, steps from there up) of every node of the level `foot` under `top`, whose own steps are `above`. `held`: the children
    of the parents between."""
    now = {top[1]: above}
    for level in range(top[0], foot, -1):
        below = {}
        for i, path in now.items():
            slots = held[level, i]
            for s in slots:
                below[ARITY * i + s["at"]] = [{"at": s["at"], "others": [x["digest"] for x in slots if x["at"] != s["at"]]}, *path]
        now = below
    yield from now.items()


def _block(parents: DataFrame, starts: DataFrame, band: int) -> DataFrame:
    """Parents of a band and the nodes that it starts from, by tree and block: one table, whose rows have slots or steps."""
    low, high = band * BAND + 1, (band + 1) * BAND
    rows = parents.where(f"level between {low} and {high}").select("tree", _ancestor(F.col("level"), F.col("i")).alias("block"), "level", "i", "slots", F.lit(None).cast(STEPS).alias("steps"), F.lit(None).cast("string").alias("top"))
    at = F.when(F.col("level") == high, F.col("i")).otherwise(F.lit(0).cast("long"))
    return rows.unionByName(starts.select("tree", at.alias("block"), "level", "i", F.lit(None).cast(SLOT).alias("slots"), "steps", "top"))


def _opened(block: pd.DataFrame, foot: int) -> tuple[Iterator[tuple[int, list]], str]:
    """The nodes of a block's foot with their steps; the digest of the tree's top."""
    held, start = {}, None
    for level, i, slots, steps, top in zip(block["level"].tolist(), block["i"].tolist(), block["slots"], block["steps"], block["top"], strict=True):
        if slots is None:
            start = ((level, i), list(steps), top)
        else:
            held[level, i] = slots
    return _down(held, foot, *start[:2]), start[2]


def _to_foot(level: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        nodes, top = _opened(block, level)
        return pd.DataFrame([(key[0], level, i, steps, top) for i, steps in nodes], columns=["tree", "level", "i", "steps", "top"])

    return run


def _paths(parents: DataFrame, tops: DataFrame) -> DataFrame:
    """tree, level, i, steps, top: the way to the root from where the first band's blocks start, that is a node of level BAND or the
    top of a lower tree. `tops`: tree, size, digest, steps of the trees' topmost nodes."""
    tops = written(tops.select("tree", height(F.col("size")).alias("level"), F.lit(0).cast("long").alias("i"), "steps", F.col("digest").alias("top")), "tops")
    foot, highest = None, parents.agg(F.max("level")).first()[0] or 0
    for band in range((highest - 1) // BAND, 0, -1):
        starts = tops.where(f"level between {band * BAND + 1} and {(band + 1) * BAND}")
        starts = starts.unionByName(foot) if foot is not None else starts
        foot = written(_block(parents, starts, band).groupBy("tree", "block").applyInPandas(_to_foot(band * BAND), f"tree string, level int, i long, steps {STEPS}, top string"), "paths")
    low = tops.where(f"level <= {BAND}")
    return low.unionByName(foot) if foot is not None else low


def fold(leaf: str, steps: list[dict]) -> str:
    """The root that a leaf's digest and its proof give."""
    for s in steps:
        others = list(s["others"])
        leaf = parent_digest([*others[: s["at"]], leaf, *others[s["at"] :]])
    return leaf


def proof_digest(steps: list[dict]) -> str:
    """The digest of a proof's digests, from the leaf up and from left to right."""
    return parent_digest([x for s in steps for x in s["others"]])


Told = Callable[[list[dict], str, str | None], tuple]


def _proofs(leaves: DataFrame, parents: DataFrame, tops: DataFrame, columns: list[str], kinds: dict[str, str], told: Told) -> DataFrame:
    """`columns` of the leaves (text), and what `told` makes of a leaf's steps, its tree's topmost digest and the last of the columns."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        nodes, top = _opened(right, 0)
        way = dict(nodes)
        out = [(*row[1:], *told(way[row[0]], top, row[-1])) for row in left[["i", *columns]].itertuples(index=False, name=None)]
        return pd.DataFrame(out, columns=[*columns, *kinds])

    block = F.floor(F.col("i") / ARITY**BAND).cast("long")
    rows = leaves.select(F.col("tree").alias("_tree"), block.alias("block"), "i", *[F.col(c).cast("string").alias(c) for c in columns])
    both = rows.groupBy("_tree", "block").cogroup(_block(parents, _paths(parents, tops), 0).groupBy("tree", "block"))
    return written(both.applyInPandas(run, ", ".join([f"{c} string" for c in columns] + [f"{k} {v}" for k, v in kinds.items()])), "proofs")


class Manifest:
    """The trees of a table. `leaves`: key, tree, size, i, digest, and the columns asked for; `parents`: the links of all groups'
    trees; `subroots`: tree, size, digest; `root`: a digest, or None of an empty table."""

    def __init__(self, docs: DataFrame, leaf: Column, group: str = "lang", id_column: str = "doc_id", also: dict[str, Column] | None = None):
        self.kind = docs.select(id_column).schema[0].dataType
        name = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(NULL))
        rows = written(docs.select(F.col(id_column).alias("key"), name.alias("tree"), leaf.alias("digest"), *[c.alias(k) for k, c in (also or {}).items()]), "leaves")
        self.leaves = numbered(rows, ["key", "digest"], ["tree"], "i", "leaves-in-order", also="size")
        dropped(rows)
        self.parents = links(self.leaves)
        self.subroots = written(_tops(self.leaves, self.parents), "subroots")
        groups = numbered(self.subroots.select(F.col("tree").alias("group"), "digest"), ["group"], [], "i", "subroots-in-order", also="size")
        self.groups = groups.withColumn("tree", F.lit(ALL))
        self.above = links(self.groups)
        self.top = _tops(self.groups, self.above)
        self.root = next((r.digest for r in self.top.collect()), None)  # one row

    def _over(self) -> DataFrame:
        """The trees' topmost nodes with their steps to the root."""
        tops = self.top.withColumn("steps", F.array().cast(STEPS))
        over = _proofs(self.groups, self.above, tops, ["group"], {"steps": STEPS}, lambda steps, top, _: (steps,))
        return self.subroots.join(over, F.col("tree") == F.col("group")).drop("group")

    def proofs(self) -> DataFrame:
        """key, digest, subroot, steps of every leaf: about ARITY digests for each level."""
        d = _proofs(self.leaves, self.parents, self._over(), ["key", "digest"], {"subroot": "string", "steps": STEPS}, lambda steps, top, _: (top, steps))
        return d.withColumn("key", F.col("key").cast(self.kind))

    def verified(self, held: str) -> DataFrame:
        """key, digest, subroot, root, proof_sha256, folded_root, verified of every leaf, whose present digest is in the column `held`."""
        kinds = {k: "string" for k in ("subroot", "proof_sha256", "folded_root")}
        d = _proofs(self.leaves, self.parents, self._over(), ["key", "digest", held], kinds, lambda steps, top, now: (top, proof_digest(steps), fold(now, steps)))
        return d.select(F.col("key").cast(self.kind).alias("key"), "digest", "subroot", F.lit(self.root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(self.root)).alias("verified"))
