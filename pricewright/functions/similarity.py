"""Similarity of two texts as a column: twice the letters in matching blocks, by the length of both.

Matching blocks are those of Ratcliff and Obershelp: the longest common piece, of equal ones the first in the left text, then
in the right one, and then the same on what is left of it and on what is right of it. No letters are set aside as too common, at
any length. The recursion is a stack that a fold works off; the longest piece is a fold that grows it where it can and
else moves on, since a longer one must hold a piece of the length that was last found plus one.

The letters that both texts have, each as often as in the text that has fewer, are a bound that is never under the
similarity and costs much less: `bound`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _longest(a: Column, b: Column) -> Column:
    """struct(at, n): the first longest piece of a that stands in b; n is 0 if they share no letter."""
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("n"), F.lit(0).alias("at"))

    def step(s: Column, _: Column) -> Column:
        longer = a.substr(s["i"] + 1, s["n"] + 1)
        grows = (s["i"] + s["n"] < F.length(a)) & (F.instr(b, longer) > 0)
        return F.when(grows, F.struct(s["i"].alias("i"), (s["n"] + 1).alias("n"), s["i"].alias("at"))).otherwise(F.struct((s["i"] + 1).alias("i"), s["n"].alias("n"), s["at"].alias("at")))

    return F.aggregate(F.sequence(F.lit(1), 2 * F.length(a)), start, step)


def _blocks(a: Column, b: Column) -> Column:
    """How many letters are in matching blocks; neither text is empty."""
    pair = lambda x, y: F.struct(x.alias("a"), y.alias("b"))
    start = F.struct(F.array(pair(a, b)).alias("todo"), F.lit(0).alias("n"))

    def rest(top: Column, todo: Column, n: Column) -> Column:
        def told(m: Column) -> Column:
            at, size = m["at"], m["n"]
            j = F.instr(top["b"], top["a"].substr(at + 1, size))
            end = F.lit(1 << 30)
            left = pair(top["a"].substr(F.lit(1), at), top["b"].substr(F.lit(1), j - 1))
            right = pair(top["a"].substr(at + size + 1, end), top["b"].substr(j + size, end))
            more = F.filter(F.array(left, right), lambda p: (p["a"] != "") & (p["b"] != ""))
            return F.struct(F.when(size > 0, F.concat(todo, more)).otherwise(todo).alias("todo"), (n + size).alias("n"))

        return _let(_longest(top["a"], top["b"]), told)

    def step(s: Column, _: Column) -> Column:
        left = F.size(s["todo"])
        return F.when(left == 0, s).otherwise(rest(F.element_at(s["todo"], F.greatest(left, F.lit(1))), F.slice(s["todo"], F.lit(1), F.greatest(left - 1, F.lit(0))), s["n"]))

    return F.aggregate(F.sequence(F.lit(1), 2 * F.least(F.length(a), F.length(b)) + 1), start, step, lambda s: s["n"])


def ratio(a: Column, b: Column) -> Column:
    """0 to 1; 1 for two empty texts, null if one is null."""
    both = F.length(a) + F.length(b)
    n = F.when(a == b, F.length(a)).when((a == "") | (b == ""), 0).otherwise(_blocks(a, b))
    return F.when(both == 0, 1.0).when(both > 0, 2.0 * n / both)


def bound(a: Column, b: Column) -> Column:
    """At least ratio(a, b)."""
    count = lambda t, c: F.length(t) - F.length(F.replace(t, c, F.lit("")))
    letters = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(a)), lambda i: a.substr(i, F.lit(1))))
    n = F.when((a == "") | (b == ""), 0).otherwise(F.aggregate(letters, F.lit(0), lambda s, c: s + F.least(count(a, c), count(b, c))))
    both = F.length(a) + F.length(b)
    return F.when(both == 0, 1.0).when(both > 0, 2.0 * n / both)
