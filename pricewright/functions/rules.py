"""Compiled word rules: many aliases of many labels, looked up in one pass over a text's words.

A text is cut once into runs of letters and digits and what stands between them. An alias is the same kind of sequence, so
it stands in the text, with no letter or digit beside it, exactly if its runs are runs of the text in a row. All runs, and all sequences
as long as the longest alias, are looked up together in a table of aliases; how many aliases there are makes no more passes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

RUN = "[a-z0-9]+|[^a-z0-9]+"


def _piece(runs: Column, size: int) -> Callable[[Column, Column], Column]:
    """The text of `size` runs from a place on."""
    return lambda _, i: F.array_join(F.slice(runs, i + 1, F.lit(size)), "")


class Aliases:
    """label -> the names it goes by, in lower case; a name begins and ends with a letter or digit."""

    def __init__(self, names: dict[str, Iterable[str]]):
        self.label = {a: label for label, ns in names.items() for a in ns}
        sizes: dict[int, list[str]] = {}
        for a in self.label:
            runs = re.findall(RUN, a)
            if len(runs) % 2 == 0 or not re.match("[a-z0-9]", a):
                raise ValueError(f"not an alias: {a!r}")
            sizes.setdefault(len(runs), []).append(a)
        #: Aliases by their number of runs.
        self.sizes = dict(sorted(sizes.items()))

    def found(self, text: Column) -> Column:
        """The labels whose aliases stand in `text` (as normalize_text writes it), sorted, each once; empty for null."""
        runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RUN), F.lit(0))

        def of(runs: Column) -> Column:
            hits = []
            for size, aliases in self.sizes.items():
                pieces = runs if size == 1 else F.transform(runs, _piece(runs, size))
                hits.append(F.array_intersect(pieces, F.array(*map(F.lit, aliases))))
            table = F.create_map(*[F.lit(x) for kv in self.label.items() for x in kv])
            return F.array_sort(F.array_distinct(F.transform(F.concat(*hits), lambda a: F.try_element_at(table, a))))

        return F.get(F.transform(F.array(runs), of), F.lit(0))
