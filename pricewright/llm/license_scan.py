"""Licence scan by a positional rare-token index, in DataFrame functions only.

Words are maximal runs of [0-9a-z] and non-ASCII characters of the lower-cased text. The templates below form a
small index: word -> (template, position). Words are weighed by IDF over all files. A file is looked at for the
templates whose mandatory key phrases all occur in it: of such a template's words that the file has, the ANCHORS of highest IDF are
looked up, and each of their places says where the template would start (place minus position). The postings of
the template's other words are intersected at those starts only, by what stands at the right relative position; a start scores the IDF
share of the words that do, and yields the template's label if it reaches MIN_SCORE. Base phrases are labelled wherever
their words stand consecutively. All of this is within a file's row; the only aggregate counts files by template word.

Defined cases: a null or empty text has no words, no places, null first and last word, empty labels and score 0;
repeated rows get equal results, one for each row; ids may be null or repeated; an empty table gives no rows; other
columns are passed through by scan(docs, *names), whatever their names: one that is called like a column of the result
is called doc_<name> there.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, text_or_empty, written

LICENCE_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Phrase -> label.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label, mandatory key phrases, wording of the notice (public licence texts).
TEMPLATES = [
    ("apache-2.0", ["apache license"], "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", ["redistribution and use"], "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-4.0", ["cc by 4 0"], "licensed under cc by 4 0"),
    ("cc-by-nc", ["cc by nc"], "licensed under cc by nc 4 0"),
    ("cc-by-sa", ["cc by sa"], "licensed under cc by sa 4 0"),
    ("gpl-3.0", ["general public license", "version 3"], "this work is licensed under the gnu general public license version 3"),
    ("isc", ["hereby granted"], "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", ["permission is hereby granted"], "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", ["mozilla public license"], "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", ["public domain"], "this is free and unencumbered software released into the public domain"),
]
#: Words too common to start a look-up.
COMMON = set("0 2 3 4 a and any by except for form forms in into is may met not of or provided that the this to under use v with without you".split())
ANCHORS, MIN_SCORE = 4, 0.6
STARTS = "array<struct<label:string,start:bigint,score:double>>"


def _consecutive(phrase: str) -> Column:
    """Starts of a phrase in _w; the spaced text rules most files out before words are walked."""
    parts = phrase.split(" ")
    places = F.filter(F.sequence(F.lit(0), F.size("_w") - len(parts)), lambda i: reduce(and_, [F.get("_w", i + j) == F.lit(p) for j, p in enumerate(parts)]))
    return F.when((F.size("_w") >= len(parts)) & F.contains("_j", F.lit(f" {phrase} ")), places).otherwise(F.array().cast("array<int>"))


def _found(label: str, phrases: list[str], wording: str, idf: dict[str, float]) -> Column:
    """Array of struct label, start, score of one template's places in a file (_w, _v, _phrases)."""
    words = [(w, q) for q, w in enumerate(wording.split(" ")) if w not in COMMON]
    all_ = sum(idf[w] for w, _ in words)
    postings = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(q).alias("q"), F.lit(idf[w]).alias("idf")) for w, q in words])
    rarest = F.array(*[F.lit(w) for w in sorted({w for w, _ in words}, key=lambda w: (-idf[w], w))])
    looked_up = F.slice(F.array_intersect(rarest, F.col("_v")), 1, ANCHORS)
    places = F.filter(F.transform("_w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: F.array_contains(looked_up, x.w))
    starts = F.array_distinct(F.flatten(F.transform(places, lambda x: F.transform(F.filter(postings, lambda p: p.w == x.w), lambda p: x.i - p.q))))

    def scored(s: Column) -> Column:
        there = F.aggregate(postings, F.lit(0.0), lambda acc, p: acc + F.when(F.get("_w", s + p.q) == p.w, p.idf).otherwise(0.0))
        return F.struct(F.lit(label).alias("label"), s.cast("long").alias("start"), F.least(F.lit(1.0), there / F.lit(all_)).alias("score"))

    good = F.filter(F.transform(starts, scored), lambda x: x.score >= MIN_SCORE)
    allowed = F.size(F.array_except(F.array(*[F.lit(p) for p in phrases]), "_phrases")) == 0
    return F.when(F.col("_w").isNotNull() & allowed, F.transform(good, lambda x: F.struct(x.label.alias("label"), x.start.alias("start"), F.round(x.score, 6).alias("score")))).otherwise(F.array().cast(STARTS))


def scan(docs: DataFrame, *keep: str, templates: list = TEMPLATES) -> DataFrame:
    """`keep` and n_words, n_base, first_word, last_word, base_labels, labels, score, starts (array of struct label,
    start, score: where each found template would begin)."""
    vocabulary = sorted({w for _, _, wording in templates for w in wording.split(" ")} - COMMON)
    needed = sorted({p for _, phrases, _ in templates for p in phrases})
    # What the caller keeps travels in one struct, so no name of a step can clash with it.
    kept = F.struct(*[F.col(k) for k in keep], *([] if keep else [F.lit(0).alias("_")])).alias("_keep")
    d = docs.select(kept, F.regexp_extract_all(lower_ascii(text_or_empty()), F.lit(LICENCE_WORD), F.lit(0)).alias("_w"))
    words = F.array(*[F.lit(w) for w in vocabulary])
    d = d.select("_keep", "_w", F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" ")).alias("_j"), F.array_intersect("_w", words).alias("_v"))
    d = d.select(
        "_keep",
        "_w",
        "_v",
        F.size("_w").cast("long").alias("n_words"),
        F.array(*[F.struct(F.lit(label).alias("label"), _consecutive(p).alias("at")) for p, label in BASE.items()]).alias("_base"),
        F.when(F.size("_v") > 0, F.filter(F.array(*[F.lit(p) for p in needed]), lambda p: F.contains("_j", F.concat(F.lit(" "), p, F.lit(" "))))).alias("_phrases"),
    )
    # One pass over the texts; what follows reads this table, which has the words of files with a key phrase only.
    d = written(d.withColumn("_w", F.when(F.size("_phrases") > 0, F.col("_w"))), "licence-words")
    seen = {r.w: r.df for r in d.select(F.explode("_v").alias("w")).groupBy("w").agg(F.count("*").alias("df")).collect()}  # a row for each template word
    n = d.count()
    idf = {w: math.log(1 + n / (1 + seen.get(w, 0))) for w in vocabulary}
    starts = F.array_sort(F.array_distinct(F.concat(*[_found(*t, idf) for t in templates])))
    places = F.flatten(F.transform("_base", lambda x: x.at))
    base_labels = F.array_sort(F.array_distinct(F.transform(F.filter("_base", lambda x: F.size(x.at) > 0), lambda x: x.label)))
    out = {
        "n_words": F.col("n_words"),
        "n_base": F.size("_places").cast("long"),
        "first_word": F.array_min("_places").cast("long"),
        "last_word": F.array_max("_places").cast("long"),
        "base_labels": F.array_join("_labels", ","),
        "labels": F.array_join(F.array_sort(F.array_union("_labels", F.transform("starts", lambda x: x.label))), ","),
        "score": F.coalesce(F.array_max(F.transform("starts", lambda x: x.score)), F.lit(0.0)),
        "starts": F.col("starts"),
    }
    d = d.select("_keep", "n_words", places.alias("_places"), base_labels.alias("_labels"), starts.alias("starts"))
    return d.select(*[F.col("_keep").getField(k).alias(f"doc_{k}" if k in out else k) for k in keep], *[c.alias(k) for k, c in out.items()])
