"""The operators that compare documents with each other, against brute force on small tables."""

import hashlib
import random
import re
import tempfile
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.llm import jaccard_join, line_dedup, suffix_dedup, suffix_sort

SF = "/root/testdata/sf0.001"


def family(r, n_words, n, edits):
    base = [f"w{r.randrange(10**6)}" for _ in range(n_words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(edits)):
            w[r.randrange(n_words)] = f"x{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(5)
    texts = [None, "", " \n ", "one", "ONE", "one two three four", "one two three four five", "one two three four five six", "zero one two three four five six seven"]
    texts += family(r, 260, 70, 12) + family(r, 24, 40, 2) + family(r, 9, 6, 2)
    shared = " ".join(f"s{i}" for i in range(60))
    texts += [f"{'é' * i} a{i} {shared}\n{'line of words ' * 9}{i % 3}\n\nb{i} {shared} end" for i in range(30)]
    texts += ["ab" * 400, "ab" * 99 + "a", "abc" * 500, "q" * 199, "q" * 200, "q" * 201]
    r.shuffle(texts)
    rows = [(i if i != 7 else None, t, "x", "y", 0, "z", "z") for i, t in enumerate(texts)]
    rows += [(3, texts[3], "x", "y", 0, "z", "z"), (500, texts[4], "x", "y", 0, "z", "z")]
    own = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, u string, d string")
    more = spark.read.parquet(f"{SF}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1000)
    return own.unionByName(more, allowMissingColumns=True).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_jaccard_join(docs, rows):
    sets = [(d, shingles(t)) for d, t in rows]
    by, up = defaultdict(set), {}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (d, s) in enumerate(sets):
        up[i] = i
        for g in s if d is not None else ():
            by[g].add(i)
    for i, (_, s) in enumerate(sets):
        n = Counter(j for g in s for j in by[g] if j < i)
        for j, k in n.items():
            if sets[i][0] is not None and 100 * k >= 80 * (len(s) + len(sets[j][1]) - k):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    want = Counter((d, len(s), least[root(i)] if d is not None else None) for i, (d, s) in enumerate(sets))
    assert Counter(map(tuple, jaccard_join.join(docs).drop("text_hash", "component").collect())) == want
    assert jaccard_join.join(docs.limit(0)).count() == 0


def test_signatures_meet_wherever_sets_link():
    """With every token frequent, none, or some, two sets that link share a signature."""
    r = np.random.default_rng(3)
    for trial in range(600):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2))
        b = a
        while True:
            c = np.unique(np.append(np.delete(b, r.integers(0, len(b))), r.integers(0, 2**63, 1, dtype=np.int64).astype(np.uint64) * np.uint64(2))) if r.random() < 0.5 else np.delete(b, r.integers(0, len(b)))
            k = len(np.intersect1d(a, c))
            if 100 * k < 80 * (len(a) + len(c) - k):
                break
            b = c
        words = 1 << jaccard_join.BITS >> 6
        bits = [np.zeros(words, np.uint64), np.full(words, np.uint64(2**64 - 1)), r.integers(0, 2**63, words, dtype=np.int64).astype(np.uint64)][trial % 3]
        a, b = sorted((a, b), key=len)
        low, every = jaccard_join.signatures(a, (bits, bits), jaccard_join.smaller(a)), jaccard_join.signatures(b, (bits, bits))
        assert len(np.intersect1d(low, every)) and set(low) <= set(jaccard_join.signatures(a, (bits, bits)))
        sigs, is_low = jaccard_join.low_signatures(a, (bits, bits))
        assert set(sigs) == set(jaccard_join.signatures(a, (bits, bits))) and set(sigs[is_low]) == set(low) and len(set(sigs)) == len(sigs)


def removed(rows, length):
    raw = [t.encode() for _, t in rows]
    n = Counter(hash(b[i : i + length]) for b in raw for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if n[hash(b[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("length", [200, 120])
def test_suffix_dedup(docs, rows, length):
    assert Counter(map(tuple, suffix_dedup.dedup(docs, length=length, with_text=False).collect())) == removed(rows, length)


def test_suffix_dedup_of_slices_and_none(docs, spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 1000)
    monkeypatch.setattr(suffix_dedup, "SHARD", 5000)
    small = docs.where("doc_id < 260 or doc_id is null")
    rows = [(r.doc_id, r.text or "") for r in small.collect()]
    got = suffix_dedup.dedup(small)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == removed(rows, 200)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.collect())
    assert suffix_dedup.dedup(docs.limit(0)).count() == 0


def test_suffix_dedup_of_hot_anchors(spark, monkeypatch):
    """A passage in many documents, each with its own surroundings; what a task may hold is lowered below its segments."""
    r = random.Random(21)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage, other = word(700), word(260)
    rows = [(i, word(r.randrange(150, 400)) + passage + word(r.randrange(150, 400)) + (other if i % 3 == 0 else "")) for i in range(60)]
    rows += [(100 + i, f"{i % 2}" + passage[i : i + 300] + word(50)) for i in range(20)] + [(7, rows[7][1]), (200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counted = []
    monkeypatch.setattr(suffix_dedup, "_counted_out", lambda d, n, f=suffix_dedup._counted_out: counted.append(1) or f(d, n))
    for hot in (suffix_dedup.HOT, 6000, 0):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        got = suffix_dedup.dedup(docs, with_text=False)
        assert Counter(map(tuple, got.collect())) == removed([(d, t or "") for d, t in rows], 200)
    assert len(counted) == 2


@pytest.mark.parametrize("block,queues", [(1 << 16, 1024), (4, 1024), (4, 2)])
def test_suffix_sort(monkeypatch, block, queues):
    monkeypatch.setattr(suffix_sort, "BLOCK", block)
    monkeypatch.setattr(suffix_sort, "QUEUES", queues)
    for trial in range(150):
        r = random.Random(trial)
        t = [r.randint(1, r.choice([1, 2, 3, 20])) for _ in range(r.randint(0, 120))]
        t = (t[: len(t) // 2] * 2 if r.random() < 0.5 else t) + [0]
        with tempfile.TemporaryDirectory() as folder:
            got = list(suffix_sort.suffixes(np.array(t), folder, 10))
        pos, lcp = ([x for b in got for x in b[k].tolist()] for k in (0, 1))
        assert sorted(pos) == list(range(len(t))) and [t[i : i + 10] for i in pos] == sorted(t[i : i + 10] for i in range(len(t)))
        same = [next((k for k in range(10) if t[a + k : a + k + 1] != t[b + k : b + k + 1] or a + k >= len(t)), 10) for a, b in zip(pos, pos[1:])]
        assert lcp == [0, *same]


def kept_lines(rows, m, words):
    """By order of id: lines whose run of m lines, or single long line, stood earlier are gone."""
    order = sorted({((d is not None, d), t) for d, t in rows if t}, key=lambda x: x[0])
    seen, out = {}, {}
    for k, ((_, d), t) in enumerate(order):
        lines = t.split("\n")
        at = [i for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        gone = set()
        for j in range(len(at)):
            one, run = lines[at[j]], tuple(lines[i] for i in at[j : j + m])
            if len(re.findall(r"[^\x20\x09-\x0D]+", one)) >= words and seen.setdefault((one,), (k, j)) != (k, j):
                gone.add(at[j])
            if m > 1 and len(run) == m and seen.setdefault(run, (k, j)) != (k, j):
                gone.update(at[j : j + m])
        out[d, t] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(at), len(gone))
    return out


@pytest.mark.parametrize("m,words", [(1, 1), (2, 10**6), (3, 10**6)])
def test_line_dedup(docs, rows, m, words):
    got = line_dedup.dedup(docs, min_lines=m)
    assert got.select("row.*").columns == docs.columns
    want = kept_lines(rows, m, words)
    assert Counter((r.row.doc_id, r.row.text or "", r.kept_text, r.n_lines, r.n_removed) for r in got.collect()) == Counter((d, t, *want.get((d, t), ("", 0, 0))) for d, t in rows)
    assert line_dedup.dedup(docs.limit(0)).count() == 0


def longest_runs(rows):
    """By (id, text) and place, the longest run of lines with a word that also stands at another place."""
    seqs = {(d, t): [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)] for d, t in rows}
    by = defaultdict(list)
    for k, s in seqs.items():
        for j, x in enumerate(s):
            by[x].append((k, j))
    out = {}
    for k, s in seqs.items():
        for j, x in enumerate(s):
            best = 0
            for q, i in by[x]:
                n = 0
                while (q, i) != (k, j) and j + n < len(s) and i + n < len(seqs[q]) and s[j + n] == seqs[q][i + n]:
                    n += 1
                best = max(best, n)
            out[k, j] = best
    return out


def test_maximal_line_runs(spark):
    r = random.Random(9)
    long = [f"long {i}" for i in range(37)]
    texts = ["\n".join(r.choice("aabcd") * r.choice((1, 1, 2)) for _ in range(r.randrange(14))) for _ in range(40)]
    texts += ["\n".join(long), "\n".join(["x", *long, "y"]), "\n".join([*long[5:30], "", "z", *long[:9]]), "a\n" * 33, "only", None, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[4]), (None, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    best = longest_runs([(d if d is not None else line_dedup.FIRST_ID, t or "") for d, t in rows])
    hashed = {(line_dedup.FIRST_ID if x.doc_id is None else x.doc_id, x.t): x.text or "" for x in docs.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) t").collect()}
    got = {((x.d, hashed[x.d, x.t]), x.j): x.length for x in line_dedup.runs(docs).collect()}
    assert got == {(k, j): n for (k, j), n in best.items() if n and best.get((k, j - 1), 0) <= n}
    assert max(got.values()) == 37
    top = defaultdict(int)
    for (k, _), n in best.items():
        top[k] = max(top[k], n)
    found = line_dedup.dedup(docs).collect()
    assert all(x.longest_run == top[line_dedup.FIRST_ID if x.row.doc_id is None else x.row.doc_id, x.row.text or ""] for x in found) and len(found) == len(rows)
    assert line_dedup.runs(docs.limit(0)).count() == 0


def test_sketches_never_exaggerate():
    rng = np.random.default_rng(3)
    for n in (0, 1, 30, 600, 5000):
        base = rng.integers(0, 2**63, n + 40, dtype=np.int64).astype(np.uint64)
        for k in (0, 1, 17, 40):
            a, b = np.unique(base[: n + k]), np.unique(base[k:])
            apart = len(np.setxor1d(a, b))
            bits = sum(int(x).bit_count() for x in jaccard_join.sketch(a) ^ jaccard_join.sketch(b))
            assert bits <= apart
            assert bits > 0 or apart != 1


def test_families_keep_every_pair(spark):
    rng = np.random.default_rng(5)
    rows = [(s, int(i), 100, bool(rng.random() < 0.5), int(i)) for s in range(30) for i in rng.choice(40, 12, replace=False)]
    left = spark.createDataFrame(rows, "sig long, id long, n int, low boolean, comp long")
    got = jaccard_join.families(left).collect()
    assert len({(r.key, r.id) for r in got}) == len(got)
    at, low = {}, {}
    for r in got:
        at.setdefault(r.id, set()).add(r.key)
        low[r.key, r.id] = r.low
    for s, i, _, is_low, _ in rows:
        for s2, j, *_ in rows:
            if s == s2:
                assert any(not is_low or low[k, i] for k in at[i] & at[j])
