"""Secret scan: fixed patterns, and zstandard novelty against a primed dictionary.

Base spans come from three patterns (assign, access, hex). The method adds `novel` spans: a candidate string near a
sensitive word is compressed twice with a dictionary of identifiers, once as the surrounding code alone and once with the candidate in its
place. The marginal compressed bytes over the candidate's length say how new it is; a candidate that neither the
surrounding code nor the dictionary makes cheap is reported, unless a base span covers it already. How new it must be depends on what
it is made of (LIMITS): letters and digits in one string are rare in words, so they need least.

The dictionary has two parts: a list of words that code around secrets is made of, and the identifiers that stand near sensitive words in most
documents of the corpus itself (identifiers(): all documents are counted; the DICTIONARY most frequent ones in at least
LEAST_DOCUMENTS enter, which bounds what is sent to the executors to 32 KB). Identifiers are shorter than any candidate, so a secret that
copies of a document repeat can't teach itself to the dictionary.

Defined cases: a null or empty text has no spans, counts 0 and the digest of ''; places are code points, end
exclusive; a span is the whole match, so for assign the key, the sign and the value; repeated rows get equal
results, one for each row; ids may be null or repeated; whole texts are read, whatever their length; an empty table gives no
rows, and the list alone as dictionary.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Words that make their surroundings sensitive.
SENSITIVE = ("password", "passwd", "secret", "token", "apikey", "api_key", "credential", "private", "bearer", "auth", "access")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,10}(?![A-Za-z0-9+/_=-])")
#: What code around secrets is made of.
IDENTIFIERS = (
    "access account action address admin algorithm api_key apikey application array async auth authorization aws_access_key_id aws_secret_access_key "
    "base64 bearer boolean bucket buffer cache callback certificate class client client_id client_secret config connection const content context "
    "cookie create credential credentials data database debug default delete digest domain encoding endpoint environment error example except export "
    "false file format from function github hash header host http https id_rsa import index input integer json key length license list local login "
    "message method module name null number object output package parameter password path permission port private_key profile project public query "
    "refresh_token region request response return secret secret_key self server service session sha256 signature source ssh_key static status string "
    "system table target test throw timeout token true type undefined update url user username value variable version 0123456789abcdef "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789"
)
NEAR, CONTEXT = 48, 256
DICTIONARY, LEAST_DOCUMENTS = 2500, 2
#: (least length, marginal bytes a character at least) by what a candidate is made of. A run of letters in one case is a word
#: for all that compression can tell, so it is none; capitals between small letters aren't, unless they start words.
LIMITS = {"mixed": (16, 0.65), "short": (12, 0.9), "digits": (16, 0.8), "letters": (16, 0.7)}
#: Capitalised words one after another, as code and titles write them.
WORDS = re.compile(r"[A-Z]?[a-z]{2,}(?:[_/+=-]*[A-Z]?[a-z]{2,})*[_/+=-]*")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end), sorted."""
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYS) or not text.isascii():
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class Novelty:
    """Marginal compressed bytes of a candidate, given its surroundings and the identifiers."""

    def __init__(self, identifiers: str = "", level: int = 9):
        import zstandard

        # The most frequent words stand last, where references to them are shortest.
        words = zstandard.ZstdCompressionDict(f"{identifiers} {IDENTIFIERS}".encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.size = lambda b, c=zstandard.ZstdCompressor(level=level, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False): len(c.compress(b))

    def __call__(self, before: str, candidate: str, after: str) -> float:
        around = (before + "\n" + after + "\n").encode()
        return (self.size(around + candidate.encode()) - self.size(around)) / len(candidate.encode())


def kind_of(x: str) -> str | None:
    """The kind of a candidate by LIMITS, None if it is none: too short, signs only, or words."""
    digit, letter = any(c.isdigit() for c in x), any(c.isalpha() for c in x)
    if digit and letter:
        return "mixed" if len(x) >= LIMITS["mixed"][0] else "short"
    if digit:
        return "digits" if sum(map(str.isdigit, x)) >= LIMITS["digits"][0] else None
    if not letter or len(x) < LIMITS["letters"][0] or x.lower() == x or x.upper() == x or WORDS.fullmatch(x):
        return None
    return "letters"


def _near(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of the text that lie within CONTEXT of a sensitive word, in order, those that touch made one."""
    low, high = -1, -1
    for m in SENSITIVE_RE.finditer(text):
        if high >= 0 and m.start() - CONTEXT > high:
            yield low, high
            low = -1
        if low < 0:
            low = max(0, m.start() - CONTEXT)
        high = min(len(text), m.end() + CONTEXT)
    if high >= 0:
        yield low, high


def novel_spans(text: str, base: list[Span], novelty: Novelty) -> list[Span]:
    """(start, 3, end) of candidates near a sensitive word that no base span covers. Any sensitive word is enough:
    places of sensitive words and candidates are merged in one walk, so the cost follows the text."""
    low = text.lower() if text.isascii() else None
    if low is not None and not any(w in low for w in SENSITIVE):
        return []
    words = sorted((m.start(), m.end()) for m in SENSITIVE_RE.finditer(text))
    out, i, b, reach = [], 0, 0, -1
    for m in CANDIDATE.finditer(text) if words else ():
        s, e = m.span()
        while b < len(base) and base[b][0] <= s:
            reach = max(reach, base[b][2])
            b += 1
        if reach >= e:
            continue
        while i < len(words) and words[i][1] < s - NEAR:
            i += 1
        if i == len(words) or words[i][0] > e + NEAR:
            continue
        x = m.group()
        kind = kind_of(x)
        if kind and novelty(text[max(0, s - CONTEXT) : s], x, text[e : e + CONTEXT]) >= LIMITS[kind][1]:
            out.append((s, 3, e))
    return out


SENSITIVE_RE = re.compile("|".join(sorted(SENSITIVE, key=len, reverse=True)), re.IGNORECASE | re.ASCII)


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def identifiers(docs: DataFrame, most: int = DICTIONARY, least: int = LEAST_DOCUMENTS) -> str:
    """The identifiers that stand near sensitive words in most documents, rarest first. Documents are told apart by a hash of
    their texts, so copies count once. `most` of them come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, of = [], []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text.isascii() and not any(w in text.lower() for w in SENSITIVE):
                    continue
                found = {m.group() for a, b in _near(text) for m in IDENTIFIER.finditer(text, a, b)}
                word += found
                of += [h] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(of, pa.int64())], names=["word", "of"])

    d = docs.select(F.xxhash64(text_or_empty()).alias("h"), text_or_empty().alias("_text")).mapInArrow(run, "word string, of long")
    top = d.distinct().groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most)
    return " ".join(r.word for r in reversed(top.collect()))


def scan(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """id, n_assign, n_access, n_hex, n_novel, base_sha256, spans; one row for each row. Only identifiers are shuffled."""
    known = docs.sparkSession.sparkContext.broadcast(identifiers(docs))
    kind = dict(docs.dtypes)[id_column]
    schema = f"`{id_column}` {kind}, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(known.value)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                more = novel_spans(text, base, novelty)
                n = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((*n, len(more), hashlib.sha256(_written(base).encode()).hexdigest(), _written(sorted(base + more))))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            names = [id_column, "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    return docs.select(id_column, text_or_empty().alias("_text")).mapInArrow(run, schema)
