"""The registered queries of the llm operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_tree, fingerprint, jaccard_join, license_scan, line_dedup, merkle, mixing, packing, quality_rules, secret_scan, sharding, suffix_dedup, warc
from .common import lower_ascii, new_path, table, text_or_empty, written

#: Target weights among siblings of the mixing tree; 1 elsewhere.
MIX_WEIGHTS = {("d0",): 4.0, ("d1",): 3.0, ("d2",): 2.0, ("d3",): 1.0}
MIX_SHARE, MIX_EPOCHS = 0.6, 2


def source_domain() -> Column:
    """Sources are dealt to four domains by their number."""
    return F.concat(F.lit("d"), F.pmod(F.coalesce(F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) as bigint)"), F.lit(0)), F.lit(4)).cast("string"))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents")).drop("text_hash", "component")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), with_text=False)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), source_domain(), MIX_SHARE, MIX_EPOCHS, MIX_WEIGHTS)
    return mixed.select("row.doc_id", "domain", "lang", "source", F.col("epoch").cast("long").alias("epoch"), "n_tokens", "taken")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edits(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return lines.select("row.doc_id", "n_lines", "n_removed", "n_runs", "longest_run", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_line_dedup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op5_line_dedup, without the longest runs."""
    lines = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return lines.select("row.doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), "doc_id").drop("starts")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    captures = warc.assemble(warc.read(spark, path, with_payload=False))
    told = F.map_from_entries("metadata.fields")
    return captures.select(
        told["capture-id"].cast("long").alias("page_id"),
        "response.payload_bytes",
        F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.expr("try_cast(regexp_extract(response.refers_to, ':(-?[0-9]*)[.][^:]*>$', 1) as bigint)").alias("refers_to"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = written(quality_rules.features(table(spark, sf_dir, "documents"), "doc_id", "lang"), "quality")
    limits = quality_rules.thresholds(feats, table(spark, sf_dir, "labels"), "lang")
    return quality_rules.judge(feats, limits, "lang").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "guarantee")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op11_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = ball_tree.cluster(table(spark, sf_dir, "embeddings"))
    return d.withColumn("centroid_sha256", ball_tree.centroid_sha256(F.col("centroid"))).drop("centroid")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 3 divides the crc32 of the id, the text held now is the lower-cased one."""
    told = lambda text: merkle.digest(*map(F.col, ("doc_id", "source", "lang", "n_chars")), text)
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    held = F.when(tampered, told(lower_ascii(F.col("text")))).otherwise(told(F.col("text")))
    trees = merkle.Manifest(table(spark, sf_dir, "documents"), told(F.col("text")), also={"held": held})
    return trees.verified("held").withColumnsRenamed({"key": "doc_id", "digest": "leaf"})


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty()
    columns = {"size": F.octet_length(text).cast("long") + 16, "text_crc32": F.crc32(text.cast("binary"))}
    d = sharding.shard(table(spark, sf_dir, "documents"), F.array(F.unhex(F.sha2(text, 256))), columns)
    return d.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_jaccard_join,
        op2_suffix_dedup,
        op3_source_mixing,
        op4_fingerprints,
        op5_line_dedup,
        op5_line_dedup_all,
        op6_license_scan,
        op7_warc,
        op8_packing,
        op9_quality_rules,
        op10_secret_scan,
        op11_ball_tree,
        op12_merkle,
        op13_sharding,
    )
}

_WORDS = r"[^\x20\x09-\x0D]+"

#: Sets of 5-word shingles, all pairs that share one, and the closure of the links.
ORACLE_1 = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') as w from documents
), s as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from w
), t as materialized (select doc_id, len(s) as n, unnest(s) as g from s),
p as materialized (
  select a.doc_id as x, b.doc_id as y from t a join t b on a.g = b.g and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), c as (select x as root, x as y from p union select c.root, p.y from c join p on c.y = p.x)
select s.doc_id, len(s)::bigint as n_shingles, coalesce(least(s.doc_id, m.y), s.doc_id)::bigint as component_id
from s left join (select root, min(y) as y from c group by root) m on m.root = s.doc_id
"""

#: Lines with a word; a place is deleted if its line stands earlier.
#: Runs grow line by line as long as they stand twice; the longest of a document is its last.
ORACLE_5 = rf"""
with recursive a as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
e as (select doc_id, unnest(l) as x, generate_subscripts(l, 1) as i from a),
f as (select *, row_number() over (partition by doc_id order by i) as j from e where regexp_matches(x, '{_WORDS}')),
m as (select *, row_number() over (partition by x order by doc_id, j) > 1 as gone from f),
n as (select e.*, m.j is not null as word, coalesce(m.gone, false) as gone from e left join m on e.doc_id = m.doc_id and e.i = m.i),
r as (
  select 1 as n, doc_id, j, md5(x) as key from (select *, count(*) over (partition by x) as c from f) where c > 1
  union all
  select n, doc_id, j, key from (
    select n, doc_id, j, key, count(*) over (partition by key) as c
    from (select r.n + 1 as n, r.doc_id, r.j, md5(r.key || md5(f.x)) as key from r join f on f.doc_id = r.doc_id and f.j = r.j + r.n)
  ) where c > 1
), longest as (select doc_id, max(n) as longest_run from r group by doc_id),
o as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) as start from n)
select o.doc_id, count(*) filter (word)::bigint as n_lines, count(*) filter (gone)::bigint as n_removed, count(*) filter (start)::bigint as n_runs,
  coalesce(any_value(longest_run), 0)::bigint as longest_run,
  sha256(coalesce(string_agg(x, chr(10) order by i) filter (not gone), '')) as kept_sha256
from o left join longest on longest.doc_id = o.doc_id group by o.doc_id
"""

#: As ORACLE_5, without runs.
ORACLE_5_ALL = rf"""
with a as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
e as (select doc_id, unnest(l) as x, generate_subscripts(l, 1) as i from a),
f as (select *, row_number() over (partition by x order by doc_id, i) > 1 as gone from e where regexp_matches(x, '{_WORDS}')),
n as (select e.*, f.i is not null as word, coalesce(f.gone, false) as gone from e left join f on e.doc_id = f.doc_id and e.i = f.i),
o as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) as start from n)
select doc_id, count(*) filter (word)::bigint as n_lines, count(*) filter (gone)::bigint as n_removed, count(*) filter (start)::bigint as n_runs,
  sha256(coalesce(string_agg(x, chr(10) order by i) filter (not gone), '')) as kept_sha256 from o group by doc_id
"""

#: Windows of 200 bytes as hexadecimal text; a run is broken where no window that is repeated starts for over 200 bytes.
ORACLE_2 = """
with h as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
w as materialized (select doc_id, i, hash(substr(x, 2 * i + 1, 400)) as k from (select doc_id, x, unnest(range(0, length(x) // 2 - 199)) as i from h)),
r as (select doc_id, i, i - lag(i) over (partition by doc_id order by i) as gap from w where k in (select k from w group by k having count(*) > 1)),
g as (select doc_id, i, sum(case when gap <= 200 then 0 else 1 end) over (partition by doc_id order by i) as run from r),
s as (select doc_id, min(i) as a, max(i) + 200 as b from g group by doc_id, run),
p as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as before from s),
o as (select p.doc_id, sum(b - a) as removed, count(*) as spans, max(b) as last, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' order by a) as kept from p join h using (doc_id) group by p.doc_id)
select h.doc_id, (length(x) // 2)::bigint as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(spans, 0)::bigint as n_spans, sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) as kept_sha256
from h left join o on o.doc_id = h.doc_id
"""

_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v[{i + 1}] >> {s}) & 31)::int, 1)" for i in range(8) for s in (15, 10, 5, 0))
_DIGITS = ", ".join(f"('0x' || substr(sha1(p), {1 + 5 * i}, 5))::int" for i in range(8))
#: Five hexadecimal digits of the digest are four of base 32.
ORACLE_7 = f"""
with a as (select page_id, encode(coalesce(html, '')) as p from pages),
b as (select page_id, octet_length(p) as n, [{_DIGITS}] as v, max(page_id) over (partition by p) as last from a)
select page_id, n::bigint as payload_bytes, {_BASE32} as payload_digest, case when last = page_id then 'response' else 'revisit' end as record_type, nullif(last, page_id) as refers_to from b
"""



def _level(name: str, keys: str, up: str, weight: str, budget: str, source: str) -> str:
    """Budgets of a level's nodes: children run dry in order of tokens by weight, the first that doesn't says what the others get."""
    part = f"partition by {up}" if up else ""
    return f"""{name}0 as (select {keys}, sum(cap) as c, {weight} as w, {budget} as b from {source} group by {keys}),
{name}1 as (select *, coalesce(sum(c) over ({part} order by c / w, {keys} rows between unbounded preceding and 1 preceding), 0) as spent, sum(w) over ({part} order by c / w, {keys} rows between current row and unbounded following) as rest from {name}0),
{name}2 as (select *, (b - spent) / rest as share, c <= (b - spent) / rest * w as dry from {name}1),
{name} as (select {keys}, case when dry then c else w * (min(struct_pack(o := c / w, l := share)) filter (not dry) over ({part})).l end as b from {name}2)"""


_WEIGHT = "case domain " + " ".join(f"when '{k[0]}' then {v}" for k, v in MIX_WEIGHTS.items()) + " else 1.0 end"
ORACLE_3 = rf"""
with a as (select doc_id, 'd' || (coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) as bigint), 0) % 4) as domain, coalesce(lang, '(none)') as lang, coalesce(source, '(none)') as source,
len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::bigint as n from documents),
l as (select domain, lang, source, sum(n)::bigint as supply, sum(n)::double * {MIX_EPOCHS} as cap from a group by 1, 2, 3),
{_level('x', 'domain', '', _WEIGHT, f'(select sum(supply) * {MIX_SHARE}::double from l)', 'l')},
{_level('y', 'domain, lang', 'domain', '1.0', 'any_value(b)', 'l join x using (domain)')},
{_level('z', 'domain, lang, source', 'domain, lang', '1.0', 'any_value(b)', 'l join y using (domain, lang)')},
q as (select domain, lang, source, supply, floor(b + 1e-6)::bigint as budget from l join z using (domain, lang, source)),
e as (select doc_id, domain, lang, source, n, supply, budget, (budget - 1) // supply as last, unnest(range(0, ((budget - 1) // supply + 1)::bigint)) as epoch from a join q using (domain, lang, source) where n > 0 and budget > 0),
r as (select *, sum(n) over (partition by domain, lang, source, epoch order by md5('mix-1:' || epoch || ':' || doc_id) rows unbounded preceding) as run from e)
select doc_id, domain, lang, source, epoch::bigint as epoch, n as n_tokens, case when epoch < last then n else least(n, budget - supply * last - run + n) end::bigint as taken
from r where epoch < last or budget - supply * last - run + n > 0
"""



def _rows(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


_TEMPLATE_WORDS = [(label, w, q) for label, _, wording in license_scan.TEMPLATES for q, w in enumerate(wording.split(" ")) if w not in license_scan.COMMON]
_PLACES = {label: "list_filter(range(len(w)), lambda i: " + " and ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(phrase.split(" "))) + ")" for phrase, label in license_scan.BASE.items()}
#: Words joined to the templates' words wherever they stand, in files that have a template's key phrases.
ORACLE_6 = rf"""
with a as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{license_scan.LICENCE_WORD}') as w from documents),
b as (select doc_id, w, ' ' || array_to_string(w, ' ') || ' ' as j, {', '.join(f'{p} as p{i}' for i, p in enumerate(_PLACES.values()))} from a),
t(label, w, q) as (values {_rows(_TEMPLATE_WORDS)}), k(label, phrase) as (values {_rows([(label, p) for label, phrases, _ in license_scan.TEMPLATES for p in phrases])}),
f as (select w, count(*) as df from (select distinct doc_id, unnest(w) as w from a) where w in (select w from t) group by w),
d as (select t.label, t.w, t.q, ln(1 + (select count(*) from a) / (1 + coalesce(df, 0))) as idf from t left join f on f.w = t.w),
m as (select label, sum(idf) as total from d group by label),
o as (select doc_id, label from b, k group by doc_id, label having bool_and(contains(j, ' ' || phrase || ' '))),
x as (select doc_id, unnest(w) as w, generate_subscripts(w, 1) - 1 as i from b where doc_id in (select doc_id from o)),
h as (select o.doc_id, o.label, d.w, d.idf, d.q, x.i - d.q as start from o join x on x.doc_id = o.doc_id join d on d.label = o.label and d.w = x.w),
r as (select doc_id, label, w from (select distinct doc_id, label, w, idf from h) qualify row_number() over (partition by doc_id, label order by idf desc, w) <= {license_scan.ANCHORS}),
s as (select h.doc_id, h.label, least(1, sum(h.idf) / any_value(total)) as score from h join m on m.label = h.label left join r on r.doc_id = h.doc_id and r.label = h.label and r.w = h.w
group by h.doc_id, h.label, h.start having sum(h.idf) / any_value(total) >= {license_scan.MIN_SCORE} and count(r.w) > 0),
g as (select doc_id, list(distinct label) as found, round(max(score), 6) as score from s group by doc_id),
e as (select *, list_concat({', '.join(f'p{i}' for i in range(len(_PLACES)))}) as p, list_filter([{', '.join(f"case when len(p{i}) > 0 then '{label}' end" for i, label in enumerate(_PLACES))}], lambda y: y is not null) as own from b)
select e.doc_id, len(w)::bigint as n_words, len(p)::bigint as n_base, list_min(p)::bigint as first_word, list_max(p)::bigint as last_word, array_to_string(list_sort(own), ',') as base_labels,
array_to_string(list_sort(list_distinct(list_concat(own, coalesce(found, [])))), ',') as labels, coalesce(score, 0)::double as score from e left join g on g.doc_id = e.doc_id
"""

_SQUARED = "(list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c))"
#: Rounds written out; components are whole numbers in doubles, whose sums of products are exact here.
_ASSIGNED = lambda r: f"n{r} as materialized (select vec_id, x, min(struct_pack(d := {_SQUARED}, k := k)) as b from v, c{r} group by vec_id, x)"
_MOVED = lambda r: f"""s{r} as (select k, list(floor(t / n) order by j) as c from (select b.k as k, j, sum(x[j]) as t, count(*) as n from n{r}, (select unnest(range(1, 65)) as j) group by b.k, j) group by k),
c{r + 1} as materialized (select k, coalesce(s{r}.c, c{r}.c) as c from c{r} left join s{r} using (k))"""  # noqa: E731
ORACLE_11 = f"""
with v as materialized (select vec_id, list_transform(embedding, lambda e: floor(256 * e::double)) as x from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64),
c0 as materialized (select k, x as c from (select row_number() over (order by sha256('2:' || vec_id)) - 1 as k, x from v) where k < 40),
{', '.join(f'{_ASSIGNED(r)}, {_MOVED(r)}' for r in range(5))}, {_ASSIGNED(5)}
select vec_id, b.k::int as cluster, b.d::bigint as distance, (sum(b.d) over (partition by b.k))::bigint as cluster_inertia, (sum(b.d) over ())::bigint as inertia,
sha256(array_to_string(list_transform(c, lambda e: e::bigint::varchar), ',')) as centroid_sha256 from n5 join c5 on c5.k = n5.b.k
"""

#: Levels of a tree that the SQL goes up to, more than the tables need.
_HEIGHT, _ARITY = 8, merkle.ARITY
_FIELD = lambda c: f"coalesce(octet_length(encode({c}::varchar)) || ':' || {c}::varchar, '-')"
_LEAF = lambda text: f"sha256({' || '.join([_FIELD(c) for c in ('doc_id', 'source', 'lang', 'n_chars')] + [_FIELD(text)])})"

#: The checksum of the id's digits, bit by bit.
_CRC32 = """xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(doc_id::varchar, ''), lambda y: [ascii(y)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
lambda a, y: case when y >= 0 then xor(a, y) else xor(a >> 1, case when a & 1 = 1 then 3988292384 else 0 end) end), 4294967295)"""


def _tree(name: str, group: str, leaves: str) -> str:
    """name0 to name8: `group`, i, d and l, the digests of the node's run, level by level; a lone node stays as it is."""
    out = [f"{name}0 as materialized (select *, list(d) over (partition by {group}, i // {_ARITY} order by i rows between unbounded preceding and unbounded following) as l, count(*) over (partition by {group}) as n from ({leaves}))"]
    for k in range(1, _HEIGHT + 1):
        up = f"select {group}, case when n = 1 then i else i // {_ARITY} end as i, case when any_value(n) = 1 then any_value(d) else sha256(string_agg(d, '' order by i)) end as d from {name}{k - 1} group by {group}, n, 2"
        out.append(f"{name}{k} as materialized (select *, list(d) over (partition by {group}, i // {_ARITY} order by i rows between unbounded preceding and unbounded following) as l, count(*) over (partition by {group}) as n from ({up}))")
    return ", ".join(out)


def _climbed(name: str, group: str, source: str) -> str:
    """`source` (group, i, proof, now) taken up the tree `name`: siblings are joined to the proof, and now becomes the folded digest."""
    out = source
    for k in range(_HEIGHT):
        at = f"(s.i % {_ARITY})"
        out = f"""(select s.* exclude (i, proof, now), case when n = 1 then s.i else s.i // {_ARITY} end as i, case when n = 1 then proof else proof || array_to_string(l[1:{at}], '') || array_to_string(l[{at} + 2:], '') end as proof,
case when n = 1 then now else sha256(array_to_string(l[1:{at}], '') || now || array_to_string(l[{at} + 2:], '')) end as now from {out} s join {name}{k} t on t.i = s.i and t.{group} is not distinct from s.{group})"""
    return out


ORACLE_12 = f"""
with a as (select *, {_LEAF('text')} as leaf from documents),
b as (select *, row_number() over (partition by lang order by doc_id) - 1 as i from a),
{_tree('t', 'lang', 'select lang, i, leaf as d from b')},
g as (select lang, d, row_number() over (order by lang nulls first) - 1 as j from t{_HEIGHT}),
{_tree('u', 'one', 'select 1 as one, j as i, d from g')},
o as (select doc_id, leaf, lang, i, '' as proof, case when {_CRC32} % 3 = 0 then {_LEAF("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} else leaf end as now from b),
p as (select s.doc_id, s.leaf, g.d as subroot, 1 as one, g.j as i, proof, now from {_climbed('t', 'lang', 'o')} s join g on g.lang is not distinct from s.lang)
select doc_id, leaf, subroot, r.d as root, sha256(proof) as proof_sha256, now as folded_root, now = r.d as verified from {_climbed('u', 'one', 'p')} s, u{_HEIGHT} r
"""

ORACLES: dict[str, str] = {"op1_jaccard_join": ORACLE_1, "op2_suffix_dedup": ORACLE_2, "op3_source_mixing": ORACLE_3, "op5_line_dedup": ORACLE_5, "op5_line_dedup_all": ORACLE_5_ALL, "op6_license_scan": ORACLE_6, "op7_warc": ORACLE_7, "op11_ball_tree": ORACLE_11, "op12_merkle": ORACLE_12}
