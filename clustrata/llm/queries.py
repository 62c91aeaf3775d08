"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, exact_dedup, html_extract, jaccard_join, line_dedup, merkle, ngram_lm, pii, suffix_dedup, toxicity, url_filter

Query = Callable[[SparkSession, str], DataFrame]

#: The host rules of the url query.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
TOXIC_FROM = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, n: int) -> Column:
    """crc32 of an id as text, modulo n."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = ngram_lm.score_texts(docs, fold("doc_id", 5) != 1)
    held = (~F.col("trained")).alias("held_out")
    return out.select("doc_id", held, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        decontam.items_digest(F.col("items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("bigint").alias("n_chars"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    tampered = F.when(even, F.translate("text", "\n", ""))
    out = merkle.verify(merkle.manifest(table(spark, sf_dir, "documents"), claimed={"text": tampered}))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return out.select("doc_id", *map(count, pii.KINDS), F.sha2(pii.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OP1_SQL = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents
)
select doc_id,
       first_value(doc_id) over (partition by text_sha256 order by n desc, doc_id nulls last) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       row_number() over (partition by text_sha256 order by n desc, doc_id nulls last) = 1 as kept,
       text_sha256
from d
"""

#: crc32 bit by bit over the decimal digits of an id
_CRC = """xor(list_reduce(list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint),
  lambda c, b: list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end), 4294967295::bigint), 4294967295::bigint)"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, base: str) -> str:
    """Levels of a forest over (g, i, n, h)."""
    return f"""{name} as (select 0 as l, g, i, n, h from ({base})
  union all select l + 1, g, i // 3, (n + 2) // 3, sha256(string_agg(h, '' order by i)) from {name} where n > 1 group by l, g, i // 3, n)"""


OP11_SQL = f"""
with recursive d as (
  select doc_id, coalesce('=' || source, '-') as g, {_leaf("text")} as leaf,
         case when {_CRC} % 2 = 0 then {_leaf("replace(text, chr(10), '')")} else {_leaf("text")} end as claim
  from documents
), placed as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by g) as n from d),
{_tree("t", "select g, i, n, leaf as h from placed")},
subroots as (select g, h from t where n = 1),
{_tree("u", "select '' as g, row_number() over (order by g) - 1 as i, count(*) over () as n, h from subroots")},
ways as (
  select p.doc_id, p.g, p.i, t.l, t.i as ti, t.h, (p.i // (3 ** t.l)::bigint) as own from placed p join t on t.g = p.g and t.n > 1 and t.i // 3 = (p.i // (3 ** t.l)::bigint) // 3
  union all
  select p.doc_id, p.g, p.i, 100 + u.l, u.i, u.h, (s.i // (3 ** u.l)::bigint) from placed p join (select g, row_number() over (order by g) - 1 as i from subroots) s using (g) join u on u.n > 1 and u.i // 3 = (s.i // (3 ** u.l)::bigint) // 3
), steps as (
  select doc_id, g, i, l, coalesce(string_agg(h, '' order by ti) filter (ti < own), '') as lhs, coalesce(string_agg(h, '' order by ti) filter (ti > own), '') as rhs,
         row_number() over (partition by doc_id, g, i order by l) as k
  from ways group by doc_id, g, i, l, own
), folds as (
  select doc_id, g, i, 0::bigint as k, claim as h from placed
  union all
  select f.doc_id, f.g, f.i, s.k, sha256(s.lhs || f.h || s.rhs) from folds f join steps s on s.doc_id = f.doc_id and s.g = f.g and s.i = f.i and s.k = f.k + 1
), ends as (select doc_id, g, i, arg_max(h, k) as folded from folds group by doc_id, g, i),
proofs as (select doc_id, g, i, string_agg(lhs || rhs, '' order by l) as proof from steps group by doc_id, g, i)
select p.doc_id, p.leaf, s.h as subroot, r.h as root, sha256(coalesce(q.proof, '')) as proof_sha256, e.folded as folded_root, e.folded = r.h as verified
from placed p join subroots s using (g) join ends e using (doc_id, g, i) left join proofs q using (doc_id, g, i), (select h from u where n = 1) r
"""

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Bytes as hex: two digits each. Runs of removed bytes are the islands of covered places.
OP2_SQL = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, ''))::bigint as n from documents),
w as (select doc_id, i, substr(h, 2 * i + 1, 100) as s from d, lateral (select unnest(range(0, n - 49)) as i) where n >= 50),
firsts as (select s, min(doc_id) as f from w group by s having count(*) > 1),
starts as (select doc_id, i from w join firsts using (s) where f < doc_id),
runs as (select doc_id, i, sum(new) over (partition by doc_id order by i) as r from (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as new from starts)),
spans as (select doc_id, r, min(i) as a, max(i) + 50 as b from runs group by doc_id, r),
gaps as (select d.doc_id, s.a, substr(h, 2 * coalesce(lag(s.b) over w, 0) + 1, 2 * (s.a - coalesce(lag(s.b) over w, 0))) as piece, s.b, d.h, d.n from d join spans s using (doc_id) window w as (partition by d.doc_id order by s.a)),
kept as (select doc_id, string_agg(piece, '' order by a) || substr(any_value(h), 2 * max(b) + 1) as k, sum(b - a)::bigint as gone, count(*) as spans from gaps group by doc_id)
select d.doc_id, d.n as n_bytes, coalesce(gone, 0)::bigint as n_removed, coalesce(spans, 0) as n_spans, sha256(unhex(coalesce(k, d.h))) as kept_sha256 from d left join kept using (doc_id)
"""

OP7_SQL = rf"""
with recursive d as (select doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+') as w from documents),
sh as (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s from d, lateral (select unnest(range(1, greatest(len(w) - 2, 2))) as i) where len(w) > 0),
sizes as (select doc_id, count(*) as n from sh group by 1),
pairs as (select a.doc_id as x, b.doc_id as y from (select x.doc_id as a, y.doc_id as b, count(*) as c from sh x join sh y on x.s = y.s and x.doc_id < y.doc_id group by all) p join sizes a on a.doc_id = p.a join sizes b on b.doc_id = p.b where 100 * c >= 85 * (a.n + b.n - c)),
links as (select x, y from pairs union all select y, x from pairs),
reach as (select doc_id as x, doc_id as y from documents union select r.x, l.y from reach r join links l on l.x = r.y)
select d.doc_id, coalesce(n, 0) as n_shingles, c.component_id from d left join sizes using (doc_id) join (select x as doc_id, min(y) as component_id from reach group by 1) c using (doc_id)
"""

OP8_SQL = rf"""
with d as (select doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
iw as (select distinct item_id, least(10, len(w)) as n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as s from b, lateral (select unnest(range(1, len(w) - least(10, len(w)) + 2)) as i) where len(w) > 0),
dw as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as s from d, (select distinct n from iw), lateral (select unnest(range(1, len(w) - n + 2)) as i)),
met as (select doc_id, dw.n, i, item_id from dw join iw on iw.n = dw.n and iw.s = dw.s),
hits as (select doc_id, count(distinct p) as n_hit from (select distinct doc_id, n, i from met), lateral (select unnest(range(i, i + n)) as p) group by 1),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as l from (select distinct doc_id, item_id::varchar as item from met) group by 1)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(l, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated from d left join hits using (doc_id) left join items using (doc_id)
"""

_RULES = ", ".join(f"('{what}', '{host}', '{path}')" for what, host, path in URL_RULES)
_IN = lambda words: "(" + ", ".join(f"'{w}'" for w in words) + ")"

#: Between boundaries, a term of letters is a whole run of letters and digits.
OP10_SQL = f"""
with u as (select page_id, url, coalesce(case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) end, '') as rest from pages),
h as (select page_id, url, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
rules(what, r_host, r_path) as (values {_RULES}),
fits as (select page_id, url, arg_max(r_host || r_path, length(r_host || r_path)) as rule, arg_max(what, length(r_host || r_path)) as what
  from (select distinct page_id, url, host, path from h), rules where (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path) group by page_id, url),
terms as (select page_id, url, count(distinct t) filter (t in {_IN(url_filter.SOFT)} and t not in {_IN(url_filter.STRICT)}) + {url_filter.SOFT_LIMIT} * count(distinct t) filter (t in {_IN(url_filter.STRICT)}) as weight
  from (select distinct page_id, url from h), lateral (select unnest(regexp_extract_all(lower(coalesce(url, '')), '[a-z0-9]+')) as t) group by page_id, url)
select h.page_id, host, path, rule, coalesce(what, case when coalesce(weight, 0) >= {url_filter.SOFT_LIMIT} then 'block' else 'allow' end) as verdict
from h left join fits f on f.page_id = h.page_id and f.url is not distinct from h.url left join terms t on t.page_id = h.page_id and t.url is not distinct from h.url
"""

QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_toxicity": op5_toxicity,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_decontamination": op8_decontamination,
    "op9_html_text": op9_html_text,
    "op10_url_filter": op10_url_filter,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_pii": op12_pii,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {"op1_exact_dedup": OP1_SQL, "op2_suffix_dedup": OP2_SQL, "op7_ngram_jaccard": OP7_SQL, "op8_decontamination": OP8_SQL, "op10_url_filter": OP10_SQL, "op11_merkle_manifest": OP11_SQL}
