"""The registered queries and the stages of the pipeline, over whole small tables, against plain versions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from clustrata.llm import queries
from clustrata.llm.html_extract import extract

from . import plain
from .test_operators import RANKS

SF = "/root/testdata/sf0.001"
digest = lambda b: hashlib.sha256(b).hexdigest()


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]


def result(spark, name):
    found = [r.asDict() for r in queries.QUERIES[name](spark, SF).collect()]
    return found, {next(iter(r.values())): r for r in found}


def test_repeats_query(spark, rows):
    found, by_id = result(spark, "op2_suffix_dedup")
    want = plain.repeats(rows)
    assert len(found) == len(rows)
    for i, t in rows:
        whole, r = (t or "").encode(), by_id[i]
        assert (r["n_bytes"], r["n_removed"], r["kept_sha256"]) == (len(whole), len(whole) - len(want[i]), digest(want[i]))
        assert (r["n_spans"] > 0) == (r["n_removed"] > 0) and r["n_spans"] * 50 <= r["n_removed"]


def test_lines_query(spark, rows):
    found, by_id = result(spark, "op3_line_dedup")
    want = plain.kept_lines(rows)
    assert {i: r["kept_sha256"] for i, r in by_id.items()} == {i: digest(want[i].encode()) for i, _ in rows} and len(found) == len(rows)


def test_language_model_query(spark, rows):
    found, by_id = result(spark, "op4_lm_scoring")
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    words = {i: [*plain.WORD.findall(plain.lower(t)), None] for i, t in rows}
    counts = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in words.items():
        r = by_id[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
        assert r["score"] <= 0
    out = [r for r in found if r["held_out"]]
    assert len(found) == len(rows) and sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_toxicity_query(spark, rows):
    found, by_id = result(spark, "op5_toxicity")
    assert set(by_id) == {i for i, _ in rows}
    for i, r in by_id.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_encoding_query(spark, rows):
    found, by_id = result(spark, "op6_byte_bpe")
    reference = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        assert (by_id[i]["n_tokens"], by_id[i]["ids_sha256"], by_id[i]["decoded_sha256"]) == (len(ids), digest(b"".join(x.to_bytes(4, "little") for x in ids)), digest((t or "").encode()))


def test_similarity_query(spark, rows):
    found, by_id = result(spark, "op7_ngram_jaccard")
    want = plain.classes(rows, 4, 85)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in by_id.items()} == {i: (len(plain.shingles(t, 4)), want[i]) for i, t in rows}


def test_contamination_query(spark, rows):
    found, by_id = result(spark, "op8_decontamination")
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SF, "benchmark").collect()]
    for i, t in rows:
        n, hit, names = plain.hits(t, items)
        r = by_id[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n, hit, len(names), digest(",".join(names).encode()), hit > 0)


def test_pages_queries(spark):
    pages = queries.table(spark, SF, "pages").collect()
    texts = result(spark, "op9_html_text")[1]
    verdicts = result(spark, "op10_url_filter")[1]
    for p in pages:
        text = "\n".join(extract(p["html"]))
        assert (texts[p["page_id"]]["url"], texts[p["page_id"]]["text"], texts[p["page_id"]]["n_chars"]) == (p["url"], text, len(text))
        url, at = p["url"] or "", (p["url"] or "").find("://")
        host = re.split(r"[/?#]", url[at + 3 :])[0] if at >= 0 else ""
        path = re.split(r"[?#]", url[at + 3 + len(host) :])[0] if at >= 0 else ""
        host = plain.lower(host)
        fits = [(len(h + s), h + s, v) for v, h, s in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(s)]
        r = verdicts[p["page_id"]]
        assert (r["host"], r["path"]) == (host, path)
        if fits:
            assert (r["rule"], r["verdict"]) == max(fits)[1:]
        else:
            assert r["rule"] is None and r["verdict"] in ("allow", "block")


def test_pipeline_stages(spark):
    """Each stage on all that the one before kept, with odd rows; all but the last return the columns of documents."""
    docs = queries.table(spark, SF, "documents")
    odd = [(900_001, None), (900_002, ""), (900_003, None), (900_004, "lone"), (900_005, "x " * 30_000), (900_006, "x " * 30_000), (900_007, "\n\t")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, None, None, None) for i, t in odd], "doc_id bigint, text string, lang string, source string, n_chars bigint").select(docs.columns))
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        out = corpus_pipeline.materialise(stage(spark, docs, SF), f"test-{name}")
        after = sorted(r["doc_id"] for r in out.select("doc_id").collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        if name == "toxicity":
            assert set(after) < {i for i, _ in before} and len(after) > 0.8 * len(before)
        elif name == "exact_dedup":
            assert after == sorted(i for i, (_, _, kept) in plain.exact(before).items() if kept)
        elif name == "ngram_jaccard":
            assert after == sorted({*plain.classes(before, 5, 80).values()})
        elif name == "decontamination":
            assert after == sorted(i for i, t in before if not plain.hits(t, items)[1])
        else:
            assert after == sorted(i for i, _ in before) and all(r["exact"] for r in out.collect())
        docs = out
    empty = queries.table(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
