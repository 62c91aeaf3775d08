"""The corpus operators against plain versions, on texts with all the odd cases."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from clustrata.llm import bpe, common, components, decontam, exact_dedup, jaccard_join, line_dedup, ngram_lm, suffix_dedup, toxicity, url_filter
from clustrata.llm.elias_fano import EliasFano, Trie
from clustrata.llm.html_extract import extract
from clustrata.llm.suffix_array import suffix_array

from . import plain

SYLLABLES = "the of ing er ré ón stra be na to ko lu".split()


def prose(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.choice([1, 1, 2, 3]))) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", ". ", "\n", "  "]) for w in words)


def corpus(seed: int = 1) -> list[tuple[int, str | None]]:
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([3, 12, 40, 90, 200])) for _ in range(30)]
    texts: list[str | None] = list(base)
    for t in base[:20]:
        w = t.split(" ")
        for _ in range(3):
            v = list(w)
            for _ in range(rng.choice([0, 1, 1, 2])):
                k = rng.randrange(len(v))
                rng.choice([lambda k=k: v.__setitem__(k, "neu"), lambda k=k: v.insert(k, "mehr"), lambda k=k: v.pop(k) if len(v) > 1 else None])()
            texts.append(" ".join(v))
        texts.append(t.upper())
        texts.append(t.replace(" ", "\t "))
    passage = prose(rng, 30)
    texts += [prose(rng, 20) + passage + prose(rng, 20) for _ in range(12)]
    texts += [None, None, "", "", " ", "\n\n", "one", "One", "a b c", "x" * 300, "x" * 400, "ab" * 200, "of of of of of of of of of of of of of"]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


ROWS = corpus()


def frame(spark, rows, extra: bool = True):
    """Documents with columns whose names clash with those that the operators use inside."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    data = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    df = spark.createDataFrame(data, schema).repartition(5)
    if extra:
        from pyspark.sql import functions as F

        for name in ("h", "n", "size", "win", "_h", "node", "id", "key", "kept", "place", "sig", "vector", "spans", "items", "words", "toxicity_", "gone", "cuts"):
            df = df.withColumn(name, F.lit(7))
    return df


def empty(spark):
    return frame(spark, [])


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.select("doc_id", *columns).collect()}


def test_exact_dedup(spark):
    got = by_id(exact_dedup.exact_dedup(frame(spark, ROWS)), "keep_id", "group_size", "kept")
    assert got == plain.exact(ROWS)
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_exact_dedup_hot_and_repeated(spark):
    rows = [(i, "hot text" if i % 2 else "hot  text") for i in range(400)] + [(1, "hot text"), (0, "hot  text"), (None, "hot  text"), (None, "lone"), (5000, "lone")]
    df = frame(spark, rows)
    out = exact_dedup.exact_dedup(df).collect()
    hot = [r for r in out if r["group_size"] > 2]
    assert len(out) == len(rows) and len(hot) == 403 and {r["group_size"] for r in hot} == {403}
    assert sum(r["kept"] for r in hot) == 1 and {r["keep_id"] for r in hot} == {0}
    lone = [r for r in out if r["group_size"] == 2]
    assert [r["keep_id"] for r in lone] == [5000, 5000] and sum(r["kept"] for r in lone) == 1
    left = exact_dedup.drop_copies(df)
    assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == [0, 5000]


def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a = rng.integers(1, rng.integers(2, 5), rng.integers(0, 40))
        assert suffix_array(a).tolist() == sorted(range(len(a)), key=lambda i: a[i:].tolist())


def test_suffix_dedup(spark):
    got = by_id(suffix_dedup.remove_repeats(frame(spark, ROWS)), "n_bytes", "n_removed", "kept_bytes")
    want = plain.repeats(ROWS)
    for i, t in ROWS:
        n = len((t or "").encode())
        assert got[i] == (n, n - len(want[i]), want[i]), i
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_suffix_dedup_shared_edges(spark):
    rng = random.Random(5)
    seam = prose(rng, 25)
    rows = [(i, prose(rng, rng.randrange(30)) + seam[: rng.randrange(40, len(seam))] + prose(rng, rng.randrange(30))) for i in range(60)]
    got = by_id(suffix_dedup.remove_repeats(frame(spark, rows)), "kept_bytes", "n_spans")
    want = plain.repeats(rows)
    assert {i: x[0] for i, x in got.items()} == want
    rows = [(None, seam * 2), (None, seam * 2), (4, seam * 2), (4, seam * 2), (5, seam * 2)]
    out = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"] > 0) for r in out) == [(0, False), (0, False), (4, False), (4, False), (5, True)]


def test_line_dedup(spark):
    got = by_id(line_dedup.dedup_lines(frame(spark, ROWS)), "kept_text", "n_lines", "n_dropped")
    want = plain.kept_lines(ROWS)
    for i, t in ROWS:
        lines = (t or "").split("\n")
        assert got[i][:2] == (want[i], len(lines)), i
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_line_dedup_edits(spark):
    rng = random.Random(3)
    line = "a b c d e f g h".split()
    rows = []
    for i in range(60):
        v = list(line)
        for _ in range(rng.choice([0, 1, 2, 3])):
            k = rng.randrange(len(v))
            rng.choice([lambda k=k: v.__setitem__(k, rng.choice("xyz")), lambda k=k: v.insert(k, rng.choice("xyz")), lambda k=k: v.pop(k)])()
        rows.append((i, " ".join(v)))
    got = by_id(line_dedup.dedup_lines(frame(spark, rows)), "kept_text")
    assert {i: x[0] for i, x in got.items()} == plain.kept_lines(rows)


def test_elias_fano():
    rng = np.random.default_rng(2)
    for n, u in ((0, 10), (1, 1), (5, 3), (1000, 1 << 40), (4000, 5000), (3000, 1 << 62)):
        values = np.sort(rng.integers(0, u, n).astype(np.uint64))
        ef = EliasFano.of(values, u)
        assert (ef.get(np.arange(n)) == values).all()
        ask = np.concatenate([values, rng.integers(0, u, 200).astype(np.uint64)])
        at = np.searchsorted(values, ask)
        want = np.where((at < n) & (values[np.minimum(at, n - 1)] == ask) if n else np.zeros(len(ask), bool), at, -1)
        assert (ef.find(ask) == want).all()


def test_trie_maps_to_a_file(tmp_path):
    rng = np.random.default_rng(4)
    keys = np.unique((rng.integers(0, 50, 3000).astype(np.uint64) << np.uint64(32)) | rng.integers(0, 400, 3000).astype(np.uint64))
    trie = ngram_lm.build_trie(keys, rng.integers(1, 6, len(keys)))
    (tmp_path / "trie").write_bytes(trie.tobytes())
    back = Trie.view(np.memmap(tmp_path / "trie", np.uint8, "r"))
    place = back.context(keys >> np.uint64(32))
    assert (back.lookup(place, keys & np.uint64(0xFFFFFFFF)) == trie.codes).all()
    assert (back.degree(np.arange(50)) == np.bincount((keys >> np.uint64(32)).astype(np.int64))).all()
    assert back.context(np.array([77], np.uint64)).tolist() == [-1]


def test_lm_scores(spark):
    from pyspark.sql import functions as F

    rows = [*ROWS, (ROWS[0][0], ROWS[0][1]), (None, "the the")]
    train = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 1
    out = ngram_lm.score_texts(frame(spark, rows), train).collect()
    assert len(out) == len(rows)
    tokens = lambda t: [*plain.WORD.findall(plain.lower(t)), None]
    learned = [i is not None and zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    counts, pairs = Counter(), Counter()
    for (_, t), use in zip(rows, learned, strict=True):
        if use:
            w = tokens(t)
            counts.update(w)
            pairs.update(zip([0, *w], w, strict=False))
    n, v = sum(counts.values()), len(counts)
    d = [0, *ngram_lm.discounts(np.array(list(pairs.values())))]
    total, mass = Counter(), Counter()
    for (a, _), c in pairs.items():
        total[a] += c
        mass[a] += d[min(c, 3)]
    want = {}
    for i, t in rows:
        w = tokens(t)
        p1 = [(counts[x] + 0.5) / (n + 0.5 * (v + 1)) for x in w]
        p = [(max(pairs[a, b] - d[min(pairs[a, b], 3)], 0) + mass[a] * q) / total[a] if total[a] else q for a, b, q in zip([0, *w], w, p1, strict=False)]
        want[i] = (len(w), sum(counts[x] > 0 for x in w), n, sum(map(math.log10, p1)), sum(map(math.log10, p)))
    for r in out:
        x = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == x[:3]
        assert r["base_score"] == pytest.approx(x[3], rel=1e-9) and r["score"] == pytest.approx(x[4], rel=2e-3)
    assert ngram_lm.score_texts(empty(spark), train).count() == 0
    untrained = ngram_lm.score_texts(frame(spark, [(1, "a b")]), F.lit(False)).first()
    assert untrained["base_score"] == untrained["score"] == 0.0 and untrained["train_tokens"] == 0


def test_lm_split_contexts(spark, monkeypatch):
    """With many shards a frequent context is split over several; probabilities stay proper."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 200)
    many = {r["doc_id"]: r for r in ngram_lm.score_texts(frame(spark, ROWS), F.col("doc_id") % 2 == 0).collect()}
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 1 << 20)
    one = {r["doc_id"]: r for r in ngram_lm.score_texts(frame(spark, ROWS), F.col("doc_id") % 2 == 0).collect()}
    for i, r in one.items():
        assert many[i]["base_score"] == pytest.approx(r["base_score"], rel=1e-12)
        assert many[i]["score"] == pytest.approx(r["score"], rel=1e-12)


def labelled(n: int, seed: int):
    rng = random.Random(seed)
    bad = {"en": ["grumpf", "zorkish"], "de": ["knarzelig", "knarzelung"]}
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice(["en", "de"])
        words = prose(rng, rng.randrange(1, 80)).split() or ["x"]
        toxic = rng.random() < 0.3
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(bad[lang]))
        rows.append((i, " ".join(words), lang, "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = labelled(600, 3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    marks = spark.createDataFrame([*labels, (1, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    from pyspark.sql import functions as F

    model = toxicity.train(docs, marks, F.col("doc_id") < 400)
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model).collect()}
    right = sum((got[i] >= 0.5) == bool(y) for i, _, y in labels[400:])
    assert right >= 190  # of 200 held-out rows
    odd = toxicity.score(frame(spark, ROWS), model)
    assert all(0 <= r["toxicity"] <= 1 for r in odd.collect()) and odd.count() == len(ROWS)
    assert toxicity.score(empty(spark), model).count() == 0
    nothing = toxicity.train(docs, marks.where("false"))
    assert all(r["toxicity"] < 1e-9 for r in toxicity.score(docs, nothing).collect())
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns and 350 < left.count() < 480


RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 16, 512), (64, 16), (40, 8)])
def test_bpe(spark, chunk, overlap):
    plain_encoder = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    rows = [*ROWS, (9001, "a" * 500 + "     " + "b" * 10), (9002, " " * 333), (9003, "\n \n" * 90 + "é" * 77), (9004, "<|endoftext|> 123 don't we'll 日本語 🎉" * 9), ROWS[0]]
    out = bpe.encode(frame(spark, rows), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True, chunk=chunk, overlap=overlap).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        text = texts[r["doc_id"]] or ""
        ids = plain_encoder.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_ids(spark):
    df = bpe.encode(frame(spark, [(1, "of the"), (2, None)]), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = {r["doc_id"]: r["ids"] for r in df.collect()}
    vocabulary = bpe.Vocabulary(RANKS, public_tokenizers.PATTERN)
    assert vocabulary.decode(np.array(got[1])) == b"of the" and got[2] == []
    assert bpe.encode(empty(spark), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (1, 60)])
def test_jaccard_components(spark, n, percent):
    got = by_id(jaccard_join.jaccard_components(frame(spark, ROWS), n, percent), "n_shingles", "component_id")
    want = plain.classes(ROWS, n, percent)
    assert got == {i: (len(plain.shingles(t, n)), want[i]) for i, t in ROWS}


def test_jaccard_chains_and_tiles(spark, monkeypatch):
    """A chain whose ends don't link, and tiles smaller than the blocks."""
    words = [f"w{i}" for i in range(140)]
    rows = [(i, " ".join(words[i * 2 : i * 2 + 60])) for i in range(40)]
    monkeypatch.setattr(jaccard_join, "TILE", 7)
    got = by_id(jaccard_join.jaccard_components(frame(spark, rows), 4, 85), "component_id")
    assert {i: x[0] for i, x in got.items()} == plain.classes(rows, 4, 85)
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


def test_drop_near_copies(spark):
    rows = [*ROWS, ROWS[0], ROWS[0], (None, "lone words that nobody else has here"), (None, "lone words that nobody else has here")]
    df = frame(spark, rows)
    left = jaccard_join.drop_near_copies(df, 5, 80)
    assert left.columns == df.columns
    want = plain.classes(ROWS, 5, 80)
    wordless = [i for i, t in ROWS if not plain.shingles(t, 5)]
    got = sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None)
    assert got == sorted({*want.values(), *wordless})


def test_rtree_is_lossless():
    rng = np.random.default_rng(8)
    sets = [rng.choice(400, rng.integers(50, 90), replace=False).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(60)]
    sets += [np.append(s[4:], np.uint64(k)) for k, s in enumerate(sets[:30])]
    sets.sort(key=len)
    points = np.stack([np.bincount((s >> np.uint64(20)).astype(np.int64) & 15, minlength=16) for s in sets])
    tree = jaccard_join.RTree(points, np.array([len(s) for s in sets]))
    for i, s in enumerate(sets):
        linked = {j for j in range(i + 1, len(sets)) if 100 * len(np.intersect1d(s, sets[j])) >= 85 * len(np.union1d(s, sets[j]))}
        at, bound = tree.search(points[i], len(s), 85)
        assert linked <= set(at.tolist()) and all(b >= len(np.intersect1d(s, sets[j])) for j, b in zip(at.tolist(), bound.tolist(), strict=True))


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_linked_sets_share_a_page(percent):
    rng = np.random.default_rng(percent)
    for size in [2, 3, 6, 7, 8, 11, 20, 55, 180, 700, 5000]:
        for _ in range(20):
            whole = np.unique(rng.integers(0, 2**64, size, np.uint64))
            lost = int(rng.integers(0, len(whole) * (100 - percent) // 100 + 1))
            other = np.unique(np.concatenate([whole[rng.permutation(len(whole))[lost:]], rng.integers(0, 2**64, int(rng.integers(0, 3)), np.uint64)]))
            both = jaccard_join.common(whole, other)
            if 100 * both >= percent * (len(whole) + len(other) - both) and not np.array_equal(whole, other):
                names, owner = jaccard_join.page_names([whole, other], percent)
                assert np.intersect1d(names[owner == 0], names[owner == 1]).size


def test_trees_join_what_links(spark, monkeypatch):
    """Large groups of near copies of a text, in many small trees; what they leave apart is found across trees."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(90)]
    rows = [(0, " ".join(base))]
    for i in range(1, 90):
        words = list(base)
        words[int(rng.integers(0, 90))] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join([*base[:70], *(f"y{i % 5}.{k}" for k in range(20)), f"z{i}"])) for i in range(60)]
    want = plain.classes(rows, 4, 85)
    for tile in (512, 6):
        monkeypatch.setattr(jaccard_join, "TILE", tile)
        got = by_id(jaccard_join.jaccard_components(frame(spark, rows), 4, 85), "component_id")
        assert {i: x[0] for i, x in got.items()} == want
    sets = list(jaccard_join.gram_sets(*common.utf8(pa.array([t for _, t in rows])), 4))
    whole = jaccard_join.joined(sets, 85)
    assert [rows[i][0] for i in whole.tolist()] == [want[i] for i, _ in rows]
    monkeypatch.setattr(jaccard_join.RTree, "search", lambda self, q, size, percent: (np.zeros(0, int), np.zeros(0, int)))
    assert len(set(jaccard_join.joined(sets, 85).tolist())) == len(sets)


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (10, 9), (9, 8), (7, 7), (5, 1), (20, 30), (30, 20), (None, 3)]
    got = {(r["node"], r["root"]) for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {*((i, 1) for i in range(1, 6)), *((i, 8) for i in (8, 9, 10)), (20, 20), (30, 20)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


ITEMS = [(1, "Of the ing er be na to ko lu the of stra"), (2, "seven of nine"), (3, "x"), (4, None), (5, "..."), (6, "seven of nine"), (None, "lu lu lu lu lu lu lu lu lu lu lu")]


@pytest.mark.parametrize("block", [1 << 20, 2])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK", block)
    rows = [*ROWS, (9001, "so: of THE ing er, be na to ko lu the of stra of"), (9002, "seven of nine x"), (9003, " ".join(["lu"] * 14))]
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = by_id(decontam.find_contamination(frame(spark, rows), items), "n_words", "n_hit", "items")
    for i, t in rows:
        n, hit, found = plain.hits(t, ITEMS)
        assert got[i] == (n, hit, [x for x in found if x != "None"]), i
    clean = decontam.decontaminate(frame(spark, rows), items)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, t in rows if not plain.hits(t, ITEMS)[1]}
    assert decontam.find_contamination(empty(spark), items).count() == 0
    assert decontam.decontaminate(frame(spark, rows), items.where("false")).count() == len(rows)


PAGES = [
    ("<html><body><nav><a href=x>menu</a></nav><article><h1>Head &amp; tail</h1><p>First <b>bold</b>\n text.<p>So.</article><footer>foot</footer>", ["Head & tail", "First bold text.", "So."]),
    ("<body><header>Site</header><div class='sidebar'>side</div><main><p>Main text that is long enough to count.</p><form>q<input></form><div id=comments><p>nice comment</p></div></main></body>", ["Main text that is long enough to count."]),
    ("<body><div class=menu><a>a</a><a>b</a></div><div class=content><p>A long paragraph of plain text, with many words in it.</p><p>Short.</p></div><div class='cookie-notice'>cookies</div></body>", ["A long paragraph of plain text, with many words in it.", "Short."]),
    ("<script>var t='<p>no</p>'</script><style>p{}</style>", []),
    ("<nav><ul><li>open menu<article><p>Still found &eacute;&nbsp;x</p>", ["Still found é x"]),
    ("plain text only", ["plain text only"]),
    ("", []),
    (None, []),
    ("<article><p>cut of", ["cut of"]),
    ("<p hidden>no</p><article><p>yes yes yes</p><aside>no</aside><p aria-hidden=true>no</p></article>", ["yes yes yes"]),
]


@pytest.mark.parametrize(("html", "want"), PAGES)
def test_html(html, want):
    assert extract(html) == want


def test_html_frame(spark):
    from clustrata.llm.html_extract import extract_text

    df = spark.createDataFrame([(i, "u", h, 5) for i, (h, _) in enumerate(PAGES)], "page_id bigint, url string, html string, text int")
    out = extract_text(df)
    assert out.columns == ["page_id", "url", "text", "main_text"]
    assert {r["page_id"]: r["main_text"] for r in out.collect()} == {i: "\n".join(w) for i, (_, w) in enumerate(PAGES)}
    assert extract_text(df.where("false")).count() == 0


URLS = [
    ("http://A.Example.com/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
    ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://m.www.example.com/en/1", "m.www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://example.com/de/", "example.com", "/de/", "com/", "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://notexample.net/es/a", "notexample.net", "/es/a", "net/es/", "block"),
    ("http://casino-win.example.org/x", "casino-win.example.org", "/x", None, "block"),
    ("http://free-bets.example.org/", "free-bets.example.org", "/", None, "block"),
    ("http://freebets.example.org/", "freebets.example.org", "/", None, "allow"),
    ("http://essex-county.example.org/sex", "essex-county.example.org", "/sex", None, "allow"),
    ("http://x.org/sex/sexy", "x.org", "/sex/sexy", None, "block"),
    ("http://x.org?a=://b/c", "x.org", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_urls(spark):
    from clustrata.llm.queries import URL_RULES

    df = spark.createDataFrame([(i, x[0], "clash") for i, x in enumerate(URLS)], "page_id bigint, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.url_filter(df, URL_RULES).collect()}
    assert got == {i: x[1:] for i, x in enumerate(URLS)}
    assert url_filter.url_filter(df.where("false"), URL_RULES).count() == 0
    assert {r["verdict"] for r in url_filter.url_filter(df, strict=[], soft=[]).collect()} == {"allow"}
