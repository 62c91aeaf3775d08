"""Findings of the third round on corpus operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from clustrata.llm import jaccard_join, suffix_dedup, toxicity


def test_toxicity_learns_from_every_label(spark):
    """a word of toxic rows that lie beyond any bound on the rows learned from."""
    ids = spark.range(6800).select(F.col("id").alias("doc_id"))
    toxic = F.col("doc_id") % 2 == 0
    last = [r["doc_id"] for r in ids.where(toxic).orderBy(F.xxhash64("doc_id"), "doc_id").collect()[3000:]]
    text = F.when(~toxic, "some fine words").when(F.col("doc_id").isin(last), "some qzxv words").otherwise("some awful words")
    docs = ids.select("doc_id", text.alias("text"), F.lit("en").alias("lang"))
    model = toxicity.train(docs, ids.select("doc_id", toxic.cast("int").alias("toxic")))
    got = {r["text"]: r["toxicity"] for r in toxicity.score(docs.dropDuplicates(["text"]), model).collect()}
    assert got["some qzxv words"] > 0.9 and got["some awful words"] > 0.9 and got["some fine words"] < 0.1


def test_parities_lose_no_link():
    rng = np.random.default_rng(3)
    draw = lambda n: np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
    linked = unlinked = 0
    for n in rng.integers(1, 1500, 300).tolist():
        one = draw(n)
        two = np.union1d(one[rng.random(len(one)) > rng.random() * 0.2], draw(1 + n // 20))
        sets = [one, two, draw(n)]
        sizes = np.array([len(x) for x in sets])
        bits = [jaccard_join.parities(jaccard_join.packed(jaccard_join.counts_of(x))) for x in sets]
        near = jaccard_join.near_others(bits, sizes, np.arange(3), np.arange(3), 80)
        if jaccard_join.common(one, two) >= jaccard_join.least_common(len(one), len(two), 80):
            linked += 1
            assert near[:2].all()
        unlinked += n > 40 and not near[2]
    assert linked > 50 and unlinked > 250


def test_near_copies_store_no_grams_with_trees(spark, monkeypatch):
    """Pages that lie over many tasks, trees of few sets: the same classes, and no n-grams written with the trees."""
    seen, write = {}, jaccard_join.materialise

    def watched(df, name, *rest):
        seen.setdefault(name, df.columns)
        return write(df, name, *rest)

    monkeypatch.setattr(jaccard_join, "materialise", watched)
    monkeypatch.setattr(jaccard_join, "TILE", 5)
    rng = np.random.default_rng(5)
    rows = []
    for k in range(12):
        base = [f"w{x}" for x in rng.integers(0, 10_000, 120)]
        for c in range(14):
            own = list(base)
            own[int(rng.integers(0, 120))] = f"x{k}y{c}"
            rows.append((100 * k + c, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs, 5, 80).collect()}
    assert got == {i: i - i % 100 for i, _ in rows}
    assert "grams" not in seen["grown"]


def prose(rng, words):
    return " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(words))


def test_suffix_dedup_moves_texts_alike_at_every_size(spark):
    """Texts meet what documents need by a shuffle, at a small size too, so disk grows with the input; ids may be strings."""
    rng = np.random.default_rng(7)
    shared = [prose(rng, 60) for _ in range(6)]
    rows = [(f"d{k:03}", prose(rng, k % 9) + shared[k % 6][k % 31 :] + prose(rng, 5)) for k in range(90)] + [("d001", shared[2])] * 2
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id string, text string").repartition(5))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "ShuffledHashJoin" in plan
    got = [(r["doc_id"], r["text"], bytes(r["kept_bytes"])) for r in out.collect()]
    first: dict[bytes, str] = {}
    strings = lambda t: [t.encode()[k : k + 50] for k in range(len(t.encode()) - 49)]
    for i, t in rows:
        for s in strings(t):
            first[s] = min(i, first.get(s, i))
    assert len(got) == len(rows)
    for i, t, kept in got:
        gone = np.zeros(len(t), bool)
        for k, s in enumerate(strings(t)):
            gone[k : k + 50] |= first[s] < i
        assert kept == bytes(b for b, g in zip(t.encode(), gone, strict=True) if not g), i


def test_copies_in_one_task_mark_no_places(spark, monkeypatch):
    """Copies of a text that lie in different passes of one task share chunks only: no hash of theirs makes excerpts."""
    monkeypatch.setattr(suffix_dedup, "SLICE", 1 << 12)
    rng = np.random.default_rng(8)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    copy = letters(3000)
    other = [(letters(3000),) for _ in range(9)]
    marked = lambda rows: suffix_dedup._shared_fingerprints(spark.createDataFrame(rows, "text string").coalesce(1), 4).count()
    alone = marked([(copy,), *other])  # places whose strings start in three chunks
    assert marked([(copy,), *other, (copy,)]) == alone < 20
    assert marked([(copy,), *other, (letters(300) + copy[100:400] + letters(300),)]) >= alone + 15


def test_least_ids_by_brute_force():
    rng = np.random.default_rng(9)
    for _ in range(40):
        base = rng.integers(0, 256, 160).astype(np.uint8).tobytes()
        excerpts = list({base[a : a + int(n)] for a, n in zip(rng.integers(0, 60, 25), rng.integers(30, 100, 25), strict=True)} | {bytes(75), bytes([255]) * 61, bytes([255]) * 62})
        ids = rng.integers(0, 12, len(excerpts))
        least: dict[bytes, int] = {}
        for x, i in zip(excerpts, ids.tolist(), strict=True):
            for k in range(len(x) - 49):
                least[x[k : k + 50]] = min(i, least.get(x[k : k + 50], i))
        want = {(e, k, least[x[k : k + 50]]) for e, x in enumerate(excerpts) for k in range(len(x) - 49) if least[x[k : k + 50]] < ids[e]}
        joined, offsets = np.frombuffer(b"".join(excerpts), np.uint8), np.r_[0, np.cumsum([len(x) for x in excerpts])]
        who, a, b, lower = suffix_dedup.least_ids(joined, offsets, ids)
        assert {(e, k, m) for e, a, b, m in zip(who.tolist(), a.tolist(), b.tolist(), lower.tolist(), strict=True) for k in range(a, b)} == want


def test_selected_hashes_fill_all_shards():
    """Selected hashes are least ones; shards by their first bits hold alike many, and different hashes stay different."""
    data = np.random.default_rng(10).integers(0, 256, 200_000).astype(np.uint8)
    text = suffix_dedup._Text(data, np.array([0, len(data)]))
    gram = np.unique(text.gram[text.selected()[0]] >> np.uint64(64 - suffix_dedup._F_BITS) << np.uint64(64 - suffix_dedup._F_BITS))
    f = suffix_dedup._fingerprint(gram)
    assert len(np.unique(f)) == len(gram) and int(f.max()) < 1 << suffix_dedup._F_BITS
    many = np.bincount((f >> np.uint64(suffix_dedup._F_BITS - 4)).astype(np.int64), minlength=16)
    assert many.max() < 1.3 * many.mean() and many.min() > 0.7 * many.mean()
