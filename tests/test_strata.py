"""Stratified tests of scores, and enrichment of many rankings in many collections."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clustrata.operators import association, signatures


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(4)
    scores = spark.createDataFrame([(m, s, i, None if i == 3 else float(np.round(rng.normal() + (i % 3) * (s == "a"), 1))) for m in ("mean", "ssgsea") for s in ("a", "b") for i in range(40)], "method string, signature string, sample int, score double")
    partition = spark.createDataFrame([(k, i, i % k + 1) for k in (2, 3) for i in range(40)], "k int, sample int, cluster int")
    meta = spark.createDataFrame([(i, "xyz"[i % 3] if i % 5 else None, "rare" if i < 2 else "all", float(i)) for i in range(40)], "sample int, arm string, lone string, age double")
    return scores, partition, meta


def test_strata(spark, tables):
    _, partition, meta = tables
    strata = association.strata_table(partition, meta, ["arm", "lone"])
    assert {(r["stratification"], r["level"]) for r in strata.select("stratification", "level").distinct().collect()} == {("k2", "C1"), ("k2", "C2"), ("k3", "C1"), ("k3", "C2"), ("k3", "C3"), ("arm", "x"), ("arm", "y"), ("arm", "z")}
    assert association.strata_table(None, meta, ["arm"]).count() == 32
    with pytest.raises(ValueError):
        association.strata_table(None, meta, [])


def test_views_agree_with_single_tests(tables):
    scores, partition, meta = tables
    found = association.stratified_tests(scores, association.strata_table(partition, meta, ["arm"]), keys=["method"]).cache()
    for name, groups in (("k3", partition.where("k = 3").select("sample", F.concat(F.lit("C"), "cluster").alias("level"))), ("arm", meta.select("sample", F.col("arm").alias("level")))):
        own = scores.where("method = 'mean'").drop("method")
        got = {(r["kind"], r["signature"], r["contrast"]): r for r in found.where((F.col("stratification") == name) & (F.col("method") == "mean")).collect()}
        for r in association.rank_tests_one_vs_rest(own, groups).collect():
            g = got.pop(("ova", r["signature"], f"{r['level']} vs rest"))
            assert (g["n1"], g["n2"], g["u"]) == (r["n1"], r["n2"], r["u"]) and g["p"] == pytest.approx(r["p"]) and g["effect"] == pytest.approx(r["rank_biserial"])
        for r in association.rank_tests_pairs(own, groups).collect():
            g = got.pop(("ovo", r["signature"], f"{r['level1']} vs {r['level2']}"))
            assert g["u"] == r["u"] and g["p"] == pytest.approx(r["p"])
        assert not got
    for r in found.groupBy("method", "stratification", "kind").agg(F.collect_list(F.struct("p", "q")).alias("l")).collect():
        p, n = sorted((x["p"], x["q"]) for x in r["l"]), len(r["l"])  # each family by itself
        assert [q for _, q in p] == pytest.approx([min(1.0, min(n * x / (k + 1) for k, (x, _) in enumerate(p) if k >= i)) for i in range(n)])


def test_small_levels_have_no_p(spark):
    scores = spark.createDataFrame([("s", i, float(i)) for i in range(8)], "signature string, sample int, score double")
    strata = spark.createDataFrame([("v", i, "a" if i < 2 else "b") for i in range(8)], "stratification string, sample int, level string")
    got = {(r["kind"], r["contrast"]): (r["u"], r["p"], r["stars"]) for r in association.stratified_tests(scores, strata).collect()}
    assert got == {("ova", "a vs rest"): (0.0, None, ""), ("ova", "b vs rest"): (12.0, None, "")}


@pytest.fixture(scope="module")
def rankings(spark):
    rng = np.random.default_rng(1)
    rows = [(d, f"IC{c:02d}", f"g{j:03d}", float(rng.normal() + (3 if j < 20 and c == 1 else 0))) for d in (6, 8) for c in (1, 2) for j in range(120)]
    lists = spark.createDataFrame(rows, "dimension int, component string, gene string, score double").cache()
    sets = [("h", "TOP", f"g{j:03d}") for j in range(20)] + [("c2", "TOP", f"g{j:03d}") for j in range(40, 60)] + [("c2", "MIXED", f"g{j:03d}") for j in range(0, 120, 6)] + [("none", "FEW", "g001")]
    return lists, spark.createDataFrame(sets, "collection string, signature string, gene string").cache()


def test_all_rankings_in_all_collections(rankings):
    lists, sets = rankings
    keys = ["dimension", "component"]
    found = signatures.gsea_by_collection(lists, sets, keys, 100, 5, 500).cache()
    assert found.schema["dimension"].dataType == lists.schema["dimension"].dataType and found.count() == 2 * 2 * 3
    got = {(r["dimension"], r["component"], r["collection"], r["signature"]): r for r in found.collect()}
    for d in (6, 8):  # a set of the same name in another collection is another set
        top, other = got[d, "IC01", "h", "TOP"], got[d, "IC01", "c2", "TOP"]
        assert top["nes"] > 1.5 and top["fdr_q"] < 0.05 and "g000" in top["lead_genes"] and other["es"] < top["es"]
    alone = {r["signature"]: r for r in signatures.gsea_prerank(lists.where("dimension = 6 and component = 'IC02'").select(F.lit("r").alias("ranking"), "gene", "score"), sets.where("collection = 'c2'").select("signature", "gene"), 100, 5, 500).collect()}
    for name, r in alone.items():
        g = got[6, "IC02", "c2", name]
        assert (g["size"], g["es"], g["nes"], g["fdr_q"]) == pytest.approx((r["size"], r["es"], r["nes"], r["fdr_q"]))
    manifest = {(r["dimension"], r["component"], r["collection"]): (r["status"], r["n_pathways"]) for r in signatures.collection_manifest(lists, sets, found, keys).collect()}
    assert len(manifest) == 12 and manifest[8, "IC02", "c2"] == ("ok", 2) and manifest[6, "IC01", "none"] == ("empty", 0)
    fewer = signatures.collection_manifest(lists.where("dimension = 6"), sets, found, keys)
    assert fewer.where("status = 'unexpected'").count() == 4
    with pytest.raises(ValueError):
        signatures.gsea_by_collection(lists, sets, keys, 10, 9, 5)


def test_a_ranking_without_results_ends_the_run(spark, tmp_path, rankings):
    from clustrata.plans import config
    from clustrata.plans.pipeline import Pipeline

    lists, _ = rankings
    (tmp_path / "h.gmt").write_text("TOP\tna\t" + "\t".join(f"g{j:03d}" for j in range(20)) + "\n")
    options = {o.name: o.default for o in config.OPTIONS.values()} | dict.fromkeys(config.BLOCKS) | {"outdir": str(tmp_path / "out"), "gsea_permutations": 20}
    run = Pipeline(spark, options)
    files = {"h": str(tmp_path / "h.gmt")}
    run._enrich(lists, ["dimension", "component"], "ok_gsea", 5, 500, files, whole=True)
    assert run.results["ok_gsea_manifest"].where("status = 'ok'").count() == 4 and run.results["ok_gsea_nes"].columns[:2] == ["signature", "top"]
    few = lists.union(spark.createDataFrame([(9, "IC01", "other", 1.0)], lists.schema))
    with pytest.raises(RuntimeError, match="9:IC01"):
        run._enrich(few, ["dimension", "component"], "bad_gsea", 5, 500, files, whole=True)
