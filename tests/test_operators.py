"""Operators on small frames with hand-made values."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clustrata.functions import expr
from clustrata.operators import association, compare, consensus, differential, ica, nullcheck, preprocess, resample, signatures, stability
from clustrata.sources import tables
from clustrata.streaming import assign

# Six samples on two components and two partitions.
POINTS = {"S1": (0, 0), "S2": (2, 0), "S3": (4, 0), "S4": (6, 0), "S5": (1, 3), "S6": (3, 5)}
THREE = {"S1": 1, "S2": 1, "S3": 2, "S4": 2, "S5": 3, "S6": 3}
TWO = {"S1": 1, "S2": 1, "S3": 1, "S4": 2, "S5": 2, "S6": 2}


@pytest.fixture
def points(spark):
    return spark.createDataFrame([(s, f"IC{i + 1:02d}", float(v[i])) for s, v in POINTS.items() for i in (0, 1)], "sample string, component string, value double")


def labels(spark, held):
    return spark.createDataFrame(list(held.items()), "sample string, cluster int")


def test_contrasts(spark, points):
    rows = {(r["component"], r["cluster1"], r["cluster2"]): r for r in compare.component_contrasts(points, labels(spark, THREE)).collect()}
    r = rows["IC01", 1, 2]
    assert (r["mean1"], r["mean2"], r["difference"]) == (1, 5, -4)
    assert r["pooled_sd"] == pytest.approx(math.sqrt(2)) and r["cohen_d"] == pytest.approx(-4 / math.sqrt(2))
    assert r["hedges_g"] == pytest.approx(-4 / math.sqrt(2) * (1 - 3 / 7))
    assert (r["medoid1"], r["medoid2"]) == ("S1", "S3")


def test_global_distance(spark, points):
    parts = compare.global_contributions(points, labels(spark, THREE))
    sums = parts.groupBy("cluster1", "cluster2").agg(F.sum("quadratic").alias("q"), F.sum("relative").alias("r"))
    for r in compare.global_distances(parts).join(sums, ["cluster1", "cluster2"]).collect():
        assert r["distance"] ** 2 == pytest.approx(r["q"]) and r["r"] == pytest.approx(1)


def test_degenerate_contrasts(spark):
    rows = [("A", "flat", 1.0), ("B", "flat", 1.0), ("C", "flat", 1.0), ("A", "gap", 0.0), ("B", "gap", None), ("C", "gap", 2.0)]
    df = spark.createDataFrame(rows, "sample string, component string, value double")
    part = labels(spark, {"A": 1, "B": 2, "C": 2})
    for r in compare.component_contrasts(df, part).collect():
        assert r["cohen_d"] is None and r["warning"]
    assert {r["component"] for r in compare.global_contributions(df, part).collect()} == {"gap"}


def test_compare_all_k(spark, points):
    both = labels(spark, THREE).select(F.lit(3).alias("k"), "*").unionByName(labels(spark, TWO).select(F.lit(2).alias("k"), "*"))
    out = compare.compare_all_k(points, both)
    assert {r["k"] for r in out["componentwise"].collect()} == {2, 3}
    assert out["distances"].where("k = 3").count() == 3
    with pytest.raises(ValueError, match="differ"):
        compare.compare_all_k(points, both.where("sample <> 'S1'"))


def matrix(spark, x, names=None):
    rows = [(names[i] if names else f"s{i:02d}", f"g{j:03d}", float(v)) for i, r in enumerate(x) for j, v in enumerate(r)]
    return spark.createDataFrame(rows, "sample string, gene string, value double")


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (15, 60)) + 3 * rng.standard_normal(60) for _ in range(3)])
    return matrix(spark, x).persist()


def test_consensus_of_planted_clusters(spark, planted):
    pairs = consensus.consensus_clustering(planted, [2, 3, 4], 30, partitions=4).persist()
    assert pairs.where("m > n_co or consensus < 0 or consensus > 1 or i >= j").count() == 0
    assert pairs.where("k = 3").count() == 45 * 44 / 2
    parts = consensus.final_partition(pairs).persist()
    three = {r["sample"]: r["cluster"] for r in parts.where("k = 3").collect()}
    assert len({tuple(sorted({three[f"s{i:02d}"] for i in range(a, a + 15)})) for a in (0, 15, 30)}) == 3
    summary = consensus.k_summary(pairs, parts).persist()
    assert {r["k"]: r["pac"] for r in summary.collect()}[3] < 0.05
    assert consensus.suggest_k(summary, "pac", 5).first()["k"] == 3
    branches = stability.branch_table(pairs.where("k = 3"), parts)
    kept = stability.branch_stability(planted, branches, 10, partitions=4)
    final = kept.where("is_final_cluster").collect()
    assert len(final) == 3 and all(r["stability"] > 0.95 for r in final)
    assert "|" in stability.export(kept).first()["members"]


def test_null_models(spark, planted):
    out = nullcheck.null_comparison(planted, [3], 1, 20, partitions=4)
    got = {r["model"]: r["pac_mean"] for r in nullcheck.null_summary(out).collect()}
    assert got["observed"] < got["permuted"] and got["observed"] < 0.1
    same = resample.permute_genes(planted, 1)
    assert same.groupBy("gene").agg(F.round(F.sum("value"), 6).alias("s")).exceptAll(planted.groupBy("gene").agg(F.round(F.sum("value"), 6).alias("s"))).count() == 0


def test_draws(spark, planted):
    one = resample.draw(planted, "sample", 5, 0.5)
    assert {r["count"] for r in one.groupBy("b").count().collect()} == {resample.draw_size(45, 0.5)}
    many = resample.draw(planted, "sample", 5, 1.0, "bootstrap")
    assert {r["t"] for r in many.groupBy("b").agg(F.sum("times").alias("t")).collect()} == {45}
    with pytest.raises(ValueError):
        resample.draw(planted, "sample", 1, 0.5, "other")


def test_differential_recovers_planted_changes(spark):
    rng = np.random.default_rng(1)
    base = rng.uniform(50, 500, 60)
    change = np.where(np.arange(60) < 6, 2.0, 0.0)
    mean = np.concatenate([np.tile(base, (8, 1)), np.tile(base * 2**change, (8, 1))])
    counts = rng.negative_binomial(10, 10 / (10 + mean))
    df = matrix(spark, counts)
    meta = spark.createDataFrame([(f"s{i:02d}", "b" if i >= 8 else "a", float(i % 4)) for i in range(16)], "sample string, arm string, age double")
    out = differential.clinical_differential(df, meta, "~ age + arm", "arm", "b", "a").collect()
    assert [r["stat"] for r in out] == sorted((r["stat"] for r in out), reverse=True)
    hits = {r["gene"] for r in out if r["padj"] is not None and r["padj"] < 0.05 and r["log2FoldChange"] > 0}
    assert hits >= {f"g{j:03d}" for j in range(6)} and len(hits) <= 9
    assert np.mean([r["log2FoldChange"] for r in out if r["gene"] < "g006"]) == pytest.approx(2, abs=0.5)
    own = spark.createDataFrame([(f"s{i:02d}", 1 + i // 8) for i in range(16)], "sample string, cluster int")
    assert [t for t, _, _ in differential.contrasts(own)] == ["c1_vs_rest", "c2_vs_rest", "c1_vs_c2"]
    with pytest.raises(ValueError):
        differential.wald_test(df, meta, "~ arm", "arm", "zzz", "a")


def test_designs():
    assert differential.design_variables("~ age + C(arm)", ["arm", "age", "ag"]) == ["age", "arm"]
    x, names = differential.design_matrix(pd.DataFrame({"arm": ["a", "b", "a"], "age": [1.0, 2, 3]}), "~ age + arm", {"arm": "b"})
    assert names == ["Intercept", "age", "arm[a]"] and x[:, 2].tolist() == [1, 0, 1]


def test_gsea(spark):
    rng = np.random.default_rng(2)
    scores = [("r", f"g{i:03d}", 3 - i * 0.02 + float(rng.normal(0, 0.1))) for i in range(300)]
    sets = [("top", f"g{i:03d}") for i in range(20)] + [("bottom", f"g{i:03d}") for i in range(280, 300)] + [("random", f"g{int(i):03d}") for i in rng.choice(300, 20, replace=False)]
    got = {r["signature"]: r for r in signatures.gsea_prerank(spark.createDataFrame(scores, "ranking string, gene string, score double"), spark.createDataFrame(sets, "signature string, gene string"), 200, 5).collect()}
    assert got["top"]["es"] > 0.8 and got["top"]["nes"] > 0 and got["top"]["nom_p"] < 0.01 and got["bottom"]["es"] < 0 and got["bottom"]["nes"] < 0
    assert got["top"]["fdr_q"] < 0.05 and abs(got["random"]["es"]) < 0.6 and "g000" in got["top"]["lead_genes"]


def test_u_statistics_add_up(spark):
    rng = np.random.default_rng(4)
    scores = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(rng.integers(0, 9, 30))], "signature string, sample int, score double")
    groups = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(30)], "sample int, level string")
    u = {r["level"]: r for r in association.rank_tests_one_vs_rest(scores, groups).collect()}
    assert u["a"]["u"] + u["b"]["u"] == 15 * 15 and u["a"]["p"] == pytest.approx(u["b"]["p"])
    assert u["a"]["rank_biserial"] == pytest.approx(-u["b"]["rank_biserial"])


def test_fdr_is_monotone(spark):
    df = spark.createDataFrame([(i, float(p)) for i, p in enumerate([0.01, 0.02, 0.02, 0.5, 0.9])] + [(9, None)], "i int, p double")
    got = [(r["p"], r["q"]) for r in expr.benjamini_hochberg(df, "p").orderBy("p").collect()]
    assert got[0] == (None, None)
    assert [q for _, q in got[1:]] == pytest.approx([0.02 * 5 / 3, 0.02 * 5 / 3, 0.02 * 5 / 3, 0.625, 0.9])


def test_vst_and_filters(spark):
    rng = np.random.default_rng(5)
    df = matrix(spark, rng.negative_binomial(5, 0.05, (10, 40)))
    v = preprocess.vst(df).join(df.withColumnRenamed("value", "raw"), ["sample", "gene"])
    assert v.where("isnan(value) or value is null").count() == 0 and v.agg(F.corr("value", "raw")).first()[0] > 0.7
    with pytest.raises(ValueError):
        preprocess.vst(df.withColumn("value", -F.col("value") - 1))
    assert preprocess.parse_threshold("off") is None and preprocess.parse_threshold("0.4") == 0.4
    with pytest.raises(ValueError):
        preprocess.parse_threshold("1.5")


def test_pca_outlier(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (20, 30))
    x[7] += 15
    out = preprocess.pca_outliers(matrix(spark, x), 3.0)
    assert [r["sample"] for r in out.where("is_outlier").collect()] == ["s07"]


def test_ica_scan(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((12, 3)) @ rng.laplace(size=(3, 200)) + rng.normal(0, 0.05, (12, 200))
    found, status = ica.scan(matrix(spark, x), 2, 4, n_runs=4)
    assert {r["dim"] for r in status.collect()} == {2, 3, 4} and status.where("error is not null").count() == 0
    summary = ica.profile(found)
    choice = ica.select_dimension(summary, found)
    assert choice.dim in (2, 3, 4) and choice.roles
    samples = [f"s{i:02d}" for i in range(12)]
    assert ica.long_metasamples(found, 3, samples).count() == 36
    assert ica.long_metagenes(found, 3, [f"g{j:03d}" for j in range(200)]).count() == 600
    for mode in ("bootstrap", "fast_bootstrap"):
        drawn, status = ica.scan(matrix(spark, x), 2, 3, n_runs=4, resampling=mode)
        assert status.where("error is not null").count() == 0 and drawn.where("dim = 3").agg(F.min("stability")).first()[0] > 0.4
    with pytest.raises(ValueError, match="resampling"):
        ica.scan(matrix(spark, x), 2, 3, n_runs=1, resampling="other")


def test_readers(spark, tmp_path):
    (tmp_path / "m.csv").write_text("gene,s1,s2\nA,1,2\nB,,4\n")
    got = {(r["sample"], r["gene"]): r["value"] for r in tables.read_matrix(spark, str(tmp_path / "m.csv")).collect()}
    assert got == {("s1", "A"): 1, ("s2", "A"): 2, ("s1", "B"): None, ("s2", "B"): 4}
    (tmp_path / "meta.tsv").write_text("id\tage\tarm\n1\t30\tx\n2\t\ty\n")
    meta = tables.read_metadata(spark, str(tmp_path / "meta.tsv"))
    assert meta.columns == ["sample", "age", "arm"] and meta.schema["sample"].dataType.simpleString() == "string"
    (tmp_path / "sets.gmt").write_text("SET\tna\tA\tB\n")
    assert tables.read_gmt(spark, str(tmp_path / "sets.gmt")).count() == 2
    (tmp_path / "sig.csv").write_text("Geneset,Gene Listing\nsig, A; B ;;C\n")
    assert sorted(r["gene"] for r in tables.read_signature_source(spark, "x", {"path": str(tmp_path / "sig.csv")}).collect()) == ["A", "B", "C"]
    assert tables.read_signature_source(spark, "x", {"path": str(tmp_path / "none.csv")}) is None
    assert tables.resolve_gene_sets({"a": str(tmp_path / "sets.gmt"), "b": "/none"}) == {"a": str(tmp_path / "sets.gmt")}
    assert tables.cleaned({"a": [float("nan"), 1.0, {"b": float("inf")}]}) == {"a": [None, 1.0, {"b": None}]}


def test_streaming_assignment(spark, tmp_path):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((2, 20)) * 3
    x = np.concatenate([centres[i] + rng.normal(0, 0.5, (6, 20)) for i in (0, 1)])
    df = matrix(spark, x)
    part = spark.createDataFrame([(f"s{i:02d}", 1 + i // 6) for i in range(12)], "sample string, cluster int")
    known = assign.centroids(df, part).persist()
    rows = df.groupBy("sample").agg(F.map_from_entries(F.collect_list(F.struct("gene", "value"))).alias("values"))
    got = {r["sample"]: r["cluster"] for r in assign.assign(rows, known).collect()}
    assert got == {f"s{i:02d}": 1 + i // 6 for i in range(12)}
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = assign.assign_stream(stream, known, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12


def test_stratified_sample(spark):
    from clustrata.operators.resample import stratified_sample

    rows = [("a", i) for i in range(50)] + [("b", 100), (None, 200), (None, None)]
    df = spark.createDataFrame(rows, "_r string, id int")
    found = [tuple(r) for r in stratified_sample(df, "_r", "id", 7, 1).collect()]
    assert stratified_sample(df, "_r", "id", 7, 1).columns == ["_r", "id"]
    assert sum(r[0] == "a" for r in found) == 7 and ("b", 100) in found and sum(r[0] is None for r in found) == 2
    assert sorted(map(repr, found)) == sorted(repr(tuple(r)) for r in stratified_sample(df.repartition(5), "_r", "id", 7, 1).collect())
    assert stratified_sample(df.limit(0), "_r", "id", 7).count() == 0


def test_marker_means_and_missing_tasks(spark):
    from clustrata.operators import signatures as s

    logs = spark.createDataFrame([("s1", "g1", 1.0), ("s1", "g2", 3.0), ("s1", "g3", None), ("s2", "g1", 5.0)], "sample string, gene string, value double")
    markers = spark.createDataFrame([("T", "g1"), ("T", "g2"), ("T", "g2"), ("T", "g3"), ("B", "g9")], "signature string, gene string")
    assert sorted(tuple(r) for r in s.marker_means(logs, markers).collect()) == [("T", "s1", 2.0, 2), ("T", "s2", 5.0, 1)]
    assert [tuple(r) for r in s.marker_means(logs, markers, 2).collect()] == [("T", "s1", 2.0, 2)]
    results = spark.createDataFrame([("a", "x", 2.0), ("a", "y", -3.0), ("a", "z", float("nan")), ("a", "w", 3.0)], "contrast string, signature string, nes double")
    assert [r["signature"] for r in s.best_pathways(results, 2).orderBy("place").collect()] == ["w", "y"]
    tasks = spark.createDataFrame([("a",), ("b",), ("b",)], "contrast string")
    assert [r[0] for r in s.missing_tasks(tasks, results, ["contrast"]).collect()] == ["b"]


def test_assembled_features(spark):
    from clustrata.operators.association import assemble_features

    meta = spark.createDataFrame([(f"s{i}", float(i) if i else None, i % 2) for i in range(9)], "sample string, age double, arm int")
    scores = spark.createDataFrame([("A", "s1", 1.5), ("A", "s2", float("nan"))], "signature string, sample string, score double")
    found = assemble_features(meta, {"mean": scores}, samples=meta.where("sample in ('s0', 's1', 's2')"))
    assert sorted(tuple(r) for r in found.collect()) == [("s1", "clinic:age", "clinic", "clinic", 1.0), ("s1", "mean:A", "sig_mean", "sig", 1.5), ("s2", "clinic:age", "clinic", "clinic", 2.0)]
    with pytest.raises(ValueError, match="no feature"):
        assemble_features(meta.select("sample"))


def test_input_checks(spark):
    rows = [("a", "g1", 1.0), ("a", "g2", 2.0), ("b", "g1", 3.0), ("b", "g2", 5.0), ("c", "g1", 4.0), ("c", "g2", 4.0)]
    df = spark.createDataFrame(rows, "sample string, gene string, value double")
    twice = df.union(df.limit(1))
    meta = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "y")], "sample string, arm string")
    assert expr.unique_rows(df, ["sample", "gene"], "a gene").exceptAll(df).count() == 0
    with pytest.raises(Exception, match="a gene occurs more than once: a, g1"):
        expr.unique_rows(twice, ["sample", "gene"], "a gene").collect()
    with pytest.raises(Exception, match="more than once"):
        consensus.consensus_clustering(twice, [2], 2, partitions=1)
    with pytest.raises(Exception, match="a gene of a sample occurs more than once"):
        differential.wald_test(twice, meta, "~ arm", "arm", "y", "x")
    with pytest.raises(Exception, match="a sample of the metadata occurs more than once: b"):
        differential.wald_test(df, meta.union(meta.where("sample = 'b'")), "~ arm", "arm", "y", "x")
    for bad in (None, float("nan"), float("inf")):
        with pytest.raises(Exception, match="isn't a finite number"):
            spark.createDataFrame([(bad,)], "v double").select(expr.finite_or_error(F.col("v"), "a value")).collect()
