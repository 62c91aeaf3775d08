"""Null models: the nested comparison, its keys and its command line."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clustrata.operators import consensus, nullcheck, resample
from clustrata.plans import nullcheck as command


@pytest.fixture(scope="module")
def grouped(spark):
    """Three clear groups of fifteen samples."""
    rng = np.random.default_rng(5)
    own = np.repeat([0, 1, 2], 15)
    x = rng.normal(size=(45, 60)) + np.eye(3)[own] @ rng.normal(size=(3, 60)) * 3
    return spark.createDataFrame([(f"s{i:02d}", f"g{j:02d}", float(x[i, j])) for i in range(45) for j in range(60)], "sample string, gene string, value double").cache()


def test_structure_is_less_ambiguous_than_both_nulls(spark, grouped):
    found = nullcheck.null_comparison(grouped, [2, 3], n_null=2, n_resamples=24, partitions=6).cache()
    assert {(r["model"], r["rep"]): r["count"] for r in found.groupBy("model", "rep").count().collect()} == {("observed", 0): 2, **{(m, r): 2 for m in ("permuted", "gaussian") for r in (0, 1)}}
    summary = nullcheck.null_summary(found)
    by = {(r["model"], r["k"]): r for r in summary.collect()}
    assert by["observed", 3]["pac_mean"] < 0.1 and by["permuted", 3]["pac_min"] > 0.3
    gaps = {r["k"]: r for r in nullcheck.null_gaps(summary).collect()}
    assert gaps[3]["gap_permuted"] == pytest.approx(by["permuted", 3]["pac_min"] - by["observed", 3]["pac_mean"]) and gaps[3]["gap_gaussian"] > 0
    again = nullcheck.null_comparison(grouped.repartition(3), [2, 3], n_null=2, n_resamples=24, partitions=20)
    key = lambda df: sorted((r["model"], r["rep"], r["k"], round(r["pac"], 9), round(r["auc"], 9)) for r in df.collect())
    assert key(found) == key(again)  # whatever the tasks


def test_observed_run_is_the_plain_consensus(spark, grouped):
    pairs = consensus.consensus_clustering(grouped, [3], 10, seed=4, partitions=2)
    nested = nullcheck.null_comparison(grouped, [3], n_null=1, n_resamples=10, seed=4, partitions=9).where("model = 'observed'").first()
    assert nested["pac"] >= 0 and abs(nested["pac"] - consensus.pac(pairs).first()["pac"]) < 0.05


def test_permuted_replicates_are_the_permutations(spark, grouped):
    many = nullcheck.permuted_replicates(grouped, 3)
    for rep in (0, 2):
        own = many.where(F.col("rep") == rep).select("sample", "gene", "value")
        assert own.exceptAll(resample.permute_genes(grouped, rep)).count() == 0 and own.count() == grouped.count()


def test_keys_keep_matrices_apart(spark, grouped):
    """Labels and pairs of a matrix among others are those that it has alone; more than 64 draws fill two words."""
    small = grouped.where("sample < 's12'")
    alone = consensus.consensus_pairs(resample.medoid_labels(small, 70, [2, 3]))
    both = nullcheck.null_matrices(small, 1)
    keyed = consensus.consensus_pairs(resample.medoid_labels(both, 70, [2, 3], keys=nullcheck.KEYS), nullcheck.KEYS).where("model = 'observed'").drop("model", "rep")
    cols = ["k", "i", "j", "m", "n_co"]
    assert alone.select(cols).exceptAll(keyed.select(cols)).count() == 0 and keyed.count() == alone.count() == 2 * 12 * 11 / 2
    labels = resample.medoid_labels(small, 70, [2, 3]).collect()
    own = {(r["b"], r["k"], r["sample"]): r["label"] for r in labels}
    for r in alone.collect():
        met = [(own[b, r["k"], r["i"]], own[b, r["k"], r["j"]]) for b in range(70) if (b, r["k"], r["i"]) in own and (b, r["k"], r["j"]) in own]
        assert (r["n_co"], r["m"]) == (len(met), sum(a == c for a, c in met))


def test_pairs_never_drawn_together(spark):
    labels = spark.createDataFrame([(0, 2, "a", 1), (0, 2, "b", 1), (1, 2, "c", 2), (200, 2, "a", 3), (200, 2, "c", 3)], "b int, k int, sample string, label int")
    got = {(r["i"], r["j"]): (r["m"], r["n_co"], r["consensus"]) for r in consensus.consensus_pairs(labels).collect()}
    assert got == {("a", "b"): (1, 1, 1.0), ("a", "c"): (1, 1, 1.0), ("b", "c"): (0, 0, 0.0)}
    with pytest.raises(Exception, match="beyond 255"):
        consensus.consensus_pairs(labels.withColumn("label", F.lit(256))).collect()


def test_command_line(spark, grouped, tmp_path, monkeypatch, caplog):
    wide = grouped.groupBy("gene").pivot("sample").agg(F.first("value")).toPandas()
    wide.to_csv(tmp_path / "m.csv", index=False)
    monkeypatch.setattr("clustrata.session.session", lambda *a, **b: spark)
    args = ["--counts", str(tmp_path / "m.csv"), "--outdir", str(tmp_path / "out"), "--already-normalized", "--k-min", "3", "--k-max", "3", "--n-resamples", "12", "--n-null", "1", "--partitions", "3"]
    with caplog.at_level("INFO"):
        assert command.main(args) == 0
    rows = spark.read.csv(str(tmp_path / "out/tables/null_comparison"), header=True, inferSchema=True).collect()
    assert sorted(r["model"] for r in rows) == ["gaussian", "observed", "permuted"] and "gap to permuted" in caplog.text
    assert command.main([*args[:-2], "--k-min", "4"]) == 2 and command.main([*args, "--prop-genes", "0"]) == 2


def test_planted_groups_are_found_again(spark):
    rng = np.random.default_rng(0)
    base = rng.uniform(20, 400, 60)
    counts = spark.createDataFrame([(f"s{i:02d}", f"g{j:02d}", float(rng.poisson(base[j]))) for i in range(30) for j in range(60)], "sample string, gene string, value double").cache()
    groups = spark.createDataFrame([(f"s{i:02d}", "abc"[i % 3]) for i in range(29)], "sample string, level string")
    planted = resample.plant_groups(counts, groups).cache()
    assert planted.where("sample = 's29'").exceptAll(counts).count() == 0 and planted.count() == counts.count()
    from clustrata.operators import preprocess

    logs = preprocess.centre_genes(preprocess.log_cpm(planted.where("sample <> 's29'")))
    pairs = consensus.consensus_clustering(logs, [3], 12, partitions=3)
    own = {r["sample"]: r["cluster"] for r in consensus.final_partition(pairs).collect()}
    assert len({tuple(sorted({own[f"s{i:02d}"] for i in range(29) if i % 3 == g})) for g in range(3)}) == 3
    assert all(len({own[f"s{i:02d}"] for i in range(29) if i % 3 == g}) == 1 for g in range(3))


def test_planted_depth_rounds_like_sql(spark):
    """0.7 x ticks is exact before the division (F21): a product that should end in .5 isn't moved by a last bit."""
    import hashlib
    import math

    cells = [(f"s{i:03d}", f"g{v}", float(v)) for i in range(300) for v in (500, 1000, 2500, 5000)]
    counts = spark.createDataFrame(cells, "sample string, gene string, value double")
    groups = spark.createDataFrame([(f"s{i:03d}", "a") for i in range(300)], "sample string, level string")
    got = {(r["sample"], r["gene"]): r["value"] for r in resample.plant_groups(counts, groups, share=0.0).collect()}
    ticks = {s: int(hashlib.md5(f"0:depth:{s}".encode()).hexdigest()[:15], 16) % 10_000 for s, _, _ in cells}
    assert got == {(s, g): float(math.floor(v * (0.7 + ticks[s] * 7 / 10 / 10_000) + 0.5)) for s, g, v in cells}
