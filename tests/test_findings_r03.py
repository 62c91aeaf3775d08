"""Findings of the third round: the steps that grew faster than their input."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clustrata.functions import expr
from clustrata.operators import compare, consensus, embedding, ica, nullcheck, stability
from clustrata.operators.kernels import linear
from clustrata.plans.queries import QUERIES
from clustrata.sources import tables

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_from_counts_of_distinct_values(spark):
    """only distinct values are ordered, whatever the rows; nulls in values and groups as before."""
    rows = [(None if i % 11 == 0 else i % 2, None if i % 7 == 0 else float("nan") if i % 5 == 0 else float(i % 4)) for i in range(60)]
    df = spark.createDataFrame(rows, "g int, v double").withColumn("id", F.monotonically_increasing_id())
    got, want = expr.counted_ranks(df, "v", ["g"]), expr.with_ranks(df, "v", ["g"])
    assert got.columns == want.columns and got.dtypes == want.dtypes and got.count() == 60
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    made = plan(QUERIES["avg_rank"](spark, DATA))
    assert made.index("Window") < made.index("HashAggregate") < made.rindex("l_quantity")


def test_branches_meet_on_samples(spark):
    """members are rows that meet on their sample; as many as there are samples times the branches that hold one."""
    names = spark.range(300).select(F.col("id").alias("sample"))
    nodes = stability.hashed_nodes(names, range(3), 2).select("b", F.concat_ws("|", "level", "node").alias("other"), "sample")
    own = nodes.where("b = 0").select(F.col("other").alias("branch_id"), "sample")
    got = {(r["branch_id"], r["b"]): r["best"] for r in stability.best_of_members(own, nodes.where("b > 0")).collect()}
    sets = {}
    for r in nodes.collect():
        sets.setdefault((r["b"], r["other"]), set()).add(r["sample"])
    mine = {i: m for (b, i), m in sets.items() if b == 0}
    assert len(got) == 2 * len(mine)
    for (i, b), best in got.items():
        assert best == max(len(mine[i] & o) / len(mine[i] | o) for (c, _), o in sets.items() if c == b)
    assert "collect_list" not in plan(QUERIES["branch_support"](spark, DATA))


def test_contrasts_without_medoids(spark):
    """F32: effects that don't show medoids don't look for them; the same rows else."""
    rng = np.random.default_rng(3)
    points = spark.createDataFrame([(i, f"c{j}", float(rng.normal(i % 3))) for i in range(30) for j in range(2)], "sample int, component string, value double")
    part = spark.createDataFrame([(i, i % 3) for i in range(30)], "sample int, cluster int")
    whole, less = compare.component_contrasts(points, part), compare.component_contrasts(points, part, with_medoids=False)
    assert set(whole.columns) - set(less.columns) == {"medoid1", "medoid2", "at1", "at2", "medoid_difference"}
    assert less.exceptAll(whole.select(less.columns)).count() == 0 and less.count() == whole.count() == 6
    assert "InPandas" not in plan(QUERIES["contrasts_all_k"](spark, DATA))


def test_medoids_of_copies_far_from_zero(spark):
    """F32: distances by products are exact for copies, which are no rounding error apart."""
    x = {0: (1e6, 1e6), 1: (1e6, 1e6), 2: (1e6 + 1, 1e6), 3: (1e6, 1e6 + 2)}
    points = spark.createDataFrame([(i, c, v) for i, p in x.items() for c, v in zip("ab", p, strict=True)], "sample int, component string, value double")
    part = spark.createDataFrame([(i, 0) for i in x], "sample int, cluster int")
    for block in (2, 1024):
        assert [r["medoid"] for r in compare.medoids(points, part, block).collect()] == [0]


def peak(what):
    tracemalloc.start()
    try:
        return what(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_whitening_forms_no_matrix_of_samples():
    """with more samples than genes the Gram matrix of genes is enough; 4,000 x 4,000 would be 128 MB."""
    rng = np.random.default_rng(4)
    x, w = rng.normal(size=(4000, 12)), ica.bootstrap_weights(12, rng)
    (white, drawn), most = peak(lambda: (ica.whiten(x, 4).white, ica.weighted_whitening(x, w, 4)))
    assert most < 20e6
    for got, weights in ((white, np.ones(12)), (drawn, w)):
        share = weights / weights.sum()
        assert np.allclose((got * share) @ got.T, np.eye(4), atol=1e-8) and np.allclose(got @ share, 0, atol=1e-8)
        small = x[:300] - (x[:300] @ share)[:, None]
        values, u = np.linalg.eigh((small * weights) @ small.T / weights.sum())
        plain = (u[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])).T @ small
        assert np.allclose(np.abs(ica.white_rows(small, weights, 4)), np.abs(plain), atol=1e-6)


def test_gaussian_null_of_more_samples_than_genes(spark):
    """no matrix of samples by samples, and tasks draw the values; means and covariance are kept."""
    rng = np.random.default_rng(5)
    _, most = peak(lambda: linear.gaussian_null(rng.normal(size=(4000, 6)), rng))
    assert most < 20e6
    x = rng.normal(size=(2000, 4)) @ rng.normal(size=(4, 4)) + [1, 2, 3, 4]
    df = spark.createDataFrame(pd.DataFrame({"sample": np.repeat(np.arange(2000), 4), "gene": np.tile(list("abcd"), 2000), "value": x.ravel()}))
    made = nullcheck.gaussian_null(df, n_pc=4)
    assert "MapInPandas" in plan(made)
    assert made.repartition(3).exceptAll(nullcheck.gaussian_null(df.repartition(5), n_pc=4).select(made.columns)).where(F.col("value").isNull()).count() == 0
    y = made.groupBy("sample").pivot("gene", list("abcd")).agg(F.first("value")).toPandas()[list("abcd")].to_numpy()
    assert y.shape == x.shape and np.allclose(y.mean(0), x.mean(0), atol=0.25) and np.allclose(np.cov(y.T), np.cov(x.T), atol=0.2 * np.abs(np.cov(x.T)).max())
    with pytest.raises(ValueError, match="missing"):
        nullcheck.gaussian_null(df.where("not (sample = 3 and gene = 'b')"))


def test_pairs_of_some_rows(spark, monkeypatch):
    """the pairs of the rows that are asked for, as in the whole table, and no others are made."""
    monkeypatch.setattr(consensus.blocks, "BLOCK", 7)
    rng = np.random.default_rng(6)
    labels = spark.createDataFrame([(b, k, f"s{i:02d}", int(rng.integers(1, k + 1))) for b in range(5) for k in (2, 3) for i in range(23) if rng.random() < 0.8], "b int, k int, sample string, label int").cache()
    drawn = consensus.Drawn(labels, draws=5, most=3, samples=23)
    numbered = tables.numbered_rows(drawn.rows, (5, 9), 4)
    assert sorted({(r["k"], r["row"]) for r in numbered.collect()}) == [(k, r) for k in (2, 3) for r in range(4, 12)]
    got, whole = drawn.pairs_from(numbered), drawn.pairs().join(numbered.select("k", F.col("sample").alias("i")), ["k", "i"], "left_semi")
    assert got.exceptAll(whole.select(got.columns)).count() == 0 and got.count() == whole.count() == 2 * sum(22 - r for r in range(4, 12))
    made = []
    monkeypatch.setattr(consensus.Drawn, "pairs", lambda self: made.append(self))
    assert QUERIES["triangle_rows"](spark, DATA).count() and not made


def test_affinities_and_tsne_by_strips(monkeypatch):
    """strips of rows give what whole matrices gave; beside the affinities no square matrix is held."""
    x = np.random.default_rng(7).normal(size=(700, 3))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    d[5] = d[:, 5] = d[6]
    d[5, 5] = d[6, 6] = 0
    p = embedding.affinities(d, 20)
    monkeypatch.setattr(embedding, "strips", lambda rows, columns, most=0: [(0, rows)])
    assert (embedding.affinities(d, 20) == p).all() and (p == p.T).all()
    whole = embedding.tsne(d, iterations=5)
    monkeypatch.undo()
    assert np.allclose(embedding.tsne(d, iterations=5), whole, rtol=1e-9, atol=0)
    monkeypatch.setattr(embedding, "affinities", lambda d, perplexity: p)
    _, most = peak(lambda: embedding.tsne(d, iterations=2))
    assert most < 700 * 700 * 8


def test_kernels_take_draws_in_place_of_pairs(spark):
    """trees and embeddings of packed draws are those of the pairs, and no pair is moved."""
    rng = np.random.default_rng(8)
    labels = spark.createDataFrame([(b, k, f"s{i:02d}", int(rng.integers(1, k + 1))) for b in range(6) for k in (2, 3) for i in range(21) if rng.random() < 0.8], "b int, k int, sample string, label int").cache()
    drawn = consensus.Drawn(labels, draws=6, most=3, samples=21)
    pairs = drawn.pairs().cache()
    own, part = consensus.final_partition(drawn), consensus.final_partition(pairs)
    made = [(own, part), (stability.branch_table(drawn, part), stability.branch_table(pairs, part)), (embedding.embeddings_table(drawn, part, iterations=5), embedding.embeddings_table(pairs, part, iterations=5))]
    for got, want in made:
        assert got.dtypes == want.dtypes and got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0
    assert "InPandas" not in plan(QUERIES["hclust_partition"](spark, DATA))
