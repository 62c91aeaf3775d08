"""The association suite: which test is taken, drawn tables, totals, and the branch's tables and log."""

from __future__ import annotations

from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from clustrata.operators import crosstabs as C
from clustrata.plans.branch import AnalysisBranch, BranchSettings


def frame(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, "ab"[int(rng.integers(2))], "xyz"[int(rng.integers(3))], None if i % 11 == 0 else int(rng.integers(4))) for i in range(n)]
    return spark.createDataFrame(rows, "id int, u string, v string, w int")


def suite(df, pairs, **options):
    return {(r["var1"], r["var2"]): r for r in C.association_suite(C.pair_cells(df, pairs), **options).collect()}


def test_the_test_fits_the_table(spark):
    df = frame(spark)
    pairs = [("u", "v"), ("v", "u"), ("u", "w")]
    plain = suite(df, pairs)
    assert {r["test"] for r in plain.values()} == {"chi2"} and plain["u", "v"]["statistic"] == pytest.approx(plain["v", "u"]["statistic"])
    assert plain["u", "w"]["n"] == df.where("w is not null").count()  # rows unknown in one variable count in its pairs only
    ordered = suite(df, pairs, orders={"v": ["x", "y", "z"], "w": None})
    assert [ordered[p]["test"] for p in pairs] == ["trend"] * 3 and ordered["u", "v"]["dof"] == 1 and ordered["u", "v"]["trend_r"] == pytest.approx(ordered["v", "u"]["trend_r"])
    assert suite(df, pairs, orders={"v": ["x", "y"]})["u", "v"]["test"] == "chi2"  # a level is not in the order
    few = suite(df.where("id < 12"), pairs, orders={"v": ["x", "y", "z"]}, resamples=300)
    assert few["u", "v"]["test"] == "monte_carlo" and 1 / 301 <= few["u", "v"]["p"] <= 1
    assert suite(df.where("id < 9 and v <> 'z'"), [("u", "v")])["u", "v"]["test"] == "fisher"
    assert suite(df.where("u = 'a'"), [("u", "v")]) == {} and suite(df.where("false"), pairs) == {}


def test_families(spark):
    found = suite(frame(spark), [("u", "v"), ("u", "w"), ("v", "w")])
    p = sorted(r["p"] for r in found.values())
    want = [min(min(3 * x / (k + 1) for k, x in enumerate(p) if k >= i), 1) for i in range(3)]
    assert sorted(r["q"] for r in found.values()) == pytest.approx(want)


def test_drawn_tables_keep_margins_and_their_distribution():
    rows, cols = np.array([3, 2, 4]), np.array([5, 4])
    x = C.drawn_tables(rows, cols, 20_000, np.random.default_rng(1))
    assert (x.sum(2) == rows).all() and (x.sum(1) == cols).all() and (x >= 0).all()
    share = {k: comb(5, k) * comb(4, 3 - k) / comb(9, 3) for k in range(4)}  # the first cell is hypergeometric
    assert np.bincount(x[:, 0, 0], minlength=4) / 20_000 == pytest.approx([share[k] for k in range(4)], abs=0.015)
    big = C.drawn_tables(np.array([7, 2 * 10**9]), np.array([10**9, 10**9 + 7]), 500, np.random.default_rng(2))
    assert (big.sum(2) == [7, 2 * 10**9]).all() and (big >= 0).all() and abs(big[:, 0, 0].mean() - 3.5) < 0.5


def test_drawn_p_agrees_with_all_permutations(spark):
    from itertools import permutations

    rows = [("a", "x"), ("a", "x"), ("a", "y"), ("b", "y"), ("b", "z"), ("c", "z"), ("c", "x")]
    got = suite(spark.createDataFrame(rows, "u string, v string"), [("u", "v")], resamples=4000, seed=5)["u", "v"]

    def chi2(vs):
        us = [u for u, _ in rows]
        out = 0.0
        for u in "abc":
            for v in "xyz":
                e = us.count(u) * vs.count(v) / 7
                out += (sum(a == u and b == v for a, b in zip(us, vs, strict=True)) - e) ** 2 / e
        return out

    every = [chi2(list(vs)) for vs in permutations([v for _, v in rows])]
    assert got["test"] == "monte_carlo" and got["p"] == pytest.approx(np.mean([x >= got["statistic"] - 1e-9 for x in every]), abs=0.03)
    assert got["p"] == suite(spark.createDataFrame(rows, "u string, v string").repartition(7), [("u", "v")], resamples=4000, seed=5)["u", "v"]["p"]


def test_totals_and_residuals(spark):
    cells = C.pair_cells(frame(spark), [("u", "v")])
    n = {(r["row"], r["col"]): r["n"] for r in C.with_totals(cells).collect()}
    assert n["Total", "Total"] == 300 and n["a", "Total"] == sum(n["a", c] for c in "xyz") and n["Total", "x"] == n["a", "x"] + n["b", "x"]
    z = {(r["row"], r["col"]): r["adj_residual"] for r in cells.collect()}
    assert z["a", "x"] == pytest.approx(-z["b", "x"])


def test_rows_are_counted_without_moving(spark):
    plan = C.pair_cells(frame(spark), [("u", "v"), ("u", "w")]).groupBy("var1").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" in plan and "crossJoin" not in plan.lower()


def test_branch_writes_cells_and_logs_the_strongest(spark, caplog):
    rng = np.random.default_rng(0)
    own = np.repeat([0, 1, 2], 12)
    x = rng.normal(size=(36, 40)) + np.eye(3)[own] @ rng.normal(size=(3, 40)) * 3
    matrix = spark.createDataFrame([(f"s{i:02d}", f"g{j}", float(x[i, j])) for i in range(36) for j in range(40)], "sample string, gene string, value double")
    meta = spark.createDataFrame([(f"s{i:02d}", "abc"[own[i]], "mf"[i % 2]) for i in range(36)], "sample string, arm string, sex string")
    settings = BranchSettings.of({"k_min": 3, "k_max": 3, "k_final": 3, "n_resamples": 10, "compute_jaccard": "n", "min_cluster_size": 2, "perplexity": 5})
    with caplog.at_level("INFO"):
        branch = AnalysisBranch(matrix, meta, settings).run()
    found = {(r["var1"], r["var2"]): r for r in branch.tables["associations"].collect()}
    assert set(found) == {("cluster_k3", "arm"), ("cluster_k3", "sex"), ("arm", "sex")}
    assert found["cluster_k3", "arm"]["cramers_v"] == pytest.approx(1) and "cluster_k3 with arm" in caplog.text and "cluster_k3 with sex" not in caplog.text
    assert branch.tables["association_counts"].where("row = 'Total' and col = 'Total'").agg(F.min("n")).first()[0] == 36
    assert branch.tables["association_cells"].where("var1 = 'arm'").count() == 6
