"""Cook's cutoff and filtering by the mean in the differential tests."""

from __future__ import annotations

import numpy as np
import pytest

from clustrata.functions.tails import f_quantile
from clustrata.operators import differential


def results(spark, counts):
    half = counts.shape[1] // 2
    rows = [(f"s{j:02d}", f"g{i:03d}", float(v)) for i, r in enumerate(counts) for j, v in enumerate(r)]
    meta = spark.createDataFrame([(f"s{j:02d}", "a" if j < half else "b") for j in range(2 * half)], "sample string, arm string")
    out = differential.wald_test(spark.createDataFrame(rows, "sample string, gene string, value double"), meta, "~ arm", "arm", "b", "a")
    return {r["gene"]: r for r in out.collect()}


def drawn(samples):
    return np.random.default_rng(2).negative_binomial(20, 20 / (20 + 200), (40, samples))


def test_f_quantile():
    assert f_quantile(0.99, 2, 8) == pytest.approx(8.6491, abs=1e-4)
    assert f_quantile(0.99, 2, 18) == pytest.approx(6.0129, abs=1e-4)


def test_outlier_without_replicates_loses_its_p(spark):
    counts = drawn(8)
    counts[3, 7] = 50_000
    out = results(spark, counts)
    assert out["g003"]["pvalue"] is None and out["g003"]["padj"] is None
    assert sum(r["pvalue"] is None for r in out.values()) == 1


def test_outlier_among_replicates_is_replaced(spark):
    counts = drawn(20)
    counts[3, 19] = 50_000
    r = results(spark, counts)["g003"]
    assert r["pvalue"] is not None
    assert r["baseMean"] < 400 and abs(r["log2FoldChange"]) < 1


def test_low_means_do_not_dilute(spark):
    rng = np.random.default_rng(0)
    high = [(f"h{i}", float(1000 + i), float(p)) for i, p in enumerate(np.r_[rng.uniform(0, 0.02, 60), rng.uniform(0, 1, 40)])]
    low = [(f"l{i}", float(i % 10) / 10 + 0.1, float(p)) for i, p in enumerate(rng.uniform(0, 1, 300))]
    df = spark.createDataFrame(high + low, "gene string, baseMean double, pvalue double")
    out = {r["gene"]: r["padj"] for r in differential.independent_filtering(df).collect()}
    plain = {r["gene"]: r["padj"] for r in differential.benjamini_hochberg(df, "pvalue", name="padj").collect()}
    assert sum(p is not None and p < 0.05 for p in out.values()) > sum(p < 0.05 for p in plain.values())
    assert any(p is None for g, p in out.items() if g[0] == "l") and all(p is not None for g, p in out.items() if g[0] == "h")
