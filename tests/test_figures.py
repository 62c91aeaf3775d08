"""The tables behind figures, where SQL doesn't hold them already."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clustrata.plans import figures as G


def test_overview_and_items(spark):
    partition = spark.createDataFrame([(2, "a", 1, 1), (2, "b", 2, 0), (3, "a", 1, 0), (3, "b", 3, 1)], "k int, sample string, cluster int, leaf_pos int")
    items = spark.createDataFrame([(2, "a", 1, 0.5, 0.25), (2, "b", 2, 1.0, None)], "k int, sample string, cluster int, item_consensus double, silhouette double")
    got = {(r["k"], r["place"]): (r["sample"], r["item_consensus"], r["silhouette"]) for r in G.overview(partition, items).collect()}
    assert got == {(2, 1): ("a", 0.5, 0.25), (2, 0): ("b", 1.0, None), (3, 0): ("a", None, None), (3, 1): ("b", None, None)}
    box = spark.createDataFrame([(2, 1, float(v)) for v in (0, 1, 2, 3, 10)] + [(2, 2, None)], "k int, cluster int, item_consensus double")
    found = {r["cluster"]: tuple(r)[2:] for r in G.item_boxes(box).collect()}
    assert found == {1: (5, 0.0, 1.0, 2.0, 3.0, 10.0), 2: (0, None, None, None, None, None)}


def test_heatmap_is_symmetric(spark):
    pairs = spark.createDataFrame([(2, "a", "b", 0.5), (2, "a", "c", 0.0), (2, "b", "c", 1.0)], "k int, i string, j string, consensus double")
    partition = spark.createDataFrame([(2, "a", 1, 2), (2, "b", 1, 0), (2, "c", 2, 1)], "k int, sample string, cluster int, leaf_pos int")
    m = {(r["row"], r["col"]): r["consensus"] for r in G.heatmap_cells(pairs, partition).collect()}
    assert len(m) == 9 and m[0, 2] == m[2, 0] == 0.5 and m[0, 1] == 1.0 and m[1, 1] == 1.0


@pytest.mark.parametrize(("direction", "removed"), [("higher", {0: 1, 8: 0}), ("lower", {0: 0, 8: 2, 19: 1})])
def test_purity_bins(spark, direction, removed):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.42), ("c", 0.44), ("d", 1.0), ("e", None), ("f", float("nan"))], "sample string, purity double")
    got = {r["bin"]: r for r in G.purity_bins(df, 0.41, direction).collect()}
    assert sum(r["n"] for r in got.values()) == 4 and {b: got[b]["n_removed"] for b in removed} == removed and got[19]["high"] == 1.0
    assert G.purity_bins(df, None).agg(F.sum("n_removed")).first()[0] == 0


def test_correlation_cells(spark):
    rows = [("clinic:age", "sig:a", 0.2, 0.5), ("sig:b", "clinic:age", -0.9, 0.001), ("clinic:age", "clinic:bmi", 0.9, 0.001), ("sig:a", "sig:b", 0.9, 0.001), ("clinic:bmi", "sig:a", None, None), ("clinic:age", "sig:c", 0.95, 0.2)]
    got = [(r["clinical"], r["feature"], r["place"], r["stars"]) for r in G.correlation_cells(spark.createDataFrame(rows, "f1 string, f2 string, r double, q double")).orderBy("place", "clinical").collect()]
    assert got == [("clinic:age", "sig:b", 1, "**"), ("clinic:age", "sig:c", 2, "ns"), ("clinic:age", "sig:a", 3, "ns"), ("clinic:bmi", "sig:a", 3, "")]
    assert G.correlation_cells(spark.createDataFrame(rows, "f1 string, f2 string, r double, q double"), most=1).count() == 1
