"""Payloads of the page: drawn trees, bounded rows, written tables read back; robustness of embeddings."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from clustrata.operators import consensus, embedding, stability
from clustrata.operators.distance import distance_matrix
from clustrata.operators.kernels.cluster import leaf_order, linkage_tree, members_of
from clustrata.plans import report


@pytest.fixture(scope="module")
def pairs(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(14, 30)) + np.eye(2)[np.repeat([0, 1], 7)] @ rng.normal(size=(2, 30)) * 2
    d = distance_matrix(x, "pearson")
    rows = [(k, f"s{i:02d}", f"s{j:02d}", float(1 - d[i, j] / (2 + k))) for k in (2, 3) for i in range(14) for j in range(i + 1, 14)]
    return spark.createDataFrame(rows, "k int, i string, j string, consensus double").cache(), d


def test_drawn_trees(spark, pairs):
    own, d = pairs
    links = consensus.tree_links(own).cache()
    parts = consensus.final_partition(own)
    branches = stability.branch_table(own, parts).withColumn("stability", F.col("size") / 100)
    drawn = {r["k"]: [json.loads(r[c]) for c in ("icoord", "dcoord", "stability")] for r in report.tree_payload(links, branches).collect()}
    tree = linkage_tree(d / 4)
    order, members = leaf_order(tree, 14).tolist(), members_of(tree, 14)
    at = lambda node: 5 + 10 * order.index(node) if node < 14 else np.mean([at(int(tree[node - 14, 0])), at(int(tree[node - 14, 1]))])
    want = {}
    for step, (a, b, h, _) in enumerate(tree):
        left, right = sorted((at(int(a)), at(int(b))))
        want[round(left, 6), round(right, 6), round(h, 9)] = None if len(members[step]) == 14 else len(members[step]) / 100
    got = {(round(x[0], 6), round(x[3], 6), round(y[1], 9)): s for x, y, s in zip(*drawn[2], strict=True)}
    assert got == want and len(drawn[3][0]) == 13
    assert drawn[2][2][0] is None  # the root is drawn first
    for x, y, _ in zip(*drawn[2], strict=True):
        assert x[0] == x[1] and x[2] == x[3] and y[1] == y[2] >= max(y[0], y[3])
    alone = report.tree_payload(links).where("k = 2").first()
    assert json.loads(alone["stability"]) == [None] * 13 and json.loads(alone["icoord"]) == drawn[2][0]


def test_bounded_rows(spark):
    df = spark.createDataFrame([("a", i, None if i == 2 else float(i)) for i in range(9)] + [("b", 1, 0.5)], "g string, i int, v double")
    got = {r["g"]: (r["n_rows"], r["truncated"], json.loads(r["rows"])) for r in report.bounded_payload(df, ["g"], [F.desc("i")], 8).collect()}
    assert got["b"] == (1, False, [{"i": 1, "v": 0.5}])
    assert got["a"][:2] == (9, True) and [x["i"] for x in got["a"][2]] == list(range(8, 0, -1)) and {"i": 2, "v": None} in got["a"][2]


def test_folder_of_unlike_tables(spark, tmp_path):
    spark.range(5).withColumn("name", F.lit("x")).write.parquet(str(tmp_path / "one"))
    spark.createDataFrame([(1.5, [1, 2])], "v double, l array<int>").write.parquet(str(tmp_path / "two"))
    got = {r["table"]: r for r in report.folder_payload(spark, str(tmp_path), ["one", "two"], most=3).collect()}
    assert got["one"]["truncated"] and len(got["one"]["rows"]) == 3 and json.loads(got["one"]["columns"]) == ["id", "name"]
    assert not got["two"]["truncated"] and json.loads(got["two"]["rows"][0]) == {"v": 1.5, "l": [1, 2]}
    with pytest.raises(ValueError):
        report.folder_payload(spark, str(tmp_path), [])


def test_neighbours_against_all_distances(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 3, (60, 2)).astype(float)  # many ties
    points = spark.createDataFrame([(r, f"p{i:02d}", (x[i] * (r + 1)).tolist()) for r in (0, 1) for i in range(60)], "run int, sample string, x array<double>")
    near = embedding.nearest_neighbours(points, 5, blocks=3).cache()
    for r in near.where("run = 0").collect():
        i = int(r["sample"][1:])
        d = np.round(np.sqrt(((x - x[i]) ** 2).sum(1)), 9)
        assert r["near"] == [f"p{j:02d}" for _, j in sorted((v, j) for j, v in enumerate(d) if j != i)[:5]]
    assert embedding.neighbour_overlap(near).collect() == [(0, 1, 60, 1.0)]  # scaled points have the same neighbours
    few = embedding.nearest_neighbours(points.where("sample < 'p03'"), 5)
    assert {len(r["near"]) for r in few.collect()} == {2} and embedding.nearest_neighbours(points.where("false")).count() == 0


def test_embeddings_of_several_seeds(pairs):
    own, _ = pairs
    two = own.where("k = 2")
    found = embedding.seed_stability(two, [1, 2, 3], 4, iterations=60, perplexity=4).collect()
    assert {(r["seed1"], r["seed2"]) for r in found} == {(1, 2), (1, 3), (2, 3)} and all(0 <= r["shared"] <= 1 and r["n"] == 14 for r in found)
    again = embedding.seed_stability(two, [1, 1 + 1], 4, iterations=60, perplexity=4).collect()
    assert again[0]["shared"] == next(r["shared"] for r in found if (r["seed1"], r["seed2"]) == (1, 2))
    assert embedding.seed_stability(two, [1, 2], 4, "umap", n_neighbors=5).count() == 1
    with pytest.raises(ValueError):
        embedding.embedding_runs(two, [1], "other")


def test_triangle_round_trip(spark, pairs, tmp_path):
    from clustrata.sources import tables

    own, _ = pairs
    path = str(tmp_path / "triangle")
    tables.write_triangle(own, path, "consensus", block=4)
    back = tables.read_triangle(spark, path, 3, block=4).select("i", "j", F.col("value").alias("consensus"))
    want = own.where("k = 3").select("i", "j", "consensus")
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
    part = tables.read_triangle(spark, path, 2, (5, 9), block=4)
    assert {r["row"] for r in part.collect()} == {5, 6, 7, 8} and part.where("row = 5").count() == 14 - 6
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "block" in plan.split("PartitionFilters: [")[1].split("]")[0]  # other blocks aren't opened
