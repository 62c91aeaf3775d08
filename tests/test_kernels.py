"""NumPy kernels against plain versions and invariants."""

from __future__ import annotations

import math

import numpy as np
import pytest

from clustrata.functions import tails
from clustrata.operators import distance, embedding, ica
from clustrata.operators.kernels import cluster, linear


def slow_tree(d: np.ndarray, method: str):
    """Average, complete and single linkage straight from the members."""
    groups = {i: [i] for i in range(len(d))}
    heights, steps = [], []
    how = {"average": np.mean, "complete": np.max, "single": np.min}[method]
    nxt = len(d)
    while len(groups) > 1:
        h, a, b = min((how(d[np.ix_(groups[a], groups[b])]), a, b) for a in groups for b in groups if a < b)
        heights.append(h)
        groups[nxt] = groups.pop(a) + groups.pop(b)
        steps.append(sorted(groups[nxt]))
        nxt += 1
    return heights, steps


@pytest.mark.parametrize("method", ["average", "complete", "single"])
def test_linkage(method):
    rng = np.random.default_rng(1)
    for n in (2, 3, 7, 25):
        x = rng.standard_normal((n, 4))
        d = distance.distance_matrix(x, "euclidean")
        heights, steps = slow_tree(d, method)
        tree = cluster.linkage_tree(d, method)
        assert np.allclose(tree[:, 2], heights)
        assert [m.tolist() for m in cluster.members_of(tree, n)] == steps
        assert sorted(cluster.leaf_order(tree, n)) == list(range(n))


def test_ward_merges_by_least_growth():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 0.1, (10, 3)), rng.normal(5, 0.1, (10, 3))])
    tree = cluster.linkage_tree(distance.distance_matrix(x, "euclidean"), "ward")
    assert (np.diff(tree[:, 2]) >= -1e-9).all()
    assert cluster.cut_tree(tree, 20, 2).tolist() == [1] * 10 + [2] * 10


def test_cut_tree_with_ties():
    d = np.ones((4, 4)) - np.eye(4)
    tree = cluster.linkage_tree(d)
    assert len(set(cluster.cut_tree(tree, 4, 2))) == 1  # equal heights join at once
    assert cluster.cut_tree(tree, 4, 4).tolist() == [1, 2, 3, 4]


@pytest.mark.parametrize("base", ["hierarchical", "kmeans", "kmedoids"])
def test_planted_clusters(base):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.2, (12, 5)) for c in (0, 3, 6)])
    labels = cluster.draw_labels(x, [3], rng, base, "euclidean")[3]
    assert all(len(set(labels[i : i + 12])) == 1 for i in (0, 12, 24)) and len(set(labels)) == 3


def test_distances_and_ranks():
    x = np.array([[1.0, 2, 2, 4], [4, 2, 2, 1], [3, 3, 3, 3]])
    assert distance.ranks(x[0]).tolist() == [1, 2.5, 2.5, 4]
    d = distance.distance_matrix(x, "pearson")
    assert d[0, 2] == 1 and (d == d.T).all() and (np.diag(d) == 0).all()
    assert distance.distance_matrix(x, "spearman")[0, 1] == pytest.approx(2.0)


def test_pca():
    rng = np.random.default_rng(4)
    for shape in ((8, 20), (20, 8)):
        x = rng.standard_normal(shape)
        scores, parts, share = linear.pca(x, 5)
        u, s, _ = np.linalg.svd(x - x.mean(0), full_matrices=False)
        assert np.allclose(np.abs(scores), np.abs(u[:, :5] * s[:5])) and np.allclose(share, (s**2 / (s**2).sum())[:5])
        assert np.allclose(parts @ parts.T, np.eye(5), atol=1e-8)


def test_tails():
    for dof, x in ((1, 3.841459), (2, 5.991465), (3, 7.814728), (4, 9.487729), (5, 11.0705), (7, 14.06714)):
        assert tails.chi2_tail(x, dof) == pytest.approx(0.05, abs=1e-6)
    for dof, t in ((1, 12.7062), (5, 2.570582), (10, 2.228139), (30, 2.042272)):
        assert tails.student_two_sided(t, dof) == pytest.approx(0.05, abs=1e-5)
    assert tails.chi2_tail(3000, 10) < 1e-300 or tails.chi2_tail(3000, 10) == 0
    assert tails.fisher_two_sided(3, 1, 1, 3) == pytest.approx(0.4857, abs=1e-4)
    assert tails.fisher_two_sided(49, 9, 299, 42) == pytest.approx(0.5233, abs=1e-4)
    assert tails.correlation_p(1.0, 5) == 0 and tails.correlation_p(0.0, 5) == pytest.approx(1)
    assert tails.mann_whitney_p(2.0, 3, 3, 6.0) == pytest.approx(tails.mann_whitney_normal(2.0, 3, 3, 6.0))


def test_mann_whitney_exact():
    import itertools

    for n, m in ((2, 3), (3, 4), (4, 4)):
        us = [sum(p) - n * (n + 1) / 2 for p in itertools.combinations(range(1, n + m + 1), n)]
        for u in range(n * m + 1):
            top = max(u, n * m - u)
            assert tails.mann_whitney_exact(u, n, m) == pytest.approx(min(1, 2 * sum(x >= top for x in us) / len(us)))


def test_fast_ica_finds_sources():
    rng = np.random.default_rng(5)
    sources = np.stack([np.sign(rng.standard_normal(3000)), rng.uniform(-1, 1, 3000), rng.laplace(size=3000)])
    mixed = rng.standard_normal((6, 3)) @ sources + rng.normal(0, 0.01, (6, 3000))
    white = ica.whiten(mixed, 3).white
    runs = [ica.fast_ica(white, np.random.default_rng(i)) for i in range(5)]
    found, index = ica.stabilise(runs)
    match = np.abs(np.corrcoef(found, sources)[:3, 3:]).max(1)
    assert (match > 0.98).all() and (index > 0.9).all()


@pytest.mark.parametrize("deflate", [False, True])
@pytest.mark.parametrize("mode", [None, "bootstrap", "fast_bootstrap"])
def test_resampled_runs_find_sources(mode, deflate):
    rng = np.random.default_rng(5)
    sources = np.stack([np.sign(rng.standard_normal(3000)), rng.uniform(-1, 1, 3000), rng.laplace(size=3000)])
    mixed = rng.standard_normal((6, 3)) @ sources + rng.normal(0, 0.01, (6, 3000))
    whole = ica.whiten(mixed, 3)
    centred, runs = mixed - whole.mean[:, None], []
    for i in range(6):
        rows, weights = ica.resampled(mode, centred, whole.white, 3, np.random.default_rng(i))
        share = np.ones(3000) / 3000 if weights is None else weights / weights.sum()
        assert np.allclose((rows * share) @ rows.T, np.eye(3), atol=1e-6) and np.allclose(rows @ share, 0, atol=1e-9)
        runs.append(ica.fast_ica(rows, np.random.default_rng(i), weights=weights, deflate=deflate))
    found, index = ica.stabilise(runs)
    match = np.abs(np.corrcoef(found, sources)[:3, 3:]).max(1)
    assert (match > 0.97).all() and (index > 0.85).all()
    with pytest.raises(ValueError, match="resampling"):
        ica.resampled("other", centred, whole.white, 3, rng)


def test_a_weighted_draw_is_the_drawn_columns():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(5, 400))
    weights = ica.bootstrap_weights(400, rng)
    drawn = np.repeat(np.arange(400), weights.astype(int))
    plain = ica.whiten(x[:, drawn], 3).white
    assert weights.sum() == 400 and np.allclose(np.abs(ica.weighted_whitening(x, weights, 3)[:, drawn]), np.abs(plain))
    with pytest.raises(ValueError, match="same value"):
        ica.whiten(np.vstack([x, np.ones(400)]), 3)


def test_dimension_choice():
    assert ica.candidate_dimensions(6, 30, 5, 20, 100) == [6, 11, 16, 19]
    with pytest.raises(ValueError):
        ica.candidate_dimensions(6, 8, 1, 5, 100)
    lists = {d: [0.95] * min(d, 4) + [0.95 - 0.12 * i for i in range(1, d - 3)] for d in range(4, 10)}
    at = ica.k_lines(lists)
    assert at is None or 1 <= at <= 9


def test_tsne_and_umap_keep_neighbours():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0, 0.3, (20, 5)), rng.normal(4, 0.3, (20, 5))])
    d = distance.distance_matrix(x, "euclidean")
    for make in (lambda s: embedding.tsne(d, iterations=400, seed=s), lambda s: embedding.umap(d, epochs=150, seed=s)):
        y = make(1)
        assert np.allclose(y, make(1)) and y.shape == (40, 2)
        far = ((y[:, None] - y[None]) ** 2).sum(2) + np.diag(np.full(40, np.inf))
        near = far.argsort(1)[:, :5]
        assert ((near < 20) == (np.arange(40) < 20)[:, None]).mean() > 0.95


def test_gaussian_null_keeps_spread():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((200, 6)) * [5, 1, 1, 1, 1, 1]
    y = linear.gaussian_null(x, rng)
    assert np.allclose(y.std(0), x.std(0), rtol=0.25)


def test_perplexity():
    d = distance.distance_matrix(np.random.default_rng(8).standard_normal((30, 3)), "euclidean")
    p = embedding.affinities(d, 8)
    assert p.sum() == pytest.approx(1, abs=1e-6) and (p == p.T).all() and math.isfinite(p.max())
