"""Stabilised independent components, the scan of dimensions and the choice among them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def candidate_dimensions(least: int, most: int, step: int, n: int, p: int) -> list[int]:
    """From the least by steps, and always the greatest that the matrix allows."""
    top = min(most, n - 1, p)
    if top < least:
        raise ValueError(f"{n} samples and {p} genes allow {top} components, fewer than {least}")
    return sorted({*range(least, top + 1, step), top})


@dataclass(frozen=True)
class Whitening:
    """One whitening of genes as observations, shared by all dimensions."""

    white: np.ndarray  # dimensions x genes
    mean: np.ndarray  # per sample


def whiten(x: np.ndarray, most: int) -> Whitening:
    """Whiten the genes of a samples x genes array to ``most`` dimensions."""
    if x.ndim != 2 or x.shape[0] < 3 or not np.isfinite(x).all() or np.ptp(x) == 0:
        raise ValueError("a finite matrix of three samples or more that isn't constant is needed")
    if (flat := np.flatnonzero(np.ptp(x, axis=1) == 0)).size:
        raise ValueError(f"{flat.size} samples have the same value for every gene")
    mean = x.mean(1)
    return Whitening(white_rows(x - mean[:, None], None, most), mean)


def white_rows(centred: np.ndarray, weights: np.ndarray | None, most: int) -> np.ndarray:
    """``most`` rows that are white under the weights, from the smaller of the two Gram matrices of a centred array."""
    n, p = centred.shape
    total = p if weights is None else weights.sum()
    if n <= p:
        values, u = np.linalg.eigh((centred if weights is None else centred * weights) @ centred.T / total)
        order = np.argsort(values)[::-1][:most]
        scale = np.sqrt(np.maximum(values[order], 1e-12))
        return (u[:, order] / scale).T @ centred
    # the same eigenvalues from columns: u = centred sqrt(w) v / sqrt(value total), so no matrix of rows by rows is formed
    gram = centred.T @ centred
    root = np.ones(p) if weights is None else np.sqrt(weights)
    values, v = np.linalg.eigh(root[:, None] * gram * root / total)
    order = np.argsort(values)[::-1][:most]
    scale = np.maximum(values[order], 1e-12) * np.sqrt(total)
    return (v[:, order] / scale).T @ (root[:, None] * gram)


def _contrast(name: str):
    if name == "logcosh":
        return lambda u: (np.tanh(u), 1 - np.tanh(u) ** 2)
    if name == "exp":
        return lambda u: (u * np.exp(-(u**2) / 2), (1 - u**2) * np.exp(-(u**2) / 2))
    if name == "cube":
        return lambda u: (u**3, 3 * u**2)
    raise ValueError(f"unknown contrast {name!r}")


def bootstrap_weights(n: int, rng: np.random.Generator) -> np.ndarray:
    """How often each of n observations is drawn, with replacement, in n draws."""
    return np.bincount(rng.integers(0, n, n), minlength=n).astype(float)


def weighted_whitening(x: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """All observations (columns) of ``x`` as ``most`` rows that are white under the weights.

    The weighted Gram matrix stands for the drawn columns: no column is copied, and what an
    observation that wasn't drawn would be is known too, so that runs can be compared.
    """
    centred = x - (x @ weights / weights.sum())[:, None]
    return white_rows(centred, weights, most)


def resampled(resampling: str | None, x: np.ndarray, white: np.ndarray, most: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray | None]:
    """(white rows, weights) of one run: the shared whitening, one of drawn genes, or one of drawn genes within the shared one."""
    if not resampling:
        return white, None
    weights = bootstrap_weights(x.shape[1], rng)
    if resampling == "bootstrap":
        return weighted_whitening(x, weights, most), weights
    if resampling == "fast_bootstrap":
        return weighted_whitening(white, weights, most), weights
    raise ValueError(f"unknown resampling {resampling!r}")


def fast_ica(white: np.ndarray, rng: np.random.Generator, fun: str = "logcosh", max_iter: int = 2000, tol: float = 1e-4, weights: np.ndarray | None = None, deflate: bool = False) -> np.ndarray:
    """Fixed-point iteration on whitened rows; independent rows of unit variance. ``weights`` count the columns.

    Rows are found together and decorrelated symmetrically, or one after the other (``deflate``).
    """
    g = _contrast(fun)
    d, n = white.shape
    share = np.full(n, 1 / n) if weights is None else weights / weights.sum()
    if deflate:
        found = np.zeros((0, d))
        for _ in range(d):
            one = rng.standard_normal(d)
            for _ in range(max_iter):
                before = one / np.linalg.norm(one)
                value, slope = g(before @ white)
                one = white @ (value * share) - (slope @ share) * before
                one = one - found.T @ (found @ one)
                one /= np.linalg.norm(one)
                if 1 - abs(one @ before) < tol**2:
                    break
            found = np.vstack([found, one])
        return found @ white

    def decorrelated(w: np.ndarray) -> np.ndarray:
        s, u = np.linalg.eigh(w @ w.T)
        return u @ np.diag(1 / np.sqrt(np.maximum(s, 1e-12))) @ u.T @ w

    w = decorrelated(rng.standard_normal((d, d)))
    for _ in range(max_iter):
        value, slope = g(w @ white)
        new = decorrelated((value * share) @ white.T - (slope @ share)[:, None] * w)
        change = np.max(np.abs(np.abs(np.einsum("ij,ij->i", new, w)) - 1))
        w = new
        if change < tol:
            break
    return w @ white


def stabilise(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(components, indices): centrotypes of the clusters of all runs' components, the most stable first.

    Components cluster by average linkage on one less |correlation|; the index is the mean
    similarity within a cluster less that to the rest.
    """
    from .kernels.cluster import cut_tree, linkage_tree

    d = len(runs[0])
    every = np.concatenate(runs)
    similar = np.abs(np.corrcoef(every)) if len(every) > 1 else np.ones((1, 1))
    similar = np.clip(np.nan_to_num(similar), 0, 1)
    labels = cut_tree(linkage_tree(1 - similar), len(every), d) if len(every) > 1 else np.ones(1, int)
    found = []
    for c in np.unique(labels):
        own = np.flatnonzero(labels == c)
        rest = np.flatnonzero(labels != c)
        within = similar[np.ix_(own, own)]
        index = within.mean() - (similar[np.ix_(own, rest)].mean() if len(rest) else 0)
        centre = every[own[within.sum(1).argmax()]]
        sign = np.sign(centre[np.abs(centre).argmax()]) or 1.0
        found.append((index, centre * sign))
    found.sort(key=lambda f: -f[0])
    return np.stack([c for _, c in found]), np.array([i for i, _ in found])


def scan(df: DataFrame, least: int = 6, most: int = 8, step: int = 1, n_runs: int = 100, fun: str = "logcosh", max_iter: int = 2000, seed: int = 0, resampling: str | None = None, deflate: bool = False) -> tuple[DataFrame, DataFrame]:
    """(components (dim, component, stability, metagene, metasample), status (dim, error)).

    One task per run and dimension; runs of a dimension meet to be stabilised. With
    ``resampling`` a run draws genes with replacement, the same for every dimension:
    ``bootstrap`` whitens the draw, ``fast_bootstrap`` only within the shared whitened space. A
    dimension that fails leaves an error, not an exception. Genes and samples are in order of name.
    """
    from .kernels.linear import dense

    if resampling not in (None, "", "bootstrap", "fast_bootstrap"):
        raise ValueError(f"unknown resampling {resampling!r}")
    _, _, x = dense(df)
    dims = candidate_dimensions(least, most, step, *x.shape)
    white = whiten(x, max(dims))
    spark = df.sparkSession
    shipped = spark.sparkContext.broadcast((white.white, x - white.mean[:, None]))
    # a bootstrap is whitened once for all dimensions of a run, so these share a task
    tasks = spark.createDataFrame([(r, own) for r in range(n_runs) for own in ([dims] if resampling == "bootstrap" else [[d] for d in dims])], "run int, dims array<int>")

    def fit(batches):
        w, centred = shipped.value
        for pdf in batches:
            for r, own in zip(pdf["run"], pdf["dims"], strict=True):
                draw = lambda d: resampled(resampling, centred, w[:d], d, np.random.default_rng([seed, int(r)]))
                once = draw(max(dims)) if resampling == "bootstrap" else None
                for d in own:
                    try:
                        rows, weights = (once[0][:d], once[1]) if once else draw(d)
                        got, error = fast_ica(rows, np.random.default_rng([seed, int(d), int(r)]), fun, max_iter, weights=weights, deflate=deflate), ""
                    except (ValueError, np.linalg.LinAlgError) as e:
                        got, error = np.zeros((0, 0)), str(e)
                    yield pd.DataFrame({"dim": [d], "run": [r], "values": [got.ravel()], "error": [error]})

    fits = tasks.repartition(min(len(dims) * n_runs, 200), "run", "dims").mapInPandas(fit, "dim int, run int, values array<double>, error string")

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        d = int(pdf["dim"].iloc[0])
        columns = ["dim", "component", "stability", "metagene", "metasample", "error"]
        bad = [e for e in pdf["error"] if e]
        if bad:
            return pd.DataFrame([(d, None, None, None, None, bad[0])], columns=columns)
        s, index = stabilise([np.asarray(v).reshape(d, -1) for v in pdf.sort_values("run")["values"]])
        _, centred = shipped.value
        scores = centred @ np.linalg.pinv(s)
        return pd.DataFrame([(d, f"IC{i + 1:02d}", float(index[i]), s[i], scores[:, i], "") for i in range(len(s))], columns=columns)

    both = fits.groupBy("dim").applyInPandas(join, "dim int, component string, stability double, metagene array<double>, metasample array<double>, error string")
    return both.where(F.col("component").isNotNull()).drop("error"), both.select("dim", F.nullif("error", F.lit("")).alias("error")).distinct()


def profile(components: DataFrame, threshold: float = 0.6) -> DataFrame:
    """(dim, mean, median, min, max, n_stable) of the stability indices."""
    s = F.col("stability")
    return components.groupBy("dim").agg(F.avg(s).alias("mean"), F.median(s).alias("median"), F.min(s).alias("min"), F.max(s).alias("max"), F.count_if(s >= threshold).alias("n_stable"))


def segmented_elbow(summary: DataFrame) -> DataFrame:
    """(dim, sse): where two straight lines, each over two dimensions or more, fit the means best; none below four.

    Running sums give both lines' errors at every split in one window.
    """
    x, y = F.col("dim").cast("double"), F.col("mean")
    base = summary.select("dim", x.alias("x"), y.alias("y"))
    left = Window.orderBy("dim").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    right = Window.orderBy("dim").rowsBetween(1, Window.unboundedFollowing)

    def error(w) -> F.Column:
        n, sx, sy = F.count("*").over(w), F.sum("x").over(w), F.sum("y").over(w)
        sxx, sxy, syy = (F.sum(a * b).over(w) for a, b in ((F.col("x"), F.col("x")), (F.col("x"), F.col("y")), (F.col("y"), F.col("y"))))
        xx, xy, yy = sxx - sx * sx / F.nullif(n, F.lit(0)), sxy - sx * sy / F.nullif(n, F.lit(0)), syy - sy * sy / F.nullif(n, F.lit(0))
        return F.when(n >= 2, yy - xy * xy / F.when(xx > 0, xx))

    splits = base.select("dim", error(left).alias("a"), error(right).alias("b")).where("a is not null and b is not null")
    return splits.select("dim", F.round(F.greatest(F.col("a") + F.col("b"), F.lit(0.0)), 12).alias("sse")).orderBy("sse", "dim").limit(1)


def k_lines(profiles: dict[int, Sequence[float]], max_iter: int = 100) -> float | None:
    """Where the two main lines of (rank, stability) points cross, as a dimension; none if they don't.

    Total least squares in turn with assignment to the nearer line, from the two axes.
    """
    points = [(r, s) for values in profiles.values() for r, s in enumerate(sorted(values, reverse=True), 1)]
    x = np.array(points, float)
    if len(x) < 4:
        return None
    top = x[:, 0].max()
    x[:, 0] /= top
    lines = [(np.zeros(2), np.array([1.0, 0.0])), (np.zeros(2), np.array([0.0, 1.0]))]
    labels = None
    for _ in range(max_iter):
        far = np.stack([np.abs((x - c) @ np.array([-v[1], v[0]])) for c, v in lines], 1)
        new = far.argmin(1)
        if labels is not None and (new == labels).all():
            break
        labels = new
        lines = []
        for k in (0, 1):
            own = x[labels == k]
            if len(own) < 2:
                return None
            c = own.mean(0)
            lines.append((c, np.linalg.svd(own - c)[2][0]))
    (c0, v0), (c1, v1) = lines
    m = np.stack([v0, -v1], 1)
    if abs(np.linalg.det(m)) <= 1e-8:
        return None
    t = np.linalg.solve(m, c1 - c0)
    return float((c0 + t[0] * v0)[0] * top)


@dataclass(frozen=True)
class Selection:
    dim: int
    method: str
    roles: dict[int, list[str]]


def select_dimension(summary: DataFrame, components: DataFrame, threshold: float = 0.6, most: int = 4) -> Selection:
    """The most stable dimension by crossing lines, else the elbow, else the threshold, else the best mean; and its neighbours."""
    rows = {r["dim"]: r["mean"] for r in summary.collect()}  # one row per tested dimension
    dims = sorted(rows)
    lists: dict[int, list[float]] = {d: [] for d in dims}
    for r in components.select("dim", "stability").collect():
        lists[r["dim"]].append(r["stability"])
    best = min(dims, key=lambda d: (-rows[d], d))
    at = k_lines(lists)
    elbow = segmented_elbow(summary).first() if len(dims) >= 4 else None
    stable = [d for d in dims if rows[d] >= threshold]
    if at is not None and dims[0] <= at <= dims[-1]:
        chosen, method = min(dims, key=lambda d: (abs(d - at), d)), "k_lines"
    elif elbow is not None:
        chosen, method = elbow["dim"], "segmented"
    elif stable:
        chosen, method = max(stable), "threshold"
    else:
        chosen, method = best, "best_mean"
    roles: dict[int, list[str]] = {}
    lower, higher = [d for d in dims if d < chosen], [d for d in dims if d > chosen]
    for d, role in ((chosen, "mstd"), (max(lower, default=None), "nearest_lower"), (min(higher, default=None), "nearest_higher"), (best, "best_mean")):
        if d is not None and (d in roles or len(roles) < most):
            roles.setdefault(d, []).append(role)
    return Selection(chosen, method, roles)


def long_metasamples(components: DataFrame, dim: int, samples: Sequence) -> DataFrame:
    """(sample, component, value) of one dimension; samples in order of name."""
    names = F.array(*[F.lit(s) for s in samples])
    pairs = F.arrays_zip(names.alias("sample"), F.col("metasample").alias("value"))
    return components.where(F.col("dim") == dim).select("component", F.inline(pairs)).toDF("component", "sample", "value").select("sample", "component", "value")


def long_metagenes(components: DataFrame, dim: int, genes: Sequence) -> DataFrame:
    """(ranking, gene, score) of one dimension, ready for enrichment; genes in order of name."""
    names = F.array(*[F.lit(g) for g in genes])
    pairs = F.arrays_zip(names.alias("gene"), F.col("metagene").alias("score"))
    return components.where(F.col("dim") == dim).select("component", F.inline(pairs)).toDF("ranking", "gene", "score")


def top_genes(weights: DataFrame, n: int = 12) -> DataFrame:
    """The n genes with the largest |score| of each ranking."""
    order = Window.partitionBy("ranking").orderBy(F.desc(F.abs("score")), "gene")
    return weights.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
