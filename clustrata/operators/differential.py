"""Negative-binomial differential expression with Wald tests, and its contrasts."""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import benjamini_hochberg, unique_rows
from ..functions.tails import f_quantile, normal_p

# The quantile of Cook's cutoff, replicates that bear a test for outliers and a replacement, steps of the filter's grid.
COOKS, TESTED, REPLACED, STEPS = 0.99, 3, 7, 50


def design_variables(design: str, columns: Sequence[str]) -> list[str]:
    """The columns that a formula names, as whole identifiers, in order of the formula."""
    words = re.findall(r"[A-Za-z_][A-Za-z0-9_.]*", design.split("~")[-1])
    return [w for w in dict.fromkeys(words) if w in columns]


def design_matrix(metadata: pd.DataFrame, design: str, reference: dict[str, str] | None = None) -> tuple[np.ndarray, list[str]]:
    """Columns of an additive formula: an intercept, numbers as they are, levels against the reference (the first)."""
    reference = reference or {}
    columns, names = [np.ones(len(metadata))], ["Intercept"]
    for v in design_variables(design, list(metadata.columns)):
        own = metadata[v]
        if pd.api.types.is_numeric_dtype(own) and not pd.api.types.is_bool_dtype(own) and f"C({v})" not in design.replace(" ", ""):
            columns.append(own.to_numpy(float))
            names.append(v)
            continue
        text = own.astype(str)
        base = reference.get(v, sorted(text.unique())[0])
        for level in sorted(set(text.unique()) - {base}):
            columns.append((text == level).to_numpy(float))
            names.append(f"{v}[{level}]")
    return np.stack(columns, 1), names


def fit_trend(points: list[tuple[float, float, float]]) -> tuple[float, float]:
    """(a1, a0) of the trend a1 / mean + a0 through (mean, dispersion, weight), by reweighted least squares.

    Points far from the trend (outside 1e-4 to 15 times it) are left out as the fit goes on.
    """
    if not points:
        return 1e-8, 1e-2
    mu, alpha, w = (np.array(c, float) for c in zip(*points, strict=True))
    a1, a0 = 0.1, max(float(np.average(alpha, weights=w)), 1e-8)
    for _ in range(50):
        trend = a1 / mu + a0
        use = (alpha / trend > 1e-4) & (alpha / trend < 15)
        if use.sum() < 2:
            break
        weight = w[use] / trend[use] ** 2  # the variance of a gamma variable goes with its squared mean
        x = np.stack([1 / mu[use], np.ones(use.sum())], 1)
        beta = np.linalg.lstsq(x * np.sqrt(weight)[:, None], alpha[use] * np.sqrt(weight), rcond=None)[0]
        new = max(float(beta[0]), 0.0), max(float(beta[1]), 1e-8)
        done = abs(new[0] - a1) < 1e-8 * (1 + a1) and abs(new[1] - a0) < 1e-8 * (1 + a0)
        a1, a0 = new
        if done:
            break
    return a1, a0


def _fit_means(k: np.ndarray, x: np.ndarray, offset: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coefficients, their covariance, means) by iteratively reweighted least squares with a little ridge."""
    beta = np.linalg.lstsq(x, np.log(np.maximum(k, 0.1)) - offset, rcond=None)[0]
    ridge = np.eye(x.shape[1]) * 1e-6
    for _ in range(100):
        mu = np.maximum(np.exp(np.clip(x @ beta + offset, -30, 30)), 1e-6)
        w = mu / (1 + alpha * mu)
        z = x @ beta + (k - mu) / mu
        new = np.linalg.solve(x.T @ (w[:, None] * x) + ridge, x.T @ (w * z))
        done = np.max(np.abs(new - beta)) < 1e-8
        beta = new
        if done:
            break
    mu = np.maximum(np.exp(np.clip(x @ beta + offset, -30, 30)), 1e-6)
    w = mu / (1 + alpha * mu)
    return beta, np.linalg.inv(x.T @ (w[:, None] * x) + ridge), mu


_lgamma = np.vectorize(math.lgamma)


def _profile(log_alpha: float, k: np.ndarray, mu: np.ndarray, x: np.ndarray, prior: tuple[float, float] | None) -> float:
    """Cox-Reid adjusted log likelihood of a dispersion, with a log-normal prior if there is one."""
    a = math.exp(log_alpha)
    r = 1 / a
    ll = (_lgamma(k + r) - math.lgamma(r) + k * np.log(a * mu / (1 + a * mu)) - r * np.log1p(a * mu)).sum()
    w = mu / (1 + a * mu)
    ll -= 0.5 * np.linalg.slogdet(x.T @ (w[:, None] * x))[1]
    return ll - (log_alpha - prior[0]) ** 2 / (2 * prior[1]) if prior else ll


def _best_dispersion(k: np.ndarray, mu: np.ndarray, x: np.ndarray, prior: tuple[float, float] | None = None) -> float:
    """The maximum over log dispersions, by golden sections of the best stretch of a grid."""
    grid = np.linspace(math.log(1e-8), math.log(max(10.0, len(k))), 20)
    at = int(np.argmax([_profile(g, k, mu, x, prior) for g in grid]))
    lo, hi = grid[max(0, at - 1)], grid[min(len(grid) - 1, at + 1)]
    ratio = (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        if _profile(a, k, mu, x, prior) > _profile(b, k, mu, x, prior):
            hi = b
        else:
            lo = a
    return math.exp((lo + hi) / 2)


def _trimmed(x: np.ndarray, share: float) -> float:
    """The mean without a share of the values at either end."""
    cut = int(share * len(x))
    return float(np.sort(x)[cut : len(x) - cut].mean())


def _robust_dispersion(q: np.ndarray, cells: np.ndarray, sizes: np.ndarray) -> float:
    """A dispersion by moments from trimmed variances: the largest of cells with replicates, or of all samples without any."""

    def variance(x: np.ndarray, share: float, scale: float) -> float:
        return scale * _trimmed((x - _trimmed(x, share)) ** 2, share)

    large = np.flatnonzero(sizes >= TESTED)
    kind = lambda n: (1 / 3, 2.04) if n <= 3 else (1 / 4, 1.86) if n <= 23 else (1 / 8, 1.51)
    v = max(variance(q[cells == c], *kind(sizes[c])) for c in large) if len(large) else variance(q, 1 / 8, 1.51)
    return max((v - q.mean()) / max(q.mean(), 1e-8) ** 2, 0.04)


def _cooks(k: np.ndarray, x: np.ndarray, offset: np.ndarray, mu: np.ndarray, cov: np.ndarray, alpha: float, robust: float) -> np.ndarray:
    """Cook's distance of each sample."""
    w = mu / (1 + alpha * mu)
    hat = np.minimum(w * np.einsum("ij,jk,ik->i", x, cov, x), 1 - 1e-12)
    return (k - mu) ** 2 / (mu + robust * mu**2) / x.shape[1] * hat / (1 - hat) ** 2


def lowess(x: np.ndarray, y: np.ndarray, share: float = 0.2, rounds: int = 5) -> np.ndarray:
    """Local straight lines with tricube weights, made robust by bisquare weights of the residuals."""
    r = math.ceil(share * len(x))
    near = np.abs(x[:, None] - x)
    reach = np.maximum(np.sort(near, 1)[:, min(r, len(x) - 1)], 1e-12)
    w, delta, out = (1 - np.clip(near / reach[:, None], 0, 1) ** 3) ** 3, np.ones(len(x)), np.zeros(len(x))
    for _ in range(rounds):
        for i in range(len(x)):
            root = np.sqrt(delta * w[i])
            line = np.linalg.lstsq(np.stack([root, root * x], 1), root * y, rcond=None)[0]
            out[i] = line[0] + line[1] * x[i]
        residual = y - out
        scale = float(np.median(np.abs(residual)))
        if not scale:
            break
        delta = (1 - np.clip(residual / (6 * scale), -1, 1) ** 2) ** 2
    return out


def independent_filtering(tested: DataFrame, zeros: int = 0, alpha: float = 0.05) -> DataFrame:
    """tested (baseMean, pvalue, ...) with padj: rates among the genes above a mean, null for those below.

    Of a grid of quantiles of the means it takes the lowest whose number of rejections comes up to the
    smoothed maximum less the spread around it; none if no quantile has more than 10. ``zeros`` is the
    number of genes of mean 0 that ``tested`` doesn't hold.
    """
    n = tested.agg(F.count("*").alias("n"), F.sum((F.col("baseMean") <= 0).cast("int")).alias("z")).first()
    if not n["n"]:
        return benjamini_hochberg(tested, "pvalue", name="padj")
    low = (zeros + n["z"]) / (zeros + n["n"])
    theta = np.linspace(low, 0.95 if low < 0.95 else 1.0, STEPS)
    means = tested.select("baseMean").unionByName(tested.sparkSession.range(zeros).select(F.lit(0.0).alias("baseMean")))
    cuts = means.agg(F.percentile("baseMean", F.array(*[F.lit(float(t)) for t in theta])).alias("c")).first()["c"]
    grid = tested.select("baseMean", "pvalue").where(F.col("pvalue").isNotNull()).withColumn("cut", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(c)).alias("c")) for i, c in enumerate(cuts)])))
    rates = benjamini_hochberg(grid.where("baseMean >= cut.c").select(F.col("cut.i").alias("i"), "pvalue"), "pvalue", ["i"])
    found = {r["i"]: r["n"] for r in rates.where(F.col("q") < alpha).groupBy("i").agg(F.count("*").alias("n")).collect()}
    rejected, at = np.array([found.get(i, 0) for i in range(STEPS)], float), 0
    if rejected.max() > 10:
        smooth, some = lowess(theta, rejected), rejected > 0
        enough = rejected > smooth.max() - math.sqrt(np.mean((rejected[some] - smooth[some]) ** 2))
        at = int(np.argmax(enough)) if enough.any() else 0
    used = F.when(F.col("baseMean") >= float(cuts[at]), F.col("pvalue"))
    return benjamini_hochberg(tested.withColumn("_used", used), "_used", name="padj").drop("_used")


def wald_test(counts: DataFrame, metadata: DataFrame, design: str, variable: str, test: str, control: str) -> DataFrame:
    """(gene, baseMean, log2FoldChange, lfcSE, stat, pvalue, padj) of test against control, by falling ``stat``.

    Genes are independent given size factors and the trend: two passes over groups of genes,
    first for gene-wise dispersions, then for shrunken ones and the test. Driver and tasks hold
    the design (one row per sample) and the trend's binned points.

    Counts beyond Cook's cutoff in cells of ``REPLACED`` samples or more are replaced by the trimmed mean
    and the gene is fitted again; in cells of ``TESTED`` or more that aren't replaced, they take the gene's
    p-value (null) unless three samples have larger counts. padj is that of ``independent_filtering``.
    """
    from .preprocess import size_factors

    counts = counts.withColumn("value", F.rint("value"))
    if counts.where(F.col("value") < 0).limit(1).count():
        raise ValueError("counts can't be negative")
    if counts.select("sample").distinct().exceptAll(metadata.select("sample").distinct()).limit(1).count():
        raise ValueError("a sample of the counts has no metadata")
    factors = {r["sample"]: r["size_factor"] for r in size_factors(unique_rows(counts, ["sample", "gene"], "a gene of a sample")).collect()}
    meta = unique_rows(metadata, ["sample"], "a sample of the metadata").where(F.col("sample").isin(list(factors))).toPandas().sort_values("sample").reset_index(drop=True)
    x, names = design_matrix(meta, design, {variable: control})
    target = f"{variable}[{test}]"
    if target not in names:
        raise ValueError(f"{target} is not a column of {design}")
    if np.linalg.matrix_rank(x) < x.shape[1]:
        raise ValueError(f"the design {design} is not of full rank")
    order = {s: i for i, s in enumerate(meta["sample"])}
    offset = np.log([factors[s] for s in meta["sample"]])
    at, n, m = names.index(target), *x.shape
    spark = counts.sparkSession
    shipped = spark.sparkContext.broadcast((x, offset, order))
    _, cells_, sizes = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    cells_ = cells_.ravel()  # each sample's cell of the design
    cutoff = f_quantile(COOKS, m, n - m) if n > m else math.inf
    genes = counts.groupBy("gene").agg(F.collect_list(F.struct("sample", "value")).alias("cells"), F.sum("value").alias("total"))
    rows = genes.where(F.col("total") > 0).select("gene", "cells")
    zeros = counts.groupBy("gene").agg(F.sum("value").alias("total")).where(F.col("total") <= 0).count()

    def vector(cells) -> np.ndarray:
        _, _, order = shipped.value
        k = np.zeros(len(order))
        for c in cells:
            k[order[c["sample"]]] = c["value"]
        return k

    def first(batches):
        x, offset, _ = shipped.value
        for pdf in batches:
            out = []
            for gene, cells in zip(pdf["gene"], pdf["cells"], strict=True):
                out.append((gene, *_gene_wise(vector(cells), x, offset)))
            yield pd.DataFrame(out, columns=["gene", "mu", "alpha"])

    gene_wise = rows.mapInPandas(first, "gene string, mu double, alpha double").persist()
    usable = gene_wise.where("alpha > 1e-7 and mu > 0")
    binned = usable.groupBy(F.floor(F.log2("mu") * 8).alias("b")).agg(F.avg("mu").alias("mu"), F.avg("alpha").alias("alpha"), F.count("*").alias("n"))
    a1, a0 = fit_trend([(r["mu"], r["alpha"], r["n"]) for r in binned.collect()])
    residual = F.ln("alpha") - F.ln(F.lit(a1) / F.col("mu") + F.lit(a0))
    centre = usable.agg(F.median(residual).alias("m")).first()["m"] or 0.0
    mad = usable.agg(F.median(F.abs(residual - F.lit(centre))).alias("s")).first()["s"] or 0.0
    spread = 1.4826 * mad
    prior = max(spread**2 - _trigamma((n - m) / 2), 0.25)

    def shrunken(k: np.ndarray, x: np.ndarray, offset: np.ndarray, base: float, alpha: float):
        trend = a1 / max(base, 1e-8) + a0
        if alpha > 1e-7 and math.log(alpha) > math.log(trend) + 2 * spread and spread > 0:
            use = alpha
        else:
            _, _, mu = _fit_means(k, x, offset, trend)
            use = _best_dispersion(k, mu, x, (math.log(trend), prior))
        return use, *_fit_means(k, x, offset, use)

    def second(batches):
        x, offset, _ = shipped.value
        many = sizes[cells_]  # replicates of each sample
        for pdf in batches:
            out = []
            for gene, cells, base, alpha in zip(pdf["gene"], pdf["cells"], pdf["mu"], pdf["alpha"], strict=True):
                k = vector(cells)
                use, beta, cov, mu = shrunken(k, x, offset, base, alpha)
                far = _cooks(k, x, offset, mu, cov, use, _robust_dispersion(k / np.exp(offset), cells_, sizes))
                outlier = False
                if (beyond := far > cutoff).any():
                    replaced = many >= REPLACED
                    asked = beyond & (many >= TESTED) & ~replaced
                    outlier = bool(asked.any()) and int((k > k[np.argmax(far)]).sum()) < 3
                    if (beyond & replaced).any():
                        new = np.where(beyond & replaced, np.floor(_trimmed(k / np.exp(offset), 0.2) * np.exp(offset)), k)
                        if not new.any():
                            out.append((gene, 0.0, 0.0, 0.0, 0.0, outlier))
                            continue
                        base, alpha = _gene_wise(new, x, offset)
                        use, beta, cov, mu = shrunken(new, x, offset, base, alpha)
                se = math.sqrt(max(cov[at, at], 1e-300))
                out.append((gene, base, beta[at] / math.log(2), se / math.log(2), beta[at] / se, outlier))
            yield pd.DataFrame(out, columns=["gene", "baseMean", "log2FoldChange", "lfcSE", "stat", "outlier"])

    tested = rows.join(gene_wise, "gene").mapInPandas(second, "gene string, baseMean double, log2FoldChange double, lfcSE double, stat double, outlier boolean")
    tested = tested.withColumn("pvalue", F.when(~F.col("outlier"), normal_p("stat"))).drop("outlier").persist()  # the filter reads it three times
    return independent_filtering(tested, zeros).orderBy(F.desc("stat"), "gene")


def _gene_wise(k: np.ndarray, x: np.ndarray, offset: np.ndarray) -> tuple[float, float]:
    """(mean of the normalised counts, dispersion) of a gene by itself."""
    q = k / np.exp(offset)
    rough = max((q.var(ddof=1) - q.mean()) / max(q.mean(), 1e-8) ** 2, 0.01)
    _, _, mu = _fit_means(k, x, offset, rough)
    return float(q.mean()), _best_dispersion(k, mu, x)


def _trigamma(v: float) -> float:
    out = 0.0
    while v < 6:
        out += 1 / v**2
        v += 1
    return out + 1 / v + 1 / (2 * v**2) + 1 / (6 * v**3) - 1 / (30 * v**5)


def contrasts(partition: DataFrame, mode: str = "both", min_group: int = 3) -> list[tuple[str, list, list | None]]:
    """(tag, test clusters, control clusters; none: all others) of clusters with enough members."""
    sizes = {r["cluster"]: r["count"] for r in partition.groupBy("cluster").count().collect()}  # one row per cluster
    large = sorted(c for c, n in sizes.items() if n >= min_group)
    out: list[tuple[str, list, list | None]] = []
    if mode in ("both", "ova") and len(sizes) > 1:
        out += [(f"c{c}_vs_rest", [c], None) for c in large]
    if mode in ("both", "ovo"):
        out += [(f"c{a}_vs_c{b}", [a], [b]) for a, b in itertools.combinations(large, 2)]
    return out


def cluster_differential(counts: DataFrame, partition: DataFrame, mode: str = "both", min_group: int = 3, min_count: float = 10) -> DataFrame:
    """(contrast, gene, ...) of every contrast of a partition; the rest of one-vs-rest includes small clusters."""
    from .preprocess import min_count_genes

    out = None
    for tag, test, control in contrasts(partition, mode, min_group):
        own = partition if control is None else partition.where(F.col("cluster").isin(test + control))
        meta = own.select("sample", F.when(F.col("cluster").isin(test), "test").otherwise("control").alias("group"))
        used = min_count_genes(counts.join(meta, "sample", "left_semi"), min_count)
        one = wald_test(used, meta, "~ group", "group", "test", "control").select(F.lit(tag).alias("contrast"), "*")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no cluster has enough members")
    return out


def clinical_differential(counts: DataFrame, metadata: DataFrame, design: str, variable: str, test: str, control: str, min_count: float = 10, min_group: int = 3) -> DataFrame:
    """An adjusted test over the samples with one of two levels and all the design's variables; each level needs ``min_group`` of them."""
    from .preprocess import min_count_genes

    needed = design_variables(design, metadata.columns)
    if variable not in needed:
        raise ValueError(f"the design {design} doesn't name {variable}")
    complete = metadata.where(F.col(variable).isin(test, control))
    for v in needed:
        complete = complete.where(F.col(v).isNotNull())
    sizes = {r["level"]: r["count"] for r in complete.groupBy(F.col(variable).cast("string").alias("level")).count().collect()}  # two rows
    few = [f"{level} has {sizes.get(level, 0)}" for level in (test, control) if sizes.get(level, 0) < min_group]
    if few:
        raise ValueError(f"{variable}: each level needs {min_group} complete samples, but {' and '.join(few)}")
    used = min_count_genes(counts.join(complete.select("sample"), "sample", "left_semi"), min_count)
    return wald_test(used, complete.select("sample", *needed), design, variable, test, control)
