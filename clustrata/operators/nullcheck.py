"""Null models: how ambiguous a consensus is without structure."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .consensus import Drawn, ambiguity, draw_counts
from .resample import medoid_labels

KEYS = ("model", "rep")
MODELS = ("observed", "permuted", "gaussian")


def gaussian_null(df: DataFrame, rep: int = 0, n_pc: int = 50, seed: int = 0) -> DataFrame:
    """Gaussian values with the gene means of the matrix and the covariance of its first components.

    With more samples than genes the driver holds a matrix of genes by genes only: tasks add up its
    parts and draw their samples' values, seeded by (seed, rep, hash of the name). Else the matrix (of checked
    size) is one kernel's.
    """
    from .kernels.linear import MOST_CELLS, dense, leading_rows
    from .kernels.linear import gaussian_null as kernel

    spark, cell = df.sparkSession, F.struct("gene", F.col("value").cast("double").alias("v"))
    rows = df.groupBy("sample").agg(F.array_sort(F.collect_list(cell)).alias("c")).persist()  # as long as the input; made once, read three times
    n = rows.count()
    means = rows.select(F.inline("c")).groupBy("gene").agg(F.count("*").alias("n"), F.avg("v").alias("m")).orderBy("gene").collect()
    p, schema = len(means), df.select("sample", "gene", F.col("value").cast("double").alias("value")).schema
    if n <= p:
        samples, genes, x = dense(df)
        made = kernel(x, np.random.default_rng([seed, rep]), n_pc)
        pdf = pd.DataFrame({"sample": np.repeat(samples, len(genes)), "gene": np.tile(genes, len(samples)), "value": made.ravel()})
        return spark.createDataFrame(pdf, schema)
    if p * p > MOST_CELLS:
        raise ValueError(f"{p} genes are more than a kernel may hold; select genes first")
    if any(r["n"] != n for r in means):
        raise ValueError("a cell is missing or occurs more than once")
    genes, mean = [r["gene"] for r in means], np.array([r["m"] for r in means], float)

    def products(batches):
        total, some = np.zeros((p, p)), False
        for pdf in batches:
            x = np.stack(pdf["v"].to_list()) - mean
            total, some = total + x.T @ x, True
        if some:
            yield pd.DataFrame({"i": np.arange(p), "row": list(total)})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "row": [np.sum(pdf["row"].to_list(), axis=0)]})

    parts = rows.select(F.col("c.v").alias("v")).mapInPandas(products, "i int, row array<double>").groupBy("i").applyInPandas(add, "i int, row array<double>")
    gram = np.zeros((p, p))
    for r in parts.toLocalIterator():
        gram[r["i"]] = r["row"]
    mixed = leading_rows(gram, min(n_pc, p)) / np.sqrt(n)

    def draw(batches):
        for pdf in batches:
            z = np.stack([np.random.default_rng([seed, rep, int(h) & (2**64 - 1)]).standard_normal(len(mixed)) for h in pdf["h"]])
            yield pd.DataFrame({"sample": np.repeat(pdf["sample"].to_numpy(), p), "gene": np.tile(np.array(genes, object), len(pdf)), "value": (mean + z @ mixed).ravel()})

    return rows.select("sample", F.xxhash64("sample").alias("h")).mapInPandas(draw, schema)


def permuted_replicates(df: DataFrame, n_null: int) -> DataFrame:
    """(rep, sample, gene, value): as ``permute_genes`` for rep = 0 .. n_null - 1, in one pass without a join.

    A group is one gene's samples of one replicate: names in order are laid beside values in hash order.
    """
    many = df.select("sample", "gene", "value", F.explode(F.sequence(F.lit(0), F.lit(n_null - 1))).alias("rep"))
    order = F.md5(F.concat_ws(":", F.col("rep").cast("string"), "gene", F.col("sample").cast("string")).cast("binary"))
    dealt = many.groupBy("rep", "gene").agg(F.array_sort(F.collect_list("sample")).alias("s"), F.array_sort(F.collect_list(F.struct(order.alias("h"), "sample", "value"))).alias("v"))
    return dealt.select("rep", "gene", F.inline(F.arrays_zip(F.col("s").alias("sample"), F.col("v.value").alias("value")))).select("rep", "sample", "gene", "value")


def null_matrices(df: DataFrame, n_null: int = 3) -> DataFrame:
    """(model, rep, sample, gene, value): the matrix as observed, and with each gene's values dealt anew ``n_null`` times."""
    seen = df.select(F.lit("observed").alias("model"), F.lit(0).alias("rep"), "sample", "gene", "value")
    return seen.unionByName(permuted_replicates(df, n_null).select(F.lit("permuted").alias("model"), "rep", "sample", "gene", "value"))


def hashed_comparison(df: DataFrame, k_values: list[int], n_null: int = 3, n_draws: int = 20, samples: int | None = None, **options) -> DataFrame:
    """(model, rep, k, pac, auc, delta) with draws and labels by hash, as any engine can make them.

    The matrices are one table and the models keys of it from the labels to the areas: one
    plan, whose joins and aggregates are dealt by model, replicate and draw; pairs are counted in blocks
    and never rows. ``samples``: about how many there are (else they are counted).
    """
    labels = medoid_labels(null_matrices(df, n_null), n_draws, k_values, keys=KEYS, **options)
    return ambiguity(Drawn(labels, KEYS, n_draws, max(k_values), samples).distribution(), KEYS)


def null_comparison(df: DataFrame, k_values: list[int], n_null: int = 3, n_resamples: int = 200, prop_samples: float = 0.8, prop_genes: float = 0.8, sample_mode: str = "subsample", gene_mode: str = "subsample", base: str = "hierarchical", metric: str = "pearson", linkage: str = "average", seed: int = 0, n_pc: int = 50, partitions: int = 32) -> DataFrame:
    """(model, rep, k, pac, auc, delta) of the observed matrix and of replicates of both null models.

    One nested resampling job over (model, replicate, draws): the observed matrix (of checked
    size) is broadcast once, and a task makes its replicate's matrix from the seed, so no null
    matrix is stored or sent. Each task adds up its draws before the shuffle.
    """
    from .kernels.cluster import draw_labels
    from .kernels.linear import dense
    from .kernels.linear import gaussian_null as gaussian

    names, _, x = dense(df)
    spark = df.sparkSession
    shipped = spark.sparkContext.broadcast((names, x))
    options = {"base": base, "metric": metric, "linkage": linkage}
    runs = [("observed", 0), *((m, r) for r in range(n_null) for m in MODELS[1:])]
    shares = max(1, min(n_resamples, partitions // len(runs)))
    work = [(m, r, lo, -(-n_resamples // shares)) for m, r in runs for lo in range(0, n_resamples, -(-n_resamples // shares))]

    def matrix(x: np.ndarray, model: str, rep: int) -> np.ndarray:
        rng = np.random.default_rng([seed, rep, MODELS.index(model)])
        if model == "permuted":
            return rng.permuted(x, axis=0)
        return gaussian(x, rng, n_pc) if model == "gaussian" else x

    def run(batches):
        names, x = shipped.value
        for pdf in batches:
            for model, rep, lo, size in pdf.itertuples(index=False):
                own = matrix(x, model, int(rep))
                draws = range(int(lo), min(int(lo) + int(size), n_resamples))
                found = draw_counts(own, k_values, draws, [seed, int(rep)], (prop_samples, prop_genes), (sample_mode, gene_mode), lambda part, rng: draw_labels(part, k_values, rng, **options))
                yield from (t.assign(model=model, rep=rep, i=names[t["i"]], j=names[t["j"]])[["model", "rep", "k", "i", "j", "m", "n_co"]] for t in found)

    kind = df.schema["sample"].dataType.simpleString()
    tasks = spark.createDataFrame(work, "model string, rep int, lo int, size int").repartition(len(work))
    parts = tasks.mapInPandas(run, f"model string, rep int, k int, i {kind}, j {kind}, m bigint, n_co bigint")
    total = parts.groupBy(*KEYS, "k", "i", "j").agg(F.sum("m").alias("m"), F.sum("n_co").alias("n_co"))
    return ambiguity(total.withColumn("consensus", F.when(F.col("n_co") > 0, F.col("m") / F.col("n_co")).otherwise(0.0)), KEYS)


def null_summary(comparison: DataFrame) -> DataFrame:
    """(model, k, pac_mean, pac_min, pac_max, delta_mean, delta_min, delta_max) over the replicates."""
    stats = [f(c).alias(f"{c}_{n}") for c in ("pac", "delta") for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]
    return comparison.groupBy("model", "k").agg(*stats)


def null_gaps(summary: DataFrame, models: Sequence[str] = MODELS[1:]) -> DataFrame:
    """(k, then for each null model gap_..): how far the observed PAC lies below the least of the model's replicates."""
    at = lambda model, c: F.max(F.when(F.col("model") == model, F.col(c)))
    return summary.groupBy("k").agg(*[(at(m, "pac_min") - at("observed", "pac_mean")).alias(f"gap_{m}") for m in models])
