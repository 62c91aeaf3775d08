"""Filters and normalisation of long matrices ``(sample, gene, value)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Prefixes of technical genes, matched at the start of a name, whatever the case.
TECHNICAL = (r"^RP[LS]", r"^MT-", r"^MRP[LS]", r"^HB[ABDEGMQZ]\d?$")


def _keep(df: DataFrame, genes: DataFrame) -> DataFrame:
    return df.join(genes, "gene", "left_semi")


def drop_zero_genes(df: DataFrame) -> DataFrame:
    """Genes with a positive value in some sample."""
    return _keep(df, df.groupBy("gene").agg(F.max("value").alias("m")).where(F.col("m") > 0).select("gene"))


def with_cpm(df: DataFrame) -> DataFrame:
    """df with counts per million; an empty library counts as one read.

    Library sizes come from an aggregate with partial states; one row per sample joins back.
    """
    size = df.groupBy("sample").agg(F.sum("value").alias("_size"))
    return df.join(size, "sample").withColumn("cpm", F.col("value") / F.greatest(F.col("_size"), F.lit(1.0)) * 1e6).drop("_size")


def filter_low_expression(df: DataFrame, min_cpm: float = 1.0, min_frac_samples: float = 0.2) -> DataFrame:
    """Genes that reach ``min_cpm`` in that share of samples."""
    share = with_cpm(df).groupBy("gene").agg(F.avg((F.col("cpm") >= min_cpm).cast("double")).alias("s"))
    return _keep(df, share.where(F.col("s") >= min_frac_samples).select("gene"))


def drop_technical(df: DataFrame, patterns: Sequence[str] = TECHNICAL) -> DataFrame:
    """Genes whose name starts with none of the patterns."""
    start = [p if p.startswith("^") else "^" + p for p in patterns]
    return df.where(~F.col("gene").rlike("(?i)" + "|".join(f"(?:{p})" for p in start))) if start else df


def log_cpm(df: DataFrame, prior: float = 1.0) -> DataFrame:
    """log2 of counts per million and a prior."""
    return with_cpm(df).select("sample", "gene", F.log2(F.col("cpm") + prior).alias("value"))


def gene_scores(df: DataFrame, method: str = "mad") -> DataFrame:
    """(gene, score): median absolute deviation or population variance."""
    if method == "var":
        return df.groupBy("gene").agg(F.var_pop("value").alias("score"))
    if method != "mad":
        raise ValueError(f"unknown variance method {method!r}")
    centre = df.groupBy("gene").agg(F.median("value").alias("_m"))
    return df.join(centre, "gene").groupBy("gene").agg(F.median(F.abs(F.col("value") - F.col("_m"))).alias("score"))


def top_genes(df: DataFrame, n: int, method: str = "mad") -> DataFrame:
    """The n most variable genes; of equal scores the last names come first."""
    best = gene_scores(df, method).withColumn("score", F.round("score", 12)).orderBy(F.desc("score"), F.desc("gene")).limit(n)
    return _keep(df, best.select("gene"))


def centre_genes(df: DataFrame, scale: bool = False) -> DataFrame:
    """Values less their gene's median; with ``scale`` over 1.4826 times its MAD (at least 1e-8)."""
    centre = df.groupBy("gene").agg(F.median("value").alias("_m"))
    out = df.join(centre, "gene").withColumn("value", F.col("value") - F.col("_m"))
    if scale:
        mad = out.groupBy("gene").agg(F.median(F.abs("value")).alias("_s"))
        out = out.join(mad, "gene").withColumn("value", F.col("value") / F.greatest(1.4826 * F.col("_s"), F.lit(1e-8)))
    return out.select("sample", "gene", "value")


def size_factors(df: DataFrame) -> DataFrame:
    """(sample, size_factor): median ratio to the genes' geometric means, over genes positive everywhere."""
    means = df.groupBy("gene").agg(F.min("value").alias("_lo"), F.avg(F.when(F.col("value") > 0, F.ln("value"))).alias("_mean")).where(F.col("_lo") > 0)
    ratio = df.join(means, "gene").select("sample", (F.ln("value") - F.col("_mean")).alias("r"))
    return ratio.groupBy("sample").agg(F.exp(F.median("r")).alias("size_factor"))


def vst(df: DataFrame) -> DataFrame:
    """Variance-stabilised counts with the parametric dispersion trend of a design of one mean.

    Size factors and each gene's mean and moment dispersion are aggregates; the two trend
    coefficients (one row) are fitted on per-gene rows binned by mean, and the closed-form
    transform is an expression. Counts are rounded; negative values are an error.
    """
    from .differential import fit_trend

    counts = df.withColumn("value", F.rint("value"))
    if counts.where(F.col("value") < 0).limit(1).count():
        raise ValueError("counts can't be negative")
    scaled = counts.join(size_factors(counts), "sample").withColumn("q", F.col("value") / F.col("size_factor"))
    moments = scaled.groupBy("gene").agg(F.avg("q").alias("mu"), F.var_samp("q").alias("v"), F.avg(1 / F.col("size_factor")).alias("z"))
    usable = moments.select("mu", ((F.col("v") - F.col("z") * F.col("mu")) / (F.col("mu") * F.col("mu"))).alias("alpha")).where("mu > 0 and alpha > 1e-8")
    # a fixed number of bins by log mean bounds what reaches the driver
    binned = usable.groupBy(F.floor(F.log2("mu") * 8).alias("bin")).agg(F.avg("mu").alias("mu"), F.avg("alpha").alias("alpha"), F.count("*").alias("n"))
    a1, a0 = fit_trend([(r["mu"], r["alpha"], r["n"]) for r in binned.collect()])
    q = F.col("q")
    out = F.log2((1 + a1 + 2 * a0 * q + 2 * F.sqrt(a0 * q * (1 + a1 + a0 * q))) / (4 * a0))
    return scaled.select("sample", "gene", out.alias("value"))


def preprocess(df: DataFrame, norm_method: str = "logcpm", min_cpm: float = 1.0, min_frac_samples: float = 0.2, keep_technical: bool = False, n_top: int = 5000, variance_method: str = "mad", scale: bool = False, already_normalized: bool = False) -> DataFrame:
    """Filters, normalisation, variable genes and centring, in that order."""
    if not already_normalized:
        df = filter_low_expression(drop_zero_genes(df), min_cpm, min_frac_samples)
        df = vst(df) if norm_method == "vst" else log_cpm(df)
    if not keep_technical:
        df = drop_technical(df)
    return centre_genes(top_genes(df, n_top, variance_method), scale)


def parse_threshold(value: object) -> float | None:
    """A purity threshold in (0, 1); none for empty or off-like values, zero and less."""
    text = str(value if value is not None else "").strip().lower()
    if text in ("", "0", "0.0", "n", "no", "none", "off", "false"):
        return None
    number = float(text)
    if number <= 0:
        return None
    if not number < 1:
        raise ValueError(f"purity threshold {value!r} is not between 0 and 1")
    return number


def purity_keep(purity: Column, threshold: float, direction: str = "higher") -> Column:
    """Whether a sample stays; unknown purity does."""
    if direction not in ("higher", "lower"):
        raise ValueError(f"unknown direction {direction!r}")
    inside = purity >= threshold if direction == "higher" else purity <= threshold
    return purity.isNull() | F.isnan(purity) | inside


def filter_by_purity(df: DataFrame, purity: DataFrame, threshold: float, direction: str = "higher") -> DataFrame:
    """Samples of df that a table ``(sample, purity)`` doesn't exclude; samples without a row stay."""
    out = purity.where(~purity_keep(F.col("purity"), threshold, direction)).select("sample")
    return df.join(out, "sample", "left_anti")


def min_count_genes(df: DataFrame, min_count: float) -> DataFrame:
    """Genes whose counts sum to ``min_count`` or more."""
    return _keep(df, df.groupBy("gene").agg(F.sum("value").alias("t")).where(F.col("t") >= min_count).select("gene"))


def min_size_groups(df: DataFrame, group: str, least: int) -> DataFrame:
    """Rows whose group has that many rows."""
    return df.join(df.groupBy(group).count().where(F.col("count") >= least).select(group), group, "left_semi")


def pca_outliers(df: DataFrame, sd_threshold: float, n_pc: int = 10, min_explained_var: float = 0.0) -> DataFrame:
    """(sample, max_abs_z, worst_pc, is_outlier) over the first components, or those that explain enough.

    The components come from the Gram matrix of the centred samples, whose size is that of the
    samples; z-scores (population sd) and their maximum are expressions.
    """
    from .kernels.linear import scores_table

    scores = scores_table(df, n_pc, min_explained_var)
    by = Window.partitionBy("pc")
    sd = F.stddev_pop("score").over(by)
    z = scores.withColumn("z", (F.col("score") - F.avg("score").over(by)) / F.when(sd == 0, 1.0).otherwise(sd))
    worst = F.max_by("pc", F.struct(F.abs("z").alias("z"), (-F.col("pc")).alias("pc")))
    out = z.groupBy("sample").agg(F.max(F.abs("z")).alias("max_abs_z"), worst.alias("worst_pc"))
    return out.withColumn("is_outlier", F.col("max_abs_z") > sd_threshold)
