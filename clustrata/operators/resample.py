"""Draws of samples and genes: by hash order (the same in any engine) or by a seeded generator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import hashed


def draw_size(n: int, prop: float) -> int:
    """At least two, else the share rounded half to even."""
    return max(2, round(prop * n))


def draw(names: DataFrame, column: str, n_draws: int, prop: float, mode: str = "subsample", tag: str = "") -> DataFrame:
    """(b, column, times) for b = 0 .. n_draws - 1.

    ``subsample`` takes the share with the least hashes of ``b:tag:name``; ``bootstrap`` draws
    as many positions, by hash of ``b:tag:t``, with replacement.
    """
    spark = names.sparkSession
    plain = names.select(column).distinct()
    draws = spark.range(n_draws).select(F.col("id").cast("int").alias("b"))
    if mode == "subsample":
        order = Window.partitionBy("b").orderBy(F.md5(F.concat_ws(":", F.col("b").cast("string"), F.lit(tag), F.col(column).cast("string")).cast("binary")), column)
        # how many to take is known to each draw's window; the driver isn't asked
        many = plain.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_draws - 1))))
        size = F.greatest(F.lit(2), F.bround(F.lit(prop) * F.count("*").over(Window.partitionBy("b"))))
        ranked = many.select("b", column, F.row_number().over(order).alias("_r"), size.alias("_m"))
        return ranked.where(F.col("_r") <= F.col("_m")).select("b", column, F.lit(1).cast("bigint").alias("times"))
    if mode != "bootstrap":
        raise ValueError(f"unknown draw mode {mode!r}")
    n = plain.count()
    m = draw_size(n, prop)
    placed = plain.withColumn("_p", (F.row_number().over(Window.orderBy(column)) - 1).cast("bigint"))
    turns = draws.crossJoin(spark.range(m).withColumnRenamed("id", "t"))
    picked = turns.withColumn("_p", hashed(F.concat_ws(":", F.col("b").cast("string"), F.lit(tag), F.col("t").cast("string"))) % n)
    return picked.join(placed, "_p").groupBy("b", column).agg(F.count("*").alias("times"))


def stratified_sample(df: DataFrame, stratum: str, key: str, most: int, seed: int = 0) -> DataFrame:
    """Up to ``most`` rows of each stratum, those with the least hashes of ``seed:key``; null is a stratum too.

    The limit on the row number is applied by tasks before the shuffle, so a stratum that holds
    most rows sends ``most`` of them from each task.
    """
    number = fresh(df, "_r")
    order = Window.partitionBy(stratum).orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key)
    return df.withColumn(number, F.row_number().over(order)).where(F.col(number) <= most).drop(number)


def fresh(df: DataFrame, name: str) -> str:
    """The name with as many underscores before it as no column has."""
    while name in df.columns:
        name = "_" + name
    return name


def permute_genes(df: DataFrame, rep: int = 0) -> DataFrame:
    """Each gene's values dealt anew to the samples, by hash order, independently of other genes."""
    by_name = Window.partitionBy("gene").orderBy("sample")
    by_hash = Window.partitionBy("gene").orderBy(F.md5(F.concat_ws(":", F.lit(str(rep)), "gene", F.col("sample").cast("string")).cast("binary")), "sample")
    taken = df.select("gene", "value", F.row_number().over(by_hash).alias("_p"))
    return df.select("gene", "sample", F.row_number().over(by_name).alias("_p")).join(taken, ["gene", "_p"]).select("sample", "gene", "value")


def plant_groups(df: DataFrame, groups: DataFrame, share: float = 0.3, low: float = 1.0, high: float = 2.0, seed: int = 0) -> DataFrame:
    """(sample, gene, value): counts with groups planted into them, by hash, to see whether an analysis finds them again.

    groups: (sample, level). A ``share`` of the genes is raised in a level by a power of two between
    ``low`` and ``high``; each sample gets a depth between 0.7 and 1.4. Counts are rounded. All
    follows from the names and the seed, row by row; samples without a level keep their counts.
    """
    ticks = lambda *parts: hashed(F.concat_ws(":", F.lit(str(seed)), *parts)) % 10_000
    unit = lambda *parts: ticks(*parts) / 10_000.0
    met = df.join(groups.select("sample", F.col("level").cast("string").alias("_level")), "sample", "left")
    raised = unit(F.lit("which"), F.col("_level"), F.col("gene").cast("string")) < share
    effect = low + (high - low) * unit(F.lit("how"), F.col("_level"), F.col("gene").cast("string"))
    # 0.7 x ticks is taken exactly before the division, as decimals are: products that end in .5 round the same way in any engine
    depth = 0.7 + ticks(F.lit("depth"), F.col("sample").cast("string")) * 7 / 10.0 / 10_000.0
    value = F.floor(F.col("value") * F.when(raised, F.pow(F.lit(2.0), effect)).otherwise(1.0) * depth + 0.5).cast("double")
    return met.select("sample", "gene", F.when(F.col("_level").isNull(), F.col("value")).otherwise(value).alias("value"))


def medoid_labels(df: DataFrame, n_draws: int, k_values: list[int], prop_samples: float = 0.8, prop_genes: float = 0.8, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., b, k, sample, label): one assignment to medoids drawn by hash, on the Pearson distance over drawn genes.

    Medoids are the k drawn samples with the least hashes; a sample takes the nearest, the
    first of equally near ones. Only distances to medoids are computed. Matrices of different
    ``keys`` share the draws.
    """
    spark = df.sparkSession
    samples = draw(df.select("sample"), "sample", n_draws, prop_samples, tag="s")
    genes = draw(df.select("gene"), "gene", n_draws, prop_genes, tag="g")
    drawn = df.join(samples.select("b", "sample"), "sample").join(genes.select("b", "gene"), ["b", "gene"])
    means = drawn.groupBy(*keys, "b", "sample").agg(F.avg("value").alias("_m"), F.var_pop("value").alias("_v"))
    centred = drawn.join(means, [*keys, "b", "sample"]).select(*keys, "b", "sample", "gene", (F.col("value") - F.col("_m")).alias("x"), "_v")
    order = Window.partitionBy("b").orderBy(F.md5(F.concat_ws(":", F.col("b").cast("string"), F.lit("m"), F.col("sample").cast("string")).cast("binary")), "sample")
    most = max(k_values)
    medoids = samples.withColumn("m", F.row_number().over(order)).where(F.col("m") <= most).select("b", "sample", "m")
    side = centred.join(medoids, ["b", "sample"]).select(*keys, "b", "gene", "m", F.col("x").alias("y"), F.col("_v").alias("_w"))
    both = centred.join(side, [*keys, "b", "gene"])
    dist = both.groupBy(*keys, "b", "sample", "m").agg(F.sum(F.col("x") * F.col("y")).alias("s"), F.count("*").alias("n"), F.first("_v").alias("_v"), F.first("_w").alias("_w"))
    norm = F.col("n") * F.sqrt("_v") * F.sqrt("_w")
    dist = dist.select(*keys, "b", "sample", "m", F.round(F.when(norm > 0, 1 - F.col("s") / norm).otherwise(1.0), 9).alias("d"))
    near = dist.withColumn("k", F.explode(F.array(*[F.lit(k) for k in k_values]))).where(F.col("m") <= F.col("k"))
    return near.groupBy(*keys, "b", "k", "sample").agg(F.min_by("m", F.struct("d", "m")).alias("label"))
