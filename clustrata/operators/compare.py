"""Comparisons of clusters on components: contrasts, medoids, effect sizes, global distances."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import strips

EPS = 1e-12


#: Clusters with fewer members are named in a contrast's warning.
SMALL_CLUSTER = 3


def cluster_key(label: Column) -> Column:
    """Natural order of labels: numbers first by value, then text."""
    number = label.cast("string").try_cast("double")
    return F.struct(number.isNull(), number, label.cast("string"))


def medoids(points: DataFrame, partition: DataFrame, block: int = 1024, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., cluster, medoid): the member with the least sum of Euclidean distances to the others; the first on ties.

    points: (sample, component, value); samples with a missing value don't compete. A cluster is
    cut into blocks of about ``block`` members; a task takes two blocks and hands on one sum
    per member, so no pair is moved and no task holds a whole cluster.
    """
    by = [*keys, "cluster"]
    n = points.select("component").distinct().count()
    whole = points.where(F.col("value").isNotNull() & ~F.isnan("value"))
    vectors = whole.groupBy("sample").agg(F.sort_array(F.collect_list(F.struct("component", "value"))).alias("v")).where(F.size("v") == n)
    own = vectors.select("sample", F.col("v.value").cast("array<double>").alias("x")).join(partition.select("sample", *by), "sample")
    cut = own.join(own.groupBy(*by).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), by)
    cut = cut.withColumn("b", F.pmod(F.xxhash64("sample"), "blocks").cast("int"))
    met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("b", o).alias("one"), F.greatest("b", o).alias("two"), (F.col("b") > o).alias("second")))
    dealt = cut.select(*by, "sample", "x", F.explode(met).alias("m")).select(*by, "m.one", "m.two", "m.second", "sample", "x")

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        second = pdf["second"].to_numpy(bool)
        alone = pdf["one"].iloc[0] == pdf["two"].iloc[0]
        x = np.stack(pdf["x"].to_list())
        left, right = np.flatnonzero(~second), np.flatnonzero(~second if alone else second)
        total, y = np.zeros(len(pdf)), x[right]
        yy = (y * y).sum(1)
        for lo, hi in strips(len(left), len(right)):
            one = x[left[lo:hi]]
            both = (one * one).sum(1)[:, None] + yy
            square = both - 2 * (one @ y.T)
            a, b = np.nonzero(square <= 1e-3 * both)  # near ones anew, as the difference of large sums isn't exact
            for at in range(0, len(a), 1 << 14):
                r, c = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
                square[r, c] = ((y[c] - one[r]) ** 2).sum(1)
            d = np.sqrt(square)
            total[left[lo:hi]] += d.sum(1)
            if not alone:
                total[right] += d.sum(0)
        return pdf[[*by, "sample"]].assign(t=total)

    kinds = ", ".join(f"{c} {own.schema[c].dataType.simpleString()}" for c in (*by, "sample"))
    parts = dealt.groupBy(*by, "one", "two").applyInPandas(sums, f"{kinds}, t double")
    total = parts.groupBy(*by, "sample").agg(F.round(F.sum("t"), 9).alias("t"))
    return total.groupBy(*by).agg(F.min_by("sample", F.struct("t", "sample")).alias("medoid"))


def component_contrasts(points: DataFrame, partition: DataFrame, keys: Sequence[str] = (), with_medoids: bool = True) -> DataFrame:
    """One row per keys, component and two clusters: means, medoid values, Cohen's d, Hedges' g and warnings.

    Effects are null where a cluster has fewer than two values or the pooled spread vanishes.
    Warnings name small clusters, missing values and what keeps an effect from being known.
    Finding medoids takes all pairs of a cluster's members; without ``with_medoids`` their columns are left out.
    """
    by = [*keys, "cluster"]
    size = partition.groupBy(*by).agg(F.count("*").alias("size"))
    known = points.where(F.col("value").isNotNull() & ~F.isnan("value")).join(partition.select("sample", *by), "sample")
    stats = known.groupBy(*by, "component").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    full = stats.join(size, by)
    if with_medoids:
        middle = medoids(points, partition, keys=keys).join(points.withColumnRenamed("sample", "medoid"), "medoid").select(*by, "component", "medoid", F.col("value").alias("at"))
        full = full.join(middle, [*by, "component"], "left")
    side = lambda k: full.select(*keys, "component", *[F.col(c).alias(f"{c}{k}") for c in ("cluster", "size", "n", "mean", "sd", *(("medoid", "at") if with_medoids else ()))])
    met = side(1).join(side(2), [*keys, "component"]).where(cluster_key(F.col("cluster1")) < cluster_key(F.col("cluster2")))
    dof = F.col("n1") + F.col("n2") - 2
    enough = (F.col("n1") >= 2) & (F.col("n2") >= 2)
    pooled = F.when(enough, F.sqrt(((F.col("n1") - 1) * F.col("sd1") ** 2 + (F.col("n2") - 1) * F.col("sd2") ** 2) / F.when(enough, dof)))
    apart = {"medoid_difference": F.col("at1") - F.col("at2")} if with_medoids else {}
    out = met.withColumns({"difference": F.col("mean1") - F.col("mean2"), **apart, "pooled_sd": pooled})
    out = out.withColumn("cohen_d", F.when(F.col("pooled_sd") > EPS, F.col("difference") / F.when(F.col("pooled_sd") > EPS, F.col("pooled_sd"))))
    correction = F.when(enough, 1 - 3 / (4 * dof.cast("double") - 1))

    def said(k: int) -> list[Column]:
        name, n, size = F.concat(F.lit("cluster "), F.col(f"cluster{k}").cast("string")), F.col(f"n{k}"), F.col(f"size{k}")
        return [
            F.when(size < SMALL_CLUSTER, F.concat(name, F.lit(" has "), size.cast("string"), F.lit(" members"))),
            F.when(n < size, F.concat(name, F.lit(" lacks "), (size - n).cast("string"), F.lit(" values"))),
            F.when(n < 2, F.concat(name, F.lit(" has fewer than two values"))),
        ]

    spread = F.when(F.col("pooled_sd") <= EPS, F.lit("no spread within the clusters"))
    return out.withColumns({"hedges_g": F.col("cohen_d") * correction, "warning": F.concat_ws("; ", *said(1), *said(2), spread)})


def global_contributions(points: DataFrame, partition: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., cluster1, cluster2, component, difference, quadratic, relative, rank) of globally standardised centroids.

    Components without spread over all samples are left out.
    """
    by = [*keys, "cluster"]
    known = points.where(F.col("value").isNotNull() & ~F.isnan("value"))
    stats = known.groupBy("component").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s")).where(F.col("_s") ** 2 > EPS)
    z = known.join(stats, "component").select("sample", "component", ((F.col("value") - F.col("_m")) / F.col("_s")).alias("z"))
    centre = z.join(partition.select("sample", *by), "sample").groupBy(*by, "component").agg(F.avg("z").alias("c"))
    one = centre.select(*keys, "component", F.col("cluster").alias("cluster1"), F.col("c").alias("c1"))
    two = centre.select(*keys, "component", F.col("cluster").alias("cluster2"), F.col("c").alias("c2"))
    met = one.join(two, [*keys, "component"]).where(cluster_key(F.col("cluster1")) < cluster_key(F.col("cluster2")))
    part = met.select(*keys, "cluster1", "cluster2", "component", (F.col("c1") - F.col("c2")).alias("difference")).withColumn("quadratic", F.col("difference") ** 2)
    pair = Window.partitionBy(*keys, "cluster1", "cluster2")
    total = F.sum("quadratic").over(pair)
    rank = F.row_number().over(pair.orderBy(F.desc(F.round("quadratic", 12)), "component"))
    return part.withColumns({"relative": F.when(total > 0, F.col("quadratic") / F.when(total > 0, total)), "rank": rank})


def global_distances(contributions: DataFrame, most: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., cluster1, cluster2, distance, n_components, leading): the distance and the components that lead it."""
    lead = F.sort_array(F.collect_list(F.when(F.col("rank") <= most, F.struct("rank", "component"))))
    out = contributions.groupBy(*keys, "cluster1", "cluster2").agg(F.sqrt(F.sum("quadratic")).alias("distance"), F.count("*").alias("n_components"), lead.alias("l"))
    return out.select(*keys, "cluster1", "cluster2", "distance", "n_components", F.array_join(F.col("l.component"), "|").alias("leading"))


def compare_all_k(points: DataFrame, partitions: DataFrame) -> dict[str, DataFrame]:
    """Contrasts, contributions and distances of every k of ``partitions(k, sample, cluster)``; k is a key throughout, so each is one plan.

    Samples must be the same on both sides and every one labelled.
    """
    if partitions.where(F.col("cluster").isNull()).limit(1).count():
        raise ValueError("a sample has no cluster")
    a, b = points.select("sample").distinct(), partitions.select("sample").distinct()
    if a.exceptAll(b).limit(1).count() or b.exceptAll(a).limit(1).count():
        raise ValueError("samples of the components and of the partition differ")
    contributions = global_contributions(points, partitions, ["k"])
    return {"componentwise": component_contrasts(points, partitions, ["k"]), "contributions": contributions, "distances": global_distances(contributions, keys=["k"])}
