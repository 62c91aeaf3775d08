"""The tables behind the figures of an analysis: what is drawn, in the order in which it is drawn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import stars


def heatmap_cells(pairs: DataFrame, partition: DataFrame) -> DataFrame:
    """(k, row, col, consensus): each k's whole symmetric matrix in leaf order, from pairs (k, i, j, consensus) and (k, sample, leaf_pos)."""
    place = partition.select("k", "sample", "leaf_pos")
    at = lambda side, name: place.select("k", F.col("sample").alias(side), F.col("leaf_pos").alias(name))
    upper = pairs.select("k", "i", "j", "consensus").join(at("i", "row"), ["k", "i"]).join(at("j", "col"), ["k", "j"])
    return placed_cells(upper, place)


def placed_cells(upper: DataFrame, place: DataFrame) -> DataFrame:
    """As ``heatmap_cells``, from pairs (k, row, col, consensus) that go by place already; row by row, without a shuffle."""
    both = F.array(F.struct("row", "col", "consensus"), F.struct(F.col("col").alias("row"), F.col("row").alias("col"), "consensus"))
    return with_diagonal(upper.select("k", F.inline(both)), place)


def with_diagonal(cells: DataFrame, place: DataFrame) -> DataFrame:
    """Cells (k, row, col, consensus) of both triangles and those of each place with itself."""
    return cells.unionByName(place.select("k", F.col("leaf_pos").alias("row"), F.col("leaf_pos").alias("col"), F.lit(1.0).alias("consensus")))


def tracking_flows(partition: DataFrame) -> DataFrame:
    """(k, cluster, next_cluster, n, share): how many members of a cluster of k are in each cluster of k + 1, and their share of it."""
    now = partition.select("k", "sample", "cluster")
    later = partition.select((F.col("k") - 1).cast("int").alias("k"), "sample", F.col("cluster").alias("next_cluster"))
    met = now.join(later, ["k", "sample"]).groupBy("k", "cluster", "next_cluster").agg(F.count("*").alias("n"))
    return met.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("k", "cluster")))


def tracking(partition: DataFrame) -> DataFrame:
    """(sample, place, path): samples in the order of their clusters from the least k to the greatest, with the clusters as a text."""
    path = F.array_sort(F.collect_list(F.struct("k", "cluster")))
    rows = partition.groupBy("sample").agg(path.alias("p"))
    place = F.row_number().over(Window.orderBy("p.cluster", "sample"))  # one row for each sample
    return rows.select("sample", place.alias("place"), F.array_join(F.transform("p.cluster", lambda c: c.cast("string")), ">").alias("path"))


def signature_heatmap(scores: DataFrame, groups: DataFrame, best: DataFrame, limit: float = 3.0) -> DataFrame:
    """(signature, place, sample, level, z): z-scores over samples, within ``limit``, of the signatures in ``best``; samples by level, then name."""
    order = groups.where(F.col("level").isNotNull()).withColumn("place", F.row_number().over(Window.orderBy("level", "sample")))
    by = Window.partitionBy("signature")
    sd = F.stddev_samp("score").over(by)
    z = F.when(sd > 0, (F.col("score") - F.avg("score").over(by)) / F.when(sd > 0, sd)).otherwise(0.0)
    own = scores.where(F.col("score").isNotNull()).join(best.select("signature"), "signature", "left_semi").join(order, "sample")
    return own.select("signature", "place", "sample", "level", F.greatest(F.least(z, F.lit(limit)), F.lit(-limit)).alias("z"))


def purity_bins(purity: DataFrame, threshold: float | None, direction: str = "higher", bins: int = 20) -> DataFrame:
    """(bin, low, high, n, n_removed): purities between 0 and 1 in equal bins, and how many of each the threshold removes."""
    lost = F.lit(False) if threshold is None else (F.col("purity") < threshold if direction == "higher" else F.col("purity") > threshold)
    place = F.least(F.floor(F.col("purity") * bins), F.lit(bins - 1)).cast("int")
    known = purity.where(F.col("purity").isNotNull() & ~F.isnan("purity"))
    out = known.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.sum(lost.cast("bigint")).alias("n_removed"))
    return out.select("bin", (F.col("bin") / bins).alias("low"), ((F.col("bin") + 1) / bins).alias("high"), "n", "n_removed")


def overview(partition: DataFrame, items: DataFrame) -> DataFrame:
    """(k, place, sample, cluster, item_consensus, silhouette): the samples of each k in leaf order with what is drawn beneath the tree."""
    drawn = items.select("k", "sample", "item_consensus", "silhouette")
    return partition.select("k", F.col("leaf_pos").alias("place"), "sample", "cluster").join(drawn, ["k", "sample"], "left").select("k", "place", "sample", "cluster", "item_consensus", "silhouette")


def five_numbers(value: str) -> list[Column]:
    """Least, quartiles and greatest value, as aggregates."""
    p = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return [F.count(value).alias("n"), F.min(value).alias("min"), p[0].alias("q1"), p[1].alias("median"), p[2].alias("q3"), F.max(value).alias("max")]


def item_boxes(items: DataFrame) -> DataFrame:
    """(k, cluster, n, min, q1, median, q3, max) of the items' consensus."""
    return items.groupBy("k", "cluster").agg(*five_numbers("item_consensus"))


def marked_residuals(cells: DataFrame) -> DataFrame:
    """(var1, var2, row, col, observed, adj_residual, mark): cells of contingency tables; residuals beyond 2, 3 and 4 have one to three signs."""
    size = F.abs("adj_residual")
    times = F.when(size >= 4, 3).when(size >= 3, 2).when(size >= 2, 1).otherwise(0)
    sign = F.when(F.col("adj_residual") > 0, "+").otherwise("-")
    return cells.select("var1", "var2", "row", "col", "observed", "adj_residual", F.repeat(sign, times).alias("mark"))


def correlation_cells(pairs: DataFrame, clinical: str = "clinic:", most: int = 40, q_max: float = 0.05) -> DataFrame:
    """(clinical, feature, place, r, stars): clinical variables against derived features, the significant and strongest features first."""
    a, b = F.col("f1").startswith(clinical), F.col("f2").startswith(clinical)
    rows = pairs.where(a != b).select(F.when(a, F.col("f1")).otherwise(F.col("f2")).alias("clinical"), F.when(a, F.col("f2")).otherwise(F.col("f1")).alias("feature"), "r", "q")
    best = rows.groupBy("feature").agg(F.max(F.abs("r")).alias("m"), F.min("q").alias("least"))
    placed = best.withColumn("place", F.row_number().over(Window.orderBy(F.desc(F.col("least") < q_max), F.desc(F.round("m", 12)), "feature"))).where(F.col("place") <= most)
    return rows.join(placed.select("feature", "place"), "feature").select("clinical", "feature", "place", "r", F.when(F.col("q").isNull(), "").otherwise(stars(F.col("q"))).alias("stars"))
