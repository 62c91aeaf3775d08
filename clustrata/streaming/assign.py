"""Extension: new samples, as they arrive, to the nearest centroid of a known partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def centroids(matrix: DataFrame, partition: DataFrame) -> DataFrame:
    """(cluster, genes, centre): one row per cluster, genes in order of name."""
    mean = matrix.join(partition.select("sample", "cluster"), "sample").groupBy("cluster", "gene").agg(F.avg("value").alias("m"))
    cells = F.sort_array(F.collect_list(F.struct("gene", "m")))
    return mean.groupBy("cluster").agg(cells.alias("c")).select("cluster", F.col("c.gene").alias("genes"), F.col("c.m").alias("centre"))


def assign(arriving: DataFrame, known: DataFrame) -> DataFrame:
    """(sample, cluster, correlation) for a batch or stream of (sample, values map<gene, value>).

    Each row meets the few centroids and keeps the one it correlates with best, so the stream
    needs no state; rows without spread or shared genes get no cluster.
    """
    met = arriving.crossJoin(F.broadcast(known))
    pairs = F.filter(F.zip_with("genes", "centre", lambda g, c: F.struct(F.element_at("values", g).alias("x"), c.alias("y"))), lambda p: p["x"].isNotNull())
    met = met.withColumn("_p", pairs).withColumn("_n", F.size("_p"))

    def total(value) -> F.Column:
        return F.aggregate("_p", F.lit(0.0), lambda a, p: a + value(p))

    n = F.nullif(F.col("_n"), F.lit(0)).cast("double")
    sx, sy = total(lambda p: p["x"]), total(lambda p: p["y"])
    sxx, syy, sxy = total(lambda p: p["x"] * p["x"]), total(lambda p: p["y"] * p["y"]), total(lambda p: p["x"] * p["y"])
    a, b = sxx - sx * sx / n, syy - sy * sy / n
    ok = (a > 1e-12) & (b > 1e-12)
    r = F.when(ok, (sxy - sx * sy / n) / F.sqrt(F.when(ok, a * b)))
    each = met.select("sample", F.struct(r.alias("r"), F.col("cluster")).alias("_s"), "cluster")
    best = each.groupBy("sample").agg(F.max_by("cluster", F.col("_s.r")).alias("cluster"), F.max("_s.r").alias("correlation"))
    return best.select("sample", F.when(F.col("correlation").isNotNull(), F.col("cluster")).alias("cluster"), "correlation")


def assign_stream(stream: DataFrame, known: DataFrame, path: str, checkpoint: str):
    """Write assignments of a stream of samples as Parquet, one micro-batch at a time."""

    def batch(df: DataFrame, batch_id: int) -> None:
        assign(df, known).withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
