"""The star-schema tables in the roles of a cohort: counts, metadata, gene sets, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import hashed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers x brands: summed quantities."""
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return items.join(parts, items["l_partkey"] == parts["p_partkey"]).groupBy(F.col("l_suppkey").alias("sample"), F.col("p_brand").alias("gene")).agg(F.sum("l_quantity").alias("value"))


def wide_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers x (brand, type), with empty cells as 0; genes with an MD5 number of 0 modulo 10 are 0 everywhere."""
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("|", "p_brand", "p_type").alias("gene"))
    seen = items.join(parts, items["l_partkey"] == parts["p_partkey"]).groupBy(F.col("l_suppkey").alias("sample"), "gene").agg(F.sum("l_quantity").alias("value"))
    every = seen.select("sample").distinct().crossJoin(F.broadcast(parts.select("gene").distinct()))
    full = every.join(seen, ["sample", "gene"], "left")
    return full.withColumn("value", F.when(hashed(F.col("gene")) % 10 == 0, 0.0).otherwise(F.coalesce("value", F.lit(0.0))))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample, acctbal, nation, region, tier) of suppliers; acctbal is null for an MD5 tenth."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    full = s.join(F.broadcast(n), s["s_nationkey"] == n["n_nationkey"]).join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"])
    acct = F.when(hashed(F.col("s_suppkey").cast("string")) % 10 != 0, F.col("s_acctbal"))
    return full.select(F.col("s_suppkey").alias("sample"), acct.alias("acctbal"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"), (hashed(F.concat(F.lit("t"), F.col("s_suppkey").cast("string"))) % 3).cast("string").alias("tier"))


def gene_sets(spark: SparkSession, sf_dir: str, n_sets: int = 6) -> DataFrame:
    """(signature, gene): brands whose MD5 number with the set's is 0 modulo 3."""
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("gene")).distinct()
    sets = spark.range(n_sets).select(F.col("id").cast("string").alias("s"))
    return brands.crossJoin(F.broadcast(sets)).where(hashed(F.concat_ws("|", "gene", "s")) % 3 == 0).select(F.concat(F.lit("set"), F.col("s")).alias("signature"), "gene")


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample, component, value): all coordinates of the embeddings."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample"), F.posexplode("embedding").alias("pos", "value"))
    return rows.select("sample", F.format_string("IC%02d", F.col("pos") + 1).alias("component"), F.col("value").cast("double").alias("value"))


def embedding_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample, cluster): embeddings by their label."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample"), F.col("label").alias("cluster"))


def tier_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, sample, cluster): for k = 2..4, suppliers by MD5 number modulo k."""
    meta = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sample"))
    ks = spark.range(2, 5).select(F.col("id").cast("int").alias("k"))
    return meta.crossJoin(F.broadcast(ks)).select("k", "sample", (hashed(F.concat_ws("|", F.lit("p"), F.col("sample").cast("string"))) % F.col("k") + 1).cast("int").alias("cluster"))
