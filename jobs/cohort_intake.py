"""Incremental intake of a growing cohort: new measurement files into a normalised samples x genes matrix.

    python -m jobs.cohort_intake --measurements IN --features ANNOTATION --out OUT --checkpoint CP [--config FILE]

``measurements`` is a folder (or one file) of Parquet rows, one a measured feature of a sample;
``features`` names each feature's gene. A run takes the files that the checkpoint doesn't know:

1. A file stream (availableNow) sums each micro-batch to (sample, gene, value) and writes it to
   ``OUT/partials``, partitioned by bucket of the sample and batch, overwriting dynamically: a
   batch that is repeated after a failure replaces itself.
2. Buckets with a batch beyond their mark in ``OUT/folded`` are summed over all their partials
   and normalised (log2 counts per million) into ``OUT/matrix``, partitioned by bucket;
   others aren't read or written. The mark follows the matrix, so a run that stops between
   the two is repeated by the next, with the same result.
3. ``OUT/genes`` has each gene's samples, total and mean, for the filters of an analysis; it is
   made anew when a bucket changed.

A run without new files writes nothing. Rows without sample, feature or value, with a negative
or not finite value, or of an unknown feature are counted in the log and left out. A file is
known by its path: one that is sent again under another name counts again.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from clustrata.functions.expr import hashed  # noqa: E402
from clustrata.operators.preprocess import with_cpm  # noqa: E402

log = logging.getLogger("cohort_intake")
DEFAULTS = Path(__file__).with_suffix(".json")

PARTIALS = "sample string, gene string, value double, n bigint, bucket int, batch bigint"
FOLDED = "through bigint, bucket int"
MATRIX = "sample string, gene string, value double, logcpm double, bucket int"
GENES = "gene string, n_samples bigint, total double, mean_logcpm double, bucket int"


def write(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that ``df`` has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def bucket(name: str, o: Mapping) -> Column:
    return (hashed(F.col(name)) % o["buckets"]).cast("int")


def usable(rows: DataFrame, o: Mapping) -> DataFrame:
    """(sample, feature, value) of the rows that count."""
    value = F.col(o["value"]).cast("double")
    kept = rows.select(F.col(o["sample"]).cast("string").alias("sample"), F.col(o["feature"]).alias("feature"), value.alias("value"))
    return kept.where(F.col("sample").isNotNull() & F.col("feature").isNotNull() & (F.col("value") >= 0) & ~F.isnan("value") & (F.col("value") < float("inf")))


def take_in(spark: SparkSession, measurements: str, features: str, out: str, checkpoint: str, o: Mapping) -> dict[str, int]:
    """Step 1: rows read and partial sums written."""
    genes = spark.read.parquet(features).select(F.col(o["feature_key"]).alias("feature"), F.col(o["gene"]).cast("string").alias("gene")).where("gene is not null").dropDuplicates(["feature"])
    total = {"batches": 0, "rows_read": 0, "rows_used": 0, "partials_written": 0}

    def batch(rows: DataFrame, number: int) -> None:
        sums = usable(rows, o).join(genes, "feature").groupBy("sample", "gene").agg(F.sum("value").alias("value"), F.count("*").alias("n"))
        write(sums.withColumns({"bucket": bucket("sample", o), "batch": F.lit(number).cast("bigint")}), f"{out}/partials", "bucket", "batch")
        made = stored(spark, f"{out}/partials", PARTIALS, "bucket", "batch").where(F.col("batch") == number).agg(F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
        now = {"batches": 1, "rows_read": rows.count(), "rows_used": made["n"], "partials_written": made["rows"]}  # counts come from files' footers
        log.info("batch %d: %s", number, now)
        for k, v in now.items():
            total[k] += v

    schema = spark.read.parquet(measurements).schema
    path = measurements.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"  # a stream reads one file only by a pattern; this one means the path itself, file or folder
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", o["files_per_batch"]).parquet(pattern)
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return total


def stored(spark: SparkSession, path: str, schema: str, *by: str) -> DataFrame:
    """A table of the job; appending no rows lays down its folder and nothing else."""
    spark.createDataFrame([], schema).write.mode("append").partitionBy(*by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def fold(spark: SparkSession, out: str, o: Mapping) -> dict[str, int]:
    """Steps 2 and 3: buckets and rows written."""
    partials, folded = stored(spark, f"{out}/partials", PARTIALS, "bucket", "batch"), stored(spark, f"{out}/folded", FOLDED, "bucket")
    latest, marks = partials.groupBy("bucket").agg(F.max("batch").alias("batch")), folded.groupBy("bucket").agg(F.max("through").alias("through"))
    behind = latest.join(marks, "bucket", "left").where(F.col("through").isNull() | (F.col("through") < F.col("batch")))
    stale = {r["bucket"]: r["batch"] for r in behind.select("bucket", "batch").collect()}  # at most o["buckets"] rows
    done = {"buckets_written": len(stale), "matrix_rows": 0, "gene_rows": 0}
    for name, schema in (("matrix", MATRIX), ("genes", GENES)):
        stored(spark, f"{out}/{name}", schema, "bucket")
    if stale:
        # batches that arrive from now on belong to the next run
        counts = partials.where(F.col("bucket").isin(*stale)).groupBy("sample", "gene").agg(F.sum("value").alias("value"))
        logs = with_cpm(counts).select("sample", "gene", "value", F.log2(F.col("cpm") + o["prior"]).alias("logcpm"), bucket("sample", o).alias("bucket"))
        write(logs.hint("rebalance", "bucket"), f"{out}/matrix", "bucket")  # a large bucket is written by several tasks
        write(spark.createDataFrame([(b, k) for k, b in stale.items()], FOLDED).coalesce(1), f"{out}/folded", "bucket")
        matrix = spark.read.schema(MATRIX).parquet(f"{out}/matrix")
        stats = matrix.groupBy("gene").agg(F.sum((F.col("value") > 0).cast("bigint")).alias("n_samples"), F.sum("value").alias("total"), F.avg("logcpm").alias("mean_logcpm"))
        keyed = stats.withColumn("bucket", bucket("gene", o))
        write(keyed.hint("rebalance", "bucket"), f"{out}/genes", "bucket")
        done |= {"matrix_rows": matrix.where(F.col("bucket").isin(*stale)).count(), "gene_rows": spark.read.schema(GENES).parquet(f"{out}/genes").count()}
    return done


def run(spark: SparkSession, measurements: str, features: str, out: str, checkpoint: str, options: Mapping | None = None) -> dict[str, int]:
    """Take in what is new; the numbers of rows read and written."""
    o = {**json.loads(DEFAULTS.read_text()), **(options or {})}
    report = take_in(spark, measurements, features, out, checkpoint, o) | fold(spark, out, o)
    log.info("read %s and %s, wrote %s: %s", measurements, features, out, report)
    return report


def result(spark: SparkSession, out: str) -> DataFrame:
    """All that the job holds: the matrix's cells, and each gene's totals as the sample ``all``."""
    matrix = spark.read.schema(MATRIX).parquet(f"{out}/matrix")
    genes = spark.read.schema(GENES).parquet(f"{out}/genes")
    cells = matrix.select("bucket", "sample", "gene", "value", "logcpm", (F.col("value") > 0).cast("bigint").alias("n_samples"))
    return cells.unionByName(genes.select("bucket", F.lit("all").alias("sample"), "gene", F.col("total").alias("value"), F.col("mean_logcpm").alias("logcpm"), "n_samples"))


def main(argv: list[str] | None = None) -> int:
    from clustrata.session import session

    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("measurements", "features", "out", "checkpoint"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config", default=str(DEFAULTS))
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = session("cohort intake")
    try:
        run(spark, args.measurements, args.features, args.out, args.checkpoint, json.loads(Path(args.config).read_text()))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
