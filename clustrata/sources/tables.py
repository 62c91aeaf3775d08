"""Readers of matrices, metadata and gene sets; writers of result tables."""

from __future__ import annotations

import json
import math
import re
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_matrix(spark: SparkSession, path: str, genes_in_rows: bool = True, id_column: str | None = None) -> DataFrame:
    """(sample, gene, value) of a wide csv, tsv, txt or parquet file; NaN becomes null.

    The first column (or ``id_column``) names the rows. Wide tables are unpivoted at once, so
    no later plan carries a column per gene.
    """
    if re.search(r"\.(parquet|pq)$", path):
        wide = spark.read.parquet(path)
    else:
        sep = "\t" if re.search(r"\.(tsv|txt)(\.gz)?$", path) else ","
        wide = spark.read.csv(path, sep=sep, header=True)
    key = id_column or wide.columns[0]
    others = [c for c in wide.columns if c != key]
    typed = wide.select(F.col(f"`{key}`").cast("string").alias("_id"), *[F.col(f"`{c}`").cast("double").alias(c) for c in others])
    long = typed.unpivot("_id", others, "_name", "value").where(F.col("_id").isNotNull())
    sample, gene = ("_name", "_id") if genes_in_rows else ("_id", "_name")
    return long.select(F.col(sample).alias("sample"), F.col(gene).alias("gene"), F.when(~F.isnan("value"), F.col("value")).alias("value"))


def numeric_gene_share(df: DataFrame) -> float:
    """The share of gene names that are numbers: above 0.3 the matrix may lie on its side."""
    return df.select("gene").distinct().agg(F.avg(F.col("gene").rlike("^[0-9]+$").cast("double"))).first()[0] or 0.0


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table made elsewhere: Parquet, or a csv or tsv with a header; ``sample`` is text."""
    if re.search(r"\.(parquet|pq)$", path):
        df = spark.read.parquet(path)
    else:
        df = spark.read.csv(path, sep="\t" if re.search(r"\.(tsv|txt)(\.gz)?$", path) else ",", header=True, inferSchema=True)
    return df.withColumn("sample", F.col("sample").cast("string")) if "sample" in df.columns else df


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A csv or tsv by its header's more frequent delimiter; the first column becomes ``sample``, text."""
    first = spark.read.text(path).first()
    head = first[0] if first else ""
    sep = max(("\t", ",", ";"), key=head.count)
    df = spark.read.csv(path, sep=sep, header=True, inferSchema=True)
    return df.withColumn(df.columns[0], F.col(f"`{df.columns[0]}`").cast("string")).withColumnRenamed(df.columns[0], "sample")


def parse_gmt(lines: DataFrame, column: str = "value") -> DataFrame:
    """(signature, description, genes) of lines ``name TAB description TAB genes..``."""
    parts = F.split(F.col(column), "\t")
    genes = F.array_distinct(F.filter(F.transform(F.slice(parts, 3, 1_000_000), lambda g: F.trim(g)), lambda g: g != ""))
    return lines.where(F.size(parts) >= 3).select(F.trim(parts[0]).alias("signature"), F.trim(parts[1]).alias("description"), genes.alias("genes"))


def read_gmt(spark: SparkSession, path: str) -> DataFrame:
    """(signature, gene) of a GMT file."""
    return parse_gmt(spark.read.text(path)).select("signature", F.explode("genes").alias("gene"))


def parse_signatures(df: DataFrame, name_col: str = "Geneset", genes_col: str = "Gene Listing", sep: str = ";") -> DataFrame:
    """(signature, gene) of a table with one signature per row and its genes in one column."""
    genes = F.transform(F.split(F.col(f"`{genes_col}`"), re.escape(sep)), lambda g: F.trim(g))
    long = df.select(F.trim(F.col(f"`{name_col}`")).alias("signature"), F.explode(genes).alias("gene"))
    return long.where((F.col("gene") != "") & F.col("signature").isNotNull()).distinct()


def read_signature_source(spark: SparkSession, name: str, spec: Mapping) -> DataFrame | None:
    """One source by its specification (path; for tables: name_col, genes_col, sep); none, with a warning, if it can't be used."""
    import logging

    path = str(spec["path"])
    try:
        if path.endswith(".gmt"):
            return read_gmt(spark, path)
        df = spark.read.csv(path, sep="\t" if path.endswith((".tsv", ".txt")) else ",", header=True)
        name_col, genes_col = spec.get("name_col", "Geneset"), spec.get("genes_col", "Gene Listing")
        if {name_col, genes_col} - set(df.columns):
            logging.getLogger(__name__).warning("source %s has no column %s or %s", name, name_col, genes_col)
            return None
        return parse_signatures(df, name_col, genes_col, spec.get("sep", ";"))
    except Exception as error:  # noqa: BLE001 - a missing file is an analysis exception of Spark's
        if "PATH_NOT_FOUND" not in str(error):
            raise
        logging.getLogger(__name__).warning("source %s: %s is missing", name, path)
        return None


def resolve_gene_sets(gene_sets: str | Path | Mapping[str, str] | None) -> dict[str, str]:
    """Collections by name that exist on disk, from a path or a mapping."""
    if not gene_sets:
        return {}
    named = dict(gene_sets) if isinstance(gene_sets, Mapping) else {Path(gene_sets).stem: str(gene_sets)}
    return {k: str(v) for k, v in named.items() if Path(v).exists()}


def write_table(df: DataFrame, path: str, single: bool = False) -> None:
    """Parquet, or one compressed csv with a header for tables that people open."""
    if single:
        df.coalesce(1).write.mode("overwrite").csv(path, header=True, compression="gzip")
    else:
        df.write.mode("overwrite").parquet(path)


_own: dict[str, str] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that no other call has, under ``spark.checkpoint.dir``, which driver and executors share.

    Only where the setting is missing and one machine does all, a folder of that machine takes its place.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="clustrata-")
        shared = _own[context.applicationId]
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def numbered_rows(names: DataFrame, rows: tuple[int, int] | None = None, block: int = 256) -> DataFrame:
    """(k, sample, row): names (k, sample) numbered by name; with ``rows``, only the whole blocks that hold these, so tasks hand on that many names."""
    place = F.row_number().over(Window.partitionBy("k").orderBy("sample"))
    numbered = names.select("k", "sample").distinct().withColumn("row", place)
    if rows is not None:
        numbered = numbered.where(F.col("row") <= -(-rows[1] // block) * block)
    numbered = numbered.withColumn("row", F.col("row") - 1)
    return numbered if rows is None else numbered.where(F.col("row") >= rows[0] // block * block)


def write_triangle(pairs: DataFrame, path: str, value: str, block: int = 256, numbered: DataFrame | None = None) -> None:
    """Write a symmetric matrix (k, i, j, value) for i < j as rows of its upper triangle: (k, block, row, sample, others, values).

    Rows are numbered by name, ``block`` of them to a folder; a row is two arrays, so a name
    isn't repeated for every cell. Tasks write their rows; what one holds is a few rows at a time.
    Only the rows of ``numbered`` (see ``numbered_rows``) are written, where it is given.
    """
    if numbered is None:
        numbered = numbered_rows(pairs.select("k", F.explode(F.array("i", "j")).alias("sample")))
    cells = pairs.groupBy("k", F.col("i").alias("sample")).agg(F.array_sort(F.collect_list(F.struct(F.col("j").alias("j"), F.col(value).cast("double").alias("v")))).alias("c"))
    rows = numbered.join(cells, ["k", "sample"], "left").select("k", F.floor(F.col("row") / block).cast("int").alias("block"), "row", "sample", F.col("c.j").alias("others"), F.col("c.v").alias("values"))
    rows.write.mode("overwrite").partitionBy("k", "block").parquet(path)


def read_triangle(spark: SparkSession, path: str, k: int, rows: tuple[int, int] | None = None, block: int = 256) -> DataFrame:
    """(row, i, j, value) of one matrix, or of the rows from the first to before the second number: other blocks aren't opened."""
    found = spark.read.parquet(path).where(F.col("k") == k)
    if rows is not None:
        found = found.where(F.col("block").between(rows[0] // block, (rows[1] - 1) // block) & (F.col("row") >= rows[0]) & (F.col("row") < rows[1]))
    return found.select("row", F.col("sample").alias("i"), F.inline(F.arrays_zip(F.col("others").alias("j"), F.col("values").alias("value"))))


def cleaned(value):
    """The value with NaN and infinities as null, at any depth: safe to write as JSON."""
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, Mapping):
        return {str(k): cleaned(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [cleaned(v) for v in value]
    if hasattr(value, "item"):
        return cleaned(value.item())
    return value


def write_json(value, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(cleaned(value), ensure_ascii=False, indent=1))


def precomputed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A table made elsewhere (purity, deconvolution), checked for its columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df.select(*columns)


def simulate_cohort(spark: SparkSession, n_samples: int = 500, n_genes: int = 8000, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(counts, metadata) of a cohort with four subtypes, mixtures, purities and negative-binomial counts.

    Each task draws its samples' counts from generators seeded by (seed, sample).
    """
    import numpy as np
    import pandas as pd

    share = (0.4, 0.28, 0.2, 0.12)
    rng = np.random.default_rng(seed)
    base = rng.normal(6, 1.5, n_genes)
    loads = np.zeros((4, n_genes))
    for s in range(4):
        loads[s, rng.choice(n_genes, max(3, n_genes * 300 // 8000), replace=False)] = rng.normal(1.6, 0.4, max(3, n_genes * 300 // 8000))
    impure = np.zeros(n_genes)
    some = rng.choice(n_genes, max(3, n_genes * 500 // 8000), replace=False)
    impure[some] = rng.normal(1.2, 0.3, len(some))
    # Names of the first genes, which are technical and much expressed.
    technical = ["RPL13A", "RPS6", "MT-CO1", "MT-ND4", "HBB", "HBA1"]
    names = np.array([*technical, *[f"GENE{i:05d}" for i in range(len(technical), n_genes)]])[:n_genes]
    factor = np.where(np.arange(n_genes) < len(technical), 50.0, 1.0)
    edges = np.floor(np.cumsum(share) * n_samples + 0.5).astype(int)

    def subtype(i: int) -> int:
        return int(np.searchsorted(edges, i, "right").clip(0, 3))

    def traits(i: int):
        r = np.random.default_rng([seed, i])
        atypical, other, alpha, purity = r.random() < 0.12, int(r.integers(1, 4)), r.uniform(0.35, 0.65), r.uniform(0.3, 0.95)
        return r, subtype(i), atypical, (subtype(i) + other) % 4, alpha, purity

    def run(batches):
        for pdf in batches:
            for i in pdf["id"]:
                r, own, atypical, other, alpha, purity = traits(int(i))
                load = alpha * loads[own] + (1 - alpha) * loads[other] if atypical else loads[own]
                log = base + load + (1 - purity) * impure + r.normal(0, 0.7, n_genes)
                mean = np.exp(log / 1.5) * r.uniform(0.7, 1.4) * factor
                yield pd.DataFrame({"sample": f"TUM_{i:03d}", "gene": names, "value": r.negative_binomial(5, 5 / (5 + mean)).astype(float)})

    counts = spark.range(0, n_samples, 1, min(n_samples, 32)).mapInPandas(run, "sample string, gene string, value double")
    rows = [(f"TUM_{i:03d}", f"ST{subtype(i) + 1}", float(traits(i)[5]), bool(traits(i)[2])) for i in range(n_samples)]
    return counts, spark.createDataFrame(rows, "sample string, true_subtype string, purity double, atypical boolean")
