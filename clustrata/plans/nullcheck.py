"""Null check from the command line: is the consensus of a cohort less ambiguous than that of data without groups?

    python -m clustrata.plans.nullcheck --counts counts.csv --outdir results/null

Writes ``null_comparison`` (a row for each model, replicate and k) and ``null_summary`` (ranges over
replicates and how far the observed PAC lies below each null model's least) under the output folder.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession

from ..operators import nullcheck, preprocess
from ..operators.kernels.cluster import LINKAGES
from ..sources import tables

log = logging.getLogger(__name__)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser("clustrata-nullcheck", description=__doc__.split("\n")[0])
    out.add_argument("--counts", required=True)
    out.add_argument("--samples-in-rows", action="store_true")
    out.add_argument("--already-normalized", action="store_true")
    out.add_argument("--outdir", default="results/null")
    for name, default in (("n-top-genes", 5000), ("k-min", 2), ("k-max", 8), ("n-resamples", 200), ("n-null", 3), ("seed", 0), ("partitions", 32)):
        out.add_argument(f"--{name}", type=int, default=default)
    for name in ("prop-samples", "prop-genes"):
        out.add_argument(f"--{name}", type=float, default=0.8)
    for name in ("sample-mode", "gene-mode"):
        out.add_argument(f"--{name}", choices=["subsample", "bootstrap"], default="subsample")
    out.add_argument("--base", choices=["hierarchical", "kmeans", "kmedoids"], default="hierarchical")
    out.add_argument("--metric", choices=["pearson", "spearman", "euclidean", "cosine"], default="pearson")
    out.add_argument("--linkage", choices=LINKAGES, default="average")
    return out


def problems(o: argparse.Namespace) -> list[str]:
    """What is wrong with the options, before anything is read."""
    found = []
    if not 2 <= o.k_min <= o.k_max:
        found.append("k-min must be at least 2 and at most k-max")
    found += [f"{n.replace('_', '-')} must be at least 1" for n in ("n_top_genes", "n_resamples", "n_null", "partitions") if getattr(o, n) < 1]
    return found + [f"{n.replace('_', '-')} must be above 0 and at most 1" for n in ("prop_samples", "prop_genes") if not 0 < getattr(o, n) <= 1]


def run(spark: SparkSession, o: argparse.Namespace) -> DataFrame:
    """Compare, write and log; the summary as written."""
    raw = tables.read_matrix(spark, o.counts, not o.samples_in_rows)
    matrix = preprocess.preprocess(raw, n_top=o.n_top_genes, already_normalized=o.already_normalized)
    path = f"{o.outdir}/tables/matrix"
    tables.write_table(matrix, path)  # filters are computed once, not for every model
    matrix = spark.read.schema(matrix.schema).parquet(path)
    found = nullcheck.null_comparison(
        matrix, list(range(o.k_min, o.k_max + 1)), o.n_null, o.n_resamples, o.prop_samples, o.prop_genes, o.sample_mode, o.gene_mode,
        o.base, o.metric, o.linkage, o.seed, partitions=o.partitions,
    )
    tables.write_table(found.orderBy("model", "rep", "k"), f"{o.outdir}/tables/null_comparison", single=True)
    written = spark.read.csv(f"{o.outdir}/tables/null_comparison", header=True, schema=found.schema)
    summary = nullcheck.null_summary(written)
    both = summary.join(nullcheck.null_gaps(summary), "k").orderBy("model", "k")
    tables.write_table(both, f"{o.outdir}/tables/null_summary", single=True)
    out = spark.read.csv(f"{o.outdir}/tables/null_summary", header=True, schema=both.schema)
    for r in out.orderBy("k", "model").collect():  # three rows for each k
        log.info("k=%d %s: PAC %.3f (%.3f to %.3f), gap to permuted %.3f, to gaussian %.3f", r["k"], r["model"], r["pac_mean"], r["pac_min"], r["pac_max"], r["gap_permuted"], r["gap_gaussian"])
    return out


def main(argv: list[str] | None = None) -> int:
    """The command line; bad options end with 2."""
    from ..session import session

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    options = parser().parse_args(argv)
    if wrong := problems(options):
        print("\n".join(wrong), file=sys.stderr)
        return 2
    run(session("clustrata null check"), options)
    return 0


if __name__ == "__main__":
    sys.exit(main())
