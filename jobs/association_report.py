"""Associations between the categorical variables of a corpus: which properties of documents and labels go together.

    python -m jobs.association_report --documents DOCS --labels LABELS --out OUT [--config FILE]

The configuration names the variables as SQL expressions over the documents' and labels'
columns. Texts are turned into levels where they are read; only ids and levels meet the
labels. The job writes

* ``OUT/observed``: the counted levels of each pair, from which the rest is made;
* ``OUT/cells``: each pair's counts, expected counts and adjusted residuals, partitioned by ``var1``;
* ``OUT/counts``: the counts with totals, partitioned by ``var1``;
* ``OUT/tests``: test, statistic, p and q of each pair, partitioned by ``test``,

each replaced as a whole, and logs what it read and wrote and the strongest associations. Drawn
p-values depend on the seed and the pair only, so a rerun gives the same tables.

A document without labels has null levels, which count in no pair; of repeated labels of one
document the highest hold. A variable with fewer than two levels or more than ``max_levels`` is
left out with a warning.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from clustrata.operators import crosstabs  # noqa: E402

log = logging.getLogger("association_report")
DEFAULTS = Path(__file__).with_suffix(".json")


def write(df: DataFrame, path: str, by: str) -> DataFrame:
    """Replace a partitioned table, log its rows and read it again."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    log.info("wrote %s: %d rows", path, out.count())
    return out


def levels(documents: DataFrame, labels: DataFrame, o: Mapping) -> DataFrame:
    """(id, variables..): one row a document, each variable's level as text."""
    name = o["id"]
    of_labels = [c for c in labels.columns if c != name and c not in documents.columns]
    asked = {v: e for v, e in o["variables"].items() if e not in of_labels}
    rows = documents.select(F.col(name), *[F.expr(e).cast("string").alias(v) for v, e in asked.items()])
    theirs = [F.max(e).cast("string").alias(v) for v, e in o["variables"].items() if e in of_labels]
    if theirs:
        rows = rows.join(labels.where(F.col(name).isNotNull()).groupBy(name).agg(*theirs), name, "left")
    return rows.select(name, *o["variables"])


def run(spark: SparkSession, documents: str, labels: str, out: str, options: Mapping | None = None) -> dict[str, int]:
    """Write the tables; the numbers of documents read and pairs tested."""
    o = {**json.loads(DEFAULTS.read_text()), **(options or {})}
    rows = spark.read.parquet(documents)
    wide = levels(rows, spark.read.parquet(labels), o)
    names, read = list(o["variables"]), rows.count()
    log.info("read %s and %s: %d documents", documents, labels, read)
    # one aggregate over all rows: every pair, and each variable with itself for its number of levels
    pairs = [*crosstabs.all_pairs([], names), *((v, v) for v in names)]
    observed = write(crosstabs.pair_counts(wide, pairs), f"{out}/observed", "var1")
    size = {r["var1"]: r["n"] for r in observed.where("var1 = var2").groupBy("var1").agg(F.count("*").alias("n")).collect()}  # one row a variable
    kept = [v for v in names if 2 <= size.get(v, 0) <= o["max_levels"]]
    for v in names:
        if v not in kept:
            log.warning("%s has %d levels and is left out", v, size.get(v, 0))
    both = observed.where((F.col("var1") != F.col("var2")) & F.col("var1").isin(*kept) & F.col("var2").isin(*kept))
    found = write(crosstabs.expected_cells(both), f"{out}/cells", "var1")
    write(crosstabs.with_totals(found), f"{out}/counts", "var1")
    tests = write(crosstabs.association_suite(found, o["ordinal"], o["resamples"], o["min_expected"], o["max_low_expected"], o["seed"]), f"{out}/tests", "test")
    for r in crosstabs.strongest(tests).collect():  # at most eight rows
        log.info("%s with %s: %s, p %.3g, V %.2f", r["var1"], r["var2"], r["test"], r["p"], r["cramers_v"])
    return {"rows_read": read, "pairs": tests.count()}


def result(spark: SparkSession, out: str) -> DataFrame:
    """Every cell with its pair's test; a pair that couldn't be tested has ``none``."""
    cells, tests = spark.read.parquet(f"{out}/cells"), spark.read.parquet(f"{out}/tests")
    return cells.join(tests, list(crosstabs.PAIR), "left").fillna({"test": "none", "dof": 0, "n": 0, "conditions_met": False})


def main(argv: list[str] | None = None) -> int:
    from clustrata.session import session

    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("documents", "labels", "out"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config", default=str(DEFAULTS))
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = session("association report")
    try:
        run(spark, args.documents, args.labels, args.out, json.loads(Path(args.config).read_text()))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
