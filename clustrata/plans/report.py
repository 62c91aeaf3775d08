"""A result's tables as one JSON payload and a page that shows it; small tables only, by design of the page."""

from __future__ import annotations

import html
import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import cleaned

#: Rows of a table that the page shows; the written tables are whole.
PAGE_ROWS = 3000


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, low, high, n) of equal widths, as an aggregate."""
    span = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col(column) - F.col("_lo")) / F.when(width > 0, width)), F.lit(bins - 1))).otherwise(0)
    rows = df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(span))
    out = rows.groupBy(place.cast("int").alias("bin"), "_lo", "_hi").agg(F.count("*").alias("n"))
    return out.select("bin", (F.col("_lo") + F.col("bin") * width).alias("low"), (F.col("_lo") + (F.col("bin") + 1) * width).alias("high"), "n")


def box_plot(scores: DataFrame, groups: DataFrame) -> DataFrame:
    """(signature, level, n, min, q1, median, q3, max) of scores by group."""
    p = F.percentile("score", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = scores.join(groups, "sample").groupBy("signature", "level").agg(F.count("*").alias("n"), F.min("score").alias("min"), p.alias("p"), F.max("score").alias("max"))
    return out.select("signature", "level", "n", "min", F.col("p")[0].alias("q1"), F.col("p")[1].alias("median"), F.col("p")[2].alias("q3"), "max")


def bounded_payload(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], most: int = PAGE_ROWS) -> DataFrame:
    """(keys.., n_rows, truncated, rows): each group's first ``most`` rows as one JSON text.

    Rows beyond the bound are cut by rank, which Spark applies before the shuffle; their number
    comes from an aggregate, so a group of any size sends at most ``most`` rows from each task.
    """
    columns = [c for c in df.columns if c not in keys]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    head = df.withColumn("_r", rank).where(F.col("_r") <= most)
    packed = F.transform(F.array_sort(F.collect_list(F.struct("_r", F.struct(*columns).alias("v")))), lambda x: x["v"])
    shown = head.groupBy(*keys).agg(F.to_json(packed, {"ignoreNullFields": "false"}).alias("rows"))
    counted = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counted.join(shown, list(keys)).select(*keys, "n_rows", (F.col("n_rows") > most).alias("truncated"), "rows")


def tree_payload(links: DataFrame, branches: DataFrame | None = None) -> DataFrame:
    """(k, icoord, dcoord, stability): the drawn tree of each k as JSON lists in the same order; branches without a score have null."""
    own = links if branches is None else links.join(branches.select("k", "branch_id", "stability"), ["k", "branch_id"], "left")
    score = F.col("stability") if branches is not None else F.lit(None).cast("double")
    across = F.array("left", "left", "right", "right").alias("x")
    up = F.array("left_height", "height", "height", "right_height").alias("y")
    rows = own.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("place", across, up, F.struct(score.alias("s")).alias("s")))).alias("l"))
    return rows.select("k", F.to_json("l.x").alias("icoord"), F.to_json("l.y").alias("dcoord"), F.to_json(F.transform("l.s", lambda s: s["s"])).alias("stability"))


def folder_payload(spark: SparkSession, folder: str, names: Sequence[str], most: int = PAGE_ROWS) -> DataFrame:
    """(table, columns, truncated, rows): the head of every written table of a folder, unlike ones together, each row as one JSON text.

    Each table is read with a limit that stops its scan; its rows become JSON where they are
    read, so tables of any columns are one DataFrame.
    """
    parts = []
    for name in names:
        df = spark.read.parquet(f"{folder}/{name}")
        head = df.limit(most + 1).select(F.lit(name).alias("table"), F.lit(json.dumps(df.columns)).alias("columns"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("row"))
        parts.append(head)
    if not parts:
        raise ValueError("there is no table")
    every = reduce(DataFrame.unionByName, parts).groupBy("table", "columns").agg(F.sort_array(F.collect_list("row")).alias("r"))
    return every.select("table", "columns", (F.size("r") > most).alias("truncated"), F.slice("r", 1, most).alias("rows"))


def consensus_payload(pairs: DataFrame, partition: DataFrame, k: int) -> dict:
    """Samples in leaf order and their consensus in whole percents."""
    order = [r["sample"] for r in partition.where(F.col("k") == k).orderBy("leaf_pos").select("sample").collect()]
    place = {s: i for i, s in enumerate(order)}
    matrix = [[100 if i == j else 0 for j in range(len(order))] for i in range(len(order))]
    for r in pairs.where(F.col("k") == k).select("i", "j", F.round(F.col("consensus") * 100).cast("int").alias("c")).toLocalIterator():
        a, b = place[r["i"]], place[r["j"]]
        matrix[a][b] = matrix[b][a] = r["c"]
    return {"k": k, "samples": order, "matrix": matrix}


def payload(tables: Mapping[str, DataFrame], **values) -> dict:
    """Everything that the page needs, free of NaN: the head of each table and further values."""
    out = {}
    for name, df in tables.items():
        rows = df.limit(PAGE_ROWS + 1).collect()
        out[name] = {"columns": df.columns, "rows": [[v for v in r] for r in rows[:PAGE_ROWS]], "truncated": len(rows) > PAGE_ROWS}
    return cleaned({"tables": out, **values})


_PAGE = """<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title>
<style>body{{font-family:sans-serif;margin:2em}}table{{border-collapse:collapse}}td,th{{border:1px solid #ccc;padding:2px 6px;font-size:12px}}</style>
</head><body><h1>{title}</h1><div id="out"></div><script id="data" type="application/json">{data}</script><script>
const data = JSON.parse(document.getElementById("data").textContent), out = document.getElementById("out");
for (const [name, t] of Object.entries(data.tables)) {{
  const h = document.createElement("h2"); h.textContent = name + (t.truncated ? " (first rows)" : ""); out.append(h);
  const table = document.createElement("table"); out.append(table);
  for (const row of [t.columns, ...t.rows]) {{
    const tr = table.insertRow();
    for (const v of row) tr.insertCell().textContent = v === null ? "" : typeof v === "number" ? +v.toPrecision(5) : v;
  }}
}}
</script></body></html>"""


def page(title: str, data: dict) -> str:
    """A page without external parts."""
    text = json.dumps(data, ensure_ascii=False, default=str).replace("</", "<\\/")
    return _PAGE.format(title=html.escape(title), data=text)
