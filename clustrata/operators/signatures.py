"""Gene-set scores and enrichment of ranked lists."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def mean_z_scores(df: DataFrame, sets: DataFrame) -> DataFrame:
    """(signature, sample, score): the mean over a set's genes of their z-scores (sample sd; 1 where it is 0).

    sets: (signature, gene); sets without a gene of the matrix have no score.
    """
    stats = df.groupBy("gene").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    z = df.join(stats, "gene").select("sample", "gene", ((F.col("value") - F.col("_m")) / F.when(F.coalesce("_s", F.lit(0.0)) == 0, 1.0).otherwise(F.col("_s"))).alias("z"))
    return z.join(sets.distinct(), "gene").groupBy("signature", "sample").agg(F.avg("z").alias("score"))


def marker_means(df: DataFrame, markers: DataFrame, least: int = 1) -> DataFrame:
    """(signature, sample, score, n_markers): a cell type's abundance as the mean of its markers' values on a log scale.

    markers: (signature, gene); types with fewer than ``least`` markers in the matrix have no score.
    """
    met = df.where(F.col("value").isNotNull()).join(markers.select("signature", "gene").distinct(), "gene")
    out = met.groupBy("signature", "sample").agg(F.avg("value").alias("score"), F.count("*").alias("n_markers"))
    return out.where(F.col("n_markers") >= least)


def standardised(scores: DataFrame) -> DataFrame:
    """(signature, sample, z): scores centred and scaled within a signature (sample sd; 1 where it is 0 or unknown)."""
    by = Window.partitionBy("signature")
    sd = F.coalesce(F.stddev_samp("score").over(by), F.lit(0.0))
    return scores.select("signature", "sample", ((F.col("score") - F.avg("score").over(by)) / F.when(sd == 0, 1.0).otherwise(sd)).alias("z"))


def ssgsea(df: DataFrame, sets: DataFrame, alpha: float = 0.25, min_size: int = 3) -> DataFrame:
    """(signature, sample, es, nes): the integral of the running difference, in closed form over the hits.

    Genes are ranked within each sample, the highest having rank N; a hit weighs rank**alpha.
    ``nes`` divides by the range of all scores.
    """
    order = Window.partitionBy("sample").orderBy(F.desc("value"), "gene")
    ranked = df.select("sample", "gene", F.row_number().over(order).alias("pos"), F.count("*").over(Window.partitionBy("sample")).alias("n"))
    hits = ranked.join(sets.distinct(), "gene").withColumn("rest", F.col("n") - F.col("pos") + 1)
    w = F.pow("rest", F.lit(alpha))
    s = hits.groupBy("signature", "sample").agg(F.count("*").alias("h"), F.first("n").alias("n"), F.sum(w).alias("sw"), F.sum(w * F.col("rest")).alias("swr"), F.sum("rest").alias("sr"))
    s = s.where((F.col("h") >= min_size) & (F.col("n") > F.col("h")))
    es = F.col("swr") / F.col("sw") - (F.col("n") * (F.col("n") + 1) / 2 - F.col("sr")) / (F.col("n") - F.col("h"))
    scored = s.select("signature", "sample", es.alias("es"))
    span = scored.agg((F.max("es") - F.min("es")).alias("_span"))
    return scored.crossJoin(F.broadcast(span)).select("signature", "sample", "es", F.when(F.col("_span") > 0, F.col("es") / F.col("_span")).alias("nes"))


def ranked_list(scores: DataFrame) -> DataFrame:
    """(ranking, gene, score) with one row for each gene: the mean of duplicates, no nulls."""
    clean = scores.where(F.col("score").isNotNull() & ~F.isnan("score"))
    return clean.groupBy("ranking", "gene").agg(F.avg("score").alias("score"))


def enrichment_scores(scores: DataFrame, sets: DataFrame, min_size: int = 15, max_size: int = 500) -> DataFrame:
    """(ranking, signature, size, es, peak): running-sum enrichment, evaluated at the hits only.

    Just before and at each hit the sum over the misses is a closed form of the hit's place,
    so a window over the hits replaces one over all genes.
    """
    order = Window.partitionBy("ranking").orderBy(F.desc("score"), "gene")
    ranked = ranked_list(scores).select("ranking", "gene", F.abs("score").alias("w"), F.row_number().over(order).alias("pos"), F.count("*").over(Window.partitionBy("ranking")).alias("n"))
    hits = ranked.join(sets.distinct(), "gene")
    group = Window.partitionBy("ranking", "signature")
    up = group.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = hits.select("ranking", "signature", "pos", "n", "w", F.count("*").over(group).alias("size"), F.sum("w").over(group).alias("total"), F.sum("w").over(up).alias("cum"), F.row_number().over(group.orderBy("pos")).alias("i"))
    steps = steps.where((F.col("size") >= min_size) & (F.col("size") <= max_size) & (F.col("n") > F.col("size")) & (F.col("total") > 0))
    miss = (F.col("pos") - F.col("i")) / (F.col("n") - F.col("size"))
    at, before = F.col("cum") / F.col("total") - miss, (F.col("cum") - F.col("w")) / F.col("total") - miss
    ends = steps.groupBy("ranking", "signature").agg(F.first("size").alias("size"), F.max(F.struct(at.alias("v"), (-F.col("pos")).alias("p"))).alias("hi"), F.min(F.struct(before.alias("v"), F.col("pos").alias("p"))).alias("lo"))
    up_wins = F.col("hi.v") >= -F.col("lo.v")
    return ends.select("ranking", "signature", "size", F.when(up_wins, F.col("hi.v")).otherwise(F.col("lo.v")).alias("es"), F.when(up_wins, -F.col("hi.p")).otherwise(F.col("lo.p")).alias("peak"))


def _es_of(positions: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Enrichment of random sets: sorted 0-based positions (sets x size) in a list of weights."""
    n, size = len(weights), positions.shape[1]
    w = weights[positions]
    total = np.maximum(w.sum(1, keepdims=True), 1e-300)
    cum = np.cumsum(w, 1) / total
    miss = (positions - np.arange(size)) / max(1, n - size)
    hi, lo = (cum - miss).max(1), (cum - w / total - miss).min(1)
    return np.where(hi >= -lo, hi, lo)


def gsea_prerank(scores: DataFrame, sets: DataFrame, permutations: int = 1000, min_size: int = 15, max_size: int = 500, seed: int = 0) -> DataFrame:
    """(ranking, signature, size, es, nes, nom_p, fdr_q, lead_genes) against random sets of the same size.

    One task per ranking makes its null for each distinct size; the rest are aggregates. FDR
    compares tail shares of null and observed scores within a sign.
    """
    es = enrichment_scores(scores, sets, min_size, max_size)
    lists = ranked_list(scores)
    order = Window.partitionBy("ranking").orderBy(F.desc("score"), "gene")
    placed = lists.select("ranking", "gene", "score", F.row_number().over(order).alias("pos"))
    lead = placed.join(sets.distinct(), "gene").join(es.select("ranking", "signature", "es", "peak"), ["ranking", "signature"])
    led = lead.where(F.when(F.col("es") >= 0, F.col("pos") <= F.col("peak")).otherwise(F.col("pos") >= F.col("peak")))
    genes = led.groupBy("ranking", "signature").agg(F.array_sort(F.collect_list(F.struct("pos", "gene"))).alias("l")).select("ranking", "signature", F.col("l.gene").alias("lead_genes"))
    weights = placed.groupBy("ranking").agg(F.array_sort(F.collect_list(F.struct("pos", F.abs("score").alias("w")))).alias("w")).select("ranking", F.col("w.w").alias("weights"))
    rows = es.groupBy("ranking").agg(F.collect_list(F.struct("signature", "size", "es")).alias("sets")).join(weights, "ranking")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, r in pdf.iterrows():
                yield _against_null(r["ranking"], list(r["sets"]), np.asarray(r["weights"]), permutations, seed)

    kind = es.schema["ranking"].dataType.simpleString()
    found = rows.mapInPandas(run, f"ranking {kind}, signature string, size bigint, es double, nes double, nom_p double, fdr_q double")
    return found.join(genes, ["ranking", "signature"], "left")


def _against_null(ranking, rows: list, weights: np.ndarray, permutations: int, seed: int) -> pd.DataFrame:
    null: dict[int, np.ndarray] = {}
    for size in sorted({r["size"] for r in rows}):
        rng = np.random.default_rng([seed, int(size)])
        draws = np.argpartition(rng.random((permutations, len(weights))), size - 1, axis=1)[:, :size]
        null[size] = _es_of(np.sort(draws, 1), weights)
    out = pd.DataFrame([{"ranking": ranking, "signature": r["signature"], "size": r["size"], "es": r["es"]} for r in rows])
    nes, p, pool = [], [], []
    for r in rows:
        e, x = r["es"], null[r["size"]]
        same = x[x >= 0] if e >= 0 else -x[x < 0]
        mean = same.mean() if len(same) else np.nan
        nes.append(e / mean if mean and np.isfinite(mean) else np.nan)
        p.append(float((same >= abs(e)).mean()) if len(same) else np.nan)
        pos, neg = x[x >= 0], x[x < 0]
        pool.append(np.concatenate([pos / pos.mean() if len(pos) and pos.mean() else pos, -(neg / neg.mean()) if len(neg) else neg]))
    out["nes"], out["nom_p"] = nes, p
    pooled, seen = np.concatenate(pool), out["nes"].to_numpy()
    q = []
    for v in seen:
        if not np.isfinite(v):
            q.append(np.nan)
            continue
        side, own = (pooled[pooled >= 0], seen[seen >= 0]) if v >= 0 else (-pooled[pooled < 0], -seen[seen < 0])
        null_share = (side >= abs(v)).mean() if len(side) else 0.0
        q.append(float(min(1.0, null_share / max((own >= abs(v)).mean(), 1e-300))))
    return out.assign(fdr_q=q)


def gsea_by_collection(rankings: DataFrame, sets: DataFrame, keys: Sequence[str], permutations: int = 1000, min_size: int = 15, max_size: int = 500, seed: int = 0) -> DataFrame:
    """(keys.., collection, signature, size, es, nes, nom_p, fdr_q, lead_genes) of all rankings (keys.., gene, score) in all collections at once.

    sets: (collection, signature, gene). Genes are named within their collection, so that a
    ranking meets each collection's sets apart; a family of false-discovery rates is one ranking
    and collection.
    """
    if not 1 <= min_size <= max_size:
        raise ValueError("the sizes of gene sets need 1 <= min_size <= max_size")
    mark = "\x1f"
    named = F.concat_ws(mark, "collection", "gene")
    wide = rankings.crossJoin(F.broadcast(sets.select("collection").distinct()))  # a handful of collections
    lists = wide.select(F.concat_ws(mark, *[F.col(k).cast("string") for k in keys], "collection").alias("ranking"), named.alias("gene"), "score")
    found = gsea_prerank(lists, sets.select(F.concat_ws(mark, "collection", "signature").alias("signature"), named.alias("gene")), permutations, min_size, max_size, seed)
    part = F.split("ranking", mark)
    own = [part[i].cast(rankings.schema[k].dataType).alias(k) for i, k in enumerate(keys)]
    plain = F.transform("lead_genes", lambda g: F.substring_index(g, mark, -1)).alias("lead_genes")
    return found.select(*own, part[len(keys)].alias("collection"), F.substring_index("signature", mark, -1).alias("signature"), "size", "es", "nes", "nom_p", "fdr_q", plain)


def collection_manifest(rankings: DataFrame, sets: DataFrame, results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys.., collection, status, n_pathways) of every ranking with every collection, and of results without a task (``unexpected``)."""
    tasks = rankings.select(*keys).distinct().crossJoin(F.broadcast(sets.select("collection").distinct())).withColumn("_asked", F.lit(True))
    counted = results.groupBy(*keys, "collection").agg(F.count("*").alias("n_pathways"))
    full = tasks.join(counted, [*keys, "collection"], "full")
    status = F.when(F.col("_asked").isNull(), "unexpected").when(F.col("n_pathways").isNull(), "empty").otherwise("ok")
    return full.select(*keys, "collection", status.alias("status"), F.coalesce("n_pathways", F.lit(0)).cast("bigint").alias("n_pathways"))


def significant(results: DataFrame, q_max: float = 0.25) -> DataFrame:
    """The enriched sets below a false-discovery rate."""
    return results.where(F.col("fdr_q") < q_max)


def nes_matrix(results: DataFrame, q_max: float, levels: list[str]) -> DataFrame:
    """Sets x levels of ``contrast``: sets significant somewhere, by largest |NES|."""
    keep = results.groupBy("signature").agg(F.bool_or(F.col("fdr_q") < q_max).alias("ok"), F.max(F.abs("nes")).alias("top")).where("ok")
    wide = results.join(keep.select("signature", "top"), "signature").groupBy("signature", "top").pivot("contrast", levels).agg(F.first("nes"))
    return wide.orderBy(F.desc("top"), "signature")


def run_manifest(tasks: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., status, n_pathways) of every task, also of those without a result."""
    counted = results.groupBy(*keys).agg(F.count("*").alias("n_pathways"))
    full = tasks.select(*keys).distinct().join(counted, keys, "left")
    return full.select(*keys, F.when(F.col("n_pathways").isNull(), "empty").otherwise("ok").alias("status"), F.coalesce("n_pathways", F.lit(0)).alias("n_pathways"))


def missing_tasks(tasks: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """The tasks (keys..) that left no result."""
    return tasks.select(*keys).distinct().join(results.select(*keys).distinct(), keys, "left_anti")


def best_pathways(results: DataFrame, n: int = 5, by: str = "contrast") -> DataFrame:
    """The ``n`` sets of each contrast with the largest |NES|, by ``place``; equal ones by name."""
    order = Window.partitionBy(by).orderBy(F.desc(F.abs("nes")), "signature")
    known = results.where(F.col("nes").isNotNull() & ~F.isnan("nes"))
    return known.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def top_signatures(results: DataFrame, n: int = 8, p_max: float = 0.05) -> DataFrame:
    """(signature, best, significant): up to n signatures below the limit, else the n best regardless."""
    best = results.groupBy("signature").agg(F.min("q").alias("best"))
    whole = Window.partitionBy()
    marked = best.withColumn("significant", F.coalesce(F.col("best") <= p_max, F.lit(False)))
    usable = marked.withColumn("_any", F.max("significant").over(whole)).where(F.col("significant") | ~F.col("_any")).drop("_any")
    return usable.orderBy(F.asc_nulls_last("best"), "signature").limit(n)


def union_sources(sources: list[tuple[str, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """(sets (signature, gene), provenance (signature, source, n_genes)); a name met again gets its source in front."""
    parts = None
    for pos, (name, df) in enumerate(sources):
        one = df.select(F.lit(pos).alias("pos"), F.lit(name).alias("source"), F.col("signature").alias("plain"), "gene")
        parts = one if parts is None else parts.unionByName(one)
    names = parts.select("pos", "source", "plain").distinct()
    again = F.row_number().over(Window.partitionBy("plain").orderBy("pos")) > 1
    names = names.withColumn("signature", F.when(again, F.concat_ws(":", "source", "plain")).otherwise(F.col("plain")))
    full = parts.join(names, ["pos", "source", "plain"])
    return full.select("signature", "gene"), full.groupBy("signature", "source").agg(F.count_distinct("gene").alias("n_genes"))


def cluster_means(values: DataFrame, partition: DataFrame) -> DataFrame:
    """(kind, cluster, mean, z): cluster means of (kind, sample, value) and their z-scores over the clusters of a kind."""
    mean = values.join(partition.select("sample", "cluster"), "sample").groupBy("kind", "cluster").agg(F.avg("value").alias("mean"))
    by = Window.partitionBy("kind")
    sd = F.coalesce(F.stddev_samp("mean").over(by), F.lit(0.0))
    return mean.withColumn("z", (F.col("mean") - F.avg("mean").over(by)) / F.when(sd == 0, 1.0).otherwise(sd))


def level_shares(partition: DataFrame, values: DataFrame) -> DataFrame:
    """(cluster, level, n, share): levels of (sample, level) within each cluster; missing ones are ``NA``."""
    full = partition.select("sample", "cluster").join(values, "sample", "left").withColumn("level", F.coalesce("level", F.lit("NA")))
    counted = full.groupBy("cluster", "level").agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("cluster")))
