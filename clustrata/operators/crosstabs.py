"""Associations of many pairs of categorical variables in one plan: counted cells, then one aggregate and one test a pair.

Rows are never joined or moved: each yields its pairs of levels, which are counted map-side.
Everything after that is as long as the cells of the tables, whatever the number of rows, and
no step asks the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import benjamini_hochberg, stars
from ..functions.tails import chi2_sf, fisher_p
from . import association

PAIR = ("var1", "var2")
#: Tables that one task draws for a pair at a time.
CHUNK = 500
#: numpy's hypergeometric generator ends here; in larger tables a draw is binomial, which differs by less than the share drawn.
MOST_COUNT = 10**9


def all_pairs(clusters: Sequence[str], variables: Sequence[str]) -> list[tuple[str, str]]:
    """Every partition with every variable, then every two variables."""
    return [(c, v) for c in clusters for v in variables] + list(combinations(variables, 2))


def pair_counts(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(var1, var2, row, col, observed) of every pair of columns, over the rows where both are known."""
    level = lambda c: F.col(f"`{c}`").cast("string")
    each = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), level(a).alias("row"), level(b).alias("col")) for a, b in pairs])
    return df.select(F.inline(each)).where("row is not null and col is not null").groupBy(*PAIR, "row", "col").agg(F.count("*").alias("observed"))


def expected_cells(counts: DataFrame) -> DataFrame:
    """Counted pairs with their empty cells, ``expected`` and ``adj_residual``."""
    return association.expected_cells(counts, PAIR)


def pair_cells(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(var1, var2, row, col, observed, expected, adj_residual) of every pair of columns."""
    return expected_cells(pair_counts(df, pairs))


def _scored(side: str, var: str, orders: Mapping[str, Sequence[str] | None]) -> Column:
    """The score of a level: its place in the declared order (null if it isn't there), or by name in an undeclared or unlisted one."""
    by_name = F.dense_rank().over(Window.partitionBy(*PAIR).orderBy(side)) - 1
    out = by_name
    for name, order in orders.items():
        if order:
            place = F.array_position(F.array(*[F.lit(str(x)) for x in order]), F.col(side)) - 1
            out = F.when(F.col(var) == name, F.when(place >= 0, place)).otherwise(out)
    return out.cast("double")


def table_tests(cells: DataFrame, orders: Mapping[str, Sequence[str] | None] | None = None, min_expected: float = 5, max_low: float = 0.2) -> DataFrame:
    """One row a pair of at least two levels each: counts, conditions, Pearson's and the trend's statistics, the corner counts, the margins and ``test``.

    Tables that break Cochran's conditions take Fisher's exact test if they are two by two, else
    draws with fixed margins; others the linear trend if a variable is ordinal and both axes can
    be scored, else Pearson's test.
    """
    orders = orders or {}
    n = F.sum("observed")
    rank = lambda side: F.dense_rank().over(Window.partitionBy(*PAIR).orderBy(side))
    total = lambda side: F.sum("observed").over(Window.partitionBy(*PAIR, side))
    w = F.col("observed")
    s = cells.withColumns({"_u": _scored("row", "var1", orders), "_v": _scored("col", "var2", orders), "_r": rank("row"), "_c": rank("col"), "_nr": total("row"), "_nc": total("col")})
    corner = lambda r, c: F.sum(F.when((F.col("_r") == r) & (F.col("_c") == c), w).otherwise(0))
    out = s.groupBy(*PAIR).agg(
        n.alias("n"), F.max("_r").alias("n_rows"), F.max("_c").alias("n_cols"),
        F.sum((w - F.col("expected")) ** 2 / F.col("expected")).alias("chi2"),
        F.min("expected").alias("min_expected"), F.avg((F.col("expected") < min_expected).cast("double")).alias("share_low"),
        F.sum(w * F.col("_u")).alias("_su"), F.sum(w * F.col("_v")).alias("_sv"), F.sum(w * F.col("_u") ** 2).alias("_suu"), F.sum(w * F.col("_v") ** 2).alias("_svv"), F.sum(w * F.col("_u") * F.col("_v")).alias("_suv"),
        F.max(F.col("_u").isNull()).alias("_lost_u"), F.max(F.col("_v").isNull()).alias("_lost_v"),
        corner(1, 1).alias("a"), corner(1, 2).alias("b"), corner(2, 1).alias("c"), corner(2, 2).alias("d"),
        F.array_sort(F.collect_set(F.struct(F.col("_r").alias("at"), F.col("_nr").alias("n")))).alias("row_totals"),
        F.array_sort(F.collect_set(F.struct(F.col("_c").alias("at"), F.col("_nc").alias("n")))).alias("col_totals"),
    ).where((F.col("n_rows") > 1) & (F.col("n_cols") > 1))
    ordinal = lambda v: F.col(v).isin(*orders) if orders else F.lit(False)
    axis = lambda v, lost, size: F.when(ordinal(v), ~F.col(lost)).otherwise(F.col(size) == 2)
    trend = (ordinal("var1") | ordinal("var2")) & axis("var1", "_lost_u", "n_rows") & axis("var2", "_lost_v", "n_cols")
    met = (F.col("min_expected") >= 1) & (F.col("share_low") <= max_low)
    su2, sv2 = F.col("_suu") - F.col("_su") ** 2 / F.col("n"), F.col("_svv") - F.col("_sv") ** 2 / F.col("n")
    varies = (su2 > 1e-12) & (sv2 > 1e-12)
    r = F.when(varies, (F.col("_suv") - F.col("_su") * F.col("_sv") / F.col("n")) / F.sqrt(F.when(varies, su2 * sv2))).otherwise(0.0)
    test = F.when(~met & (F.col("n_rows") == 2) & (F.col("n_cols") == 2), "fisher").when(~met, "monte_carlo").when(trend, "trend").otherwise("chi2")
    out = out.withColumns({"conditions_met": met, "test": test, "trend_r": F.when(test == "trend", r)})
    return out.withColumns({
        "dof": F.when(F.col("test") == "trend", 1).otherwise((F.col("n_rows") - 1) * (F.col("n_cols") - 1)).cast("bigint"),
        "statistic": F.when(F.col("test") == "trend", (F.col("n") - 1) * F.col("trend_r") ** 2).otherwise(F.col("chi2")),
        "cramers_v": F.sqrt(F.col("chi2") / (F.col("n") * (F.least("n_rows", "n_cols") - 1))),
    }).drop("_su", "_sv", "_suu", "_svv", "_suv", "_lost_u", "_lost_v")


def drawn_tables(rows: np.ndarray, cols: np.ndarray, times: int, rng: np.random.Generator) -> np.ndarray:
    """(times, rows, cols): tables of independent variables with these margins."""
    out = np.zeros((times, len(rows), len(cols)), np.int64)
    left = np.repeat(cols[None, :], times, 0)
    for i in range(len(rows) - 1):
        need, pool = np.full(times, rows[i]), left.sum(1)
        for j in range(len(cols) - 1):
            pool = pool - left[:, j]
            if rows[i] + cols.sum() < MOST_COUNT:
                x = rng.hypergeometric(left[:, j], pool, need)
            else:
                share = left[:, j] / np.maximum(left[:, j] + pool, 1)
                x = np.clip(rng.binomial(need, share), np.maximum(need - pool, 0), np.minimum(need, left[:, j]))
            out[:, i, j] = x
            need = need - x
        out[:, i, -1] = need
        left = left - out[:, i]
    out[:, -1] = left
    return out


def monte_carlo(tests: DataFrame, resamples: int = 2000, seed: int = 0) -> DataFrame:
    """(var1, var2, p): the share of tables with these margins that are as far from independence, for rows of ``table_tests``.

    A drawn table needs the margins only, so the cost doesn't depend on the number of rows;
    each task draws up to ``CHUNK`` tables of one pair.
    """
    ends = [min(CHUNK, resamples - lo) for lo in range(0, resamples, CHUNK)]
    parts = F.posexplode(F.array(*[F.lit(e) for e in ends])).alias("part", "times")
    work = tests.select(*PAIR, "chi2", F.col("row_totals.n").alias("r"), F.col("col_totals.n").alias("c"), F.crc32(F.concat_ws("\x1f", *PAIR).cast("binary")).alias("key"), parts).repartition(F.col("key"), F.col("part"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = []
            for t in pdf.itertuples():
                r, c = np.asarray(t.r, np.int64), np.asarray(t.c, np.int64)
                expected = np.outer(r, c) / r.sum()
                x = drawn_tables(r, c, t.times, np.random.default_rng([seed, t.key, t.part]))
                found.append(int((((x - expected) ** 2 / expected).sum((1, 2)) >= t.chi2 - 1e-9).sum()))
            yield pd.DataFrame({"var1": pdf["var1"], "var2": pdf["var2"], "ge": found})

    drawn = work.mapInPandas(run, "var1 string, var2 string, ge bigint")
    return drawn.groupBy(*PAIR).agg(((F.sum("ge") + 1) / (resamples + 1)).alias("p"))


def association_suite(cells: DataFrame, orders: Mapping[str, Sequence[str] | None] | None = None, resamples: int = 2000, min_expected: float = 5, max_low: float = 0.2, seed: int = 0) -> DataFrame:
    """(var1, var2, test, statistic, dof, n, cramers_v, trend_r, p, q, stars, conditions_met, min_expected, share_low) from ``pair_cells``; one family."""
    tests = table_tests(cells, orders, min_expected, max_low)
    drawn = monte_carlo(tests.where("test = 'monte_carlo'"), resamples, seed).withColumnRenamed("p", "_drawn")
    # a function sees null where another test holds
    of = lambda c, *names: F.when(F.col("test").isin(*names), F.col(c))
    fisher, chi2 = fisher_p(*[of(c, "fisher") for c in "abcd"]), chi2_sf(of("statistic", "chi2", "trend"), of("dof", "chi2", "trend"))
    out = tests.join(drawn, list(PAIR), "left").withColumn("p", F.coalesce(fisher, chi2, "_drawn"))
    out = benjamini_hochberg(out, "p").withColumn("stars", stars(F.col("q")))
    return out.select(*PAIR, "test", "statistic", "dof", "n", "cramers_v", "trend_r", "p", "q", "stars", "conditions_met", "min_expected", "share_low")


def strongest(found: DataFrame, q_max: float = 0.05, most: int = 8) -> DataFrame:
    """The significant pairs of least p, at most ``most``."""
    return found.where(F.col("q") <= q_max).orderBy("p", *PAIR).limit(most)


def with_totals(cells: DataFrame) -> DataFrame:
    """(var1, var2, row, col, n): the observed counts with ``Total`` rows and columns, by grouping sets."""
    total = lambda side: F.when(F.grouping(side) == 1, "Total").otherwise(F.col(side)).alias(side)
    sets = [[F.col(v) for v in (*PAIR, *more)] for more in (("row", "col"), ("row",), ("col",), ())]
    out = cells.groupingSets(sets, *PAIR, "row", "col").agg(F.sum("observed").alias("n"), total("row").alias("r"), total("col").alias("c"))
    return out.select(*PAIR, F.col("r").alias("row"), F.col("c").alias("col"), "n")
