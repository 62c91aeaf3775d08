"""Associations of categorical variables and of scores with groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import average_rank, benjamini_hochberg, stars, variable_kinds
from ..functions.tails import corr_p, fisher_p, mann_whitney


def contingency(df: DataFrame, row: str, col: str, by: Sequence[str] = ()) -> DataFrame:
    """(by.., row, col, observed, expected, adj_residual): every cell of the levels that occur, empty ones too."""
    by = list(by)
    full = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    return expected_cells(full.groupBy(*by, F.col(row).cast("string").alias("row"), F.col(col).cast("string").alias("col")).agg(F.count("*").alias("observed")), by)


def expected_cells(counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counted cells (by.., row, col, observed) with the empty ones, expected counts and adjusted residuals."""
    by = list(by)
    rows, cols = counted.select(*by, "row").distinct(), counted.select(*by, "col").distinct()
    every = rows.join(cols, by) if by else rows.crossJoin(cols)
    cells = every.join(counted, [*by, "row", "col"], "left").fillna(0, ["observed"])
    n = F.sum("observed").over(Window.partitionBy(*by))
    r, c = F.sum("observed").over(Window.partitionBy(*by, "row")), F.sum("observed").over(Window.partitionBy(*by, "col"))
    cells = cells.withColumn("expected", r * c / n)
    spread = F.col("expected") * (1 - r / n) * (1 - c / n)
    residual = F.when(spread > 0, (F.col("observed") - F.col("expected")) / F.sqrt(F.when(spread > 0, spread))).otherwise(0.0)
    return cells.withColumn("adj_residual", residual)


def contingency_margins(df: DataFrame, row: str, col: str) -> DataFrame:
    """(row, col, n) with ``Total`` rows and columns, by CUBE."""
    plain = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).select(F.col(row).cast("string").alias("row"), F.col(col).cast("string").alias("col"))
    return plain.cube("row", "col").agg(F.count("*").alias("n")).select(F.coalesce("row", F.lit("Total")).alias("row"), F.coalesce("col", F.lit("Total")).alias("col"), "n")


def table_statistics(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by.., n, n_rows, n_cols, chi2, dof, min_expected, share_below_5, conditions_met, cramers_v)."""
    agg = [
        F.sum("observed").alias("n"),
        F.count_distinct("row").alias("n_rows"),
        F.count_distinct("col").alias("n_cols"),
        F.sum(F.when(F.col("expected") > 0, (F.col("observed") - F.col("expected")) ** 2 / F.col("expected")).otherwise(0.0)).alias("chi2"),
        F.min("expected").alias("min_expected"),
        F.avg((F.col("expected") < 5).cast("double")).alias("share_below_5"),
    ]
    out = cells.groupBy(*by).agg(*agg) if by else cells.agg(*agg)
    least = F.least("n_rows", "n_cols") - 1
    return out.withColumns({
        "dof": (F.col("n_rows") - 1) * (F.col("n_cols") - 1),
        "conditions_met": (F.col("min_expected") >= 1) & (F.col("share_below_5") <= 0.2),
        "cramers_v": F.when((F.col("n") > 0) & (least > 0), F.sqrt(F.col("chi2") / (F.col("n") * F.when(least > 0, least)))),
    })


def axis_scores(level: Column, order: Sequence[str] | None) -> Column:
    """Place of a level in an explicit order, from 0; null if there is none."""
    place = F.array_position(F.array(*[F.lit(str(x)) for x in order]), level) - 1 if order else F.lit(None).cast("bigint")
    return F.when(place >= 0, place)


def trend_statistic(cells: DataFrame, u: Column, v: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by.., n, r, m2): linear-by-linear trend of cells with row scores u and column scores v; degenerate axes give 0."""
    w = F.col("observed")
    s = cells.withColumns({"_u": u.cast("double"), "_v": v.cast("double")})
    sums = [F.sum(w).alias("n"), F.sum(w * F.col("_u")).alias("su"), F.sum(w * F.col("_v")).alias("sv"), F.sum(w * F.col("_u") ** 2).alias("suu"), F.sum(w * F.col("_v") ** 2).alias("svv"), F.sum(w * F.col("_u") * F.col("_v")).alias("suv")]
    out = s.groupBy(*by).agg(*sums) if by else s.agg(*sums)
    a = F.col("suu") - F.col("su") ** 2 / F.col("n")
    b = F.col("svv") - F.col("sv") ** 2 / F.col("n")
    r = F.when((a > 1e-12) & (b > 1e-12), (F.col("suv") - F.col("su") * F.col("sv") / F.col("n")) / F.sqrt(F.when((a > 1e-12) & (b > 1e-12), a * b))).otherwise(0.0)
    return out.select(*by, "n", r.alias("r"), ((F.col("n") - 1) * r * r).alias("m2"))


def monte_carlo_chi2(df: DataFrame, row: str, col: str, resamples: int, key: str) -> DataFrame:
    """(chi2, n_ge, resamples, p): permutes ``col`` against ``row`` by hash order of (replicate, key).

    A permuted table needs only its cell counts, so each replicate is one window over the rows
    and an aggregate; the margins, and so the expected counts, don't change.
    """
    spark = df.sparkSession
    plain = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(row).cast("string").alias("row"), F.col(col).cast("string").alias("col"))
    cells = contingency(plain, "row", "col")
    observed = cells.agg(F.sum((F.col("observed") - F.col("expected")) ** 2 / F.col("expected")).alias("chi2"))
    reps = spark.range(resamples).select(F.col("id").cast("int").alias("rep"))
    many = reps.crossJoin(plain)
    by_key = Window.partitionBy("rep").orderBy("key")
    by_hash = Window.partitionBy("rep").orderBy(F.md5(F.concat_ws(":", F.col("rep").cast("string"), "key").cast("binary")), "key")
    rows = many.select("rep", "row", F.row_number().over(by_key).alias("_p"))
    cols = many.select("rep", "col", F.row_number().over(by_hash).alias("_p"))
    counts = rows.join(cols, ["rep", "_p"]).groupBy("rep", "row", "col").agg(F.count("*").alias("o"))
    # sum of o^2 / e over the cells that occur, less n: empty cells add nothing to the first
    each = counts.join(F.broadcast(cells.select("row", "col", "expected")), ["row", "col"]).groupBy("rep").agg((F.sum(F.col("o") ** 2 / F.col("expected")) - F.sum("o")).alias("x"))
    out = each.crossJoin(F.broadcast(observed)).agg(F.first("chi2").alias("chi2"), F.sum((F.col("x") >= F.col("chi2") - 1e-9).cast("bigint")).alias("n_ge"))
    return out.select("chi2", "n_ge", F.lit(resamples).alias("resamples"), ((F.col("n_ge") + 1) / (resamples + 1)).alias("p"))


def fisher_cells(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by.., a, b, c, d, p) of two-by-two tables, levels in order of name."""
    ranked = cells.withColumns({"_r": F.dense_rank().over(Window.partitionBy(*by).orderBy("row")), "_c": F.dense_rank().over(Window.partitionBy(*by).orderBy("col"))})
    at = lambda r, c: F.sum(F.when((F.col("_r") == r) & (F.col("_c") == c), F.col("observed")).otherwise(0))
    aggs = [at(1, 1).alias("a"), at(1, 2).alias("b"), at(2, 1).alias("c"), at(2, 2).alias("d")]
    out = ranked.groupBy(*by).agg(*aggs) if by else ranked.agg(*aggs)
    return out.withColumn("p", fisher_p("a", "b", "c", "d"))


def _long_groups(scores: DataFrame, groups: DataFrame) -> DataFrame:
    """(.., signature, level, score) of the complete rows."""
    return scores.join(groups.where(F.col("level").isNotNull()), "sample").where(F.col("score").isNotNull())


def _u_test(cells: DataFrame, by: Sequence[str], first: Column) -> DataFrame:
    """Rank-sum statistics of the rows where ``first`` holds against the others, in each group."""
    by = list(by)
    ties = Window.partitionBy(*by, "score")
    ranked = cells.withColumns({"_in": first, "_rank": average_rank("score", by), "_t": F.count("*").over(ties)})
    n, m = F.sum(F.col("_in").cast("bigint")), F.sum((~F.col("_in")).cast("bigint"))
    out = ranked.groupBy(*by).agg(
        n.alias("n1"), m.alias("n2"), F.sum(F.when(F.col("_in"), F.col("_rank")).otherwise(0.0)).alias("r1"), F.sum((F.col("_t") * F.col("_t") - 1).cast("double")).alias("ties"),
        F.median(F.when(F.col("_in"), F.col("score"))).alias("median1"), F.median(F.when(~F.col("_in"), F.col("score"))).alias("median2"),
    )
    out = out.withColumn("u", F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2)
    both = (F.col("n1") > 0) & (F.col("n2") > 0)
    return out.withColumns({
        "rank_biserial": F.when(both, 1 - 2 * F.col("u") / F.when(both, F.col("n1") * F.col("n2"))),
        "median_difference": F.col("median1") - F.col("median2"),
    }).drop("r1")


def rank_tests_one_vs_rest(scores: DataFrame, groups: DataFrame, min_group: int = 3) -> DataFrame:
    """(signature, level, n1, n2, u, .., p): each level against all others; null p below ``min_group``.

    scores: (signature, sample, score); groups: (sample, level).
    """
    full = _long_groups(scores, groups)
    levels = full.select("signature", F.col("level").alias("target")).distinct()
    cells = full.join(levels, "signature")
    out = _u_test(cells, ["signature", "target"], F.col("level") == F.col("target")).withColumnRenamed("target", "level")
    ok = (F.col("n1") >= min_group) & (F.col("n2") >= min_group)
    return out.withColumn("p", F.when(ok, mann_whitney("u", "n1", "n2", "ties")))


def rank_tests_pairs(scores: DataFrame, groups: DataFrame, min_group: int = 3) -> DataFrame:
    """(signature, level1, level2, .., p): every two levels; the more frequent is the first."""
    full = _long_groups(scores, groups)
    sizes = full.groupBy("signature", "level").agg(F.count("*").alias("c")).where(F.col("c") >= min_group)
    order = Window.partitionBy("signature").orderBy(F.desc("c"), "level")
    placed = sizes.withColumn("pos", F.row_number().over(order))
    one = placed.select("signature", F.col("level").alias("level1"), F.col("pos").alias("p1"))
    two = placed.select("signature", F.col("level").alias("level2"), F.col("pos").alias("p2"))
    pairs = one.join(two, "signature").where(F.col("p1") < F.col("p2")).drop("p1", "p2")
    cells = full.join(pairs, "signature").where((F.col("level") == F.col("level1")) | (F.col("level") == F.col("level2")))
    out = _u_test(cells, ["signature", "level1", "level2"], F.col("level") == F.col("level1"))
    return out.withColumn("p", mann_whitney("u", "n1", "n2", "ties"))


def continuous_association(scores: DataFrame, values: DataFrame, method: str = "spearman", least: int = 4) -> DataFrame:
    """(signature, n, r, p): correlation of scores with (sample, value), over complete rows."""
    full = scores.join(values, "sample").where(F.col("score").isNotNull() & F.col("value").isNotNull())
    return correlate_groups(full, ["signature"], "score", "value", method).where(F.col("n") >= least).withColumn("p", corr_p("r", "n"))


def correlate_groups(df: DataFrame, by: Sequence[str], x: str, y: str, method: str = "pearson") -> DataFrame:
    """(by.., n, r); r is null where a side doesn't vary. Spearman ranks anew within each group."""
    by = list(by)
    if method == "spearman":
        df = df.withColumns({"_x": average_rank(x, by), "_y": average_rank(y, by)})
        x, y = "_x", "_y"
    means = df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(x).alias("_mx"), F.avg(y).alias("_my"))
    both = df.join(means, by)
    dx, dy = F.col(x) - F.col("_mx"), F.col(y) - F.col("_my")
    sums = both.groupBy(*by).agg(F.first("n").alias("n"), F.sum(dx * dy).alias("sxy"), F.sum(dx * dx).alias("sxx"), F.sum(dy * dy).alias("syy"))
    ok = (F.col("sxx") > 1e-24) & (F.col("syy") > 1e-24)
    return sums.select(*by, "n", F.when(ok, F.greatest(F.least(F.col("sxy") / F.sqrt(F.when(ok, F.col("sxx") * F.col("syy"))), F.lit(1.0)), F.lit(-1.0))).alias("r"))


def associate(scores: DataFrame, metadata: DataFrame, categorical: Sequence[str], continuous: Sequence[str], method: str = "spearman", min_group: int = 3) -> DataFrame:
    """(signature, variable, test, contrast, n, effect, p, q): every score with every variable, one family."""
    parts = []
    for c in categorical:
        groups = metadata.select("sample", F.col(c).cast("string").alias("level"))
        parts.append(rank_tests_pairs(scores, groups, min_group).select("signature", F.lit(c).alias("variable"), F.lit("mann_whitney").alias("test"), F.concat_ws(" vs ", "level1", "level2").alias("contrast"), (F.col("n1") + F.col("n2")).alias("n"), F.col("rank_biserial").alias("effect"), "p"))
    for c in continuous:
        values = metadata.select("sample", F.col(c).cast("double").alias("value"))
        parts.append(continuous_association(scores, values, method).select("signature", F.lit(c).alias("variable"), F.lit(method).alias("test"), F.lit("").alias("contrast"), "n", F.col("r").alias("effect"), "p"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return benjamini_hochberg(out, "p")


def strata_table(partition: DataFrame | None = None, metadata: DataFrame | None = None, variables: Sequence[str] = (), min_group: int = 3) -> DataFrame:
    """(stratification, sample, level): the clusters of every k as ``k<k>``, and each named variable with two levels of ``min_group`` samples or more."""
    parts = []
    if partition is not None:
        parts.append(partition.select(F.concat(F.lit("k"), F.col("k").cast("string")).alias("stratification"), "sample", F.concat(F.lit("C"), F.col("cluster").cast("string")).alias("level")))
    if metadata is not None and variables:
        long = metadata.unpivot("sample", [F.col(v).cast("string").alias(v) for v in variables], "stratification", "level").where("level is not null")
        sizes = long.groupBy("stratification", "level").agg(F.count("*").alias("n")).where(F.col("n") >= min_group)
        usable = sizes.groupBy("stratification").agg(F.count("*").alias("n")).where("n > 1").select("stratification")
        parts.append(long.join(usable, "stratification", "left_semi").select("stratification", "sample", "level"))
    if not parts:
        raise ValueError("there is nothing to stratify by")
    return reduce(DataFrame.unionByName, parts)


def stratified_tests(scores: DataFrame, strata: DataFrame, min_group: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., stratification, kind, signature, contrast, n1, n2, u, effect, p, q, stars) for strata (stratification, sample, level).

    All stratifications are one table and keys of every step. Each level against the rest
    comes from one ranking of a view's samples: a level's U is its rank sum less what it would
    be alone. Every two levels are ranked anew. A family of q-values is one stratification and
    kind of test (of one value of ``keys``, such as a scoring method); p is null below ``min_group``.
    """
    view = [*keys, "stratification", "signature"]
    cells = scores.where(F.col("score").isNotNull()).join(strata.where(F.col("level").isNotNull()), "sample").select(*view, "sample", "level", "score")
    ties = Window.partitionBy(*view, "score")
    ranked = cells.withColumns({"_rank": average_rank("score", view), "_t": F.count("*").over(ties)})
    own = ranked.groupBy(*view, "level").agg(F.count("*").alias("n1"), F.sum("_rank").alias("r"), F.sum((F.col("_t") * F.col("_t") - 1).cast("double")).alias("_ties"))
    whole = Window.partitionBy(*view)
    ova = own.withColumns({"n2": F.sum("n1").over(whole) - F.col("n1"), "ties": F.sum("_ties").over(whole), "u": F.col("r") - F.col("n1") * (F.col("n1") + 1) / 2})
    ova = ova.select(*view, F.lit("ova").alias("kind"), F.concat(F.col("level"), F.lit(" vs rest")).alias("contrast"), "n1", "n2", "u", "ties").where("n2 > 0")
    sizes = own.where(F.col("n1") >= min_group).select(*view, "level", "n1")
    placed = sizes.withColumn("_p", F.row_number().over(whole.orderBy(F.desc("n1"), "level")))
    one, two = (placed.select(*view, F.col("level").alias(f"level{i}"), F.col("_p").alias(f"_p{i}")) for i in (1, 2))
    pairs = one.join(two, view).where("_p1 < _p2").drop("_p1", "_p2")
    met = cells.join(pairs, view).where((F.col("level") == F.col("level1")) | (F.col("level") == F.col("level2")))
    pair = [*view, "level1", "level2"]
    again = met.withColumns({"_rank": average_rank("score", pair), "_t": F.count("*").over(Window.partitionBy(*pair, "score")), "_in": F.col("level") == F.col("level1")})
    sums = again.groupBy(*pair).agg(F.sum(F.col("_in").cast("bigint")).alias("n1"), F.sum((~F.col("_in")).cast("bigint")).alias("n2"), F.sum(F.when(F.col("_in"), F.col("_rank")).otherwise(0.0)).alias("r"), F.sum((F.col("_t") * F.col("_t") - 1).cast("double")).alias("ties"))
    ovo = sums.select(*view, F.lit("ovo").alias("kind"), F.concat_ws(" vs ", "level1", "level2").alias("contrast"), "n1", "n2", (F.col("r") - F.col("n1") * (F.col("n1") + 1) / 2).alias("u"), "ties")
    both = ova.unionByName(ovo)
    ok = (F.col("n1") >= min_group) & (F.col("n2") >= min_group)
    part = lambda c: F.when(ok, F.col(c))  # noqa: E731 - the test sees null where it isn't made
    tested = both.withColumns({"effect": 1 - 2 * F.col("u") / (F.col("n1") * F.col("n2")), "p": mann_whitney(part("u"), part("n1"), part("n2"), part("ties"))})
    out = benjamini_hochberg(tested, "p", [*keys, "stratification", "kind"]).withColumn("stars", stars(F.col("q")))
    return out.select(*keys, "stratification", "kind", "signature", "contrast", "n1", "n2", "u", "effect", "p", "q", "stars")


def assemble_features(metadata: DataFrame | None = None, scores: Mapping[str, DataFrame] | None = None, deconvolution: DataFrame | None = None, extra: DataFrame | None = None, samples: DataFrame | None = None, max_levels: int = 6, extra_prefix: str = "ica") -> DataFrame:
    """(sample, feature, block, family, value): every number known of a sample, one row each; missing ones have no row.

    Families: clinic (columns of the metadata with more than ``max_levels`` numbers), sig (``scores``
    by method, each (signature, sample, score)), deconv (method, cell_type, sample, fraction) and
    extra (sample, feature, value). Only samples of ``samples`` count, if given.
    """
    parts = []

    def add(df: DataFrame, feature: Column, block: Column, family: str, value: str) -> None:
        parts.append(df.select("sample", feature.alias("feature"), block.alias("block"), F.lit(family).alias("family"), F.col(value).cast("double").alias("value")))

    columns = [c for c in metadata.columns if c != "sample"] if metadata is not None else []
    numbers = [r["variable"] for r in variable_kinds(metadata, columns, max_levels).where("kind = 'continuous'").collect()] if columns else []  # one row per column
    if numbers:
        long = metadata.unpivot("sample", [F.col(c).cast("double").alias(c) for c in numbers], "feature", "value")
        add(long, F.concat(F.lit("clinic:"), F.col("feature")), F.lit("clinic"), "clinic", "value")
    for method, df in (scores or {}).items():
        add(df, F.concat(F.lit(f"{method}:"), F.col("signature")), F.lit(f"sig_{method}"), "sig", "score")
    if deconvolution is not None:
        block = F.concat(F.lit("deconv:"), F.col("method"))
        add(deconvolution, F.concat(block, F.lit(":"), F.col("cell_type")), block, "deconv", "fraction")
    if extra is not None:
        add(extra, F.concat(F.lit(f"{extra_prefix}:"), F.col("feature")), F.lit(extra_prefix), "extra", "value")
    if not parts:
        raise ValueError("there is no feature")
    out = reduce(DataFrame.unionByName, parts).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return out if samples is None else out.join(samples.select("sample").distinct(), "sample", "left_semi")


def pairwise_correlations(features: DataFrame, method: str = "spearman", least: int = 8, all_pairs: bool = False) -> DataFrame:
    """(f1, f2, n, r, p, q) of pairs of features over the samples complete in both.

    features: (sample, feature, family, value). By default clinical features pair with all,
    and others only across families.
    """
    one = features.where(F.col("value").isNotNull()).select("sample", F.col("feature").alias("f1"), F.col("family").alias("g1"), F.col("value").alias("x"))
    two = features.where(F.col("value").isNotNull()).select("sample", F.col("feature").alias("f2"), F.col("family").alias("g2"), F.col("value").alias("y"))
    keep = F.lit(True) if all_pairs else (F.col("g1") != F.col("g2")) | (F.col("g1") == "clinic")
    met = one.join(two, "sample").where((F.col("f1") < F.col("f2")) & keep)
    r = correlate_groups(met, ["f1", "f2"], "x", "y", method)
    out = r.where((F.col("n") >= least) & F.col("r").isNotNull()).withColumn("p", corr_p("r", "n"))
    return benjamini_hochberg(out, "p")


def correlation_matrix(pairs: DataFrame, clinical: Sequence[str], most: int = 40, q_max: float = 0.05) -> DataFrame:
    """Derived features x clinical ones: significant features first, then by largest |r|; at most ``most``."""
    a, b = F.col("f1").isin(*clinical), F.col("f2").isin(*clinical)
    rows = pairs.where(a != b).select(F.when(a, F.col("f2")).otherwise(F.col("f1")).alias("feature"), F.when(a, F.col("f1")).otherwise(F.col("f2")).alias("clinical"), "r", "q")
    best = rows.groupBy("feature").agg(F.max(F.abs("r")).alias("m"), F.min("q").alias("q")).orderBy(F.desc(F.col("q") < q_max), F.desc("m"), "feature").limit(most)
    return rows.join(F.broadcast(best.select("feature")), "feature").groupBy("feature").pivot("clinical", list(clinical)).agg(F.first("r"))


