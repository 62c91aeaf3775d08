"""Expressions on columns: ranks, false-discovery rates, stars, cleaning, deterministic draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hashed(text: Column) -> Column:
    """A non-negative 60-bit number from MD5: the same in any engine that has MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def finite(x: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(x) & ~x.isin(float("inf"), float("-inf")), x)


def unique_rows(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """df, whose plan fails at the first row that shares its keys with another: rows meet their keys' others once, nothing is scanned twice."""
    first = F.when(F.count("*").over(Window.partitionBy(*keys)) > 1, F.raise_error(F.concat(F.lit(f"{what} occurs more than once: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])))).otherwise(F.lit(True))
    return df.withColumn("_once", first).where("_once").drop("_once")


def finite_or_error(x: Column, what: str) -> Column:
    """The value; evaluating a null, NaN or infinite one fails."""
    bad = x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf"))
    return F.when(bad, F.raise_error(F.lit(f"{what} isn't a finite number")).cast("double")).otherwise(x)


def average_rank(value: str, by: Sequence[str]) -> Column:
    """Rank within groups, ties sharing their mean rank."""
    order = Window.partitionBy(*by).orderBy(value)
    ties = Window.partitionBy(*by, value)
    return F.rank().over(order) + (F.count("*").over(ties) - 1) / 2


def with_ranks(df: DataFrame, value: str, by: Sequence[str], name: str = "rank") -> DataFrame:
    """df with the mean ranks of ``value`` within groups; null values have no rank."""
    return df.withColumn(name, F.when(F.col(value).isNotNull(), average_rank(value, [*by, F.col(value).isNull()])))


def counted_ranks(df: DataFrame, value: str, by: Sequence[str], name: str = "rank") -> DataFrame:
    """As ``with_ranks``, for values that repeat much: only distinct values of a group are ordered, with their counts, and rows look theirs up."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    up_to = F.sum("_n").over(Window.partitionBy(*by).orderBy(value))
    ranks = counted.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col(value).alias("_at"), (up_to - (F.col("_n") - 1) / 2).alias(name))
    same = F.col(value) == F.col("_at")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return df.join(ranks, same, "left").select(*[c for c in df.columns if c != name], name)


def benjamini_hochberg(df: DataFrame, p: str, by: Sequence[str] = (), name: str = "q") -> DataFrame:
    """df with false-discovery rates: null p stay null and don't count in their family."""
    family = [F.col(c) for c in by] + [F.col(p).isNull()]
    up = Window.partitionBy(*family).orderBy(F.asc(p))
    down = Window.partitionBy(*family).orderBy(F.desc(p)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*family)
    # of equal p the last place counts; the running minimum goes over it anyway
    raw = df.withColumn("_raw", F.col(p) * F.count("*").over(whole) / F.row_number().over(up))
    return raw.withColumn(name, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.min("_raw").over(down)))).drop("_raw")


def stars(p: Column) -> Column:
    """Significance marks; empty for null."""
    return F.when(p.isNull(), "").when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("ns")


def safe_name(text: Column) -> Column:
    """A file name: all but letters, digits, dot, dash and underscore become underscores."""
    return F.regexp_replace(text, r"[^A-Za-z0-9_.\-]+", "_")


def contrast_label(tag: Column) -> tuple[Column, Column]:
    """(scheme, label) of tags like ``c1_vs_rest`` and ``c1_vs_c2``."""
    a = F.regexp_extract(tag, r"^c(\d+)_vs_(rest|c\d+)$", 1)
    b = F.regexp_extract(tag, r"^c(\d+)_vs_(rest|c\d+)$", 2)
    scheme = F.when(a == "", F.lit(None)).when(b == "rest", "ova").otherwise("ovo")
    label = F.when(a == "", tag).when(b == "rest", F.concat(F.lit("cluster "), a, F.lit(" vs rest"))).otherwise(F.concat(F.lit("cluster "), a, F.lit(" vs cluster "), F.substring(b, 2, 10)))
    return scheme, label


def variable_kinds(df: DataFrame, columns: Sequence[str], max_levels: int) -> DataFrame:
    """(variable, n_levels, n_values, kind): text and few-valued numbers are categorical; empty columns have no kind."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte", "decimal")}
    one = df.agg(*[F.count_distinct(c).alias(f"d_{i}") for i, c in enumerate(columns)], *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"d_{i}").alias("n_levels"), F.col(f"n_{i}").alias("n_values"), F.lit(c in numeric).alias("numeric")) for i, c in enumerate(columns)])
    out = one.select(F.inline(rows))
    kind = F.when(F.col("n_values") == 0, F.lit(None)).when(~F.col("numeric") | (F.col("n_levels") <= max_levels), "categorical").otherwise("continuous")
    return out.select("variable", "n_levels", "n_values", kind.alias("kind"))
