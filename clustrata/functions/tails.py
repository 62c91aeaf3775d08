"""Tail probabilities in NumPy and plain Python, and Pandas UDFs of them."""

import math

import pandas as pd
from pyspark.sql import functions as F


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi2_tail(x: float, dof: int) -> float:
    """P(X > x) for a chi-square variable: a finite sum for even degrees, with erfc for odd ones."""
    if dof <= 0 or x <= 0:
        return 1.0
    h = x / 2
    if dof % 2 == 0:
        term, total = math.exp(-h) if h < 700 else 0.0, 0.0
        if not term:
            return math.exp(min(0.0, -h + (dof / 2 - 1) * math.log(h) - math.lgamma(dof / 2)))
        for i in range(dof // 2):
            total += term
            term *= h / (i + 1)
        return min(1.0, total)
    total = math.erfc(math.sqrt(h))
    for i in range(1, (dof - 1) // 2 + 1):
        total += math.exp((i - 0.5) * math.log(h) - h - math.lgamma(i + 0.5))
    return min(1.0, total)


def incomplete_beta(x: float, a: float, b: float) -> float:
    """The regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    out = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1 / (1 + even * d or tiny)
        c = 1 + even / c or tiny
        out *= c * d
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + odd * d or tiny)
        c = 1 + odd / c or tiny
        step = c * d
        out *= step
        if abs(step - 1) < 1e-15:
            break
    return front * out


def f_quantile(share: float, a: int, b: int) -> float:
    """The value below which an F variable of a and b degrees lies with that probability."""
    low, high = 0.0, 1.0
    for _ in range(200):
        z = (low + high) / 2
        low, high = (z, high) if incomplete_beta(z, a / 2, b / 2) < share else (low, z)
    return b * z / (a * (1 - z))


def student_two_sided(t: float, dof: float) -> float:
    return incomplete_beta(dof / (dof + t * t), dof / 2, 0.5)


def correlation_p(r: float, n: int) -> float:
    """Two-sided p of a correlation of n pairs."""
    if n < 3:
        return 1.0
    if abs(r) >= 1:
        return 0.0
    return student_two_sided(r * math.sqrt((n - 2) / (1 - r * r)), n - 2)


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Sum of the hypergeometric probabilities up to that of the table."""
    r, s, k, n = a + b, c + d, a + c, a + b + c + d
    if not n:
        return 1.0
    log_choose = lambda m, j: math.lgamma(m + 1) - math.lgamma(j + 1) - math.lgamma(m - j + 1)
    log_p = {x: log_choose(r, x) + log_choose(s, k - x) - log_choose(n, k) for x in range(max(0, k - s), min(r, k) + 1)}
    limit = log_p[a] + math.log1p(1e-7)
    return min(1.0, sum(math.exp(v) for v in log_p.values() if v <= limit))


def mann_whitney_exact(u: float, n: int, m: int) -> float:
    """Two-sided p of the U statistic without ties, from the counts of all orders."""
    counts = [1] + [0] * (n * m)
    for i in range(1, n + 1):  # Gaussian binomial: multiply by (1 - q^(m+i)) and divide by (1 - q^i)
        for k in range(n * m, m + i - 1, -1):
            counts[k] -= counts[k - m - i]
        for k in range(i, n * m + 1):
            counts[k] += counts[k - i]
    top = max(u, n * m - u)
    return min(1.0, 2 * sum(counts[math.ceil(top) :]) / math.comb(n + m, n))


def mann_whitney_normal(u: float, n: int, m: int, ties: float) -> float:
    """Two-sided p with tie and continuity corrections; ties: the sum of t^3 - t."""
    total = n + m
    variance = n * m / 12 * ((total + 1) - ties / (total * (total - 1))) if total > 1 else 0.0
    if variance <= 0:
        return 1.0
    z = (max(u, n * m - u) - n * m / 2 - 0.5) / math.sqrt(variance)
    return min(1.0, 2 * 0.5 * math.erfc(z / math.sqrt(2)))


def mann_whitney_p(u: float, n: int, m: int, ties: float) -> float:
    """Exact if a sample has at most eight values and nothing is tied, else normal."""
    return mann_whitney_exact(u, n, m) if min(n, m) <= 8 and not ties and n * m <= 20_000 else mann_whitney_normal(u, n, m, ties)


def _over(function, *columns: pd.Series) -> pd.Series:
    return pd.Series([None if any(pd.isna(v) for v in row) else function(*row) for row in zip(*columns, strict=True)], dtype="float64")


def _udf(function, *kinds):
    """A Pandas UDF made when it is used, so that workers can import this module."""

    def run(*columns: pd.Series) -> pd.Series:
        return _over(lambda *v: function(*(k(x) for k, x in zip(kinds, v, strict=True))), *columns)

    def one(a: pd.Series) -> pd.Series:
        return run(a)

    def two(a: pd.Series, b: pd.Series) -> pd.Series:
        return run(a, b)

    def four(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return run(a, b, c, d)

    chosen = {1: one, 2: two, 4: four}[len(kinds)]
    return lambda *columns: F.pandas_udf(chosen, "double")(*columns)


chi2_sf = _udf(chi2_tail, float, int)
normal_p = _udf(normal_two_sided, float)
corr_p = _udf(correlation_p, float, int)
fisher_p = _udf(fisher_two_sided, int, int, int, int)
mann_whitney = _udf(mann_whitney_p, float, int, int, float)
