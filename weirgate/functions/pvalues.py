"""Tail probabilities. Inputs are one row per tested column, never data rows."""

from __future__ import annotations

import math
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ks_tail(statistic: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov tail."""
    scale = statistic * F.sqrt(n.cast("double") * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * scale * scale),
    )
    # The series does not converge near zero, where the tail is 1.
    return F.when(scale < 0.2, F.lit(1.0)).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))


@lru_cache(maxsize=100_000)
def ks_paths(gap: int, n: int, m: int) -> float:
    """Share of all orders of ``n`` and ``m`` values whose largest gap reaches ``gap``.

    An order is a lattice path from (0, 0) to (n, m); its gap is the largest |i*m - j*n|.
    Paths that stay below are counted column by column and compared with all paths, in
    whole numbers.
    """
    below = [0] * (m + 1)
    below[0] = 1
    for i in range(n + 1):
        for j in range(m + 1):
            if abs(i * m - j * n) >= gap:
                below[j] = 0
            elif j:
                below[j] += below[j - 1]
    total = math.comb(n + m, n)
    return (total - below[m]) / total


def ks_exact_tail(statistic: Column, n: Column, m: Column, most_cells: int = 10_000) -> Column:
    """Two-sample Kolmogorov-Smirnov tail, exact while ``n * m`` is at most ``most_cells``;
    beyond, where counting paths costs more than it adds, the asymptotic series.

    Without ties the tail is exact; with ties it is an upper bound.
    """

    @F.pandas_udf(T.DoubleType())
    def counted(d: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(
            [None if pd.isna(x) else ks_paths(round(x * k * l), int(k), int(l)) for x, k, l in zip(d, a, b)],
            dtype="float64",
        )

    small = (n > 0) & (m > 0) & (n.cast("double") * m <= most_cells)
    return F.when(small, counted(F.when(small, statistic), n, m)).otherwise(ks_tail(statistic, n, m))


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: power series below a + 1, continued fraction above."""
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > 1e-16 * abs(total):
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    fraction = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or tiny)
        c = b + step / c or tiny
        fraction *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * fraction


@F.pandas_udf(T.DoubleType())
def chi_square_tail(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if pd.isna(x) or pd.isna(k) else 1.0 if k < 1 else _upper_gamma(k / 2.0, x / 2.0)
            for x, k in zip(statistic, freedom)
        ],
        dtype="float64",
    )


@F.pandas_udf(T.DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if pd.isna(v) else math.erfc(abs(v) / math.sqrt(2))).astype("float64")
