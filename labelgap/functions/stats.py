"""Scalar statistics as Arrow-batched or native expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KS_TERMS = 100


def _ks_exact(d: float, n: int, m: int) -> float:
    """P(D >= d) by the lattice-path recurrence, one anti-diagonal at a time.

    Only cells inside the band ``|i/n - j/m| < d`` are held; a path beyond it has reached the distance, whatever follows. The work is the
    length of the paths times the width of the band, about the root of the sample size where the samples are alike, and the memory one band.
    """
    bound, half = d - 1e-9, (d - 1e-9) * n * m / (n + m)
    low, values = 0, np.ones(1) if bound <= 0 else np.zeros(1)
    for total in range(1, n + m + 1):
        centre = total * n / (n + m)
        first = max(0, total - m, math.floor(centre - half))
        last = min(n, total, math.ceil(centre + half))
        i = np.arange(first, last + 1)
        inside = np.flatnonzero(np.abs(i / n - (total - i) / m) < bound)
        if not len(inside):
            return 1.0
        i = i[inside]
        # The neighbours of cell i are i - 1 and i of the diagonal before; those outside its band count as reached.
        before = np.ones(len(i) + 1)
        start, end = max(low, i[0] - 1), min(low + len(values), i[-1] + 1)
        if start < end:
            before[start - i[0] + 1 : end - i[0] + 1] = values[start - low : end - low]
        values = (before[:-1] * i + before[1:] * (total - i)) / total
        low = int(i[0])
    return float(values[-1])


def ks_two_sample_p(d: float, n: int, m: int) -> float:
    """Two-sided p-value of a two-sample KS statistic, exact; see ``_ks_exact`` for the work it takes."""
    if n == 0 or m == 0 or d is None or math.isnan(d):
        return float("nan")
    return _ks_exact(d, n, m)


def _ks_limit(d: Column, n: Column, m: Column) -> Column:
    """The limiting distribution, with the usual correction for a finite sample."""
    size = F.round(n * m / (n + m))
    plain = F.sqrt(size) * d
    z = plain + 1 / (6 * F.sqrt(size)) + (plain - 1) / (4 * size)
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(_KS_TERMS)), lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2 * k * k * z * z)
    )
    total = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    return F.when(z <= 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * total)))


@F.pandas_udf(T.DoubleType())
def _ks_exact_column(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([ks_two_sample_p(float(a), int(b), int(c)) for a, b, c in zip(d, n, m)], dtype="float64")


KS_METHODS = ("limit", "exact")


def ks_pvalue(d: Column, n: Column, m: Column, method: str = "limit") -> Column:
    """Two-sided p-value: ``limit`` by the limiting distribution, at every size; ``exact`` by counting paths, a row at a time."""
    if method not in KS_METHODS:
        raise ValueError(f"unknown method: {method}")
    return _ks_limit(d, n, m) if method == "limit" else _ks_exact_column(d, n, m)


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation of columns that are present together; null where one is constant.

    ``corr`` itself raises on a constant column when ANSI mode is on.
    """
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function by a rational expression, error below 1e-7."""
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    # fixed values: coefficients of the published approximation
    poly = F.lit(0.0)
    for c in (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592):
        poly = (poly + F.lit(c)) * t
    erf = F.lit(1.0) - poly * F.exp(-x * x)
    return F.when(z >= 0, (F.lit(1.0) + erf) / 2).otherwise((F.lit(1.0) - erf) / 2)


def uniform(row_id: Column, seed: int, stream: int) -> Column:
    """A uniform number in (0, 1) that depends on row id, seed and stream only, not on partitioning."""
    bits = F.shiftrightunsigned(F.xxhash64(row_id, F.lit(seed), F.lit(stream)), 11)
    return (bits + F.lit(0.5)) / F.lit(float(2**53))


def standard_normal(row_id: Column, seed: int, stream: int) -> Column:
    """Box-Muller from two uniform numbers."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(row_id, seed, 2 * stream)))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(row_id, seed, 2 * stream + 1))
