"""Tail probabilities of test statistics, for small result tables (a row per column).

Spark SQL has no incomplete gamma function; these helpers run as Pandas UDFs on
tables whose size is the number of columns tested, never on data rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def chi_square_tail(statistic: float, dof: int) -> float:
    """P(X >= statistic) for a chi-square variable, by the finite closed forms.

    Even degrees of freedom give a Poisson sum; odd ones start from erfc.
    """
    if dof <= 0 or math.isnan(statistic):
        return float("nan")
    half = statistic / 2.0
    if half <= 0:
        return 1.0
    if dof % 2 == 0:
        start, powers = 0.0, range(dof // 2)
    else:
        start, powers = math.erfc(math.sqrt(half)), [i + 0.5 for i in range((dof - 1) // 2)]
    log_half = math.log(half)
    return min(1.0, start + sum(math.exp(i * log_half - half - math.lgamma(i + 1)) for i in powers))


def kolmogorov_tail(distance: float, n: float, m: float) -> float:
    """Asymptotic two-sample p-value of the largest distance between two step curves."""
    if math.isnan(distance) or n <= 0 or m <= 0:
        return float("nan")
    scaled = distance * math.sqrt(n * m / (n + m))
    if scaled < 0.2:
        return 1.0
    j = np.arange(1, 101)
    series = 2.0 * np.sum((-1.0) ** (j - 1) * np.exp(-2.0 * (j * scaled) ** 2))
    return float(min(1.0, max(0.0, series)))


def chi_square_p(statistic: Column, dof: Column) -> Column:
    @F.pandas_udf("double")
    def run(s: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(
            [chi_square_tail(float(a), int(b)) if pd.notna(a) else None for a, b in zip(s, d)],
            dtype="float64",
        )

    return run(statistic.cast("double"), dof.cast("int"))


def kolmogorov_p(distance: Column, n: Column, m: Column) -> Column:
    @F.pandas_udf("double")
    def run(s: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([kolmogorov_tail(*row) for row in zip(s, a, b)], dtype="float64")

    return run(distance.cast("double"), n.cast("double"), m.cast("double"))

