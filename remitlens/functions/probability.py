"""Tail probabilities of test statistics.

Only one aggregated row ever reaches these functions, so they are plain Python behind an Arrow UDF.
"""

from __future__ import annotations

import math
import sys
from itertools import count

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The functions travel with the plan, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def chi2_tail(statistic: float) -> float:
    """Upper tail of the chi-square distribution with one degree of freedom."""
    return math.erfc(math.sqrt(statistic / 2.0))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta integral (modified Lentz evaluation)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in count(1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-15:
            break
    return value


def _log_beta_share(a: float, b: float, x: float) -> float:
    """Log of the regularised incomplete beta function, for x below its mean."""
    front = (
        math.lgamma(a + b)
        - math.lgamma(a)
        - math.lgamma(b)
        + a * math.log(x)
        + b * math.log1p(-x)
        - math.log(a)
    )
    return front + math.log(_beta_fraction(a, b, x))


#: Degrees of freedom from which on the tail is that of a normal deviate.
MANY = 1e5


def _normal_deviate(t: float, df: float) -> float:
    """The normal deviate with the same tail as t, by Hill's expansion; its error falls with the fourth power of df."""
    a = df - 0.5
    b = 48.0 * a * a
    w = math.sqrt(a * math.log1p(t * t / df))
    third = (4 * w**7 + 33 * w**5 + 240 * w**3 + 855 * w) / (10 * b * (b + 0.8 * w**4 + 100))
    return w + (w**3 + 3 * w) / b - third


def student_tail(t: float, df: float) -> float:
    """Upper tail of Student's t; worked in logs, so tiny tails keep their magnitude."""
    if t == 0.0:
        return 0.5
    if df >= MANY:
        tail = 0.5 * math.erfc(_normal_deviate(abs(t), df) / math.sqrt(2.0))
        return tail if t > 0 else 1.0 - tail
    x = df / (df + t * t)
    a, b = df / 2.0, 0.5
    if x < (a + 1.0) / (a + b + 2.0):
        two_sided = math.exp(_log_beta_share(a, b, x))
    else:
        two_sided = 1.0 - math.exp(_log_beta_share(b, a, t * t / (df + t * t)))
    return two_sided / 2.0 if t > 0 else 1.0 - two_sided / 2.0


@F.pandas_udf(T.DoubleType())
def chi2_p_value(statistic: pd.Series) -> pd.Series:
    return statistic.map(chi2_tail, na_action="ignore").astype("float64")


@F.pandas_udf(T.DoubleType())
def student_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    pairs = zip(t, df, strict=True)
    return pd.Series([None if pd.isna(a) or pd.isna(b) else student_tail(a, b) for a, b in pairs], dtype="float64")
