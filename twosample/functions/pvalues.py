"""p-value pandas UDFs.

Spark SQL has no t, chi-square or normal distribution functions, so the tail
probabilities are computed in Python.  These UDFs are applied *after* the
aggregation that produces one summary row per test (per ``by`` key), so the
Python side sees a handful of rows no matter how large the input is; every
raw-row statistic stays in JVM aggregates.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twosample.functions import special

# Fixed value: the exact Mann-Whitney distribution is used when one group has
# at most this many values and there are no ties, whatever the other's size.
MW_EXACT_MAX_GROUP = 8


def _a(s: pd.Series) -> np.ndarray:
    return pd.to_numeric(s, errors="coerce").to_numpy(dtype=float, na_value=np.nan)


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of a t statistic."""
    return pd.Series(special.t_two_sided(_a(t), _a(df)))


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(x: pd.Series, k: pd.Series) -> pd.Series:
    """Upper-tail p-value of a chi-square statistic with k degrees of freedom."""
    return pd.Series(special.chi2_sf(_a(x), _a(k)))


def mannwhitney_p(u1, n1, n2, tie_term, max_tie) -> np.ndarray:
    """Two-sided Mann-Whitney p-values: exact where one group is small and no
    value is tied, else normal with continuity and tie corrections.  Where all values
    are equal, no U is more extreme, so p is 1."""
    u1, n1, n2, tie_term, max_tie = (np.asarray(v, dtype=float) for v in (u1, n1, n2, tie_term, max_tie))
    ok = ~(np.isnan(u1) | np.isnan(n1) | np.isnan(n2)) & (n1 >= 1) & (n2 >= 1)
    prod, n = n1 * n2, n1 + n2
    u = np.maximum(u1, prod - u1)
    with np.errstate(all="ignore"):
        var = prod / 12.0 * ((n + 1.0) - np.nan_to_num(tie_term) / (n * (n - 1.0)))
        z = (u - prod / 2.0 - 0.5) / np.sqrt(var)
    out = np.where(var > 0, np.minimum(1.0, 2.0 * special.norm_sf(np.where(var > 0, z, 0.0))), 1.0)
    exact = ok & (np.minimum(n1, n2) <= MW_EXACT_MAX_GROUP) & ~(max_tie > 1)
    for k in np.flatnonzero(exact):
        out[k] = min(1.0, 2.0 * special.mannwhitney_exact_sf(u[k], n1[k], n2[k]))
    return np.where(ok, out, np.nan)


@F.pandas_udf(T.DoubleType())
def mannwhitney_pvalue(u1: pd.Series, n1: pd.Series, n2: pd.Series,
                       tie_term: pd.Series, max_tie: pd.Series) -> pd.Series:
    """``mannwhitney_p`` of one row per test."""
    return pd.Series(mannwhitney_p(_a(u1), _a(n1), _a(n2), _a(tie_term), _a(max_tie)))


@F.pandas_udf(T.DoubleType())
def shapiro_pvalue(w: pd.Series, n: pd.Series) -> pd.Series:
    """Royston's p-value for the Shapiro-Wilk W."""
    return pd.Series([special.shapiro_p(a, None if math.isnan(b) else int(b)) for a, b in zip(_a(w), _a(n))],
                     dtype="float64")
