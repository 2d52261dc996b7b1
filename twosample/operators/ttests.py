"""t-tests (D4 pooled, D5 Welch, D6 paired) and pair alignment.

Statistics come from one conditional aggregate (counts, means, sample
variances via Spark's central-moment aggregates, never sum(x^2)-n*mean^2);
the two-sided p-value is a pandas UDF over the one-row-per-key result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twosample.functions.pvalues import t_pvalue
from twosample.operators.prepare import nan_if_null
from twosample.operators.summary import moments


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def ratio_t(diff: Column, se: Column) -> Column:
    """``diff / se``; no spread gives a signed infinity (p = 0) for a
    difference that is not zero, and NaN for none."""
    inf = F.lit(float("inf"))
    return nan_if_null(F.when(se == 0, F.when(diff > 0, inf).when(diff < 0, -inf)).otherwise(_div(diff, se)))


def pooled_t(n1, n2, m1, m2, v1, v2) -> tuple[Column, Column]:
    """D4 formula columns: (t, df) with pooled variance."""
    n1d, n2d = n1.cast("double"), n2.cast("double")
    dfree = n1d + n2d - 2.0
    sp2 = _div((n1d - 1.0) * v1 + (n2d - 1.0) * v2, dfree)
    se = F.sqrt(sp2 * (_div(F.lit(1.0), n1d) + _div(F.lit(1.0), n2d)))
    return ratio_t(m1 - m2, se), dfree


def welch_t(n1, n2, m1, m2, v1, v2) -> tuple[Column, Column]:
    """D5 formula columns: (t, Welch-Satterthwaite df, 1 if nothing varies)."""
    n1d, n2d = n1.cast("double"), n2.cast("double")
    a, b = _div(v1, n1d), _div(v2, n2d)
    t = ratio_t(m1 - m2, F.sqrt(a + b))
    dfree = F.when(a + b == 0, F.lit(1.0)).otherwise(_div((a + b) * (a + b), _div(a * a, n1d - 1.0) + _div(b * b, n2d - 1.0)))
    return t, nan_if_null(dfree)


def two_sample_t(frame: DataFrame, keys: Sequence[str], equal_var: bool = True,
                 stats: DataFrame | None = None) -> DataFrame:
    """One row per key with n1, n2, means, variances, t, df, p
    (``stats``: precomputed ``moments`` of ``frame`` to reuse)."""
    m = stats if stats is not None else moments(frame, keys)
    args = [F.col("n1"), F.col("n2"), F.col("mean1"), F.col("mean2"),
            F.col("var1"), F.col("var2")]
    t, dfree = pooled_t(*args) if equal_var else welch_t(*args)
    return (m.withColumn("statistic", t).withColumn("df", dfree)
             .withColumn("p_value", nan_if_null(t_pvalue(F.col("statistic"), F.col("df")))))


def pair_align(frame: DataFrame, keys: Sequence[str], pair_key: str) -> DataFrame:
    """Line up group 1 and group 2 per pair key.

    A canonical frame carrying ``pair_key`` is pivoted with one conditional
    aggregate per ``(keys, pair_key)`` -- a single shuffle with map-side
    combine, no join -- and a key seen more than once in a group contributes
    the mean of its values.  Rows without a pair key match nothing: they are one
    incomplete pair.  Returns ``(keys, pair_key, x, y, complete)``.
    """
    a = frame.groupBy(*keys, pair_key).agg(
        F.avg(F.when(F.col("g") == 1, F.col("v"))).alias("x"),
        F.avg(F.when(F.col("g") == 2, F.col("v"))).alias("y"))
    return a.withColumn("complete", F.col("x").isNotNull() & F.col("y").isNotNull() & F.col(pair_key).isNotNull())


def paired_t(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """T on d = x - y over complete pairs; reports unmatched keys."""
    d = F.when(F.col("complete"), F.col("x") - F.col("y"))
    m = pairs.groupBy(*keys).agg(
        F.count(d).alias("n"),
        F.avg(d).alias("mean_diff"),
        F.var_samp(d).alias("var_diff"),
        F.sum(F.when(~F.col("complete"), 1).otherwise(0)).alias("unmatched"),
        F.avg(F.when(F.col("complete"), F.col("x"))).alias("mean1"),
        F.avg(F.when(F.col("complete"), F.col("y"))).alias("mean2"))
    t = ratio_t(F.col("mean_diff"), F.sqrt(_div(F.col("var_diff"), F.col("n").cast("double"))))
    dfree = (F.col("n") - 1).cast("double")
    return (m.withColumn("statistic", t).withColumn("df", dfree)
             .withColumn("p_value", nan_if_null(t_pvalue(F.col("statistic"), F.col("df")))))


def differences(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Complete pairs as a canonical one-group frame of differences."""
    return pairs.filter(F.col("complete")).select(
        *keys, F.lit(1).cast("tinyint").alias("g"), (F.col("x") - F.col("y")).alias("v"))
