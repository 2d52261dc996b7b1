"""Shapiro-Wilk normality check (D13), Royston's AS R94 weights.

W is computed for every group of three or more values, however large: ranks
come from ``ranks.observation_ranks`` (no window over a group), weights from
the rank through the JVM-side inverse normal, and W needs one aggregate:

    sum(a_i x_(i)) = (sum m_i x_(i) - special terms) / fac + special terms

where only the two outermost weights on each side differ from m_i / fac.
The p-value is calibrated up to ``max_n`` values (5,000 as published); above
it there is none, the flag is true and ``test_used`` says that the test was skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twosample.functions.pvalues import shapiro_pvalue
from twosample.functions.special import SW_C1, SW_C2, shapiro_poly, with_norm_ppf
from twosample.operators.prepare import assumption_flag
from twosample.operators.ranks import null_safe, observation_ranks

MAX_N = 5000    # fixed value: largest group with a calibrated p-value
MIN_N = 3


@null_safe
def shapiro(frame: DataFrame, keys: Sequence[str], max_n: int = MAX_N) -> DataFrame:
    """One row per key of ``frame`` (``keys`` usually include ``g``) with
    ``n, sw_w, sw_p, is_normal, test_used, median``.  ``max_n`` decides the p-value and
    the flag only.  The median is at hand among the ranks, for Levene's check."""
    ranked = with_norm_ppf(observation_ranks(frame, keys), (F.col("i").cast("double") - 0.375)
                           / (F.col("n").cast("double") + 0.25), "m")
    agg = ranked.groupBy(*keys, "n").agg(
        F.sum(F.col("m") * F.col("m")).alias("ss"),
        F.sum(F.col("m") * F.col("v")).alias("smx"),
        F.max(F.when(F.col("i") == 1, F.col("v"))).alias("x1"),
        F.max(F.when(F.col("i") == 2, F.col("v"))).alias("x2"),
        F.max(F.when(F.col("i") == F.col("n") - 1, F.col("v"))).alias("xn1"),
        F.max(F.when(F.col("i") == F.col("n"), F.col("v"))).alias("xn"),
        F.max(F.when(F.col("i") == F.col("n"), F.col("m"))).alias("mn"),
        F.max(F.when(F.col("i") == F.col("n") - 1, F.col("m"))).alias("mn1"),
        F.avg(F.when(F.col("i").between(F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1), F.col("v"))).alias("median"),
        (F.var_pop("v") * F.col("n")).alias("ssq"))
    n = F.col("n")
    # one column per intermediate so the AS241 expression is not re-inlined
    # m_n and m_(n-1) come out of the aggregate, so only arithmetic follows
    agg = agg.withColumn("u", F.lit(1.0) / F.sqrt(n.cast("double")))
    agg = (agg.withColumn("an", F.try_divide(F.col("mn"), F.sqrt("ss")) + shapiro_poly(F.col("u"), SW_C1))
              .withColumn("an1", F.try_divide(F.col("mn1"), F.sqrt("ss")) + shapiro_poly(F.col("u"), SW_C2)))
    mn, mn1, an, an1 = F.col("mn"), F.col("mn1"), F.col("an"), F.col("an1")
    fac = F.when(n > 5, F.sqrt(F.try_divide(F.col("ss") - 2 * mn * mn - 2 * mn1 * mn1,
                                            1 - 2 * an * an - 2 * an1 * an1))
                 ).otherwise(F.sqrt(F.try_divide(F.col("ss") - 2 * mn * mn, 1 - 2 * an * an)))
    agg = agg.withColumn("fac", fac)
    xn, x1, xn1, x2 = F.col("xn"), F.col("x1"), F.col("xn1"), F.col("x2")
    lin6 = (F.try_divide(F.col("smx") - mn * (xn - x1) - mn1 * (xn1 - x2), F.col("fac"))
            + an * (xn - x1) + an1 * (xn1 - x2))
    lin4 = F.try_divide(F.col("smx") - mn * (xn - x1), F.col("fac")) + an * (xn - x1)
    lin3 = F.sqrt(F.lit(0.5)) * (xn - x1)
    agg = agg.withColumn("lin", F.when(n > 5, lin6).when(n > 3, lin4).otherwise(lin3))
    w = F.when(F.col("ssq") <= 0, F.lit(1.0)).otherwise(
        F.least(F.try_divide(F.col("lin") * F.col("lin"), F.col("ssq")), F.lit(1.0)))
    enough = F.col("n") >= MIN_N
    out = agg.select(*keys, "n", "median", F.when(enough, w).alias("sw_w"))
    out = out.withColumn("sw_p", F.when(enough & (F.col("n") <= max_n), F.when(F.col("sw_w") >= 1.0, F.lit(1.0))
                                        .otherwise(shapiro_pvalue(F.col("sw_w"), F.col("n")))))
    used = (F.when(F.col("n") > max_n, F.lit("skipped_large_sample"))
            .when(F.col("n") < MIN_N, F.lit("too_few_rows"))
            .otherwise(F.lit("shapiro-wilk")))
    normal = (F.when(F.col("n") > max_n, F.lit(True))
              .when(F.col("n") < MIN_N, F.lit(None).cast("boolean"))
              .otherwise(assumption_flag(F.col("sw_p"))))
    return out.withColumn("test_used", used).withColumn("is_normal", normal)
