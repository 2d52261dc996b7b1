"""Mann-Whitney U (D7) from distributed rank sums.

U1 = R1 - n1(n1+1)/2, where R1 is the sum of group-1 mid-ranks in the pooled
sample (``ranks.rank_sums``: no single-partition window, ties collapsed
before any shuffle of raw rows).  The p-value is two-sided with continuity
and tie corrections, exact for small tie-free groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twosample.functions.pvalues import mannwhitney_pvalue
from twosample.operators.prepare import nan_if_null
from twosample.operators.ranks import rank_sums


def mannwhitney(frame: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    rs = rank_sums(frame, keys, parts)
    n1 = F.col("n1").cast("double")
    u1 = F.col("r1") - n1 * (n1 + 1.0) / 2.0
    out = rs.withColumn("statistic", nan_if_null(u1))
    return out.withColumn("p_value", nan_if_null(mannwhitney_pvalue(
        F.col("statistic"), F.col("n1"), F.col("n2"), F.col("tie_term"), F.col("max_tie"))))
