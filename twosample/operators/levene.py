"""Levene's equal-variance check, median-centred (D12), with C3 re-join.

Group medians are exact (``ranks.exact_quantiles``, no single-buffer
percentile), joined back onto the rows on ``(keys, g)`` -- a two-rows-per-key
table, broadcast if the keys are few -- and the one-way ANOVA F on absolute deviations is assembled from
count / mean / sample-variance aggregates.  For two groups F(1, N-2) is the
square of a t with N-2 degrees of freedom, so the p-value reuses the t tail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twosample.functions.pvalues import t_pvalue
from twosample.operators.prepare import assumption_flag, nan_if_null
from twosample.operators.ranks import attach_stats, exact_quantiles, few_keys, null_safe


def group_medians(frame: DataFrame, keys: Sequence[str], parts: int | None = None, small: bool | None = None) -> DataFrame:
    q = exact_quantiles(frame, [*keys, "g"], [0.5], "v", parts, small)
    return q.select(*keys, "g", F.col("q0").alias("median"))


def rejoin_stats(frame: DataFrame, stats: DataFrame, keys: Sequence[str], spread: str = "v",
                 small: bool | None = None) -> DataFrame:
    """Attach per-(key, group) statistics to every row; ``spread`` names a
    near-unique row column that salts the join of many keys."""
    return _rejoin(frame, keys, stats, spread, small)


@null_safe
def _rejoin(frame: DataFrame, keys: Sequence[str], stats: DataFrame, spread: str, small: bool | None) -> DataFrame:
    small = few_keys(frame, keys) if small is None else small
    return attach_stats(frame, stats, [*keys, "g"], spread, small)


@null_safe
def levene(frame: DataFrame, keys: Sequence[str], parts: int | None = None, medians: DataFrame | None = None) -> DataFrame:
    """Exact group medians, then one aggregate of the deviations from them
    over raw rows: counts, means and central second moments.  ``medians`` (keys, g,
    median): those that another operator has found."""
    small = few_keys(frame, keys)
    med = group_medians(frame, keys, parts, small) if medians is None else medians
    z = _rejoin(frame, keys, med, "v", small)
    dev = F.abs(F.col("v") - F.col("median"))
    per_g = z.groupBy(*keys).agg(*[
        a for gi in (1, 2) for d in (F.when(F.col("g") == gi, dev),) for a in (
            F.count(d).alias(f"n{gi}"), F.avg(d).alias(f"z{gi}"),
            (F.var_pop(d) * F.count(d)).alias(f"ss{gi}"))])
    n1 = F.coalesce(F.col("n1"), F.lit(0)).cast("double")
    n2 = F.coalesce(F.col("n2"), F.lit(0)).cast("double")
    n = n1 + n2
    zall = (n1 * F.col("z1") + n2 * F.col("z2")) / n
    between = n1 * (F.col("z1") - zall) ** 2 + n2 * (F.col("z2") - zall) ** 2
    within = F.col("ss1") + F.col("ss2")
    # no spread within the groups: infinite if their deviations differ, else undefined
    w = nan_if_null(F.when((within == 0) & (between > 0), F.lit(float("inf"))).otherwise(
        F.try_divide((n - 2.0) * between, within)))
    out = per_g.withColumn("levene_w", w)
    out = out.withColumn("levene_p", nan_if_null(
        t_pvalue(F.sqrt(F.col("levene_w")), n - 2.0)))
    return out.withColumn("equal_variance", assumption_flag(F.col("levene_p")))
