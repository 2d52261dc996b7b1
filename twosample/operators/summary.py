"""Group summaries.

All of these are one partial + final hash aggregate; the two groups are
summarised in the same pass with conditional aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twosample.operators.prepare import ALL_KEY, check_columns, coerce_lenient, constant_key, is_usable
from twosample.operators.ranks import null_safe, values_at

SUMMARY_FIELDS = ("mean", "std", "count", "min", "max")


def group_summary(df: DataFrame, value: str, group: str | None = None,
                  by: Sequence[str] = (), median: str = "approx",
                  accuracy: int = 10000) -> DataFrame:
    """Mean, sample std, count, min, max and median of ``value`` per
    ``by`` (+ ``group``) key.

    ``median="approx"`` is Spark's ``percentile_approx`` (a mergeable sketch
    with rank error about n/accuracy), as in the reference;
    ``median="exact"`` returns the value that sketch aims at -- the lower
    middle element, at 0-based position ceil(n/2) - 1 -- found with the
    distributed position search (no per-group buffer)."""
    keys = list(by or []) + ([group] if group else [])
    check_columns(df, value, *keys)
    v = coerce_lenient(F.col(value))
    data = df.select(*keys, v.alias("v")).filter(is_usable(F.col("v")))
    base = [F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
            F.count("v").alias("count"), F.min("v").alias("min"), F.max("v").alias("max")]
    if median == "approx":
        return data.groupBy(*keys).agg(*base, F.percentile_approx("v", 0.5, accuracy).alias("median"))
    k = keys or [ALL_KEY]
    out = _exact_summary(data if keys else constant_key(data), k, base)
    return out if keys else out.drop(ALL_KEY)


@null_safe
def _exact_summary(data: DataFrame, keys: Sequence[str], base: Sequence[Column]) -> DataFrame:
    lower_middle = (F.ceil(F.col("n") / F.lit(2.0)) - 1).cast("long")
    med = values_at(data, keys, [0.5], [lower_middle]).select(*keys, F.col("_x0").alias("median"))
    return data.groupBy(*keys).agg(*base).join(med, list(keys), "left")


def moments(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D2/D3 core: per key, both groups' count, mean, variance, std, min,
    max and the usable-row total, from a canonical ``(keys, g, v)`` frame."""
    aggs = []
    for gi in (1, 2):
        x = F.when(F.col("g") == gi, F.col("v"))
        aggs += [
            F.count(x).alias(f"n{gi}"),
            F.avg(x).alias(f"mean{gi}"),
            F.var_samp(x).alias(f"var{gi}"),
            F.stddev_samp(x).alias(f"std{gi}"),
            F.min(x).alias(f"min{gi}"),
            F.max(x).alias(f"max{gi}"),
        ]
    return frame.groupBy(*keys).agg(*aggs, F.count("v").alias("total_rows"))


def group_stats_struct() -> F.Column:
    """``struct<group1: summary, group2: summary>`` from ``moments`` columns."""
    def one(gi):
        return F.struct(F.col(f"mean{gi}").alias("mean"), F.col(f"std{gi}").alias("std"),
                        F.col(f"n{gi}").alias("count"), F.col(f"min{gi}").alias("min"),
                        F.col(f"max{gi}").alias("max"))
    return F.struct(one(1).alias("group1"), one(2).alias("group2"))
