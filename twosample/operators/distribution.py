"""Numbers behind the distribution plots (I1-I6), computed on all rows.

* I1 ``hist_density``: 30 equal-width bins over each group's own range,
  density = count / (n * width); empty bins are emitted too.
* I2 ``kde_curve``: Gaussian kernel density at 300 evenly spaced points from
  the group min to max, Scott bandwidth (sample std * n^(-1/5)), from
  moments per grid cell: no data x grid product is formed.
* I3 ``group_means``.
* I4 ``box_stats``: exact interpolated quartiles (distributed, see
  ``ranks``), whiskers at the furthest data within 1.5 IQR, outlier counts.
* I5 ``qq_points``: every observation against the normal quantile of its
  Filliben plotting position; I6 ``qq_fit``: least-squares line and r.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twosample.functions.bins import bin_edges, bin_index, edge_at, widened_range
from twosample.functions.special import with_norm_ppf
from twosample.operators.ranks import (attach_stats, exact_quantiles, few_keys,
                                       null_safe, observation_ranks)

HIST_BINS = 30
KDE_POINTS = 300
KDE_REACH = 12.0
KDE_CELL = 0.5      # widest cell, in bandwidths
KDE_TERMS = 16      # moments per cell
WHISKER = 1.5


@null_safe
def hist_density(frame: DataFrame, keys: Sequence[str], bins: int = HIST_BINS) -> DataFrame:
    """``(keys, g, bin, left, right, count, density)`` for every bin.
    Raw rows get their group's range (broadcast if the keys are few) and are
    counted per bin before any shuffle; an infinite range is an error."""
    gk, small = [*keys, "g"], few_keys(frame, keys)
    st = frame.groupBy(*gk).agg(F.count("v").alias("n"), F.min("v").alias("lo0"), F.max("v").alias("hi0"))
    finite = (F.abs(F.col("lo0")) < float("inf")) & (F.abs(F.col("hi0")) < float("inf"))
    st = st.withColumn("lo0", F.when(finite, F.col("lo0")).otherwise(
        F.raise_error(F.lit("histogram bins need finite values")).cast("double")))
    lo, hi = widened_range(F.col("lo0"), F.col("hi0"))
    st = (st.withColumn("lo", lo).withColumn("hi", hi).withColumn("k", F.lit(bins))
            .withColumn("edges", bin_edges(F.col("lo"), F.col("hi"), F.col("k"))))
    counts = (attach_stats(frame.select(*gk, "v"), st.select(*gk, "lo", "hi", "k", "edges"), gk, "v", small)
              .withColumn("bin", bin_index(F.col("v"), F.col("edges"), F.col("lo"),
                                           F.col("hi"), F.col("k")))
              .groupBy(*gk, "bin").agg(F.count(F.lit(1)).alias("count")))
    grid = st.select(*gk, "n", "edges", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, [*gk, "bin"], "left").fillna(0, subset=["count"])
    left, right = edge_at(F.col("edges"), F.col("bin")), edge_at(F.col("edges"), F.col("bin") + 1)
    return out.select(*gk, "bin", left.alias("left"), right.alias("right"),
                      F.col("count").cast("long").alias("count"),
                      (F.col("count") / (F.col("n") * (right - left))).alias("density"))


@null_safe
def kde_curve(frame: DataFrame, keys: Sequence[str], points: int = KDE_POINTS) -> DataFrame:
    """``(keys, g, j, x, density)``; groups with fewer than 2 values, zero
    or undefined spread have no curve.

    A value becomes the powers of its distance ``d`` (in bandwidths) from the centre of
    its cell, summed per cell: one row per cell enters the shuffle, whatever the
    bandwidth.  A cell at distance ``z`` from a grid point adds
    ``exp(-z^2/2) * sum(He_p(z) * sum(d^p) / p!)``.  Cells are at most ``KDE_CELL``
    bandwidths wide, so ``|d|`` is at most a quarter and, as ``|He_p(z)| exp(-z^2/2)`` is below
    ``1.1 sqrt(p!)``, the terms left out stay below 6e-17 of the kernel's peak for each
    value.  Cells farther than ``KDE_REACH`` bandwidths (under 1e-31 of the peak) add nothing."""
    gk, small = [*keys, "g"], few_keys(frame, keys)
    st = frame.groupBy(*gk).agg(F.count("v").alias("n"), F.min("v").alias("lo"),
                                F.max("v").alias("hi"), F.stddev_samp("v").alias("sd"))
    st = st.filter((F.col("n") > 1) & (F.col("sd") > 0) & ~F.isnan("sd")).withColumn(
        "h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).withColumn(
        "step", (F.col("hi") - F.col("lo")) / F.lit(float(points - 1)))
    st = st.withColumn("w", F.col("step") / F.ceil(F.col("step") / (F.lit(KDE_CELL) * F.col("h"))))
    rows = attach_stats(frame.select(*gk, "v"), st.select(*gk, "lo", "h", "w"), gk, "v", small)
    rows = rows.withColumn("c", F.rint((F.col("v") - F.col("lo")) / F.col("w")))
    rows = rows.withColumn("d1", (F.col("v") - F.col("lo") - F.col("c") * F.col("w")) / F.col("h"))
    top = 1
    while top < KDE_TERMS - 1:      # powers up to twice as high at a time
        rows = rows.select("*", *[F.expr(f"d{top} * d{p - top} AS d{p}") for p in range(top + 1, min(2 * top, KDE_TERMS - 1) + 1)])
        top = min(2 * top, KDE_TERMS - 1)
    cells = rows.groupBy(*gk, "c", "lo", "h", "w").agg(
        F.expr("double(count(v)) AS m0"), *[F.expr(f"sum(d{p}) AS m{p}") for p in range(1, KDE_TERMS)])
    # the Hermite sum as a polynomial in z; its terms add up to at most exp(|z| / 4) a value
    coefs = [" + ".join(f"m{k + 2 * r} * double({(-1) ** r / (2 ** r * math.factorial(r) * math.factorial(k))!r})"
                        for r in range((KDE_TERMS - 1 - k) // 2 + 1)) + f" AS q{k}" for k in range(KDE_TERMS)]
    cells = cells.select(*gk, "h", (F.col("lo") + F.col("c") * F.col("w")).alias("centre"), *[F.expr(q) for q in coefs])
    at = F.when(F.col("j") == points - 1, F.col("hi")).otherwise(
        F.col("j").cast("double") * F.col("step") + F.col("lo"))
    grid = st.select(*gk, "n", "h", "lo", "hi", "step", F.explode(
        F.sequence(F.lit(0), F.lit(points - 1))).alias("j")).withColumn("x", at)
    reach = F.lit(KDE_REACH) * F.col("h")
    j_lo = F.greatest(F.ceil((F.col("centre") - reach - F.col("lo")) / F.col("step")), F.lit(0))
    j_hi = F.least(F.floor((F.col("centre") + reach - F.col("lo")) / F.col("step")), F.lit(points - 1))
    near = attach_stats(cells, st.select(*gk, "lo", "hi", "step"), gk, "centre", small).withColumn(
        "j_lo", j_lo.cast("int")).withColumn("j_hi", j_hi.cast("int")).filter("j_lo <= j_hi")
    near = near.withColumn("j", F.explode(F.sequence("j_lo", "j_hi"))).withColumn("z", (at - F.col("centre")) / F.col("h"))
    horner = f"q{KDE_TERMS - 1}"
    for k in reversed(range(KDE_TERMS - 1)):
        horner = f"({horner} * z + q{k})"
    dens = near.groupBy(*gk, "j").agg(F.expr(f"sum(exp(-0.5D * z * z) * {horner}) AS _s"))
    return grid.join(dens, [*gk, "j"], "left").select(*gk, "j", "x", (F.greatest(
        F.coalesce("_s", F.lit(0.0)), F.lit(0.0)) / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))


def group_means(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean marker per group."""
    return frame.groupBy(*keys, "g").agg(F.avg("v").alias("mean"), F.count("v").alias("n"))


@null_safe
def box_stats(frame: DataFrame, keys: Sequence[str], whis: float = WHISKER,
              parts: int | None = None) -> DataFrame:
    """I4: ``(keys, g, n, q1, median, q3, iqr, whisker_low, whisker_high,
    n_outliers)``."""
    gk, small = [*keys, "g"], few_keys(frame, keys)
    q = exact_quantiles(frame, gk, [0.25, 0.5, 0.75], "v", parts, small).select(
        *gk, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_f = F.col("q1") - F.lit(whis) * F.col("iqr")
    hi_f = F.col("q3") + F.lit(whis) * F.col("iqr")
    # a value below the lower whisker is exactly a value below the lower
    # fence (the whisker is the smallest value inside it), so one aggregate
    # of raw rows counts outliers and finds both whiskers
    out = attach_stats(frame.select(*gk, "v"), q, gk, "v", small).groupBy(*gk, "n", "q1", "median", "q3", "iqr").agg(
        F.min(F.when(F.col("v") >= lo_f, F.col("v"))).alias("_wl"),
        F.max(F.when(F.col("v") <= hi_f, F.col("v"))).alias("_wh"),
        F.sum(F.when((F.col("v") < lo_f) | (F.col("v") > hi_f), 1).otherwise(0))
        .alias("n_outliers"))
    return out.select(*gk, "n", "q1", "median", "q3", "iqr",
                      F.least(F.coalesce("_wl", "q1"), F.col("q1")).alias("whisker_low"),
                      F.greatest(F.coalesce("_wh", "q3"), F.col("q3")).alias("whisker_high"),
                      F.col("n_outliers").cast("long").alias("n_outliers"))


def filliben(i, n):
    """Filliben's order-statistic medians for the uniform distribution."""
    nd = n.cast("double")
    last = F.pow(F.lit(0.5), F.lit(1.0) / nd)
    return (F.when(i == n, last).when(i == 1, F.lit(1.0) - last)
            .otherwise((i.cast("double") - 0.3175) / (nd + 0.365)))


@null_safe
def qq_points(frame: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """``(keys, g, i, n, theoretical, sample)`` for every observation."""
    r = observation_ranks(frame, [*keys, "g"], "v", parts=parts)
    r = with_norm_ppf(r, filliben(F.col("i"), F.col("n")), "theoretical")
    return r.select(*keys, "g", "i", "n", "theoretical", F.col("v").alias("sample"))


def qq_fit(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Least-squares line of sample on theoretical quantiles, and r."""
    return points.groupBy(*keys, "g").agg(
        F.regr_slope("sample", "theoretical").alias("slope"),
        F.regr_intercept("sample", "theoretical").alias("intercept"),
        F.corr("theoretical", "sample").alias("r"),
        F.count(F.lit(1)).alias("n"))
