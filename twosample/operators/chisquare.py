"""Chi-square family.

* D8 ``chisq_binned``: two continuous groups share equal-width bins over
  their joint range; 2 x k contingency test on the non-empty bins, Yates
  correction when k = 2.
* D9 ``chisq_gof``: observed vs expected counts per category, expected
  rescaled to the observed total; D10 the same against equal frequencies.
* D11 ``chisq_auto``: D8 if any value is non-integer, else D9 with group-1
  values as observed and group-2 values as expected counts per category.

All per-row work is a bin index or a conditional count; the per-bin /
per-category tables are tiny and finish with windows over the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twosample.functions.bins import (bin_edges, bin_index, n_bins_for,
                                      rescale_expected, widened_range)
from twosample.functions.pvalues import chi2_pvalue
from twosample.operators.prepare import nan_if_null
from twosample.operators.ranks import attach, attach_stats, few_keys, null_safe


@null_safe
def bin_plan(frame: DataFrame, keys: Sequence[str], cap: int = 10) -> DataFrame:
    """H1: per key the joint range, bin count and edge array."""
    st = frame.groupBy(*keys).agg(F.count("v").alias("N"), F.min("v").alias("lo0"), F.max("v").alias("hi0"))
    # Bin edges are undefined over an infinite range
    finite = F.abs(F.col("lo0")) < F.lit(float("inf"))
    finite = finite & (F.abs(F.col("hi0")) < F.lit(float("inf")))
    st = st.withColumn("lo0", F.when(finite, F.col("lo0")).otherwise(
        F.raise_error(F.lit("chi-square binning needs finite values")).cast("double")))
    lo, hi = widened_range(F.col("lo0"), F.col("hi0"))
    st = st.withColumn("lo", lo).withColumn("hi", hi).withColumn("k", n_bins_for(F.col("N"), cap))
    return st.withColumn("edges", bin_edges(F.col("lo"), F.col("hi"), F.col("k"))).drop("lo0", "hi0")


@null_safe
def binned_counts(frame: DataFrame, keys: Sequence[str], cap: int = 10) -> DataFrame:
    """H2/H3: per key and non-empty bin, counts of both groups.  Raw rows get
    their key's plan (broadcast if the keys are few) and are counted per bin
    before any shuffle."""
    b = attach_stats(frame.select(*keys, "g", "v"), bin_plan(frame, keys, cap), keys, "v", few_keys(frame, keys)).withColumn(
        "bin", bin_index(F.col("v"), F.col("edges"), F.col("lo"), F.col("hi"), F.col("k")))
    return b.groupBy(*keys, "bin").agg(
        F.count(F.when(F.col("g") == 1, 1)).alias("o1"),
        F.count(F.when(F.col("g") == 2, 1)).alias("o2"),
        F.first("edges").alias("edges"))


@null_safe
def contingency_2xk(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Chi-square of a 2 x k table given as rows ``(keys, o1, o2, ...)``.

    Row and table totals come from a per-key aggregate attached back to the
    cells (salted on a cell hash), not from a window over the key, so a key
    with millions of categories is not one task."""
    cells = cells.withColumn("_cid", F.xxhash64(*[F.col(c) for c in cells.columns]))
    tot = cells.groupBy(*keys).agg(F.sum("o1").alias("R1"), F.sum("o2").alias("R2"),
                                   F.count(F.lit(1)).alias("K"))
    c = attach(cells, tot, keys, "_cid", "inner")
    col = (F.col("o1") + F.col("o2")).cast("double")
    n = (F.col("R1") + F.col("R2")).cast("double")
    e1 = F.try_divide(F.col("R1").cast("double") * col, n)
    e2 = F.try_divide(F.col("R2").cast("double") * col, n)

    def term(o, e):
        diff = e - o.cast("double")
        # Yates: move each count toward its expectation by at most 0.5 (k = 2)
        adj = F.when(F.col("K") == 2, F.signum(diff) * F.least(F.lit(0.5), F.abs(diff))) \
               .otherwise(F.lit(0.0))
        return F.try_divide((o.cast("double") + adj - e) ** 2, e)
    c = c.withColumn("_term", term(F.col("o1"), e1) + term(F.col("o2"), e2))
    out = c.groupBy(*keys).agg(F.sum("_term").alias("_stat"), F.first("K").alias("k"),
                               F.first("R1").alias("n1"), F.first("R2").alias("n2"))
    stat = F.when(F.col("k") <= 1, F.lit(0.0)).otherwise(nan_if_null(F.col("_stat")))
    out = out.withColumn("statistic", stat).withColumn("df", (F.col("k") - 1).cast("double"))
    p = F.when(F.col("k") <= 1, F.lit(1.0)).otherwise(
        nan_if_null(chi2_pvalue(F.col("statistic"), F.col("df"))))
    return out.withColumn("p_value", p).drop("_stat")


def chisq_binned(frame: DataFrame, keys: Sequence[str], cap: int = 10) -> DataFrame:
    """One row per key; ``n_total`` counts both groups."""
    res = contingency_2xk(binned_counts(frame, keys, cap), keys)
    return res.withColumn("n_total", F.col("n1") + F.col("n2"))


def category_counts(frame: DataFrame, keys: Sequence[str], category: str,
                    weight: str | None = None, aligned: bool = False) -> DataFrame:
    """Per (key, category): ``observed`` from group 1, ``expected`` from group 2
    (row counts, or sums of ``weight`` when given).  ``aligned``: every category must
    have one row of each group, as positions of two vectors of equal length have (B5)."""
    w = F.col(weight) if weight else F.lit(1.0)
    out = frame.groupBy(*keys, category).agg(
        F.sum(F.when(F.col("g") == 1, w).otherwise(F.lit(0.0))).alias("observed"),
        F.sum(F.when(F.col("g") == 2, w).otherwise(F.lit(0.0))).alias("expected"),
        F.count(F.when(F.col("g") == 1, 1)).alias("_n1"), F.count(F.when(F.col("g") == 2, 1)).alias("_n2"))
    if aligned:
        uneven = F.concat(F.lit("chi-square by position needs two vectors of equal length: position "),
                          F.coalesce(F.col(category).cast("string"), F.lit("null")), F.lit(" is not one of each"))
        out = out.withColumn("observed", F.when((F.col("_n1") == 1) & (F.col("_n2") == 1), F.col("observed")).otherwise(
            F.raise_error(uneven).cast("double")))
    return out.drop("_n1", "_n2")


@null_safe
def chisq_gof(counts: DataFrame, keys: Sequence[str], observed: str = "observed",
              expected: str | None = "expected") -> DataFrame:
    """D9 (``expected`` given, H4 rescale) / D10 (uniform): one row per key."""
    o = F.col(observed).cast("double")
    # per-key totals by aggregate + salted attach (no window over the key)
    counts = counts.withColumn("_cid", F.xxhash64(*[F.col(c) for c in counts.columns]))
    tot_cols = [F.sum(o).alias("_osum"), F.count(F.lit(1)).alias("_k")]
    if expected is not None:
        tot_cols.append(F.sum(F.col(expected).cast("double")).alias("_esum"))
    c = attach(counts, counts.groupBy(*keys).agg(*tot_cols), keys, "_cid", "inner")
    if expected is None:
        e = F.col("_osum") / F.col("_k").cast("double")
    else:
        e = rescale_expected(F.col(expected).cast("double"), F.col("_osum"), F.col("_esum"))
    c = c.withColumn("_e", e).withColumn(
        "_term", F.when((F.col("_e") == 0) & (o != 0), F.lit(float("inf"))).otherwise(
            F.try_divide((o - F.col("_e")) ** 2, F.col("_e"))))
    out = c.groupBy(*keys).agg(
        F.sum("_term").alias("_stat"), F.first("_k").alias("k"),
        F.first("_osum").alias("_osum"), F.count("_term").alias("_defined"))
    # nothing observed where nothing is expected is undefined (0 / 0)
    stat = F.when(F.col("_defined") < F.col("k"), F.lit(float("nan"))).otherwise(
        nan_if_null(F.col("_stat")))
    out = (out.withColumn("statistic", stat)
              .withColumn("df", (F.col("k") - 1).cast("double"))
              .withColumn("n_total", F.col("_osum").cast("long")))
    out = out.withColumn("p_value", F.when(F.col("k") <= 1, F.lit(float("nan"))).otherwise(
        nan_if_null(chi2_pvalue(F.col("statistic"), F.col("df")))))
    return out.drop("_stat", "_osum", "_defined")


@null_safe
def rescaled_counts(counts: DataFrame, keys: Sequence[str], observed: str = "observed",
                    expected: str = "expected") -> DataFrame:
    """H4 as a table: each category's expected count scaled to the observed
    total of its key (totals by aggregate + salted attach)."""
    counts = counts.withColumn("_cid", F.xxhash64(*[F.col(c) for c in counts.columns]))
    tot = counts.groupBy(*keys).agg(F.sum(F.col(observed).cast("double")).alias("_osum"),
                                    F.sum(F.col(expected).cast("double")).alias("_esum"))
    c = attach(counts, tot, keys, "_cid", "inner")
    return c.withColumn("expected_scaled", rescale_expected(
        F.col(expected).cast("double"), F.col("_osum"), F.col("_esum"))).drop(
        "_cid", "_osum", "_esum")


def has_fraction(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D11 flag per key: any value with a fractional part."""
    return frame.groupBy(*keys).agg(
        F.bool_or(F.pmod(F.col("v"), F.lit(1.0)) != 0).alias("non_integer"))


@null_safe
def chisq_auto(frame: DataFrame, keys: Sequence[str], category: str | None = None,
               cap: int = 10, aligned: bool = False) -> DataFrame:
    """The binned contingency test for keys with a value that is not
    whole; else a fit test of group 1 to group 2 by ``category``, or, without one,
    a contingency table of the whole values.  Each key's rows go to its own
    variant only; ``variant`` names it.  ``aligned``: the category is a position, so
    values are counts, observed[i] against expected[i], and lengths must agree."""
    flag = has_fraction(frame, keys)
    routed = attach_stats(frame, flag, keys, "v", few_keys(frame, keys))
    binned = chisq_binned(routed.filter("non_integer"), keys, cap).select(
        *keys, "statistic", "df", "p_value", "n_total", F.lit("binned").alias("variant"))
    whole = routed.filter("not non_integer")
    if category is None:
        # integer data without a category key: the values themselves are the
        # categories of a 2 x k contingency table
        cells = whole.groupBy(*keys, "v").agg(
            F.count(F.when(F.col("g") == 1, 1)).alias("o1"),
            F.count(F.when(F.col("g") == 2, 1)).alias("o2"))
        ints = contingency_2xk(cells, keys).withColumn("n_total", F.col("n1") + F.col("n2"))
        ints = ints.select(*keys, "statistic", "df", "p_value", "n_total",
                           F.lit("contingency").alias("variant"))
    else:
        ints = chisq_gof(category_counts(whole, keys, category, weight="v", aligned=aligned), keys).select(
            *keys, "statistic", "df", "p_value", "n_total", F.lit("goodness_of_fit").alias("variant"))
    return binned.unionByName(ints)
