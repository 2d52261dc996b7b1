"""Public test API and the full result row (D14 dispatcher, D15, H9).

``run_test`` (and the three entry points under it) return one lazy DataFrame
with one row per ``by`` key: the core statistic, the group summaries and the assumption
checks are small per-key tables merged on the keys, and Catalyst plans the whole thing
at once.  With ``by`` keys an operator may count them first, to know whether a
per-key table can be broadcast; no other job runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twosample.functions import text as T
from twosample.operators import chisquare as CS
from twosample.operators.levene import levene
from twosample.operators.mannwhitney import mannwhitney
from twosample.operators.prepare import (ALL_KEY, check_alpha, check_test_name, constant_key,
                                         drop_internal, keys_for, prepare,
                                         significance_flag)
from twosample.operators.sampling import sample_groups
from twosample.operators.shapiro import MAX_N, shapiro
from twosample.operators.summary import group_stats_struct, moments
from twosample.operators.ttests import (differences, pair_align, paired_t,
                                        two_sample_t)

NORMALITY_TYPE = ("struct<is_normal:boolean,statistic:double,p_value:double,"
                  "test_used:string,interpretation:string>")
VARIANCE_TYPE = ("struct<equal_variance:boolean,statistic:double,p_value:double,"
                 "interpretation:string>")


def _null_normality() -> Column:
    return F.lit(None).cast(NORMALITY_TYPE)


def _null_variance() -> Column:
    return F.lit(None).cast(VARIANCE_TYPE)


def combine(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Merge one-row-per-key tables into one row per key.

    A union followed by a grouped ``first(ignorenulls)`` instead of a chain
    of joins: every column is non-null in exactly one input, the shuffle
    carries a few rows per key, and no join (hence no cross join when the
    key is a folded constant) appears in the plan.
    """
    u = tables[0]
    for t in tables[1:]:
        u = u.unionByName(t, allowMissingColumns=True)
    seen, cols = set(keys), []
    for t in tables:
        for c in t.columns:
            if c not in seen:
                seen.add(c)
                cols.append(c)
    return u.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def normality_by_group(frame: DataFrame, keys: Sequence[str], max_n: int = MAX_N) -> DataFrame:
    """Shapiro-Wilk per group, pivoted to ``normality_group1/2`` structs."""
    return _normality(shapiro(frame, [*keys, "g"], max_n), keys, max_n)


def _normality(sw: DataFrame, keys: Sequence[str], max_n: int) -> DataFrame:
    sw = sw.withColumn("check", F.struct(
        F.col("is_normal"), F.col("sw_w").alias("statistic"), F.col("sw_p").alias("p_value"),
        F.col("test_used"),
        T.normality_text(F.col("test_used"), F.col("sw_w"), F.col("sw_p"),
                         F.col("is_normal"), F.col("n"), max_n).alias("interpretation")))
    return sw.groupBy(*keys).agg(
        F.max(F.when(F.col("g") == 1, F.col("check"))).alias("normality_group1"),
        F.max(F.when(F.col("g") == 2, F.col("check"))).alias("normality_group2"))


def variance_check(frame: DataFrame, keys: Sequence[str], medians: DataFrame | None = None) -> DataFrame:
    lv = levene(frame, keys, medians=medians)
    return lv.select(*keys, F.struct(
        F.col("equal_variance"), F.col("levene_w").alias("statistic"),
        F.col("levene_p").alias("p_value"),
        T.variance_text(F.col("levene_w"), F.col("levene_p"), F.col("equal_variance"))
        .alias("interpretation")).alias("equal_variance"))


def recommendation(test: str) -> Column:
    """H9: first matching rule wins."""
    n1 = F.col("assumption_checks.normality_group1.is_normal")
    n2 = F.col("assumption_checks.normality_group2.is_normal")
    eq = F.col("assumption_checks.equal_variance.equal_variance")
    non_normal = (n1 == F.lit(False)) | (n2 == F.lit(False))
    if test == "independent_ttest":
        return (F.when(non_normal, F.lit(T.REC_NON_NORMAL))
                .when(eq == F.lit(False), F.lit(T.REC_UNEQUAL_VAR)))
    if test == "welch_ttest":
        return F.when(non_normal, F.lit(T.REC_NON_NORMAL))
    if test == "paired_ttest":
        nd = F.col("assumption_checks.normality_of_differences.is_normal")
        return F.when(nd == F.lit(False), F.lit(T.REC_PAIRED_NON_NORMAL))
    return F.lit(None).cast("string")


def _finish(core: DataFrame, test: str, alpha: float, by: Sequence[str],
            n1: Column, n2: Column, rows_tested: Column, levels: Sequence = (None, None)) -> DataFrame:
    if "variant" not in core.columns:
        core = core.withColumn("variant", F.lit(None).cast("string"))
    for i, level in enumerate(levels, 1):
        core = core.withColumn(f"level{i}", F.lit(None if level is None else str(level)).cast("string"))
    sig = significance_flag(F.col("p_value"), alpha)
    out = (core.withColumn("test_name", F.lit(test))
               .withColumn("alpha", F.lit(float(alpha)))
               .withColumn("significant", sig)
               .withColumn("n_group1", n1.cast("long"))
               .withColumn("n_group2", n2.cast("long"))
               .withColumn("rows_tested", rows_tested.cast("long")))
    out = (out.withColumn("verdict", T.verdict_text(F.col("significant"), F.col("p_value"),
                                                    F.col("alpha")))
              .withColumn("interpretation", T.interpretation_text(
                  F.col("test_name"), (F.col("rows_tested") / 2 if test == "paired_ttest" else F.col("n_group1")),
                  F.col("n_group2"), F.col("significant")))
              .withColumn("recommendation", recommendation(test))
              .withColumn("headline", T.headline_text(F.col("significant"), F.col("test_name"),
                                                      F.col("p_value")))
              .withColumn("coverage_note", T.coverage_note(F.col("total_rows"),
                                                           F.col("rows_tested"))))
    cols = [*list(by), "test_name", "statistic", "df", "p_value", "significant", "alpha",
            "verdict", "interpretation", "recommendation", "assumption_checks",
            "n_group1", "n_group2", "group_stats", "total_rows", "rows_tested",
            "headline", "coverage_note", "level1", "level2", "variant"]
    return out.select(*cols)


def two_sample(df: DataFrame, value: str, group: str, levels: Sequence,
               test: str = "independent_ttest", alpha: float = 0.05,
               by: Sequence[str] = (), checks: bool = True, strict: bool = False,
               sample_rows: int | None = None, row_key: Sequence[str] | None = None,
               seed: int = 42, category: str | None = None,
               bounded_alpha: bool = True, position: str | None = None,
               max_n: int = MAX_N) -> DataFrame:
    """Independent-sample tests (pooled t, Welch t, Mann-Whitney, chi-square)
    of ``value`` between the two ``levels`` of ``group``, per ``by`` key.

    ``position`` (chi-square) takes whole values as counts: those of the first
    level are fitted to those of the second at the same position.  ``max_n`` is the largest
    group whose Shapiro-Wilk W gets a p-value."""
    check_test_name(test)
    if position is not None:
        if test != "chisquare" or category is not None:
            raise ValueError("position is for a chi-square test without a category")
        category = position
    alpha = check_alpha(alpha, bounded_alpha)
    if test == "paired_ttest":
        raise ValueError("paired_ttest needs a pair key: use paired(...)")
    by = list(by or [])
    keys = keys_for(by)
    keep = [c for c in ([category] if category else []) + list(row_key or [])]
    full = prepare(df, value, group, levels, by, strict, keep=keep)
    frame = sample_groups(full, keys, sample_rows, row_key, seed) if sample_rows else full
    # one aggregate of all rows gives counts, group summaries and the total;
    # a sampled test gets its own moments from the sample
    m = moments(full, keys).withColumn("group_stats", group_stats_struct())
    sampled = moments(frame, keys) if sample_rows else m
    if test in ("independent_ttest", "welch_ttest"):
        core = two_sample_t(frame, keys, equal_var=(test == "independent_ttest"), stats=sampled).select(
            *keys, "statistic", "df", "p_value", (F.col("n1") + F.col("n2")).alias("n_tested"),
            *([] if sample_rows else ["n1", "n2", "group_stats", "total_rows"]))
    elif test == "mannwhitney":
        core = mannwhitney(frame, keys).select(
            *keys, "statistic", F.lit(None).cast("double").alias("df"), "p_value", (F.col("n1") + F.col("n2")).alias("n_tested"))
    else:
        core = CS.chisq_auto(frame, keys, category, aligned=position is not None).select(
            *keys, "statistic", "df", "p_value", F.col("n_total").alias("n_tested"), "variant")
    # a t-test of all rows has the counts and summaries at hand: one read
    out = core if "group_stats" in core.columns else combine([core, m.select(*keys, "n1", "n2", "group_stats", "total_rows")], keys)
    if checks and test in ("independent_ttest", "welch_ttest"):
        # one rank table gives W and the medians that Levene's check starts from
        sw = shapiro(frame, [*keys, "g"], max_n)
        out = combine([out, _normality(sw, keys, max_n), variance_check(frame, keys, sw.select(*keys, "g", "median"))], keys)
        out = out.withColumn("assumption_checks", F.struct(
            F.col("normality_group1"), F.col("normality_group2"), F.col("equal_variance"),
            _null_normality().alias("normality_of_differences")))
    else:
        out = out.withColumn("assumption_checks", F.struct(
            _null_normality().alias("normality_group1"), _null_normality().alias("normality_group2"),
            _null_variance().alias("equal_variance"),
            _null_normality().alias("normality_of_differences")))
    if test == "chisquare":
        n1, n2 = F.col("n_tested"), F.lit(None)
    else:
        n1, n2 = F.col("n1"), F.col("n2")
    res = _finish(out, test, alpha, by, n1, n2, F.col("n_tested"), levels)
    return drop_internal(res, by)


def paired(df: DataFrame, value: str, group: str, levels: Sequence, pair_key: str,
           alpha: float = 0.05, by: Sequence[str] = (), checks: bool = True,
           strict: bool = False, sample_rows: int | None = None, seed: int = 42,
           bounded_alpha: bool = True, require_complete: bool = True, max_n: int = MAX_N) -> DataFrame:
    """Paired t-test: observation of group 1 and group 2 matched on
    ``pair_key`` (C1), which may be a position (``with_positions``, inline arrays), per
    ``by`` key; whole pairs are sampled when ``sample_rows`` is set.  An unmatched key
    is a query error (B5), as groups of unequal length are; with
    ``require_complete=False`` incomplete pairs are left out."""
    alpha = check_alpha(alpha, bounded_alpha)
    by = list(by or [])
    keys = keys_for(by)
    frame = prepare(df, value, group, levels, by, strict, keep=[pair_key])
    pairs = pair_align(frame, keys, pair_key)
    m = moments(frame, keys).withColumn("group_stats", group_stats_struct())
    if sample_rows:
        whole = pairs.filter("complete").withColumns({"g": F.lit(1).cast("tinyint"), "v": F.col("x")})
        sampled = sample_groups(whole, keys, sample_rows, [pair_key], seed).drop("g", "v")
        core = combine([paired_t(sampled, keys).drop("unmatched"), paired_t(pairs, keys).select(*keys, "unmatched")], keys)
        pairs = sampled
    else:
        core = paired_t(pairs, keys)
    if require_complete:
        # counted by the aggregate of the test itself; a filter, which no column pruning drops
        text = F.concat(F.lit("paired test: "), F.col("unmatched").cast("string"), F.lit(" pair keys lack one of the two groups"))
        core = core.filter(F.when(F.col("unmatched") > 0, F.raise_error(text).cast("boolean")).otherwise(F.lit(True)))
    core = core.select(*keys, "statistic", "df", "p_value", "n")
    out = combine([core, m.select(*keys, "n1", "n2", "group_stats", "total_rows")], keys)
    if checks:
        sw = normality_by_group(differences(pairs, keys), keys, max_n).select(
            *keys, F.col("normality_group1").alias("nd"))
        out = combine([out, sw], keys).withColumn("assumption_checks", F.struct(
            _null_normality().alias("normality_group1"), _null_normality().alias("normality_group2"),
            _null_variance().alias("equal_variance"), F.col("nd").alias("normality_of_differences")))
    else:
        out = out.withColumn("assumption_checks", F.struct(
            _null_normality().alias("normality_group1"), _null_normality().alias("normality_group2"),
            _null_variance().alias("equal_variance"),
            _null_normality().alias("normality_of_differences")))
    res = _finish(out, "paired_ttest", alpha, by, F.col("n1"), F.col("n2"), F.col("n") * 2, levels)
    return drop_internal(res, by)


def chisquare_counts(counts: DataFrame, observed: str, expected: str | None = None,
                     alpha: float = 0.05, by: Sequence[str] = (),
                     bounded_alpha: bool = True) -> DataFrame:
    """Chi-square goodness of fit on a table of counts, one row per category
    (D9 with ``expected``, D10 without), per ``by`` key."""
    alpha = check_alpha(alpha, bounded_alpha)
    by = list(by or [])
    keys = keys_for(by)
    c = counts if by else constant_key(counts)
    core = CS.chisq_gof(c, keys, observed, expected).withColumn("variant", F.lit("uniform" if expected is None else "goodness_of_fit"))
    out = core.withColumn("total_rows", F.col("n_total")).withColumn(
        "group_stats", F.lit(None).cast(
            "struct<group1:struct<mean:double,std:double,count:bigint,min:double,max:double>,"
            "group2:struct<mean:double,std:double,count:bigint,min:double,max:double>>"))
    out = out.withColumn("assumption_checks", F.struct(
        _null_normality().alias("normality_group1"), _null_normality().alias("normality_group2"),
        _null_variance().alias("equal_variance"), _null_normality().alias("normality_of_differences")))
    res = _finish(out, "chisquare", alpha, by, F.col("n_total"), F.lit(None), F.col("n_total"))
    return drop_internal(res, by)


def run_test(df: DataFrame, test: str, value: str, group: str | None = None, levels: Sequence | None = None,
             alpha: float = 0.05, by: Sequence[str] = (), pair_key: str | None = None,
             **kw) -> DataFrame:
    """Dispatch on the test name; unknown names are an argument error.
    A chi-square test without a second group (no ``group``) takes ``value`` as
    observed counts, one row per category, against equal frequencies (D10)."""
    check_test_name(test)
    if test == "chisquare" and group is None:
        return chisquare_counts(df, value, alpha=alpha, by=by, **kw)
    if group is None or levels is None:
        raise ValueError(f"{test} needs a group column and its two levels")
    if test == "paired_ttest":
        if pair_key is None:
            raise ValueError("paired_ttest needs pair_key")
        return paired(df, value, group, levels, pair_key, alpha=alpha, by=by, **kw)
    return two_sample(df, value, group, levels, test=test, alpha=alpha, by=by, **kw)
