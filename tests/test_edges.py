"""Edge fixtures (FIXTURES.md section 4): tiny groups, ties, constants,
null / NaN / infinity, empty groups, unmatched pairs, alpha boundary."""
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from twosample import paired, two_sample
from twosample.functions import special as S
from twosample.operators import chisquare as CS
from twosample.operators.shapiro import shapiro
from twosample.operators.ttests import two_sample_t


def frame(spark, g1, g2=()):
    rows = [(0, 1, float(v)) for v in g1] + [(0, 2, float(v)) for v in g2]
    return spark.createDataFrame(rows, "_all int, g tinyint, v double")


def swilk_reference(x):
    """Plain-Python AS R94 W from the lower-half weights, as published."""
    x = sorted(x)
    n = len(x)
    nn2 = n // 2
    if n == 3:
        a = [math.sqrt(0.5)]
    else:
        m = [-statistics.NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, nn2 + 1)]
        summ2 = 2 * sum(v * v for v in m)
        ssumm2 = math.sqrt(summ2)
        u = 1 / math.sqrt(n)
        poly = lambda c: sum(ci * u ** k for k, ci in enumerate(c))
        a1 = poly(S.SW_C1) + m[0] / ssumm2
        if n > 5:
            a2 = m[1] / ssumm2 + poly(S.SW_C2)
            fac = math.sqrt((summ2 - 2 * m[0] ** 2 - 2 * m[1] ** 2) / (1 - 2 * a1 ** 2 - 2 * a2 ** 2))
            a = [a1, a2] + [v / fac for v in m[2:]]
        else:
            fac = math.sqrt((summ2 - 2 * m[0] ** 2) / (1 - 2 * a1 ** 2))
            a = [a1] + [v / fac for v in m[1:]]
    num = sum(ai * (x[n - 1 - i] - x[i]) for i, ai in enumerate(a))
    mean = sum(x) / n
    return num * num / sum((v - mean) ** 2 for v in x)


@pytest.mark.parametrize("n", [3, 4, 5, 6, 11, 12, 20, 57])
def test_shapiro_w_all_branches(spark, n):
    x = list(np.random.default_rng(n).gamma(2.0, 3.0, n).round(3))
    r = shapiro(frame(spark, x), ["_all", "g"]).collect()[0]
    assert r.sw_w == pytest.approx(swilk_reference(x), rel=1e-9)
    assert 0.0 <= r.sw_p <= 1.0


def test_shapiro_n3_closed_form(spark):
    r = shapiro(frame(spark, [1, 2, 4]), ["_all", "g"]).collect()[0]
    assert r.sw_w == pytest.approx(4.5 / (42 / 9))
    expect = 6 / math.pi * (math.asin(math.sqrt(r.sw_w)) - math.asin(math.sqrt(0.75)))
    assert r.sw_p == pytest.approx(expect)


def test_shapiro_5000_vs_5001(spark):
    rows = shapiro(frame(spark, range(5000), range(5001)), ["_all", "g"]).collect()
    got = {r.g: r.test_used for r in rows}
    assert got == {1: "shapiro-wilk", 2: "skipped_large_sample"}


def test_empty_group_gives_nan(spark):
    r = two_sample_t(frame(spark, [1.0, 2.0, 3.0]), ["_all"]).collect()[0]
    assert r.n2 == 0 and math.isnan(r.statistic) and math.isnan(r.p_value)


def test_single_value_groups(spark):
    r = two_sample_t(frame(spark, [1.0], [2.0]), ["_all"], False).collect()[0]
    assert math.isnan(r.statistic)


def test_all_values_tied_mannwhitney(spark):
    from twosample.operators.mannwhitney import mannwhitney
    r = mannwhitney(frame(spark, [5.0] * 10, [5.0] * 12), ["_all"]).collect()[0]
    assert r.statistic == pytest.approx(60.0) and r.p_value == 1.0


def test_infinity_t_is_nan_and_binning_raises(spark):
    fr = frame(spark, [1.0, float("inf"), 3.0], [1.0, 2.0])
    r = two_sample_t(fr, ["_all"]).collect()[0]
    assert math.isnan(r.statistic)
    with pytest.raises(Exception, match="finite"):
        CS.chisq_binned(fr, ["_all"]).collect()


def test_min_equals_max_binning(spark):
    r = CS.binned_counts(frame(spark, [2.0] * 5, [2.0] * 3), ["_all"]).collect()
    assert len(r) == 1 and (r[0].o1, r[0].o2) == (5, 3)


def test_expected_zero_category(spark):
    schema = "_all int, cat string, observed double, expected double"
    c = spark.createDataFrame([(0, "a", 3.0, 0.0), (0, "b", 5.0, 4.0)], schema)
    r = CS.chisq_gof(c, ["_all"]).collect()[0]
    assert r.statistic == math.inf and r.p_value == 0.0
    c = spark.createDataFrame([(0, "a", 0.0, 0.0), (0, "b", 5.0, 4.0)], schema)
    assert math.isnan(CS.chisq_gof(c, ["_all"]).collect()[0].statistic)


@pytest.mark.parametrize("equal_var", [True, False])
def test_zero_variance_with_different_means_is_infinite(spark, equal_var):
    r = two_sample_t(frame(spark, [3.0] * 4, [5.0] * 4), ["_all"], equal_var).collect()[0]
    assert r.statistic == -math.inf and r.p_value == 0.0


def test_constant_paired_difference(spark):
    df = spark.createDataFrame([(k, g, float(k + (g == "b"))) for k in range(5) for g in "ab"], "k int, grp string, v double")
    r = paired(df, "v", "grp", ("a", "b"), "k", checks=False).collect()[0]
    assert r.statistic == -math.inf and r.p_value == 0.0 and r.significant


def test_levene_without_spread_inside(spark):
    from twosample.operators.levene import levene
    r = levene(frame(spark, [1.0, 3.0], [5.0, 5.0]), ["_all"]).collect()[0]
    assert r.levene_w == math.inf and r.levene_p == 0.0 and r.equal_variance is False


def test_histogram_over_infinity_raises(spark):
    from twosample.operators.distribution import hist_density, kde_curve
    fr = frame(spark, [1.0, float("inf"), 3.0], [1.0, 2.0])
    with pytest.raises(Exception, match="finite"):
        hist_density(fr, ["_all"]).collect()
    assert {r.g for r in kde_curve(fr, ["_all"]).collect()} == {2}


def test_null_pair_keys_match_nothing(spark):
    df = spark.createDataFrame([(None, "a", 100.0), (None, "b", 1.0), (1, "a", 1.0), (1, "b", 2.0), (2, "a", 1.0), (2, "b", 4.0)],
                               "k int, grp string, v double")
    r = paired(df, "v", "grp", ("a", "b"), "k", checks=False, require_complete=False).collect()[0]
    assert r.rows_tested == 4 and r.statistic == pytest.approx(-2.0)
    with pytest.raises(Exception, match="pair keys"):
        paired(df, "v", "grp", ("a", "b"), "k", checks=False, require_complete=True).collect()


def test_null_by_key_is_a_group_like_any_other(spark):
    from twosample.operators import distribution as DI
    from twosample.operators import ranks as RK
    from twosample.operators.levene import levene
    rng = np.random.default_rng(3)
    vals = [(int(g), float(v)) for g, v in zip(rng.integers(1, 3, 60), rng.normal(10, 3, 60).round(2))]
    both = spark.createDataFrame([(k, g, v) for k in (None, "x") for g, v in vals], "st string, g tinyint, v double")
    for op in (lambda f: DI.box_stats(f, ["st"]), lambda f: DI.hist_density(f, ["st"]), lambda f: DI.kde_curve(f, ["st"]),
               lambda f: levene(f, ["st"]), lambda f: CS.chisq_binned(f, ["st"]), lambda f: CS.chisq_auto(f, ["st"]),
               lambda f: RK.midranks(f, ["st"]), lambda f: DI.qq_points(f, ["st"]), lambda f: shapiro(f, ["st", "g"])):
        rows = [r.asDict() for r in op(both).collect()]
        got = {k: sorted(str({c: f"{v:.9g}" if isinstance(v, float) else v for c, v in r.items() if c != "st"})
                         for r in rows if r["st"] == k) for k in (None, "x")}
        assert got[None] and got[None] == got["x"]


def test_quantiles_of_squeezed_groups(spark):
    from twosample.operators.ranks import exact_quantiles
    x = np.random.default_rng(8).lognormal(0, 2, 30_000).round(1)
    r = exact_quantiles(frame(spark, x), ["_all"], [0.0, 0.25, 0.5, 0.999, 1.0], whole_rows=10).collect()[0]
    assert [r.q0, r.q1, r.q2, r.q3, r.q4] == pytest.approx(list(np.quantile(x, [0.0, 0.25, 0.5, 0.999, 1.0])))


def test_shapiro_w_above_the_calibrated_size(spark):
    x = list(np.random.default_rng(5).normal(0, 1, 5200).round(3))
    r = shapiro(frame(spark, x), ["_all", "g"]).collect()[0]
    assert r.sw_w == pytest.approx(swilk_reference(x), rel=1e-9) and r.sw_p is None and r.is_normal


def test_paired_unmatched_keys(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (2, "b", 3.5),
                                (3, "a", 4.0), (4, "b", 9.0), (5, "a", 1.0), (5, "b", 1.4)],
                               "k int, grp string, v double")
    r = paired(df, "v", "grp", ("a", "b"), "k", checks=False, require_complete=False).collect()[0]
    assert (r.n_group1, r.n_group2, r.rows_tested) == (4, 4, 6)
    with pytest.raises(Exception, match="pair keys"):
        paired(df, "v", "grp", ("a", "b"), "k", checks=False, require_complete=True).collect()


def test_null_nan_values_dropped_per_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0),
                                ("b", 2.0), ("b", 4.0), ("b", None)], "grp string, v double")
    r = two_sample(df, "v", "grp", ("a", "b"), checks=False).collect()[0]
    assert (r.n_group1, r.n_group2) == (2, 2) and r.total_rows == 4


def test_level_with_no_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "grp string, v double")
    r = two_sample(df, "v", "grp", ("a", "zzz"), test="welch_ttest").collect()[0]
    assert r.n_group2 == 0 and r.significant is False and "NaN" in r.verdict


def test_alpha_bounds_on_api(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "grp string, v double")
    with pytest.raises(ValueError):
        two_sample(df, "v", "grp", ("a", "b"), alpha=0.2)
    with pytest.raises(ValueError):
        two_sample(df, "v", "grp", ("a", "b"), test="anova")
    with pytest.raises(ValueError):
        two_sample(df, "missing", "grp", ("a", "b"))
