"""Registered queries over the driver tables, each with a DuckDB twin.

Every query reads whole tables (no row caps, id subsets or samples beyond
the sampling operator itself) and returns flat, rounded columns so the two
engines can be compared value by value.  Statistics and p-values are rounded
to 6 decimals on both sides, means/std to 4, densities to 12.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twosample.functions import text as T
from twosample.operators import chisquare as CS
from twosample.operators import distribution as DI
from twosample.operators import ranks as RK
from twosample.operators.levene import group_medians, levene, rejoin_stats
from twosample.operators.mannwhitney import mannwhitney
from twosample.operators.prepare import constant_key, prepare, stack_groups
from twosample.operators.sampling import head_cap, limit_rows
from twosample.operators.shapiro import shapiro
from twosample.operators.summary import group_summary, moments
from twosample.operators.ttests import pair_align
from twosample.plans import oracle as O
from twosample.plans.dispatch import paired, run_test, two_sample
from twosample.sources.readers import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r(c, d=6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def _t(spark, d, name):
    return read_table(spark, d, name)


def _g():
    """Group label as INT in query outputs (the SQL twins produce INTEGER)."""
    return F.col("g").cast("int").alias("g")


# --------------------------------------------------------------------------
# SQL building blocks
# --------------------------------------------------------------------------
def frame_sql(table: str, value: str, group: str | None, l1=None, l2=None,
              by: tuple = (), extra: tuple = ()) -> str:
    keys = ", ".join(list(by) + list(extra)) + (", " if by or extra else "")
    if group is None:
        g, where = "1", "TRUE"
    else:
        g = f"CASE WHEN {group} = {l1} THEN 1 ELSE 2 END"
        where = f"{group} IN ({l1}, {l2})"
    return (f"SELECT {keys}{'' if by else '0 AS _all, '}{g} AS g, CAST({value} AS DOUBLE) AS v "
            f"FROM {table} WHERE {where} AND {value} IS NOT NULL AND NOT isnan(CAST({value} AS DOUBLE))")


def keys_sql(by: tuple) -> str:
    return ", ".join(by) if by else "_all"


def moments_sql(by: tuple) -> str:
    k = keys_sql(by)
    parts = []
    for gi in (1, 2):
        parts += [f"count(v) FILTER (WHERE g = {gi}) AS n{gi}",
                  f"avg(v) FILTER (WHERE g = {gi}) AS mean{gi}",
                  f"var_samp(v) FILTER (WHERE g = {gi}) AS var{gi}",
                  f"stddev_samp(v) FILTER (WHERE g = {gi}) AS std{gi}",
                  f"min(v) FILTER (WHERE g = {gi}) AS min{gi}",
                  f"max(v) FILTER (WHERE g = {gi}) AS max{gi}"]
    return f"SELECT {k}, {', '.join(parts)}, count(v) AS total_rows FROM fr GROUP BY {k}"


def ttest_sql(frame: str, by: tuple, equal_var: bool, alpha: float = 0.05) -> str:
    sel = (", ".join(by) + ", ") if by else ""
    if equal_var:
        tdf = ("(mean1 - mean2) / sqrt(((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2.0)"
               " * (1.0 / n1 + 1.0 / n2)) AS stat, (n1 + n2 - 2)::DOUBLE AS dfree")
    else:
        tdf = ("(mean1 - mean2) / sqrt(var1 / n1 + var2 / n2) AS stat, "
               "pow(var1 / n1 + var2 / n2, 2) / (pow(var1 / n1, 2) / (n1 - 1.0) "
               "+ pow(var2 / n2, 2) / (n2 - 1.0))::DOUBLE AS dfree")
    return (f"WITH fr AS ({frame}), m AS ({moments_sql(by)}), "
            f"t AS (SELECT *, {tdf} FROM m), "
            f"p AS (SELECT *, {O.t_two_sided_sql('stat', 'dfree')} AS pv FROM t) "
            f"SELECT {sel}n1 AS n_group1, n2 AS n_group2, round(stat, 6) AS statistic, "
            f"round(dfree, 6) AS df, round(pv, 6) AS p_value, pv < {alpha} AS significant FROM p")


def mw_sql(frame: str, by: tuple) -> str:
    k = keys_sql(by)
    sel = (", ".join(by) + ", ") if by else ""
    return (f"WITH fr AS ({frame}), "
            f"vc AS (SELECT {k}, v, count(*) AS t, count(*) FILTER (WHERE g = 1) AS t1 "
            f"FROM fr GROUP BY {k}, v), "
            f"rk AS (SELECT *, coalesce(sum(t) OVER (PARTITION BY {k} ORDER BY v ROWS BETWEEN "
            f"UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2.0 AS mid FROM vc), "
            f"s AS (SELECT {k}, sum(t1)::DOUBLE AS n1, (sum(t) - sum(t1))::DOUBLE AS n2, "
            f"sum(t1 * mid) AS r1, sum(t::DOUBLE * t * t - t) AS ties FROM rk GROUP BY {k}), "
            f"u AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u1, n1 + n2 AS nn FROM s), "
            f"z AS (SELECT *, (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / "
            f"sqrt(n1 * n2 / 12.0 * ((nn + 1) - ties / (nn * (nn - 1)))) AS zz FROM u) "
            f"SELECT {sel}n1::BIGINT AS n_group1, n2::BIGINT AS n_group2, round(u1, 6) AS statistic, "
            f"round(least(1.0, 2 * {O.norm_sf_sql('zz')}), 6) AS p_value FROM z")


def levene_sql(frame: str, by: tuple) -> str:
    k = keys_sql(by)
    sel = (", ".join(by) + ", ") if by else ""
    return (f"WITH fr AS ({frame}), "
            f"md AS (SELECT {k}, g, quantile_cont(v, 0.5) AS med FROM fr GROUP BY {k}, g), "
            f"z AS (SELECT fr.*, abs(v - med) AS z FROM fr JOIN md USING ({k}, g)), "
            f"a AS (SELECT {k}, count(z) FILTER (WHERE g = 1)::DOUBLE AS n1, "
            f"count(z) FILTER (WHERE g = 2)::DOUBLE AS n2, avg(z) FILTER (WHERE g = 1) AS z1, "
            f"avg(z) FILTER (WHERE g = 2) AS z2, var_samp(z) FILTER (WHERE g = 1) AS s1, "
            f"var_samp(z) FILTER (WHERE g = 2) AS s2 FROM z GROUP BY {k}), "
            f"w AS (SELECT *, (n1 * z1 + n2 * z2) / (n1 + n2) AS za FROM a), "
            f"ww AS (SELECT *, (n1 + n2 - 2) * (n1 * pow(z1 - za, 2) + n2 * pow(z2 - za, 2)) / "
            f"((n1 - 1) * s1 + (n2 - 1) * s2) AS lw FROM w), "
            f"p AS (SELECT *, {O.t_two_sided_sql('sqrt(lw)', '(n1 + n2 - 2)')} AS lp FROM ww) "
            f"SELECT {sel}round(lw, 6) AS levene_w, round(lp, 6) AS levene_p, "
            f"lp >= 0.05 AS equal_variance FROM p")


def shapiro_sql(frame: str, keys: tuple) -> str:
    """Keys must include g; assumes n >= 12 in every group (the driver tables'
    groups); the n < 12 branches are covered by pytest."""
    k = ", ".join(keys)
    m = O.norm_ppf_sql("((i - 0.375) / (n + 0.25))")
    c1 = "(0.221157 * u - 0.147981 * u * u - 2.071190 * pow(u, 3) + 4.434685 * pow(u, 4) - 2.706056 * pow(u, 5))"
    c2 = "(0.042981 * u - 0.293762 * u * u - 1.752461 * pow(u, 3) + 5.682633 * pow(u, 4) - 3.582633 * pow(u, 5))"
    return (f"WITH fr AS ({frame}), "
            f"o AS (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY v) AS i, "
            f"count(*) OVER (PARTITION BY {k}) AS n FROM fr), "
            f"om AS (SELECT *, {m} AS m FROM o), "
            f"a AS (SELECT {k}, n, sum(m * m) AS ss, sum(m * v) AS smx, "
            f"max(v) FILTER (WHERE i = 1) AS x1, max(v) FILTER (WHERE i = 2) AS x2, "
            f"max(v) FILTER (WHERE i = n - 1) AS xn1, max(v) FILTER (WHERE i = n) AS xn, "
            f"max(m) FILTER (WHERE i = n) AS mn, max(m) FILTER (WHERE i = n - 1) AS mn1, "
            f"var_samp(v) * (n - 1) AS ssq FROM om GROUP BY {k}, n), "
            f"b AS (SELECT *, 1.0 / sqrt(n) AS u FROM a), "
            f"c AS (SELECT *, mn / sqrt(ss) + {c1} AS an, mn1 / sqrt(ss) + {c2} AS an1 FROM b), "
            f"d AS (SELECT *, sqrt((ss - 2 * mn * mn - 2 * mn1 * mn1) / (1 - 2 * an * an - 2 * an1 * an1)) AS fac FROM c), "
            f"e AS (SELECT *, least(1.0, pow((smx - mn * (xn - x1) - mn1 * (xn1 - x2)) / fac "
            f"+ an * (xn - x1) + an1 * (xn1 - x2), 2) / ssq) AS w FROM d), "
            f"f AS (SELECT *, ln(1 - w) AS y, ln(n) AS ll FROM e), "
            f"h AS (SELECT *, (y - (-1.5861 - 0.31082 * ll - 0.083751 * ll * ll + 0.0038915 * pow(ll, 3))) / "
            f"exp(-0.4803 - 0.082676 * ll + 0.0030302 * ll * ll) AS zz FROM f) "
            f"SELECT {k}, n, round(w, 6) AS sw_w, CASE WHEN n <= 5000 THEN round({O.norm_sf_sql('zz')}, 6) END AS sw_p, "
            f"n > 5000 OR {O.norm_sf_sql('zz')} >= 0.05 AS is_normal FROM h")


def contingency_sql(cells: str, k: str) -> str:
    """cells: (k..., o1, o2) rows; returns k..., stat, df, p, n_total."""
    return (f"c AS ({cells}), "
            f"w AS (SELECT *, sum(o1) OVER (PARTITION BY {k}) AS r1, sum(o2) OVER (PARTITION BY {k}) AS r2, "
            f"count(*) OVER (PARTITION BY {k}) AS kk FROM c), "
            f"e AS (SELECT *, r1 * (o1 + o2)::DOUBLE / (r1 + r2) AS e1, r2 * (o1 + o2)::DOUBLE / (r1 + r2) AS e2 FROM w), "
            f"y AS (SELECT *, CASE WHEN kk = 2 THEN sign(e1 - o1) * least(0.5, abs(e1 - o1)) ELSE 0 END AS a1, "
            f"CASE WHEN kk = 2 THEN sign(e2 - o2) * least(0.5, abs(e2 - o2)) ELSE 0 END AS a2 FROM e), "
            f"s AS (SELECT {k}, sum(pow(o1 + a1 - e1, 2) / e1 + pow(o2 + a2 - e2, 2) / e2) AS stat, "
            f"(any_value(kk) - 1)::DOUBLE AS dfree, any_value(r1 + r2) AS n_total FROM y GROUP BY {k})")


def chisq_final_sql(by: tuple, extra_sel: str = "") -> str:
    sel = (", ".join(by) + ", ") if by else ""
    return (f"SELECT {sel}round(stat, 6) AS statistic, round(dfree, 6) AS df, "
            f"round({O.chi2_sf_sql('stat', 'dfree')}, 6) AS p_value, n_total::BIGINT AS n_total{extra_sel} FROM s")


def binned_cells_sql(frame: str, by: tuple, cap: int = 10) -> str:
    k = keys_sql(by)
    # edges i * step + lo, last edge = hi; bin = (# of edges 0..k-1 <= v) - 1
    edge_terms = " + ".join(
        f"(CASE WHEN {i} < kb AND ({i} * ((hi - lo) / kb) + lo) <= v THEN 1 ELSE 0 END)"
        for i in range(cap))
    return (f"fr AS ({frame}), "
            f"pl AS (SELECT {k}, count(v) AS nn, min(v) AS lo0, max(v) AS hi0 FROM fr GROUP BY {k}), "
            f"pl2 AS (SELECT *, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, "
            f"CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi, "
            f"greatest(least(floor(sqrt(nn / 2.0)), {cap}), 1)::INT AS kb FROM pl), "
            f"bb AS (SELECT fr.*, ({edge_terms}) - 1 AS bin FROM fr JOIN pl2 USING ({k})), "
            f"cells AS (SELECT {k}, bin, count(*) FILTER (WHERE g = 1) AS o1, "
            f"count(*) FILTER (WHERE g = 2) AS o2 FROM bb GROUP BY {k}, bin)")


def gof_sql(counts: str, k: str, expected: bool) -> str:
    """counts: (k..., observed, expected) rows."""
    e = ("expected * (so / se)" if expected else "so / kk")
    return (f"c AS ({counts}), "
            f"w AS (SELECT *, sum(observed) OVER (PARTITION BY {k}) AS so, "
            f"sum(expected) OVER (PARTITION BY {k}) AS se, count(*) OVER (PARTITION BY {k}) AS kk FROM c), "
            f"e AS (SELECT *, {e} AS ee FROM w), "
            f"s AS (SELECT {k}, sum(pow(observed - ee, 2) / ee) AS stat, (any_value(kk) - 1)::DOUBLE AS dfree, "
            f"any_value(so) AS n_total FROM e GROUP BY {k})")


# --------------------------------------------------------------------------
# Frames used by several queries
# --------------------------------------------------------------------------
LI_PRICE = frame_sql("lineitem", "l_extendedprice", "l_returnflag", "'A'", "'R'")
EV_CP = frame_sql("events", "value", "event_type", "'click'", "'purchase'")


def li_price(spark, d, by=()):
    return prepare(_t(spark, d, "lineitem"), "l_extendedprice", "l_returnflag", ("A", "R"), by)


def ev_cp(spark, d):
    return prepare(_t(spark, d, "events"), "value", "event_type", ("click", "purchase"))


def _flat_test(res: DataFrame, by=()) -> DataFrame:
    return res.select(*by, "n_group1", "n_group2", r("statistic").alias("statistic"),
                      r("df").alias("df"), r("p_value").alias("p_value"), "significant")


# --------------------------------------------------------------------------
# D4-D6 t-tests
# --------------------------------------------------------------------------
@register("ttest_independent", ttest_sql(LI_PRICE, (), True))
def q_ttest_independent(spark, d):
    res = two_sample(_t(spark, d, "lineitem"), "l_extendedprice", "l_returnflag", ("A", "R"),
                     test="independent_ttest", checks=False)
    return _flat_test(res)


@register("ttest_welch", ttest_sql(
    frame_sql("orders", "o_totalprice", "o_orderstatus", "'F'", "'O'", ("o_orderpriority",)),
    ("o_orderpriority",), False))
def q_ttest_welch(spark, d):
    res = two_sample(_t(spark, d, "orders"), "o_totalprice", "o_orderstatus", ("F", "O"),
                     test="welch_ttest", by=["o_orderpriority"], checks=False)
    return _flat_test(res, ["o_orderpriority"])


PAIRS_SQL = ("SELECT l_orderkey, avg(l_quantity) FILTER (WHERE l_linenumber = 1) AS x, "
             "avg(l_quantity) FILTER (WHERE l_linenumber = 2) AS y FROM lineitem "
             "WHERE l_linenumber IN (1, 2) AND l_quantity IS NOT NULL AND NOT isnan(l_quantity) "
             "GROUP BY l_orderkey")


@register("ttest_paired", (
    f"WITH pr AS ({PAIRS_SQL}), d AS (SELECT x - y AS dd FROM pr WHERE x IS NOT NULL AND y IS NOT NULL), "
    f"s AS (SELECT count(dd) AS n, avg(dd) AS md, var_samp(dd) AS vd FROM d), "
    f"t AS (SELECT *, md / sqrt(vd / n) AS stat, (n - 1)::DOUBLE AS dfree FROM s), "
    f"p AS (SELECT *, {O.t_two_sided_sql('stat', 'dfree')} AS pv FROM t) "
    f"SELECT (SELECT count(*) FROM lineitem WHERE l_linenumber = 1 AND l_quantity IS NOT NULL AND NOT isnan(l_quantity)) AS n_group1, "
    f"(SELECT count(*) FROM lineitem WHERE l_linenumber = 2 AND l_quantity IS NOT NULL AND NOT isnan(l_quantity)) AS n_group2, "
    f"round(stat, 6) AS statistic, round(dfree, 6) AS df, "
    f"round(pv, 6) AS p_value, pv < 0.05 AS significant FROM p"))
def q_ttest_paired(spark, d):
    res = paired(_t(spark, d, "lineitem"), "l_quantity", "l_linenumber", (1, 2), "l_orderkey",
                 checks=False, require_complete=False)
    return _flat_test(res)


@register("pair_align", PAIRS_SQL.replace("SELECT l_orderkey,", "SELECT * FROM (SELECT l_orderkey,")
          + ") WHERE x IS NOT NULL AND y IS NOT NULL")
def q_pair_align(spark, d):
    fr = prepare(_t(spark, d, "lineitem"), "l_quantity", "l_linenumber", (1, 2), keep=["l_orderkey"])
    return pair_align(fr, ["_all"], "l_orderkey").filter("complete").select("l_orderkey", "x", "y")


@register("stack_groups", ttest_sql(
    "SELECT 0 AS _all, 1 AS g, c_acctbal AS v FROM customer WHERE c_acctbal IS NOT NULL AND NOT isnan(c_acctbal) "
    "UNION ALL SELECT 0, 2, s_acctbal FROM supplier WHERE s_acctbal IS NOT NULL AND NOT isnan(s_acctbal)",
    (), False))
def q_stack_groups(spark, d):
    from twosample.operators.ttests import two_sample_t
    fr = stack_groups(_t(spark, d, "customer"), _t(spark, d, "supplier"), "c_acctbal", "s_acctbal")
    res = two_sample_t(fr, ["_all"], equal_var=False)
    return res.select(F.col("n1").alias("n_group1"), F.col("n2").alias("n_group2"),
                      r("statistic").alias("statistic"), r("df").alias("df"),
                      r("p_value").alias("p_value"), (F.col("p_value") < 0.05).alias("significant"))


# --------------------------------------------------------------------------
# D7 Mann-Whitney, E1/E2 ranks
# --------------------------------------------------------------------------
@register("mannwhitney", mw_sql(LI_PRICE, ()))
def q_mannwhitney(spark, d):
    res = two_sample(_t(spark, d, "lineitem"), "l_extendedprice", "l_returnflag", ("A", "R"),
                     test="mannwhitney")
    return res.select("n_group1", "n_group2", r("statistic").alias("statistic"),
                      r("p_value").alias("p_value"))


@register("mannwhitney_ties", mw_sql(
    frame_sql("lineitem", "l_quantity", "l_returnflag", "'A'", "'R'", ("l_linestatus",)),
    ("l_linestatus",)))
def q_mannwhitney_ties(spark, d):
    res = two_sample(_t(spark, d, "lineitem"), "l_quantity", "l_returnflag", ("A", "R"),
                     test="mannwhitney", by=["l_linestatus"])
    return res.select("l_linestatus", "n_group1", "n_group2", r("statistic").alias("statistic"),
                      r("p_value").alias("p_value"))


@register("midrank", (
    "WITH vc AS (SELECT l_returnflag, l_quantity AS v, count(*) AS t FROM lineitem "
    "WHERE l_quantity IS NOT NULL AND NOT isnan(l_quantity) GROUP BY 1, 2) "
    "SELECT l_returnflag, v, t, coalesce(sum(t) OVER (PARTITION BY l_returnflag ORDER BY v ROWS "
    "BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2.0 AS midrank FROM vc"))
def q_midrank(spark, d):
    fr = prepare(_t(spark, d, "lineitem"), "l_quantity", by=["l_returnflag"])
    return RK.midranks(fr, ["l_returnflag"]).select("l_returnflag", "v", "t", "midrank")


@register("order_rank", (
    "SELECT c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal) AS i, "
    "c_acctbal AS v FROM customer WHERE c_acctbal IS NOT NULL AND NOT isnan(c_acctbal)"))
def q_order_rank(spark, d):
    fr = prepare(_t(spark, d, "customer"), "c_acctbal", by=["c_mktsegment"])
    return RK.observation_ranks(fr, ["c_mktsegment"]).select("c_mktsegment", "i", "v")


# --------------------------------------------------------------------------
# D12 Levene / C3, D13 Shapiro, D15 + H9 assumption report
# --------------------------------------------------------------------------
@register("levene", levene_sql(EV_CP, ()))
def q_levene(spark, d):
    lv = levene(ev_cp(spark, d), ["_all"])
    return lv.select(r("levene_w").alias("levene_w"), r("levene_p").alias("levene_p"),
                     "equal_variance")


@register("rejoin_stats", (
    "WITH fr AS (SELECT event_type, value AS v FROM events WHERE value IS NOT NULL AND NOT isnan(value)), "
    "md AS (SELECT event_type, quantile_cont(v, 0.5) AS median FROM fr GROUP BY 1) "
    "SELECT event_type, round(any_value(median), 6) AS median, round(avg(abs(v - median)), 6) AS mean_abs_dev, "
    "count(*) AS n FROM fr JOIN md USING (event_type) GROUP BY event_type"))
def q_rejoin_stats(spark, d):
    fr = prepare(_t(spark, d, "events"), "value", by=["event_type"])
    med = group_medians(fr, ["event_type"])
    z = rejoin_stats(fr, med, ["event_type"])
    return z.groupBy("event_type").agg(
        r(F.first("median")).alias("median"),
        r(F.avg(F.abs(F.col("v") - F.col("median")))).alias("mean_abs_dev"),
        F.count(F.lit(1)).alias("n"))


@register("shapiro_wilk", shapiro_sql(
    frame_sql("events", "value", None, by=("event_type",)), ("event_type", "g")))
def q_shapiro_wilk(spark, d):
    fr = prepare(_t(spark, d, "events"), "value", by=["event_type"])
    sw = shapiro(fr, ["event_type", "g"])
    return sw.select("event_type", _g(), "n", r("sw_w").alias("sw_w"), r("sw_p").alias("sw_p"),
                     "is_normal")


@register("shapiro_wilk_small", shapiro_sql(
    frame_sql("customer", "c_acctbal", None, by=("c_mktsegment",)), ("c_mktsegment", "g")))
def q_shapiro_wilk_small(spark, d):
    fr = prepare(_t(spark, d, "customer"), "c_acctbal", by=["c_mktsegment"])
    sw = shapiro(fr, ["c_mktsegment", "g"])
    return sw.select("c_mktsegment", _g(), "n", r("sw_w").alias("sw_w"), r("sw_p").alias("sw_p"),
                     "is_normal")


def _assumption_sql() -> str:
    sw = shapiro_sql(EV_CP, ("_all", "g"))
    lv = levene_sql(EV_CP, ())
    return (f"WITH s AS ({sw}), l AS ({lv}) SELECT "
            f"(SELECT is_normal FROM s WHERE g = 1) AS normal1, "
            f"(SELECT is_normal FROM s WHERE g = 2) AS normal2, "
            f"(SELECT sw_w FROM s WHERE g = 1) AS sw_w1, (SELECT sw_w FROM s WHERE g = 2) AS sw_w2, "
            f"l.equal_variance AS equal_variance, l.levene_w AS levene_w, "
            f"CASE WHEN NOT (SELECT is_normal FROM s WHERE g = 1) OR NOT (SELECT is_normal FROM s WHERE g = 2) "
            f"THEN '{T.REC_NON_NORMAL}' WHEN NOT l.equal_variance THEN '{T.REC_UNEQUAL_VAR}' END "
            f"AS recommendation FROM l")


@register("assumption_report", _assumption_sql())
def q_assumption_report(spark, d):
    res = two_sample(_t(spark, d, "events"), "value", "event_type", ("click", "purchase"),
                     test="independent_ttest")
    ac = "assumption_checks"
    return res.select(
        F.col(f"{ac}.normality_group1.is_normal").alias("normal1"),
        F.col(f"{ac}.normality_group2.is_normal").alias("normal2"),
        r(f"{ac}.normality_group1.statistic").alias("sw_w1"),
        r(f"{ac}.normality_group2.statistic").alias("sw_w2"),
        F.col(f"{ac}.equal_variance.equal_variance").alias("equal_variance"),
        r(f"{ac}.equal_variance.statistic").alias("levene_w"),
        "recommendation")


@register("welch_recommendation", (
    f"WITH s AS ({shapiro_sql(EV_CP, ('_all', 'g'))}) SELECT CASE WHEN bool_or(NOT is_normal) THEN '{T.REC_NON_NORMAL}' END "
    f"AS recommendation, count(*) FILTER (WHERE is_normal) AS normal_groups FROM s"))
def q_welch_recommendation(spark, d):
    """H9, Welch chain: unequal variances are no reason to change the test."""
    res = two_sample(_t(spark, d, "events"), "value", "event_type", ("click", "purchase"), test="welch_ttest")
    normal = [F.col(f"assumption_checks.normality_group{g}.is_normal").cast("long") for g in (1, 2)]
    return res.select("recommendation", (normal[0] + normal[1]).alias("normal_groups"))


ACCOUNT_DIFF = ("SELECT 0 AS _all, c_mktsegment AS g, c_acctbal - (c_acctbal * 0.5 + c_custkey % 7 * 100) AS v FROM customer "
                "WHERE c_acctbal IS NOT NULL AND NOT isnan(c_acctbal)")


@register("paired_recommendation", (
    f"WITH s AS ({shapiro_sql(ACCOUNT_DIFF, ('_all', 'g'))}) SELECT g AS c_mktsegment, sw_w, is_normal, "
    f"CASE WHEN NOT is_normal THEN '{T.REC_PAIRED_NON_NORMAL}' END AS recommendation FROM s"))
def q_paired_recommendation(spark, d):
    """H9, paired chain, per segment; D15 checks the differences only."""
    c = _t(spark, d, "customer")
    x = c.select("c_mktsegment", "c_custkey", F.lit("x").alias("side"), F.col("c_acctbal").alias("v"))
    y = c.select("c_mktsegment", "c_custkey", F.lit("y").alias("side"), (F.col("c_acctbal") * 0.5 + F.col("c_custkey") % 7 * 100).alias("v"))
    res = paired(x.unionByName(y), "v", "side", ("x", "y"), "c_custkey", by=["c_mktsegment"])
    nd = "assumption_checks.normality_of_differences"
    return res.select("c_mktsegment", r(f"{nd}.statistic").alias("sw_w"), F.col(f"{nd}.is_normal").alias("is_normal"), "recommendation")


# --------------------------------------------------------------------------
# D1-D3 summaries, I3 means
# --------------------------------------------------------------------------
@register("group_summary", (
    "SELECT l_returnflag, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std, "
    "count(l_extendedprice) AS count, min(l_extendedprice) AS min, max(l_extendedprice) AS max, "
    "quantile_disc(l_extendedprice, 0.5) AS median FROM lineitem "
    "WHERE l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice) GROUP BY l_returnflag"))
def q_group_summary(spark, d):
    s = group_summary(_t(spark, d, "lineitem"), "l_extendedprice", "l_returnflag",
                      median="exact")
    return s.select("l_returnflag", r("mean", 4).alias("mean"), r("std", 4).alias("std"),
                    "count", "min", "max", "median")


@register("two_group_summary", (
    f"WITH fr AS ({frame_sql('orders', 'o_totalprice', 'o_orderstatus', chr(39)+'F'+chr(39), chr(39)+'O'+chr(39), ('o_orderpriority',))}), "
    f"m AS ({moments_sql(('o_orderpriority',))}) SELECT o_orderpriority, "
    + ", ".join(f"round(mean{g}, 4) AS mean{g}, round(std{g}, 4) AS std{g}, n{g} AS count{g}, "
                f"min{g}, max{g}" for g in (1, 2)) + ", total_rows FROM m"))
def q_two_group_summary(spark, d):
    fr = prepare(_t(spark, d, "orders"), "o_totalprice", "o_orderstatus", ("F", "O"),
                 by=["o_orderpriority"])
    m = moments(fr, ["o_orderpriority"])
    cols = []
    for g in (1, 2):
        cols += [r(f"mean{g}", 4).alias(f"mean{g}"), r(f"std{g}", 4).alias(f"std{g}"),
                 F.col(f"n{g}").alias(f"count{g}"), f"min{g}", f"max{g}"]
    return m.select("o_orderpriority", *cols, "total_rows")


@register("group_means", (
    "SELECT event_type, round(avg(value), 6) AS mean, count(value) AS n FROM events "
    "WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY event_type"))
def q_group_means(spark, d):
    fr = prepare(_t(spark, d, "events"), "value", by=["event_type"])
    return DI.group_means(fr, ["event_type"]).select("event_type", r("mean").alias("mean"), "n")


# --------------------------------------------------------------------------
# D8-D11 chi-square, H1-H4 binning
# --------------------------------------------------------------------------
@register("chisq_binned", "WITH " + binned_cells_sql(LI_PRICE, ()) + ", "
          + contingency_sql("SELECT _all, o1, o2 FROM cells", "_all") + " " + chisq_final_sql(()))
def q_chisq_binned(spark, d):
    res = CS.chisq_binned(li_price(spark, d), ["_all"])
    return res.select(r("statistic").alias("statistic"), r("df").alias("df"),
                      r("p_value").alias("p_value"), F.col("n_total").cast("long").alias("n_total"))


@register("binned_counts", "WITH " + binned_cells_sql(LI_PRICE, ()) +
          " SELECT bin, o1, o2 FROM cells")
def q_binned_counts(spark, d):
    return CS.binned_counts(li_price(spark, d), ["_all"]).select("bin", "o1", "o2")


PRIO_COUNTS = ("SELECT 0 AS _all, o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F')::DOUBLE AS observed, "
               "count(*) FILTER (WHERE o_orderstatus = 'O')::DOUBLE AS expected FROM orders "
               "WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderpriority")


def _prio_counts(spark, d):
    fr = prepare(_t(spark, d, "orders"), "o_totalprice", "o_orderstatus", ("F", "O"),
                 keep=["o_orderpriority"])
    return CS.category_counts(fr, ["_all"], "o_orderpriority")


@register("chisq_gof_expected", "WITH " + gof_sql(PRIO_COUNTS, "_all", True) + " " + chisq_final_sql(()))
def q_chisq_gof_expected(spark, d):
    res = CS.chisq_gof(_prio_counts(spark, d), ["_all"])
    return res.select(r("statistic").alias("statistic"), r("df").alias("df"),
                      r("p_value").alias("p_value"), "n_total")


@register("rescale_expected", (
    f"WITH c AS ({PRIO_COUNTS}) SELECT o_orderpriority, observed, "
    f"round(expected * (sum(observed) OVER () / sum(expected) OVER ()), 6) AS expected_scaled FROM c"))
def q_rescale_expected(spark, d):
    c = CS.rescaled_counts(_prio_counts(spark, d), ["_all"])
    return c.select("o_orderpriority", "observed", r("expected_scaled").alias("expected_scaled"))


@register("chisq_gof_uniform", "WITH " + gof_sql(
    "SELECT 0 AS _all, event_type, count(*)::DOUBLE AS observed, 0.0 AS expected FROM events GROUP BY event_type",
    "_all", False) + " " + chisq_final_sql(()))
def q_chisq_gof_uniform(spark, d):
    ev = _t(spark, d, "events")
    counts = constant_key(ev.groupBy("event_type").agg(F.count(F.lit(1)).cast("double").alias("observed")))

    res = CS.chisq_gof(counts, ["_all"], "observed", None)
    return res.select(r("statistic").alias("statistic"), r("df").alias("df"),
                      r("p_value").alias("p_value"), "n_total")


@register("chisq_dispatch", (
    "WITH fr AS (" + frame_sql("lineitem", "l_quantity", "l_returnflag", "'A'", "'R'", ("l_linestatus",)) + "), "
    + contingency_sql("SELECT l_linestatus, v, count(*) FILTER (WHERE g = 1) AS o1, "
                      "count(*) FILTER (WHERE g = 2) AS o2 FROM fr GROUP BY l_linestatus, v",
                      "l_linestatus")
    + " " + chisq_final_sql(("l_linestatus",), ", 'contingency' AS variant")))
def q_chisq_dispatch(spark, d):
    fr = prepare(_t(spark, d, "lineitem"), "l_quantity", "l_returnflag", ("A", "R"),
                 by=["l_linestatus"])
    res = CS.chisq_auto(fr, ["l_linestatus"])
    return res.select("l_linestatus", r("statistic").alias("statistic"), r("df").alias("df"),
                      r("p_value").alias("p_value"), F.col("n_total").cast("long").alias("n_total"),
                      "variant")


# --------------------------------------------------------------------------
# H5-H10 text
# --------------------------------------------------------------------------
def _fmt_p_sql(p: str) -> str:
    return (f"CASE WHEN {p} < 0.0001 THEN printf('p < 0.0001 (%.2e)', {p}) "
            f"ELSE printf('p = %.4f', {p}) END")


@register("verdict_text", (
    "WITH b AS (" + ttest_sql(frame_sql("orders", "o_totalprice", "o_orderstatus", "'F'", "'O'",
                                        ("o_orderpriority",)), ("o_orderpriority",), False)
    .replace("round(pv, 6) AS p_value", "pv AS p_value") + ") "
    "SELECT o_orderpriority, CASE WHEN significant THEN 'The two groups differ significantly: ' || "
    + _fmt_p_sql("p_value") + " || ' is below the significance level 0.05.' ELSE "
    "'No significant difference between the two groups: ' || " + _fmt_p_sql("p_value")
    + " || ' is not below the significance level 0.05.' END AS verdict, "
    "CASE WHEN significant THEN 'SIGNIFICANT DIFFERENCE' ELSE 'NO SIGNIFICANT DIFFERENCE' END "
    "|| '   |   Welch Ttest   ' || printf('p = %.4f', p_value) AS headline FROM b"))
def q_verdict_text(spark, d):
    res = two_sample(_t(spark, d, "orders"), "o_totalprice", "o_orderstatus", ("F", "O"),
                     test="welch_ttest", by=["o_orderpriority"], checks=False)
    return res.select("o_orderpriority", "verdict", "headline")


@register("interpretation_text", (
    "WITH fr AS (" + frame_sql("orders", "o_totalprice", "o_orderstatus", "'F'", "'O'", ("o_orderpriority",))
    + "), m AS (SELECT o_orderpriority, count(*) FILTER (WHERE g = 1) AS n1, count(*) FILTER (WHERE g = 2) AS n2, "
    "count(*) AS total FROM fr GROUP BY 1) SELECT o_orderpriority, "
    "'Compares the means of two independent groups without assuming equal variances; groups of ' "
    "|| format('{:,}', n1) || ' and ' || format('{:,}', n2) || ' observations.' AS interpretation, "
    "'Computed by Spark over all ' || format('{:,}', total) || ' usable rows; ' || format('{:,}', total) "
    "|| ' rows entered the test statistic.' AS coverage_note FROM m"))
def q_interpretation_text(spark, d):
    res = two_sample(_t(spark, d, "orders"), "o_totalprice", "o_orderstatus", ("F", "O"),
                     test="welch_ttest", by=["o_orderpriority"], checks=False)
    return res.select("o_orderpriority", "interpretation", "coverage_note")


# --------------------------------------------------------------------------
# I1-I6 distribution data
# --------------------------------------------------------------------------
def _hist_sql(bins: int = 30) -> str:
    edge_terms = " + ".join(
        f"(CASE WHEN ({i} * ((hi - lo) / {bins}.0) + lo) <= v THEN 1 ELSE 0 END)" for i in range(bins))
    return (f"WITH fr AS ({LI_PRICE}), st AS (SELECT g, count(v) AS n, "
            f"CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo, "
            f"CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM fr GROUP BY g), "
            f"bb AS (SELECT g, ({edge_terms}) - 1 AS b0 FROM fr JOIN st USING (g)), "
            f"cn AS (SELECT g, least(b0, {bins - 1}) AS bin, count(*) AS cnt FROM bb GROUP BY 1, 2), "
            f"grid AS (SELECT g, n, lo, hi, unnest(range(0, {bins})) AS bin FROM st), "
            f"e AS (SELECT grid.*, bin * ((hi - lo) / {bins}.0) + lo AS lft, "
            f"CASE WHEN bin = {bins - 1} THEN hi ELSE (bin + 1) * ((hi - lo) / {bins}.0) + lo END AS rgt, "
            f"coalesce(cnt, 0) AS count FROM grid LEFT JOIN cn USING (g, bin)) "
            f"SELECT g, bin::INT AS bin, lft AS left, rgt AS right, count, "
            f"round(count / (n * (rgt - lft)), 12) AS density FROM e")


@register("hist_density", _hist_sql())
def q_hist_density(spark, d):
    h = DI.hist_density(li_price(spark, d), ["_all"])
    return h.select(_g(), "bin", "left", "right", "count", r("density", 12).alias("density"))


def _kde_sql(points: int = 300) -> str:
    return (f"WITH fr AS ({EV_CP}), st AS (SELECT g, count(v) AS n, min(v) AS lo, max(v) AS hi, "
            f"stddev_samp(v) * pow(count(v), -0.2) AS h FROM fr GROUP BY g), "
            f"grid AS (SELECT g, n, h, unnest(range(0, {points})) AS j, lo, hi FROM st), "
            f"gx AS (SELECT *, CASE WHEN j = {points - 1} THEN hi ELSE j * ((hi - lo) / {points - 1}.0) + lo END AS x FROM grid) "
            f"SELECT gx.g, j::INT AS j, x, round(sum(exp(-0.5 * pow((x - v) / h, 2))) / (n * h * sqrt(2 * pi())), 12) AS density "
            f"FROM gx JOIN fr ON gx.g = fr.g GROUP BY gx.g, j, x, n, h")


@register("kde_curve", _kde_sql())
def q_kde_curve(spark, d):
    k = DI.kde_curve(ev_cp(spark, d), ["_all"])
    return k.select(_g(), "j", "x", r("density", 12).alias("density"))


@register("box_stats", (
    f"WITH fr AS ({LI_PRICE}), q AS (SELECT g, count(*) AS n, quantile_cont(v, 0.25) AS q1, "
    f"quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM fr GROUP BY g), "
    f"f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS hf FROM q) "
    f"SELECT g, any_value(n) AS n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, "
    f"round(any_value(q3), 6) AS q3, round(any_value(q3 - q1), 6) AS iqr, "
    f"least(min(v) FILTER (WHERE v >= lf), any_value(q1)) AS whisker_low, "
    f"greatest(max(v) FILTER (WHERE v <= hf), any_value(q3)) AS whisker_high, "
    f"count(*) FILTER (WHERE v < lf OR v > hf) AS n_outliers FROM fr JOIN f USING (g) GROUP BY g"))
def q_box_stats(spark, d):
    b = DI.box_stats(li_price(spark, d), ["_all"])
    return b.select(_g(), "n", r("q1").alias("q1"), r("median").alias("median"), r("q3").alias("q3"),
                    r("iqr").alias("iqr"), "whisker_low", "whisker_high", "n_outliers")


def _qq_sql(digits: int | None = 6) -> str:
    pos = ("CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n) "
           "ELSE (i - 0.3175) / (n + 0.365) END")
    return (f"WITH fr AS (SELECT c_mktsegment, c_acctbal AS v FROM customer WHERE c_acctbal IS NOT NULL "
            f"AND NOT isnan(c_acctbal)), o AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY v) AS i, "
            f"count(*) OVER (PARTITION BY c_mktsegment) AS n FROM fr) "
            f"SELECT c_mktsegment, i, n, "
            + (f"round({O.norm_ppf_sql(pos)}, {digits})" if digits else O.norm_ppf_sql(pos))
            + " AS theoretical, v AS sample FROM o")


@register("qq_points", _qq_sql())
def q_qq_points(spark, d):
    fr = prepare(_t(spark, d, "customer"), "c_acctbal", by=["c_mktsegment"])
    p = DI.qq_points(fr, ["c_mktsegment"])
    return p.select("c_mktsegment", "i", "n", r("theoretical").alias("theoretical"), "sample")


@register("qq_fit", (
    "WITH p AS (" + _qq_sql(None) + ") SELECT c_mktsegment, "
    "round(regr_slope(sample, theoretical), 6) AS slope, round(regr_intercept(sample, theoretical), 6) AS intercept, "
    "round(corr(theoretical, sample), 6) AS r, count(*) AS n FROM p GROUP BY c_mktsegment"))
def q_qq_fit(spark, d):
    fr = prepare(_t(spark, d, "customer"), "c_acctbal", by=["c_mktsegment"])
    f = DI.qq_fit(DI.qq_points(fr, ["c_mktsegment"]), ["c_mktsegment"])
    return f.select("c_mktsegment", r("slope").alias("slope"), r("intercept").alias("intercept"),
                    r("r").alias("r"), "n")


# --------------------------------------------------------------------------
# B4, F1s, F2s: caps and samples
# --------------------------------------------------------------------------
@register("head_cap", (
    "WITH o AS (SELECT l_returnflag, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag "
    "ORDER BY l_orderkey * 8 + l_linenumber, l_extendedprice) AS rk FROM lineitem WHERE l_returnflag IN ('A', 'R') "
    "AND l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice)) "
    "SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 4) AS total FROM o WHERE rk <= 5000 "
    "GROUP BY l_returnflag"))
def q_head_cap(spark, d):
    li = _t(spark, d, "lineitem").withColumn(
        "row_order", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("double"))
    fr = prepare(li, "l_extendedprice", "l_returnflag", ("A", "R"), keep=["row_order"])
    capped = head_cap(fr, ["_all"], "row_order", 5000)
    out = capped.groupBy("g").agg(F.count(F.lit(1)).alias("n"), r(F.sum("v"), 4).alias("total"))
    return out.select(F.when(F.col("g") == 1, "A").otherwise("R").alias("l_returnflag"), "n", "total")


@register("limit_rows", (
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"))
def q_limit_rows(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return limit_rows(o, 10, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


SAMPLE_KEY = ("l_orderkey", "l_linenumber", "l_partkey")


@register("sampled_test", (
    "WITH fr AS (" + frame_sql("lineitem", "l_extendedprice", "l_returnflag", "'A'", "'R'", SAMPLE_KEY) + "), "
    "pick AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY substr(md5(concat_ws('|', '42', l_orderkey, l_linenumber, "
    "l_partkey)), 1, 15), l_orderkey, l_linenumber, l_partkey, v) AS k FROM fr), "
    "m AS (SELECT count(*) FILTER (WHERE g = 1) AS n1, count(*) FILTER (WHERE g = 2) AS n2, avg(v) FILTER (WHERE g = 1) AS mean1, "
    "avg(v) FILTER (WHERE g = 2) AS mean2, var_samp(v) FILTER (WHERE g = 1) AS var1, var_samp(v) FILTER (WHERE g = 2) AS var2 "
    "FROM pick WHERE k <= 5000), "
    "t AS (SELECT *, (mean1 - mean2) / sqrt(var1 / n1 + var2 / n2) AS stat, pow(var1 / n1 + var2 / n2, 2) / "
    "(pow(var1 / n1, 2) / (n1 - 1.0) + pow(var2 / n2, 2) / (n2 - 1.0))::DOUBLE AS dfree FROM m), "
    "f AS (SELECT count(*) FILTER (WHERE g = 1) AS n_group1, count(*) FILTER (WHERE g = 2) AS n_group2, "
    "round(avg(v) FILTER (WHERE g = 1), 4) AS mean1, count(*) AS total_rows FROM fr) "
    f"SELECT f.n_group1, f.n_group2, f.mean1, round(stat, 6) AS statistic, round({O.t_two_sided_sql('stat', 'dfree')}, 6) AS p_value, "
    "f.total_rows, n1 + n2 AS rows_tested FROM t, f"))
def q_sampled_test(spark, d):
    """F1s: a Welch test of an exact-size seeded sample of 5,000 rows per
    group; counts, summaries and the total are those of all rows."""
    res = two_sample(_t(spark, d, "lineitem"), "l_extendedprice", "l_returnflag", ("A", "R"),
                     test="welch_ttest", checks=False, sample_rows=5000, row_key=list(SAMPLE_KEY))
    return res.select("n_group1", "n_group2", r("group_stats.group1.mean", 4).alias("mean1"), r("statistic").alias("statistic"),
                      r("p_value").alias("p_value"), "total_rows", "rows_tested")


def _run_test_sql() -> str:
    sw, lv, tt = shapiro_sql(EV_CP, ("_all", "g")), levene_sql(EV_CP, ()), ttest_sql(EV_CP, (), True)
    return (f"WITH s AS ({sw}), l AS ({lv}), t AS ({tt}), fm AS ({EV_CP}) SELECT 'independent_ttest' AS test_name, t.*, "
            + ", ".join(f"(SELECT sw_w FROM s WHERE g = {g}) AS sw_w{g}, (SELECT is_normal FROM s WHERE g = {g}) AS normal{g}, "
                        f"(SELECT round(avg(v), 4) FROM fm WHERE g = {g}) AS mean{g}, (SELECT round(stddev_samp(v), 4) FROM fm WHERE g = {g}) AS std{g}, "
                        f"(SELECT min(v) FROM fm WHERE g = {g}) AS min{g}, (SELECT max(v) FROM fm WHERE g = {g}) AS max{g}" for g in (1, 2))
            + ", l.levene_w, l.levene_p, l.equal_variance, (SELECT count(*) FROM fm) AS total_rows, 'click' AS level1, 'purchase' AS level2 FROM t, l")


@register("run_test_full", _run_test_sql())
def q_run_test_full(spark, d):
    """D14 + D15: the dispatcher's full result row, flattened."""
    res = run_test(_t(spark, d, "events"), "independent_ttest", "value", "event_type", ("click", "purchase"), by=())
    ac, cols = "assumption_checks", []
    for g in (1, 2):
        gs, sw = f"group_stats.group{g}", f"{ac}.normality_group{g}"
        cols += [r(f"{sw}.statistic").alias(f"sw_w{g}"), F.col(f"{sw}.is_normal").alias(f"normal{g}"),
                 r(f"{gs}.mean", 4).alias(f"mean{g}"), r(f"{gs}.std", 4).alias(f"std{g}"),
                 F.col(f"{gs}.min").alias(f"min{g}"), F.col(f"{gs}.max").alias(f"max{g}")]
    return res.select("test_name", "n_group1", "n_group2", r("statistic").alias("statistic"), r("df").alias("df"),
                      r("p_value").alias("p_value"), "significant", *cols, r(f"{ac}.equal_variance.statistic").alias("levene_w"),
                      r(f"{ac}.equal_variance.p_value").alias("levene_p"), F.col(f"{ac}.equal_variance.equal_variance").alias("equal_variance"),
                      "total_rows", "level1", "level2")


# --------------------------------------------------------------------------
# Dirty text, strict casts, complete pairs; null keys
# --------------------------------------------------------------------------
DIRTY_SQL = ("SELECT l_returnflag, CASE WHEN l_orderkey % 7 = 0 THEN 'n/a' WHEN l_orderkey % 11 = 0 THEN 'NaN' "
             "WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(l_linenumber * 3 AS VARCHAR) END AS txt FROM lineitem")


def _dirty(spark, d):
    k = F.col("l_orderkey")
    return _t(spark, d, "lineitem").select("l_returnflag", "l_linenumber", F.when(k % 7 == 0, "n/a").when(k % 11 == 0, "NaN").when(
        k % 13 == 0, F.lit(None).cast("string")).otherwise((F.col("l_linenumber") * 3).cast("string")).alias("txt"))


@register("coerce_dirty", (
    f"WITH x AS ({DIRTY_SQL}), fr AS (SELECT l_returnflag, TRY_CAST(txt AS DOUBLE) AS v FROM x) "
    "SELECT l_returnflag, count(*) AS n, sum(v) AS total FROM fr WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY l_returnflag"))
def q_coerce_dirty(spark, d):
    """B2 + B3: text that is no number, NaN and null drop out."""
    fr = prepare(_dirty(spark, d), "txt", by=["l_returnflag"])
    return fr.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))


@register("coerce_strict", (
    "SELECT l_returnflag, count(*) AS n, sum(CAST(CAST(l_linenumber * 3 AS VARCHAR) AS DOUBLE)) AS total FROM lineitem GROUP BY l_returnflag"))
def q_coerce_strict(spark, d):
    """B1: clean text passes the strict cast (text that is no number is an error)."""
    li = _t(spark, d, "lineitem").select("l_returnflag", (F.col("l_linenumber") * 3).cast("string").alias("txt"))
    fr = prepare(li, "txt", by=["l_returnflag"], strict=True)
    return fr.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))


@register("paired_complete", (
    "WITH pr AS (SELECT o_orderkey, o_totalprice AS x, o_totalprice * 0.9 + o_orderkey % 5 AS y FROM orders "
    "WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)), "
    "s AS (SELECT count(*) AS n, avg(x - y) AS md, var_samp(x - y) AS vd, round(stddev_samp(x), 4) AS std1, min(y) AS min2 FROM pr), "
    "t AS (SELECT *, md / sqrt(vd / n) AS stat FROM s) "
    "SELECT n AS n_group1, n AS n_group2, round(stat, 4) AS statistic, std1, round(min2, 6) AS min2, 2 * n AS rows_tested FROM t"))
def q_paired_complete(spark, d):
    """Every pair key has both groups, so the required completeness holds;
    D2: the paired result carries full group summaries."""
    o = _t(spark, d, "orders").filter(F.col("o_totalprice").isNotNull() & ~F.isnan("o_totalprice"))
    x = o.select("o_orderkey", F.lit("x").alias("side"), F.col("o_totalprice").alias("v"))
    y = o.select("o_orderkey", F.lit("y").alias("side"), (F.col("o_totalprice") * 0.9 + F.col("o_orderkey") % 5).alias("v"))
    res = paired(x.unionByName(y), "v", "side", ("x", "y"), "o_orderkey", checks=False, require_complete=True)
    return res.select("n_group1", "n_group2", r("statistic", 4).alias("statistic"), r("group_stats.group1.std", 4).alias("std1"),
                      r("group_stats.group2.min").alias("min2"), "rows_tested")


def _null_key(spark, d):
    li = _t(spark, d, "lineitem").withColumn("status", F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")))
    return prepare(li, "l_quantity", "l_returnflag", ("A", "N"), by=["status"])


NULL_KEY_SQL = ("SELECT NULLIF(l_linestatus, 'O') AS status, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS g, l_quantity AS v FROM lineitem "
                "WHERE l_returnflag IN ('A', 'N') AND l_quantity IS NOT NULL AND NOT isnan(l_quantity)")


@register("null_key_box", (
    f"WITH fr AS ({NULL_KEY_SQL}), q AS (SELECT status, g, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, "
    "quantile_cont(v, 0.75) AS q3 FROM fr GROUP BY status, g) SELECT status, g, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3 FROM q"))
def q_null_key_box(spark, d):
    b = DI.box_stats(_null_key(spark, d), ["status"])
    return b.select("status", _g(), "n", r("q1").alias("q1"), r("median").alias("median"), r("q3").alias("q3"))


@register("null_key_midrank", (
    f"WITH fr AS ({NULL_KEY_SQL}), vc AS (SELECT status, v, count(*) AS t FROM fr GROUP BY status, v) SELECT status, v, t, coalesce(sum(t) OVER "
    "(PARTITION BY status ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2.0 AS midrank FROM vc"))
def q_null_key_midrank(spark, d):
    return RK.midranks(_null_key(spark, d), ["status"]).select("status", "v", "t", "midrank")


@register("null_key_levene", (
    f"WITH fr AS ({NULL_KEY_SQL}), md AS (SELECT status, g, quantile_cont(v, 0.5) AS med FROM fr GROUP BY status, g) "
    "SELECT fr.status, fr.g, round(avg(abs(v - med)), 6) AS mean_dev, count(*) AS n FROM fr JOIN md ON fr.g = md.g AND fr.status IS NOT DISTINCT FROM md.status GROUP BY fr.status, fr.g"))
def q_null_key_levene(spark, d):
    fr = _null_key(spark, d)
    z = rejoin_stats(fr, group_medians(fr, ["status"]), ["status"])
    return z.groupBy("status", "g").agg(r(F.avg(F.abs(F.col("v") - F.col("median")))).alias("mean_dev"), F.count(F.lit(1)).alias("n")).select(
        "status", _g(), "mean_dev", "n")


@register("null_key_chisq", (
    f"WITH fr AS ({NULL_KEY_SQL}), x AS (SELECT coalesce(status, '-') AS ks, * FROM fr), "
    + contingency_sql("SELECT ks, v, count(*) FILTER (WHERE g = 1) AS o1, count(*) FILTER (WHERE g = 2) AS o2 FROM x GROUP BY ks, v", "ks")
    + " SELECT NULLIF(ks, '-') AS status, round(stat, 4) AS statistic, dfree AS df, n_total::BIGINT AS n_total, 'contingency' AS variant FROM s").replace(
        "round(stat, 4) AS statistic", "CASE WHEN stat IS NULL OR isnan(stat) THEN -1 ELSE round(stat, 4) END AS statistic"))
def q_null_key_chisq(spark, d):
    """A statistic that is not defined (a group without rows) is -1 on both sides."""
    res = CS.chisq_auto(_null_key(spark, d), ["status"])
    return res.select("status", F.nanvl(r("statistic", 4), F.lit(-1.0)).alias("statistic"), "df", F.col("n_total").cast("long").alias("n_total"), "variant")


@register("group_summary_approx", (
    "SELECT l_returnflag, round(avg(l_quantity), 4) AS mean, count(l_quantity) AS count, quantile_disc(l_quantity, 0.5) AS median "
    "FROM lineitem WHERE l_quantity IS NOT NULL AND NOT isnan(l_quantity) GROUP BY l_returnflag"))
def q_group_summary_approx(spark, d):
    """D1 with the sketch median; ties make the sketch's value the exact one."""
    s = group_summary(_t(spark, d, "lineitem"), "l_quantity", "l_returnflag")
    return s.select("l_returnflag", r("mean", 4).alias("mean"), "count", "median")


@register("chisq_dispatch_binned", "WITH " + binned_cells_sql(frame_sql("orders", "o_totalprice", "o_orderstatus", "'F'", "'O'"), ()) + ", "
          + contingency_sql("SELECT _all, o1, o2 FROM cells", "_all") + " " + chisq_final_sql((), ", 'binned' AS variant"))
def q_chisq_dispatch_binned(spark, d):
    res = run_test(_t(spark, d, "orders"), "chisquare", "o_totalprice", "o_orderstatus", ("F", "O"))
    return res.select(r("statistic").alias("statistic"), r("df").alias("df"), r("p_value").alias("p_value"),
                      F.col("n_group1").alias("n_total"), "variant")


@register("chisq_dispatch_gof", "WITH " + gof_sql(
    "SELECT 0 AS _all, l_linenumber, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END)::DOUBLE AS observed, "
    "sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)::DOUBLE AS expected FROM lineitem WHERE l_returnflag IN ('A', 'R') "
    "GROUP BY l_linenumber", "_all", True) + " SELECT round(stat, 4) AS statistic, dfree AS df, n_total::BIGINT AS n_total, "
    "'goodness_of_fit' AS variant FROM s")
def q_chisq_dispatch_gof(spark, d):
    res = run_test(_t(spark, d, "lineitem"), "chisquare", "l_quantity", "l_returnflag", ("A", "R"), category="l_linenumber")
    return res.select(r("statistic", 4).alias("statistic"), "df", F.col("n_group1").alias("n_total"), "variant")


@register("chisq_dispatch_uniform", "WITH " + gof_sql(
    "SELECT 0 AS _all, event_type, count(*)::DOUBLE AS observed, 0.0 AS expected FROM events GROUP BY event_type",
    "_all", False) + " " + chisq_final_sql((), ", 'uniform' AS variant"))
def q_chisq_dispatch_uniform(spark, d):
    """D10 through the dispatcher: no second group."""
    counts = _t(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).cast("double").alias("observed"))
    res = run_test(counts, "chisquare", "observed")
    return res.select(r("statistic").alias("statistic"), r("df").alias("df"), r("p_value").alias("p_value"),
                      F.col("n_group1").alias("n_total"), "variant")


def _texts_sql() -> str:
    fr = "l_returnflag IN ('A', 'R') AND l_quantity IS NOT NULL AND NOT isnan(l_quantity)"
    n = {g: f"(SELECT format('{{:,}}', count(*)) FROM lineitem WHERE {fr} AND l_returnflag = '{g}')" for g in "AR"}
    both = f"(SELECT format('{{:,}}', count(*)) FROM lineitem WHERE {fr})"
    pairs = f"(SELECT format('{{:,}}', count(*)) FROM ({PAIRS_SQL}) WHERE x IS NOT NULL AND y IS NOT NULL)"
    groups = f"{n['A']} || ' and ' || {n['R']} || ' observations.'"
    return (f"SELECT 'independent_ttest' AS test_name, 'Compares the means of two independent groups assuming a common variance; groups of ' || {groups} AS interpretation "
            f"UNION ALL SELECT 'welch_ttest', 'Compares the means of two independent groups without assuming equal variances; groups of ' || {groups} "
            f"UNION ALL SELECT 'mannwhitney', 'Rank-based comparison of two independent groups with no normality assumption; groups of ' || {groups} "
            f"UNION ALL SELECT 'paired_ttest', 'Tests whether the mean within-pair difference is zero; ' || {pairs} || ' complete pairs.' "
            f"UNION ALL SELECT 'chisquare', 'Compares observed with expected frequencies over ' || {both} || ' observations; '")


@register("interpretation_tests", _texts_sql())
def q_interpretation_tests(spark, d):
    """H7 for all five tests (of chi-square's, the part before its outcome)."""
    li = _t(spark, d, "lineitem")
    out = None
    for test in ("independent_ttest", "welch_ttest", "mannwhitney", "chisquare"):
        res = two_sample(li, "l_quantity", "l_returnflag", ("A", "R"), test=test, checks=False).select(
            "test_name", F.regexp_replace("interpretation", "the pattern.*", "").alias("interpretation"))
        out = res if out is None else out.unionByName(res)
    return out.unionByName(paired(li, "l_quantity", "l_linenumber", (1, 2), "l_orderkey", checks=False,
                                  require_complete=False).select("test_name", "interpretation"))


@register("json_requests", (
    "SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n1, count(*) FILTER (WHERE o_orderstatus <> 'F') AS n2, "
    "round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 4) AS mean1, count(*) AS total FROM orders "
    "WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice) GROUP BY o_custkey"))
def q_json_requests(spark, d):
    """A2: one request per customer, each payload its own test."""
    from twosample.sources.readers import json_groups
    o = _t(spark, d, "orders").filter(F.col("o_totalprice").isNotNull() & ~F.isnan("o_totalprice"))
    payload = o.groupBy("o_custkey").agg(F.to_json(F.struct(
        F.collect_list(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("group1"),
        F.collect_list(F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))).alias("group2"))).alias("payload"))
    res = two_sample(json_groups(payload, "payload", keep=["o_custkey"]), "value", "grp", ("group1", "group2"),
                     test="welch_ttest", by=["o_custkey"], checks=False)
    return res.select("o_custkey", F.col("n_group1").alias("n1"), F.col("n_group2").alias("n2"),
                      r("group_stats.group1.mean", 4).alias("mean1"), F.col("total_rows").alias("total"))


# --------------------------------------------------------------------------
# A1 / A3 / A4: CSV scan and result sink over files Spark derives from tables
# --------------------------------------------------------------------------
@register("csv_group_scan", (
    "SELECT 'group1' AS grp, count(*) AS n, round(avg(o_totalprice), 4) AS mean, "
    "min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders "
    "WHERE o_orderstatus = 'F' AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice) "
    "UNION ALL SELECT 'group2', count(*), round(avg(o_totalprice), 4), min(o_totalprice), "
    "max(o_totalprice) FROM orders WHERE o_orderstatus = 'O' AND o_totalprice IS NOT NULL "
    "AND NOT isnan(o_totalprice)"))
def q_csv_group_scan(spark, d):
    """A1: each group written by Spark as a headed CSV file set (value column
    first, so the first-column default A3 picks it), then scanned back with
    an explicit schema."""
    from twosample.session import scratch_path
    from twosample.sources.readers import csv_groups
    o = _t(spark, d, "orders")
    paths = []
    for status in ("F", "O"):
        p = scratch_path(spark, f"csv-{status}")
        (o.filter(F.col("o_orderstatus") == status)
          .select("o_totalprice", "o_orderkey").write.option("header", True).csv(p))
        paths.append(p)
    g = csv_groups(spark, paths[0], paths[1], schema="o_totalprice double, o_orderkey long")
    return g.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), r(F.avg("value"), 4).alias("mean"),
                                F.min("value").alias("min"), F.max("value").alias("max"))


def _ordered_csv(spark, rows, order: list[str], name: str) -> str:
    """``rows`` as headed CSV part files whose names and lines follow ``order``."""
    from twosample.session import scratch_path
    p = scratch_path(spark, name)
    rows.orderBy(*order).drop(*order).write.option("header", True).csv(p)
    return p


# every 17th value is missing in both files, so positions count the usable values
X_SQL = "SELECT o_totalprice AS x, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders WHERE o_orderkey % 17 > 0"
Y_SQL = ("SELECT o_totalprice * 0.9 + 100 AS y, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS pos FROM orders "
         "WHERE o_orderkey % 17 > 0")


def _order_files(spark, d):
    o = _t(spark, d, "orders")
    kept = F.col("o_orderkey") % 17 > 0
    x = o.select(F.when(kept, F.col("o_totalprice")).alias("amount"), "o_orderkey")
    y = o.select(F.when(kept, F.col("o_totalprice") * 0.9 + 100).alias("amount"), "o_custkey", "o_orderkey")
    return (_ordered_csv(spark, x, ["o_orderkey"], "csv-x"), _ordered_csv(spark, y, ["o_custkey", "o_orderkey"], "csv-y"))


@register("paired_csv", (
    f"WITH pr AS (SELECT x, y FROM ({X_SQL}) JOIN ({Y_SQL}) USING (pos)), "
    "s AS (SELECT count(*) AS n, avg(x - y) AS md, var_samp(x - y) AS vd FROM pr), "
    "t AS (SELECT *, md / sqrt(vd / n) AS stat, (n - 1)::DOUBLE AS dfree FROM s) "
    f"SELECT n AS n_group1, n AS n_group2, round(stat, 4) AS statistic, dfree AS df, round({O.t_two_sided_sql('stat', 'dfree')}, 6) AS p_value FROM t"))
def q_paired_csv(spark, d):
    """C1 by position: observation i of one file with observation i of the other."""
    from twosample.sources.readers import csv_groups
    g = csv_groups(spark, *_order_files(spark, d), strict=True, positions=True)
    res = paired(g, "value", "grp", ("group1", "group2"), "pos", checks=False)
    return res.select("n_group1", "n_group2", r("statistic", 4).alias("statistic"), "df", r("p_value").alias("p_value"))


VECTOR_SQL = ("SELECT 0 AS _all, c_custkey AS cat, count(o_orderkey) FILTER (WHERE o_orderstatus = 'F')::DOUBLE AS observed, "
              "(count(o_orderkey) + 1)::DOUBLE AS expected FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")


@register("chisq_vectors", "WITH " + gof_sql(VECTOR_SQL, "_all", True) + " " + chisq_final_sql(()))
def q_chisq_vectors(spark, d):
    """D11 with whole values: observed[i] is fitted to expected[i], by line of two files."""
    from twosample.sources.readers import csv_groups
    o = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("f"), F.count("o_orderkey").alias("n"))
    c = _t(spark, d, "customer").select("c_custkey").join(o, "c_custkey", "left").fillna(0)
    paths = (_ordered_csv(spark, c.select(F.col("f").alias("observed"), "c_custkey"), ["c_custkey"], "csv-observed"),
             _ordered_csv(spark, c.select((F.col("n") + 1).alias("expected"), "c_custkey"), ["c_custkey"], "csv-expected"))
    res = run_test(csv_groups(spark, *paths, strict=True, positions=True), "chisquare", "value", "grp", ("group1", "group2"), position="pos")
    return res.select(r("statistic").alias("statistic"), r("df").alias("df"), r("p_value").alias("p_value"), F.col("rows_tested").alias("n_total"))


HEAD_ROWS = 5000        # fixed value: how many values feed a plot


@register("csv_head", (
    f"SELECT grp, count(*) AS n, round(avg(v), 4) AS mean, min(v) AS min, max(v) AS max FROM (SELECT 'group1' AS grp, x AS v, pos FROM ({X_SQL}) "
    f"UNION ALL SELECT 'group2', y, pos FROM ({Y_SQL})) WHERE pos < {HEAD_ROWS} GROUP BY grp"))
def q_csv_head(spark, d):
    """B4 by arrival: the first values of each file, without a column that orders them."""
    from twosample.sources.readers import csv_groups
    g = csv_groups(spark, *_order_files(spark, d), strict=True, head=HEAD_ROWS)
    return g.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), r(F.avg("value"), 4).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))


@register("csv_profile", (
    f"WITH t AS ({DIRTY_SQL}), c AS (SELECT l_returnflag, count(*) AS rows, count(*) FILTER (WHERE txt IS NULL) AS missing, "
    "count(*) FILTER (WHERE regexp_full_match(txt, '-?[0-9]+')) AS whole, count(*) FILTER (WHERE txt = 'NaN') AS fraction, "
    "count(*) FILTER (WHERE txt = 'n/a') AS other FROM t GROUP BY l_returnflag) "
    "SELECT l_returnflag, rows, missing, whole, fraction, other, CASE WHEN whole = rows - missing THEN 'bigint' "
    "WHEN whole + fraction = rows - missing THEN 'double' ELSE 'string' END AS inferred FROM c"))
def q_csv_profile(spark, d):
    """A1 types of one column of a CSV file: one scan that parses that column, no inference over all."""
    from twosample.session import scratch_path
    from twosample.sources.readers import column_profile, read_csv
    p = scratch_path(spark, "csv-dirty")
    _dirty(spark, d).write.option("header", True).csv(p)
    return column_profile(read_csv(spark, p), "txt", by=["l_returnflag"]).drop("boolean")


@register("result_sink", ttest_sql(LI_PRICE, (), True))
def q_result_sink(spark, d):
    """A4: the full result written as JSON documents by the executors and
    read back; the flat columns must survive the round trip."""
    from twosample.session import scratch_path
    from twosample.sources.sinks import write_results
    res = two_sample(_t(spark, d, "lineitem"), "l_extendedprice", "l_returnflag", ("A", "R"),
                     test="independent_ttest", checks=False)
    p = scratch_path(spark, "results")
    write_results(res, p, "json")
    back = spark.read.json(p)
    return back.select("n_group1", "n_group2", r("statistic").alias("statistic"),
                       r("df").alias("df"), r("p_value").alias("p_value"), "significant")


@register("inline_groups", ttest_sql(
    "SELECT 0 AS _all, 1 AS g, l_quantity AS v FROM lineitem WHERE l_quantity IS NOT NULL "
    "AND NOT isnan(l_quantity) UNION ALL SELECT 0, 2, l_discount * 100 FROM lineitem "
    "WHERE l_discount IS NOT NULL AND NOT isnan(l_discount * 100)", (), False))
def q_inline_groups(spark, d):
    """A2: request payloads (JSON arrays) built by Spark from lineitem, one per
    row, parsed and exploded on the executors, then a Welch test."""
    from twosample.sources.readers import json_groups
    li = _t(spark, d, "lineitem")
    payload = li.select(F.to_json(F.struct(
        F.array(F.col("l_quantity")).alias("group1"),
        F.array(F.col("l_discount") * 100).alias("group2"))).alias("payload"))
    res = two_sample(json_groups(payload, "payload"), "value", "grp", ("group1", "group2"),
                     test="welch_ttest", checks=False)
    return _flat_test(res)
