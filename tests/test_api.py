"""Public API: dispatcher, checks, sources and sinks, registered queries."""
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from twosample import paired, run_test, two_sample
from twosample.operators.prepare import check_alpha, check_test_name
from twosample.sources import as_json, csv_group, csv_groups, inline_groups, inline_json, write_results

from conftest import SF


def test_unknown_test_and_alpha_bounds():
    with pytest.raises(ValueError):
        check_test_name("invalid_test")
    with pytest.raises(ValueError):
        check_alpha(0.5)
    assert check_alpha(0.001) == 0.001


def test_run_test_all_five(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    for name in ("independent_ttest", "welch_ttest", "mannwhitney", "chisquare"):
        r = run_test(li, name, "l_extendedprice", "l_returnflag", ("A", "R")).collect()
        assert len(r) == 1 and r[0].test_name == name
        assert isinstance(r[0].verdict, str) and r[0].p_value == r[0].p_value
    p = run_test(li, "paired_ttest", "l_quantity", "l_linenumber", (1, 2),
                 pair_key="l_orderkey", require_complete=False).collect()[0]
    assert p.rows_tested % 2 == 0 and p.assumption_checks.normality_of_differences is not None


def test_full_result_schema_and_recommendation(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    r = two_sample(ev, "value", "event_type", ("click", "purchase")).collect()[0]
    ac = r.assumption_checks
    assert ac.normality_group1.test_used == "shapiro-wilk"
    assert ac.equal_variance.statistic >= 0
    if ac.normality_group1.is_normal is False or ac.normality_group2.is_normal is False:
        assert "Mann-Whitney" in r.recommendation
    assert r.group_stats.group1["count"] == r.n_group1
    assert r.total_rows == r.n_group1 + r.n_group2 == r.rows_tested


def test_by_keys_one_row_each(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    res = two_sample(o, "o_totalprice", "o_orderstatus", ("F", "O"), test="welch_ttest",
                     by=["o_orderpriority"], checks=False)
    assert res.count() == o.select("o_orderpriority").distinct().count()


def test_significance_at_alpha_boundary(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    r = two_sample(li, "l_extendedprice", "l_returnflag", ("A", "R"), checks=False).collect()[0]
    # p equal to alpha is not significant (strict <)
    from twosample.operators.prepare import significance_flag
    df = spark.createDataFrame([(0.05,), (float("nan"),), (0.01,)], "p double")
    got = [x[0] for x in df.select(significance_flag(F.col("p"), 0.05)).collect()]
    assert got == [False, False, True]
    assert "significance level 0.05" in r.verdict


def test_csv_source_crlf_first_column_and_strict(spark, tmpdir_session):
    path = os.path.join(tmpdir_session, "g1.csv")
    with open(path, "w", newline="") as f:
        f.write("score,other\r\n1.5,a\r\n2.5,b\r\n,c\r\n4,d\r\n")
    g = csv_group(spark, path)
    assert sorted(r.value for r in g.collect()) == [1.5, 2.5, 4.0]
    bad = os.path.join(tmpdir_session, "bad.csv")
    with open(bad, "w") as f:
        f.write("x\n1\nabc\n")
    assert [r.value for r in csv_group(spark, bad).collect()] == [1.0]
    with pytest.raises(Exception):
        csv_group(spark, bad, schema="x string", strict=True).collect()
    both = csv_groups(spark, path, path)
    assert both.groupBy("grp").count().count() == 2


def test_inline_groups_and_json(spark):
    df = inline_groups(spark, [1, 2, 3], [4, 5])
    assert [(r.grp, r.pos, r.value) for r in df.orderBy("grp", "pos").collect()][-1] == ("group2", 1, 5.0)
    j = inline_json(spark, json.dumps({"group1": [1.0, 2.0], "group2": [3.0]}))
    assert j.count() == 3
    r = two_sample(df, "value", "grp", ("group1", "group2"), test="mannwhitney").collect()[0]
    assert r.statistic == 0.0


def test_result_sink_roundtrip(spark, tmpdir_session):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    res = two_sample(li, "l_extendedprice", "l_returnflag", ("A", "R"), checks=False)
    out = os.path.join(tmpdir_session, "res_json")
    write_results(res, out)
    back = spark.read.json(out).collect()[0]
    assert back.test_name == "independent_ttest"
    assert json.loads(res.select(as_json(res)).collect()[0][0])["n_group1"] == back.n_group1


@pytest.mark.parametrize("name", ["ttest_independent", "ttest_welch", "ttest_paired", "mannwhitney",
                                  "levene", "chisq_binned", "chisq_gof_expected", "box_stats",
                                  "midrank", "group_summary", "verdict_text", "hist_density"])
def test_registered_queries_match_duckdb(spark, name):
    from __spark_entry__ import oracle_sql, queries
    from twosample.sources.readers import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    rel = con.sql(oracle_sql()[name])
    assert sorted(rel.columns) == cols

    def norm(x):
        return repr(round(x, 9)) if isinstance(x, float) else repr(x)
    a = sorted(tuple(norm(r[c]) for c in cols) for r in sdf.collect())
    b = sorted(tuple(norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert a == b


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert len(rows) == 1 and rows[0].test_name == "independent_ttest"


def test_many_by_keys_match_pandas(spark):
    """Rank and median machinery with ~100 keys (sf0.01 suppliers): every
    key's U and Levene W equal a direct pandas / NumPy computation."""
    import numpy as np
    import pandas as pd
    from twosample.operators.levene import levene
    from twosample.operators.prepare import prepare
    d = "/root/testdata/sf0.01"
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    res = two_sample(li, "l_quantity", "l_returnflag", ("A", "R"), test="mannwhitney",
                     by=["l_suppkey"]).select("l_suppkey", "statistic").toPandas()
    lv = levene(prepare(li, "l_extendedprice", "l_returnflag", ("A", "R"), by=["l_suppkey"]),
                ["l_suppkey"]).select("l_suppkey", "levene_w").toPandas()
    pdf = pd.read_parquet(f"{d}/lineitem.parquet",
                          columns=["l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"])
    pdf = pdf[pdf.l_returnflag.isin(["A", "R"])]
    got_u = dict(zip(res.l_suppkey, res.statistic))
    got_w = dict(zip(lv.l_suppkey, lv.levene_w))
    assert len(got_u) == pdf.l_suppkey.nunique()
    for k, sub in pdf.groupby("l_suppkey"):
        a = sub.l_returnflag == "A"
        r = sub.l_quantity.rank()
        assert got_u[k] == pytest.approx(r[a].sum() - a.sum() * (a.sum() + 1) / 2)
        x, y = sub.l_extendedprice[a].values, sub.l_extendedprice[~a].values
        if len(x) > 1 and len(y) > 1:
            zx, zy = np.abs(x - np.median(x)), np.abs(y - np.median(y))
            z = np.concatenate([zx, zy])
            n1, n2 = len(x), len(y)
            w = (n1 + n2 - 2) * (n1 * (zx.mean() - z.mean()) ** 2 + n2 * (zy.mean() - z.mean()) ** 2) \
                / ((n1 - 1) * zx.var(ddof=1) + (n2 - 1) * zy.var(ddof=1))
            assert got_w[k] == pytest.approx(w, rel=1e-9)


def test_json_groups_column_parsed_on_executors(spark):
    from twosample.sources import json_groups
    df = spark.createDataFrame([('{"group1": [1.0, 2.0], "group2": [5.0]}',),
                                ('{"group1": [3.0], "group2": [6.0, 7.0, 8.0]}',)], "payload string")
    rows = sorted((r.grp, r.value) for r in json_groups(df, "payload").collect())
    assert rows == [("group1", 1.0), ("group1", 2.0), ("group1", 3.0),
                    ("group2", 5.0), ("group2", 6.0), ("group2", 7.0), ("group2", 8.0)]
