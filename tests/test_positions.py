"""Positions in file order: pairing by line, count vectors, first rows, column types."""
import glob
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from twosample import paired, run_test, two_sample
from twosample.sources import column_profile, csv_group, csv_groups, first_rows, inline_groups, read_csv, with_positions


def write(lines, name=None):
    path = name or os.path.join(tempfile.mkdtemp(prefix="twosample-pos-"), "g.csv")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write("\r\n".join(["value", *map(str, lines)]) + "\r\n")
    return path


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("few", [True, False])
def test_positions_run_over_files_and_splits(spark, small_splits, few, monkeypatch):
    from twosample.sources import positions
    if not few:                                     # offsets by a window over the splits, joined by shuffle
        monkeypatch.setattr(positions, "BROADCAST_SPLITS", 0)
    folder, want = tempfile.mkdtemp(prefix="twosample-pos-"), []
    for k, n in enumerate([300, 0, 7, 1500]):
        part = [10_000 * k + i if i % 5 else "" for i in range(n)]
        write(part, f"{folder}/part-{k:03d}.csv")
        want += [float(x) for x in part if x != ""]
    got = csv_group(spark, folder, positions=True)
    assert spark.read.csv(folder).rdd.getNumPartitions() > 5
    rows = sorted((r.pos, r.value) for r in got.collect())
    assert rows == list(enumerate(want))
    assert [r.value for r in with_positions(read_csv(spark, folder).filter("value is not null")).orderBy("pos").select(
        F.col("value").cast("double").alias("value")).collect()] == want


def test_first_rows_read_no_later_file(spark, small_splits):
    folder = tempfile.mkdtemp(prefix="twosample-pos-")
    for k in range(6):
        write(range(1000 * k, 1000 * k + 400), f"{folder}/part-{k:03d}.csv")
    df = read_csv(spark, folder)
    for late in glob.glob(f"{folder}/part-005.csv"):
        os.truncate(late, 0)                        # a scan of it would fail or give no row
    got = first_rows(df.select(F.col("value").cast("int").alias("v")), 700)
    assert sorted(r.v for r in got.collect()) == [*range(400), *range(1000, 1300)]
    assert first_rows(df, 0).count() == 0
    assert csv_group(spark, write(range(5)), head=9).count() == 5


def test_pairs_by_line(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(5, 2, 400).round(6)
    y = (x + rng.normal(0.1, 1, 400)).round(6)
    # missing values are dropped on each side before lines are paired
    lines_x = [v for k, v in enumerate(x) for v in ([v, ""] if k % 50 == 0 else [v])]
    g = csv_groups(spark, write(lines_x), write(y), positions=True)
    r = paired(g, "value", "grp", ("group1", "group2"), "pos", checks=False).collect()[0]
    d = x - y
    assert r.n_group1 == r.n_group2 == 400 and r.rows_tested == 800
    assert r.statistic == pytest.approx(d.mean() / (d.std(ddof=1) / 20), rel=1e-9)


def test_unequal_lengths_are_an_error(spark):
    g = csv_groups(spark, write([1, 2, 3]), write([2, 4]), positions=True)
    for sample in (None, 2):
        with pytest.raises(Exception, match="1 pair keys lack"):
            paired(g, "value", "grp", ("group1", "group2"), "pos", checks=False, sample_rows=sample).collect()
    r = paired(g, "value", "grp", ("group1", "group2"), "pos", checks=False, require_complete=False).collect()[0]
    assert r.rows_tested == 4
    with pytest.raises(Exception, match="equal length"):
        run_test(g, "chisquare", "value", "grp", ("group1", "group2"), position="pos").collect()


def test_count_vectors_are_fitted_by_position(spark):
    obs, exp = [18, 55, 27, 0], [20, 50, 28, 4]
    g = inline_groups(spark, obs, exp)
    r = two_sample(g, "value", "grp", ("group1", "group2"), test="chisquare", position="pos").collect()[0]
    e = np.array(exp) * sum(obs) / sum(exp)
    assert r.statistic == pytest.approx(((np.array(obs) - e) ** 2 / e).sum(), rel=1e-12)
    assert r.df == 3 and r.variant == "goodness_of_fit" and r.n_group1 == 100
    # one value that is not whole: both vectors are samples, and lengths may differ
    g = inline_groups(spark, obs + [0.5], exp)
    assert two_sample(g, "value", "grp", ("group1", "group2"), test="chisquare", position="pos").collect()[0].variant == "binned"
    with pytest.raises(ValueError, match="position"):
        two_sample(g, "value", "grp", ("group1", "group2"), test="welch_ttest", position="pos")


def test_positions_need_files(spark):
    with pytest.raises(ValueError, match="files"):
        with_positions(spark.range(3))


def test_positions_of_nothing(spark):
    assert csv_group(spark, write([]), positions=True).count() == 0


def test_column_profile(spark):
    df = spark.createDataFrame([("1", "1", "true", "x"), (" 2 ", "2.5", "FALSE", None), (None, "1e3", "", "3"), ("", "NaN", None, "-inf")],
                               "a string, b string, c string, d string")
    kinds = {c: column_profile(df, c).collect()[0] for c in "abcd"}
    assert {c: r.inferred for c, r in kinds.items()} == {"a": "bigint", "b": "double", "c": "boolean", "d": "string"}
    assert (kinds["a"].missing, kinds["a"].whole, kinds["b"].whole, kinds["b"].fraction, kinds["d"].other) == (2, 2, 1, 3, 1)
    assert column_profile(df.filter("a is null"), "a").collect()[0].inferred == "void"


def test_text_columns_are_not_inferred(spark):
    plan = csv_group(spark, write([1, 2]))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<value:string>" in plan


def test_shapiro_limit_is_a_parameter(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(g, float(v)) for g in "ab" for v in rng.exponential(1, 60)], "grp string, v double")
    for limit, used in ((5000, "shapiro-wilk"), (50, "skipped_large_sample")):
        c = two_sample(df, "v", "grp", ("a", "b"), max_n=limit).collect()[0].assumption_checks.normality_group1
        assert c.test_used == used and c.is_normal == (limit == 50)
        assert (f"over 60 values; no p-value above {limit}" in c.interpretation) == (limit == 50)


def test_a_plain_ttest_reads_its_table_once(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    for test in ("independent_ttest", "welch_ttest"):
        plan = two_sample(li, "l_extendedprice", "l_returnflag", ("A", "R"), test=test, checks=False)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
