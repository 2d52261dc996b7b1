"""Property checks: invariances that must hold whatever
the data and however the rows are partitioned."""
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from twosample.operators.levene import levene
from twosample.operators.mannwhitney import mannwhitney
from twosample.operators.ttests import two_sample_t

KEYS = ["_all"]


def frame(spark, g1, g2, parts=None):
    rows = [(0, 1, float(v)) for v in g1] + [(0, 2, float(v)) for v in g2]
    df = spark.createDataFrame(rows, "_all int, g tinyint, v double")
    return df.repartition(parts) if parts else df


def one(df):
    return df.collect()[0]


samples = st.lists(st.integers(-50, 50), min_size=3, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=samples, b=samples, shift=st.integers(-1000, 1000), scale=st.integers(1, 50))
def test_shift_and_scale_invariance(spark, a, b, shift, scale):
    base_t = one(two_sample_t(frame(spark, a, b), KEYS, False))
    moved = [scale * x + shift for x in a], [scale * x + shift for x in b]
    t = one(two_sample_t(frame(spark, *moved), KEYS, False))
    if np.isnan(base_t.statistic):
        assert np.isnan(t.statistic)
    else:
        assert t.statistic == pytest.approx(base_t.statistic, rel=1e-9, abs=1e-9)
    u0 = one(mannwhitney(frame(spark, a, b), KEYS)).statistic
    u1 = one(mannwhitney(frame(spark, *moved), KEYS, parts=5)).statistic
    assert u0 == u1


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_partition_count_invariance(spark, parts):
    rng = np.random.default_rng(7)
    a, b = rng.normal(10, 2, 300).round(1), rng.normal(10.5, 3, 250).round(1)
    ref = (one(two_sample_t(frame(spark, a, b), KEYS, True)),
           one(mannwhitney(frame(spark, a, b), KEYS)), one(levene(frame(spark, a, b), KEYS)))
    got = (one(two_sample_t(frame(spark, a, b, parts), KEYS, True)),
           one(mannwhitney(frame(spark, a, b, parts), KEYS, parts=5)),
           one(levene(frame(spark, a, b, parts), KEYS, parts=5)))
    assert got[0].statistic == pytest.approx(ref[0].statistic, rel=1e-12)
    assert got[1].statistic == ref[1].statistic and got[1].p_value == pytest.approx(ref[1].p_value)
    assert got[2].levene_w == pytest.approx(ref[2].levene_w, rel=1e-12)
