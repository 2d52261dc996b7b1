"""Input preparation: coercion, missing values, group labels.

Every test works on one canonical long frame::

    by..., g TINYINT (1 = first level, 2 = second), v DOUBLE

Two groups are two values of ``g`` in the same frame, so one aggregation
pass serves both, and ``by`` keys run many tests in one job.  With no ``by``
keys a constant key column ``_all`` is added, so every downstream operator
has the same shape (group on keys, join on keys); it is dropped from results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL_KEY = "_all"
SUPPORTED_TESTS = ("independent_ttest", "welch_ttest", "paired_ttest",
                   "mannwhitney", "chisquare")
ALPHA_MIN, ALPHA_MAX = 0.001, 0.1
ASSUMPTION_ALPHA = 0.05


def keys_for(by: Sequence[str]) -> list[str]:
    """Grouping keys used internally: the caller's ``by`` or the constant key."""
    by = list(by or [])
    return by if by else [ALL_KEY]


def constant_key(df: DataFrame) -> DataFrame:
    """Adds the constant key used when there are no ``by`` keys.

    Derived from a column (``hash(col) * 0``) rather than a literal: a literal
    key is folded by the optimizer and turns key joins into cross joins of a
    one-row side; a column-derived key keeps them ordinary broadcast hash
    joins.  Every row still carries the same key (0)."""
    return df.withColumn(ALL_KEY, (F.hash(F.col(df.columns[0])) * F.lit(0)).cast("int"))


def drop_internal(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df if by else df.drop(ALL_KEY)


def coerce_strict(c: Column) -> Column:
    """B1: cast to double; non-numeric text raises (ANSI cast)."""
    return c.cast("double")


def coerce_lenient(c: Column) -> Column:
    """B2: cast to double; non-numeric text becomes null."""
    return c.try_cast("double")


def is_usable(c: Column) -> Column:
    """Not null and not NaN."""
    return c.isNotNull() & ~F.isnan(c)


def significance_flag(p: Column, alpha: float | Column) -> Column:
    """``p < alpha`` strictly; NaN or null p is never significant."""
    a = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    return F.coalesce(is_usable(p) & (p < a), F.lit(False))


def assumption_flag(p: Column, level: float = ASSUMPTION_ALPHA) -> Column:
    """The assumption holds when ``p >= level``; NaN p does not hold
    (Spark orders NaN above every number, so test it explicitly)."""
    return F.when(p.isNull(), F.lit(None).cast("boolean")).otherwise(
        ~F.isnan(p) & (p >= F.lit(level)))


def check_alpha(alpha: float, bounded: bool = True) -> float:
    """Alpha must be a number in [0.001, 0.1] (the JSON route's bounds)."""
    try:
        a = float(alpha)
    except (TypeError, ValueError) as exc:
        raise ValueError(f"alpha must be a number, got {alpha!r}") from exc
    if bounded and not (ALPHA_MIN <= a <= ALPHA_MAX):
        raise ValueError(f"alpha must lie in [{ALPHA_MIN}, {ALPHA_MAX}], got {a}")
    if not (0.0 < a < 1.0):
        raise ValueError(f"alpha must lie in (0, 1), got {a}")
    return a


def check_test_name(test: str) -> str:
    """The test name must be one of the supported five."""
    if test not in SUPPORTED_TESTS:
        raise ValueError(
            f"unknown test {test!r}; choose one of {', '.join(sorted(SUPPORTED_TESTS))}")
    return test


def check_columns(df: DataFrame, *names: str | None) -> None:
    """Named columns must exist (schema only, no job)."""
    have = set(df.columns)
    missing = [n for n in names if n is not None and n not in have]
    if missing:
        raise ValueError(f"column(s) not found: {', '.join(missing)}")


def prepare(df: DataFrame, value: str, group: str | None = None,
            levels: Sequence | None = None, by: Sequence[str] = (),
            strict: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical ``(keys..., g, v)`` frame from a table with a group column.

    Rows whose group is not one of the two ``levels`` are filtered out (the
    filter reaches the parquet scan); values are coerced to double and
    missing values (null, NaN) dropped per group.  ``keep`` carries extra
    columns through (a pair key, a row key, a category).
    """
    by = list(by or [])
    keep = [k for k in (keep or []) if k not in by]
    check_columns(df, value, group, *by, *keep)
    cast = coerce_strict if strict else coerce_lenient
    if group is None:
        g = F.lit(1).cast("tinyint")
    else:
        if levels is None or len(levels) != 2:
            raise ValueError("levels must name exactly two groups")
        l1, l2 = levels
        if l1 == l2:
            raise ValueError("the two levels must differ")
        df = df.filter(F.col(group).isin(l1, l2))
        g = F.when(F.col(group) == F.lit(l1), F.lit(1)).otherwise(F.lit(2)).cast("tinyint")
    out = df.select(*[F.col(b) for b in by], *[F.col(k) for k in keep],
                    g.alias("g"), cast(F.col(value)).alias("v"))
    out = out.filter(is_usable(F.col("v")))
    return out if by else constant_key(out)


def stack_groups(df1: DataFrame, df2: DataFrame, value1: str, value2: str | None = None,
                 by: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """G1: two separate inputs (e.g. two files) as one canonical frame
    (UNION ALL with a literal group label)."""
    value2 = value2 or value1
    by = list(by or [])
    check_columns(df1, value1, *by)
    check_columns(df2, value2, *by)
    cast = coerce_strict if strict else coerce_lenient
    a = df1.select(*by, F.lit(1).cast("tinyint").alias("g"), cast(F.col(value1)).alias("v"))
    b = df2.select(*by, F.lit(2).cast("tinyint").alias("g"), cast(F.col(value2)).alias("v"))
    out = a.unionByName(b).filter(is_usable(F.col("v")))
    return out if by else constant_key(out)


def nan_if_null(c: Column) -> Column:
    """Undefined statistics (zero variance, too few rows) are NaN, not null."""
    return F.coalesce(c, F.lit(float("nan")))
