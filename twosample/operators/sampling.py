"""Row caps and sampling (F1s, F2s, B4).

Exact-size, reproducible per-group samples: every row has a 60-bit number from
the md5 of a seed and its row key; a group keeps its ``k`` rows with the
smallest (number, key).  The k smallest of a union are among the k smallest of its
parts, so one scan is enough: each task keeps the k smallest of every group it
meets, a shuffle by (group, part of the number range) and the same step leave
``SPREAD`` times k rows a group at most, and a window picks among these.
B4 picks the first k by an order column behind a coarse limit from a
quantile sketch of the column; a group whose limit let too few through is picked from
all its rows instead.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twosample.operators.ranks import attach_stats, few_keys, null_safe

DEFAULT_SAMPLE_ROWS = 10_000    # fixed value: rows kept per group
DEFAULT_SEED = 42               # fixed value
SPREAD = 32                     # tasks that meet a group after the first step
HELD_ROWS = 2_000_000           # rows that a task keeps before it hands them on
HASH_DIGITS = 15                # hex digits of the md5: numbers below 16 ** 15


def row_number_hash(seed: int, row_key: Sequence[str]) -> Column:
    """The first 60 bits of md5(seed | key | ...), null keys as empty text."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in row_key])
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("long")


def _pick(rows: DataFrame, keys: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def _first(frame: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, limits: DataFrame, small: bool) -> DataFrame:
    """The first ``k`` rows per key by ``order``, given coarse ``limits``
    (keys, _n, _limit) on the first order column."""
    rows = attach_stats(frame, limits, keys, order[0], small)
    coarse = rows.filter(F.col(order[0]) <= F.col("_limit"))
    # keys whose limit was too low; the others' rows never meet this branch
    got = coarse.groupBy(*keys).agg(F.count(F.lit(1)).alias("_got"))
    short = (limits.select(*keys, "_n", F.lit(0).alias("_got")).unionByName(got.withColumn("_n", F.lit(0).cast("long")))
             .groupBy(*keys).agg(F.max("_n").alias("_n"), F.max("_got").alias("_got"))
             .filter(F.col("_got") < F.least("_n", F.lit(k))).select(*keys))
    rest = attach_stats(frame, short, keys, order[0], small)
    enough = coarse.join(F.broadcast(short) if small else short, list(keys), "left_anti")
    return _pick(enough.select(*frame.columns).unionByName(rest.select(*frame.columns)), keys, order, k)


def _prune(rows: pa.Table, k: int) -> pa.Table:
    """The rows with the ``k`` smallest numbers of each group, and those that tie with the last."""
    g, h = rows.column("_group").to_numpy(), rows.column("_h").to_numpy()
    order = np.lexsort((h, g))
    g, h = g[order], h[order]
    start = np.maximum.accumulate(np.where(np.r_[True, g[1:] != g[:-1]], np.arange(len(g)), 0))
    rank = np.arange(len(g)) - start
    last = h[np.minimum(start + k - 1, len(g) - 1)]
    return rows.take(order[(rank < k) | (h == last)])


def _smallest(k: int):
    """Keeps the ``k`` smallest of each group of a task; where there are too many groups for
    its memory, hands on what it has, which loses nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, full = [], 0, max(4 * k, 50_000)
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= full:
                rows = _prune(pa.Table.from_batches(held), k)
                held, n = rows.to_batches(), rows.num_rows
                full = max(full, 2 * n)
                if n > HELD_ROWS:
                    yield from rows.to_batches(max_chunksize=10_000)
                    held, n = [], 0
        if n:
            yield from _prune(pa.Table.from_batches(held), k).to_batches(max_chunksize=10_000)
    return run


@null_safe
def sample_groups(frame: DataFrame, keys: Sequence[str], k: int = DEFAULT_SAMPLE_ROWS,
                  row_key: Sequence[str] | None = None, seed: int = DEFAULT_SEED) -> DataFrame:
    """F1s: exactly ``min(k, n)`` rows per ``(keys, g)`` group, by seeded hash.

    ``row_key`` should tell rows apart; by default all columns do, so that only
    rows equal in all of them are interchangeable."""
    gk = [*keys, "g"]
    row_key = list(row_key or [c for c in frame.columns if c not in keys])
    rows = frame.withColumn("_h", row_number_hash(seed, row_key)).withColumn("_group", F.xxhash64(*gk))
    if k < 1:
        return frame.limit(0)
    few = rows.mapInArrow(_smallest(k), rows.schema)
    few = few.repartition(*gk, F.pmod("_h", F.lit(SPREAD))).mapInArrow(_smallest(k), rows.schema)
    return _pick(few.drop("_group"), gk, ["_h", *[c for c in row_key if c in frame.columns], "v"], k).drop("_h")


@null_safe
def head_cap(frame: DataFrame, keys: Sequence[str], order: Sequence[str] | str, k: int = 5000) -> DataFrame:
    """Exactly the first ``min(k, n)`` rows per ``(keys, g)`` group by
    ``order`` (one or more columns that tell rows apart, then the value)."""
    gk = [*keys, "g"]
    order = [order] if isinstance(order, str) else list(order)
    st = frame.groupBy(*gk).agg(F.count(F.lit(1)).alias("_n"), F.max(order[0]).alias("_max"), F.percentile_approx(
        order[0], [min(1.0, q / 1000) for q in range(1, 1001)], 20_000).alias("_q"))
    # the first permille mark past k rows, with the sketch's error to spare
    mark = F.ceil((F.lit(float(k)) / F.col("_n") + F.lit(3e-4)) * 1000)
    limits = st.select(*gk, "_n", F.when(mark >= 1000, F.col("_max")).otherwise(
        F.get("_q", (F.least(mark, F.lit(1000)) - 1).cast("int"))).alias("_limit"))
    return _first(frame, gk, [*order, "v"], k, limits, few_keys(frame, keys))


def limit_rows(df: DataFrame, n: int, order: Sequence[str] | None = None) -> DataFrame:
    """F2s: a row cap; ordered when ``order`` is given (top-n is then exact
    and Spark plans it as TakeOrderedAndProject, a per-task top-n)."""
    return (df.orderBy(*order) if order else df).limit(n)
