"""Distributed ordering primitives: mid-ranks, exact quantiles, positions.

A rank or an exact quantile needs, for every value, the number of values
below it in its group.  ``rank() over (partition by key order by v)`` would
send a whole group -- possibly a third of the table -- to one task.  Instead:

1. collapse ties: ``groupBy(keys, v).count()`` (map-side partial aggregation,
   so a hot value costs one row, not a hot task);
2. range-partition and sort the distinct values by (keys, value), so a hot key
   is spread over as many partitions as it fills, and add running counts per
   (key, partition) in one streaming pass;
3. totals per (key, partition) give each partition's first position through a
   window over that tiny table (at most keys + partitions rows), which is joined back.

The streaming pass takes all columns, so nothing above it prunes columns below it:
the branches that need totals and rows share one range exchange.  Every row
checks that its value lies in the span that its partition's totals name, so two
exchanges with different bounds could only end in an error, never in a wrong rank.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twosample.operators.prepare import ALL_KEY

# A quantile's bracket (see ``squeeze``): sketch accuracy, its margin in rank,
# and the group size up to which the bracket is the whole range.
SKETCH = 10_000
MARGIN = 4 / SKETCH
WHOLE_ROWS = 20_000

# Keys that a per-key table may have to be broadcast to raw rows.
BROADCAST_KEYS = 20_000

_SAFE = "_null_safe_key"


def null_safe(fn):
    """Operators group and join on ``by`` keys that can be null.  Inside the
    decorated operator each key is a struct around its value: a struct is
    never null itself and equal structs may hold nulls, so plain equi-joins
    keep the null key.  Results carry the plain keys again."""
    @wraps(fn)
    def run(frame, keys, *args, **kw):
        plain = [k for k in keys if k not in (ALL_KEY, "g")]
        if not plain or all(isinstance(frame.schema[k].dataType, T.StructType)
                            and frame.schema[k].dataType.names == [_SAFE] for k in plain):
            return fn(frame, keys, *args, **kw)

        def wrap(x):
            if not isinstance(x, DataFrame) or not set(plain) <= set(x.columns):
                return x
            return x.withColumns({k: F.struct(F.col(k).alias(_SAFE)) for k in plain})

        out = fn(wrap(frame), keys, *map(wrap, args), **{k: wrap(v) for k, v in kw.items()})
        return out.withColumns({k: F.col(k)[_SAFE] for k in plain})
    return run


def few_keys(frame: DataFrame, keys: Sequence[str], limit: int = BROADCAST_KEYS) -> bool:
    """Whether a table with one row per key is small enough to broadcast.
    Without ``by`` keys it has two rows at most; else the distinct keys are
    counted, up to the limit (a scan of the key columns)."""
    by = [k for k in keys if k not in (ALL_KEY, "g")]
    return not by or frame.select(*by).distinct().limit(limit + 1).count() <= limit


def attach_stats(rows: DataFrame, table: DataFrame, keys: Sequence[str], spread: str, small: bool) -> DataFrame:
    """A one-row-per-key table joined onto raw rows: broadcast if its keys are
    known to be few, so that the rows do not move; else salted."""
    return rows.join(F.broadcast(table), list(keys)) if small else attach(rows, table, keys, spread, "inner")


def squeeze(frame: DataFrame, keys: Sequence[str], probs: Sequence[float], value: str, small: bool,
            whole_rows: int = WHOLE_ROWS) -> DataFrame:
    """``(keys, value, _in)`` with few distinct values, and the same values
    near the quantiles ``probs``.

    A sketch per key brackets each quantile.  Values in a bracket stay (``_in``
    = 1); any other becomes the end of the bracket below it, or -infinity.
    Order is kept, so positions are, too, and nearly all rows collapse before
    they are shuffled.  Groups of up to ``whole_rows`` rows stay as they are."""
    marks = [q for p in sorted(probs) for q in (max(0.0, p - MARGIN), min(1.0, p + MARGIN))]
    st = frame.groupBy(*keys).agg(F.count(value).alias("_n"), F.min(value).alias("_min"), F.max(value).alias("_max"),
                                  F.percentile_approx(value, marks, SKETCH).alias("_marks"))
    rows = attach_stats(frame.select(*keys, value), st, keys, value, small)
    v, inside, floor = F.col(value), F.lit(False), F.lit(float("-inf"))
    for j, p in enumerate(sorted(probs)):
        lo = F.col("_min") if p <= MARGIN else F.when(F.col("_n") <= whole_rows, F.col("_min")).otherwise(F.col("_marks")[2 * j])
        hi = F.col("_max") if p >= 1 - MARGIN else F.when(F.col("_n") <= whole_rows, F.col("_max")).otherwise(F.col("_marks")[2 * j + 1])
        inside = inside | ((v >= lo) & (v <= hi))
        floor = F.when(v > hi, hi).otherwise(floor)
    return rows.select(*keys, F.when(inside, v).otherwise(floor).alias(value), inside.cast("long").alias("_in"))


def value_counts(frame: DataFrame, keys: Sequence[str], value: str = "v",
                 extra: Sequence[Column] = ()) -> DataFrame:
    """``(keys, value, t[, extra...])`` with ties collapsed."""
    return frame.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("t"), *extra)


def _solid_counts(frame: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Value counts with ``tin``, the copies that were not collapsed into the value."""
    solid = F.col("_in") if "_in" in frame.columns else F.lit(1)
    return value_counts(frame, keys, value, [F.sum(solid).alias("tin")])


# Joins keyed by the ``by`` keys alone are salted: a distinct value's salt is
# a hash of the value, and the per-key table is replicated once per salt.  If
# AQE broadcasts the table nothing changes; if the table is too large to
# broadcast (very many keys), a hot key's rows still spread over SALTS tasks.
SALTS = 32


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], spread: str,
           how: str = "left", salts: int | None = None) -> DataFrame:
    """Join a one-row-per-key table onto many rows, skew-safe.

    ``spread`` names a row column whose values are (nearly) unique within a
    key -- a distinct value, a row hash -- and its hash is the salt.  The
    table side is replicated once per salt, so when it is too large for AQE
    to broadcast, a key holding a third of the rows is still spread over
    ``salts`` join tasks.  Deterministic: a retried task salts identically.
    """
    n = SALTS if salts is None else salts
    salt = F.pmod(F.xxhash64(F.col(spread)), F.lit(n)).cast("int")
    t = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return rows.withColumn("_salt", salt).join(t, [*keys, "_salt"], how).drop("_salt")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with ``_h`` (hash of the key) and ``t``: adds the partition's number
    ``_b`` and ``_pre``, the copies before the row in its (key, partition)."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        h, t = batch.column("_h").to_numpy(), batch.column("t").to_numpy()
        before = np.cumsum(t) - t
        new = np.r_[last is None or h[0] != last, h[1:] != h[:-1]]
        start = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
        pre = np.where(start < 0, before + seen, before - before[start])       # negative: the key of the batch before goes on
        last, seen = h[-1], int(pre[-1] + t[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(h), part, np.int32)), pa.array(pre.astype(np.int64))],
                                         names=[*batch.schema.names, "_b", "_pre"])


def ordered(vc: DataFrame, keys: Sequence[str], value: str = "v", parts: int | None = None) -> DataFrame:
    """``vc`` (keys, value, t, ...; distinct values) range-partitioned and sorted, with
    ``_b`` and ``_pre``.  ``parts``: partitions, by default ``spark.sql.shuffle.partitions``."""
    n = parts or int(vc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = vc.withColumn("_h", F.xxhash64(*keys)).repartitionByRange(n, *keys, value).sortWithinPartitions(*keys, value)
    schema = T.StructType([*rows.schema.fields, T.StructField("_b", T.IntegerType()), T.StructField("_pre", T.LongType())])
    return rows.mapInArrow(_running, schema).drop("_h")


def bucket_starts(bt: DataFrame, keys: Sequence[str], total: str = "_T") -> DataFrame:
    """Adds ``_start`` (rows in earlier buckets) and ``_n`` (rows in the key)."""
    w = Window.partitionBy(*keys).orderBy("_b")
    return (bt.withColumn("_start", F.coalesce(
                F.sum(total).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0)).cast("long"))
              .withColumn("_n", F.sum(total).over(Window.partitionBy(*keys)).cast("long")))


def _positions(vc: DataFrame, keys: Sequence[str], value: str, parts: int | None, small: bool) -> DataFrame:
    """``vc`` with ``before`` (copies of smaller values in the key) and ``n`` (all copies)."""
    rows = ordered(vc, keys, value, parts)
    spans = bucket_starts(rows.groupBy(*keys, "_b").agg(F.sum("t").alias("_T"), F.min(value).alias("_lo"), F.max(value).alias("_hi")), keys)
    spans = spans.select(*keys, "_b", "_start", "_lo", "_hi", F.col("_n").alias("n"))
    placed = rows.join(F.broadcast(spans) if small else spans, [*keys, "_b"])
    apart = F.raise_error(F.lit("range partitions differ between two reads of one exchange")).cast("long")
    return placed.select(*vc.columns, F.when((F.col(value) >= F.col("_lo")) & (F.col(value) <= F.col("_hi")),
                                             F.col("_start") + F.col("_pre")).otherwise(apart).alias("before"), "n")


@null_safe
def value_positions(frame: DataFrame, keys: Sequence[str], value: str = "v", parts: int | None = None) -> DataFrame:
    """E1/E2 building block: one row per distinct value with
    ``t`` (copies), ``before`` (values strictly below, 0-based first position)
    and ``n`` (group size).  Mid-rank = before + (t + 1) / 2."""
    return _positions(value_counts(frame, keys, value), keys, value, parts, few_keys(frame, keys))


@null_safe
def midranks(frame: DataFrame, keys: Sequence[str], value: str = "v", parts: int | None = None) -> DataFrame:
    """Average rank of each distinct value within its key (ties share)."""
    pos = value_positions(frame, keys, value, parts)
    return pos.withColumn("midrank", F.col("before") + (F.col("t") + F.lit(1)) / F.lit(2.0))


@null_safe
def rank_sums(frame: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Mann-Whitney building block over a canonical ``(keys, g, v)`` frame.

    Returns one row per key: ``n1, n2, r1`` (sum of group-1 mid-ranks over
    the pooled sample), ``tie_term`` = sum(t^3 - t) and ``max_tie``.  Ranks
    are never materialised per row: sums per (key, partition) are shifted by the
    partition's first position."""
    vc = value_counts(frame, keys, "v", [F.count(F.when(F.col("g") == 1, F.lit(1))).alias("t1")])
    td = F.col("t").cast("double")
    per_b = ordered(vc, keys, "v", parts).groupBy(*keys, "_b").agg(
        F.sum("t").alias("_T"),
        F.sum("t1").alias("_C1"),
        F.sum(F.col("t1").cast("double") * (F.col("_pre") + (td + 1.0) / 2.0)).alias("_W1"),
        F.sum(td * td * td - td).alias("_ties"),
        F.max("t").alias("_maxt"))
    per_b = bucket_starts(per_b, keys)
    return per_b.groupBy(*keys).agg(
        F.sum("_C1").alias("n1"),
        (F.sum("_T") - F.sum("_C1")).alias("n2"),
        F.sum(F.col("_C1").cast("double") * F.col("_start") + F.col("_W1")).alias("r1"),
        F.sum("_ties").alias("tie_term"),
        F.max("_maxt").alias("max_tie"))


def _at(frame: DataFrame, keys: Sequence[str], targets: Sequence[Column], value: str, parts: int | None, small: bool) -> DataFrame:
    """(keys, n, _x0, _x1, ...): the values at the positions ``targets`` (columns over ``n``).
    In a squeezed frame a position on a collapsed row finds nothing; a value's
    collapsed copies, which are larger values, come behind its own."""
    pos = _positions(_solid_counts(frame, keys, value), keys, value, parts, small)
    inside = [(F.col("before") <= at) & (at < F.col("before") + F.col("tin")) for at in targets]
    return pos.groupBy(*keys).agg(F.max("n").alias("n"), *[
        F.max(F.when(c, F.col(value))).cast("double").alias(f"_x{k}") for k, c in enumerate(inside)])


@null_safe
def values_at(frame: DataFrame, keys: Sequence[str], probs: Sequence[float], targets: Sequence[Column], value: str = "v",
              parts: int | None = None, small: bool | None = None, whole_rows: int = WHOLE_ROWS) -> DataFrame:
    """(keys, n, _x0, _x1, ...): exact values at 0-based positions that lie near the
    quantiles ``probs``; ``targets`` are columns over ``n``, the size of the key.

    Values far from the quantiles are collapsed first (``squeeze``).  That selection is
    certified: a key one of whose positions falls on a collapsed row, as a sketch worse than
    its bound could bring about, is selected again from all its values."""
    small = few_keys(frame, keys) if small is None else small
    got = _at(squeeze(frame, keys, probs, value, small, whole_rows), keys, targets, value, parts, small)
    lost = F.greatest(*[F.col(f"_x{k}").isNull() for k in range(len(targets))]) if len(targets) > 1 else F.col("_x0").isNull()
    keys_lost = got.filter(lost).select(*keys)
    # adaptive execution drops this branch, scan included, when no key is lost
    again = _at(frame.select(*keys, value).join(F.broadcast(keys_lost) if small else keys_lost, list(keys), "left_semi"), keys, targets, value, parts, small)
    return got.filter(~lost).unionByName(again)


@null_safe
def exact_quantiles(frame: DataFrame, keys: Sequence[str], probs: Sequence[float],
                    value: str = "v", parts: int | None = None,
                    small: bool | None = None, whole_rows: int = WHOLE_ROWS) -> DataFrame:
    """Exact linearly interpolated quantiles per key (position (n-1)p), the
    definition of ``percentile`` / ``quantile_cont`` -- without holding a
    group's values in one aggregation buffer, and without shuffling values
    far from the quantiles (``values_at``).

    Returns one row per key with columns ``q0, q1, ...`` in ``probs`` order
    and ``n``.
    """
    targets = []
    for p in probs:
        lo = F.floor((F.col("n") - 1).cast("double") * F.lit(float(p))).cast("long")
        targets += [lo, F.least(lo + 1, F.col("n") - 1)]
    out = values_at(frame, keys, probs, targets, value, parts, small, whole_rows)
    for j, p in enumerate(probs):
        h = (F.col("n") - 1).cast("double") * F.lit(float(p))
        frac = h - F.floor(h)
        lo_v, hi_v = F.col(f"_x{2 * j}"), F.col(f"_x{2 * j + 1}")
        out = out.withColumn(f"q{j}", F.when(frac == 0, lo_v)
                             .otherwise(lo_v + frac * (hi_v - lo_v)))
    return out.select(*keys, "n", *[f"q{j}" for j in range(len(probs))])


@null_safe
def observation_ranks(frame: DataFrame, keys: Sequence[str], value: str = "v",
                      chunk: int = 65536, parts: int | None = None) -> DataFrame:
    """One row per observation with its 1-based
    rank ``i`` in sorted order and the group size ``n``.

    Tied copies of a value are expanded from ``(value, t, before)`` in chunks
    of at most ``chunk`` ranks; the chunk rows are hash-repartitioned before
    the final expansion, so a value holding a third of the table is spread
    over all tasks instead of exploding inside one.
    """
    pos = value_positions(frame, keys, value, parts)
    nchunks = ((F.col("t") + F.lit(chunk - 1)) / F.lit(chunk)).cast("long")
    chunks = pos.select(*keys, value, "t", "before", "n",
                        F.explode(F.sequence(F.lit(0).cast("long"),
                                             nchunks - 1)).alias("_c"))
    chunks = chunks.repartition(*keys, value, "_c")
    first = F.col("before") + F.col("_c") * F.lit(chunk) + 1
    last = F.least(F.col("before") + F.col("t"),
                   F.col("before") + (F.col("_c") + 1) * F.lit(chunk))
    return chunks.select(*keys, value, "n",
                         F.explode(F.sequence(first, last)).alias("i"))
