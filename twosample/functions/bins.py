"""Equal-width binning as Column expressions (H1-H4).

Edges follow the usual ``linspace`` construction (edge i = i * step + lo, the
last edge forced to hi, a zero range widened by 0.5 each side) and a value
falls in bin i when ``edge[i] <= v < edge[i+1]``, the last bin closed.  The
index is found arithmetically and then corrected against the actual edges,
so values sitting on an edge land exactly where an edge comparison puts them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def widened_range(lo: Column, hi: Column) -> tuple[Column, Column]:
    """A zero-width range becomes [lo - 0.5, hi + 0.5]."""
    same = lo == hi
    return (F.when(same, lo - F.lit(0.5)).otherwise(lo),
            F.when(same, hi + F.lit(0.5)).otherwise(hi))


def n_bins_for(total: Column, cap: int = 10) -> Column:
    """H1 bin count: min(cap, floor(sqrt(N / 2))), at least 1."""
    return F.greatest(F.least(F.floor(F.sqrt(total.cast("double") / 2.0)),
                              F.lit(cap)).cast("int"), F.lit(1))


def bin_edges(lo: Column, hi: Column, k: Column) -> Column:
    """H1: array of k+1 edges from lo to hi (callers pass a widened range)."""
    step = (hi - lo) / k.cast("double")
    return F.transform(
        F.sequence(F.lit(0), k.cast("int")),
        lambda i: F.when(i == k, hi).otherwise(i.cast("double") * step + lo))


def edge_at(edges: Column, i: Column) -> Column:
    """0-based edge lookup."""
    return F.element_at(edges, (i + F.lit(1)).cast("int"))


def bin_index(v: Column, edges: Column, lo: Column, hi: Column, k: Column) -> Column:
    """H2: 0-based bin of ``v``; ``edge[i] <= v < edge[i+1]``, last bin closed."""
    kd = k.cast("double")
    guess = F.floor((v - lo) / (hi - lo) * kd).cast("int")
    guess = F.least(F.greatest(guess, F.lit(0)), (k - 1).cast("int"))
    down = F.when(v < edge_at(edges, guess), guess - 1).otherwise(guess)
    up = F.when((down < k - 1) & (v >= edge_at(edges, down + 1)), down + 1).otherwise(down)
    return up


def rescale_expected(expected: Column, obs_total: Column, exp_total: Column) -> Column:
    """H4: expected counts scaled so they sum to the observed total."""
    return expected * (obs_total.cast("double") / exp_total.cast("double"))
