"""Connected components of an undirected graph by alternating large-star and
small-star steps (Kiveris et al., 2014), as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                  F.sum((F.xxhash64("v", "u") % F.lit(1 << 40)).cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["x"], r["s"]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = (both.groupBy("u").agg(F.min("v").alias("m"))
           .select("u", F.least("u", "m").alias("m")))
    return (both.join(low, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (u, v: long) to (node, component): the smallest id of the
    component, for every id that an edge names with another id.

    Self loops and repeated edges count for nothing; an empty table gives an
    empty result.  Each round is two group-min aggregates and joins; the
    joins are plain equi-joins whose hot keys AQE splits.  Rounds are cut by
    written tables and end when the edge set stays the same.
    """
    cur = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
              .filter("u <> v").distinct(), "cc-edges")
    seen = _checksum(cur)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        cur = cut(_small_star(_large_star(cur)), "cc-round")
        now = _checksum(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(cur.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .distinct())
