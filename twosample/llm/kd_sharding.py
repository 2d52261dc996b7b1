"""Sharding by K-d tree partitioning: nodes are split at distributed weighted
medians along their widest metadata dimension until leaves reach the target
bytes.  DataFrame operations only.

A point is a document with its metadata: size, language, source, id, each
mapped to 32 bits (numbers scaled by their range, strings hashed).  Equal texts
take the metadata of their smallest id, so they are one place in the tree.
The weighted median of a node is found by counting, not by sorting: bytes per
leading digits of the key (dimension value, text hash, id in hex), then again
inside the one prefix where the target falls.  Each pass is one aggregate with
map-side combine for all nodes of a level, so neither a hot source nor a hot
text meets in one task; the driver gets one row per node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut

DIGIT = 4                               # hex digits that a pass tells apart
DIMS = ["source", "lang", "bytes", "id"]


@dataclass
class _Node:
    """A node that is to be split in ``leaves``: the cut's path of digits so far."""
    id: int
    leaves: int
    bytes: int
    dim: int
    path: str = ""
    below: int = 0          # bytes ahead of the path
    after: bool = False     # the cut lies behind the path, else ahead of it
    done: bool = False

    @property
    def goal(self) -> float:
        return self.bytes * (self.leaves // 2) / self.leaves


def _listed(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A table of one short row per node, which Spark knows the size of."""
    value = lambda x: f"'{x}'" if isinstance(x, str) else str(x)
    return spark.sql("SELECT * FROM VALUES " + ", ".join("(" + ", ".join(map(value, r)) + ")" for r in rows) + f" AS t({names})")


def _hex(c: Column, digits: int) -> Column:
    return F.lpad(F.hex(c), digits, "0")


def _cut_nodes(points: DataFrame, nodes: list[_Node], slack: float, group_slack: float) -> None:
    """Sets the cut of every node of one level; ``points`` have their key."""
    spark, digits = points.sparkSession, 8 + 16 + 16
    for at in range(0, digits, DIGIT):
        open_ = [n for n in nodes if not n.done]
        if not open_:
            return
        goals = _listed(spark, [(n.id, n.path, float(n.goal - n.below)) for n in open_], "node, path, goal")
        sums = (points.join(goals, "node").filter(F.substring("key", 1, at) == F.col("path"))
                .groupBy("node", "goal", F.substring("key", at + 1, DIGIT).alias("d"))
                .agg(F.sum("size").alias("b"), F.min("h").alias("h0"), F.max("h").alias("h1"),
                     F.min("u").alias("u0"), F.max("u").alias("u1")))
        run = Window.partitionBy("node").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
        rank = Window.partitionBy("node").orderBy("d")
        found = (sums.withColumn("upto", F.sum("b").over(run)).filter(F.col("upto") >= F.col("goal"))
                 .withColumn("k", F.row_number().over(rank)).filter("k = 1"))
        rows = {r["node"]: r for r in found.collect()}
        for n in open_:
            x = rows[n.id]
            n.path += x["d"]
            over, under = n.below + x["upto"] - n.goal, n.goal - (n.below + x["upto"] - x["b"])
            n.after, near, one_text = over <= under, min(over, under), x["h0"] == x["h1"]
            n.done = near <= slack * n.bytes or (one_text and (x["u0"] == x["u1"] or near <= group_slack * n.bytes))
            n.below += x["upto"] - x["b"]


def kd_shards(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None,
              id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
              slack: float = 0.001, group_slack: float = 0.02, slot_rows: int = 20_000) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row.

    Give ``target_bytes`` (leaves split until they reach it) or ``shards``
    (the target is that share of all bytes).  Law ``bytes``: the shards' sums
    of ``size`` (UTF-8 bytes of the text plus 1; null text: 1) are near equal:
    a cut misses its target by ``slack`` of its node at most, or by half a
    document; equal texts stay in one shard unless the group would shift a cut
    by more than ``group_slack`` of its node.  Slots count from 0 without
    gaps in each shard, ordered by hash range and id.

    Null ids, languages and sources are values of their own; repeated rows
    are separate rows; an empty table gives an empty result; other columns
    are ignored.  At most one row per shard is on the driver.
    """
    if (target_bytes is None) == (shards is None):
        raise ValueError("give target_bytes or shards")
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col), F.lit(""))
    rows = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                           (F.octet_length(text) + 1).cast("long").alias("size"),
                           F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"),
                           F.shiftrightunsigned(F.xxhash64(F.col(lang_col).cast("string")), 32).alias("lang"),
                           F.shiftrightunsigned(F.xxhash64(F.col(source_col).cast("string")), 32).alias("source")),
               "kd-rows")
    same = (rows.groupBy("h").agg(F.count("*").alias("n"), F.min("doc_id").alias("rep"), F.min("lang").alias("glang"),
                                  F.min("source").alias("gsource")).filter("n > 1").drop("n"))
    span = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("doc_id").alias("i0"),
                    F.max("doc_id").alias("i1"), F.min("size").alias("s0"), F.max("size").alias("s1")).first()
    total = span["bytes"] or 0

    def scaled(c: Column, lo: int | None, hi: int | None) -> Column:
        lo, hi = lo or 0, hi or 0
        return F.floor((F.coalesce(c, F.lit(lo)) - F.lit(lo)) / F.lit(float(max(1, hi - lo))) * F.lit(float((1 << 32) - 1)))

    points = (rows.join(same, "h", "left")
              .select("doc_id", "size", "text_crc32", "h", F.coalesce("doc_id", F.lit(0)).alias("u"),
                      F.coalesce("gsource", "source").alias("source"), F.coalesce("glang", "lang").alias("lang"),
                      scaled(F.coalesce("rep", "doc_id"), span["i0"], span["i1"]).alias("id"),
                      scaled(F.col("size"), span["s0"], span["s1"]).alias("bytes")))
    points = cut(points.withColumn("node", F.lit(0)), "kd-points")
    leaves = shards if shards else max(1, -(-total // target_bytes))
    todo, next_id, order = {0: leaves}, 1, [0]
    while total and any(k > 1 for k in todo.values()):
        open_ids = [i for i, k in todo.items() if k > 1]
        wide = (points.filter(F.col("node").isin(open_ids)).groupBy("node")
                .agg(F.sum("size").alias("b"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMS]).collect())
        nodes = [_Node(r["node"], todo[r["node"]], r["b"], max(range(len(DIMS)), key=lambda k, r=r: r[DIMS[k]])) for r in wide]
        for i in set(open_ids) - {n.id for n in nodes}:     # nodes without rows
            todo[i] = 1
        if not nodes:
            break
        dims = _listed(spark, [(n.id, n.dim + 1) for n in nodes], "node, dim")
        key = F.concat(_hex(F.element_at(F.array(*DIMS), F.col("dim")), 8), _hex(F.col("h"), 16), _hex(F.col("u"), 16))
        points = points.join(dims, "node", "left").withColumn("key", key).drop("dim")
        _cut_nodes(points.filter("key is not null"), nodes, slack, group_slack)
        right = {}
        for n in nodes:
            right[n.id], next_id = next_id, next_id + 1
            todo[n.id], todo[right[n.id]] = n.leaves // 2, n.leaves - n.leaves // 2
            order.insert(order.index(n.id) + 1, right[n.id])
        cuts = _listed(spark, [(n.id, n.path, int(n.after), right[n.id]) for n in nodes], "node, path, after, right_id")
        head = F.expr("substring(key, 1, length(path))")
        is_left = (head < F.col("path")) | ((head == F.col("path")) & (F.col("after") == 1))
        points = cut(points.join(cuts, "node", "left").withColumn(
            "node", F.when(F.col("path").isNull() | is_left, F.col("node")).otherwise(F.col("right_id"))
        ).drop("key", "path", "after", "right_id"), "kd-level")
    number = _listed(spark, [(i, k) for k, i in enumerate(order)], "node, shard")
    placed = points.join(number, "node").select("doc_id", "size", "text_crc32", "shard", "h")
    return _slots(placed, max(1, (span["rows"] or 0) // (len(order) * slot_rows))).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _slots(placed: DataFrame, ranges: int) -> DataFrame:
    """Numbers the rows of each shard: rows are counted per (shard, range of
    ids' hashes), ranges are laid end to end, rows are numbered in a range."""
    ranged = placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "h"), F.lit(ranges)).cast("int"))
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("shard", "part").agg(F.count("*").alias("n"))
               .withColumn("start", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "h")
    return (ranged.withColumn("k", F.row_number().over(inside))
            .join(offsets, ["shard", "part"])
            .withColumn("slot", (F.col("start") + F.col("k") - 1).cast("long")))
