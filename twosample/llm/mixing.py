"""Mixing sources to target weights by hierarchical budgeting.  DataFrame
operations only.

Documents hang in a tree domain - language - source.  A token budget goes down
the tree: each node splits its budget among its children by their weights; a
child that has fewer tokens than its share is filled, and what it leaves goes
to its siblings (water-filling).  A node's own capacity is the sum of its
children's, so a shortage reaches the ancestors only when all siblings are
full.  Capacity is tokens times the epochs allowed.

A leaf's documents are taken in the order of a seeded hash, one order per
epoch: whole epochs first, then the prefix of the next epoch that comes nearest
to the rest of the budget (a document is in if half of its tokens fit).
Prefixes are found by token sums per hash range of each leaf, so only the
documents of one range meet in a window, never a leaf.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

LEVELS = ["domain", "lang", "source"]
BROADCAST_LEAVES = 50_000


def weights_column(col: str, weights: dict[str, int], other: int) -> Column:
    """Integer weight by value; ``other`` for values not named."""
    c = F.lit(other)
    for name, w in weights.items():
        c = F.when(F.col(col) == name, F.lit(w)).otherwise(c)
    return c.cast("long")


def waterfill(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``budget`` to ``nodes`` (parent columns, parent_budget, capacity,
    weight: long): shares of the parent's budget by weight, none above its
    capacity, what is left to the siblings that have room.

    Children sorted by capacity / weight fill up in that order: one is full
    if the capacity is at most its share of what the ones before left."""
    ratio = F.col("capacity") / F.greatest(F.col("weight"), F.lit(1)).cast("double")
    order = [F.col("weight") == 0, ratio, F.col("capacity"), *(F.col(c) for c in LEVELS if c in nodes.columns)]
    w = Window.partitionBy(*parent)
    ahead = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    big = "decimal(38,0)"
    return (nodes
            .withColumn("used", F.coalesce(F.sum("capacity").over(ahead), F.lit(0)))
            .withColumn("rest", F.sum("weight").over(w) - F.coalesce(F.sum("weight").over(ahead), F.lit(0)))
            .withColumn("full", (F.col("weight") > 0) & (F.col("capacity").cast(big) * F.col("rest").cast(big)
                                <= F.col("weight").cast(big) * (F.col("parent_budget") - F.col("used")).cast(big)))
            .withColumn("open_budget", F.col("parent_budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(w), F.lit(0)))
            .withColumn("open_weight", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(w), F.lit(0)))
            .withColumn("budget", F.when(F.col("full"), F.col("capacity")).when(F.col("weight") == 0, F.lit(0)).otherwise(
                F.expr("cast(open_budget as decimal(38,0)) * weight div open_weight")).cast("long"))
            .drop("used", "rest", "full", "open_budget", "open_weight"))


def leaf_budgets(leaves: DataFrame, budget: int, lang_weight: Column, domain_weight: Column,
                 source_weight: Column, epochs: int) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with ``budget`` tokens each."""
    caps = leaves.withColumn("capacity", F.col("tokens") * F.lit(epochs))
    domains = (caps.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
               .withColumns({"weight": domain_weight, "parent_budget": F.lit(max(0, budget)), "root": F.lit(0)}))
    domains = waterfill(domains, ["root"])
    langs = (caps.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity")).withColumn("weight", lang_weight)
             .join(domains.select("domain", F.col("budget").alias("parent_budget")), "domain"))
    langs = waterfill(langs, ["domain"])
    sources = (caps.withColumn("weight", source_weight)
               .join(langs.select("domain", "lang", F.col("budget").alias("parent_budget")), ["domain", "lang"]))
    return waterfill(sources, ["domain", "lang"]).select(*LEVELS, "tokens", "budget")


def mix(docs: DataFrame, domain: Column, budget: Callable[[int], int], lang_weights: dict[str, int], lang_other: int = 1,
        domain_weights: dict[str, int] | None = None, domain_other: int = 1, source_weights: dict[str, int] | None = None,
        source_other: int = 1, epochs: int = 1, seed: int = 1, keep: list[str] | None = None, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", source_col: str = "source", range_digits: int = 3) -> DataFrame:
    """One row per row of ``docs``: (doc_id, domain, lang, source, tokens,
    leaf_tokens, leaf_budget, copies) and the columns ``keep`` of ``docs``.

    ``copies`` is how often the document is taken: full epochs of its leaf,
    and one more if it is in the prefix of the last, partial epoch.
    ``tokens``: UTF-8 bytes / 4, rounded up, 1 at least (null and empty texts: 1).
    ``domain``: an expression over ``source``; ``budget``: tokens to take, given all tokens.
    Weights are whole numbers; a weight of 0 takes nothing.  Null languages,
    sources and domains count as the value '' .  Documents of a leaf are ordered
    by md5 of seed, epoch, id and tokens; rows equal in these follow each other.
    ``range_digits``: leading hex digits of that md5 that name a range (16 ** digits a leaf).
    An empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*[F.col(c).alias(f"kept_{c}") for c in keep or []], F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
                       F.greatest(F.lit(1), F.ceil(F.octet_length(text) / 4)).cast("long").alias("tokens"))
    rows = rows.withColumn("domain", F.coalesce(domain, F.lit("")))
    # one row per leaf: written once, the plans of the budgets stay small
    sums = cut(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    total = sums.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    leaves = leaf_budgets(sums, budget(total), weights_column("lang", lang_weights, lang_other),
                          weights_column("domain", domain_weights or {}, domain_other),
                          weights_column("source", source_weights or {}, source_other), epochs)
    leaves = (leaves.withColumn("rounds", F.expr("budget div tokens"))
              .withColumn("part_budget", F.col("budget") - F.col("rounds") * F.col("tokens"))
              .select(*LEVELS, F.col("tokens").alias("leaf_tokens"), F.col("budget").alias("leaf_budget"), "rounds", "part_budget"))
    leaves = cut(leaves, "mix-budgets")
    if leaves.count() <= BROADCAST_LEAVES:       # else a shuffled join, whose hot leaf AQE splits
        leaves = F.broadcast(leaves)
    sized = rows.join(leaves, LEVELS).withColumn("o", F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("rounds").cast("string"),
                                                            F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("tokens").cast("string"))))
    sized = sized.withColumn("part", F.substring("o", 1, range_digits))
    ahead = Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sized.groupBy(*LEVELS, "part").agg(F.sum("tokens").alias("n"))
              .withColumn("start", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n"))
    inside = Window.partitionBy(*LEVELS, "part").orderBy("o", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    run = sized.withColumn("run", F.sum("tokens").over(inside)).join(starts, [*LEVELS, "part"])
    taken = ((F.col("part_budget") > 0) & (2 * (F.col("start") + F.col("run")) - F.col("tokens") <= 2 * F.col("part_budget"))).cast("long")
    return run.select("doc_id", *LEVELS, "tokens", "leaf_tokens", "leaf_budget", (F.col("rounds") + taken).alias("copies"),
                      *[F.col(f"kept_{c}").alias(f"kept_{c}") for c in keep or []])
