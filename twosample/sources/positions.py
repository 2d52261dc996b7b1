"""Row positions in file order.

Files have an order that a table has not: by path, then by line.  A scan reads them in
splits, and the rows of a split pass one task in order, so their
``monotonically_increasing_id`` runs without gaps.  A row's position is therefore its
id, less that of its split's first row, plus the rows of all splits before: one pass
that counts rows per split, offsets over that small table, and a second pass that adds
them.  Nothing is sorted and no row moves.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_SPLITS = 100_000      # splits (a path and three numbers each) whose offsets may be broadcast


def _in_order(df: DataFrame) -> DataFrame:
    """``df`` with ``_file``, ``_split`` and ``_id``, a number that grows by one a row within a split."""
    try:
        rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"))
    except AnalysisException as exc:
        raise ValueError("positions need a table read from files, filtered and projected at most; "
                         "give other tables a column to pair by") from exc
    return rows.withColumn("_id", F.monotonically_increasing_id())


def _shifts(rows: DataFrame) -> DataFrame:
    """(_file, _split, _shift): what to add to ``_id`` to get a position.  One scan counts the
    splits; their table is metadata of the scan, like its list of files, and is put in
    order on the driver as long as it is small."""
    splits = rows.groupBy("_file", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    some = splits.limit(BROADCAST_SPLITS + 1).collect()
    if len(some) <= BROADCAST_SPLITS:
        start, out = 0, []
        for s in sorted(some):
            out.append((s["_file"], s["_split"], start - s["_first"]))
            start += s["_n"]
        return F.broadcast(rows.sparkSession.createDataFrame(out, "_file string, _split long, _shift long"))
    before = Window.orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)      # one short row a split
    return splits.select("_file", "_split", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))


def with_positions(df: DataFrame, name: str = "pos") -> DataFrame:
    """``df`` and the position of each row, from 0, in file order: by path, then by line.

    ``df`` is a scan of files, perhaps filtered or projected; rows that a filter drops do
    not count.  An empty scan gives an empty result."""
    rows = _in_order(df)
    placed = rows.join(_shifts(rows), ["_file", "_split"])
    return placed.select(*df.columns, (F.col("_id") + F.col("_shift")).alias(name))


def first_rows(df: DataFrame, k: int, name: str = "pos") -> DataFrame:
    """B4 by arrival: the first ``k`` rows of a scan in file order, with their positions.

    Rows are counted in the first file, then in twice as many files, until there are
    ``k``; only these are read, since a filter on the path prunes the list of files."""
    # the list of files is at hand; a path is written differently there for local files
    paths, taken = sorted({re.sub("^file:/+", "file:/", p) for p in df.inputFiles()}), 1
    while True:
        lead = df.filter(F.col("_metadata.file_path").isin(paths[:taken])) if taken < len(paths) else df
        if taken >= len(paths) or lead.limit(k).count() >= k:
            return with_positions(lead, name).filter(F.col(name) < k)
        taken *= 2
