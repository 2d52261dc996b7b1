"""Exact dedup by an extendible-hash index on shared files.

1. Texts are hashed (64 bits).  A directory of hash prefixes is grown from
   counts of bytes per prefix: every overfull bucket splits on its next bit,
   and the directory doubles whenever a bucket as deep as the directory
   splits.  Counts are refined only for slots that are still overfull.
2. Copies inside one Arrow batch are collapsed first, so that a hot text
   reaches its owner once per batch, not once per row.
3. Collapsed rows go to the owner of their bucket, sorted by hash.  The owner
   streams through them, chains the texts that share a hash and tells them
   apart by their bytes.  Bucket files in the shared folder hold
   (hash, chain position, rows, largest id, ids of the batch, SHA-256).
4. Totals of each (hash, chain position) are joined back to the bucket files
   and the ids are listed again.

An owner keeps the chain of one hash in memory, never a bucket or a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, shared_path

STEP_BITS = 10


def split_directory(slots: dict[int, int], depth: int, capacity: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Grow a directory over the byte counts of all prefixes of ``depth`` bits.

    Returns the directory (slot of ``global depth`` bits to bucket number) and
    the buckets (prefix, local depth, bytes)."""
    sums = [np.zeros(1 << d, dtype=np.int64) for d in range(depth + 1)]
    for s, n in slots.items():
        sums[depth][s] += n
    for d in range(depth, 0, -1):
        sums[d - 1] = sums[d].reshape(-1, 2).sum(axis=1)
    buckets, todo, global_depth = [], [(0, 0)], 0
    while todo:
        prefix, local = todo.pop()
        if sums[local][prefix] > capacity and local < depth:
            global_depth = max(global_depth, local + 1)      # the directory doubles
            todo += [(prefix * 2 + 1, local + 1), (prefix * 2, local + 1)]
        else:
            buckets.append((prefix, local, int(sums[local][prefix])))
    directory = np.empty(1 << global_depth, dtype=np.int32)
    for b, (prefix, local, _) in enumerate(buckets):
        width = 1 << (global_depth - local)
        directory[prefix * width:(prefix + 1) * width] = b
    return directory, buckets


def _prefix(h: str, bits: int) -> Column:
    return F.shiftrightunsigned(F.col(h), 64 - bits).cast("int")


def grow_directory(keys: DataFrame, capacity: int, max_bits: int) -> np.ndarray:
    """Directory over ``keys`` (h, bytes).  Prefix counts are taken ``STEP_BITS``
    bits at a time, again only for prefixes that are still overfull, and are
    at most 2 ** max_bits rows on the driver whatever the input."""
    bits, known, hot = min(STEP_BITS, max_bits), {}, None
    total = None
    while True:
        part = keys
        if hot is not None:
            part = part.filter(_prefix("h", bits - STEP_BITS).isin([int(x) for x in hot]))
        counts = {r["p"]: r["n"] for r in part.groupBy(_prefix("h", bits).alias("p"))
                  .agg(F.sum("bytes").alias("n")).collect()}
        if total is None:
            total = sum(counts.values())
            capacity = max(capacity, total >> max_bits)
        if hot is not None:
            known = {(p << STEP_BITS): n for p, n in known.items() if p not in hot}
        known |= counts
        over = [p for p, n in counts.items() if n > capacity]
        if not over or bits + STEP_BITS > max_bits:
            return split_directory(known, bits, capacity)[0]
        hot, bits = set(over), bits + STEP_BITS


def _collapse(directory: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    depth = int(len(directory)).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            g = pa.Table.from_batches([b]).group_by("text", use_threads=False).aggregate(
                [("h", "min"), ("id", "list"), ("id", "max"), ([], "count_all")]).combine_chunks()
            h = g["h_min"].to_numpy().astype(np.int64)
            slot = (h.view(np.uint64) >> np.uint64(64 - depth)).astype(np.int64) if depth else np.zeros(len(h), np.int64)
            yield from pa.table({"bucket": pa.array(directory[slot], pa.int32()), "h": pa.array(h, pa.int64()),
                                 "n": g["count_all"].cast(pa.int64()), "top": g["id_max"].cast(pa.int64()),
                                 "ids": g["id_list"].cast(pa.list_(pa.int64())),
                                 "text": g["text"].cast(pa.string())}).to_batches()
    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, h): the chain position and digest of each."""
    at, chain = None, []
    for b in batches:
        texts, spots, shas = b.column("text").cast(pa.binary()), [], []
        for h, t in zip(b.column("h").to_pylist(), texts):
            if h != at:
                at, chain = h, []
            t = t.as_py()
            k = next((i for i, (other, _) in enumerate(chain) if other == t), None)
            if k is None:
                k = len(chain)
                chain.append((t, hashlib.sha256(t).hexdigest()))
            spots.append(k)
            shas.append(chain[k][1])
        yield pa.record_batch({"h": b.column("h"), "spot": pa.array(spots, pa.int32()), "n": b.column("n"),
                               "top": b.column("top"), "ids": b.column("ids"), "sha": pa.array(shas, pa.string())})


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_bytes: int = 2 << 20, max_bits: int = 20, hash_of: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when their bytes are; null counts as the empty text.  The
    row with the largest id stays.  Rows that repeat the same id and text all
    carry the id that stays and are all ``kept``; a null id stays only where
    its group has no other id.  An empty table gives an empty result; other
    columns, whatever their names, are ignored.

    ``bucket_bytes``: bytes of text in a bucket before it splits; at most
    2 ** max_bits buckets, which then grow instead.  ``hash_of``: the 64-bit
    key as an expression over ``text`` (tests force collisions with it).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text") if hash_of is None else hash_of)
    directory = grow_directory(rows.select("h", (F.octet_length("text") + 1).alias("bytes")),
                               bucket_bytes, max_bits)
    spark.createDataFrame(pa.table({"slot": pa.array(range(len(directory)), pa.int32()),
                                    "bucket": pa.array(directory, pa.int32())})) \
         .write.parquet(shared_path(spark, "exact-directory"))
    collapsed = rows.select("h", "id", "text").mapInArrow(
        _collapse(directory), "bucket int, h long, n long, top long, ids array<long>, text string")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(directory.max()) // 64)
    owned = collapsed.repartition(tasks, "bucket").sortWithinPartitions("bucket", "h").mapInArrow(
        _own, "h long, spot int, n long, top long, ids array<long>, sha string")
    index = cut(owned, "exact-buckets")
    totals = index.groupBy("h", "spot").agg(F.sum("n").alias("size"), F.max("top").alias("keep"))
    return (index.join(totals, ["h", "spot"])
            .select(F.explode("ids").alias("doc_id"), F.col("keep").alias("keep_id"),
                    F.col("size").alias("group_size"), F.col("sha").alias("text_sha256"))
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
