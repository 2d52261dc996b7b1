"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints are 64 majority bits over XXH64 of word shingles.  Links are
pairs within ``max_bits`` differing bits.

The 64 bits are cut into ``max_bits + 1`` or more blocks; a pair that links agrees on
all but ``max_bits`` of them, so it shares the key of at least one table, a
choice of blocks that must agree.  In each table, distinct fingerprints are
sorted by (key, Gray rank), range-partitioned over all tasks.  Runs of one key
become leaves of ``LEAF`` fingerprints and nodes of ``LEAF`` leaves; each keeps
the mask of the bits that all its members share, and their pattern.  Two nodes
or leaves whose patterns differ in more than ``max_bits`` of the bits that
both masks hold cannot contain a link and are dropped whole.  What is left is
compared by XOR and bit count.  A task hands on a spanning forest of the links
that it finds, never all pairs of a group; components come from joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, partitions_for
from .components import connected_components

LEAF = 64
U1 = np.uint64(1)
GROW_SCHEMA = "kind int, t int, key long, node long, mask long, pattern long, fps array<long>, a long, b long"


def fingerprint(text: str | None, words: int = 3) -> int:
    """Fingerprint of one text, as an unsigned number."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    line, digest = b" ".join(ws), xxhash.xxh64_intdigest
    ends = list(accumulate(map(len, ws), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends)]
    hs = np.fromiter((digest(line[a:b], 42) for a, b in zip(starts, ends[words - 1:] or ends[-1:])), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hs), 1 << 16):
        ones += np.unpackbits(hs[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hs), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = 3) -> DataFrame:
    """``docs`` and, behind its columns, the fingerprints ``fp`` as signed 64-bit numbers."""
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in b.column(at)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps.view(np.int64), pa.int64())], names=[*b.schema.names, "fp"])
    return docs.mapInArrow(run, schema)


def tables(blocks: int, max_bits: int) -> list[int]:
    """Masks of the block choices that must agree, as unsigned numbers."""
    edge = [round(i * 64 / blocks) for i in range(blocks + 1)]
    block = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(blocks)]
    return [sum(block[i] for i in c) for c in combinations(range(blocks), blocks - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Rank of each word in Gray-code order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class _Forest:
    """Union-find over fingerprints; keeps the edges that joined two trees."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while up.setdefault(root, root) != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = self.find(x), self.find(y)
            if p != q:
                self.up[max(p, q)] = min(p, q)
                self.edges.append((x, y))


def _shared(fps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mask, pattern) of each run of ``fps`` that begins at ``starts``."""
    ones, zeros = np.bitwise_and.reduceat(fps, starts), np.bitwise_and.reduceat(~fps, starts)
    return ones | zeros, ones


def _link_leaves(a: np.ndarray, b: np.ndarray, same: bool, max_bits: int, forest: _Forest) -> None:
    """Links between two Gray-sorted runs by their leaves; ``same``: one run with itself."""
    sa, sb = np.arange(0, len(a), LEAF), np.arange(0, len(b), LEAF)
    ma, pa_ = _shared(a, sa)
    mb, pb = _shared(b, sb)
    apart = np.bitwise_count((pa_[:, None] ^ pb[None, :]) & ma[:, None] & mb[None, :])
    for i, j in zip(*np.nonzero(apart <= max_bits)):
        if same and j < i:
            continue
        x, y = a[sa[i]:sa[i] + LEAF], b[sb[j]:sb[j] + LEAF]
        hit = np.bitwise_count(x[:, None] ^ y[None, :]) <= max_bits
        if same and i == j:
            hit = np.triu(hit, 1)
        u, v = np.nonzero(hit)
        if len(u):
            forest.link(x[u], y[v])


def _rows(kind: int, **cols) -> pa.RecordBatch:
    n = len(next(iter(cols.values())))
    types = {"t": pa.int32(), "key": pa.int64(), "node": pa.int64(), "mask": pa.int64(), "pattern": pa.int64(),
             "fps": pa.list_(pa.int64()), "a": pa.int64(), "b": pa.int64()}
    return pa.record_batch({"kind": pa.array([kind] * n, pa.int32())} | {
        k: pa.array(cols.get(k, [None] * n), typ) for k, typ in types.items()})


def _edge_rows(forest: _Forest) -> pa.RecordBatch:
    e = np.array(forest.edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return _rows(0, a=e[:, 0], b=e[:, 1])


def _grow(max_bits: int):
    """Sorted (t, key, rank, fp) of one task: links inside its nodes, and the
    nodes of keys that have several or that may go on in another task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t, key, fp = (np.concatenate([b.column(k).to_numpy() for b in got]) for k in ("t", "key", "fp"))
        fp = fp.view(np.uint64)
        n, forest = len(fp), _Forest()
        head = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (key[1:] != key[:-1])])
        size = np.diff(np.r_[head, n])
        small = np.repeat(size <= LEAF, size)
        group = np.repeat(np.arange(len(head)), size)
        live, step = np.arange(n), 1
        while True:                       # all short runs at once, by distance in the run
            live = live[live + step < n]
            live = live[small[live] & (group[live] == group[live + step])]
            if not len(live):
                break
            hit = live[np.bitwise_count(fp[live] ^ fp[live + step]) <= max_bits]
            forest.link(fp[hit], fp[hit + step])
            step += 1
        first, nodes = TaskContext.get().partitionId() << 32, []
        for g in np.flatnonzero((size > LEAF) | (np.arange(len(head)) == 0) | (np.arange(len(head)) == len(head) - 1)):
            cuts = range(head[g], head[g] + size[g], LEAF * LEAF)
            for at in cuts:
                part = fp[at:min(at + LEAF * LEAF, head[g] + size[g])]
                if size[g] > LEAF:
                    _link_leaves(part, part, True, max_bits, forest)
                if len(cuts) > 1 or g in (0, len(head) - 1):
                    m, p = _shared(part, np.array([0]))
                    nodes.append((int(t[at]), int(key[at]), first + len(nodes), int(m.view(np.int64)[0]),
                                  int(p.view(np.int64)[0]), part.view(np.int64)))
        if forest.edges:
            yield _edge_rows(forest)
        for node in nodes:
            yield _rows(1, **{k: [v] for k, v in zip(("t", "key", "node", "mask", "pattern", "fps"), node)})
    return run


def _compare(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forest = _Forest()
            for x, y in zip(b.column("fps"), b.column("other")):
                _link_leaves(x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64), False, max_bits, forest)
            if forest.edges:
                e = np.array(forest.edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.record_batch({"a": pa.array(e[:, 0], pa.int64()), "b": pa.array(e[:, 1], pa.int64())})
    return run


def hamming_links(fps: DataFrame, max_bits: int = 3, blocks: int | None = None, task_rows: int = 100_000) -> DataFrame:
    """(a, b): links between the distinct values of ``fps`` (fp: long) that
    join the same components as all pairs within ``max_bits`` do.

    ``blocks``: by default so many that the keys of a table outnumber the
    fingerprints; the links do not depend on it."""
    spark = fps.sparkSession
    n = fps.count()
    if blocks is None:
        blocks = max_bits + 1
        while (blocks - max_bits) * 64 // blocks < min(n.bit_length() - 2, 30):
            blocks += 1
    masks = tables(blocks, max_bits)
    fp = F.col("fp")
    entries = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), fp.bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])).alias("x"))
    rank = F.col("fp")
    for s in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, s))
    entries = entries.select("x.t", "x.key", "fp").withColumn("rank", rank)
    tasks = partitions_for(n * len(masks), task_rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    grown = cut(entries.repartitionByRange(tasks, "t", "key", "rank").sortWithinPartitions("t", "key", "rank")
                .select("t", "key", "fp").mapInArrow(_grow(max_bits), GROW_SCHEMA), "simhash-nodes")
    nodes = grown.filter("kind = 1")
    x = nodes.select("t", "key", "node", "mask", "pattern", "fps")
    y = nodes.select("t", "key", F.col("node").alias("node2"), F.col("mask").alias("mask2"),
                     F.col("pattern").alias("pattern2"), F.col("fps").alias("other"))
    near = (x.join(y, ["t", "key"]).filter("node < node2")
            .filter(F.bit_count(F.col("pattern").bitwiseXOR(F.col("pattern2")).bitwiseAND(F.col("mask"))
                                .bitwiseAND(F.col("mask2"))) <= max_bits))
    across = near.select("fps", "other").mapInArrow(_compare(max_bits), "a long, b long")
    return grown.filter("kind = 0").select("a", "b").union(across)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                       max_bits: int = 3, blocks: int | None = None, task_rows: int = 100_000) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased;
    shingles of ``words`` words, repeats included (fewer words: all of them;
    none, or a null text: fingerprint 0, linked like any other).  Rows whose
    fingerprints are within ``max_bits`` bits link; ``component_id`` is the
    smallest doc_id of all rows reachable.  Rows with a null id take part in
    links; a component of null ids only has a null component_id.  Repeated rows stay
    separate rows; an empty table gives an empty result; other columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = cut(fingerprints(rows, "text", words).select("doc_id", "fp"), "simhash-fp")
    by_fp = _components(rows, F.min("doc_id"), max_bits, blocks, task_rows)
    return (rows.join(by_fp, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id")))


def _components(rows: DataFrame, first: Column, max_bits: int, blocks: int | None, task_rows: int) -> DataFrame:
    """(fp, first): for each distinct fingerprint of ``rows``, the smallest
    value of the aggregate ``first`` over its whole component."""
    distinct = cut(rows.groupBy("fp").agg(first.alias("first")), "simhash-distinct")
    links = hamming_links(distinct.select("fp"), max_bits, blocks, task_rows)
    comp = cut(connected_components(links.toDF("u", "v")), "simhash-components")
    named = (distinct.join(comp, F.col("fp") == F.col("node"), "left")
             .select("fp", "first", F.coalesce("component", "fp").alias("c")))
    return named.join(named.groupBy("c").agg(F.min("first").alias("least")), "c").select("fp", F.col("least").alias("first"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 3,
                     blocks: int | None = None, task_rows: int = 100_000) -> DataFrame:
    """``docs`` with all its columns and one row of each component: the one
    with the smallest id (null ids last; of rows that share it, the first in
    the table).  Rows get numbers, which are written down with the fingerprints.  No
    documents give no rows; null and wordless texts are one component; columns of any name come
    back as they were."""
    rows = fingerprints(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                                    F.monotonically_increasing_id().alias("_row"),
                                    *[F.col(f"`{c}`").alias(f"kept_{k}") for k, c in enumerate(docs.columns)]), "text", words)
    rows = cut(rows.drop("text"), "simhash-rows")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("_row").alias("row"))
    stay = _components(rows.select("fp", "id", "_row"), F.min(order), max_bits, blocks, task_rows).select(
        F.col("first.row").alias("_row")).distinct()
    return rows.join(stay, "_row", "left_semi").select(*[F.col(f"kept_{k}").alias(c) for k, c in enumerate(docs.columns)])
