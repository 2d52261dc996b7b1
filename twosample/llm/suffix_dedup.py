"""Suffix-array dedup: bytes of repeated long strings, by column-wise
construction of suffix order and common prefixes for many texts.

The construction inserts one symbol of every text of a collection each round,
from right to left: sorting the new symbols stably into the order of the
round before gives the new order of suffixes (the symbols in that order are the
round's slice of the Burrows-Wheeler transform), and the common prefix of two
neighbours is one more than the least common prefix between their places
before.  Rounds cost time in proportion to the texts, so the collection is
first cut into pieces of bounded width that can be sorted apart:

* Every window of ``length`` bytes has an anchor: the leftmost of its
  ``GRAM``-byte strings with the least hash.  Equal windows have equal anchors
  at equal places, so a window can only repeat within its anchor's class.
* Anchors that occur once are dropped.  Around each other anchor, the piece
  that all its windows lie in is hashed; pieces with equal hash (and clipping) are one
  variant.  A variant that occurs twice is repeated as a whole.
* Classes of several variants get their pieces' bytes, aligned at the anchor,
  and go through the rounds, whole classes to a task.  Wherever neighbours share
  ``length`` bytes, the window that starts at that column occurs elsewhere.
* A class with more variants than ``class_rows`` does not go to one task: all
  windows of its variants are counted by column and 128-bit digest instead.

Windows on one anchor overlap, so an occurrence has one repeated span at most.
Spans are joined per text and cut out.  Tables are handed on through
written files; what a task holds is bounded by ``task_rows`` pieces.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, partitions_for

GRAM = 50
CHUNK = 1 << 16
END = 0xFF              # not a byte of UTF-8
BASE = 0x9E3779B97F4A7C15
LOW = np.uint64((1 << 24) - 1)


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, modulo 2 ** 64."""
    inverse = pow(BASE, -1, 1 << 64)
    up, down = np.full(n, BASE, dtype=np.uint64), np.full(n, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed hash of the GRAM bytes at each place."""
    up, down = _powers(CHUNK + 4096)
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=run[1:])
    g = (run[GRAM:] - run[:-GRAM]) * down[:len(data) - GRAM + 1]
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(32)
    return g


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of all windows of ``length`` bytes."""
    wide, last = length - GRAM + 1, len(data) - length       # grams in a window, last window
    places, hashes = [], []
    for at in range(0, last + 1, CHUNK):
        g = _gram_hashes(data[at:at + CHUNK + length - 1])
        m = (g & ~LOW) | np.arange(len(g), dtype=np.uint64)   # ties go to the left
        span = 1
        while span * 2 <= wide:
            m = np.minimum(m[:-span], m[span:])
            span *= 2
        if span < wide:
            m = np.minimum(m[:len(m) - (wide - span)], m[wide - span:])
        p = (m & LOW).astype(np.int64)
        p = p[np.r_[True, p[1:] != p[:-1]]]
        places.append(p + at)
        hashes.append(g[p].view(np.int64))
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    p, h = np.concatenate(places), np.concatenate(hashes)
    new = np.r_[True, p[1:] != p[:-1]]
    return p[new], h[new]


def repeated_columns(pieces: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For aligned pieces (rows; END beyond the text's borders): first and last
    column at which a window starts that another row has at the same column
    (-1: none).  One symbol of each row is inserted per round."""
    n, width = pieces.shape
    columns = np.ascontiguousarray(pieces.T)
    order, lcp = np.arange(n), np.zeros(n + 1, dtype=np.int16)
    first, last = np.full(n, -1, dtype=np.int32), np.full(n, -1, dtype=np.int32)
    for c in range(width - 1, -1, -1):
        sym = columns[c][order]
        move = np.argsort(sym, kind="stable")
        sym = sym[move]
        same = np.flatnonzero((sym[1:] == sym[:-1]) & (sym[1:] != END))
        i, j = move[same], move[same + 1]
        new = np.zeros(n + 1, dtype=np.int16)
        new[same + 1] = lcp[j]
        far = np.flatnonzero(j != i + 1)
        if len(far):
            ends = np.column_stack([i[far] + 1, j[far] + 1]).ravel()
            new[same[far] + 1] = np.minimum.reduceat(lcp, ends)[::2]
        new[same + 1] += 1
        order, lcp = order[move], new
        if c <= width - length:
            long = lcp[:-1] >= length
            hit = order[long | np.r_[long[1:], False]]
            first[hit] = c
            last[hit] = np.where(last[hit] < 0, c, last[hit])
    return first, last


def _release(spark: SparkSession) -> None:
    """Lets Spark drop shuffle files of tables that are written by now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _piece(data: bytes, at: int, length: int) -> tuple[int, int]:
    """(bytes to the left, bytes from the anchor on) of an anchor's piece."""
    return min(at, length - GRAM), min(len(data) - at, length)


def _grams(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [anchors(np.frombuffer(t.as_py(), dtype=np.uint8), length)[1] for t in b.column("data")]
            if got:
                yield pa.record_batch({"h": pa.array(np.concatenate(got), pa.int64())})
    return run


def _occurrences(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, th, t in zip(b.column("id").to_pylist(), b.column("th").to_pylist(), b.column("data")):
                data = t.as_py()
                p, h = anchors(np.frombuffer(data, dtype=np.uint8), length)
                if not len(p):
                    continue
                left, right = np.minimum(p, length - GRAM), np.minimum(len(data) - p, length)
                hs = [xxhash.xxh3_64_intdigest(data[a - x:a + y], x) for a, x, y in zip(p.tolist(), left.tolist(), right.tolist())]
                yield pa.record_batch({"id": pa.array(np.full(len(p), i), pa.int64()), "th": pa.array(np.full(len(p), th), pa.int64()),
                                       "at": pa.array(p, pa.int64()), "h": pa.array(h, pa.int64()),
                                       "hs": pa.array(np.array(hs, dtype=np.uint64).view(np.int64), pa.int64()),
                                       "left": pa.array(left, pa.int32()), "right": pa.array(right, pa.int32())})
    return run


def _cut_pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 * length - GRAM
        for b in batches:
            rows = []
            for t, wanted in zip(b.column("data"), b.column("wanted")):
                data = t.as_py()
                for w in wanted.as_py():
                    x, y = _piece(data, w["at"], length)
                    rows.append((w["h"], w["hs"], w["n"], w["many"], bytes([END]) * (length - GRAM - x) + data[w["at"] - x:w["at"] + y]
                                 + bytes([END]) * (length - y)))
                    assert len(rows[-1][4]) == width
            for k in range(0, len(rows), 4096):
                cols = list(zip(*rows[k:k + 4096]))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()))],
                                      names=["h", "hs", "n", "many", "piece"])
    return run


def _rounds(length: int, task_rows: int):
    """Pieces sorted by class: (h, hs, first, last) of rows with a repeated window."""
    def solve(h: np.ndarray, hs: np.ndarray, pieces: list[bytes]) -> pa.RecordBatch:
        m = np.frombuffer(b"".join(pieces), dtype=np.uint8).reshape(len(pieces), -1)
        first, last = repeated_columns(m, length)
        hit = np.flatnonzero(first >= 0)
        return pa.record_batch({"h": pa.array(h[hit], pa.int64()), "hs": pa.array(hs[hit], pa.int64()),
                                "first": pa.array(first[hit], pa.int32()), "last": pa.array(last[hit], pa.int32())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, hs, pieces = np.empty(0, np.int64), np.empty(0, np.int64), []
        for b in batches:
            h = np.concatenate([h, b.column("h").to_numpy()])
            hs = np.concatenate([hs, b.column("hs").to_numpy()])
            pieces += b.column("piece").to_pylist()
            if len(h) >= task_rows:
                k = int(np.searchsorted(h, h[-1]))      # the last class may go on
                if k:
                    yield solve(h[:k], hs[:k], pieces[:k])
                    h, hs, pieces = h[k:], hs[k:], pieces[k:]
        if len(h):
            yield solve(h, hs, pieces)
    return run


def _windows(length: int):
    """All windows of pieces, by their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, hs, p in zip(b.column("h").to_pylist(), b.column("hs").to_pylist(), b.column("piece").to_pylist()):
                a = len(p) - len(p.lstrip(bytes([END])))
                cols = list(range(a, len(p.rstrip(bytes([END]))) - length + 1))
                d = [xxhash.xxh3_128_digest(p[c:c + length]) for c in cols]
                yield pa.record_batch({"h": pa.array([h] * len(cols), pa.int64()), "hs": pa.array([hs] * len(cols), pa.int64()),
                                       "c": pa.array(cols, pa.int32()), "d": pa.array(d, pa.binary())})
    return run


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for i, t, spans in zip(b.column("doc_id").to_pylist(), b.column("data"), b.column("spans").to_pylist()):
            data, kept, at, runs = t.as_py(), [], 0, 0
            for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
                if s > at or not runs:
                    kept.append(data[at:s])
                    runs += 1
                at = max(at, e)
            kept.append(data[at:])
            rest = b"".join(kept)
            out.append((i, len(data), len(data) - len(rest), runs, hashlib.sha256(rest).hexdigest()))
        cols = list(zip(*out)) or [()] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.string()])],
                              names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(texts: DataFrame, length: int, class_rows: int, task_rows: int) -> DataFrame:
    """(id, th, spans: array of (s, e)) for texts (id, th, data: binary) with
    bytes that a string of ``length`` bytes covers which also starts elsewhere."""
    spark = texts.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    long = texts.filter(F.length("data") >= length)
    again = (long.select("data").mapInArrow(_grams(length), "h long").groupBy("h").agg(F.count("*").alias("k"))
             .filter("k > 1").select("h"))
    found = cut(long.mapInArrow(_occurrences(length), "id long, th long, at long, h long, hs long, left int, right int")
                .join(again, "h"), "suffix-occurrences")
    _release(spark)
    variants = found.groupBy("h", "hs").agg(F.count("*").alias("n"), F.first("left").alias("left"), F.first("right").alias("right"),
                                            F.min(F.struct("id", "th", "at")).alias("x"))
    variants = cut(variants, "suffix-variants")
    sizes = variants.groupBy("h").agg(F.count("*").alias("v")).filter("v > 1")
    whole = variants.filter("n > 1").select("h", "hs", F.lit(length - GRAM).alias("base"),
                                           F.greatest(F.lit(0), length - F.col("right")).alias("near"), F.col("left").alias("far"))
    wanted = (variants.join(sizes, "h").select("x.id", "x.th", F.struct("h", "hs", "n", "x.at", (F.col("v") > class_rows).alias("many")).alias("w"))
              .groupBy("id", "th").agg(F.collect_list("w").alias("wanted")))
    pieces = cut(long.join(wanted, ["id", "th"]).select("data", "wanted")
                 .mapInArrow(_cut_pieces(length), "h long, hs long, n long, many boolean, piece binary"), "suffix-pieces")
    _release(spark)
    few = pieces.filter("not many")
    tasks = partitions_for(few.count(), task_rows, least)
    sorted_out = (few.select("h", "hs", "piece").repartition(tasks, "h").sortWithinPartitions("h")
                  .mapInArrow(_rounds(length, task_rows), "h long, hs long, first int, last int"))
    windows = pieces.filter("many").select("h", "hs", "piece").mapInArrow(_windows(length), "h long, hs long, c int, d binary")
    # equal windows of a class stand at equal columns; other classes can hold the same place again
    same = ["h", "c", "d"]
    twice = windows.groupBy(*same).agg(F.count("*").alias("k")).filter("k > 1").select(*same)
    counted = windows.join(twice, same).groupBy("h", "hs").agg(F.min("c").alias("first"), F.max("c").alias("last"))
    left = length - GRAM
    across = sorted_out.union(counted).select("h", "hs", F.lit(left).alias("base"), (left - F.col("last")).alias("near"),
                                              (left - F.col("first")).alias("far"))
    known = (whole.filter("near <= far").union(across).groupBy("h", "hs").agg(F.min("near").alias("near"), F.max("far").alias("far")))
    return (found.join(known, ["h", "hs"])
            .select("id", "th", F.struct((F.col("at") - F.col("far")).alias("s"), (F.col("at") + length - F.col("near")).alias("e")).alias("span"))
            .groupBy("id", "th").agg(F.collect_set("span").alias("spans")))


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                  class_rows: int = 50_000, task_rows: int = 20_000) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row.

    Texts are UTF-8 bytes, null counts as empty.  Every byte goes that is
    covered by a string of ``length`` bytes which also starts anywhere else, in
    the same or another text; strings do not cross texts and are judged on the
    input.  Spans are maximal runs of removed bytes.  Rows that repeat id and
    text are separate texts, so a long enough one goes whole; a null id is passed on.  Shorter texts
    stay as they are; an empty table gives an empty result; other columns are ignored.
    """
    if not GRAM < length <= 2048:
        raise ValueError(f"length must be above {GRAM} and at most 2048")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
                        F.xxhash64(text).alias("th"), text.cast("binary").alias("data"))
    spans = cut(repeated_spans(texts.drop("doc_id"), length, class_rows, task_rows), "suffix-spans")
    _release(docs.sparkSession)
    return texts.join(spans, ["id", "th"], "left").select("doc_id", "data", "spans").mapInArrow(
        _strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
