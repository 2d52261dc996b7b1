"""Benchmark decontamination: a BM25 inverted index of test items, queried by
every training passage with block-max pruning, then verified by overlap.

Items are the documents of the index and a passage's words are the query, so
one task holds the (bounded) index and streams over the training texts.  An
item's weights are divided by its own full score, so a passage scores between
0 and 1 on it.  ``theta`` of an item is the least score that a passage can have
which holds ``containment`` of the item's word shingles: it may miss that many
words at most, at worst the heaviest ones.  No verified item is thus lost.

A text is first taken whole.  Postings per block of items give upper bounds
(block maxima); blocks below their smallest ``theta`` are skipped, items in the
others are scored.  A text that is longer than a passage is halved for the items
that are left, and what remains at passage length is verified.  An item counts
with other text inside it, over a span of at most twice the longest item; the
halves overlap by such a span, so each lies whole in one passage.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

APART = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))     # ASCII letters, digits and all else beyond ASCII
SENTENCE = re.compile(r"(?<=[.?!])\s+")
SCHEMA = "doc_id long, item_id long, passage_word long, bm25 double, containment double, question_overlap double, answer_overlap double"
K1, B = 1.2, 0.75


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8: runs of ASCII letters, digits and any characters beyond ASCII."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(APART).split()


def shingles(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    """Word n-grams; fewer words than ``n``: all of them as one."""
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def split_item(text: str) -> tuple[list[bytes], list[bytes]]:
    """(question words, answer words): the last sentence answers; an item of
    one sentence is cut after three quarters of its words."""
    parts = [w for w in (words_of(s) for s in SENTENCE.split(text or "")) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    ws = parts[0] if parts else []
    k = max(1, len(ws) * 3 // 4)
    return ws[:k], ws[k:]


class ItemStats(NamedTuple):
    """What BM25 and the passages need of all items with a word."""
    count: int
    mean: float                 # words of an item
    longest: int
    df: dict[bytes, int]        # items that hold a word


class ItemIndex:
    """Inverted index of test items with block maxima.  ``stats`` are those of all
    items where these are only a part of them; scores, thresholds and passages
    then are the same as in one index of all."""

    def __init__(self, items: list[tuple[int, str]], n: int, containment: float, part_overlap: float, block: int = 16,
                 stats: ItemStats | None = None) -> None:
        self.n, self.containment, self.part_overlap = n, containment, part_overlap
        texts = [(i, words_of(t), *split_item(t)) for i, t in items]
        texts = [x for x in texts if x[1]]
        self.ids = [x[0] for x in texts]
        self.shingles = [shingles(x[1], n) for x in texts]
        self.question, self.answer = [set(x[2]) for x in texts], [set(x[3]) for x in texts]
        here = Counter(w for x in texts for w in set(x[1]))
        count, mean, self.longest, df = stats or ItemStats(
            len(texts), sum(len(x[1]) for x in texts) / max(1, len(texts)), max((len(x[1]) for x in texts), default=1), here)
        self.term = {w: k for k, w in enumerate(sorted(here))}
        lists: list[list[tuple[int, float]]] = [[] for _ in here]
        self.theta = np.zeros(len(texts))
        for k, (_, ws, _, _) in enumerate(texts):
            tf = Counter(ws)
            w = {t: math.log(1 + (count - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(ws) / mean))
                 for t, c in tf.items()}
            full = sum(w.values())
            # k absent shingles are the end of k first occurrences of words; n - 1 more words can stand before the first end
            absent = math.floor((1 - containment) * len(self.shingles[k]) + 1e-9)
            may_miss = absent + n - 1 if absent else 0
            self.theta[k] = max(1e-6, 1 - sum(sorted(w.values(), reverse=True)[:may_miss]) / full - 1e-6)
            for t, x in w.items():
                lists[self.term[t]].append((k, x / full))
        self.start = np.r_[0, np.cumsum([len(p) for p in lists])].astype(np.int64)
        self.post = np.array([k for p in lists for k, _ in p], dtype=np.int64)
        self.impact = np.array([x for p in lists for _, x in p], dtype=np.float64)
        # block maxima: one posting per (term, block)
        tops = [defaultdict(float) for _ in lists]
        for top, p in zip(tops, lists):
            for k, x in p:
                top[k // block] = max(top[k // block], x)
        self.bstart = np.r_[0, np.cumsum([len(t) for t in tops])].astype(np.int64)
        self.bpost = np.array([b for t in tops for b in t], dtype=np.int64)
        self.btop = np.array([x for t in tops for x in t.values()], dtype=np.float64)
        self.block = block
        self.btheta = np.array([self.theta[i:i + block].min() for i in range(0, len(texts), block)])

    @staticmethod
    def _gather(start: np.ndarray, terms: np.ndarray) -> np.ndarray:
        n = start[terms + 1] - start[terms]
        return np.repeat(start[terms] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())

    def retrieve(self, tids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(items, scores) at or above their ``theta`` for the words ``tids``."""
        terms = np.unique(tids)
        none = np.empty(0, dtype=np.int64), np.empty(0)
        if not len(terms):
            return none
        at = self._gather(self.bstart, terms)
        live = np.bincount(self.bpost[at], self.btop[at], len(self.btheta)) >= self.btheta
        if not live.any():
            return none
        at = self._gather(self.start, terms)
        if not live.all():
            at = at[live[self.post[at] // self.block]]
        score = np.bincount(self.post[at], self.impact[at], len(self.ids))
        hit = np.flatnonzero((score >= self.theta) & live[np.arange(len(score)) // self.block])
        return hit, score[hit]

    def search(self, words: list[bytes]) -> list[tuple[int, int, float, float, float, float]]:
        """Verified items of one text, each at its first best passage."""
        get = self.term.get
        tids = np.array([get(w, -1) for w in words], dtype=np.int64)
        known = np.flatnonzero(tids >= 0)
        tids = tids[known]
        found: dict[int, tuple] = {}
        todo = [(0, len(words))]
        while todo:
            a, b = todo.pop()
            lo, hi = np.searchsorted(known, [a, b])
            items, scores = self.retrieve(tids[lo:hi])
            if not len(items):
                continue
            if b - a > 3 * self.longest:
                mid, half = (a + b) // 2, self.longest         # an overlap of a span: 2 * longest
                todo += [(mid - half, b), (a, mid + half)]
                continue
            passage = words[a:b]
            have, bag = shingles(passage, self.n), set(passage)
            for k, s in zip(items.tolist(), scores.tolist()):
                want = self.shingles[k]
                if len(next(iter(want))) < self.n:      # an item shorter than a shingle
                    have_k = shingles(passage, len(next(iter(want))))
                else:
                    have_k = have
                c = len(want & have_k) / len(want)
                q = len(self.question[k] & bag) / max(1, len(self.question[k]))
                r = len(self.answer[k] & bag) / len(self.answer[k]) if self.answer[k] else 1.0
                if c >= self.containment and min(q, r) >= self.part_overlap and (k not in found or c > found[k][2]):
                    found[k] = (a, s, c, q, r)
        return [(self.ids[k], *v) for k, v in sorted(found.items())]


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, word, n) of each distinct word of each item with n = null, and (block, null, n words) of the item."""
    for b in batches:
        rows = []
        for block, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if ws := words_of(t):
                rows += [(block, w, None) for w in set(ws)] + [(block, None, len(ws))]
        cols = list(zip(*rows)) or [()] * 3
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int64()))], names=["block", "word", "n"])


def item_blocks(items: DataFrame, item_id: str, item_text: str, block_bytes: int) -> Iterator[tuple[list[tuple[int, str]], ItemStats | None]]:
    """The items in blocks of about ``block_bytes`` of text, one after the other, with
    the statistics of all items where there is more than one block: document
    frequencies are counted over all blocks, and a block gets those of its own words."""
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).filter(
        "t is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("t").cast("long")).alias("n")).first()["n"] or 0
    if total <= block_bytes:
        yield [tuple(r) for r in rows.orderBy("i", "t").collect()], None
        return
    blocks = -(-total // block_bytes)
    placed = cut(rows.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks))), "bm25-items")
    words = cut(placed.select("block", "t").mapInArrow(_item_words, "block long, word binary, n long").groupBy("block", "word").agg(
        F.count(F.lit(1)).alias("items"), F.sum("n").alias("n"), F.max("n").alias("longest")), "bm25-words")
    lengths = words.filter("word is null").agg(F.sum("items").alias("c"), F.sum("n").alias("n"), F.max("longest").alias("longest")).first()
    per_block = words.filter("word is not null").select("block", "word", "items")
    df = cut(per_block.select("block", "word").join(per_block.groupBy("word").agg(F.sum("items").alias("df")), "word"), "bm25-df")
    for b in range(blocks):
        if part := [tuple(r) for r in placed.filter(F.col("block") == b).select("i", "t").orderBy("i", "t").collect()]:
            mine = {bytes(w): int(c) for w, c in df.filter(F.col("block") == b).select("word", "df").collect()}
            yield part, ItemStats(lengths["c"] or 0, (lengths["n"] or 0) / max(1, lengths["c"] or 0), lengths["longest"] or 1, mine)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", n: int = 5, containment: float = 0.8,
                 part_overlap: float = 0.5, block_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, item_id, passage_word, bm25, containment, question_overlap,
    answer_overlap): one row per document row and test item that it holds.

    A passage holds an item if it has ``containment`` of the item's distinct
    ``n``-word shingles and ``part_overlap`` of the distinct words of its
    question and of its answer (the last sentence).  ``passage_word`` is the
    first word of the passage (at most three times as long as the longest
    item) with the highest containment, the first of equals.

    Items are taken in blocks of ``block_bytes``, each sent to all tasks; statistics
    are those of all items, so the result does not depend on the blocks.  Null
    texts hold nothing and items without a word are left out; an item
    with a null id counts and keeps it; repeated documents give a row each, repeated items count once; null doc_ids
    are passed on; empty tables give an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for block, stats in item_blocks(items, item_id, item_text, block_bytes):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(block, n, containment, part_overlap, stats=stats))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            ix = index.value
            for b in batches:
                hits = [(d.as_py(), *h) for d, t in zip(b.column(0), b.column(1)) if ix.ids for h in ix.search(words_of(t.as_py()))]
                cols = list(zip(*hits)) or [()] * 7
                types = [pa.int64()] * 3 + [pa.float64()] * 4
                names = ["doc_id", "item_id", "passage_word", "bm25", "containment", "question_overlap", "answer_overlap"]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        part = rows.mapInArrow(run, SCHEMA)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                      n: int = 5, containment: float = 0.8, part_overlap: float = 0.5, block_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` with all its columns, without the rows that hold an item, as
    ``contaminated`` defines it: one pass for each block of items, no join.
    Rows with a null or empty text stay, repeated rows share their lot, all columns
    pass as they are whatever their names; without items every row stays, and an
    empty table gives an empty one."""
    for block, stats in item_blocks(items, item_id, item_text, block_bytes):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(block, n, containment, part_overlap, stats=stats))
        at = docs.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch], index=index, at=at) -> Iterator[pa.RecordBatch]:
            ix = index.value
            for b in batches:
                yield b.filter(pa.array([not ix.ids or not ix.search(words_of(t.as_py())) for t in b.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
