"""Spelling variants by permuterm rotations.

A word is marked with a terminator and rotated once per position.  For a word
``a c b`` with the edited character ``c`` the rotation ``b $ a c`` ends in it, so
all words that differ in that character alone share the prefix ``b $ a``, and a
word without it has ``b $ a`` as a full rotation.  The rotations, once whole and
once without their last character, are range-partitioned and sorted; a scan
meets each group of equal prefixes as one run.  A run holds at most one word per
letter and one full rotation, so it is bounded by the alphabet, however
many words there are.  Each member takes from its run the number of the others and the
best of them; no pair is written.

An inserted character next to an equal one makes the same word at either place, so a
shortened rotation counts for indels only where its character differs from the
one before it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

RUN = re.compile("[a-zÀ-ÿ]+")       # after lower-casing A-Z
END = "$"                                       # no word holds it
HELD_WORDS = 300_000                            # words a task counts before it hands them on


def misspelt(word: str, h: int, every: int) -> str:
    """``word`` without its code point ``h`` % length where ``every`` divides ``h``."""
    if not every or h % every:
        return word
    i = h % len(word)
    return word[:i] + word[i + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = 0) -> DataFrame:
    """(word, n): how often each run of letters occurs in whole texts, A-Z lower-cased.

    ``damage`` plants slips: with h the unsigned crc32 of ``<id>:<word>``, a word whose h
    it divides loses a code point.  Null texts hold none; null ids count as empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                start = zlib.crc32(f"{doc or ''}:".encode())
                # bytes.lower changes A-Z only
                for w, n in Counter(RUN.findall(text.encode().lower().decode())).items():
                    total[misspelt(w, zlib.crc32(w.encode(), start), damage)] += n
                if len(total) >= HELD_WORDS:
                    yield pa.record_batch({"word": list(total), "n": pa.array(total.values(), pa.int64())})
                    total.clear()
        if total:
            yield pa.record_batch({"word": list(total), "n": pa.array(total.values(), pa.int64())})
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, word, n, cut, indel): every rotation of the marked words, whole (``cut``
    false) and without its last character; ``indel``: that character differs from the one before it."""
    at, size = F.col("at"), F.length("word")
    before, after = F.substring("word", F.lit(1), at), F.expr("substring(word, at + 1)")
    whole = words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("at")).select(
        F.concat(after, F.lit(END), before).alias("prefix"), "word", "n", F.lit(False).alias("cut"), F.lit(False).alias("indel"))
    short = words.select("word", "n", F.explode(F.sequence(F.lit(1), size)).alias("at")).select(
        F.concat(after, F.lit(END), F.substring("word", F.lit(1), at - 1)).alias("prefix"), "word", "n", F.lit(True).alias("cut"),
        ((at == 1) | (F.substring("word", at - 1, F.lit(1)) != F.substring("word", at, F.lit(1)))).alias("indel"))
    return whole.union(short)


def _best(members: list[tuple]) -> list[tuple]:
    """The two best (largest n, then smallest word) of (word, n, indel)."""
    return sorted(members, key=lambda m: (-m[1], m[0]))[:2]


def _neighbours(run: list[tuple]) -> Iterator[tuple]:
    """(word, near, best word, its n) from one run of equal prefixes."""
    cuts = [(w, n, indel) for w, n, is_cut, indel in run if is_cut]
    whole = [(w, n, False) for w, n, is_cut, _ in run if not is_cut]
    top = _best(cuts)
    for w, n, indel in cuts:
        near = len(cuts) - 1 + (indel and len(whole))
        if near:
            best = _best([m for m in top if m[0] != w] + (whole if indel else []))[0]
            yield w, near, best[0], best[1]
    grown = [m for m in cuts if m[2]]
    if whole and grown:
        best = _best(grown)[0]
        yield whole[0][0], len(grown), best[0], best[1]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    out: list[tuple] = []
    for _, run in groupby(rows(), key=lambda r: r[0]):
        members = [r[1:] for r in run]
        if len(members) > 1:
            out.extend(_neighbours(members))
        if len(out) >= 50_000:
            yield pa.record_batch(dict(zip(("word", "near", "best", "best_n"), map(list, zip(*out)))))
            out = []
    if out:
        yield pa.record_batch(dict(zip(("word", "near", "best", "best_n"), map(list, zip(*out)))))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of the ``words`` (word, n; distinct) that have near
    words, those at exactly one inserted, deleted or replaced code point."""
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = rotations(words).repartitionByRange(tasks, "prefix").sortWithinPartitions("prefix")
    near = runs.mapInArrow(_scan, "word string, near long, best string, best_n long")
    first = F.min(F.struct((-F.col("best_n")).alias("minus_n"), F.col("best").alias("best")))
    return near.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("f")).select(
        "word", "n_near", F.col("f.best").alias("best"), (-F.col("f.minus_n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from ``forms`` (word, form; form not null): each round doubles the
    way along the forms, so as many rounds as the longest way has binary digits."""
    step = cut(forms.select("word", F.col("form").alias("root")), "variant-steps")
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = cut(step.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                       F.col("further").isNotNull().alias("moved")), "variant-steps")
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        step = step.select("word", "root")


def spelling_variants(counts: DataFrame, min_chars: int = 5, min_count: int = 3, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per word of ``counts`` (word, n) with at
    least ``min_chars`` code points and ``min_count`` occurrences.

    A word's form is its near word of largest n (ties: the smallest in code-point
    order) if that n is at least ``ratio`` times its own, else null; its root is where the
    forms lead.  Null words and counts are left out; rows that repeat a word are
    added up; an empty table gives an empty result; other columns are ignored.  ``ratio`` above 1
    makes n grow along the forms, so they cannot go round."""
    words = counts.filter(F.length("word") >= min_chars).groupBy("word").agg(F.sum(F.col("n").cast("long")).alias("n"))
    words = cut(words.filter(F.col("n") >= min_count), "variant-words")
    # ratio * n, not best_n / ratio: whole numbers
    found = words.join(near_words(words), "word", "left").withColumn("fits", F.col("best_n") >= F.lit(ratio) * F.col("n"))
    found = cut(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(F.col("fits"), F.col("best")).alias("form"), F.when(F.col("fits"), F.col("best_n")).alias("form_n")), "variant-forms")
    ends = roots(found.filter("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
