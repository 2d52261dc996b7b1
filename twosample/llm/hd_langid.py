"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1/-1.  An n-gram is bound by multiplying
the letters' vectors, each permuted (rotated) by its place in the n-gram; a
text is the bundle (sum) of its n-grams' vectors, a language the bundle of its
training texts.  A document gets the language whose prototype is nearest by
cosine.  Since bundling is linear, training adds up n-gram counts per language
by Spark (a bounded table: languages x n-grams) before vectors are formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = 48                # 0: no letter; 1-26: a-z; all other letters share the rest
GRAMS = SYMBOLS ** 3
UND = "und"


@lru_cache(1)
def _symbols() -> np.ndarray:
    """Symbol of every code point below 0x10000."""
    table = np.zeros(1 << 16, dtype=np.uint8)
    for c in range(1 << 16):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            table[c] = c - 96 if 97 <= c <= 122 else 27 + (c * 40503 >> 4) % (SYMBOLS - 27)
    return table


def gram_codes(text: str | None) -> np.ndarray | None:
    """Codes of the letter trigrams of a text, words set apart by one blank;
    None without a letter."""
    cp = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if len(cp) and cp.max() >= 1 << 16:
        far = cp >= 1 << 16
        s = _symbols()[np.where(far, 0, cp)]
        s[far] = [27 + c % (SYMBOLS - 27) if chr(c).isalpha() else 0 for c in cp[far].tolist()]
    else:
        s = _symbols()[cp]
    if not s.any():
        return None
    s = np.r_[np.uint8(0), s, np.uint8(0)]
    s = s[np.r_[True, (s[1:] | s[:-1]) != 0]].astype(np.int32)
    codes = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
    return codes[s[1:-1] != 0]


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their counts."""
    codes = np.sort(codes)
    at = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[at], np.diff(np.r_[at, len(codes)])


@lru_cache(1)
def gram_vectors(dims: int, seed: int) -> np.ndarray:
    """Vector of every trigram: the letters' vectors, permuted by their place
    and multiplied (one byte an entry)."""
    v = np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.int8), (SYMBOLS, dims))
    first, second = np.roll(v, 2, axis=1), np.roll(v, 1, axis=1)
    pairs = (first[:, None, :] * second[None, :, :]).reshape(-1, 1, dims)
    return (pairs * v[None, :, :]).reshape(-1, dims)


def bundle(codes: np.ndarray, counts: np.ndarray, dims: int, seed: int) -> np.ndarray:
    """Sum of the n-gram vectors, each times its count, block by block."""
    table, out = gram_vectors(dims, seed), np.zeros(dims, dtype=np.float32)
    for i in range(0, len(codes), 1024):
        out += counts[i:i + 1024].astype(np.float32) @ table[codes[i:i + 1024]].astype(np.float32)
    return out.astype(np.float64)


def learn(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang",
          dims: int = 1024, seed: int = 7) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes (unit length) from all rows where
    ``train`` holds and the language is not null.  A task sends each language's counts
    once; the driver gets one row per language and n-gram of the alphabet."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b["text"], b["lang"]):
                if (codes := gram_codes(text)) is not None:
                    np.add.at(got.setdefault(lang, np.zeros(GRAMS, dtype=np.int64)), codes, 1)
        for lang, n in got.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "code": at, "n": n[at]})

    rows = docs.filter(train & F.col(lang_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sums = (rows.mapInPandas(count, "lang string, code long, n long")
            .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    per = sums.groupBy("lang").agg(F.collect_list(F.struct("code", "n")).alias("grams"))
    langs, protos = [], []
    for r in per.orderBy("lang").collect():
        grams = np.array([(x["code"], x["n"]) for x in sorted(r["grams"])], dtype=np.int64)
        p = bundle(grams[:, 0], grams[:, 1], dims, seed)
        langs.append(r["lang"])
        protos.append(p / (np.linalg.norm(p) or 1.0))
    return langs, np.array(protos).reshape(len(langs), dims)


def predict(text: str | None, langs: list[str], protos: np.ndarray, dims: int, seed: int) -> tuple[str, float]:
    """(language, cosine) of one text."""
    codes = gram_codes(text)
    if codes is None or not langs:
        return UND, 0.0
    v = bundle(*counted(codes), dims, seed)
    sims = protos @ v / (np.linalg.norm(v) or 1.0)
    k = int(np.argmax(sims))
    return langs[k], min(1.0, max(0.0, float(sims[k])))


def identify(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", dims: int = 1024, seed: int = 7) -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs``.

    ``lang_pred`` is a learned language, or ``und`` (score 0) if the text is
    null or has no letter, or nothing could be learned.  ``score`` is the
    cosine with the language's prototype, at least 0; ties go to the
    language that sorts first.  Ids are passed on as they are, null or
    repeated; an empty table gives an empty result; other columns are ignored.
    """
    langs, protos = learn(docs, train, text_col, lang_col, dims, seed)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [predict(t.as_py(), langs, protos, dims, seed) for t in b.column(1)]
            yield pa.record_batch({"doc_id": b.column(0), "lang_pred": pa.array([x[0] for x in got], pa.string()),
                                   "score": pa.array([x[1] for x in got], pa.float64())})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        score, "doc_id long, lang_pred string, score double")


def drop_unidentified(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang",
                      dims: int = 1024, seed: int = 7, least: float = 0.0) -> DataFrame:
    """``docs`` with all its columns, without the rows that ``identify`` calls
    ``und`` or scores below ``least``; every row goes if nothing could be learned."""
    langs, protos = learn(docs, train, text_col, lang_col, dims, seed)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [predict(t.as_py(), langs, protos, dims, seed) for t in b.column(at)]
            yield b.filter(pa.array([x != UND and s >= least for x, s in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
