"""Quality classifier: a generalised additive model with pairwise interactions.

Features of whole texts are cut into bins.  Shallow trees are boosted in turn
on one feature after the other; a tree on one feature is a step function over
its bins, so all trees of a feature add up to one lookup table.  The strongest
pairs of features get tables of their own, boosted on what the features leave.
A score is a sum of table entries, looked up for whole columns at once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

FEATURES = ["log_words", "word_len", "upper", "digits", "marks", "odd_marks", "doubled_marks", "distinct_words",
            "same_as_last", "top_word", "line_len", "same_lines", "stop_marks", "lone_marks"]
_DOUBLED = re.compile(r"[^\w\s]{2}")


def text_features(text: str | None) -> list[float]:
    """The features of one whole text; an empty text has zeros."""
    t = text or ""
    words = t.split()
    if not words:
        return [0.0] * len(FEATURES)
    cp = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ascii_ = cp[cp < 128]
    n, kinds = len(cp), np.bincount(ascii_, minlength=128)
    upper, digits = kinds[65:91].sum(), kinds[48:58].sum()
    marks = kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()
    stops = kinds[[44, 46, 63, 58, 59]].sum()
    seen = Counter(words)
    lines = [x for x in t.split("\n") if x.strip()]
    return [float(np.log1p(len(words))), n / len(words), upper / n, digits / n, marks / n, (marks - stops) / n,
            len(_DOUBLED.findall(t)) / len(words), len(seen) / len(words) ** 0.8,
            sum(map(str.__eq__, words, words[1:])) / len(words), max(seen.values()) / len(words),
            float(np.log1p(n / max(1, len(lines)))), 1 - len(set(lines)) / max(1, len(lines)), stops / len(words),
            sum(1 for w in words if len(w) == 1 and not w.isalnum()) / len(words)]


@dataclass
class Gam:
    """Bin edges and lookup tables; ``pairs``: (i, j, table) over coarse bins."""
    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        b = self.bins(x)
        z = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            z += t[b[f]]
        for i, j, t in self.pairs:
            z += t[self.coarse[i][b[i]], self.coarse[j][b[j]]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _leaves(g: np.ndarray, h: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Best-first tree of ``leaves`` leaves over ordered bins: a value per bin."""
    cuts = [0, len(g)]
    cg, ch = np.r_[0.0, np.cumsum(g)], np.r_[0.0, np.cumsum(h)]

    def part(a: int, b: int) -> float:
        return (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + 1.0)

    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            k = np.arange(a + 1, b)
            k = k[(ch[k] - ch[a] >= least) & (ch[b] - ch[k] >= least)]
            if len(k):
                gain = (cg[k] - cg[a]) ** 2 / (ch[k] - ch[a] + 1.0) + (cg[b] - cg[k]) ** 2 / (ch[b] - ch[k] + 1.0) - part(a, b)
                m = int(np.argmax(gain))
                if gain[m] > best[0]:
                    best = (gain[m], int(k[m]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = -(cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, np.ndarray]:
    """One cut of the rows, one of the columns on either side: (gain, values)."""
    best_gain, best = -1.0, np.zeros_like(g)
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    for r in range(1, g.shape[0]):
        out, gain = np.zeros_like(g), -whole
        for rows in (slice(0, r), slice(r, None)):
            cg, ch = g[rows].sum(axis=0), h[rows].sum(axis=0)
            v = _leaves(cg, ch, 2, least)
            out[rows] = v
            gain += float((v ** 2 * (ch + 0)).sum())
        if gain > best_gain:
            best_gain, best = gain, out
    return best_gain, best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, max_bins: int = 48, pair_bins: int = 8,
        pairs: int = 6, pair_rounds: int = 40, least: float = 2.0) -> Gam:
    """Cyclic boosting of the tables; least: Hessian weight in a leaf."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, max_bins + 1)[1:-1])) if len(x) else np.empty(0)
             for f in range(x.shape[1])]
    coarse = [np.minimum(np.arange(len(e) + 1) * pair_bins // (len(e) + 1), pair_bins - 1) for e in edges]
    p0 = (y.sum() + 0.5) / (len(y) + 1.0)
    model = Gam(edges, float(np.log(p0 / (1 - p0))), [np.zeros(len(e) + 1) for e in edges], coarse, [])
    if len(np.unique(y)) < 2:
        return model
    b, z = model.bins(x), np.full(len(y), model.base)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for f in range(x.shape[1]):
            g, h = gradients()
            k = len(edges[f]) + 1
            step = rate * _leaves(np.bincount(b[f], g, k), np.bincount(b[f], h, k), 3, least)
            model.tables[f] += step
            z += step[b[f]]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        g, h = gradients()
        at = coarse[i][b[i]] * pair_bins + coarse[j][b[j]]
        return at, *(np.bincount(at, w, pair_bins ** 2).reshape(pair_bins, pair_bins) for w in (g, h))

    ranked = sorted(((_pair_tree(*sums(i, j)[1:], least)[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
    model.pairs = [(i, j, np.zeros((pair_bins, pair_bins))) for _, i, j in ranked[:pairs]]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            at, g, h = sums(i, j)
            step = rate * _pair_tree(g, h, least)[1]
            table += step
            z += step.ravel()[at]
    return model


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x: array of FEATURES), one row per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch({"doc_id": b.column(0), "x": pa.array(
                [text_features(t.as_py()) for t in b.column(1)], pa.list_(pa.float64()))})
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, x array<double>")


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_id: str = "doc_id", label_col: str = "quality", max_train_rows: int = 20_000,
                   threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    The model learns from at most ``max_train_rows`` labelled rows where
    ``held_out`` (an expression over ``doc_id``) is false: those with the
    smallest md5 of their id, so the choice does not depend on the layout.
    A label is learned once however many rows share its id (least features).
    Null labels are left out; with no row or one class to learn from, the
    score is that share of labels.  Null texts count as empty.  Repeated rows
    stay; an empty table gives an empty result; other columns are ignored.
    """
    rows = cut(features(docs, id_col, text_col), "quality-features")
    known = labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        "label is not null and doc_id is not null").filter(~held_out)
    pick = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "label").limit(max_train_rows)
    one = rows.join(pick.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("x").alias("x"))
    train = one.join(pick, "doc_id").select("doc_id", "x", "label").toPandas().sort_values(["doc_id", "label"])
    x = np.array(train["x"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    model = fit(x, train["label"].to_numpy(dtype=np.float64))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = model.score(np.array(b["x"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES)))
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": s})

    return rows.mapInPandas(score, "doc_id long, score double").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
