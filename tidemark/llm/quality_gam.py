"""Document quality by a generalised additive model with pairwise interactions.

Each document is a row of numeric features of its whole text. A feature is cut into
bins at quantiles of the training rows; the model is one lookup table per feature
and one per chosen pair of features, on the logit scale. Training is cyclic boosting:
round after round each feature in turn gets a shallow tree over its bins, fitted to
the current residuals and added to its table with a small rate. The pairs whose
two-way cuts explain the remaining residuals best are boosted in the same way after that.
Scoring adds the looked-up values of all tables, vectorised over rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import small_batches, whole_text
from tidemark.llm.labelled import fold, labelled_sample

SAMPLE_PER_CLASS = 8000  # bound of the labelled documents that a model is fitted on
BINS, PAIR_BINS = 64, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 250, 120, 8
RATE, LEAVES, MIN_WEIGHT = 0.1, 3, 8.0

_words = re.compile(r"[^\W\d_]+").findall
FEATURES = ("length", "words", "word_length", "long_words", "distinct_words", "repeated_next", "top_word", "upper", "digits", "symbols",
            "symbol_runs", "spaces", "lines", "distinct_lines", "line_length", "sentence_ends", "bars", "exclaims", "accents", "compressed", "capitalised")
_RUNS = re.compile(r"([^\w\s])\1\1").findall


def features(text: str) -> list[float]:
    """The features of a whole text, in the order of ``FEATURES``; an empty text gives zeros."""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    words = _words(text)
    w = max(1, len(words))
    lower = list(map(str.lower, words))
    counts = Counter(lower)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    raw = text.encode()
    codes = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(codes, minlength=256)
    letters, spaces = kinds[65:91].sum() + kinds[97:123].sum(), kinds[32] + kinds[9:14].sum()
    accents, digits = kinds[192:].sum(), kinds[48:58].sum()
    symbols = kinds[33:127].sum() - letters - digits
    out = [float(np.log1p(n)), float(np.log1p(len(words))), sizes.sum() / w, (sizes > 12).sum() / w,
            len(counts) / w, sum(map(eq, lower, lower[1:])) / w, max(counts.values(), default=0) / w,
            kinds[65:91].sum() / n, digits / n, symbols / n, len(_RUNS(text)) / w, spaces / n, float(np.log1p(len(lines))),
            len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)), (kinds[46] + kinds[33] + kinds[63]) / w, kinds[124] / w, kinds[33] / w,
            accents / n, len(zlib.compress(raw, 1)) / len(raw), sum(map(str.istitle, words)) / w]
    return [float(v) for v in out]


@dataclass(frozen=True)
class Model:
    edges: list  # per feature: cuts of its bins
    tables: list  # per feature: value per bin
    pair_edges: list
    pairs: list  # ((feature, feature), table)
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for j, (cuts, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(cuts, x[:, j], "right")]
        for (a, b), table in self.pairs:
            out += table[np.searchsorted(self.pair_edges[a], x[:, a], "right"), np.searchsorted(self.pair_edges[b], x[:, b], "right")]
        return out


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="higher"))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Newton step per bin of the best tree of ``leaves`` leaves over ordered bins."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None)
        for a, b in parts:
            if b - a < 2:
                continue
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            lg, lh, tg, th = cg[:-1], ch[:-1], cg[-1], ch[-1]
            gain = lg ** 2 / (lh + 1) + (tg - lg) ** 2 / (th - lh + 1) - tg ** 2 / (th + 1)
            gain[(lh < MIN_WEIGHT / 4) | (th - lh < MIN_WEIGHT / 4)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (a, a + k + 1, b))
        if best[1] is None:
            break
        a, m, b = best[1]
        parts.remove((a, b))
        parts += [(a, m), (m, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray):
    """Best cut of a table of bins into four: (gain, step per cell)."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a, ah = cg[:-1, :-1], ch[:-1, :-1]
    b, bh = cg[:-1, -1:] - a, ch[:-1, -1:] - ah
    c, chh = cg[-1:, :-1] - a, ch[-1:, :-1] - ah
    d, dh = cg[-1, -1] - a - b - c, ch[-1, -1] - ah - bh - chh
    if not a.size:
        return 0.0, np.zeros_like(g)
    gain = sum(x ** 2 / (y + 1) for x, y in ((a, ah), (b, bh), (c, chh), (d, dh)))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    step = np.empty_like(g)
    for rows, cols, x, y in ((slice(0, i + 1), slice(0, j + 1), a, ah), (slice(0, i + 1), slice(j + 1, None), b, bh),
                             (slice(i + 1, None), slice(0, j + 1), c, chh), (slice(i + 1, None), slice(j + 1, None), d, dh)):
        step[rows, cols] = x[i, j] / (y[i, j] + 1)
    return float(gain[i, j] - g.sum() ** 2 / (h.sum() + 1)), step


def train(x: np.ndarray, y: np.ndarray) -> Model:
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias, n_features = float(np.log(share / (1 - share))), x.shape[1]
    edges = [_cuts(x[:, j], BINS) if len(x) else np.zeros(0) for j in range(n_features)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    pair_edges = [_cuts(x[:, j], PAIR_BINS) if len(x) else np.zeros(0) for j in range(n_features)]
    if not len(y) or y.min() == y.max():
        return Model(edges, tables, pair_edges, [], bias)
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    logit = np.full(len(y), bias)
    slope = lambda: (y - (p := 1 / (1 + np.exp(-logit))), p * (1 - p))
    for _ in range(ROUNDS):
        for j in range(n_features):
            g, h = slope()
            step = RATE * _tree(np.bincount(at[j], g, len(tables[j])), np.bincount(at[j], h, len(tables[j])), LEAVES)
            tables[j] += step
            logit += step[at[j]]
    pair_at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(pair_edges)]
    shape = [len(e) + 1 for e in pair_edges]

    def cells(a, b, v):
        return np.bincount(pair_at[a] * shape[b] + pair_at[b], v, shape[a] * shape[b]).reshape(shape[a], shape[b])

    g, h = slope()
    ranked = sorted(((_quadrants(cells(a, b, g), cells(a, b, h))[0], a, b) for a in range(n_features) for b in range(a)), reverse=True)
    pairs = [[(a, b), np.zeros((shape[a], shape[b]))] for gain, a, b in ranked[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in pairs:
            g, h = slope()
            step = RATE * _quadrants(cells(a, b, g), cells(a, b, h))[1]
            table += step
            logit += step[pair_at[a], pair_at[b]]
    return Model(edges, tables, pair_edges, [tuple(p) for p in pairs], bias)


def _feature_rows(texts) -> np.ndarray:
    return np.array([features(t.as_py()) for t in texts], float).reshape(-1, len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """A model from at most ``per_class`` labelled documents of each class, none of
    them in fold ``held_out``. Where a class is missing, every score is the smoothed
    share of label 1 (a half without labels)."""
    sample, shift = labelled_sample(docs, labels, label, fold(F.col("doc_id"), folds) != held_out, per_class)

    def measure(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(_feature_rows(b.column(1)).tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    got = sample.select("y", "text").mapInArrow(measure, "y int, x array<double>").toPandas()  # bounded by the sample
    x = np.stack(got["x"].to_numpy()) if len(got) else np.zeros((0, len(FEATURES)))
    order = np.lexsort(x.T) if len(x) else []
    model = train(x[order], got["y"].to_numpy(float)[order])
    return replace(model, bias=model.bias + shift)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted of every row. Null and empty texts are
    scored by their features (zeros); a null doc_id is not held out. No other column is read."""
    model = fit(docs, labels, folds=folds, held_out=held_out)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])

    def judge(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(1 / (1 + np.exp(-model.logit(_feature_rows(b.column(1))))))], names=schema.names)

    out = small_batches(docs).select("doc_id", whole_text().alias("text")).mapInArrow(judge, schema)
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
