"""Toxicity by compression distance.

Two zstandard raw-content dictionaries are trained on labelled text. The ordinary
one holds the strings that cover ordinary windows best. The toxic one holds the
same strings and, besides, those that toxic text has far more often than ordinary
text, so that both compress ordinary writing alike. A text is cut into windows of
words; a window's gain is the length by which the toxic dictionary compresses it
better. Each window stands between two copies of a line that both dictionaries end
with, so that a frame's fixed costs do not depend on the window and its last bytes,
where the compressor looks for no match, are not the window's. Windows are so short
that bytes without a match are stored as they are.

A document's score is a logistic calibration of how many of its windows reach each
gain, fitted on labelled documents that did not go into the dictionaries.

Strings are counted by distinct (previous word, word) pairs, not by occurrences,
so a passage that is copied a thousand times counts once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import small_batches, whole_text
from tidemark.llm.labelled import fold, labelled_sample


SAMPLE_PER_CLASS = 6000  # bound of the labelled documents that a model is fitted on
CALIBRATE_FOLDS = 3  # one in three of them calibrates, the others train the dictionaries
WINDOW = 48  # bytes, then on to the end of the word
ORDINARY_BYTES = 4096
ORDINARY_WINDOWS = 40_000
TOXIC_STRINGS = 400
MIN_PAIRS, MIN_LIFT, MIN_G2 = 5, 10.0, 15.0
SHORTEST, LONGEST = 6, 12
LINE = b"<window of ordinary text>"
WORD = "[^\\x00-\\x40\\x5b-\\x60\\x7b-\\x7f]+"
_words = re.compile(WORD.encode()).findall
_windows = re.compile(rb"\S.{0,%d}\S* " % (WINDOW - 1)).findall
GAINS = range(2, 11)


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    mean: tuple
    scale: tuple
    weights: tuple  # intercept first


def windows(text: str) -> list[bytes]:
    """Lower-cased words joined by spaces, cut after at least ``WINDOW`` bytes at a word's end."""
    flat = b" ".join(_words(text.lower().encode()))
    return [LINE + b" " + w + LINE for w in _windows(flat + b" ")] if flat else []


def _compressor(content: bytes) -> zs.ZstdCompressor:
    held = zs.ZstdCompressionDict(b" " + content + LINE * 2, dict_type=zs.DICT_TYPE_RAWCONTENT)
    how = zs.ZstdCompressionParameters(
        strategy=zs.STRATEGY_GREEDY, window_log=17, chain_log=16, hash_log=17, search_log=6, min_match=6, target_length=16,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    held.precompute_compress(compression_params=how)
    return zs.ZstdCompressor(dict_data=held, compression_params=how)


@lru_cache(maxsize=2)
def _pair(ordinary: bytes, toxic: bytes):
    return _compressor(ordinary).compress, _compressor(toxic).compress


def gains(text: str, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Bytes by which the toxic dictionary beats the ordinary one, per window; [0] for an empty text."""
    plain, other = _pair(ordinary, toxic)
    return np.array([len(plain(w)) - len(other(w)) for w in windows(text)] or [0])


def features(gain: np.ndarray) -> np.ndarray:
    reach = np.array([(gain >= g).sum() for g in GAINS])
    return np.concatenate([reach / len(gain), np.log1p(reach), [np.log(len(gain)), gain.mean(), min(gain.max(), 15)]])


def toxic_strings(pairs: DataFrame) -> list[bytes]:
    """At most ``TOXIC_STRINGS`` strings (a space, the beginning of a word or a
    whole word) that toxic text has far more often. ``pairs``: y, before, word, distinct."""
    totals = {r["y"]: r["n"] for r in pairs.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, plain = float(totals.get(1, 0)), float(totals.get(0, 0))
    if not toxic or not plain:
        return []
    in_class = lambda y: F.sum((F.col("y") == y).cast("long"))
    words = pairs.groupBy("word").agg(in_class(1).alias("a"), in_class(0).alias("b"))
    spaced = F.concat(F.lit(" "), "word", F.lit(" "))
    heads = F.transform(F.sequence(F.lit(SHORTEST), F.greatest(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length(spaced)))),
                        lambda n: F.substring(spaced, F.lit(1), n))
    strings = (words.select("a", "b", F.explode(F.array_distinct(F.concat(heads, F.array(spaced)))).alias("s"))
               .where((F.length("s") >= 5) & (F.length("s") <= 20)).groupBy("s").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
               .where((F.col("a") >= MIN_PAIRS) & (F.col("a") / toxic >= MIN_LIFT * (F.col("b") + 0.5) / plain)))
    both = (F.col("a") + F.col("b")) / (toxic + plain)
    part = lambda k, n: F.when(k > 0, k * F.log(k / n / both)).otherwise(0.0) + (n - k) * F.log((1 - k / n) / (1 - both))
    g2 = 2 * (part(F.col("a"), F.lit(toxic)) + part(F.col("b"), F.lit(plain)))
    ranked = strings.withColumn("g", g2).where(F.col("g") >= MIN_G2).orderBy(F.desc("g"), F.desc(F.length("s")), "s").limit(4 * TOXIC_STRINGS)
    kept: list[str] = []
    for r in ranked.collect():  # a bounded list; strings inside or around a stronger one add little but noise
        if not any(r["s"] in k or k in r["s"] for k in kept):
            kept.append(r["s"])
    return [s.encode() for s in kept[:TOXIC_STRINGS]]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    w = np.zeros(z.shape[1])
    penalty = np.r_[0.0, np.full(len(w) - 1, ridge)]
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-6), z.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held_out: int = 0,
        per_class: int = SAMPLE_PER_CLASS) -> Model:
    """A model from at most ``per_class`` labelled documents of each class, none
    of them in fold ``held_out``. Where a class is missing, the score is a constant:
    the share of label 1 among the rows seen, a half without any."""
    sample, shift = labelled_sample(docs, labels, label, fold(F.col("doc_id"), folds) != held_out, per_class)
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(CALIBRATE_FOLDS)) == 0
    trains = sample.where(~calibrates)
    words = F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))
    cut = trains.select("y", words.alias("w")).where(F.size("w") > 0)
    at = F.transform("w", lambda w, i: F.struct(F.when(i > 0, F.get("w", i - 1)).otherwise("").alias("before"), w.alias("word")))
    strings = toxic_strings(cut.select("y", F.inline(at)).distinct())
    seen = trains.where("y = 0").select("text").orderBy(F.xxhash64("text")).limit(2000).toPandas()["text"]  # bounded by the sample
    some = [w[len(LINE):-len(LINE)] for t in seen for w in windows(t)[:400]][:ORDINARY_WINDOWS]
    try:
        base = zs.train_dictionary(ORDINARY_BYTES, some).as_bytes()
    except zs.ZstdError:  # too little text to train on: the text itself
        base = b"".join(some)[:ORDINARY_BYTES]
    ordinary, toxic = base, b"".join(reversed(strings)) + base
    rows = sample.where(calibrates).select("y", "text")

    def measure(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([features(gains(t.as_py(), ordinary, toxic)).tolist() for t in b.column(1)], pa.list_(pa.float64()))],
                                  names=["y", "x"])

    got = rows.mapInArrow(measure, "y int, x array<double>").toPandas()  # at most a third of the sample, a few numbers each
    y = got["y"].to_numpy(float)
    width = len(features(np.array([0])))
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        bias = np.log((share + 1e-3) / (1 - share + 1e-3))
        return Model(ordinary, toxic, (0.0,) * width, (1.0,) * width, (float(bias), *[0.0] * width))
    mean, scale, w = _logistic(np.stack(got["x"].to_numpy()), y)
    w[0] += shift
    return Model(ordinary, toxic, tuple(mean), tuple(scale), tuple(w))


def score(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """``carry`` columns of ``docs`` with score (0 to 1), n_windows and max_gain of every whole text."""
    fields = [docs.schema[c] for c in carry]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("n_windows", T.IntegerType()),
                           T.StructField("max_gain", T.IntegerType())])
    mean, scale, weights = (np.array(x) for x in (model.mean, model.scale, model.weights))

    def judge(batches):
        for b in batches:
            of = [gains(t.as_py(), model.ordinary, model.toxic) for t in b.column(b.num_columns - 1)]
            x = np.array([features(g) for g in of]).reshape(len(of), len(mean))
            z = weights[0] + (x - mean) / scale @ weights[1:]
            yield pa.record_batch([*b.columns[:-1], pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30)))), pa.array([len(g) for g in of], pa.int32()),
                                   pa.array([int(g.max()) for g in of], pa.int32())], names=schema.names)

    return small_batches(docs).select(*carry, whole_text().alias("__text")).mapInArrow(judge, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted, n_windows, max_gain of every row.

    Null and empty texts get the score of a window without gain; rows with a null
    doc_id are scored like others and are not held out. lang, source and other columns are not read."""
    model = fit(docs, labels, folds=folds, held_out=held_out)
    out = score(docs, model, ["doc_id"])
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "n_windows", "max_gain")


def without_toxic(docs: DataFrame, learn_from: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents of ``docs`` that score below ``threshold``, with their
    columns; the model learns from the labelled rows of ``learn_from``."""
    model = fit(learn_from, labels)
    packed = docs.select(F.struct(*docs.columns).alias("__row"), "text")
    return score(packed, model, ["__row"]).where(F.col("score") < threshold).select("__row.*")
