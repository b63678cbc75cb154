"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens in which numbers, names and units are typed
placeholders. Windows of ``WINDOW`` tokens of the benchmark items and of the documents
are joined on their hash, so that a question matches its copies and also its
re-parameterised copies. What a placeholder stood for is its slot value; a match
counts if the values of an item map consistently to those of the document.
A document leaks an item if it holds at least ``COVERAGE`` of the item's windows.

Documents emit only windows that a bitmap of the benchmark's hashes lets through;
the bitmap has a fixed size (``BITMAP_BITS``), whatever the benchmark, and false
positives end in the join. Windows of which less than ``LITERALS`` tokens are
words of their own are left out on both sides: placeholders alone tell nothing.
An item without such a window is held by a document that has its whole sequence of
tokens, with the values they have (upper and lower case are equal); ``shortest`` is the
least number of tokens of items searched this way.

An item of n windows that needs m of them shares at least one of any n - m + 1: its rarest ones in
the documents find the candidates, and only candidate pairs of text and item meet in all windows. So a window
that many items and many documents share does not pair them all.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, whole_text
from tidemark.session import materialize

WINDOW = 5
LITERALS = 3
COVERAGE = 0.6
BITMAP_BITS = 24
MEMO = 200_000

NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half dozen".split())
UNITS = frozenset(
    "mm cm m km meter meters metre metres kilometer kilometers kilometre kilometres inch inches foot feet yard yards mile miles "
    "g kg mg gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds ml l liter liters litre litres gallon gallons "
    "second seconds sec minute minutes min hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros percent degree degrees kmh mph watt watts volt volts joule joules".split())

_cut = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?\n]").findall
LITERAL, CAPITAL, NUMBER, END, UNIT = range(5)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash
_PLACE = {k: np.uint64(xxhash.xxh64_intdigest(name.encode(), 1) & ~7) for k, name in ((CAPITAL, "<name>"), (NUMBER, "<number>"), (UNIT, "<unit>"))}


class _Words(dict):
    """Token -> its hash with its kind in the lowest three bits; a bounded memo."""

    def __missing__(self, token: str) -> int:
        low = token.lower()
        if token in ".!?\n":
            kind = END
        elif token[0].isdigit() or low in NUMBER_WORDS:
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        elif len(token) > 1 and token[0].isupper() and not token.isupper():
            kind = CAPITAL
        else:
            kind = LITERAL
        got = xxhash.xxh64_intdigest(low.encode(), 1) & ~7 | kind
        if len(self) < MEMO:
            self[token] = got
        return got


_memo = _Words()
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sequences(raw: list[str], keep: np.ndarray, lengths: list[int]) -> np.ndarray:
    """A hash of every sequence of so many tokens, values and all: a window's sum of
    token * inverse power is a difference of running sums, shifted back to power 0."""
    n = len(keep)
    value = np.fromiter((_memo[raw[k]] & ~7 for k in keep.tolist()), np.uint64, n)
    power = np.ones(n + 1, np.uint64)
    back = power.copy()
    power[1:], back[1:] = _BASE, _INVERSE
    power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
    total = np.append(np.uint64(0), np.cumsum(value * power[:n], dtype=np.uint64))
    out = [_mixed((total[m:] - total[:-m]) * back[:n - m + 1] ^ np.uint64(m)) for m in lengths if m <= n]
    return np.concatenate([*out, np.zeros(0, np.uint64)])


def templates(text: str):
    """(tokens, is a slot, window hashes, window is usable). A capitalised word
    is a name unless it begins a sentence; a unit is one only after a number."""
    raw = _cut(text)
    code = np.fromiter(map(_memo.__getitem__, raw), np.uint64, len(raw))
    kind = (code & np.uint64(7)).astype(np.int8)
    begins = np.ones(len(raw), bool)
    begins[1:] = kind[:-1] == END
    keep = np.flatnonzero(kind != END)
    kind, begins, value = kind[keep], begins[keep], (code & ~np.uint64(7))[keep]
    after_number = np.zeros(len(keep), bool)
    after_number[1:] = kind[:-1] == NUMBER
    name, number, unit = (kind == CAPITAL) & ~begins, kind == NUMBER, (kind == UNIT) & after_number
    for place, of in ((CAPITAL, name), (NUMBER, number), (UNIT, unit)):
        value[of] = _PLACE[place]
    slot = name | number | unit
    n = len(keep) - WINDOW + 1
    if n <= 0:
        return raw, keep, slot, np.zeros(0, np.uint64), np.zeros(0, bool)
    h = np.zeros(n, np.uint64)
    literals = np.zeros(n, np.int8)
    for j in range(WINDOW):
        h = h * _BASE + value[j:j + n]
        literals += ~slot[j:j + n]
    return raw, keep, slot, _mixed(h), literals >= LITERALS


def _whole_items(items: DataFrame, shortest: int) -> DataFrame:
    """(item_id, length, hash) of the items that have no usable window: their whole sequence of tokens."""
    def whole(batches):
        for b in batches:
            of, lengths, hashes = [], [], []
            for i, text in enumerate(b.column(1)):
                raw, keep, _, _, usable = templates(text.as_py())
                if len(keep) >= max(shortest, 1) and not usable.any():
                    of.append(i)
                    lengths.append(len(keep))
                    hashes.append(sequences(raw, keep, [len(keep)]))
            h = np.concatenate([*hashes, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.record_batch([b.column(0).take(pa.array(of, pa.int64())), pa.array(lengths, pa.int32()), pa.array(h)], names=["item_id", "length", "hash"])

    kind = items.schema["item_id"].dataType.simpleString()
    return small_batches(items).select("item_id", "text").mapInArrow(whole, f"item_id {kind}, length int, hash long")


def _whole_matches(texts: DataFrame, wholes: DataFrame) -> DataFrame:
    """(text_digest, item_id, n_windows, coverage) of the texts that hold an item's whole sequence of tokens."""
    lengths = sorted(r["length"] for r in wholes.select("length").distinct().collect())
    bitmap, shift = _bitmap(wholes), np.uint64(64 - BITMAP_BITS)

    def cut(batches):
        for b in batches:
            of, hashes = [], []
            for i, text in enumerate(b.column(1)):
                raw, keep, *_ = templates(text.as_py())
                h = sequences(raw, keep, lengths)
                h = np.unique(h[bitmap[h >> shift]])
                of.append(np.full(len(h), i))
                hashes.append(h)
            h = np.concatenate([*hashes, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.record_batch([b.column(0).take(pa.array(np.concatenate([*of, np.zeros(0, np.int64)]))), pa.array(h)], names=["text_digest", "hash"])

    held = small_batches(texts).select("text_digest", "text").mapInArrow(cut, "text_digest string, hash long")
    n = F.greatest(F.col("length") - WINDOW + 1, F.lit(1)).cast("long")
    return held.join(wholes, "hash").select("text_digest", "item_id", n.alias("n_windows"), F.lit(1.0).alias("coverage"))


def _windows(rows: DataFrame, key: str, bitmap: np.ndarray | None) -> DataFrame:
    """(key, position, hash, slots) of the usable windows of ``text``; slots:
    the lower-cased tokens under the placeholders. With a bitmap, only windows it lets through."""
    shift = np.uint64(64 - BITMAP_BITS)

    def cut(batches):
        for b in batches:
            of, at, hashes, slots = [], [], [], []
            for i, text in enumerate(b.column(1)):
                raw, keep, slot, h, usable = templates(text.as_py())
                if bitmap is not None and len(h):
                    usable &= bitmap[h >> shift]
                hits = np.flatnonzero(usable)
                of += [i] * len(hits)
                at += hits.tolist()
                hashes.append(h[hits])
                slots += [[raw[keep[k]].lower() for k in range(w, w + WINDOW) if slot[k]] for w in hits.tolist()]
            h = np.concatenate([*hashes, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.record_batch([b.column(0).take(pa.array(of, pa.int64())), pa.array(at, pa.int32()), pa.array(h), pa.array(slots, pa.list_(pa.string()))],
                                  names=[key, "position", "hash", "slots"])

    kind = rows.schema[key].dataType.simpleString()
    return small_batches(rows).select(key, "text").mapInArrow(cut, f"{key} {kind}, position int, hash long, slots array<string>")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """The benchmark's hashes by their first ``BITMAP_BITS`` bits: at most that many marks."""
    marks = windows.select(F.shiftrightunsigned("hash", 64 - BITMAP_BITS).cast("int").alias("mark")).distinct().toPandas()["mark"]
    out = np.zeros(1 << BITMAP_BITS, bool)
    out[marks.to_numpy(np.int64)] = True
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, shortest: int = 1) -> DataFrame:
    """(text_digest, item_id, n_windows, coverage) of every document text that
    holds at least ``coverage`` of an item's windows with consistent slot values.

    Texts are named by their SHA-256; copies are searched once per row but counted once.
    Of several values that a document has for one value of an item, the most frequent
    counts (ties: the last by text), and only windows that agree with it or hold the item's
    own values. The values are chosen, and the windows counted, in the whole document,
    at each distance between document and item position, and within each range of
    distances as wide as the item (two rows of ranges, half a width apart, so words
    put into a copy do not part it); the best of these counts. An item without a usable
    window, of at least ``shortest`` tokens, must stand in the document as a whole."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", whole_text().alias("text"))
    known = materialize(_windows(items, "item_id", None).select("item_id", F.col("position").alias("at"), "hash", F.col("slots").alias("asked")).distinct(), "item-windows")
    bitmap = _bitmap(known)
    # what an item has: its distinct windows, and the tokens from the first to the last of them
    sizes = known.groupBy("item_id").agg(F.countDistinct("hash").alias("size"), (F.max("at") - F.min("at") + WINDOW).alias("extent"))
    once = known.groupBy("item_id", "hash", "asked").agg(F.min("at").alias("first"))
    places = known.join(once, ["item_id", "hash", "asked"]).withColumn("first", F.col("first") == F.col("at"))
    texts = docs.select(whole_text().alias("text")).select(F.sha2("text", 256).alias("text_digest"), "text")
    found = materialize(_windows(texts, "text_digest", bitmap).dropDuplicates(["text_digest", "position", "hash"]), "document-windows")
    pair = ["text_digest", "item_id"]
    # candidates: texts that hold one of the n - m + 1 windows of the item that are rarest in the documents
    counts = materialize(found.groupBy("hash").agg(F.count("*").alias("seen")), "window-counts")  # at most one row per window of the benchmark
    ranked = (known.select("item_id", "hash").distinct().join(counts, "hash", "left").join(sizes, "item_id")
              .withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(F.coalesce("seen", F.lit(0)), "hash"))))
    rare = ranked.where((F.col("rank") <= F.col("size") - F.ceil(F.col("size") * coverage - 1e-9) + 1) & F.col("seen").isNotNull()).select("item_id", "hash")
    candidates = materialize(found.select("text_digest", "hash").distinct().join(rare, "hash").select(*pair).distinct(), "candidates")
    met = (candidates.join(places.hint("merge"), "item_id").hint("merge")
           .join(found.hint("merge"), ["text_digest", "hash"]))
    met = materialize(met.select("text_digest", "item_id", "hash", "position", "at", "first", "asked", "slots"), "met-windows")
    # only texts that hold enough of an item's windows, whatever their values, can leak it
    enough = (met.groupBy(*pair).agg(F.countDistinct("hash").alias("n")).join(sizes, "item_id")
              .where(F.col("n") / F.col("size") >= coverage).select(*pair, "extent"))
    apart = F.col("position") - F.col("at")
    alone = [F.struct(F.lit(k).alias("kind"), F.floor(c).cast("int").alias("where")) for k, c in (
        (1, apart), (2, apart / F.col("extent")), (3, apart / F.col("extent") + 0.5))]
    everywhere = F.struct(F.lit(0).alias("kind"), F.lit(0).alias("where"))
    side = (met.join(enough.hint("merge"), pair).select("*", F.explode(F.when(F.col("first"), F.array(everywhere, *alone)).otherwise(F.array(*alone))).alias("side"))
            .select(*pair, "side", "hash", "asked", "slots"))
    key = [*pair, "side"]
    # value of the item -> most frequent value of the document
    pairs = side.select(*key, F.explode(F.arrays_zip(F.col("asked").alias("a"), F.col("slots").alias("b"))).alias("z"))
    votes = pairs.groupBy(*key, F.col("z.a").alias("a"), F.col("z.b").alias("b")).agg(F.count("*").alias("n"))
    chosen = (votes.groupBy(*key, "a").agg(F.max_by("b", F.struct("n", "b")).alias("b"))
              .groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("a", "b"))).alias("map")))  # an item's values
    agree = F.forall(F.arrays_zip(F.col("asked").alias("a"), F.col("slots").alias("b")), lambda z: F.element_at("map", z["a"]) == z["b"])
    good = (side.join(chosen.hint("merge"), key, "left").where(F.col("map").isNull() | (F.col("asked") == F.col("slots")) | agree)
            .groupBy(*key).agg(F.countDistinct("hash").alias("n_windows"))
            .groupBy(*pair).agg(F.max("n_windows").alias("n_windows")))
    held = (good.join(sizes, "item_id").withColumn("coverage", F.col("n_windows") / F.col("size"))
            .where(F.col("coverage") >= coverage).select("text_digest", "item_id", "n_windows", "coverage"))
    wholes = materialize(_whole_items(items, shortest).distinct(), "whole-items")
    if wholes.isEmpty():
        return held
    # an item_id may have several rows: one result for each text and item
    best = held.unionByName(_whole_matches(texts, wholes)).groupBy(*pair).agg(F.max(F.struct("coverage", "n_windows")).alias("best"))
    return best.select(*pair, "best.n_windows", "best.coverage")


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, shortest: int = 1) -> DataFrame:
    """doc_id, item_id, n_windows, coverage: one row per leaking document row and
    item. Clean documents give no row. Null and empty texts have no windows."""
    named = docs.select("doc_id", F.sha2(whole_text(), 256).alias("text_digest"))
    return named.join(leaks(docs, benchmark, coverage, shortest), "text_digest").select("doc_id", "item_id", "n_windows", "coverage")


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, shortest: int = 1) -> DataFrame:
    """The documents that leak no item, with their columns."""
    found = materialize(leaks(docs, benchmark, coverage, shortest).select(F.col("text_digest").alias("__digest")).distinct(), "leaking-texts")
    marked = docs.withColumn("__digest", F.sha2(whole_text(), 256))
    return marked.join(found, "__digest", "left_anti").select(docs.columns)
