"""Packing of token sequences by minimum bin slack.

How a bin can be filled depends only on how many pieces of each length are left,
and there are at most ``capacity`` lengths. So the corpus is reduced to a
histogram of lengths (at most ``capacity`` rows on the driver, whatever the
corpus), bins are filled on that histogram, and the pieces are dealt to the bins
by their rank within their length.

A bin starts with the longest length left; a subset-sum dynamic programme over
the available lengths, on bitsets, finds the fullest feasible combination (of
equally full ones that with the longest lengths). The combination is then
removed. The same combination stays the answer as long as the counts allow it,
so it is removed as many times as they do, at once.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import tokenizer
from tidemark.llm.common import small_batches, whole_text
from tidemark.session import materialize

CAPACITY = 2048
END_ID = 0
SALTS = 64


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Ids of every whole text and an end id, cut into pieces of ``capacity``.

    doc_id, piece, start, length, ids (binary, little-endian uint32). A null or
    empty text gives one piece with the end id alone."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    end = struct.pack("<I", end_id)

    def cut(batches):
        ids_of = tokenizer.load(tokenizer_path).ids
        width = 4 * capacity
        for b in batches:
            of, piece, start, length, ids = [], [], [], [], []
            for i, text in enumerate(b.column(1)):
                whole = ids_of(text.as_py()) + end
                for k, at in enumerate(range(0, len(whole), width)):
                    part = whole[at:at + width]
                    of.append(i), piece.append(k), start.append(at // 4), length.append(len(part) // 4), ids.append(part)
            yield pa.record_batch([b.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                   pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=schema.names)

    return small_batches(docs).select("doc_id", whole_text().alias("text")).mapInArrow(cut, schema)


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, copies) whose sum is the largest possible up to ``room``."""
    reach, steps, limit = 1, [], (1 << (room + 1)) - 1
    for length in sorted(counts):
        most = min(counts[length], room // length) if length <= room else 0
        if most:
            steps.append((length, most, reach))
            power = 1
            while most:  # copies in groups of 1, 2, 4, ... and the rest
                group = min(power, most)
                reach |= (reach << (length * group)) & limit
                most -= group
                power *= 2
    left, chosen = reach.bit_length() - 1, []
    for length, most, below in reversed(steps):
        for copies in range(min(most, left // length), -1, -1):
            if below >> (left - copies * length) & 1:
                break
        if copies:
            chosen.append((length, copies))
            left -= copies * length
    return chosen


def minimum_bin_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, [(length, copies in each bin)]) until the histogram is used up."""
    counts = {k: v for k, v in histogram.items() if v}
    patterns = []
    while counts:
        first = max(counts)
        counts[first] -= 1
        rest = dict(fullest(counts, capacity - first)) if first < capacity else {}
        counts[first] += 1
        rest[first] = rest.get(first, 0) + 1
        bins = min(counts[k] // c for k, c in rest.items())
        for k, c in rest.items():
            counts[k] -= bins * c
            if not counts[k]:
                del counts[k]
        patterns.append((bins, sorted(rest.items(), reverse=True)))
    return patterns


def _slots(patterns) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank of each pattern's slots, copies in a bin, number
    of the pattern's first bin, offset of the first copy in the bin."""
    used, slots, sequence = {}, {}, 0
    for bins, parts in patterns:
        offset = 0
        for length, copies in parts:
            slots.setdefault(length, []).append((used.get(length, 0), copies, sequence, offset))
            used[length] = used.get(length, 0) + bins * copies
            offset += length * copies
        sequence += bins
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in slots.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, order_by: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (a ``length`` column of 1 to
    ``capacity``; all columns are kept). ``pieces`` is read twice, so it should be a stored table.

    Ranks are counted per (length, salt), so that no length, however common,
    meets in one task. Equal rows are interchangeable. An empty table gives an
    empty one."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _slots(minimum_bin_slack(histogram, capacity))
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64(*order_by), F.lit(SALTS)))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (salted.groupBy("length", "__salt").agg(F.count("*").alias("__n"))
              .select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    ranked = (salted.withColumn("__rank", F.row_number().over(Window.partitionBy("length", "__salt").orderBy(*order_by)))
              .join(starts, ["length", "__salt"])
              .withColumn("__rank", F.col("__start") + F.col("__rank") - 1)
              .select(*pieces.columns, "__rank"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def deal(batches):
        for b in batches:
            length, rank = np.asarray(b.column("length")), np.asarray(b.column("__rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for one in np.unique(length):
                at = np.flatnonzero(length == one)
                first, copies, base, inside = slots[int(one)]
                k = np.searchsorted(first, rank[at], "right") - 1
                turn = rank[at] - first[k]
                sequence[at] = base[k] + turn // copies[k]
                offset[at] = inside[k] + turn % copies[k] * one
            yield pa.record_batch([*b.columns[:-1], pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(deal, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Packed pieces of whole documents: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset. Each document is tokenised once, into a stored
    table of digests; ``token_pieces`` gives the ids themselves."""
    pieces = token_pieces(docs, tokenizer_path, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(materialize(pieces, "pieces"), capacity, ("doc_id", "piece", "ids_crc32"))
