"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into so few segments that, of two fingerprints within
the distance, one segment differs by at most one bit (4 bits: 3 segments). Each
segment is indexed under its one-wildcard variants, one per bit, with that bit
deleted. Fingerprints that share a variant are compared exactly.

Only distinct fingerprints are indexed. A group of one variant gives the edges
of a spanning forest, not its pairs. A group larger than ``BLOCK`` is dealt out as
pairs of blocks, so that no task holds an unbounded group and none is cut off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import small_batches, whole_text
from tidemark.llm.components import connected_components
from tidemark.session import materialize

BITS = 64
BLOCK = 4096
_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, words: int = 4) -> int:
    """Bit i is 1 if it is set in over half the shingles' XXH64 (seed 42).
    Words end at ASCII white space; a text of fewer words is one shingle; none: 0."""
    flat = _flat(text)
    if not flat:
        return 0
    ends = np.append(np.flatnonzero(np.frombuffer(flat, np.uint8) == 32), len(flat))
    starts = np.append(0, ends[:-1] + 1)
    if len(starts) > words:
        starts, ends = starts[:1 - words], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(flat[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):  # bounded memory for very long texts
        ones += np.unpackbits(hashes[at:at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _flat(text: str) -> bytes:
    """Lower-cased (A-Z) words joined by one space. ``bytes.split`` cuts at
    exactly space and \\x09-\\x0D."""
    return b" ".join(text.encode().translate(_FOLD).split())


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fp", T.LongType())])

    def scan(batches):
        for b in batches:
            got = np.array([fingerprint(t.as_py(), words) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.record_batch([b.column(0), pa.array(got)], names=["doc_id", "fp"])

    return small_batches(docs).select("doc_id", whole_text().alias("text")).mapInArrow(scan, schema)


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the fewest segments of which one has at most one
    of ``distance`` differing bits."""
    n = distance // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _variants(distance: int):
    """(mask of the segment without one bit, that bit, whether it is the segment's first)."""
    out = []
    for first, size in segments(distance):
        whole = ((1 << size) - 1) << first
        out += [(whole & ~(1 << bit), bit, bit == first) for bit in range(first, first + size)]
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(fp: np.ndarray, other: np.ndarray | None, bit: int, first: bool, distance: int):
    """Forest edges among ``fp``, or between it and ``other``, of pairs that
    this variant has to compare: those that differ in the deleted bit, and, in the
    segment's first variant, those that do not."""
    left = fp
    right = fp if other is None else other
    parent: dict[int, int] = {}

    def find(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    bits = lambda x: (x >> np.uint64(bit)) & np.uint64(1)
    lb, rb = bits(left), bits(right)
    kinds = [(left[lb == 0], right[rb == 1], False)]
    if other is not None:
        kinds.append((left[lb == 1], right[rb == 0], False))
    if first:
        kinds += [(left[lb == v], right[rb == v], other is None) for v in (0, 1)]
    for a, b, same in kinds:
        step = max(1, 2_000_000 // max(1, len(b)))
        for at in range(0, len(a), step):
            part = a[at:at + step]
            i, j = np.nonzero(np.bitwise_count(part[:, None] ^ b[None, :]) <= distance)
            if same:
                keep = part[i] < b[j]
                i, j = i[keep], j[keep]
            for x, y in zip(part[i].tolist(), b[j].tolist()):
                rx, ry = find(x), find(y)
                if rx != ry:
                    parent[ry] = rx
                    out.append((x, y))
    return out


def links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp), enough to
    connect all that link within ``distance`` bits; a pair may come twice."""
    spark = fps.sparkSession
    table = _variants(distance)
    keys = F.array(*[F.struct(F.lit(k).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))
                     for k, (mask, _, _) in enumerate(table)])
    rows = fps.select("fp", F.inline(keys))
    # groups larger than a block, a small table that is stored so that its size is known
    large = materialize(rows.groupBy("v", "key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
                        .select("v", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "large-groups")
    dealt_in = rows.join(large, ["v", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # a block meets itself and each other block once: (low, high) with the row's side
    met = (dealt_in.withColumn("mine", mine).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("v", "key", "fp", F.least("mine", "with").alias("low"), F.greatest("mine", "with").alias("high"),
                   (F.col("mine") > F.col("with")).alias("side")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.repartition(parts, "v", "key", "low", "high").sortWithinPartitions("v", "key", "low", "high")

    def compare(batches):
        rest = None
        for b in batches:
            cols = [np.asarray(b.column(i)) for i in range(6)]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            v, key, _, low, high, _ = cols
            new = (v[1:] != v[:-1]) | (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            cuts = np.flatnonzero(new) + 1
            last = cuts[-1] if len(cuts) else 0
            rest = [x[last:] for x in cols]
            yield _edges([x[:last] for x in cols], np.append(0, cuts))
        if rest is not None and len(rest[0]):
            yield _edges(rest, np.array([0, len(rest[0])]))

    def _edges(cols, cuts):
        v, _, fp, low, high, side = cols
        fp, out = fp.view(np.uint64), []
        size = np.diff(cuts)
        two = cuts[:-1][size == 2]  # most groups: compared all at once
        if len(two):
            x, y = fp[two], fp[two + 1]
            near = (low[two] == high[two]) & (np.bitwise_count(x ^ y) <= distance)
            out += zip(x[near].tolist(), y[near].tolist())
        for at, n in zip(cuts[:-1][size > 2].tolist(), size[size > 2].tolist()):
            _, bit, first = table[v[at]]
            part, sides = fp[at:at + n], side[at:at + n]
            if low[at] == high[at]:
                out += _links(part, None, bit, first, distance)
            else:
                out += _links(part[~sides], part[sides], bit, first, distance)
        both = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.record_batch([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    Fingerprints within ``distance`` bits link; component_id is the smallest
    doc_id that a document reaches, its own included (null only if all those are
    null). Texts without words have fingerprint zero and link like any other.
    Repeated rows share fingerprint and component; other columns are not read."""
    stored = materialize(fingerprints(docs, words), "fingerprints")
    fps = materialize(stored.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints-distinct")
    roots = connected_components(materialize(links(fps.select("fp"), distance), "links"))
    named = fps.join(roots, fps.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.select("fp", "root").join(least, "root").select("fp", "component_id")
    return stored.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """The documents with one row kept of each component: that of its smallest doc_id, of rows
    with one id the first by a hash of the whole row; of rows equal in all columns one. Rows with a null
    doc_id cannot be told apart by it, so they stay.

    Rows are named by (doc_id, hash of the row) in place of the id, so rows that share an
    id but not a component are decided apart."""
    row = F.xxhash64(*docs.columns)
    named = docs.where("doc_id is not null").select(F.struct(F.col("doc_id").alias("id"), row.alias("row")).alias("doc_id"), "text")
    found = near_duplicates(named, words, distance)
    # one entry per kept row, with the number of rows equal to it
    kept = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("__same"))
    kept = materialize(kept.select(F.col("doc_id.id").alias("__id"), F.col("doc_id.row").alias("__row"), "__same"), "kept-documents")
    chosen = docs.withColumn("__row_", row).join(kept, (F.col("doc_id") == F.col("__id")) & (F.col("__row_") == F.col("__row")))
    several = chosen.where("__same > 1").dropDuplicates(["__id", "__row"])
    return (docs.where("doc_id is null").unionByName(chosen.where("__same = 1").select(docs.columns))
            .unionByName(several.select(docs.columns)))
