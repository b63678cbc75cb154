"""Removal of byte strings that repeat, by column-wise suffix sorting of many documents.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere
else in the corpus. The order of all suffixes would say which strings do, but one
order over the whole corpus is one task's work. So the work is cut by content:

1. Every string of ``LENGTH`` bytes has an anchor, its leftmost least gram of ``GRAM``
   bytes (by a hash). Equal strings have equal anchors at equal places. A run of
   strings with one anchor is a segment; an anchor whose gram occurs once in the corpus
   cannot belong to a string that repeats, so its segment is left out.
2. Segments of one gram, aligned at their anchors, are a collection of short
   documents. It is sorted column by column from the right (the construction of a
   multi-document Burrows-Wheeler transform that inserts one symbol per document and
   round): each round reads the next column from a file, puts the documents in the order
   of (new symbol, order so far), which is the transform's LF step, and updates the
   common prefixes of neighbours: 0 if the new symbols differ, else one more than the
   least of the common prefixes between their places in the round before. The symbols in that order
   are the round's slice of the transform, written to a second file with its prefixes.
   Because equal strings stand in one column, suffixes of different columns
   need never be compared.
3. Where a common prefix reaches ``LENGTH``, or a segment stands for several equal ones,
   the string that begins in this column repeats.

Equal texts are one text with a count, and equal segments of one gram one segment with
a count, before anything is gathered. A group of more than ``GROUP`` distinct segments
is cut by columns: strings that begin in a range of columns share the bytes that
all of the range cover, so the range and a hash of those bytes make a smaller group, a part. A hot
passage in ever different surroundings gives such a part many pieces all the same: equal pieces are counted,
combined before the shuffle, and one of each is sorted. A part that still has more than ``GROUP`` different
pieces, at the edges of such a passage, is cut on to single columns, where strings are counted by a 128-bit hash.
No task gathers more than whole parts of up to ``GROUP`` pieces.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, whole_text
from tidemark.session import delete_path, materialize, scratch_path

LENGTH = 200
GRAM = 64
GROUP = 20_000  # distinct segments of one gram that are sorted together
RANGE = 8  # columns of a part of a larger group
BATCH = 20_000  # segments that a task sorts at once, at least; whole parts only
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
END = 256  # a document's end; two ends never match


def _gram_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every gram of ``size`` bytes (a power of two), by doubling."""
    h = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    base, step = _ODD, 1
    while step < size:
        h = h[:-step] * base + h[step:]
        base, step = base * base, step * 2
    h ^= h >> np.uint64(31)
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def anchors(text: bytes, length: int = LENGTH, size: int = GRAM):
    """(gram hash, anchor place, first start, last start) of each run of strings
    with one anchor, in order; together they cover every start once."""
    n = len(text) - length + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty, empty
    with np.errstate(over="ignore"):
        h = _gram_hashes(np.frombuffer(text, np.uint8), size)
    width = length - size + 1  # grams in a string
    # leftmost least gram of every string: compare the halves, ties to the left
    at, span = np.arange(len(h)), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(h[right] < h[left], right, left)
        span += step
    cut = np.flatnonzero(np.diff(at)) + 1
    first = np.append(0, cut)
    last = np.append(cut - 1, n - 1)
    return h[at[first]], at[first], first, last


def _range_min(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of values[a..b] for a <= b, by a table of powers of two."""
    levels, step = [values], 1
    longest = int((b - a + 1).max(initial=1))
    while 2 * step <= longest:
        v = levels[-1]
        levels.append(np.minimum(v[:len(v) - step], v[step:]) if len(v) > step else v)
        step *= 2
    k = np.log2(b - a + 1).astype(np.int64)
    out = np.empty(len(a), values.dtype)
    for level in np.unique(k):
        at = np.flatnonzero(k == level)
        v = levels[level]
        out[at] = np.minimum(v[a[at]], v[b[at] - (1 << int(level)) + 1])
    return out


def repeated_starts(rows: list[bytes], shift: np.ndarray, length: int = LENGTH):
    """For strings placed at columns ``shift`` (their anchors then stand in one
    column): (row, column) of every string of ``length`` bytes that two rows share in one column."""
    m = len(rows)
    sizes = np.array([len(r) for r in rows])
    base = int(shift.min())
    width = int((shift + sizes).max()) - base
    with tempfile.TemporaryFile() as columns, tempfile.TemporaryFile() as transform:
        # the documents, column by column, on disk; END where a document has no symbol
        table = np.memmap(columns, np.uint16, "w+", shape=(width, m))
        table[:] = END
        for j, (r, s) in enumerate(zip(rows, shift.tolist())):
            table[s - base:s - base + len(r), j] = np.frombuffer(r, np.uint8)
        order = np.arange(m)
        common = np.zeros(m, np.int32)  # with the one before in the order
        out_row, out_col = [], []
        for c in range(width - 1, -1, -1):
            symbol = np.asarray(table[c])[order]
            turn = np.argsort(symbol, kind="stable")
            new = symbol[turn]
            same = np.flatnonzero((new[1:] == new[:-1]) & (new[1:] != END)) + 1
            grown = np.zeros(m, np.int32)
            # equal symbols stay in their old order, so the old places increase
            grown[same] = np.minimum(_range_min(common, turn[same - 1] + 1, turn[same]) + 1, length)
            order, common = order[turn], grown
            transform.write(new.tobytes())
            transform.write(common.tobytes())
            hit = common >= length
            if hit.any():
                both = hit.copy()
                both[:-1] |= hit[1:]
                of = order[both]
                out_row.append(of)
                out_col.append(np.full(len(of), c + base))
        del table
    none = np.zeros(0, np.int64)
    return np.concatenate([*out_row, none]).astype(np.int64), np.concatenate([*out_col, none]).astype(np.int64)


def distinct_texts(docs: DataFrame, path: str) -> tuple[DataFrame, str]:
    """(digest, body, copies) of the distinct texts, stored at ``path`` in buckets by digest so
    that later joins do not move the texts again; the second result names the table."""
    spark = docs.sparkSession
    rows = small_batches(docs).select(F.encode(whole_text(), "utf-8").alias("body")).withColumn("digest", F.unhex(F.sha2("body", 256)))
    texts = rows.groupBy("digest").agg(F.first("body").alias("body"), F.count("*").alias("copies"))
    name = "repeats_" + uuid.uuid4().hex[:12]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts.write.bucketBy(buckets, "digest").sortBy("digest").option("compression", "zstd").option("path", path).saveAsTable(name)
    return spark.table(name), name


def _anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    def scan(batches):
        for b in batches:
            of, parts = [], []
            for i, body in enumerate(b.column(1)):
                got = anchors(body.as_py(), length, _gram(length))
                of.append(np.full(len(got[0]), i))
                parts.append(got)
            cols = [np.concatenate([*(p[j] for p in parts), np.zeros(0, kind)]) for j, kind in enumerate((np.uint64, *[np.int64] * 3))]
            yield pa.record_batch([b.column(0).take(pa.array(np.concatenate([*of, np.zeros(0, np.int64)]))), pa.array(cols[0].view(np.int64)),
                                   *[pa.array(c.astype(np.int32)) for c in cols[1:]]], names=["digest", "gram", "place", "first", "last"])

    return texts.select("digest", "body").mapInArrow(scan, "digest binary, gram long, place int, first int, last int")


def _gram(length: int) -> int:
    """The largest power of two up to a third of the length, at most ``GRAM``."""
    return min(GRAM, 1 << max(0, (length // 3).bit_length() - 1))


def _per_text(rows: DataFrame, fields: list[str]) -> DataFrame:
    """One row per text with its segments: at most as many as it has bytes."""
    return rows.groupBy("digest").agg(F.collect_list(F.struct(*fields)).alias("parts"))


def _segment_names(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(digest, gram, shift, name, place, first, last): each segment with a 128-bit name of its bytes."""
    def name(batches):
        for b in batches:
            out = []
            for digest, body, parts in zip(b.column(0), b.column(1), b.column(2)):
                d, text = digest.as_py(), body.as_py()
                for p in parts.as_py():
                    cut = text[p["first"]:p["last"] + length]
                    out.append((d, p["gram"], p["first"] - p["place"], hashlib.blake2b(cut, digest_size=16).digest(), p["place"], p["last"] - p["place"]))
            cols = list(zip(*out)) or [[]] * 6
            kinds = (pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["digest", "gram", "low", "name", "place", "high"])

    parts = _per_text(wanted, ["gram", "place", "first", "last"])
    return (texts.select("digest", "body").join(parts, "digest")
            .mapInArrow(name, "digest binary, gram long, low int, name binary, place int, high int"))


_PIECES = "part long, gram long, low int, name binary, shift int, bytes binary"
_RANGES = "gram long, low int, name binary, a int, b int"


def _cut_pieces(texts: DataFrame, members: DataFrame, length: int) -> DataFrame:
    """The segments of ``members`` cut into the pieces of their parts: a piece at column ``shift`` has
    the bytes of the strings that begin in its range of columns. ``members``: one place of each segment
    (digest, place) and ``step``, the columns of each part of a large group (0: one part)."""
    def cut(batches):
        for b in batches:
            out = []
            for body, parts in zip(b.column(1), b.column(2)):
                text = body.as_py()
                for p in parts.as_py():
                    step = p["step"] or p["high"] - p["low"] + 1
                    for c in range(p["low"] // step * step if p["step"] else p["low"], p["high"] + 1, step):
                        lo, hi = max(c, p["low"]), min(c + step - 1, p["high"])
                        part = p["gram"]
                        if p["step"]:  # these bytes stand in every string that begins in c..c+step-1
                            core = text[p["place"] + c + step - 1:p["place"] + c + length]
                            part = xxhash.xxh64_intdigest(core, c & 0xFFFFFFFF) ^ (part & (1 << 64) - 1)
                            part -= (part >> 63) << 64
                        out.append((part, p["gram"], p["low"], p["name"], lo, text[p["place"] + lo:p["place"] + hi + length]))
            cols = list(zip(*out)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["part", "gram", "low", "name", "shift", "bytes"])

    return (texts.select("digest", "body").join(_per_text(members, ["gram", "low", "high", "name", "place", "step"]), "digest")
            .mapInArrow(cut, _PIECES))


def _sorted_columns(pieces: DataFrame, length: int) -> DataFrame:
    """(gram, low, name, a, b): ranges of columns in which a piece's strings stand also in another
    piece of its part; (gram, low, name) name the pieces."""
    def sort(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= BATCH:  # whole parts only: the last one may go on
                rows = pa.Table.from_batches(held)
                keys = np.asarray(rows.column("part"))
                last = int(np.searchsorted(keys, keys[-1], "left"))
                if last:
                    yield from _one_collection(rows.slice(0, last), length)
                    held, size = rows.slice(last).to_batches(), rows.num_rows - last
        if size:
            yield from _one_collection(pa.Table.from_batches(held), length)

    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(sort, _RANGES)


def _large_groups(pieces: DataFrame, length: int, keep) -> DataFrame:
    """The same for the pieces of large groups, none of whose parts is gathered beyond ``GROUP`` different pieces."""
    key = ["part", "shift", "piece"]
    pieces = keep(pieces.withColumn("piece", F.unhex(F.substring(F.sha2("bytes", 256), 1, 32))), "pieces")
    different = keep(pieces.groupBy(*key).agg(F.count("*").alias("n"), F.first("bytes").alias("bytes")), "different-pieces")
    sizes = keep(different.groupBy("part").agg(F.count("*").alias("k")).where("k > 1"), "part-sizes")  # combined before the shuffle
    sized = different.join(sizes, "part")
    as_names = lambda df: df.select("part", F.col("part").alias("gram"), F.col("shift").alias("low"), F.col("piece").alias("name"), "shift", "bytes")
    back = lambda df: df.select(F.col("gram").alias("part"), F.col("low").alias("shift"), F.col("name").alias("piece"), "a", "b")
    sorted_ = back(_sorted_columns(as_names(sized.where(F.col("k") <= GROUP)), length))
    # several segments have the same piece: all its strings repeat
    equal = different.where("n > 1").select(*key, F.col("shift").alias("a"), (F.col("shift") + F.length("bytes") - length).cast("int").alias("b"))

    def strings(batches):
        for b in batches:
            of, column, hashes = [], [], []
            for i, (shift, body) in enumerate(zip(b.column("shift").to_pylist(), b.column("bytes").to_pylist())):
                for c in range(len(body) - length + 1):
                    of.append(i)
                    column.append(shift + c)
                    hashes.append(hashlib.blake2b(body[c:c + length], digest_size=16).digest())
            at = pa.array(of, pa.int64())
            yield pa.record_batch([*(b.column(c).take(at) for c in key), pa.array(column, pa.int32()), pa.array(hashes, pa.binary())],
                                  names=[*key, "column", "string"])

    single = keep(sized.where(F.col("k") > GROUP).select(*key, "bytes")
                  .mapInArrow(strings, "part long, shift int, piece binary, column int, string binary"), "single-columns")
    again = keep(single.groupBy("part", "column", "string").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeated-strings")
    alone = single.join(again, ["part", "column", "string"], "left_semi").select(*key, F.col("column").alias("a"), F.col("column").alias("b"))
    ranges = keep(sorted_.unionByName(equal).unionByName(alone), "piece-columns")
    return pieces.drop("bytes").join(ranges, key).select("gram", "low", "name", "a", "b")


def _one_collection(rows: pa.Table, length: int):
    """Sort whole parts as one collection: strings of different grams differ at
    the anchor's column, so parts cannot mix."""
    gram, low = np.asarray(rows.column("gram")), np.asarray(rows.column("low"))
    of, column = repeated_starts(rows.column("bytes").to_pylist(), np.asarray(rows.column("shift")).astype(np.int64), length)
    if not len(of):
        return
    at = np.lexsort((column, of))
    of, column = of[at], column[at]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (column[1:] != column[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(of)) - 1
    row = of[first]
    names = rows.column("name").take(pa.array(row)).combine_chunks()
    yield pa.record_batch([pa.array(gram[row]), pa.array(low[row]), names, pa.array(column[first].astype(np.int32)), pa.array(column[last].astype(np.int32))],
                          names=["gram", "low", "name", "a", "b"])


def repeated_strings(texts: DataFrame, length: int = LENGTH, keep=materialize) -> DataFrame:
    """(digest, a, b): ranges of starts of strings of ``length`` bytes that start
    anywhere else too, in the distinct ``texts`` (digest, body; a stored table). ``keep`` stores intermediate tables."""
    found = keep(_anchor_rows(texts, length), "anchors")
    # stored, so that both sides of the join are plain and Spark may split a gram that many rows have
    twice = keep(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "repeated-grams")
    wanted = found.join(twice, "gram")
    named = keep(_segment_names(texts, wanted, length), "segments")
    key = ["gram", "low", "name"]
    distinct = keep(named.groupBy(*key).agg(F.count("*").alias("n"), F.max("high").alias("high"), F.min(F.struct("digest", "place")).alias("one")),
                    "distinct-segments")
    groups = keep(distinct.groupBy("gram").agg(F.count("*").alias("k"), F.min("n").alias("least")).where("k > 1 and least = 1"), "gram-groups")
    step = F.when(F.col("k") > GROUP, F.lit(RANGE)).otherwise(F.lit(0)).alias("step")
    members = distinct.join(groups, "gram").select(*key, "high", "one.digest", "one.place", step)
    shared = _sorted_columns(_cut_pieces(texts, members.where("step = 0"), length), length)
    large = keep(members.where("step > 0"), "large-members")
    if not large.isEmpty():
        shared = shared.unionByName(_large_groups(_cut_pieces(texts, large, length), length, keep))
    # segments that stand for several are repeated as a whole
    whole = distinct.where("n > 1").select(*key, F.col("low").alias("a"), F.col("high").alias("b"))
    ranges = keep(shared.unionByName(whole), "repeated-columns")
    return named.join(ranges, key).select("digest", (F.col("place") + F.col("a")).alias("a"), (F.col("place") + F.col("b")).alias("b"))


def remove_repeats(texts: DataFrame, length: int, keep=materialize) -> DataFrame:
    """(text_digest, n_bytes, spans, kept) of every distinct text: spans is the
    array of maximal removed runs (start, end) in bytes, kept the remaining bytes."""
    starts = repeated_strings(texts, length, keep).groupBy("digest").agg(F.collect_list(F.struct("a", "b")).alias("starts"))  # bounded by the text's bytes

    def take_out(batches):
        for b in batches:
            n, spans, kept = [], [], []
            for body, copies, ranges in zip(b.column(1), b.column(2), b.column(3)):
                text = body.as_py()
                found = [(r["a"], r["b"] + length) for r in ranges.as_py() or []]
                if copies.as_py() > 1 and len(text) >= length:
                    found = [(0, len(text))]  # an equal text holds each of its strings
                runs = []
                for a, e in sorted(found):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(e, runs[-1][1])
                    else:
                        runs.append([a, e])
                edges = [0, *(x for r in runs for x in r), len(text)]
                n.append(len(text)), spans.append([{"start": a, "end": e} for a, e in runs])
                kept.append(b"".join(text[a:e] for a, e in zip(edges[::2], edges[1::2])))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                                  names=["text_digest", "n_bytes", "spans", "kept"])

    return (texts.join(starts, "digest", "left").select("digest", "body", "copies", "starts")
            .mapInArrow(take_out, "text_digest binary, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary"))


def repeats_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Null and empty texts have no bytes; repeated rows are copies of each other, so
    theirs are removed from ``length`` bytes on; a null doc_id stays; other columns are not read."""
    spark = docs.sparkSession
    paths = [scratch_path(spark, "repeats-texts")]

    def keep(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, name))
        return materialize(df, name, paths[-1])

    texts, name = distinct_texts(docs, paths[0])
    try:
        cut = remove_repeats(texts, length, keep)
        removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
        report = materialize(cut.select("text_digest", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                                        F.sha2("kept", 256).alias("kept_sha256")), "repeats-report")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in paths:
            delete_path(spark, path)
    rows = docs.select("doc_id", F.unhex(F.sha2(F.encode(whole_text(), "utf-8"), 256)).alias("text_digest"))
    return rows.join(report, "text_digest").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
