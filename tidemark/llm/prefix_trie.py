"""Conversation prefix trie, rolled up in depth bands.

Every distinct sequence of first d turns of the rebuilt conversations is a node.
A node is known by a 128-bit digest of its sequence, so the whole job moves narrow rows
(ids, digests, lengths) and never texts after the first scan.

* Turns are numbered within their conversation by one range exchange over (conversation,
  turn, digest, row): a conversation as large as any is spread over many partitions, whose
  offsets are one small table.
* Sequences are digested in chunks of ``BAND`` turns; the chunk digests of a conversation are
  themselves a sequence, digested the same way, until one chunk holds all. No group has
  more than ``BAND`` rows, and the number of rounds is the logarithm of the depth.
* The chunks are the depth bands. Values of nodes are exploded to ancestors inside the band
  only (at most ``BAND``) and to the band's root. Totals of the band roots, which form a tree
  ``BAND`` times less deep, are completed by the same function; then each
  completed band-root total is added to the root's ancestors in the band above.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text
from tidemark.session import delete_path, scratch_path

BAND = 8  # turns of a depth band
HEADS = 5  # at most so many turns are taken from another conversation
MEMBERS = 4096  # ids of a block of members
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
ROOT_ID = hashlib.sha256(b"root").digest()[:16]


class _Tables:
    """Intermediate tables under the shared folder, deleted once the result is stored."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"trie-{name}")
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def drop(self) -> None:
        for path in self.paths:
            delete_path(self.spark, path)


def _digest(*parts: Column) -> Column:
    """The first 16 bytes of the SHA-256 of binary parts of fixed lengths."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def narrow_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, n, row): digest is of role and text, n the code points
    of the text. Null role and text are empty; rows without conv_id belong to no conversation."""
    role, text = whole_text("role").cast("binary"), whole_text("text")
    turn = F.concat(F.sha2(role, 256), F.sha2(text.cast("binary"), 256)).cast("binary")
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _digest(turn).alias("digest"),
        F.char_length(text).cast("long").alias("n"), F.monotonically_increasing_id().alias("row"))


def _numbered(batches):
    """Rows of one sorted partition with their number within the conversation so far."""
    last, count, part = None, 0, None
    for b in batches:
        if not b.num_rows:
            continue
        conv = b.column("conv_id").to_numpy(zero_copy_only=False)
        part = b.column("part")
        starts = np.flatnonzero(np.r_[conv[0] != last if last is not None else True, conv[1:] != conv[:-1]])
        at = np.arange(len(conv))
        first = np.zeros(len(conv), np.int64)
        first[starts] = starts
        first = np.maximum.accumulate(first)
        here = at - first + 1
        if not len(starts) or starts[0] > 0:  # the batch begins inside the last conversation
            here[:starts[0] if len(starts) else len(conv)] += count
        last, count = conv[-1], int(here[-1])
        yield pa.record_batch([b.column("conv_id"), part, pa.array(here), b.column("digest"), b.column("n")],
                              names=["conv_id", "part", "number", "digest", "n"])


def rebuilt_turns(conversations: DataFrame, keep) -> DataFrame:
    """(conv_id, pos, digest, n, size): the turns of every rebuilt conversation, numbered
    from 1; size is the number of its turns. A conversation left without turns has one row of pos 0."""
    key = ["conv_id", "turn", "digest", "row"]  # nulls sort first
    rows = keep(narrow_turns(conversations), "turns")
    ranged = rows.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("part", F.spark_partition_id().cast("long"))
    own = keep(ranged.select("conv_id", "part", "digest", "n")
               .mapInArrow(_numbered, "conv_id long, part long, number long, digest binary, n long"), "numbered")
    # one row per (conversation, partition): offsets, and what the conversation takes from its first one
    spans = own.groupBy("conv_id", "part").agg(F.max("number").alias("rows"))
    by_part = Window.partitionBy("conv_id").orderBy("part")
    spans = keep(spans.select("conv_id", "part", (F.sum("rows").over(by_part) - F.col("rows")).alias("offset"),
                              F.sum("rows").over(Window.partitionBy("conv_id")).alias("own")), "spans")
    base = F.col("conv_id") - F.col("conv_id") % 100
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    placed = own.join(spans, ["conv_id", "part"]).withColumn("number", F.col("number") + F.col("offset"))
    heads = keep(placed.where((F.col("conv_id") % 100 == 0) & (F.col("number") <= HEADS)).groupBy(F.col("conv_id").alias("base"))
                 .agg(F.sort_array(F.collect_list(F.struct("number", "digest", "n"))).alias("head")), "heads")
    wide = spans.select("conv_id", "part", "offset", "own", base.alias("base"), taken.alias("taken")).join(heads, "base", "left")
    wide = wide.withColumn("head", F.when(F.col("head").isNull(), F.array().cast(heads.schema["head"].dataType))
                           .otherwise(F.slice("head", F.lit(1), F.col("taken").cast("int"))))
    wide = keep(wide.select("conv_id", "part", "offset", "taken", "head", F.size("head").cast("long").alias("got"),
                            (F.size("head") + F.greatest(F.col("own") - F.col("taken"), F.lit(0))).cast("long").alias("size")), "sizes")
    later = (own.join(wide.drop("head"), ["conv_id", "part"]).withColumn("number", F.col("number") + F.col("offset"))
             .where("number > taken").select("conv_id", (F.col("number") - F.col("taken") + F.col("got")).alias("pos"), "digest", "n", "size"))
    first = wide.where((F.col("offset") == 0) & (F.col("got") > 0)).select("conv_id", "size", F.explode("head").alias("h")).select(
        "conv_id", F.col("h.number").alias("pos"), "h.digest", "h.n", "size")
    none = wide.where((F.col("offset") == 0) & (F.col("size") == 0)).select(
        "conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n"), "size")
    return keep(first.unionByName(later).unionByName(none), "rebuilt")


def _levels(items: DataFrame, deepest: int, band: int, keep, level: int = 0) -> list[DataFrame]:
    """Tables of prefixes, one per level. ``items``: (conv_id, pos, digest) with whatever
    else is to be kept in ``rest``. A table has (conv_id, pos, path, rest): path holds the node ids from the
    band's root over the nodes of the band down to the node itself. Items of level
    l + 1 are the full chunks of level l, so its nodes are the band roots of level l."""
    chunk = F.floor((F.col("pos") - 1) / band).cast("long")
    chunks = (items.groupBy("conv_id", chunk.alias("chunk"))
              .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "rest"))).alias("turns")))
    # digests of the chunk's beginnings; each of them of 16 bytes, as are the items
    chain = F.aggregate("turns", F.expr("cast(array() as array<binary>)"),
                        lambda done, t: F.concat(done, F.array(_digest(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(b"")), t["digest"]))))
    chunks = chunks.withColumn("chain", F.when(F.size("turns") > 0, chain))
    if deepest <= band:
        above, based = [], chunks.withColumn("base", F.lit(ROOT_ID)).withColumn("end", F.lit(None).cast("binary"))
    else:
        chunks = keep(chunks, f"chunks{level}")
        full = chunks.where(F.size("turns") == band).select("conv_id", (F.col("chunk") + 1).alias("pos"), F.element_at("chain", -1).alias("digest"),
                                                            F.lit(None).cast("struct<n:bigint,last:boolean>").alias("rest"))
        above = _levels(full, deepest // band, band, keep, level + 1)
        ends = above[0].select("conv_id", F.col("pos").alias("chunk"), F.element_at("path", -1).alias("id"))
        based = (chunks.join(ends.withColumnRenamed("id", "base"), ["conv_id", "chunk"], "left")
                 .join(ends.select("conv_id", (F.col("chunk") - 1).alias("chunk"), F.col("id").alias("end")), ["conv_id", "chunk"], "left")
                 .withColumn("base", F.coalesce("base", F.lit(ROOT_ID))))
    # a node is (band root, beginning of the chunk), but for the last one of a full chunk, which is a band root itself
    ids = F.transform("chain", lambda c, i: F.when((i == band - 1) & F.col("end").isNotNull(), F.col("end")).otherwise(_digest(F.col("base"), c)))
    based = based.select("conv_id", "turns", F.concat(F.array("base"), ids).alias("path"))
    each = based.select("conv_id", "path", F.posexplode("turns").alias("at", "t")).select(
        "conv_id", F.col("t.pos").alias("pos"), F.slice("path", F.lit(1), F.col("at") + 2).alias("path"), F.col("t.rest").alias("rest"))
    return [keep(each, f"level{level}"), *above]


def _spread(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Values of nodes summed per ancestor inside the band (the node included: ``value``) and
    per band root (``value_root``)."""
    each = nodes.select(F.posexplode("path").alias("at", "id"), *values).where("id IS NOT NULL")
    zero = F.lit(0).cast("long")
    return each.groupBy("id").agg(
        *[F.sum(F.when(F.col("at") > 0, F.col(v)).otherwise(zero)).alias(v) for v in values],
        *[F.sum(F.when(F.col("at") == 0, F.col(v)).otherwise(zero)).alias(f"{v}_root") for v in values],
        F.max(F.col("at") == 0).alias("is_root"))


def _totals(nodes: DataFrame, levels: list[DataFrame], values: list[str], keep, level: int = 0) -> DataFrame:
    """(id, values): sums over the whole subtree of each node of a level. ``nodes``: (path, values)."""
    local = keep(_spread(nodes, values), f"local{level}")
    roots = local.where("is_root").select("id", *[F.col(f"{v}_root").alias(v) for v in values])
    below = roots  # at the top, only the root of the trie is a band root
    if levels:
        paths = levels[0].select(F.element_at("path", -1).alias("id"), "path").distinct()
        paths = paths.unionByName(nodes.sparkSession.range(1).select(F.lit(ROOT_ID).alias("id"), F.array(F.lit(None).cast("binary"), F.lit(ROOT_ID)).alias("path")))
        below = _totals(paths.join(roots, "id"), levels[1:], values, keep, level + 1)
    ends = nodes.select(F.element_at("path", -1).alias("id"), "path")
    up = ends.join(below, "id").select(F.explode(F.slice("path", 2, 2 ** 30)).alias("id"), *values)
    inside = local.select("id", *values)
    return inside.unionByName(up).groupBy("id").agg(*[F.sum(v).alias(v) for v in values])


def _member_blocks(batches):
    """Runs of sorted (id, conv_id) as blocks of at most ``MEMBERS`` decimal ids."""
    for b in batches:
        ids, convs = b.column("id").to_pylist(), b.column("conv_id").to_pylist()
        out, a = [], 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or ids[i] != ids[a] or i - a == MEMBERS:
                out.append((ids[a], convs[a], ",".join(map(str, convs[a:i]))))
                a = i
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else ((), (), ()), (pa.binary(), pa.int64(), pa.string()))],
                              names=["id", "first", "ids"])


def _member_digests(batches):
    """One SHA-256 per id over its blocks, which arrive in order."""
    at, sha = None, None
    for b in batches:
        done = []
        for i, block in zip(b.column("id").to_pylist(), b.column("ids").to_pylist()):
            if i != at:
                if sha is not None:
                    done.append((at, sha.hexdigest()))
                at, sha = i, hashlib.sha256(block.encode())
            else:
                sha.update(b"," + block.encode())
        yield pa.record_batch([pa.array([x[k] for x in done], t) for k, t in ((0, pa.binary()), (1, pa.string()))], names=["id", "ends_sha256"])
    if sha is not None:
        yield pa.record_batch([pa.array([at], pa.binary()), pa.array([sha.hexdigest()])], names=["id", "ends_sha256"])


def _ends(ending: DataFrame, keep) -> DataFrame:
    """(id, ends_sha256) of the members (id, conv_id) that end at a node. The ids of a node may be
    a third of all, so a range exchange over both columns makes blocks of them first; a digest is one
    sequential pass, which reads the blocks of a node in order and holds one of them."""
    blocks = keep(ending.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
                  .mapInArrow(_member_blocks, "id binary, first long, ids string"), "members")
    return blocks.repartition("id").sortWithinPartitions("id", "first").mapInArrow(_member_digests, "id binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c is rebuilt from the first h turns of conversation c - c % 100 (h the unsigned
    crc32 of the decimal id, modulo 6; % as in SQL, so -5 belongs to 0) and its own turns after
    its first h. Turns are ordered by turn, null first; rows with one turn number by a digest of role and
    text, repeated rows stay. Null role or text is empty. Rows without conv_id belong to no conversation.
    Without conversations there are no nodes. Other columns are not read. The result is stored under the
    shared folder; all tables before it are deleted."""
    tables = _Tables(conversations.sparkSession)
    try:
        return _trie(conversations, band, tables.store)
    finally:
        tables.drop()


def _trie(conversations: DataFrame, band: int, keep) -> DataFrame:
    spark = conversations.sparkSession
    turns = rebuilt_turns(conversations, keep)
    deepest = int(turns.agg(F.max("pos")).first()[0] or 0)
    items = turns.where("pos > 0").select("conv_id", "pos", "digest", F.struct("n", (F.col("pos") == F.col("size")).alias("last")).alias("rest"))
    first, *above = _levels(items, deepest, band, keep)
    members = first.groupBy("pos", "path", F.col("rest.n").alias("n")).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("rest.last").cast("long")).alias("n_ends"))
    everyone = turns.where((F.col("pos") == F.least(F.col("size"), F.lit(1)))).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum((F.col("size") == 0).cast("long")).alias("n_ends")).where("n_convs > 0")
    root = everyone.select(F.lit(0).cast("long").alias("pos"), F.array(F.lit(None).cast("binary"), F.lit(ROOT_ID)).alias("path"), F.lit(0).cast("long").alias("n"),
                           "conv_id", "n_convs", "n_ends")
    leaf = F.col("n_convs") == F.col("n_ends")  # every other member goes on to a child
    nodes = keep(members.unionByName(root).select(
        F.col("pos").alias("depth"), "path", "conv_id", "n_convs", F.element_at("path", -1).alias("id"), F.element_at("path", -2).alias("parent"),
        leaf.cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n")).alias("saved_tokens"), (F.col("n_ends") > 0).alias("ended")), "nodes")
    totals = _totals(nodes.select("path", "n_leaves", "saved_tokens"), above, ["n_leaves", "saved_tokens"], keep)
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    ending = first.where("rest.last").select(F.element_at("path", -1).alias("id"), "conv_id").unionByName(
        turns.where("pos = 0").select(F.lit(ROOT_ID).alias("id"), "conv_id"))
    own = (nodes.select("id", "depth", "conv_id", "parent", "n_convs").join(totals, "id").join(children, "id", "left")
           .join(_ends(ending, keep), "id", "left"))
    own = keep(own.select("id", "conv_id", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
                          "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")), "own")
    # many nodes may share a parent; both sides are stored tables, so the planner can split a hot one
    parents = own.where("n_children > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    path = scratch_path(spark, "trie-result")
    own.join(parents, "parent", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                               "ends_sha256").write.parquet(path)
    return spark.read.parquet(path)
