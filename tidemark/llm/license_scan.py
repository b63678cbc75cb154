"""License scan: exact set-similarity join of text blocks with notice templates.

DataFrame expressions only. A block is a window of ``BLOCK`` words, or of twice a
template's words if that is more, and begins at every word. A block
matches a template if it holds at least ``CONTAINMENT`` of the template's distinct words.

Of these blocks, those that begin at a template word, with a prefix
word (below) inside, are enough: one that begins at another word holds no more
template words than the block that begins at its first template word.

The join: template words are ordered by their count in the whole corpus, rarest
first. A template of n words that needs o of them is indexed under its first
n - o + 1 words (the prefix): a match must hold one. A block's template words,
in the same order, meet the index by equi-join on the word; a pair stays if the
block has at least o template words (length) and if what follows the met word in
both is enough (position); then the sets are intersected. The corpus passes the
prefix words as one pattern first, so only texts that hold one are cut to blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# fixed: a word and what stands between words, in texts that are not lower-cased
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

BLOCK = 32
CONTAINMENT = 0.9
#: label -> notices
TEMPLATES = {
    "agpl": ["GNU Affero General Public License version 3"],
    "apache": ["Licensed under the Apache License, Version 2.0",
               "you may not use this file except in compliance with the License",
               "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted",
            "Neither the name of the copyright holder nor the names of its contributors"],
    "cc-by": ["Licensed under CC BY 4.0", "Licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["CC0 1.0 Universal Public Domain Dedication"],
    "gpl": ["you can redistribute it and/or modify it under the terms of the GNU General Public License"],
    "lgpl": ["GNU Lesser General Public License version 2.1"],
    "mit": ["Released under the MIT License", "Licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
            "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND"],
    "mpl": ["subject to the terms of the Mozilla Public License, v. 2.0"],
    "no-reuse": ["No part of this publication may be reproduced or distributed without prior written permission"],
}


def _pattern(words) -> str:
    """Whole words, letters in either case."""
    return rf"(?i)(?<!{WORD})(?:{'|'.join(words)})(?!{WORD})"


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def template_sets(templates: dict[str, list[str]]) -> list[tuple[str, frozenset[str]]]:
    import re

    cut = re.compile(WORD + "+")
    return [(label, frozenset(cut.findall(t.lower()))) for label, texts in sorted(templates.items()) for t in texts]


def word_order(docs: DataFrame, words: set[str]) -> list[str]:
    """The template words, rarest in the corpus first (ties: by word). The
    result has at most one row per template word."""
    seen = (docs.select(F.explode(_all(whole_text(), _pattern(sorted(words)))).alias("w")).select(_lower(F.col("w")).alias("w"))
            .groupBy("w").agg(F.count("*").alias("n")).collect())
    counts = {r["w"]: r["n"] for r in seen}
    return sorted(words, key=lambda w: (counts.get(w, 0), w))


def block_sizes(templates: dict[str, list[str]]) -> list[int]:
    """The words of a block for each of ``template_sets``."""
    import re

    cut = re.compile(WORD + "+")
    return [max(BLOCK, 2 * len(cut.findall(t.lower()))) for _, texts in sorted(templates.items()) for t in texts]


def _every_block(words: Column, size: int, vocabulary: list[str], prefix: list[str]) -> Column:
    """(block, held): the size, and the template words in their order, of the blocks of
    ``size`` words that begin at a template word and hold a prefix word; equal ones once."""
    order = F.array(*[F.lit(w) for w in vocabulary])
    places = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.element_at(words, i).isin(prefix))
    before = F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(F.greatest(p - size + 1, F.lit(1)), p))))
    begins = F.filter(before, lambda i: F.element_at(words, i).isin(vocabulary))
    held = F.array_distinct(F.transform(begins, lambda i: F.array_intersect(order, F.slice(words, i, size))))
    return F.transform(held, lambda h: F.struct(F.lit(size).alias("block"), h.alias("held")))


def matching_blocks(docs: DataFrame, templates: dict[str, list[str]] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """text_digest, label, containment of every text block and template that
    meet the threshold; texts are named by their SHA-256, so copies do not multiply."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    sets = template_sets(templates)
    sizes = block_sizes(templates)
    order = word_order(docs, set().union(*(s for _, s in sets)))
    rank = {w: i for i, w in enumerate(order)}
    rows, prefix_words, by_size = [], set(), {}
    for k, ((label, words), size) in enumerate(zip(sets, sizes)):
        ordered = sorted(words, key=rank.get)
        need = math.ceil(containment * len(ordered) - 1e-9)
        for i, w in enumerate(ordered[:len(ordered) - need + 1]):
            rows.append((w, size, k, label, ordered, len(ordered) - i, need))
            prefix_words.add(w)
            by_size.setdefault(size, (set(), set()))[1].add(w)
        if ordered:
            by_size[size][0].update(ordered)
    index = spark.createDataFrame(rows, "word string, block int, template int, label string, words array<string>, rest int, need int")
    prefix = F.array(*[F.lit(w) for w in sorted(prefix_words, key=rank.get)])
    text = whole_text()
    held = (docs.select(text.alias("t")).where(F.col("t").rlike(_pattern(sorted(prefix_words))))
            .select(F.sha2("t", 256).alias("text_digest"), _all(_lower(F.col("t")), WORD + "+").alias("w")))
    # array_intersect keeps the order of its first side: the global order
    ranked = lambda words: sorted(words, key=rank.get)
    lists = [_every_block(F.col("w"), size, ranked(of), ranked(first)) for size, (of, first) in sorted(by_size.items())]
    least = F.lit(min((r[-1] for r in rows), default=0))
    sorted_blocks = (held.select("text_digest", F.explode(F.filter(F.concat(*lists), lambda b: F.size(b["held"]) >= least)).alias("b"))
                     .select("text_digest", "b.block", "b.held").distinct())
    met = (sorted_blocks.select("text_digest", "block", "held", F.explode(F.array_intersect(prefix, "held")).alias("word"))
           .join(index, ["word", "block"])
           .where((F.size("held") >= F.col("need"))
                  & (F.least("rest", F.size("held") - F.array_position("held", F.col("word")) + 1) >= F.col("need"))))
    share = F.size(F.array_intersect("held", "words")) / F.size("words")
    return (met.select("text_digest", "label", share.alias("containment"), "need", "words", "held")
            .where(F.size(F.array_intersect("held", "words")) >= F.col("need"))
            .groupBy("text_digest", "label").agg(F.max("containment").alias("containment")))


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The base columns tell of the fixed phrases; labels adds those of matching
    templates; score is the largest share of a phrase (1) or template found, 0 if
    none. Null and empty texts have no words, null word places, empty labels."""
    phrase = rf"(?i)(?<!{WORD})(?:{'|'.join(p.replace(' ', GAP) for p in PHRASES)})(?!{WORD})"
    words_in = lambda c: F.regexp_count(c, F.lit(WORD + "+")).cast("long")
    first = docs.select("doc_id", whole_text().alias("t")).select("doc_id", "t", _all(F.col("t"), phrase).alias("found"))
    # places: count the words before the first phrase, and from the last one on
    gaps = F.when(F.size("found") > 0, F.split("t", phrase, -1))
    base = (first.select("*", words_in(F.col("t")).alias("n_words"), gaps.alias("gaps"))
            .select("doc_id", F.sha2("t", 256).alias("text_digest"), "n_words", F.size("found").cast("long").alias("n_base"),
                    words_in(F.col("gaps")[0]).alias("first_word"),
                    F.when(F.size("found") > 0, F.col("n_words") - words_in(F.element_at("gaps", -1)) - words_in(F.element_at("found", -1))).alias("last_word"),
                    F.array_sort(F.array_distinct(F.transform("found", _label))).alias("base_labels")))
    more = (matching_blocks(docs, templates, containment).groupBy("text_digest")
            .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best")))  # at most one entry per label
    none = F.expr("cast(array() as array<string>)")
    return base.join(more, "text_digest", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("base_labels", F.coalesce("more", none)))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def _label(match: Column) -> Column:
    out = F.lit(None).cast("string")
    for words, label in PHRASES.items():
        out = F.when(_lower(match).startswith(words.split()[0]), F.lit(label)).otherwise(out)
    return out
