import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tidemark.llm import simhash
from tidemark.llm.components import connected_components


def slow_fingerprint(text):
    words, word = [], ""
    for c in text or "":
        c = c.lower() if "A" <= c <= "Z" else c
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    words += [word] * bool(word)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps):
    """{key: fp} -> {key: least key of its component}"""
    parent = {k: k for k in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: find(k) for k in keys}


def test_segments():
    assert len(simhash.segments(4)) == 3 and sum(n for _, n in simhash.segments(4)) == 64
    assert len(simhash._variants(4)) == 64


def test_near_duplicates(docs_of):
    r = random.Random(3)
    base = [" ".join(r.choice("abcdefgh") * r.randint(1, 3) for _ in range(60)) for _ in range(25)]
    docs = [d for d in ODD if len(d[1] or "") < 9000 and d[0] not in (None, 4)]
    for i in range(150):
        words = r.choice(base).split()
        for _ in range(r.randint(0, 2)):
            words[r.randrange(len(words))] = "zz"
        docs.append((1000 - i, " ".join(words)))
    got = {x.doc_id: x for x in simhash.near_duplicates(docs_of(docs)).collect()}
    fps = {i: slow_fingerprint(t) for i, t in docs}
    assert {i: int(x.fingerprint, 16) for i, x in got.items()} == fps
    assert {i: x.component_id for i, x in got.items()} == slow_components(fps)
    kept = {x.doc_id for x in simhash.one_of_each(docs_of(docs)).collect()}
    assert kept == {x.component_id for x in got.values()}


def test_odd_rows(docs_of):
    got = simhash.near_duplicates(docs_of(ODD)).collect()
    assert len(got) == len(ODD)
    assert {x.component_id for x in got if x.doc_id in (1, 2, 3)} == {1}
    assert {x.component_id for x in got if x.doc_id is None or x.doc_id == 7} == {7}
    kept = simhash.one_of_each(docs_of(ODD))
    assert kept.columns == docs_of(ODD).columns
    assert sorted(x.doc_id or 0 for x in kept.collect()) == [0, 1, 4, 5, 6, 7, 8]
    assert simhash.near_duplicates(docs_of([])).count() == 0


@pytest.mark.parametrize("block", [4, 4096])
def test_no_link_is_lost(spark, monkeypatch, block):
    """Random walks of few bits, in groups of one variant larger than a block."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    r = random.Random(block)
    fps = {0}
    for _ in range(30):
        x = r.getrandbits(64)
        for _ in range(12):
            for _ in range(r.choice([1, 2, 3, 4, 5, 6])):
                x ^= 1 << r.randrange(64)
            fps.add(x)
    fps |= {1 << b for b in range(40)}
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    roots = {x.node: x.root for x in connected_components(simhash.links(df)).collect()}
    signed = {int(np.uint64(x).view(np.int64)): x for x in fps}
    assert {k: roots.get(k, k) for k in signed} == slow_components(signed)


def test_components_of_a_path(spark):
    edges = spark.range(60).select((F.col("id") * 7919 % 61).alias("a"), ((F.col("id") + 1) * 7919 % 61).alias("b"))
    got = connected_components(edges).collect()
    assert {x.root for x in got} == {0} and len(got) == 61


def test_rows_that_share_an_id(docs_of):
    """Of rows with one id, each component is decided for itself; of equal rows one stays."""
    a = " ".join(f"word{i}" for i in range(400))
    near = a.replace("word7 ", "other ")
    b = " ".join(f"thing{i * i}" for i in range(400))
    docs = [(3, a), (5, near), (5, b), (7, b), (9, "alone " * 5), (9, "alone " * 5), (None, a)]
    assert bin(slow_fingerprint(a) ^ slow_fingerprint(near)).count("1") <= 4
    kept = sorted((x.doc_id or -1, x.text) for x in simhash.one_of_each(docs_of(docs)).collect())
    assert kept == sorted([(3, a), (5, b), (9, "alone " * 5), (-1, a)])
