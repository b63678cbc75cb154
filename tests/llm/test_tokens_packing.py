"""Token counts and packing against the library and brute force."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD
from tidemark.llm import packing, token_counts, tokenizer
from tidemark.session import scratch_path

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
CHARS = st.one_of(st.sampled_from(list(" \n\t'abcsStTZ09.,!\"éÉßœ<|>endoftx")), st.characters(blacklist_categories=("Cs",)))


@settings(max_examples=300, deadline=None)
@given(st.text(CHARS, max_size=80))
def test_ids_are_the_librarys(text):
    for path in (BYTE, WORD):
        t = tokenizer.load(path)
        want = t.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(t.ids(text), "<u4").tolist() == want
        assert t.count(text) == len(want)


def test_memo_is_bounded():
    t = tokenizer.Tokenizer(WORD, memo=3)
    for x in ("aa bb cc dd ee", "ff gg aa"):
        t.ids(x)
    assert len(t.packed) == 3


def test_counts(spark, docs_of):
    got = token_counts.count_tokens(docs_of(ODD), BYTE).toPandas()
    lib = tokenizer.load(BYTE).library
    want = sorted((i or -1, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD)
    assert sorted((int(i) if i == i else -1, b, n) for i, b, n in zip(got.doc_id, got.n_bytes, got.n_tokens)) == want
    assert (got.over_limit == (got.n_tokens > 512)).all()


def test_cache_holds_each_content_once_and_is_reused(spark, docs_of):
    path = scratch_path(spark, "cache")
    first = docs_of([(1, "one two"), (2, "one two"), (3, None)])
    token_counts.fill_cache(first, BYTE, path)
    assert spark.read.parquet(path).count() == 2
    token_counts.fill_cache(first, BYTE, path)
    assert spark.read.parquet(path).count() == 2
    token_counts.fill_cache(docs_of([(9, "three"), (8, "one two")]), BYTE, path)
    assert spark.read.parquet(path).count() == 3
    token_counts.fill_cache(first, WORD, path)
    assert spark.read.parquet(path).count() == 5
    got = token_counts.count_tokens(docs_of([(9, "three"), (8, "one two")]), BYTE, path)
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {9: 1, 8: 2}


@pytest.mark.parametrize("op", [lambda d: token_counts.count_tokens(d, BYTE), lambda d: packing.pack_documents(d, WORD)])
def test_empty_table(docs_of, op):
    assert op(docs_of([])).count() == 0


def _best(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
    return max(sums)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_fullest_combination(counts, room):
    chosen = packing.fullest(counts, room)
    assert sum(k * c for k, c in chosen) == _best(counts, room)
    assert all(c <= counts[k] for k, c in chosen)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=10))
def test_bins_one_by_one(counts):
    """Removing a combination at once equals packing bin by bin."""
    left, singles = dict(counts), []
    while left:
        first = max(left)
        one = {**left, first: left[first] - 1}
        rest = dict(packing.fullest({k: v for k, v in one.items() if v}, 32 - first))
        rest[first] = rest.get(first, 0) + 1
        singles.append(sorted(rest.items(), reverse=True))
        left = {k: v - rest.get(k, 0) for k, v in left.items() if v > rest.get(k, 0)}
    assert [p for n, p in packing.minimum_bin_slack(counts, 32) for _ in range(n)] == singles


def check_packed(rows, docs, capacity=2048):
    lib = tokenizer.load(WORD).library
    want = []
    for i, t in docs:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(i or -1, k, k * capacity, len(x), zlib.crc32(x.tobytes())) for k in range(-(-len(ids) // capacity)) for x in [ids[k * capacity:(k + 1) * capacity]]]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def test_pack_documents(docs_of):
    docs = ODD + [(100 + i, "word " * (i * 37 % 900)) for i in range(120)] + [(300, "word " * 2047)] * 3
    bins = check_packed(packing.pack_documents(docs_of(docs), WORD).collect(), docs)
    total = sum(n for parts in bins.values() for _, n in parts)
    assert len(bins) <= -(-total // 2048) + 1
