"""Classifiers by held-out accuracy, decontamination by planted and brute-force cases."""

import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import ODD
from tidemark.llm import decontaminate, quality_gam, toxicity


def corpus(seed=1, n=700):
    r = random.Random(seed)
    common = ["".join(r.choice(["er", "an", "ti", "on", "th", "in", "re"]) for _ in range(r.randint(1, 4))) for _ in range(400)]
    bad = ["grombul", "snarfle", "vexatron", "plugh"]
    docs, labels = [], []
    for i in range(n):
        words = [r.choice(common) for _ in range(r.randint(20, 300))]
        toxic = i % 5 == 0
        for _ in range(r.randint(2, 8) * toxic):
            words.insert(r.randint(0, len(words)), r.choice(bad))
        junk = i % 7 == 0
        docs.append((i, "### ".join(words).upper() if junk else " ".join(words)))
        labels.append((i, int(not junk), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def made(spark):
    docs, labels = corpus()
    return docs, labels, spark.createDataFrame(labels + [(None, 1, 1), (9999, None, None), (3, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("which", ["toxic", "quality"])
def test_held_out_accuracy(docs_of, made, which):
    docs, labels, table = made
    truth = {i: t if which == "toxic" else q for i, q, t in labels}
    odd = [(d if d is None else 5000 + d, t) for d, t in ODD]
    run = toxicity.score_toxicity if which == "toxic" else quality_gam.score_quality
    got = run(docs_of(docs + odd), table).collect()
    assert len(got) == len(docs) + len(odd)
    folds, out = (5, 0) if which == "toxic" else (4, 2)
    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % folds == out) for x in got)
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= (0.5 if which == "toxic" else 0.7)) for x in got)
    held = [x for x in got if x.held_out and x.doc_id in truth]
    assert len(held) > 100 and np.mean([x.predicted == truth[x.doc_id] for x in held]) > 0.95


@pytest.mark.parametrize("run", [toxicity.score_toxicity, quality_gam.score_quality])
def test_without_labels_or_rows(spark, docs_of, run):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert run(docs_of([]), none).count() == 0
    got = run(docs_of(ODD), none).collect()
    assert len(got) == len(ODD) and {round(x.score, 6) for x in got} == {0.5}


def test_held_out_labels_are_not_learned(docs_of, made, spark):
    docs, labels, table = made
    flipped = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    score = lambda t: sorted((x.doc_id, x.score) for x in quality_gam.score_quality(docs_of(docs), t).collect())
    assert score(table) == score(flipped)


def test_without_toxic_keeps_columns(docs_of, made):
    docs, _, table = made
    df = docs_of(docs)
    kept = toxicity.without_toxic(df, df, table)
    assert kept.columns == df.columns and 500 < kept.count() < 620


def test_gam_tables_add_up():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # only the pair tells
    model = quality_gam.train(x, y)
    p = model.logit(x) > 0
    assert np.mean(p == y) > 0.9 and model.pairs[0][0] == (1, 0)
    one = model.bias + sum(t[np.searchsorted(c, v, "right")] for c, t, v in zip(model.edges, model.tables, x[0]))
    one += sum(t[np.searchsorted(model.pair_edges[a], x[0, a], "right"), np.searchsorted(model.pair_edges[b], x[0, b], "right")] for (a, b), t in model.pairs)
    assert one == pytest.approx(model.logit(x[:1])[0])


ITEMS = [(1, "A train leaves Boston at 9 hours and travels 120 km to reach the city of Chicago before noon. How fast must the train of Maria travel?"),
         (2, "Every farmer in the valley keeps three goats and seven hens near the old wooden barn behind the mill."), (3, "short one"), (4, None), (5, "Aa Bb Cc Dd Ee Ff Gg")]


def test_leaks(docs_of, spark):
    fill = "some ordinary words that stand around here and there in every text of this kind"
    other = ITEMS[0][1].replace("Boston", "Denver").replace("120", "355").replace("Chicago", "Dallas").replace("9", "11").replace("Maria", "Peter")
    docs = [(10, f"{fill}. {ITEMS[0][1]} {fill}"), (11, f"{fill} {other} {fill}"), (12, fill), (13, f"{fill} {ITEMS[1][1]}"), (13, f"{fill} {ITEMS[1][1]}"),
            (14, ITEMS[1][1][:40]), (15, "short one"), (16, "Hh Ii Jj Kk Ll Mm Nn"), (17, ITEMS[1][1].replace("valley", "canyon"))] + [(i and 100 + i, t) for i, t in ODD]
    bench = spark.createDataFrame(ITEMS + [(None, "x y z x y z x y z")], "item_id long, text string")
    got = sorted((x.doc_id, x.item_id) for x in decontaminate.contaminated(docs_of(docs), bench).collect())
    assert got == [(10, 1), (11, 1), (13, 2), (13, 2), (15, 3), (17, 2)]
    kept = decontaminate.without_leaks(docs_of(docs), bench)
    assert kept.columns == docs_of(docs).columns and kept.count() == len(docs) - 6
    assert decontaminate.contaminated(docs_of([]), bench).count() == 0
    assert decontaminate.contaminated(docs_of(docs), bench.limit(0)).count() == 0


def test_slots_must_be_consistent(docs_of, spark):
    """The same words around slots whose values do not map one to one."""
    item = "give Anna many red apples then give Anna some green pears then tell Anna about all those fruits now"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    changed = item.replace("Anna", "Zoe")
    mixed = item.replace("Anna", "Zoe", 1).replace("Anna", "Kim", 1).replace("Anna", "Lea", 1)
    got = {x.doc_id: x.n_windows for x in decontaminate.contaminated(docs_of([(1, changed), (2, mixed), (3, item)]), bench, 0.0).collect()}
    assert got[1] == got[3] > got[2]


def test_copy_beside_a_variant(docs_of, spark):
    """Values are chosen at each place where the item stands, not mixed over all of them."""
    item = "Add 12 apples to 30 pears and 7 plums then take 4 figs from 19 dates"
    values = lambda *v: "Add {} apples to {} pears and {} plums then take {} figs from {} dates".format(*v)
    fill = "words that stand between both of these here so that neither touches the other one"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = [(1, f"{item} {values(9, 15, 8, 3, 25)}"), (2, f"{values(9, 15, 8, 3, 25)}. {fill}. {item}"),
            (3, f"{values(12, 15, 8, 4, 25)}. {fill}. {values(9, 30, 6, 3, 20)}"), (4, f"{fill} {item[:26]} {fill}"),
            (5, item.replace("plums", "plums too and"))]
    got = {x.doc_id: x.coverage for x in decontaminate.contaminated(docs_of(docs), bench).collect()}
    assert {i: got.get(i) for i in (1, 2, 3)} == {1: 1.0, 2: 1.0, 3: 1.0}
    assert 4 not in got and 0.6 <= got[5] < 1


def test_items_without_windows(docs_of, spark):
    """Title-case, number-heavy and short items are found by their whole sequence of tokens."""
    items = [(1, "Who Wrote The Great Gatsby In America"), (2, "12 34 56, 78 90 11 13"), (3, "Capital of France?"), (4, "?"),
             (5, ITEMS[1][1]), (5, "Jane Austen Wrote Emma And Persuasion")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    fill = "some ordinary words that stand around"
    docs = [(1, f"{fill}: who wrote the Great Gatsby in America, {fill}"), (2, f"{fill} 12 34 56 78 90 11 13 14"), (3, f"{fill}. capital of France"),
            (4, "12 34 56 78 90 11 14"), (5, "Who Wrote The Great Gatsby In Canada"), (6, "capital of"), (7, f"{ITEMS[1][1]} Jane Austen wrote Emma and Persuasion")]
    found = lambda: sorted((x.doc_id, x.item_id) for x in decontaminate.contaminated(docs_of(docs), bench).collect())
    assert found() == [(1, 1), (2, 2), (3, 3), (7, 5)]


def slow_leaks(docs, items, coverage=0.6):
    """Pairs of text and item by their windows alone, for items without slots."""
    def windows(text):
        _, _, slot, h, usable = decontaminate.templates(text)
        assert not slot.any()
        return set(h[usable].tolist())

    held = [(i, windows(t)) for i, t in items]
    return sorted((d, i) for d, t in docs for i, w in held if w and len(w & windows(t)) / len(w) >= coverage)


def test_random_texts_against_brute_force(docs_of, spark):
    r = random.Random(11)
    words = [a + b for a in ("ba", "du", "ke", "lo", "mi") for b in ("ra", "ten", "vo", "sul")]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(8, 30)))) for i in range(40)]
    shared = " ".join(r.choice(words) for _ in range(12))
    items += [(100 + i, f"{shared} " + " ".join(r.choice(words) for _ in range(r.randint(0, 12)))) for i in range(20)]
    docs = []
    for d in range(120):
        _, text = r.choice(items)
        cut = text.split()
        for _ in range(r.randint(0, 4)):
            cut[r.randrange(len(cut))] = r.choice(words)
        docs.append((d, " ".join([r.choice(words) for _ in range(r.randint(0, 9))] + cut + shared.split() * r.randint(0, 1))))
    got = decontaminate.contaminated(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = slow_leaks(docs, items)
    assert sorted((x.doc_id, x.item_id) for x in got) == want and len(want) > 60


def test_shared_sentences_do_not_pair_all(docs_of, spark, monkeypatch):
    """Items and documents that share one sentence meet only where rarer windows do."""
    shared = "please read the whole question below and then choose the best of all answers"
    stored, materialize = {}, decontaminate.materialize

    def counted(df, name, *a):
        out = materialize(df, name, *a)
        stored[name] = out.count()
        return out

    monkeypatch.setattr(decontaminate, "materialize", counted)
    rows = {}
    for n in (100, 200, 400, 800):
        r = random.Random(n)
        word = lambda: "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(4))
        items = [(i, shared + " " + " ".join(word() for _ in range(30))) for i in range(n)]
        docs = [(i, shared + " " + " ".join(word() for _ in range(30))) for i in range(n)] + [(10_000, items[0][1])]
        got = decontaminate.contaminated(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
        assert [(x.doc_id, x.item_id) for x in got] == [(10_000, 0)]
        rows[n] = (stored["candidates"], stored["met-windows"])
    assert all(c == 1 and m == rows[100][1] for c, m in rows.values())


def test_windows_against_brute_force():
    r = random.Random(3)
    words = ["Anna", "said", "12", "km", "the", "Bob", "one", "miles", ".", "tree", "3.5", "kg", "USA"]
    for _ in range(50):
        text = " ".join(r.choice(words) for _ in range(r.randint(0, 40)))
        raw, keep, slot, h, usable = decontaminate.templates(text)
        tokens, before = [], "."
        for t in raw:
            if t == ".":
                before = t
                continue
            low = t.lower()
            if t[0].isdigit() or low in decontaminate.NUMBER_WORDS:
                kind = "<number>"
            elif low in decontaminate.UNITS:
                kind = "<unit>" if tokens and tokens[-1] == "<number>" and before != "." else low
            elif t[0].isupper() and not t.isupper() and before != ".":
                kind = "<name>"
            else:
                kind = low
            tokens.append(kind)
            before = t
        if "." in raw and any(a == "." for a in raw):  # a unit right after a full stop is rare; skip those texts
            units = [i for i, t in enumerate(raw) if i > 1 and raw[i - 1] == "." and t in ("km", "miles", "kg")]
            if units:
                continue
        n = max(0, len(tokens) - decontaminate.WINDOW + 1)
        assert len(h) == n
        windows = [tuple(tokens[i:i + decontaminate.WINDOW]) for i in range(n)]
        assert len(set(h.tolist())) == len(set(windows))
        assert [sum(not t.startswith("<") for t in w) >= decontaminate.LITERALS for w in windows] == usable.tolist()
