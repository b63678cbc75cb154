"""Main text of pages: a plain reading of the given layout, and hand-made pages."""

import html
import re
import time

import numpy as np
import pytest

from tidemark.llm import html_text
from tidemark.llm.queries import QUERIES


def text_of(page):
    (blocks, kept), = html_text._judged([page], html_text.article_tree())
    return "\n\n".join(b[0] for b, k in zip(blocks, kept) if k)


def plain(page):
    """The article of the given layout, cut at its headings and paragraphs."""
    inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in p else "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages(spark, sf):
    d = f"/root/testdata/{sf}"
    pages = {r.page_id: r for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    got = QUERIES["op12_html_extraction"](spark, d)
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    rows = got.collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


P1 = "The council voted on Tuesday to extend the tram line to the harbour, after two years of talks with the operators and the residents of the old town."
P2 = "Work on the new track is expected to begin in spring &amp; to last about eighteen months, said the head of the planning office in a short statement."
P3 = "Costs are put at ninety million, a third of which will be carried by the region, while the rest has to be found in the budget of the city itself."
E2 = html.unescape(P2)
WANT = "\n\n".join([P1, E2, P3])

LAYOUTS = {
    "semantic": f"""<header><a href=/>Paper</a><p>Your daily news since 1902, from town and country and the sea</p></header><nav><a href=a>Home</a></nav>
        <main><article><p>{P1}</p><aside><p>{P3} And more of this kind.</p></aside><p>{P2}</p><p>{P3}</p>
        <footer><p>Filed under local news by the desk of the paper</p></footer></article></main><footer><p>All rights reserved by the paper and its partners</p></footer>""",
    "classes": f"""<div class="site-header"><div>The Paper</div></div><div id="cookieBanner"><p>{P3} We value your privacy.</p></div>
        <div class="content-sidebar-wrap"><div class="entry-content"><p>{P1}<p>{P2}<div class="ad-slot"><p>{P1} Buy now!</p></div><p>{P3}</div>
        <div class="sidebar widget-area"><ul><li>{P1}</ul></div></div>""",
    "comments": f"""<article><p>{P1}</p><p>{P2}</p><p>{P3}</p></article><section id="comments"><h3>2 comments</h3>
        <article class="comment"><p>{P1} I disagree.</p></article><ol><li><article><p>{P2} So do I, and so does everyone whom I know here.</p></article></li></ol></section>""",
    "form around": f"""<form id="aspnet"><div><article><p>{P1}</p><p>{P2}</p><p>{P3}</p></article></div><p>Send us a letter</p><input name=x><select><option>One<option>Two</select></form>""",
    "bare": f"""<div><a href=1>Home</a></div><div><a href=2>Sport</a></div><div><a href=3>Local news</a></div><div>{P1}</div><div>{P2}</div><div>{P3}</div>
        <div><a href=4>Read next</a></div><div><a href=5>Imprint</a> and <a href=6>terms</a></div>""",
    "scripts": f"""<article><script>if (a < b) document.write("<p>no</p>")</script><style>p > a {{}}</style><p>{P1}</p><!-- <p>no</p> --><noscript><p>no</p></noscript>
        <p hidden>{P1}</p><p style="display: none">{P2}</p><template><p>no</p></template><p>{P2}</p><textarea>no</textarea><button>Send</button><p>{P3}</p></article>""",
    "roles": f"""<div role="banner"><p>{P1}</p></div><div role="main" class="col"><div>{P1}</div><div>{P2}</div><div>{P3}</div></div><div role="contentinfo">{P3}</div>""",
    "upper case, no ends": f"""<HTML><BODY CLASS="has-sidebar"><DIV CLASS=menu><A HREF="x">Home</A></DIV><ARTICLE><P>{P1}<P>{P2}<P>{P3}</ARTICLE><DIV ID=footer>{P2}""",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    assert text_of(LAYOUTS[name]) == WANT


def test_inside_a_block():
    page = "<article><h1>A  title</h1><p>one\n two&nbsp;three<br>four <b>fi</b>ve &lt;b&gt; &#x1F600; &unknown; 3 < 4 <span>x</span></p><ul><li>first point<li>second point</ul></article>"
    assert text_of(page) == "A title\n\none two three four five <b> \U0001f600 &unknown; 3 < 4 x\n\nfirst point\n\nsecond point"


def test_broken_markup():
    assert text_of(f"<article><p>{P1}</p><p class='x") == P1
    assert text_of(f'<article><p>{P1}</p><p class="x>{P3}</p><p>{P3}</p>') == "\n\n".join([P1, P3, P3])
    assert text_of(f"<article></div></p></b><p>{P1}</article></article></nav>") == P1
    assert text_of(f"<article><p>{P1}<!-- never closed <p>{P3}") == P1
    assert text_of(f"<article><p><a href=x>{P1}</p><p>{P3}</p>") == P3  # a link ends with its paragraph


@pytest.mark.parametrize("unit", ["<p ", "<", "<a \"", "</", "<!--", "<div>", "<p>", "<li>", "<a href='", "&amp", "<script>", "<b><div class=ad>", "<td><p>"])
def test_long_odd_pages_in_linear_time(unit):
    t0 = time.perf_counter()
    text_of(unit * (1_500_000 // len(unit)))
    assert time.perf_counter() - t0 < 20


def test_rows(spark):
    page = LAYOUTS["semantic"]
    rows = [(1, "u", page, "t", 5), (1, None, page, None, None), (None, "v", "", "t", 5), (3, "w", None, "t", 5), (4, "x", "   <p> </p>", "t", 5),
            (5, "y", f"<article>{'<p>' + P1 + '</p>'}" * 1 + f"<p>{P3}</p>" * 20_000, "t", 5), (6, "z", "no markup at all, a few words", "t", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = [tuple(r) for r in html_text.main_text(df).collect()]
    assert got[0] == (1, "u", WANT, len(WANT)) and got[1] == (1, None, WANT, len(WANT))
    assert got[2:5] == [(None, "v", "", 0), (3, "w", "", 0), (4, "x", "", 0)]
    assert got[5][2] == "\n\n".join([P1] + [P3] * 20_000)
    assert html_text.main_text(df.limit(0)).count() == 0
    blocks = html_text.text_blocks(df).where("page_id = 1 AND kept").orderBy("position").collect()
    assert [b.text for b in blocks] == [x for x in WANT.split("\n\n") for _ in (0, 1)] and html_text.text_blocks(df.limit(0)).count() == 0


def slow_tree(x, y, depth):
    """The best tree level by level, each cut by trying all."""
    def impurity(v):
        p = sum(v) / len(v) if len(v) else 0
        return 2 * p * (1 - p) * len(v)

    if depth == 0 or len(set(y)) == 1:
        return bool(2 * sum(y) > len(y))
    best = (1e-9, None)
    for j in range(len(x[0])):
        values = sorted({r[j] for r in x})
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            low, high = [t for r, t in zip(x, y) if r[j] <= cut], [t for r, t in zip(x, y) if r[j] > cut]
            gain = impurity(y) - impurity(low) - impurity(high)
            if gain > best[0] + 1e-9:
                best = (gain, (j, cut))
    if best[1] is None:
        return bool(2 * sum(y) > len(y))
    j, cut = best[1]
    parts = [[(r, t) for r, t in zip(x, y) if (r[j] <= cut) == side] for side in (True, False)]
    return (j, cut, *(slow_tree([r for r, _ in p], [t for _, t in p], depth - 1) for p in parts))


def test_tree():
    x, y = html_text.labelled_table()
    tree = html_text.article_tree()
    assert (html_text._judge(tree, x) == y).all() and len(y) < 200

    def walk(node, r):
        while not isinstance(node, bool):
            node = node[2] if r[node[0]] <= node[1] else node[3]
        return node

    slow = slow_tree(x.tolist(), y.tolist(), 8)
    assert [walk(slow, r) for r in x] == [walk(tree, r) for r in x] == y.tolist()
    # each page left out in turn is judged by a tree of the others
    pages = np.repeat(np.arange(html_text.LABELLED.count("\n\n") + 1), [len(p.splitlines()) for p in html_text.LABELLED.strip().split("\n\n")])
    right = sum((html_text._judge(html_text.grow_tree(x[pages != k], y[pages != k]), x[pages == k]) == y[pages == k]).sum() for k in set(pages))
    assert right / len(y) > 0.85
