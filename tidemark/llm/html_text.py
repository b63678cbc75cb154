"""Main text of web pages from flat text blocks.

A page is cut into flat blocks: text between two block-level tags. A block is described by its own word
count and link density, those of the blocks before and after it, whether it is a
heading or list item, and what its enclosing elements call themselves (article or menu,
advert, comments and the like; innermost first). A decision tree, grown from the small table
``LABELLED``, decides which blocks belong to the article. Spark deals the pages out;
a page is read in one linear pass.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import small_batches, whole_text

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul
    button select option optgroup datalist svg math object audio video canvas""".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp".split())  # their content is no text of the page
EMPTY = frozenset("hr img input meta link area base col embed source track param".split())
CONTROLS = frozenset("button select option optgroup datalist svg math object audio video canvas".split())
SITE_TAGS = frozenset("nav footer aside menu dialog search".split())
#: elements that end at the start of another of their group, up to the elements that hold them
_SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select", "datalist"})}
_P_HOLDERS = frozenset("td th table caption button object html body".split())

#: names by which elements call themselves something other than the article, and the article
SITE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promos promotion promoted
    nav navbar navigation menu submenu breadcrumb breadcrumbs crumbs header masthead topbar footer foot bottombar sidebar side rail aside
    cookie cookies consent gdpr notice notices notification alert alerts popup modal overlay toast paywall disclaimer legal copyright colophon
    comment comments reply replies respond discussion disqus feedback share sharing social follow newsletter subscribe subscription signup signin
    login register search related recommended recommendations trending popular widget widgets toolbar pagination pager tags
    hidden skip""".split())
MAIN_NAMES = frozenset("article content main post entry story prose maincontent".split())
SITE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
_NOT_NAMES = frozenset("has with no without is".split())  # a name that begins so tells of something else
_FRAMES = frozenset("wrap wrapper layout grid".split())  # with one of these, a sidebar is only a part of the element

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}


def _kind(name: str, attributes: str, in_article: bool) -> int:
    """-1 for an element that calls itself something other than the article (-2 for a form, which
    may hold a whole page), 1 for the article, else 0."""
    named = 0
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "").lower()):
            return -1
        if key == "role":
            if value.lower() in SITE_ROLES:
                return -1
            named = named or int(value.lower() in ("main", "article"))
        elif key in ("class", "id") and name not in ("html", "body"):
            for token in value.split():
                words = [w.lower() for w in _NAME.findall(token)]
                if not words or words[0] in _NOT_NAMES:
                    continue
                site = SITE_NAMES.intersection(words)
                if site == {"header"} and (in_article or words[0] in MAIN_NAMES):
                    site = None
                elif site == {"sidebar"} and not _FRAMES.isdisjoint(words):
                    continue
                if site:
                    return -1
                named = named or int(not MAIN_NAMES.isdisjoint(words))
    if name in SITE_TAGS or name in CONTROLS or (name == "header" and not in_article):
        return -1
    if name == "form":
        return -2
    return named or int(name in ("article", "main"))


def page_blocks(page: str) -> list[tuple]:
    """(text, words, linked share, context, wrapped, heading, item) of the flat blocks of a page in
    order. Context is the kind of the innermost element that has one; wrapped tells
    whether an element outside the innermost article is not the article. Text is decoded, its white space single spaces. Unclosed
    elements, quotes, comments and tags end where browsers end them or at the next tag; nothing is read twice."""
    out, text, linked = [], [], []
    # open block elements: (name, context, wrapped); the state outside all is the first entry
    stack, count = [("", 0, 0)], {}
    link = 0  # height of the stack inside which a link is open, or 0
    tag, pos, end = _TAG, 0, len(page)

    def add(raw):
        if raw:
            part = html.unescape(raw) if "&" in raw else raw
            text.append(part)
            if link:
                linked.append(part)

    def flush():
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                inside = sum(len("".join(p.split())) for p in linked)
                name, context, wrapped = stack[-1]
                out.append((whole, max(whole.count(" ") + 1, len(whole) // 8), inside / len(whole.replace(" ", "")), max(context, -1), wrapped,
                            int(name in ("h1", "h2", "h3", "h4", "h5", "h6")), int(count.get("li", 0) > 0)))
            text.clear()
            linked.clear()

    def pop():
        name = stack.pop()[0]
        count[name] -= 1

    def close(names, holders):
        """End the innermost open element of ``names``, unless a holder comes first."""
        if any(count.get(n) for n in names):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in names:
                    while len(stack) > k:
                        pop()
                    return
                if stack[k][0] in holders:
                    return

    while pos < end:
        at = page.find("<", pos)
        if at < 0:
            add(page[pos:])
            break
        after = page[at + 1:at + 2]
        if not (after.isalpha() and after.isascii()) and after not in ("/", "!", "?"):
            add(page[pos:at + 1])
            pos = at + 1
            continue
        add(page[pos:at])
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 2)
            pos = end if stop < 0 else stop + 3
            continue
        m = tag.match(page, at) if after not in ("!", "?") else None
        if m is None:
            if after not in ("!", "?") and tag is _TAG and _PLAIN_TAG.match(page, at):
                tag = _PLAIN_TAG  # a quote that never ends: from here on tags end at the next >
                continue
            stop = page.find(">", at)
            pos = end if stop < 0 else stop + 1
            continue
        closing, name, attributes = m[1], m[2].lower(), m[3]
        pos = m.end()
        if name in RAW:
            if not closing:
                stop = _RAW_END[name].search(page, pos)
                pos = end if stop is None else stop.start()
            continue
        if name == "br":
            add(" ")
        elif name == "a":
            link = 0 if closing else len(stack)
        elif name in EMPTY:
            if name == "hr":
                flush()
        elif name in BLOCKS:
            flush()
            if closing:
                if count.get(name):
                    while stack[-1][0] != name:
                        pop()
                    pop()
            else:
                if name in _SIBLINGS:
                    close(*_SIBLINGS[name])
                if name not in CONTROLS:
                    close({"p"}, _P_HOLDERS)
                _, context, wrapped = stack[-1]
                kind = _kind(name, attributes, context > 0)
                if name == "main":  # a page has one
                    wrapped = 0
                elif kind > 0 and context == -1:
                    wrapped = 1
                stack.append((name, kind or context, wrapped))
                count[name] = count.get(name, 0) + 1
            if link > len(stack):
                link = 0
    flush()
    return out


#: label (+ article, - other), words, linked words, heading or item, context of innermost element, wrapped.
#: Consecutive rows are blocks of one page; a blank line ends it. Made by hand after common page layouts.
LABELLED = """
- 1 1 item site 0
- 2 2 item site 0
- 1 1 item site 0
- 9 0 - site 0
+ 8 0 head main 0
+ 74 2 - main 0
+ 1 0 - main 0
+ 31 0 - main 0
+ 3 0 - main 0
+ 120 4 - main 0
+ 2 0 - main 0
- 14 1 - site 0

- 3 3 - site 0
- 40 0 - site 0
+ 5 0 head main 0
+ 1 0 - main 0
- 22 0 - site 0
+ 16 0 - main 0
+ 2 0 item main 0
+ 11 3 item main 0
+ 4 0 item main 0
- 3 3 item main 0
- 4 4 item main 0
- 35 0 - site 0
- 60 6 - site 0

- 6 0 head site 0
- 2 2 - site 0
+ 7 0 head main 0
+ 230 8 - main 0
- 5 5 - main 0
+ 44 0 - main 0
+ 6 0 head main 0
+ 12 0 - main 0
- 2 0 head site 0
- 18 0 - main 1
- 45 0 - main 1
- 3 0 - main 1
- 110 1 - main 1
- 5 5 - main 1

- 1 1 - none 0
- 1 1 - none 0
- 2 2 - none 0
- 1 1 - none 0
+ 7 0 head none 0
+ 55 0 - none 0
+ 90 3 - none 0
+ 12 0 - none 0
+ 140 2 - none 0
+ 33 0 - none 0
- 3 3 - none 0
- 4 4 - none 0
- 9 3 - none 0

- 2 0 - none 0
- 3 3 item none 0
- 2 2 item none 0
- 2 2 item none 0
+ 10 0 head none 0
+ 38 1 - none 0
+ 8 0 - none 0
+ 61 0 - none 0
+ 5 0 head none 0
+ 47 0 - none 0
+ 15 0 item none 0
+ 21 0 item none 0
+ 18 0 item none 0
+ 70 0 - none 0
- 6 6 head none 0
- 7 7 item none 0
- 8 8 item none 0
- 5 0 - none 0

- 4 0 - none 0
- 2 1 - none 0
- 5 5 - none 0
+ 28 0 - none 0
+ 35 7 - none 0
+ 3 0 - none 0
+ 52 12 - none 0
- 12 12 - none 0
- 2 2 - none 0
- 4 0 - none 0

+ 6 0 head none 0
+ 20 0 - none 0
+ 26 0 - none 0

+ 2 0 head main 0
+ 17 4 - main 0
+ 66 15 - main 0
+ 9 1 item main 0
+ 30 8 item main 0
+ 3 0 - main 0

- 2 2 item site 0
- 1 1 item site 0
+ 3 0 head main 0
+ 25 0 - main 0
- 6 6 - main 0
+ 4 0 - main 0
+ 12 0 - main 0

- 2 2 - site 0
+ 1 0 head main 0
- 2 2 - main 0
+ 2 0 - main 0
+ 50 0 - main 0

+ 4 0 head main 0
- 3 3 - main 0
+ 50 0 - main 0

+ 1 0 head main 0
+ 5 0 - main 0

+ 3 0 - main 0

+ 9 0 head main 0
+ 4 0 head main 0
+ 80 24 - main 0
+ 1 0 - main 0
- 5 4 - main 0
- 6 5 item main 0

+ 42 0 - none 0

- 3 3 - none 0
- 3 0 - none 0

- 2 2 item site 0
- 30 0 - site 0
- 15 0 - site 0
+ 4 0 head main 0
- 2 2 item site 0
"""
_CONTEXT = {"site": -1, "none": 0, "main": 1}


def _features(blocks: list[tuple]) -> list[tuple]:
    """Of each block (words, linked share, context, wrapped, heading, item): its own numbers
    and the words and linked shares of its neighbours (none: zero words)."""
    edge = (0, 0.0)
    near = [edge, *((b[0], b[1]) for b in blocks), edge]
    return [(*b, *near[i], *near[i + 2]) for i, b in enumerate(blocks)]


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in LABELLED.strip().split("\n\n"):
        blocks = []
        for line in page.splitlines():
            label, words, linked, what, context, wrapped = line.split()
            blocks.append((int(words), int(linked) / int(words), _CONTEXT[context], int(wrapped), int(what == "head"), int(what == "item")))
            labels.append(label == "+")
        rows += _features(blocks)
    return np.array(rows, float), np.array(labels)


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 1):
    """A binary tree by Gini impurity: a leaf is a bool, a node (feature, cut, below or equal, above)."""
    if depth == 0 or y.all() or not y.any():
        return bool(2 * y.sum() > len(y))
    best = (0.0, None)
    whole = 2 * y.mean() * (1 - y.mean()) * len(y)
    for j in range(x.shape[1]):
        order = np.argsort(x[:, j], kind="stable")
        v, positive = x[order, j], np.cumsum(y[order])
        n = np.arange(1, len(y) + 1)
        left, right = positive / n, (positive[-1] - positive) / np.maximum(len(y) - n, 1)
        gain = whole - 2 * n * left * (1 - left) - 2 * (len(y) - n) * right * (1 - right)
        gain[(np.r_[v[1:], v[-1]] == v) | (n < least) | (len(y) - n < least)] = 0
        k = int(gain.argmax())
        if gain[k] > best[0] + 1e-9:
            best = (gain[k], (j, (v[k] + v[k + 1]) / 2))
    if best[1] is None:
        return bool(2 * y.sum() > len(y))
    j, cut = best[1]
    below = x[:, j] <= cut
    return j, cut, grow_tree(x[below], y[below], depth - 1, least), grow_tree(x[~below], y[~below], depth - 1, least)


@lru_cache(maxsize=1)
def article_tree():
    return grow_tree(*labelled_table())


def _judge(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, bool):
        return np.full(len(x), tree)
    j, cut, below, above = tree
    low = x[:, j] <= cut
    out = np.empty(len(x), bool)
    out[low], out[~low] = _judge(below, x[low]), _judge(above, x[~low])
    return out


def _judged(pages: list[str], tree) -> list[tuple[list, np.ndarray]]:
    """Blocks of each page and which of them belong to the article."""
    blocks = [page_blocks(p) for p in pages]
    rows = [f for b in blocks for f in _features([x[1:] for x in b])]
    kept = _judge(tree, np.array(rows, float).reshape(len(rows), 10))
    ends = np.cumsum([len(b) for b in blocks])
    return [(b, kept[e - len(b):e]) for b, e in zip(blocks, ends)]


def text_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, position, text, words, link_density, kept) of every block of every page."""
    tree = article_tree()
    id_type = pages.schema["page_id"].dataType.simpleString()

    def cut(batches):
        for b in batches:
            for k, (blocks, kept) in enumerate(_judged(b.column("html").to_pylist(), tree)):
                n = len(blocks)
                yield pa.record_batch([b.column("page_id").take(pa.array([k] * n, pa.int64())), pa.array(range(n), pa.int32()),
                                       pa.array([x[0] for x in blocks], pa.string()), pa.array([x[1] for x in blocks], pa.int64()),
                                       pa.array([x[2] for x in blocks], pa.float64()), pa.array(kept, pa.bool_())],
                                      names=["page_id", "position", "text", "words", "link_density", "kept"])

    return small_batches(pages).select("page_id", whole_text("html").alias("html")).mapInArrow(
        cut, f"page_id {id_type}, position int, text string, words long, link_density double, kept boolean")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page: the blocks of the article, two line feeds
    between them. A null html is empty; a page without article has an empty text. Rows are kept
    as they are (null and repeated ids, too); other columns are not read."""
    tree = article_tree()
    schema = T.StructType([T.StructField("page_id", pages.schema["page_id"].dataType), T.StructField("url", pages.schema["url"].dataType),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def extract(batches):
        for b in batches:
            texts = ["\n\n".join(x[0] for x, k in zip(blocks, kept) if k) for blocks, kept in _judged(b.column("html").to_pylist(), tree)]
            yield pa.record_batch([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                  names=schema.names)

    return small_batches(pages).select("page_id", "url", whole_text("html").alias("html")).mapInArrow(extract, schema)
