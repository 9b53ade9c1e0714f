"""Main text of web pages by gradient-boosted trees over the nodes of their document trees.

A page is parsed into a tree of its block elements; inline elements belong to the text of their block.
Trees trained by Spark ML on features of nodes (text density of the subtree, tokens of attributes, depth,
siblings and the like) give the probability that a node holds main text. A node is kept only if its
parent is: among all such choices the most likely one is taken, bottom up, so that no ancestor
contradicts a descendant.

The training pages are made by ``labelled_pages`` from layout rules, ``TRAINING_PAGES`` of them; all pages
of a table are read whole, also very long and deeply nested ones. Defined results: a null or empty page, and one without kept text, has the
empty text; repeated rows are returned each; an empty table gives an empty result; columns other than
the named ones are kept, columns named as the results are replaced; where keeping and dropping a
node are as likely, it is dropped.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from citypulse.llm.registry import query
from citypulse.llm.storage import table

# Fixed values of HTML: elements by kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
SKIPPED = set("head script style template noscript iframe object svg math canvas audio video map button select option textarea datalist title".split())
BLOCKS = set(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag ends an open element of these kinds, unless one of the bounding kinds is between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
CLOSE_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "summary"}

TAGS = [
    {"article", "main"}, {"section"}, {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"li", "dd", "dt"}, {"ul", "ol", "dl", "menu"},
    {"table", "tr", "td", "th", "tbody", "thead"}, {"div", "center"}, {"nav", "menu"}, {"header", "hgroup"}, {"footer"}, {"aside"},
    {"form", "fieldset"}, {"blockquote", "pre", "figure", "figcaption"},
]
#: Kinds of elements whose text is rarely main text: nav, footer, aside, form.
AGAINST = [9, 11, 12, 13]
# Words that sites put in class, id and role of such elements.
TOKENS = [
    set("nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pagination pager toc tabs".split()),
    set("ad ads advert advertisement adsense sponsor sponsored promo promotion banner teaser".split()),
    set("comment comments reply replies disqus respond discussion thread reader".split()),
    set("cookie cookies notice consent gdpr popup modal overlay alert newsletter subscribe signup paywall".split()),
    set("sidebar aside related recommended widget share social sharing footer copyright legal meta tags complementary contentinfo".split()),
    set("article content post entry main story body text page hentry blog".split()),
    set("header masthead topbar logo brand site".split()),
]


class Node:
    """A block element: its text pieces and block children in order."""

    __slots__ = ("tag", "attrs", "parent", "items", "links", "tags", "skip")

    def __init__(self, tag: str, attrs: str, parent: Node | None, skip: bool) -> None:
        self.tag, self.attrs, self.parent, self.skip = tag, attrs, parent, skip
        self.items: list[str | Node] = []
        self.links = self.tags = 0


# An attribute as the HTML standard reads it: a name up to white space, / > or =, and a value in quotes, or without
# them up to white space or >; quotes elsewhere are plain characters. Without its closing quote a value ends
# with the page. Nothing is given back once matched, so a page is read in one pass.
_ATTRIBUTE = r"[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+"
_MARKUP = re.compile(rf"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|{_ATTRIBUTE})*+)(?:>|\Z)", re.S)
_SPACE = re.compile(r"[\s\xa0]+")


def parse(page: str) -> Node:
    """The tree of block elements. Closing tags may be missing, as browsers allow."""
    root = Node("html", "", None, False)
    stack: list[tuple[str, Node]] = [("html", root)]  # every open element, with the block that its text belongs to
    raw, at, link, n = "", 0, 0, len(page)

    def text(piece: str) -> None:
        own = stack[-1][1]
        if own.skip or not piece:
            return
        piece = html.unescape(piece)
        own.items.append(piece)
        if link:
            own.links += len(piece.strip())

    def close(k: int) -> None:
        nonlocal link
        for tag, _ in stack[k:]:
            link -= tag == "a"
        del stack[k:]

    while at < n:
        if raw:
            end = re.compile(rf"</{raw}[\s/>]", re.I).search(page, at)
            at, raw = (end.start() if end else n), ""
            continue
        m = _MARKUP.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        own = stack[-1][1]
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
                # An inline end tag does not close the blocks around it.
                if tag not in BLOCKS and stack[k][0] in BLOCKS:
                    break
            continue
        own.tags += 1
        if tag in CLOSE_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        if tag in ENDS:
            ended, bound = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ended:
                    close(k)
                    break
                if stack[k][0] in bound:
                    break
        if tag in ("html", "body") and any(t == tag for t, _ in stack):
            root.attrs += m[3]
            continue
        own = stack[-1][1]
        if tag == "br":
            text(" ")
        if tag in VOID:
            if tag == "hr":
                own.items.append(Node("hr", "", own, True))
            continue
        if tag in BLOCKS or tag in SKIPPED:
            child = Node(tag, m[3], own, own.skip or tag in SKIPPED)
            own.items.append(child)
            stack.append((tag, child))
        else:
            stack.append((tag, own))
            link += tag == "a"
        if m[3].rstrip().endswith("/") and tag in ("svg", "math", "path"):
            close(len(stack) - 1)
            continue
        if tag in RAW:
            raw = tag
    return root


def pieces(node: Node) -> Iterator[str]:
    """Text of the node itself: runs of text between block children, each with single spaces."""
    run: list[str] = []
    for item in [*node.items, None]:
        if isinstance(item, str):
            run.append(item)
            continue
        joined = _SPACE.sub(" ", "".join(run)).strip()
        if joined:
            yield joined
        run = []


class Tree(NamedTuple):
    """Nodes of a page in document order, without skipped ones; parents come before children."""

    nodes: list[Node]
    parent: np.ndarray
    own: list[list[str]]
    features: np.ndarray


_WORD = re.compile(r"[a-z]+")
_VALUE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)|'([^']*+)|([^\s>\"'][^\s>]*+))?+[\"']?)?+", re.S)
_NAMED = {"class", "id", "role"}


def attributes(attrs: str) -> list[tuple[str, str]]:
    """Names, in lower case, and values of the attributes of a tag."""
    return [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _VALUE.finditer(attrs)]


def attribute_words(attrs: str) -> set[str]:
    if "=" not in attrs:
        return set()
    values = " ".join(value for name, value in attributes(attrs) if name in _NAMED)
    return set(_WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", values).lower()))


def tree(page: str) -> Tree:
    root = parse(page)
    nodes, parent, number = [], [], {}
    todo = [root]
    while todo:
        node = todo.pop()
        number[id(node)] = len(nodes)
        parent.append(number[id(node.parent)] if node.parent is not None else -1)
        nodes.append(node)
        todo += [x for x in reversed(node.items) if isinstance(x, Node) and not x.skip]
    own = [list(pieces(x)) for x in nodes]
    return Tree(nodes, np.array(parent), own, _features(nodes, np.array(parent), own))


def _features(nodes: list[Node], parent: np.ndarray, own: list[list[str]]) -> np.ndarray:
    n = len(nodes)
    kinds = np.array([[x.tag in t for t in TAGS] for x in nodes], float)
    words = [attribute_words(x.attrs) for x in nodes]
    tokens = np.array([[len(w & t) > 0 for t in TOKENS] for w in words], float)
    text = np.array([sum(map(len, o)) for o in own], float)
    marks = np.array([sum(s.count(c) for s in o for c in ".,;:!?") for o in own], float)
    links = np.array([x.links for x in nodes], float)
    tags = np.array([x.tags for x in nodes], float)
    start = np.cumsum(text) - text
    total, all_links, all_tags, all_marks = text.copy(), links.copy(), tags.copy(), marks.copy()
    depth, above_kinds, above_tokens = np.zeros(n), np.zeros_like(kinds), np.zeros_like(tokens)
    place, siblings, n_par = np.zeros(n), np.zeros(n), np.zeros(n)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        for x in (total, all_links, all_tags, all_marks):
            x[p] += x[i]
        n_par[p] += nodes[i].tag == "p"
        siblings[p] += 1
    count = np.zeros(n)
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        above_kinds[i] = np.maximum(above_kinds[p], kinds[p])
        above_tokens[i] = np.maximum(above_tokens[p], tokens[p])
        place[i], count[p] = count[p], count[p] + 1
    up = np.maximum(parent, 0)
    page = max(total[0], 1.0)
    near = siblings[up]
    left = np.maximum(near, 1)
    numbers = np.stack(
        [
            depth, np.log1p(total), np.log1p(text), all_links / np.maximum(total, 1), np.log1p(all_tags), np.log((total + 1) / (all_tags + 1)),
            all_marks / np.maximum(total, 1), total / page, start / page, np.log1p(near), place / left, n_par[up] / left,
            np.log1p((total[up] - total) / left), np.log1p(n_par), total / np.maximum(total[up], 1), all_links[up] / np.maximum(total[up], 1),
        ],
        axis=1,
    )
    # Whether any sign against main text, and any for it, is on the node, and on those above it.
    signs = [x.max(axis=1, keepdims=True) for pair in ((kinds, tokens), (above_kinds, above_tokens)) for x in (np.concatenate([pair[0][:, AGAINST], pair[1][:, :5]], axis=1), np.concatenate([pair[0][:, :1], pair[1][:, 5:6]], axis=1))]
    return np.concatenate([kinds, above_kinds, tokens, above_tokens, *signs, numbers], axis=1)


TRAINING_PAGES, TREES, DEPTH, SEED = 800, 40, 5, 7


def labelled_pages(count: int = TRAINING_PAGES, seed: int = SEED) -> Iterator[str]:
    """Pages of many layouts; every element says in ``data-k`` whether it holds main text."""
    rng = np.random.default_rng(seed)

    def pick(*options: str) -> str:
        return options[rng.integers(len(options))]

    def chance(p: float) -> bool:
        return rng.random() < p

    def some(low: int, high: int) -> int:
        return int(rng.integers(low, high + 1))

    def say(low: int, high: int) -> str:
        n = some(low, high)
        sizes = rng.integers(1, 10, n)
        out = ["".join(map(chr, rng.integers(97, 123, s))) for s in sizes]
        style = rng.random()
        for k in range(n):
            if style < 0.7 and rng.random() < 0.12:
                out[k] += pick(",", ".", ".", ";", ":")
            elif style > 0.85:
                out[k] += pick("%%%", "###", "", "!!")
        return " ".join(out).capitalize() + pick(".", ".", "", "!")

    def el(tag: str, keep: bool, inner: str, attrs: str = "", end: bool = True) -> str:
        return f"<{tag}{' ' + attrs if attrs else ''} data-k={int(keep)}>{inner}" + (f"</{tag}>" if end else "")

    def link(low: int = 1, high: int = 3) -> str:
        return f'<a href="/{some(1, 99)}">{say(low, high)}</a>'

    def links(tag: str, attrs: str = "") -> str:
        return el(tag, False, el(pick("ul", "ol"), False, "".join(el("li", False, link()) for _ in range(some(2, 9)))), attrs)

    def named(*names: str) -> str:
        return f'{pick("class", "id", "class")}="{pick("", "", "site-", "main-", "js-", "c-")}{pick(*names)}{pick("", "", "-1", "-box", "-wrap")}"'

    def wordy(low: int, high: int) -> str:
        return "".join(el("p", False, say(low, high)) for _ in range(some(1, 3)))

    def junk() -> str:
        kind = some(0, 15)
        if kind == 0:
            return links("nav")
        if kind == 1:
            return links("div", named("menu", "nav", "navigation", "breadcrumbs", "tabs"))
        if kind <= 4:
            return el("div", False, pick(say(3, 60), wordy(3, 40)), named("ad", "ads", "advert", "sponsored", "promo", "banner"))
        if kind == 5:
            return el("aside", False, el("h3", False, say(1, 3)) + pick(wordy(5, 40), links("div")), pick("", named("sidebar", "related")))
        if kind == 6:
            return el("div", False, pick(wordy(5, 40), links("div"), say(5, 40)), named("sidebar", "widget", "related", "recommended", "share", "social"))
        if kind == 7:
            return el("div", False, pick(say(8, 50), wordy(5, 40)) + "<button>OK</button>", named("cookie", "cookie-notice", "consent", "notice", "newsletter", "popup"))
        if kind == 8:
            return el("form", False, el("p", False, say(2, 20)) + "<label>" + say(1, 3) + "</label><input name=q><button>Go</button>", pick("", named("search", "subscribe", "signup")))
        if kind <= 10:
            one = "".join(el(pick("div", "li", "article"), False, el("p", False, say(4, 60)), named("comment", "reply")) for _ in range(some(1, 6)))
            return el(pick("section", "div", "ol"), False, el("h3", False, say(1, 3)) + one, named("comments", "comment-list", "respond", "discussion"))
        if kind == 11:
            return el("footer", False, pick("&copy; ", "") + pick(say(3, 60), say(3, 20), wordy(4, 30), links("div")), "")
        if kind == 12:
            return el("div", False, say(3, 40), named("footer", "copyright", "legal", "meta", "tags"))
        if kind == 13:
            return el("section", False, el("h2", False, say(1, 4)) + "".join(el("div", False, link(3, 8)) for _ in range(some(2, 5))), pick("", named("related", "recommended")))
        if kind == 14:
            return el("header", False, el("div", False, link() + say(1, 4)) + pick("", links("nav")), pick("", named("header", "masthead")))
        return el("div", False, link() + " " + link() + " | " + link(), "")

    def body(inside: float) -> str:
        out = []
        title = el("h1", True, say(2, 12))
        out.append(el("header", True, title) if chance(0.15) else title if chance(0.85) else "")
        open_ended = chance(0.3)
        for _ in range(some(1, (1, 3, 10, 40)[some(0, 3)])):
            kind = rng.random()
            if kind < 0.72:
                inner = say(1, (6, 40, 120, 300)[some(0, 3)])
                if chance(0.12):
                    inner = f"<b>{inner}<br>" if chance(0.5) else f"<em>{inner}</em> {say(1, 30)}"
                elif chance(0.15):
                    inner += f" {link()} {say(1, 20)}"
                out.append(el("p", True, inner, "", not open_ended or chance(0.5)))
            elif kind < 0.80:
                out.append(el(pick("h2", "h3"), True, say(1, 8)))
            elif kind < 0.86:
                out.append(el(pick("ul", "ol"), True, "".join(el("li", True, say(2, 25)) for _ in range(some(2, 6)))))
            elif kind < 0.90:
                out.append(el(pick("blockquote", "pre"), True, say(5, 50)))
            elif kind < 0.93:
                out.append(el("div", True, say(5, 80)))
            elif kind < 0.95:
                out.append(el("table", True, "".join(el("tr", True, "".join(el("td", True, say(1, 6)) for _ in range(3))) for _ in range(some(2, 5)))))
            elif kind < 0.97:
                out.append(el("figure", True, '<img src="x">' + el("figcaption", True, say(2, 15))))
            if chance(inside):
                out.append(junk())
        return "".join(out)

    for _ in range(count):
        content = body((0.0, 0.0, 0.08)[some(0, 2)])
        holder = some(0, 6)
        if holder <= 2:
            content = el("article", True, content, pick("", named("post", "article", "entry")))
        elif holder == 3:
            content = el("main", True, content)
        elif holder <= 5:
            content = el(pick("div", "section"), True, content, named("content", "post", "entry", "story", "article", "text", "main"))
        else:
            content = el("div", True, content)
        for _ in range(some(0, 2)):
            before = junk() if chance(0.3) else ""
            content = el("div", True, before + content + (junk() if chance(0.3) else ""), pick("", named("page", "wrap", "container", "main", "layout")))
        top = "".join(junk() for _ in range(some(0, 4)))
        bottom = "".join(junk() for _ in range(some(0, 4)))
        if chance(0.4):
            bottom += el("footer", False, pick("&copy; ", "") + say(3, 60))
        head = f"<head><title>{say(2, 9)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
        yield f'<!DOCTYPE html><html data-k=1>{pick(head, "")}<body data-k=1>{top}<!-- {say(1, 3)} -->{content}{bottom}' + pick("</body></html>", "")


_LABEL = re.compile(r"data-k=(\d)")


def training_rows() -> tuple[np.ndarray, np.ndarray]:
    x, y = [], []
    for page in labelled_pages():
        t = tree(page)
        labels = [int(m[1]) if (m := _LABEL.search(node.attrs)) else 1 for node in t.nodes]
        x.append(t.features)
        y.append(np.array(labels, float))
    return np.concatenate(x), np.concatenate(y)


class Boosted(NamedTuple):
    """Trees as arrays, one row each: feature (-1 in a leaf), threshold, children, value; and the weights of the trees."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        rows, margin = np.arange(len(x)), np.zeros(len(x))
        for t, w in enumerate(self.weight):
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                f = self.feature[t, at]
                down = np.where(x[rows, np.maximum(f, 0)] <= self.threshold[t, at], self.left[t, at], self.right[t, at])
                at = np.where(f < 0, at, down)
            margin += w * self.value[t, at]
        return 1 / (1 + np.exp(-2 * margin))


def train(spark: SparkSession) -> Boosted:
    """Fit the trees with Spark ML on the training pages."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors

    x, y = training_rows()
    rows = spark.createDataFrame([(float(label), Vectors.dense(v)) for v, label in zip(x, y, strict=True)], ["label", "features"]).coalesce(4)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=64, minInstancesPerNode=20, subsamplingRate=0.6, featureSubsetStrategy="0.4", seed=SEED).fit(rows)
    return exported(model)


def exported(model: object) -> Boosted:
    """The arrays of a fitted model."""
    parts = []
    for t in model.trees:
        nodes: list[list[float]] = []

        def add(node: object, nodes: list[list[float]] = nodes) -> int:
            me = len(nodes)
            nodes.append([-1, 0.0, 0, 0, node.prediction()])
            if node.subtreeDepth():
                split = node.split()
                nodes[me][:2] = [split.featureIndex(), split.threshold()]
                nodes[me][2] = add(node.leftChild())
                nodes[me][3] = add(node.rightChild())
            return me

        add(t._call_java("rootNode"))
        parts.append(np.array(nodes, float))
    out = np.zeros((len(parts), max(map(len, parts)), 5))
    for k, p in enumerate(parts):
        out[k, : len(p)] = p
    return Boosted(out[..., 0].astype(int), out[..., 1], out[..., 2].astype(int), out[..., 3].astype(int), out[..., 4], np.array(model.treeWeights))


def decoded(t: Tree, p: np.ndarray) -> np.ndarray:
    """The most likely choice in which every kept node has a kept parent. Nodes count by their own text."""
    p = np.clip(p, 0.01, 0.99)
    weight = 1 + np.log1p([sum(map(len, o)) for o in t.own])
    keep, drop = weight * np.log(p), weight * np.log(1 - p)
    for i in range(len(p) - 1, 0, -1):
        keep[t.parent[i]] += max(keep[i], drop[i])
        drop[t.parent[i]] += drop[i]
    out = np.zeros(len(p), bool)
    out[0] = True
    for i in range(1, len(p)):
        out[i] = out[t.parent[i]] and keep[i] > drop[i]
    return out


def text_of(t: Tree, kept: np.ndarray) -> str:
    """Blocks of the kept nodes in page order."""
    blocks: list[str] = []
    number = {id(x): k for k, x in enumerate(t.nodes)}

    def walk(node: Node) -> None:
        todo: list[tuple[Node, int]] = [(node, 0)]
        run: list[str] = []

        def flush() -> None:
            joined = _SPACE.sub(" ", "".join(run)).strip()
            if joined:
                blocks.append(joined)
            run.clear()

        while todo:
            own, k = todo.pop()
            while k < len(own.items):
                item = own.items[k]
                k += 1
                if isinstance(item, str):
                    run.append(item)
                    continue
                flush()
                if not item.skip and kept[number[id(item)]]:
                    todo.append((own, k))
                    own, k = item, 0
            flush()

    walk(t.nodes[0])
    return "\n\n".join(blocks)


def main_text(pages: DataFrame, model: Boosted, column: str = "html") -> DataFrame:
    """Add ``text`` and ``n_chars`` to pages."""
    new = ("text", "n_chars")
    kept = pages.drop(*(c for c in new if c != column))
    schema = T.StructType([*kept.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    sent = pages.sparkSession.sparkContext.broadcast(model)  # TREES trees of at most 2 ** (DEPTH + 1) nodes

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            at = batch.schema.get_field_index(column)
            for i in range(0, batch.num_rows, 200):
                trees = [tree(p.as_py() or "") for p in batch.column(at).slice(i, 200)]
                p = sent.value.probability(np.concatenate([t.features for t in trees]))
                end = np.cumsum([len(t.nodes) for t in trees])
                texts += [text_of(t, decoded(t, q)) for t, q in zip(trees, np.split(p, end[:-1]), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*batch.schema.names, *new])

    return kept.mapInArrow(extract, schema)


@query("op3_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages, train(spark)).select("page_id", "url", "text", "n_chars")
