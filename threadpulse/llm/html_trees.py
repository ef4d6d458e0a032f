"""Main text of web pages by boosted trees over nodes of the document tree.

A page is read into a tree in the way browsers do for the cases that matter: void elements, raw text of
scripts and styles, paragraphs and list items that end when the next begins, end tags without a beginning.
In a tag a quote opens a value only after '=' and white space, a value without quotes runs to white space or
'>', and other quotes are plain characters, as is one that the page never closes: no text after it is lost.
Each element has features: density of text, links and tags in its subtree, tokens of its class, id and role,
depth, place among its siblings and how they look, and what its ancestors are. Boosted trees give each
element the log-odds that it holds main text.

Decoding is hierarchical. An element is kept or dropped with all that is in it; it can be kept only if its
ancestors are. Among all such choices the one with the highest sum of log-odds is taken, from the leaves up,
so no child contradicts its parent.

Training needs no labels of the pages. A bounded sample (SAMPLE pages) is labelled by where an element
stands: in an article or main element or not, and not in navigation, adverts and the like. As pages of one
site look alike, the sample's trees are also varied: their own texts are put into sections of the kinds that
a page may have (comments, sidebars, notices, forms, and articles without an article element), whose label
is known. Labels come from the kind of a section, the model from its features.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed,
empty ones go, and the rest is joined by an empty line in page order. Nothing is capped.

Defined results: NULL, empty and textless pages have an empty text. Text outside any element counts as that
of the page's body. Rows are independent; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadpulse.llm import boosted_trees
from threadpulse.llm import words as W

SAMPLE = 120
VARIANTS = 5

# An attribute: its name, and its value in double quotes, in single quotes or bare.
_GAP = r"[\t\n\f\r ]"
_PART = rf"([^\t\n\f\r />][^\t\n\f\r />=]*+)(?:{_GAP}*+={_GAP}*+(?:\"([^\"]*)\"|'([^']*)'|([^\t\n\f\r >\"'][^\t\n\f\r >]*+)))?+"
_ATTRIBUTE = re.compile(_PART)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\t\n\f\r />]*+)((?:{_GAP}|/|{_PART.replace('([', '(?:[')})*+)>|<[!?][^>]*>", re.DOTALL
)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")

# Fixed sets of HTML.
READ = frozenset("class id role itemprop aria-label hidden style".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math select option datalist".split())
UNSEEN = RAW | {"head", "button", "object", "audio", "video", "canvas"}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br img input".split()
)
#: An element that ends when one of these begins inside it.
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
        "header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
}
#: Tokens of class, id and role by what they tell. Plurals and parts joined by signs are taken apart before.
TOKENS = {
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs skip toolbar sitemap",
    "ad": "ad ads advert advertisement adverts advertising sponsor sponsored sponsors promo promotion promoted banner "
    "adsense doubleclick outbrain taboola affiliate commercial dfp",
    "edge": "header footer masthead topbar bottombar copyright colophon site logo branding legal imprint",
    "side": "sidebar aside rail widget widgets related recommended recommendations popular trending more teaser "
    "complementary secondary tags",
    "notice": "cookie cookies consent gdpr notice notices notification alert alerts popup modal overlay dialog "
    "disclaimer paywall warning privacy",
    "comment": "comment comments reply replies disqus discussion respond commentlist reader readers feedback reviews",
    "form": "form login signup signin subscribe subscription newsletter search share sharing social contact input poll",
    "main": "article content main post entry story body text maincontent contentinfo articlebody postbody prose page",
}
_KIND_OF = {token: kind for kind, tokens in TOKENS.items() for token in tokens.split()}
_KINDS = list(TOKENS)
_TAGS = ["nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "p", "li", "ul", "table", "h", "quote", "a", "fieldset", "dialog"]
_TAG_OF = {**{f"h{i}": "h" for i in range(1, 7)}, "ol": "ul", "dl": "ul", "dt": "li", "dd": "li", "blockquote": "quote", "menu": "nav"}
#: Tags and kinds of tokens by which the sample is labelled.
_NOT_MAIN_TAGS = frozenset("nav header footer aside form dialog fieldset".split())
_NOT_MAIN_KINDS = frozenset(["nav", "ad", "edge", "side", "notice", "comment", "form"])


class Node:
    """An element, its kinds of tokens, and its children: nodes and pieces of text."""

    __slots__ = ("tag", "kinds", "hidden", "children", "parent", "label", "row")

    def __init__(self, tag: str, kinds: frozenset[str] = frozenset(), parent: Node | None = None, hidden: bool = False):
        self.tag, self.kinds, self.parent, self.hidden = tag, kinds, parent, hidden
        self.children: list[Node | str] = []
        self.label = self.row = None


def _attributes(raw: str) -> tuple[frozenset[str], bool]:
    kinds, hidden = set(), False
    for name, *values in _ATTRIBUTE.findall(raw):
        value = "".join(values)
        name = name.lower()
        if name not in READ:
            continue
        if name == "hidden" or name == "style":
            hidden |= name == "hidden" or "display:none" in value.replace(" ", "").lower()
            continue
        for token in _NAME.findall(value):
            token = token.lower()
            kind = _KIND_OF.get(token) or _KIND_OF.get(token.removesuffix("s"))
            if kind:
                kinds.add(kind)
    return frozenset(kinds), hidden


def _ends_itself(raw: str) -> bool:
    """Whether a tag ends in a slash that is no part of a bare value."""
    return raw.endswith("/") and all(m.end() < len(raw) for m in _ATTRIBUTE.finditer(raw))


def parse(page: str) -> Node:
    """The tree of a page; an element that never ends goes on to the end of its parent."""
    root = node = Node("body")
    at = 0
    search = _TOKEN.search
    while match := search(page, at):
        if match.start() > at:
            node.children.append(html.unescape(page[at : match.start()]))
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if match[1]:
            walk = node
            while walk is not root and walk.tag != tag:
                # an end tag of an inline element does not end blocks around it
                if tag in INLINE and walk.tag not in INLINE:
                    walk = root
                    break
                walk = walk.parent
            if walk is not root:
                node = walk.parent
            continue
        if tag in ("html", "body"):
            continue
        walk = node
        while walk is not root and (walk.tag in INLINE or walk.tag in CLOSED_BY):
            if tag in CLOSED_BY.get(walk.tag, ()):
                node = walk.parent
                break
            if walk.tag in ("li", "td", "th", "dd") and tag not in CLOSED_BY[walk.tag]:
                break
            walk = walk.parent
        kinds, hidden = _attributes(match[3]) if match[3] else (frozenset(), False)
        child = Node(tag, kinds, node, hidden)
        node.children.append(child)
        if tag in VOID or tag in ("svg", "math") and _ends_itself(match[3]):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>|\Z", re.IGNORECASE).search(page, at)
            at = end.end()
            continue
        node = child
    if at < len(page):
        # a tag that the page breaks off inside is no text
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!][^>]*\Z", rest)
        node.children.append(html.unescape(rest[: cut.start()] if cut else rest))
    return root


def _seen(node: Node) -> bool:
    return node.tag not in UNSEEN and not node.hidden


def elements(root: Node) -> list[Node]:
    """Visible block elements, parents before children. Inline elements belong to the block around them."""
    out, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        out.append(node)
        waiting += [c for c in reversed(node.children) if isinstance(c, Node) and _seen(c) and not _is_inline(c)]
        for inline in [c for c in node.children if isinstance(c, Node) and _seen(c) and _is_inline(c)]:
            waiting += _blocks_in(inline)
    return out


def _is_inline(node: Node) -> bool:
    return node.tag in INLINE


def _blocks_in(node: Node) -> list[Node]:
    """Blocks inside an inline element."""
    out, waiting = [], [node]
    while waiting:
        for c in waiting.pop().children:
            if isinstance(c, Node) and _seen(c):
                (waiting if _is_inline(c) else out).append(c)
    return out


def _block_parent(node: Node) -> Node | None:
    node = node.parent
    while node is not None and _is_inline(node):
        node = node.parent
    return node


#: Of a subtree: letters, letters in links, elements, links, paragraphs, list items, inputs, text pieces, commas.
_STATS = 9


def _own_stats(node: Node) -> list[float]:
    """Counts of the text and inline elements of a block itself."""
    text = linked_text = links = inputs = pieces = commas = 0
    waiting = [(node, False)]
    while waiting:
        here, linked = waiting.pop()
        for c in here.children:
            if isinstance(c, str):
                n = len(c.strip())
                text += n
                linked_text += n * linked
                pieces += n > 0
                commas += c.count(",") + c.count(".")
            elif c.tag in INLINE and not c.hidden:
                links += c.tag == "a"
                inputs += c.tag == "input"
                waiting.append((c, linked or c.tag == "a"))
            elif c.tag in ("button", "select", "textarea"):
                inputs += 1
    return [text, linked_text, 1, links, node.tag == "p", node.tag == "li", inputs, pieces, commas]


def features(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each of the elements of a tree, and its weight in decoding."""
    n = len(nodes)
    for i, node in enumerate(nodes):
        node.row = i
    stats = np.array([_own_stats(node) for node in nodes], float)
    own = stats.copy()
    parent = np.array([-1 if i == 0 else _block_parent(node).row for i, node in enumerate(nodes)])
    for i in range(n - 1, 0, -1):
        stats[parent[i]] += stats[i]
    total = np.maximum(stats[0], 1)
    depth, ahead = np.zeros(n), np.zeros(n)
    tags, kinds = np.zeros((n, len(_TAGS))), np.zeros((n, len(_KINDS)))
    for i, node in enumerate(nodes):
        tag = _TAG_OF.get(node.tag, node.tag)
        if tag in _TAGS:
            tags[i, _TAGS.index(tag)] = 1
        for kind in node.kinds:
            kinds[i, _KINDS.index(kind)] = 1
    above_tags, above_kinds = np.zeros_like(tags), np.zeros_like(kinds)
    siblings: dict[int, list[int]] = {}
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        above_tags[i] = np.maximum(above_tags[p], tags[p])
        above_kinds[i] = np.maximum(above_kinds[p], kinds[p])
        ahead[i] = len(siblings.setdefault(p, []))
        siblings[p].append(i)
    near = np.zeros((n, 4))
    for own_rows in siblings.values():
        rows = np.array(own_rows)
        sizes = stats[rows, 0]
        near[rows, 0] = len(rows)
        near[rows, 1] = ahead[rows] / len(rows)
        near[rows, 2] = sizes / max(1, sizes.max())
        near[rows, 3] = sizes.mean()
    letters = np.maximum(stats[:, 0], 1)
    density = np.stack(
        [
            np.log1p(stats[:, 0]),
            np.log1p(own[:, 0]),
            stats[:, 0] / total[0],
            stats[:, 1] / letters,
            own[:, 1] / np.maximum(own[:, 0], 1),
            stats[:, 0] / stats[:, 2],
            stats[:, 3] / stats[:, 2],
            stats[:, 4] / stats[:, 2],
            stats[:, 5] / stats[:, 2],
            stats[:, 6],
            stats[:, 8] / letters,
            stats[:, 4] / max(1, total[4]),
            depth,
        ],
        axis=1,
    )
    weight = 0.1 + np.sqrt(own[:, 0]) + 0.5 * np.sqrt(stats[:, 0])
    return np.concatenate([density, near, tags, kinds, above_tags, above_kinds], axis=1), weight


def decoded(nodes: list[Node], margin: np.ndarray, weight: np.ndarray) -> list[bool]:
    """Which elements are kept: the best choice in which each kept one's ancestors are kept.

    An element's weight grows with its own text and with that of its subtree.
    """
    parent = [-1 if i == 0 else _block_parent(node).row for i, node in enumerate(nodes)]
    best = (weight * margin).tolist()
    for i in range(len(nodes) - 1, 0, -1):
        if best[i] > 0:
            best[parent[i]] += best[i]
    kept = [True]  # the page itself
    for i in range(1, len(nodes)):
        kept.append(kept[parent[i]] and best[i] > 0)
    return kept


def _texts(root: Node, kept: set[int], own_text_of_root: bool) -> str:
    """Blocks of the kept elements in page order."""
    blocks: list[str] = []
    line: list[str] = []

    def close() -> None:
        block = _SPACE.sub(" ", "".join(line)).strip()
        line.clear()
        if block:
            blocks.append(block)

    waiting: list[tuple[Node | str, bool] | None] = [(root, own_text_of_root)]
    while waiting:
        item = waiting.pop()
        if item is None:
            close()
            continue
        node, wanted = item
        if isinstance(node, str):
            if wanted:
                line.append(node)
            continue
        if not _seen(node):
            continue
        if node.tag in ("br", "img", "input", "wbr"):
            line.append("" if node.tag == "wbr" else " ")
            continue
        block = not _is_inline(node)
        if block:
            close()
            wanted = id(node) in kept and (node is not root or own_text_of_root)
            waiting.append(None)
        waiting += [(c, wanted) for c in reversed(node.children)]
    close()
    return "\n\n".join(blocks)


def extract(pages: list[str | None], model: boosted_trees.Trees | None) -> list[str]:
    """The main texts of pages. Without a model all visible text is main."""
    roots = [parse(page or "") for page in pages]
    trees = [elements(root) for root in roots]
    if model is None:
        return [_texts(root, {id(node) for node in nodes}, True) for root, nodes in zip(roots, trees, strict=True)]
    found = [features(nodes) for nodes in trees]
    margins = np.split(model.margin(np.concatenate([x for x, _ in found])), np.cumsum([len(t) for t in trees])[:-1])
    out = []
    for root, nodes, margin, (_, weight) in zip(roots, trees, margins, found, strict=True):
        kept = decoded(nodes, margin, weight)
        out.append(_texts(root, {id(node) for node, k in zip(nodes, kept, strict=True) if k}, bool(margin[0] > 0)))
    return out


def _weakly_labelled(nodes: list[Node]) -> list[bool] | None:
    """Labels by where an element stands; None for a page without an article or main element."""
    main = [node.tag in ("article", "main") or "main" in node.kinds and node.tag in ("div", "section") for node in nodes]
    if not any(main):
        return None
    labels = []
    for node, is_main in zip(nodes, main, strict=True):
        parent = _block_parent(node)
        inside = is_main or parent is not None and parent.label
        against = node.tag in _NOT_MAIN_TAGS and not (node.tag == "header" and inside) or bool(node.kinds & _NOT_MAIN_KINDS - {"edge"})
        node.label = inside and not against
    for node in reversed(nodes):  # what holds main text is part of its path
        parent = _block_parent(node)
        if node.label and parent is not None:
            parent.label = True
    return [node.label for node in nodes]


def _varied(page: Node, nodes: list[Node], rng) -> Node:
    """The page's texts in sections of various kinds, with labels on the elements."""
    texts = [t for node in nodes if node.label for t in ["".join(c for c in node.children if isinstance(c, str)).strip()] if len(t) > 20] or ["text"]
    words = " ".join(texts).split()

    longest = [16, 40, 120][int(rng.integers(3))]

    def some(low: int, high: int) -> str:
        n, at = int(rng.integers(low, high)), int(rng.integers(max(1, len(words))))
        return " ".join(words[at : at + n]) or "text"

    def put(parent: Node, tag: str, label: bool, kinds: str = "", text: str = "") -> Node:
        node = Node(tag, frozenset(kinds.split()), parent)
        node.label = label
        if text:
            node.children.append(text)
        parent.children.append(node)
        return node

    def link(parent: Node, text: str) -> None:
        a = Node("a", frozenset(), parent)
        a.children.append(text)
        parent.children.append(a)

    def paragraphs(parent: Node, n: int, label: bool) -> None:
        for _ in range(n):
            p = put(parent, "p", label, "", some(5, longest) if label else some(3, 40))
            if rng.random() < 0.15:
                link(p, some(1, 4))

    def links(parent: Node, label: bool = False) -> None:
        ul = put(parent, "ul", label)
        for _ in range(int(rng.integers(2, 9))):
            link(put(ul, "li", label), some(1, 6))

    def boiler(parent: Node) -> None:
        kind = ["nav", "ad", "edge", "side", "notice", "comment", "form"][int(rng.integers(7))]
        tag = {"nav": "nav", "edge": ["header", "footer"][int(rng.integers(2))], "side": "aside", "form": "form"}.get(kind, "div")
        named = rng.random() < 0.75
        box = put(parent, tag if rng.random() < 0.6 or not named else ["div", "section"][int(rng.integers(2))], False, kind if named or tag == "div" else "")
        if kind in ("nav", "side") and rng.random() < 0.8:
            if rng.random() < 0.4:
                put(box, "h3", False, "", some(1, 4))
            links(box)
        elif kind == "comment":
            if rng.random() < 0.7:
                put(box, "h2", False, "", some(1, 4))
            holder = put(box, "ul", False) if rng.random() < 0.4 else box
            for _ in range(int(rng.integers(1, 8))):
                one = put(holder, "li" if holder is not box else ["div", "article"][int(rng.random() < 0.3)], False, "comment" if rng.random() < 0.7 else "")
                if rng.random() < 0.5:
                    one.children.append(some(3, 60))
                else:
                    paragraphs(one, int(rng.integers(1, 3)), False)
        elif kind == "form":
            put(box, "label", False, "", some(1, 4))
            box.children += [Node("input", frozenset(), box) for _ in range(int(rng.integers(1, 4)))]
            box.children.append(some(2, 20))
        elif rng.random() < 0.5:
            box.children.append(some(3, 60))
        else:
            paragraphs(box, int(rng.integers(1, 4)), False)

    root = Node("body")
    root.label = True
    outer = root
    for _ in range(int(rng.integers(0, 3))):
        outer = put(outer, "div", True, "main" if rng.random() < 0.2 else "")
    for _ in range(int(rng.integers(1, 4))):
        boiler(root if rng.random() < 0.5 else outer)
    tag = ["article", "article", "main", "div", "section"][int(rng.integers(5))]
    article = put(outer, tag, True, "main" if tag in ("div", "section") or rng.random() < 0.3 else "")
    if rng.random() < 0.25:
        article = put(article, ["div", "section", "article"][int(rng.integers(3))], True, "main" if rng.random() < 0.6 else "")
    if rng.random() < 0.1:
        root.children.append(some(5, 200))
    head = put(article, "header", True) if rng.random() < 0.15 else article
    put(head, "h1", True, "", some(2, 12))
    for _ in range(int(rng.integers(1, 5))):
        paragraphs(article, int(rng.integers(1, 5)), True)
        choice = rng.random()
        if choice < 0.2:
            ul = put(article, "ul", True)
            for _ in range(int(rng.integers(2, 6))):
                put(ul, "li", True, "", some(3, 30))
        elif choice < 0.35:
            put(article, "h2", True, "", some(1, 8))
        elif choice < 0.45:
            put(put(article, "blockquote", True), "p", True, "", some(5, 60))
        elif choice < 0.55:
            table = put(article, "table", True)
            for _ in range(3):
                row = put(table, "tr", True)
                put(row, "td", True, "", some(1, 5))
                put(row, "td", True, "", some(1, 8))
        elif choice < 0.8:
            boiler(article)
    for _ in range(int(rng.integers(1, 5))):
        boiler(root if rng.random() < 0.5 else outer)
    return root


def fit(pages: list[str]) -> boosted_trees.Trees | None:
    """A model from sample pages; None if they hold no text at all."""
    rng = np.random.default_rng(11)
    x, y = [], []
    for page in pages:
        root = parse(page)
        nodes = elements(root)
        labels = _weakly_labelled(nodes)
        if labels is None:
            for node in nodes:
                node.label = bool(node.children)
        else:
            x.append(features(nodes)[0])
            y.append(labels)
        for _ in range(VARIANTS):
            varied = elements(_varied(root, nodes, rng))
            x.append(features(varied)[0])
            y.append([bool(node.label) for node in varied])
    return boosted_trees.fit(np.concatenate(x), np.concatenate([np.array(v, float) for v in y])) if x else None


def sampled(pages: DataFrame, sample: int) -> DataFrame:
    """hash and html of up to sample pages, those with the smallest hashes of page_id and url.

    Hashes are ranked without their pages, and once each: copies of a page and empty pages take no place.
    """
    hashed = pages.where("html <> ''").select(F.xxhash64("page_id", "url").alias("hash"), "html")
    ranked = hashed.select("hash").distinct().withColumn("rank", F.row_number().over(Window.orderBy("hash")))
    chosen = F.broadcast(ranked.where(f"rank <= {sample}").select("hash"))
    return hashed.join(chosen, "hash", "left_semi").groupBy("hash").agg(F.min("html").alias("html"))


def main_text(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text and n_chars of every page; learns from a sample of the pages first."""
    rows = pages.select("page_id", "url", "html")
    fitted = pages.sparkSession.sparkContext.broadcast(fit([r["html"] for r in sampled(rows, sample).orderBy("hash").collect()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fitted.value
        for batch in W.slices(batches, "html"):
            texts = extract(batch.column("html").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
