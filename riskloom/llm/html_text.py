"""Main text of web pages by composite text density.

A page becomes a tree. Scripts, styles, forms, hidden nodes and elements that are furniture by their kind or
role are taken out. A class or id that names furniture (``MARKS``) is only a hint: it takes a node out if the node's own
links and size agree, and never one that holds the core or most of the body's text. Every node then has its characters C and tags T below it, and of these
those inside links, LC and LT. Its density is the characters per tag, adjusted for links::

    C / T * log(C * T / (LC * LT)) / log(log(C * LC / (C - LC) + C * LCb / Cb + e))

with LCb and Cb of the body: link lists score low, and lower still on pages with few links. The
density sum of a node adds the densities of its children. The node with the largest sum is the core
of the article; the smallest density on the way from it to the body is the threshold. From the body
down, every node not below the threshold contributes the node with the largest density sum in its subtree. A
core inside an ``article`` or ``main`` element stands for the whole element, so that short headings are kept.

Text: character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined in page order by one space. A line break ends a block.

Pages are independent: one narrow pass without shuffle, page by page; a very long page is one task's
work only for its own length (parsing is linear). Defined results: null, empty or tag-only html gives
an empty text; text without any tag is its own article; repeated rows and null ids stay rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import over_slices, quoted

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Start tags that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: An open element of the key is ended by a start tag of the value, up to the nearest of ``SCOPES``.
SIBLINGS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("html body table td th ul ol dl article aside section main nav div".split())

#: Elements that are never part of an article.
FURNITURE = frozenset(
    "head nav aside footer form button select input dialog menu noscript template svg canvas object audio video map "
    "script style textarea title xmp iframe noembed noframes".split()
)
#: Words in a class or id that name page furniture.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments "
    "commentlist consent cookie cookies disclaimer disqus feedback footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification pager pagination paywall popup promo promoted promotion recommended "
    "related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser "
    "toolbar tracking widget".split()
)
#: Of these, those that also count on an ``article`` element and as ids of sections of an article, where others are slugs.
ARTICLE_MARKS = frozenset("ad ads advert advertisement comment comments promo related reply replies sponsored teaser".split())

#: Characters below which a node outside paragraphs is a label, such as "Share this".
LABEL = 30

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>"']|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<close2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)""",
    re.DOTALL,
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MARKING = re.compile(r"""(?:^|[\s/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORDS = re.compile(r"[^a-z0-9]+")


class Node:
    __slots__ = ("name", "parent", "children", "drop", "mark", "inside", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, parent: Node | None) -> None:
        self.name, self.parent = name, parent
        self.children: list[Node | str] = []
        self.drop = False
        #: What class and id say: 0 nothing, 1 a word of furniture beside others (``has-sidebar``), 2 nothing but such words.
        self.mark = 0
        #: Whether this is, or lies in, an article.
        self.inside = name in ("article", "main") or (parent is not None and parent.inside)


def named(name: str, rest: str, parent: Node) -> tuple[bool, int]:
    """Whether an element is furniture by its kind, role or being hidden, and its mark."""
    if name in FURNITURE or (name == "header" and not parent.inside):
        return True, 0
    if not rest or name in ("html", "body", "main"):
        return False, 0
    mark = 0
    for key, value in MARKING.findall(rest):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            if key == "id" and name in HEADINGS:
                continue
            slug = key == "id" and name == "section" and parent.inside
            known = ARTICLE_MARKS if name == "article" or slug else MARKS
            for token in value.split():
                words = [w for w in WORDS.split(token) if w]
                count = sum(w in known for w in words)
                if count:
                    mark = max(mark, 2 if count == len(words) else 1)
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True, 0
        elif key == "role" and value in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"):
            return True, 0
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return True, 0
    return False, mark


def parse(page: str) -> Node:
    """The page's tree. Unclosed and misplaced tags are mended the way browsers do for common cases."""
    root = Node("html", None)
    here = root
    at, size = 0, len(page)
    opened: Counter[str] = Counter()  # open elements by name: no search for what is not there

    def left(node: Node | None) -> Node:
        """Close everything up to and with ``node``; the element that is open then."""
        nonlocal here
        while here is not node:
            opened[here.name] -= 1
            here = here.parent
        opened[here.name] -= 1
        return here.parent or root

    while at < size:
        found = TAG.search(page, at)
        start = found.start() if found else size
        if start > at:
            here.children.append(html.unescape(page[at:start]))
        if not found:
            break
        at = found.end()
        name = found["name"] or found["name2"]
        if name is None:
            continue
        name = name.lower()
        if found["close"] or found["close2"]:
            node: Node | None = here if opened[name] else None
            while node is not None and node.name != name:
                node = node.parent
            if node is not None and node.parent is not None:
                here = left(node)
            continue
        rest = found["rest"] or found["rest2"] or ""
        if name in ("html", "body") and here.parent is None:
            if name == "html":
                continue
        elif name == "body":
            continue
        if name in ENDS_P and opened["p"]:
            node = here
            while node is not None and node.name not in ("p", "td", "th", "li", "button", "article", "body", "html"):
                node = node.parent
            if node is not None and node.name == "p":
                here = left(node)
        elif name in ("li", "dt", "dd", "tr", "td", "th", "option", "tbody", "thead", "tfoot"):
            node = here
            while node is not None:
                if name in SIBLINGS.get(node.name, ()):
                    here = left(node)
                    node = here
                    continue
                if node.name in SCOPES and not (name == "tr" and node.name in ("td", "th")):
                    break
                node = node.parent
        if here.name == "head" and name in BLOCK:
            here = left(here)
        new = Node(name, here)
        new.drop, new.mark = named(name, rest, here)
        here.children.append(new)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else size
            if end:
                close = page.find(">", at)
                at = size if close < 0 else close + 1
        elif name not in VOID and (name in BLOCK or not rest.endswith("/")):
            here = new
            opened[name] += 1
    return root


def in_order(root: Node) -> list[Node]:
    """All kept nodes, parents first; no recursion, pages can be nested deeply."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.drop)
    return out


def measure(nodes: list[Node], body: Node) -> None:
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len("".join(child.split()))
            elif not child.drop:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.name == "a")
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, max(node.link_tags, node.tags)
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if not c:
            node.density = 0.0
            continue
        base = math.log(c * node.link_chars / max(c - node.link_chars, 1) + c * share + math.e)
        # The logarithm's base is at least e's, so that the adjustment never changes sign.
        adjust = max(math.log(max(c * t / (lc * lt), 1.0)), 0.0) / max(math.log(base + math.e - 1), 1.0)
        node.density = c / t * adjust
    for node in nodes:
        node.total = sum(c.density for c in node.children if isinstance(c, Node) and not c.drop)


def settle_marks(nodes: list[Node], body: Node) -> bool:
    """Take out the marked ones of the measured ``nodes`` that are furniture by their own links and size too;
    whether there are any. Where an article holds a tenth of the text or more, the core is looked for in articles, and
    a marked node beside them may be longer than a short article."""
    articles = any(n.name in ("article", "main") and not n.mark and n.chars * 10 >= body.chars for n in nodes)
    holders, node = set(), max((n for n in nodes if n.inside or not articles), key=lambda n: n.total)
    while node is not None:
        holders.add(id(node))
        node = node.parent
    prose: set[int] = set()  # paragraphs, headings and what is in them
    any_out = False
    for node in nodes:
        if node.name == "p" or node.name in HEADINGS or id(node.parent) in prose:
            prose.add(id(node))
        if not node.mark or id(node) in holders:
            continue
        if node.chars * 10 > body.chars * (9 if articles and not node.inside else 5):
            continue
        linked = node.link_chars * 2 >= node.chars
        if node.mark == 2 or (id(node) not in prose and (linked or node.chars < LABEL)):
            node.drop = any_out = True
    return any_out


def content_nodes(root: Node) -> list[Node]:
    """The subtrees that make up the article, in page order."""
    nodes = in_order(root)
    body = next((n for n in nodes if n.name == "body"), root)
    nodes = in_order(body)
    measure(nodes, body)
    if any(n.mark for n in nodes) and settle_marks(nodes, body):
        nodes = in_order(body)
        measure(nodes, body)
    if not body.chars:
        return []
    # The node with the largest density sum of each subtree; the outer one on ties.
    best: dict[int, Node] = {}
    for node in reversed(nodes):
        top = node
        for child in node.children:
            if isinstance(child, Node) and not child.drop and best[id(child)].total > top.total:
                top = best[id(child)]
        best[id(node)] = top
    core = best[id(body)]
    threshold, node = core.density, core
    while node is not body:
        node = node.parent
        threshold = min(threshold, node.density)

    # Going down, so that no node looks back over its ancestors: the nearest article around each.
    around: dict[int, Node | None] = {}
    for node in nodes:
        if node is body:
            around[id(node)] = None
        else:
            around[id(node)] = node if node.name in ("article", "main") else around[id(node.parent)]

    def whole(node: Node) -> Node:
        return around[id(node)] or node

    chosen = {id(whole(core))}
    for node in nodes:
        if node.density >= threshold and node.density > 0 and node is not body:
            chosen.add(id(whole(best[id(node)] if best[id(node)].total > 0 else node)))
    out: list[Node] = []
    covered: set[int] = set()
    for node in nodes:
        if node is not body and id(node.parent) in covered:
            covered.add(id(node))
        elif id(node) in chosen:
            covered.add(id(node))
            out.append(node)
    return out


def text_of(nodes: list[Node]) -> str:
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        if line:
            text = " ".join("".join(line).split())
            if text:
                blocks.append(text)
            line.clear()

    for top in nodes:
        end()
        stack: list[Node | str | None] = [top]
        while stack:
            item = stack.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                line.append(item)
            elif not item.drop:
                if item.name in BLOCK:
                    end()
                    stack.append(None)
                stack.extend(reversed(item.children))
    end()
    return " ".join(blocks)


def main_text(page: str | None) -> str:
    return text_of(content_nodes(parse(page))) if page else ""


def extract(df: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns of every page, its main ``text`` and ``n_chars``."""
    # Inner names cannot clash with the caller's columns.
    names = [f"kept_{i}" for i in range(len(keep))]
    rows = df.select(*[quoted(c).alias(n) for c, n in zip(keep, names)], quoted(html_col).cast("string").alias("html"))
    kinds = dict(rows.dtypes)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            [*names, "text", "n_chars"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return over_slices(batches, work)

    out = rows.mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n in names) + ", text string, n_chars long")
    return out.toDF(*keep, "text", "n_chars")
