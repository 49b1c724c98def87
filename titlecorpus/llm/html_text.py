"""Main text of HTML pages by composite text density.

Every DOM node gets its characters per tag, adjusted for links: with C
characters and T tags below it, LC of the characters and LT of the tags in
links,

    density = C / T * log_b(C / LC * T / LT),  b = ln(C / (C - LC) * LC + LC_body / C_body * C + e)

(a zero divisor counts as 1). The node with the largest sum of its children's
densities is the core of the text. The least density on the path from it to the
body is the threshold: the subtree grows to a parent that has another child as
dense as that, or a heading, and to the article or main element around it.
Menus, page headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments are no part of the tree (by element, role or class).
A class or id counts if all words of one of its names say so, on blocks but
headings. Names that an article's own parts bear too (a discussion, a notice)
count only if the block is less dense than the page or at least half links.
Lists of links go unless they lie in the core, an article or a main element.

Text: character references decoded, white space inside a block turned into one
space, blocks trimmed and joined in page order by a line feed.

Defined results: a NULL or empty page, or one without text, gives an empty
text. Tags may be unclosed, misnested or cut off at the end: a tag cut off is
dropped, an unclosed script or style runs to the end. Repeated pages give
repeated rows.
"""

from __future__ import annotations

import html
import re
from math import e, log

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.llm.common import steps, table

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
CUT_OFF = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
#: Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template iframe object svg annotation annotation-xml canvas head title audio video noembed noframes".split())
RAW = frozenset("script style noscript template iframe title noembed noframes textarea xmp".split())
FURNITURE = frozenset("nav footer aside form button select textarea input dialog menu datalist label".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
                   "time tt u var wbr math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mtable mtr mtd mstyle mspace "
                   "mpadded mphantom merror menclose mfenced mmultiscripts mprescripts semantics".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hgroup hr main menu nav ol p pre search section summary table ul".split())
#: Elements that end at the next one of the set, up to the container named.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
SCOPE = frozenset("html body table td th button caption object template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: Words that a class or id of a part outside the text holds.
PARTS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login paywall nav navbar navigation menu submenu topbar "
    "toolbar breadcrumb breadcrumbs pagination pager sidebar sidebars rail widget widgets related recommended recommendations trending footer masthead "
    "share sharing social comment comments commentlist discussion disqus respond replies reply feedback".split())
#: Those that parts of an article bear as well, and words that only say where or what shape a part is.
DOUBTFUL = frozenset("notice notices alert related recommended recommendations social share sharing sponsor sponsored promotion discussion respond replies reply "
                     "feedback overlay rail widget widgets subscription navigation masthead consent".split())
SHAPES = frozenset("left right top bottom main box bar block list item items area section container wrapper wrap inner outer links link buttons button text "
                   "content header site page global primary secondary posts form panel unit slot".split())
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


class Node:
    __slots__ = ("tag", "parent", "items", "chars", "tags", "link_chars", "link_tags", "density", "sum", "doubtful")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.items = tag, parent, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        self.doubtful = False


def outside(tag: str, attributes: str, inside: bool) -> bool | None:
    """Whether an element is no part of a text, None if its density has to tell; ``inside`` an article or main element a header may hold the title."""
    if tag in FURNITURE or tag in HIDDEN or tag == "header" and not inside:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    found: bool | None = False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id") and tag not in INLINE and tag not in HEADINGS:
            for one in value.split():
                words = [w.lower() for w in WORDS.findall(one)]
                known = [w for w in words if w in PARTS]
                # Inside an article only a name that is one known word and no more.
                if known and all(w in PARTS or w in SHAPES and not inside for w in words):
                    if not all(w in DOUBTFUL for w in known):
                        return True
                    found = None
    return found


def tree(page: str) -> Node:
    """DOM of the parts that may be text. Ends of elements are inferred as browsers do; stray end tags are ignored."""
    root = node = Node("html", None)
    skip: Node | None = None  # the outermost element that is no part of the text
    at = within = 0

    def close(target: Node) -> None:
        nonlocal node, skip, within
        while True:
            done, node = node, node.parent
            if done is skip:
                skip = None
            within -= done.tag in ("article", "main")
            if done is target:
                return

    def find(names, stop) -> Node | None:
        n = node
        while n.parent is not None and n.tag not in names:
            if n.tag in stop:
                return None
            n = n.parent
        return n if n.parent is not None else None

    while at < len(page):
        m = TOKEN.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if m is None:
            text = CUT_OFF.sub("", text)
        if text and skip is None:
            node.items.append(html.unescape(text) if "&" in text else text)
        if m is None:
            break
        at = m.end()
        if end := m[1]:
            end = end.lower()
            # An inline end tag does not close the block around it.
            target = find((end,), CLOSES_P | SCOPE if end in INLINE else SCOPE - {end})
            if target is not None:
                close(target)
            elif end == "br":
                node.items.append(" ")
            continue
        tag = (m[2] or m[4] or "").lower()
        if not tag:
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P and (p := find(("p",), SCOPE)) is not None:
            close(p)
        if tag in ENDS and (last := find(ENDS[tag][0], ENDS[tag][1])) is not None:
            close(last)
        attributes = m[3] or m[5] or ""
        if tag in VOID:
            if skip is None:
                node.items.append(" " if tag == "br" else Node(tag, node))
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        child = Node(tag, node)
        if skip is None:
            apart = outside(tag, attributes, within > 0)
            if apart:
                skip = child
            else:
                child.doubtful = apart is None
                node.items.append(child)
        within += tag in ("article", "main")
        node = child
    return root


def measure(root: Node) -> list[Node]:
    """Counts, densities and sums of all nodes, in page order (parents first)."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack.extend(c for c in reversed(n.items) if isinstance(c, Node))
    for n in order:
        n.chars = n.tags = n.link_chars = n.link_tags = 0
        n.density = n.sum = 0.0
    for n in reversed(order):
        n.chars += sum(len(x) - x.count(" ") - x.count("\n") for x in n.items if isinstance(x, str))
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.tags + 1
        if (p := n.parent) is not None:
            p.chars, p.tags = p.chars + n.chars, p.tags + n.tags + 1
            p.link_chars, p.link_tags = p.link_chars + n.link_chars, p.link_tags + n.link_tags
    share = root.link_chars / (root.chars or 1)
    for n in order:
        c, t, lc, lt = n.chars, n.tags or 1, n.link_chars, n.link_tags or 1
        if c:
            base = log(c / ((c - lc) or 1) * lc + share * c + e)
            n.density = c / t * log(max(c / (lc or 1) * t / lt, 1.0)) / log(max(base, 1.0000001)) if base > 1.0000001 else c / t * log(max(c / (lc or 1) * t / lt, 1.0))
        if n.parent is not None:
            n.parent.sum += n.density
    return order


def content(root: Node) -> tuple[Node, Node]:
    """The subtree that holds the text, and its core."""
    order = measure(root)
    apart = [n for n in order if n.doubtful and (n.density < root.density or n.link_chars and 2 * n.link_chars >= n.chars)]
    if apart:
        for n in apart:
            n.parent.items = [x for x in n.parent.items if x is not n]
        order = measure(root)
    core = max(order, key=lambda n: n.sum)
    if core.sum == 0:
        return root, root
    threshold, n = core.density, core
    while n.parent is not None:
        threshold, n = min(threshold, n.density), n.parent
    best, n = core, core
    while n.parent is not None:
        parent = n.parent
        others = [c for c in parent.items if isinstance(c, Node) and c is not n and c.chars]
        loose = any(isinstance(x, str) and x.strip() for x in parent.items)
        if parent.tag in ("article", "main") or loose or any(c.density >= threshold or c.tag in HEADINGS or c.tag == "p" for c in others):
            best = parent
        n = parent
    return best, core


def blocks(node: Node, core: Node) -> list[str]:
    """Texts of the blocks below ``node`` in page order."""

    def kept(n: Node) -> bool:
        while n.parent is not None:
            if n is core or n.tag in ("article", "main"):
                return True
            n = n.parent
        return False
    out, line, stack = [], [], [iter([node])]

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    closing: list[bool] = [False]
    while stack:
        item = next(stack[-1], None)
        if item is None:
            stack.pop()
            if closing.pop():
                flush()
        elif isinstance(item, str):
            line.append(item)
        else:
            block = item.tag not in INLINE
            if block:
                flush()
            if not (block and item.tag not in HEADINGS and item.tag != "p" and item.link_tags > 2 and item.link_chars >= 0.9 * item.chars and not kept(item)):
                stack.append(iter(item.items))
                closing.append(block)
    flush()
    return out


def main_text(page: str | None) -> str:
    return "\n".join(blocks(*content(tree(page)))) if page else ""


def extract_text(df: DataFrame, page: str = "html", to: str = "text", length: str = "n_chars") -> DataFrame:
    """``df`` with the main text of ``page`` in ``to`` and its code points in ``length``, in place of the page."""
    names = [c for c in df.columns if c not in (page, to, length)]

    def rows(batches):
        import pyarrow as pa

        for b in steps(batches, page):
            texts = [main_text(p) for p in b.column(page).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, to, length])

    fields = [f"`{c}` {t}" for c, t in df.dtypes if c in names]
    return df.select(*names, page).mapInArrow(rows, ", ".join([*fields, f"`{to}` string", f"`{length}` long"]))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
