"""Operator 2: main text of web pages by tag-path ratios.

Every text node has a root-to-leaf tag path (element names with their classes, which only tell paths apart).  For each path the text
length, the punctuation and the blocks of its nodes are added up; text of links doesn't count.  The totals are smoothed over the paths
of one container: each path takes the sums of all paths whose blocks lie in the same parent path, so that a heading or a short list
stands with the paragraphs beside it.  Text and punctuation, each weighed by the square of the number of blocks (content repeats its paths, an advert or
a notice doesn't), are fused by multiplication, and a path passes at a share of the largest fused ratio of the page, if it holds such a
share of its container itself.  The nodes of passing blocks are content.

What is too short for its path to pass is rescued by position: list items, table cells, quotations and the like whose
container also holds content (paragraphs and items that are links alone between content only), and headings that lead to
a kept block, and paragraphs beside content in an article or main element, which the HTML standard makes one composition.

Text in elements that are no content by the HTML and ARIA standards (navigation, headers, footers, asides, forms,
scripts, hidden elements, their roles) never counts; a header inside an article or main element is the article's own.
No word in a class or id decides anything.

Defined results: a null or empty page, and one with nothing but boilerplate, gives the empty text; a
page without tags is one block; unclosed and stray tags are repaired as browsers do for paragraphs,
list items, table cells and definition lists; repeated rows get equal texts; other columns pass through.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from changeloom.llm.common import read

# Fixed values of HTML: elements without content, with raw content, and those that make blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: An opening tag closes an open element of these kinds, up to the container that stops the search.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "thead": ("tr", "td", "th", "tbody"), "tfoot": ("tr", "td", "th", "tbody", "thead"),
}
STOPS = frozenset("ul ol menu dl table select datalist body html article section main nav aside".split())
P_ENDS = BLOCK - {"option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "head", "title", "legend"}
P_STOPS = frozenset("button td th caption object html body table article section main div".split())
BOILERPLATE = frozenset("nav header footer aside form script style noscript template svg iframe button select textarea head title dialog menu object canvas audio video map input label fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist note status".split())
#: A path passes at this share of the largest fused ratio of its page, and of the largest path of its container.
SHARE = 0.3
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Short blocks that are rescued beside content, those only between content, and what they may be nested in.
ITEMS = frozenset("li dt dd td th pre blockquote caption figcaption summary".split())
BETWEEN = frozenset("p address".split())
HOLDERS = frozenset("ul ol dl table tbody thead tfoot tr li dt dd td th blockquote figure details p pre caption figcaption summary address".split())

_markup = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_attribute = re.compile(r"(class|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_space = re.compile(r"\s+")
_punctuation = re.compile(r"[,.;:!?…、。，！？¿¡]")


class Node:
    """An element; inline ones share the ``block`` element that they stand in."""

    __slots__ = ("tag", "parent", "path", "boiler", "link", "own", "block", "above")

    def __init__(self, tag: str, name: str, parent: Node | None, boiler: bool, paths: dict):
        self.tag, self.parent = tag, parent
        self.path = paths.setdefault((parent.path if parent else -1, name), len(paths))  # a number for each distinct path
        self.own = self if tag in ("article", "main") else parent.own if parent else None  # the article that it stands in
        self.boiler = (boiler and not (tag == "header" and parent and parent.own)) or bool(parent and parent.boiler)
        self.link = tag == "a" or bool(parent and parent.link)
        self.block = self if tag in BLOCK or not parent else parent.block
        self.above = False  # whether content stands in it


def _named(tag: str, attributes: str) -> tuple[str, bool]:
    """Element name with classes for the path, and whether a standard makes it boilerplate."""
    boiler, classes = tag in BOILERPLATE, ""
    if attributes and attributes.strip():
        for m in _attribute.finditer(attributes):
            what, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if what == "role":
                boiler |= value.lower() in ROLES
            elif what == "hidden":
                boiler = True
            elif what == "aria-hidden":
                boiler |= value.lower() == "true"
            elif what == "style":
                boiler |= "display:none" in value.replace(" ", "").lower()
            else:
                classes = "." + ".".join(sorted(value.split()))
    return tag + classes, boiler


def parse(page: str) -> list[tuple[Node, int, str]]:
    """Text nodes as (element, block number, raw text) in page order."""
    paths: dict[tuple[int, str], int] = {}
    root = Node("#", "", None, False, paths)
    stack, out, block, at, n = [root], [], 0, 0, len(page)

    def text(end: int) -> None:
        if end > at:
            out.append((stack[-1], block, page[at:end]))

    def close(kinds, stops) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in kinds:
                del stack[i:]
                return
            if stack[i].tag in stops:
                return

    while at < n:
        m = _markup.search(page, at)
        if not m:
            text(n)
            break
        text(m.start())
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        block += tag in BLOCK
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in P_ENDS:
            close(("p",), P_STOPS)
        if tag in CLOSES:
            close(CLOSES[tag], STOPS)
        if tag == "br":
            out.append((stack[-1], block, " "))
        if tag in VOID:
            continue
        name, boiler = _named(tag, m[3])
        if m[3].endswith("/") and tag in ("svg", "path", "use"):
            continue
        stack.append(Node(tag, name, stack[-1], boiler, paths))
        if tag in RAW:
            end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            stack.pop()
    return out


def path_ratios(said: list[tuple[Node, int, str]]) -> dict[int, float]:
    """The fused ratio of each path, as a share of the largest of the page: text times punctuation of its container, each times the container's blocks squared.

    A path that holds little of its container's text and punctuation itself has none: it is not what the container is for.
    """
    own, whole, at = {}, {}, {}
    for node, block, s in said:
        path, within = node.block.path, (node.block.parent or node.block).path
        at[node.path] = path, within
        for sums in (own.setdefault(path, [0, 1, set()]), whole.setdefault(within, [0, 1, set()])):
            if not node.link:
                sums[0] += len(s)
                sums[1] += len(_punctuation.findall(s))
                sums[2].add(block)
    product = lambda sums, power: sums[0] * sums[1] * len(sums[2]) ** power
    top, most = max(product(x, 4) for x in whole.values()), {}
    for path, within in at.values():
        most[within] = max(most.get(within, 0), product(own[path], 0))
    return {leaf: product(whole[within], 4) / top if top and product(own[path], 0) >= SHARE * most[within] else 0.0 for leaf, (path, within) in at.items()}


def _container(element: Node) -> Node:
    """The element that holds a list, a table, a quotation or a block of text."""
    node = element.parent or element
    while node.parent and node.tag in HOLDERS:
        node = node.parent
    return node


def extract(page: str | None) -> str:
    """The main text of one page."""
    nodes = parse(page) if page else []
    seen = [(node, block, unescape(raw) if "&" in raw else raw) for node, block, raw in nodes]
    said = [(node, block, s) for node, block, raw in seen if not node.boiler and (s := raw.strip())]
    if not said:
        return ""
    fused = path_ratios(said)
    good = {path for path, x in fused.items() if x >= SHARE}
    good |= {node.block.path for node, *_ in said if node.path in good and not node.link}
    passed = [(node, block) for node, block, _ in said if not node.link and node.block.path in good]
    passed = passed or [(node, block) for node, block, _ in said]
    content = {block for _, block in passed}
    first, last = passed[0][1], passed[-1][1]
    articles = {node.own for node, _ in passed if node.own}
    for node, _ in passed:
        up = node.block.parent or node.block
        while up and not up.above:
            up.above, up = True, up.parent
    # the element, whether it is links alone, of each block in page order
    blocks: dict[int, list] = {}
    for node, block, _ in said:
        at = blocks.setdefault(block, [node.block, True])
        at[1] &= node.link
    kept = set(content)
    for block, (element, links) in blocks.items():
        inside = first < block < last
        near = inside or not links and element.own in articles
        if block not in kept and (element.tag in ITEMS and (inside or not links) or element.tag in BETWEEN and near) and _container(element).above:
            kept.add(block)
    following = False
    for block, (element, _) in reversed(blocks.items()):
        if element.tag not in HEADINGS:
            following = block in kept
        elif following and (element.tag == "h1" or _container(element).above):
            kept.add(block)
    counted = {block for _, block, _ in said}
    parts: dict[int, list[str]] = {}
    for node, block, raw in seen:
        if block in kept and block in counted and not node.boiler:
            parts.setdefault(block, []).append(raw)
    return "\n\n".join(s for texts in parts.values() if (s := _space.sub(" ", "".join(texts)).strip()))


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``text`` and ``n_chars`` to the other columns of ``pages`` (``html`` itself is dropped)."""
    kept = [c for c in pages.columns if c.lower() not in (html.lower(), "text", "n_chars")]
    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches):
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [*kept, "text", "n_chars"])

    return pages.select(*[f"`{c}`" for c in kept], html).mapInArrow(run, ", ".join(x for x in (fields, "text string, n_chars long") if x))


def op2_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
