"""Main text of web pages by composite text density.

Every node of a page has C characters of text, T tags, LC characters in links
and LT link tags below it. Its density is the characters per tag, adjusted by
how many of them stand in links:

    C / T * log_b(C * T / (LC * LT)),  b = ln(C / nonlink * LC + LC_body / C_body * C + e)

The text is that of the node whose children's densities have the largest sum,
among those at least as dense as the thinnest node on the path from the body
to the node of largest sum.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from mapledger.llm.batches import slices, texts

# --- fixed values: elements by their role in a page -------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
# never part of an article
DROPPED = frozenset(
    "head script style noscript template iframe object embed svg canvas nav header footer aside form button "
    "input select textarea menu dialog audio video map noembed noframes xmp title".split()
)
# a start tag that ends an open element of these, unless one of the others is in between
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
ENDS_PARAGRAPH = BLOCKS - {"br", "option", "body", "html", "legend", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
PARAGRAPH_SCOPE = {"table", "td", "th", "button", "body", "html", "caption", "object"}
# words of class, id and role that mark what isn't the article
UNWANTED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adslot banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar widget footer header masthead cookie cookies consent gdpr notice "
    "notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments commentlist disqus reply replies respond discussion reviews pagination pager toolbar "
    "skip copyright complementary contentinfo search".split()
)
COMMENT_WORDS = frozenset("ad ads advert advertisement sponsored promo related comment comments reply replies review reviews".split())
# parts of a slug that no amount of text speaks against
CERTAIN_PARTS = COMMENT_WORDS | frozenset("commentlist disqus respond cookie cookies consent gdpr".split())
# of a page's layout, not of what an element is: words before or behind the one they speak of
LAYOUT_PREFIXES = ("has-", "with-", "no-", "without-", "is-", "js-")
LAYOUT_BEFORE = frozenset("has with no without is".split())
LAYOUT_BEHIND = frozenset("enabled disabled open closed on off".split())
CONTROLS = frozenset("input select textarea button".split())
# ----------------------------------------------------------------------------

_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")
_HEADING = re.compile("h[1-6]")
_LABELLED = re.compile(r"(?:^|\s)for\s*=", re.I)


@dataclass(slots=True)
class Node:
    tag: str
    unwanted: bool = False
    doubtful: bool = False  # unwanted unless its text speaks for it
    by_share: bool = False  # in doubt, and wanted only if most of the text is in it
    children: list = field(default_factory=list)  # nodes and texts
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    density_sum: float = 0.0


def _named_parts(token: str, words: frozenset) -> list[str]:
    """Parts of a slug among the words, but for those that tell what a layout has: `post-with-comments`, `share-enabled`."""
    parts = token.split("-")
    if token.startswith(LAYOUT_PREFIXES):
        return []
    beside = zip(parts, ["", *parts], [*parts[1:], ""], strict=False)
    return [part for part, before, behind in beside if part in words and before not in LAYOUT_BEFORE and behind not in LAYOUT_BEHIND]


def _marked(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether attributes mark an element as no part of the article, and whether that is in doubt.

    A word that is a whole class, id or role is a sure mark, but for ids of
    sections and paragraphs, which are often made from their headings. A part
    of a slug is a weak mark, unless it speaks of comments or cookies. A
    heading is never marked by words.
    """
    if not attributes.strip() or tag in ("body", "main"):
        return False, False
    words, marks = COMMENT_WORDS if tag == "article" else UNWANTED_WORDS, []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, False
        if name == "style" and _HIDDEN.search(value):
            return True, False
        if name in ("class", "id", "role") and not _HEADING.fullmatch(tag):
            for token in value.replace("_", "-").split():
                whole, parts = token in words, _named_parts(token, words)
                if not whole and not parts:
                    continue
                if tag in ("section", "p"):
                    marks.append((name == "id" or not whole) and token.split("-")[-1] not in COMMENT_WORDS)
                else:
                    marks.append(not whole and CERTAIN_PARTS.isdisjoint(parts))
    return bool(marks), bool(marks) and all(marks)


def parse(page: str) -> Node:
    """The tree of a page: unclosed elements end where the next one of their kind, or their parent, does."""
    root = Node("html")
    stack, opened, at, size = [root], Counter(), 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        start = found.start() if found else size
        if start > at:
            stack[-1].children.append(html.unescape(page[at:start]))
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            for depth in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[depth].tag == tag:
                    _close(stack, opened, depth)
                    break
                # an inline end tag never closes a block around it
                if stack[depth].tag in BLOCKS and tag not in BLOCKS:
                    break
            continue
        if tag == "html":
            continue
        _close_implied(stack, opened, tag)
        marked, doubtful = _marked(tag, found[3])
        node = Node(tag, tag in DROPPED or marked, doubtful and tag not in DROPPED or tag == "form" and not marked)
        node.by_share = node.doubtful and tag not in ("section", "p", "form")
        if tag == "label" and _LABELLED.search(found[3]):
            node.unwanted, node.doubtful = True, False
        if tag in CONTROLS and (opened["fieldset"] or opened["label"]):  # what groups or names controls is part of a form
            for outer in stack:
                if outer.tag in ("fieldset", "label"):
                    outer.unwanted, outer.doubtful = True, False
        (_parent_of(tag, stack) if opened["header"] else stack[-1]).children.append(node)
        if tag in ("article", "main") and not node.unwanted:
            for outer in stack:  # what holds the article isn't ruled out by its class
                outer.unwanted = outer.tag in DROPPED and outer.tag != "form"
        if tag in VOID or found[3].rstrip().endswith("/") and tag not in BLOCKS and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*/?>|</{re.escape(tag)}[\s/]", re.I).search(page, at)
            at = end.end() if end else size
            continue
        stack.append(node)
        opened[tag] += 1
    return root


def _close(stack: list[Node], opened: Counter, depth: int) -> None:
    """End the open elements from a depth on; `opened` tells how many of a tag are open, so none is looked for in vain."""
    for node in stack[depth:]:
        opened[node.tag] -= 1
    del stack[depth:]


def _parent_of(tag: str, stack: list[Node]) -> Node:
    """Where an element belongs: the headings of an article's header are the article's own."""
    if _HEADING.fullmatch(tag):
        for depth in range(len(stack) - 1, 1, -1):
            if stack[depth].tag == "header":
                return stack[depth - 1] if any(outer.tag == "article" for outer in stack[:depth]) else stack[-1]
            if stack[depth].unwanted:
                break
    return stack[-1]


def _close_implied(stack: list[Node], opened: Counter, tag: str) -> None:
    if tag in IMPLIED_END:
        ends, scope = IMPLIED_END[tag]
        for depth in range(len(stack) - 1, 0, -1) if any(opened[end] for end in ends) else ():
            if stack[depth].tag in scope:
                break
            if stack[depth].tag in ends:
                _close(stack, opened, depth)
                if tag != "tr":
                    break
    if tag in ENDS_PARAGRAPH and opened["p"]:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in PARAGRAPH_SCOPE:
                break
            if stack[depth].tag == "p":
                _close(stack, opened, depth)
                break


def _wanted(node: Node) -> list:
    return [child for child in node.children if isinstance(child, str) or not child.unwanted]


def _in_post_order(root: Node) -> list[tuple[Node, bool]]:
    """Wanted nodes, children before parents, and whether each stands in a link; no recursion, so any depth goes."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        linked = linked or node.tag == "a"
        order.append((node, linked))
        stack.extend((child, linked) for child in _wanted(node) if isinstance(child, Node))
    return order[::-1]


def measure(root: Node, body: Node) -> None:
    """Counts, densities and density sums of all wanted nodes below the root."""
    order = _in_post_order(root)
    for node, linked in order:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for child in _wanted(node):
            if isinstance(child, str):
                n = len(_SPACE.sub(" ", child).strip())
                node.chars += n
                node.link_chars += n * linked
            else:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
    ratio = body.link_chars / body.chars if body.chars else 0.0
    for node, _ in order:
        c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        if not c:
            node.density = 0.0
            continue
        base = math.log(c / max(1, c - node.link_chars) * node.link_chars + ratio * c + math.e)
        adjusted = math.log(c / lc * t / lt) / math.log(base) if base > 1.0000001 else math.log(c / lc * t / lt)
        node.density = c / t * max(0.0, adjusted)
    for node, _ in order:
        node.density_sum = sum(child.density for child in _wanted(node) if isinstance(child, Node))


def select(root: Node) -> Node | None:
    """The node of largest density sum, widened along its path to the body as far as the threshold allows.

    The threshold is the smallest density on the path from the body to that
    node. A path node is taken instead if the article's other parts lie in
    it: siblings of the chosen node that are as dense, and not behind links.
    """
    body = next((c for c in root.children if isinstance(c, Node) and c.tag == "body"), root)
    measure(root, body)
    if not body.chars:
        return None
    best, parents, stack = body, {}, [body]
    while stack:
        node = stack.pop()
        if node.density_sum > best.density_sum:
            best = node
        for child in _wanted(node):
            if isinstance(child, Node) and child.density_sum > 0:
                parents[id(child)] = node
                stack.append(child)
    path = [best]
    while path[-1] is not body:
        path.append(parents[id(path[-1])])
    path.reverse()
    threshold = min(node.density for node in path)
    # a single block of text has no children to add up
    while best.density_sum == 0:
        inner = [c for c in _wanted(best) if isinstance(c, Node) and c.tag in BLOCKS and 2 * c.chars > best.chars]
        if not inner:
            break
        best = inner[0]
        path.append(best)
    # out to the element that is the article by its tag
    for node in reversed(path):
        if node.tag in ("article", "main") and node.density >= threshold:
            return node
    for outer, inner in zip(path[-2::-1], path[:0:-1], strict=True):
        others = [c for c in _wanted(outer) if isinstance(c, Node) and c is not inner and c.chars]
        dense = [c for c in others if c.density >= max(threshold, 0.25 * inner.density) and 2 * c.link_chars < c.chars]
        heads = [c for c in others if re.fullmatch("h[1-6]", c.tag)]
        if inner is best and (dense or heads) and outer.tag not in ("html",):
            best = outer
        else:
            break
    return best


def blocks(node: Node) -> list[str]:
    """Texts of the blocks of a subtree in page order, each with single spaces."""
    found, current = [], []

    def end() -> None:
        line = _SPACE.sub(" ", "".join(current)).strip(" ")
        current.clear()
        if line:
            found.append(line)

    stack: list = [node]
    while stack:
        item = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            current.append(item)
        else:
            if item.tag in BLOCKS:
                end()
                stack.append(None)
            stack.extend(reversed(_wanted(item)))
    end()
    return found


def _possible(root: Node) -> list[Node]:
    """Nodes of a subtree in page order that are wanted or in doubt."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and (c.doubtful or not c.unwanted))
    return found


def _prose(nodes: list[Node]) -> tuple[dict[int, int], dict[int, int]]:
    """Characters outside of links below each of the nodes (parents first): in what is wanted, and with what is in doubt."""
    firm, total, linked = {}, {}, set()
    for node in nodes:
        if node.tag == "a" or id(node) in linked:
            linked.update(id(c) for c in node.children if isinstance(c, Node))
            linked.add(id(node))
    for node in reversed(nodes):
        own = 0 if id(node) in linked else sum(len(_SPACE.sub(" ", c).strip()) for c in node.children if isinstance(c, str))
        inner = [c for c in node.children if isinstance(c, Node) and id(c) in total]
        firm[id(node)] = own + sum(firm[id(c)] for c in inner if not c.unwanted)
        total[id(node)] = own + sum(total[id(c)] for c in inner if not c.unwanted or c.by_share)
    return firm, total


def _keep_by_share(root: Node) -> None:
    """Want those elements marked by a part of a slug that hold more prose than all that is certain around them.

    Looked at from the outside in, once for each node: in the articles by their
    tag if a page has any, else in the whole page. Of several such elements
    those stay that hold at least half of the prose of the largest.
    """
    nodes = _possible(root)
    if not any(node.by_share and node.unwanted for node in nodes):
        return
    firm, total = _prose(nodes)
    within = [n for n in nodes if n.tag in ("article", "main") and not n.unwanted] or [root]
    seen: set[int] = set()
    while within:
        around = within.pop()
        found, stack = [], [around]
        while stack:
            node = stack.pop()
            if id(node) in seen:
                continue
            seen.add(id(node))
            for child in node.children:
                if isinstance(child, Node) and child.by_share and child.unwanted:
                    found.append(child)
                elif isinstance(child, Node) and not child.unwanted:
                    stack.append(child)
        most = max((total[id(n)] for n in found), default=0)
        for node in found:
            if total[id(node)] > firm[id(around)] and 2 * total[id(node)] >= most:
                node.unwanted = False
                within.append(node)


def choose(root: Node) -> Node | None:
    """The article, with the parts of it whose marks are in doubt and whose text isn't mostly links.

    Elements other than sections and paragraphs whose class or id holds a
    doubtful part are wanted if most of the prose is in them. A form that holds most of a page's text is kept if the page has no article
    by its tag. If nothing is left of a page, what is in doubt is looked at.
    """
    nodes = _possible(root)
    forms = [n for n in nodes if n.tag == "form" and n.unwanted]
    if forms and not any(n.tag in ("article", "main") and not n.unwanted for n in nodes):
        for form in forms:
            form.unwanted = False
        measure(root, root)
        for form in forms:
            form.unwanted = 2 * form.chars <= root.chars
    _keep_by_share(root)
    chosen = select(root)
    if chosen is None:
        for node in nodes:
            if node.tag != "form" and node.doubtful:
                node.unwanted = False
        return select(root)
    doubtful = [n for n in _possible(chosen) if n.doubtful and n.unwanted and not n.by_share and n.tag != "form"]
    for node in doubtful:
        node.unwanted = False
    if doubtful:
        measure(chosen, chosen)
    for node in doubtful:
        node.unwanted = 2 * node.link_chars >= node.chars
    return chosen


def main_text(page: str) -> str:
    """The article of a page, one line for each block; empty if there is none."""
    chosen = choose(parse(page))
    return "\n".join(blocks(chosen)) if chosen else ""


def extract_pages(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty page, or one without text, has an empty text. Whole pages
    are read, of any size and depth. Repeated rows are treated alike, an empty
    table gives no rows, further columns are ignored.
    """
    kept = [f"`{name}` {pages.schema[name].dataType.simpleString()}" for name in ("page_id", "url")]

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html_column):
            found = [main_text(page) for page in texts(batch, html_column)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", html_column).mapInArrow(extracted, ", ".join([*kept, "text STRING", "n_chars BIGINT"]))
