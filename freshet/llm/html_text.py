"""Main text of web pages by composite text density.

Every DOM node gets a density: its characters per tag, adjusted by how many of both are
links. A node's density sum adds those of its children. The threshold is the least density on
the path from the node with the greatest sum up to the body. All articles with more text than
links are the main text; without one all subtrees that reach the threshold, and headings and
paragraphs right below the body. Menus, forms, comments and the like, told by tag, role and
class names, are taken out of the tree first, but not what holds the article or most of the
text; and names that speak of short or linked parts only count where the density agrees.

All steps take time in proportion to the page, however deep or broken it is.
"""

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of HTML, and words that page authors use for parts beside the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe object svg math canvas audio video textarea title noembed noframes".split())
ASIDE_TAGS = frozenset("nav aside footer form button select option fieldset dialog menu".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert alerts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo "
    "promotion related replies respond response responses share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Names of parts that have few words or many links; text that is as dense as the article is none of these.
SPARSE_WORDS = frozenset("breadcrumb breadcrumbs header login masthead menu modal nav navbar navigation overlay pager pagination signup social toolbar widget".split())
#: Names that may also say what a page's frame has beside the article, as in "with-sidebar".
FRAME_WORDS = frozenset("ad ads banner footer header menu nav navbar sidebar".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Below the body these belong to the text beside them, however short they are.
TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
CONTAINERS = frozenset("div section table center".split())
# A start tag of the first kind ends open elements of the second, up to one of the third.
CLOSED_BY = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select"),
}
CLOSES_PARAGRAPH = BLOCKS - frozenset("body html td th tr tbody thead tfoot".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG_PART = re.compile(r"[>\"']")
#: Start tags of a page whose quotes hide their end up to the page's; from then on quotes hide nothing.
_OPEN_QUOTES = 3
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


@dataclass(slots=True)
class Node:
    """An element with its children, nodes or strings, and what is counted below it."""

    tag: str
    children: list = field(default_factory=list)
    aside: bool = False
    framing: bool = False  # an aside by a word of FRAME_WORDS only
    loose: bool = False  # an aside that is a form, or by a word that is one of several in its name
    sparse: bool = False  # an aside by words of SPARSE_WORDS only
    unseen: bool = False
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    density_sum: float = 0.0


def _named_words(attributes: str) -> set[str]:
    """Words of an element's class and id names that speak of a part beside the article."""
    words = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            words.update(w.lower() for w in _WORD.findall("".join(values)))
    return words & ASIDE_WORDS


def _names(attributes: str) -> set[str]:
    """An element's class and id names, each as a whole."""
    found = _ATTRIBUTE.findall(attributes)
    return {part for name, *values in found if name.lower() in ("class", "id") for part in "".join(values).lower().split()}


def _make_node(tag: str, attributes: str, inside_article: bool) -> Node:
    if tag == "form":
        return Node(tag, aside=True, loose=True)
    if tag in ASIDE_TAGS or (tag == "header" and not inside_article):
        return Node(tag, aside=True)
    if not attributes or tag in ("html", "body", "main", "h1"):
        return Node(tag)
    roles = {"".join(v).lower() for name, *v in _ATTRIBUTE.findall(attributes) if name.lower() == "role"}
    hidden = "hidden" in attributes.lower().split()
    if roles & ASIDE_ROLES or hidden:
        return Node(tag, aside=True, unseen=hidden)
    words = _named_words(attributes)
    if inside_article:
        words.discard("header")
    loose = bool(words) and not words & _names(attributes)
    some = bool(words)
    return Node(tag, aside=some, framing=some and words <= FRAME_WORDS, loose=loose, sparse=some and words <= SPARSE_WORDS)


class _Scanner:
    """Text and tags of a page, one after the other; every character is looked at a few times at most."""

    def __init__(self, html: str):
        self.html, self.at = html, 0
        self.last_end = html.rfind(">")
        self.open_quotes = 0

    def _tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends a start tag, past quoted values; -1 if there is none."""
        html, start = self.html, at
        while at <= self.last_end:
            part = _TAG_PART.search(html, at)
            if part is None:
                break
            if part[0] == ">":
                return part.start()
            closing = html.find(part[0], part.end()) if self.open_quotes < _OPEN_QUOTES else -1
            at = closing + 1 if closing >= 0 else part.end()
        else:
            if start <= self.last_end:
                self.open_quotes += 1
                return html.find(">", start)
        return -1

    def tokens(self) -> Iterator[tuple[str, str, str]]:
        """``text``, ``start`` with its attributes, or ``end``. ``raw`` may be called after a start tag."""
        html, size = self.html, len(self.html)
        text = 0  # where text not yet given begins
        look = 0
        while (at := html.find("<", look)) >= 0:
            following = html[at + 1 : at + 2]
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                token, after = None, size if end < 0 else end + 3
            elif name := _NAME.match(html, at + 1):
                end = self._tag_end(name.end())
                if end < 0:
                    look = at + 1  # text
                    continue
                token, after = ("start", name[0].lower(), html[name.end() : end]), end + 1
            elif following == "/" and (name := _NAME.match(html, at + 2)) and self.last_end >= name.end():
                token, after = ("end", name[0].lower(), ""), html.find(">", name.end()) + 1
            elif following and following in "!?/":
                end = html.find(">", at)
                token, after = None, size if end < 0 else end + 1
            else:
                look = at + 1  # a lone "<" is text
                continue
            if text < at:
                yield "text", html[text:at], ""
            self.at = after
            if token:
                yield token
            text = look = self.at
        if text < size:
            yield "text", html[text:], ""

    def raw(self, tag: str) -> str:
        """All up to the end tag, whatever it looks like."""
        final = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(self.html, self.at)
        content = self.html[self.at : final.start() if final else len(self.html)]
        self.at = final.end() if final else len(self.html)
        return content


class _Open:
    """The open elements, with the places of each tag among them."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.framing: list[int] = []  # open asides that an article would unmark

    def push(self, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag in BLOCKS:
            self.blocks.append(at)
        if node.aside and node.framing:
            self.framing.append(at)

    def close(self, until: int) -> None:
        while len(self.nodes) > until:
            tag = self.nodes.pop().tag
            self.places[tag].pop()
        for places in (self.blocks, self.framing):
            while places and places[-1] >= until:
                places.pop()

    def last(self, names) -> int:
        """Place of the innermost of some tags, 0 if none is open."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def has(self, tag: str) -> bool:
        return bool(self.places.get(tag))


def parse(html: str) -> Node:
    """The element tree. Unclosed, stray and implied tags are handled as browsers mostly do."""
    root = Node("html")
    stack, scanner = _Open(root), _Scanner(html)
    for kind, tag, attributes in scanner.tokens():
        if kind == "text":
            stack.nodes[-1].children.append(unescape(tag) if "&" in tag else tag)
        elif kind == "end":
            at = stack.last((tag,))
            # An inline end tag reaches no further than the block it stands in.
            if at and tag not in ("html", "body") and (tag in BLOCKS or not stack.blocks or stack.blocks[-1] < at):
                stack.close(at)
        else:
            if tag == "html" or (tag == "body" and stack.has(tag)):
                continue
            if tag == "body" or (tag in CLOSES_PARAGRAPH and stack.nodes[-1].tag == "head"):
                stack.close(1)
            if tag in CLOSES_PARAGRAPH and (p := stack.last(("p",))) > stack.last(("table", "td", "th", "button")):
                stack.close(p)
            if tag in CLOSED_BY:
                names, barrier = (x.split() for x in CLOSED_BY[tag])
                while (at := stack.last(names)) > stack.last(barrier):
                    stack.close(at)
            node = _make_node(tag, attributes, stack.has("article") or stack.has("main"))
            if tag in ("article", "main") and not node.aside:
                # What holds the article is no part beside it, whatever its name tells of.
                for at in stack.framing:
                    stack.nodes[at].aside = False
                stack.framing.clear()
            stack.nodes[-1].children.append(node)
            if tag in RAW:
                node.children.append(scanner.raw(tag))
            elif tag not in VOID and not attributes.rstrip().endswith("/"):
                stack.push(node)
    return root


def _pardon(body: Node) -> None:
    """Unmarks asides that hold the article, or most of the text, whatever their names tell of.

    If all articles stand in asides, those around them are unmarked: loosely named ones, and only
    if there are none the others. Of the text of an article, or of a page without one, a
    loosely named aside with more than half of the characters outside links is unmarked, and
    a plainly named one only where no text is left otherwise.
    """
    order, waiting = [], [(body, None)]
    while waiting:
        node, parent = waiting.pop()
        if node.unseen or node.tag in UNSEEN:
            continue
        order.append((node, parent))
        waiting.extend((c, node) for c in reversed(node.children) if isinstance(c, Node))
    if not any(n.aside for n, _ in order):
        return
    plain, holds = {}, {}
    for node, parent in reversed(order):
        own = sum(sum(map(len, c.split())) for c in node.children if isinstance(c, str))
        plain[id(node)] = 0 if node.tag == "a" else plain.get(id(node), 0) + own
        holds[id(node)] = holds.get(id(node), False) or node.tag in ("article", "main")
        if parent is not None:
            if not node.aside or node.loose:
                plain[id(parent)] = plain.get(id(parent), 0) + plain[id(node)]
            holds[id(parent)] = holds.get(id(parent), False) or holds[id(node)]

    def open_articles() -> dict[int, Node | None]:
        """The outermost open article around every node that an aside does not hide."""
        inside = {}
        for node, parent in order:
            if node.aside or (parent is not None and id(parent) not in inside):
                continue
            above = inside[id(parent)] if parent is not None else None
            inside[id(node)] = above or (node if node.tag in ("article", "main") else None)
        return inside

    if holds[id(body)]:
        for loose in (True, False):
            if any(open_articles().values()):
                break
            for node, _ in order:
                if node.aside and holds[id(node)] and (node.loose or not loose):
                    node.aside = False
    inside = open_articles()
    articles = any(inside.values())
    for node, parent in order:
        if node.aside and id(parent) in inside:
            whole = inside[id(parent)] or (None if articles else body)
            named = node.loose or (node.tag not in ASIDE_TAGS and not plain[id(whole or body)])
            if whole is not None and named and 2 * plain[id(node)] > plain[id(whole)]:
                node.aside = False
        if parent is not None and not node.aside and id(parent) in inside:
            inside[id(node)] = inside[id(parent)] or (node if node.tag in ("article", "main") else None)


def _post_order(root: Node) -> list[Node]:
    """Nodes that count, children before parents; no recursion, for pages may be deep."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting.extend(c for c in node.children if isinstance(c, Node) and not c.aside and c.tag not in UNSEEN)
    return order[::-1]


def measure(body: Node) -> list[Node]:
    """Counts characters and tags, then sets densities and density sums."""
    nodes = _post_order(body)
    for node in nodes:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += sum(map(len, child.split()))
            elif not child.aside and child.tag not in UNSEEN:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        node.density = _composite(node, share)
        node.density_sum = sum(c.density for c in node.children if isinstance(c, Node) and not c.aside and c.tag not in UNSEEN)
    return nodes


def _composite(node: Node, body_share: float) -> float:
    """Characters per tag times a logarithm that falls with the links' share of both."""
    if not node.chars:
        return 0.0
    tags, links, linked = max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
    plain = max(1, node.chars - node.link_chars)
    base = math.log(node.chars / plain * node.link_chars + body_share * node.chars + math.e)
    return node.chars / tags * max(0.0, math.log(node.chars * tags / (links * linked) + 1e-9)) / base


def _path(body: Node, nodes: list[Node]) -> list[Node]:
    """From the node with the greatest density sum up to the body; of equal sums the first in post-order."""
    parents = {id(c): n for n in nodes for c in n.children if isinstance(c, Node)}
    path = [max(nodes, key=lambda n: n.density_sum)]
    while path[-1] is not body:
        path.append(parents[id(path[-1])])
    return path


def _readmit(body: Node, threshold: float) -> bool:
    """Unmarks asides of sparse names that are as dense as the main text and hold more text than links."""
    found, waiting = False, [body]
    while waiting:
        node = waiting.pop()
        if node.unseen or node.tag in UNSEEN:
            continue
        if node.aside:
            if not node.sparse:
                continue
            node.aside = False
            measure(node)
            node.aside = not (node.density >= threshold and node.chars > 2 * node.link_chars)
            found |= not node.aside
            continue
        waiting.extend(c for c in node.children if isinstance(c, Node))
    return found


def _outermost(body: Node, tag: str) -> list[Node]:
    """Elements of a tag that stand in no other one, with more text than links, in page order."""
    found, waiting = [], [body]
    while waiting:
        node = waiting.pop()
        if node.aside or node.tag in UNSEEN:
            continue
        if node.tag == tag:
            if node.chars > 2 * node.link_chars:
                found.append(node)
            continue
        waiting.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return found


def _content(body: Node) -> list[Node]:
    nodes = measure(body)
    path = _path(body, nodes)
    if path[0].density_sum and _readmit(body, min(n.density for n in path)):
        nodes = measure(body)
        path = _path(body, nodes)
    # Articles are taken whole, for each of their parts may have the greatest sum.
    if articles := _outermost(body, "article") or _outermost(body, "main"):
        return articles
    return _dense(body, _with_siblings(path), path) if path[0].density_sum else [body]


def _dense(body: Node, found: Node, path: list[Node]) -> list[Node]:
    """``found`` and the other subtrees that reach the least density on the path, in page order."""
    threshold = min(n.density for n in path)
    at = next(i for i, n in enumerate(path) if n is found)
    ancestors = {id(n) for n in path[at + 1 :]}
    kept, waiting = [], [(found, body)] if found is body else [(c, body) for c in reversed(body.children)]
    while waiting:
        node, parent = waiting.pop()
        if node is found:
            kept.append(node)
        elif not isinstance(node, Node) or node.aside or node.tag in UNSEEN:
            continue
        elif id(node) not in ancestors and node.tag in BLOCKS and node.chars > 2 * node.link_chars and (
            node.density >= threshold or (parent is body and node.tag in TEXT_TAGS)
        ):
            kept.append(node)
        else:
            waiting.extend((c, node) for c in reversed(node.children))
    return kept


def _with_siblings(path: list[Node]) -> Node:
    """The highest node of a path that joins it to siblings with more text than links.

    A short paragraph has a low density and still belongs to its neighbours. The body only
    counts if it holds the paragraphs itself; else what stands beside the container of the
    text is judged by its own density.
    """
    found = path[0]
    for node, parent in zip(path, path[1:]):
        if parent is path[-1] and node.tag in CONTAINERS:
            break
        others = (c for c in parent.children if isinstance(c, Node) and c is not node and not c.aside)
        if any(c.chars > 2 * c.link_chars for c in others):
            found = parent
    return found


def _blocks(content: Node) -> Iterator[str]:
    """Text of the blocks below a node in page order, white space joined."""
    open_text: list[str] = []
    waiting: list = [content]
    while waiting:
        item = waiting.pop()
        if item is None:
            yield " ".join("".join(open_text).split())
            open_text.clear()
        elif isinstance(item, str):
            open_text.append(item)
        elif item.aside or item.tag in UNSEEN:
            open_text.append(" ")
        elif item.tag == "br":
            open_text.append(" ")
        else:
            edge = [None] if item.tag in BLOCKS else []
            waiting.extend([*edge, *reversed(item.children), *edge])
    yield " ".join("".join(open_text).split())


def main_text(html: str | None) -> str:
    """The main text's blocks, one a line, white space joined; empty for null and for pages without text.

    Deep, long and broken pages are read whole. A start tag that never ends is text; where
    quotes hide the end of tags up to the end of the page, they are not looked at. Of nodes
    with equal density sums the first in post-order is the centre.
    """
    if not html:
        return ""
    root = parse(html)
    body = next((c for c in root.children if isinstance(c, Node) and c.tag == "body"), root)
    _pardon(body)
    return "\n".join(block for content in _content(body) for block in _blocks(content) if block)


@F.arrow_udf(T.StringType())
def _main_texts(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for array in pages:
        yield pa.array([main_text(p.as_py()) for p in array], pa.string())


def extracted(html: Column | str) -> Column:
    """Main text of a page; never null. See ``main_text``."""
    return _main_texts.asNondeterministic()(html)
