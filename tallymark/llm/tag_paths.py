"""Main text of web pages by tag-path ratios.

Per page, the text of every root-to-leaf tag path is summed up: characters and punctuation per text node. Both ratios are
smoothed over neighbouring paths in page order, fused by their geometric mean, and paths above a threshold are content.
The content paths name the article's container: the marked ones (article, main) if one of them holds most of their text,
else the smallest element with all their text and the page's main heading. The text is that of the container's blocks,
short ones included, without elements that are navigation, notices, adverts, forms or comments by their tag or role, by a
name that says nothing else, or by another name if no text of theirs is on a content path: see `belongs`.
A name or a form does not take away the element that holds most of the content: see `spared`.

Pages are handled in their own rows; the memory needed is that of one page.

Defined results: a null or empty html gives an empty text, and so does a page without text outside of such elements; a
page cut off anywhere is read as far as it goes, open elements ending there; repeated rows give repeated results; an
empty table gives an empty result. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

#: Spread that must be exceeded, as a share of the standard deviation of the fused ratios.
THRESHOLD = 0.5
#: Share of the content's characters that must be exceeded to hold most of it.
MOST = 0.5
#: With less of the content left than this share, elements named outright as something else are taken for the article's.
LEFT = 0.1

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "aside audio button canvas datalist dialog footer form head iframe input menu nav noscript object option script select style svg template textarea title video".split()
)
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
MAIN = frozenset(("article", "main"))
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Parts of class names and ids. The first kind also occurs in the names of layouts around an article ("with-sidebar"),
#: so it counts only where no marked container lies inside; the second always does.
LAYOUT_NAMES = frozenset("ad ads banner footer header masthead menu nav navbar navigation notice search sidebar widget".split())
DROPPED_NAMES = frozenset(
    "adbox advert adverts advertisement advertising breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus dropdown"
    " gdpr login modal newsletter pager pagination popup promo promotion recommended related replies respond share sharing signin signup"
    " skip social sponsor sponsored subscribe subscription teaser toolbar".split()
)
#: Words that may stand beside those above in the name of such an element itself; with any other ("has-comments",
#: "comments-open") the name may be that of something around an article.
BESIDE = frozenset(
    "area article aside bar block body bottom box button buttons col column container content count entry foot form head icon icons id inner item items"
    " left link links list main module more outer page panel post posts rail reader readers right section site slot stories story strip text the thread"
    " title top unit user users wrap wrapper zone".split()
)
#: Elements that hold other things together: only these are dropped for a class that says more than what they are.
SHELLS = frozenset("div dl ol p section span ul".split())
#: A marked container with less than this share of the main one's content is another story's card, or a comment.
FAR = 0.25
#: Opening one of these ends an open paragraph.
ENDS_PARAGRAPH = BLOCKS - {"br", "body", "html"}
#: An element that ends an open one of its own kind, up to the container named.
SIBLINGS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")


class Node:
    __slots__ = ("tag", "parent", "path", "dropped", "outright", "classed", "form", "main", "holds_main")

    def __init__(self, tag: str, parent: Node | None, attrs: list[tuple[str, str | None]]):
        self.tag, self.parent = tag, parent
        named = {k: v or "" for k, v in attrs} if attrs else {}
        names = named.get("class", "").split()
        self.path = (parent.path if parent else "") + "/" + tag + "".join("." + n for n in names)
        self.main = tag in MAIN or named.get("role") == "main" or named.get("itemprop") == "articleBody"
        self.holds_main = False
        whole = [
            {part for part in re.split(r"[-_\s]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if part}
            for name in ([*names, named.get("id", "")] if tag not in ("body", "html") else ())
        ]
        parts = set().union(*whole)
        role = named.get("role", "")
        hidden = "hidden" in named or named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", "")
        form = tag == "form" or role == "form"
        #: 3: always; 2: by a name or as a form; 1: unless a marked container lies inside. 2 and 1 can be spared.
        self.dropped = 3 if (tag in DROPPED or hidden or role in DROPPED_ROLES) and not (form and not hidden) else 0
        self.dropped = self.dropped or (2 if form or parts & DROPPED_NAMES else 1 if parts & LAYOUT_NAMES or tag == "header" else 0)
        #: One of the names says nothing else.
        noise = DROPPED_NAMES | LAYOUT_NAMES
        self.outright = any(x & noise and all(part in noise or part in BESIDE or part.isdigit() for part in x) for x in whole)
        #: A class has such a part. An id with one may as well be the anchor of a part of the article.
        self.classed = any(x & noise for x in whole[: len(names)])
        self.form = form
        if self.main and not self.dropped:
            up = parent
            while up and not up.holds_main:
                up.holds_main = True
                up = up.parent


class Page(HTMLParser):
    """Text nodes of a page in order: (element, text, number of its block)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.at = Node("", None, [])
        self.block = 0
        self.texts: list[tuple[Node, str, int]] = []

    def end_to(self, node: Node) -> None:
        self.at = node.parent
        if node.tag in BLOCKS:
            self.block += 1

    def open_up_to(self, tags: tuple[str, ...], stop: tuple[str, ...]) -> Node | None:
        node = self.at
        while node.parent is not None:
            if node.tag in tags:
                return node
            if node.tag in stop:
                return None
            node = node.parent
        return None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_PARAGRAPH and (node := self.open_up_to(("p",), ("article", "main", "section", "div", "td", "table", "button", "object"))):
            self.end_to(node)
        if tag in SIBLINGS and (node := self.open_up_to((tag,) if tag not in ("dt", "dd", "td", "th") else (("dt", "dd") if tag[0] == "d" else ("td", "th")), SIBLINGS[tag])):
            self.end_to(node)
        if tag in BLOCKS:
            self.block += 1
        if tag not in VOID:
            self.at = Node(tag, self.at, attrs)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "br" or tag == "p" and not self.open_up_to(("p",), ()):
            self.block += 1
        elif node := self.open_up_to((tag,), ("article", "main") if tag not in BLOCKS | DROPPED else ()):
            self.end_to(node)

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self.texts.append((self.at, data, self.block))
        elif self.texts and self.texts[-1][2] == self.block:
            self.texts.append((self.at, " ", self.block))

    def unknown_decl(self, data: str) -> None:
        pass


def up(node: Node):
    """The element and those around it."""
    while node.parent is not None:
        yield node
        node = node.parent


def kept(node: Node, saved: set[Node]) -> bool:
    """No element from here up to the root is dropped. Site headers go; an article's own header stays."""
    while node.parent is not None:
        if node.dropped == 3 or node not in saved and (node.dropped == 2 or node.dropped == 1 and not node.holds_main):
            if not (node.tag == "header" and node.dropped == 1 and under_main(node)):
                return False
        node = node.parent
    return True


def under_main(node: Node) -> bool:
    while node is not None:
        if node.main:
            return True
        node = node.parent
    return False


def fused_ratios(texts: list[tuple[Node, str, int]]) -> dict[str, float]:
    """Per path the geometric mean of the smoothed text and punctuation ratios."""
    characters, marks, nodes = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, text, _ in texts:
        characters[node.path] += len(text.strip())
        marks[node.path] += len(PUNCTUATION.findall(text))
        nodes[node.path] += 1
    paths = list(nodes)
    smooth = lambda ratios: [
        (0.25 * (ratios[i - 1] if i else x) + 0.5 * x + 0.25 * (ratios[i + 1] if i + 1 < len(ratios) else x)) for i, x in enumerate(ratios)
    ]
    text_ratio = smooth([characters[p] / nodes[p] for p in paths])
    mark_ratio = smooth([marks[p] / nodes[p] for p in paths])
    return {p: math.sqrt(a * b) for p, a, b in zip(paths, text_ratio, mark_ratio)}


def content_paths(ratios: dict[str, float], threshold: float = THRESHOLD) -> set[str]:
    if not ratios:
        return set()
    mean = sum(ratios.values()) / len(ratios)
    spread = math.sqrt(sum((x - mean) ** 2 for x in ratios.values()) / len(ratios))
    return {p for p, x in ratios.items() if x >= threshold * spread}


def content_of(texts: list[tuple[Node, str, int]]) -> list[tuple[Node, int]]:
    """Element and characters of the text nodes on content paths."""
    content = content_paths(fused_ratios(texts))
    return [(node, len(text.strip())) for node, text, _ in texts if node.path in content]


def sentences(texts: list[tuple[Node, str, int]]) -> set[Node]:
    """Elements with text on a content path that has punctuation of its own, not only of its neighbours by the smoothing."""
    marked = {node.path for node, text, _ in texts if PUNCTUATION.search(text)}
    return {x for node, _ in content_of(texts) if node.path in marked for x in up(node)}


def holders(chosen: list[tuple[Node, int]]) -> set[Node]:
    """Elements that could be dropped by name or as a form, but hold most of the content."""
    under: dict[Node, int] = defaultdict(int)
    for node, size in chosen:
        for x in up(node):
            if x.dropped in (1, 2):
                under[x] += size
    total = sum(size for _, size in chosen)
    return {x for x, size in under.items() if size > MOST * total}


def spared(texts: list[tuple[Node, str, int]]) -> set[Node]:
    """Elements that stay whatever their name: those that hold most of the content.

    The content of elements whose name says only what they are (a long thread of comments) does not count, unless without
    them hardly any content and no marked container is left; then they stay.
    """
    if not any(x.dropped for node in {t[0] for t in texts} for x in up(node)):
        return set()
    texts = [t for t in texts if not any(x.dropped == 3 for x in up(t[0]))]
    rest = [t for t in texts if not any(x.outright and x.dropped for x in up(t[0]))]
    all_content, content = content_of(texts), content_of(rest)
    if sum(size for _, size in content) < LEFT * sum(size for _, size in all_content) and not any(x.main for node, _ in content for x in up(node)):
        return holders(all_content)
    return holders(content)


def container(texts: list[tuple[Node, str, int]], content: set[str], everything: list[tuple[Node, str, int]]) -> tuple[set[Node], set[Node]]:
    """The elements whose text is the article's, and those marked as articles that are none of it: cards and comments."""
    chosen = [(node, len(text)) for node, text, _ in texts if node.path in content] or [(node, len(text)) for node, text, _ in texts]
    marked: dict[Node, int] = {x: 0 for node, _, _ in everything for x in up(node) if x.main}
    outermost: dict[Node, int] = defaultdict(int)
    total = 0
    for node, size in chosen:
        total += size
        around = [x for x in up(node) if x.main]
        for x in around:
            marked[x] += size
        if around:
            outermost[around[-1]] += size
    best = max((x for x, size in marked.items() if size > MOST * total), key=lambda x: sum(1 for _ in up(x)), default=None)
    others: set[Node] = set()
    if best is not None:
        related = set(up(best))
        others = {x for x, size in marked.items() if x not in related and best not in set(up(x)) and size < FAR * marked[best]}
    if outermost and max(outermost.values()) > MOST * total:
        return {x for x in outermost if x not in others}, others
    nodes = dict.fromkeys([node for node, _ in chosen] + [node for node, _, _ in texts if "h1" in {x.tag for x in up(node)}])
    under: dict[Node, int] = defaultdict(int)
    for node in nodes:
        while node is not None:
            under[node] += 1
            node = node.parent
    return {max((x for x, n in under.items() if n == len(nodes)), key=lambda x: sum(1 for _ in up(x)))}, others


def belongs(node: Node, roots: set[Node], others: set[Node], saved: set[Node], rich: set[Node]) -> bool:
    """The element's text is the article's: it lies in a container, and nothing on the way is something else.

    Inside the article a name alone drops only an element that says nothing else by it. One that says more is dropped if it is
    a shell, named so by its class, and without text on a content path.
    """
    while node is not None and node not in roots:
        if node in others or node.dropped == 3:
            return False
        if node.dropped and node not in saved:
            if node.tag == "header" and node.dropped == 1:
                if not under_main(node):
                    return False
            elif not (node.dropped == 1 and node.holds_main):
                if node.outright or node.form or node.classed and node.tag in SHELLS and node not in rich:
                    return False
        node = node.parent
    return node is not None


def main_text(html: str | None) -> str:
    page = Page()
    page.feed(html or "")
    page.close()
    saved = spared(page.texts)
    seen: dict[Node, bool] = {}
    texts = []
    for item in page.texts:
        node = item[0]
        if node not in seen:
            seen[node] = kept(node, saved)
        if seen[node]:
            texts.append(item)
    if not texts:
        return ""
    roots, others = container(texts, content_paths(fused_ratios(texts)), page.texts)
    rich = sentences([t for t in page.texts if not any(x.dropped == 3 for x in up(t[0]))])
    inside: dict[Node, bool] = {}
    blocks: dict[int, list[str]] = {}
    for node, text, block in page.texts:
        if node not in inside:
            inside[node] = belongs(node, roots, others, saved, rich)
        if inside[node]:
            blocks.setdefault(block, []).append(text)
    return " ".join(" ".join(" ".join("".join(parts).split()) for parts in blocks.values()).split())


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([main_text(x.as_py()) for x in batch.column(2)], type=pa.string())],
                names=["page_id", "url", "text"],
            )

    rows = pages.select("page_id", "url", "html")
    kinds = [f.dataType.simpleString() for f in rows.schema.fields]
    return rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
