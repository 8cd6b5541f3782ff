"""Main text of web pages by wrapper induction (operator 5).

Pages of one host share a template. Each page becomes a small tree of its block elements
(paragraphs of one parent are one node, inline elements are text). Trees of a host are aligned by
simple tree matching and merged, node by node: a node whose text is the same in all the
pages that have it stays constant and is template, all others are slots. The container that holds
most of a host's varying text is the slot of its articles, and main text is what stands in that slot of a
page. Names of elements decide within it, and where a host has too few pages.

Pages that share an article's title are one article, so that copies make no template. Trees are
merged by host and share of the articles, then by host, so a host with a third of all pages is
no large group; a merged tree forgets rare nodes as it grows, and so its size is bounded by that of
some pages.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslayers.storage import materialize

# -- fixed values: elements of the HTML standard, and names that say what a part is -------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title xmp noframes".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
# An open element on the left ends where one on the right begins.
ENDED_BY = {
    "p": BLOCKS - set("html head body option optgroup tbody td tfoot th thead tr caption legend summary".split()),
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option", "optgroup"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "head": {"body"},
}
# Elements that an end of another element does not close.
FENCES = set("html body table article main section div td th ul ol dl nav aside header footer form blockquote".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
TITLES = {"h1", "h2"}
CONTAINERS = set("html body article main section div td center details header".split())
OTHER_TAGS = set("head nav footer aside form button select textarea iframe svg object dialog menu search template".split())
OTHER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription paywall sidebar "
    "menu menubar nav navbar navigation breadcrumb breadcrumbs pagination masthead footer comment comments disqus "
    "respond social share sharing related recommended widget login signup toolbar skip hidden".split()
)
OTHER_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
# ----------------------------------------------------------------------------------------

# A constant node is template if so many different articles of the host have it, and half of all.
LEAST_PAGES = 5
# Nodes that at most one page in so many has are dropped from merged trees. A node of half of the
# pages is always found, one of under half less a ``RARE``th never taken for one.
RARE = 16
# Containers of one label in one element, beyond which they are one node.
MOST_ALIKE = 16
# The share of a host's varying text that the article's slot holds at least.
MOST_TEXT = 0.8
# Wrappers that a task keeps unpacked, and shares that a host's articles are dealt into.
MOST_HOSTS, SHARES = 5000, 256
# Marks labels of elements named for something other than main text.
OTHER_MARK = "-"

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
ENDED = re.compile(r"<!--.*-->|<!\[CDATA\[.*\]\]>", re.S)
UNENDED = re.compile(r"<!--.*|<!\[CDATA\[.*", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME_PARTS = re.compile(r"[^a-z]+")
ENDERS = set().union(*ENDED_BY.values())


@dataclass(eq=False)
class Element:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    parts: list = field(default_factory=list)  # texts and elements, in order

    def names(self) -> set[str]:
        named = f"{self.attributes.get('class', '')} {self.attributes.get('id', '')}".lower()
        return set(NAME_PARTS.split(named))

    @property
    def label(self) -> str:
        """Tag and class, without the numbers that make a class unlike on every page, marked for other parts."""
        tag = OTHER_MARK + self.tag if _apart(self) else self.tag
        if "class" not in self.attributes:
            return tag
        named = re.sub(r"\d+", "", self.attributes["class"].lower())
        return " ".join([tag, *sorted(named.split())])


def _attributes(text: str) -> dict[str, str]:
    if not text.strip(" /\n\t\r"):
        return {}
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(text)}


def parse(page: str) -> Element:
    """The page as a tree. Any text is accepted; ends without a beginning are ignored."""
    root = Element("html")
    open_ = [root]
    at, n = 0, len(page)
    last = page.rfind(">") + 1  # no tag ends behind it; without this, many "<p " take time squared
    while at < n:
        tag = TAG.search(page, at, last) or UNENDED.search(page, max(at, last))
        text = page[at : tag.start() if tag else n]
        if text:
            open_[-1].parts.append(html.unescape(text) if "&" in text else text)
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or tag[5]) if tag.re is TAG else None
        if not name:
            if at == last and UNENDED.match(tag[0]) and not ENDED.fullmatch(tag[0]):
                at = n
            if tag[0].startswith("<![CDATA["):
                open_[-1].parts.append(page[tag.start() + 9 : at].removesuffix("]]>"))
            continue
        name = name.lower()
        if tag[1] or tag[4]:
            _close(open_, name)
            continue
        attributes = _attributes(tag[3] or tag[6] or "")
        if name in ("html", "body") and any(e.tag == name for e in open_):
            root.attributes.update(attributes)
            continue
        for i in range(len(open_) - 1, 0, -1) if name in ENDERS else ():
            if name in ENDED_BY.get(open_[i].tag, ()):
                del open_[i:]
                break
            if open_[i].tag in FENCES:
                break
        element = Element(name, attributes)
        open_[-1].parts.append(element)
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else n
        elif name not in VOID:
            open_.append(element)
    return root


def _close(open_: list[Element], name: str) -> None:
    for i in range(len(open_) - 1, 0, -1):
        if open_[i].tag == name:
            del open_[i:]
            return
        if open_[i].tag in FENCES and name not in FENCES:
            return


def is_other(element: Element) -> bool:
    """Whether tag, class, id or role say that it is no part of the main text."""
    if element.tag in OTHER_TAGS or element.tag in RAW:
        return True
    if not element.attributes:
        return False
    role = element.attributes.get("role", "").lower()
    hidden = "hidden" in element.attributes or element.attributes.get("aria-hidden") == "true"
    return hidden or role in OTHER_ROLES or bool(element.names() & OTHER_NAMES)


# -- trees of a host ---------------------------------------------------------------


@dataclass(eq=False)
class Node:
    """A node of a merged tree: ``text`` is a digest, empty for none, None where it varies.

    ``pages`` have it for certain and up to ``missed`` more, from before it was dropped for being rare;
    ``chars`` is how much text of its own all of them had.
    """

    label: str
    text: str | None
    pages: int
    missed: int
    chars: int
    kids: list[Node] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)  # in a page's own tree

    def walk(self) -> Iterator[Node]:
        """This node and all below it, parents first, in page order."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(reversed(node.kids))

    def packed(self) -> str:
        return json.dumps([[n.label, n.text, n.pages, n.missed, n.chars, len(n.kids)] for n in self.walk()])

    @staticmethod
    def unpacked(given: str) -> Node:
        top = Node("", "", 0, 0, 0)
        open_ = [[top, 1]]
        for *values, n_kids in json.loads(given):
            while not open_[-1][1]:
                open_.pop()
            node = Node(*values)
            open_[-1][0].kids.append(node)
            open_[-1][1] -= 1
            open_.append([node, n_kids])
        return top.kids[0]


def _own(element: Element, texts: list[str], blocks: list[Element]) -> None:
    """Text of an element outside block elements within it, and those block elements."""
    todo = [iter(element.parts)]
    while todo:
        for part in todo[-1]:
            if isinstance(part, str):
                texts.append(part)
            elif part.tag in BLOCKS:
                texts.append(" ")
                blocks.append(part)
            elif part.tag not in RAW:
                todo.append(iter(part.parts))
                break
        else:
            todo.pop()


def _grouped(blocks: list[Element]) -> list[list[Element]]:
    """Elements that are one node: paragraphs and the like by label, containers if there are many of a label."""
    by_label: dict[str, list[Element]] = {}
    for block in blocks:
        by_label.setdefault(block.label, []).append(block)
    groups: list[list[Element]] = []
    for block in blocks:
        alike = by_label[block.label]
        if block.tag in CONTAINERS and len(alike) <= MOST_ALIKE:
            groups.append([block])
        elif block is alike[0]:
            groups.append(alike)
    return groups


def skeleton(root: Element) -> Node:
    """The page's tree of block elements; inline elements are text of the block around them."""
    top = Node("", "", 0, 0, 0)
    todo = [([root], top)]
    while todo:
        elements, parent = todo.pop()
        texts: list[str] = []
        blocks: list[Element] = []
        for element in elements:
            _own(element, texts, blocks)
        words = " ".join("".join(texts).split())
        digest = xxhash.xxh3_64_hexdigest(words) if words else ""
        node = Node(elements[0].label, digest, 1, 0, len(words), [], elements)
        parent.kids.append(node)
        todo.extend((group, node) for group in reversed(_grouped(blocks)))
    return top.kids[0]


class Matching:
    """Simple tree matching: for two nodes the order-keeping match of their kids with most nodes in all."""

    def __init__(self, a: Node, b: Node) -> None:
        self._known: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
        todo = [(a, b)]
        while todo:  # what a pair needs is settled before it
            x, y = todo[-1]
            if (id(x), id(y)) in self._known:
                todo.pop()
                continue
            places: dict[str, list[Node]] = {}
            for q in y.kids:
                places.setdefault(q.label, []).append(q)
            needed = [(p, q) for p in x.kids for q in places.get(p.label, ()) if (id(p), id(q)) not in self._known]
            if needed:
                todo += needed
            else:
                todo.pop()
                self._known[id(x), id(y)] = self._best(x.kids, y.kids)

    def nodes(self, a: Node, b: Node) -> int:
        return self._known[id(a), id(b)][0]

    def pairs(self, a: Node, b: Node) -> list[tuple[int, int]]:
        return self._known[id(a), id(b)][1]

    def _best(self, a: list[Node], b: list[Node]) -> tuple[int, list[tuple[int, int]]]:
        common = {x.label for x in a} & {y.label for y in b}
        rows = [i for i, x in enumerate(a) if x.label in common]
        columns = [j for j, y in enumerate(b) if y.label in common]
        labels = [a[i].label for i in rows]
        if len(labels) == len(common) and labels == [b[j].label for j in columns]:
            pairs = list(zip(rows, columns))
            return 1 + sum(self.nodes(a[i], b[j]) for i, j in pairs), pairs
        best = [[0] * (len(columns) + 1) for _ in range(len(rows) + 1)]
        for r, i in enumerate(rows):
            for c, j in enumerate(columns):
                both = self.nodes(a[i], b[j]) if a[i].label == b[j].label else 0
                best[r + 1][c + 1] = max(best[r][c + 1], best[r + 1][c], best[r][c] + both)
        pairs, r, c = [], len(rows), len(columns)
        while r and c:
            if best[r][c] == best[r - 1][c]:
                r -= 1
            elif best[r][c] == best[r][c - 1]:
                c -= 1
            else:
                r, c = r - 1, c - 1
                pairs.append((rows[r], columns[c]))
        return 1 + best[-1][-1], pairs[::-1]


def merged(a: Node, b: Node) -> Node:
    """Two trees with equal roots as one: matched nodes together, all others in their places."""
    found = Matching(a, b)
    # Up to so many pages of a tree may have had a node that it holds no more.
    unseen = a.pages // RARE, b.pages // RARE

    def both(x: Node, y: Node) -> Node:
        return Node(x.label, x.text if x.text == y.text else None, x.pages + y.pages, x.missed + y.missed, x.chars + y.chars)

    def alone(nodes: list[Node], missed: int) -> list[Node]:
        if missed:
            for top in nodes:
                for node in top.walk():
                    node.missed += missed
        return nodes

    tree = both(a, b)
    todo = [(a, b, tree)]
    while todo:
        x, y, into = todo.pop()
        i = j = 0
        for p, q in found.pairs(x, y):
            kid = both(x.kids[p], y.kids[q])
            into.kids += [*alone(x.kids[i:p], unseen[1]), *alone(y.kids[j:q], unseen[0]), kid]
            todo.append((x.kids[p], y.kids[q], kid))
            i, j = p + 1, q + 1
        into.kids += [*alone(x.kids[i:], unseen[1]), *alone(y.kids[j:], unseen[0])]
    if tree.pages // RARE > max(unseen):
        _drop_rare(tree)
    return tree


def _drop_rare(tree: Node) -> None:
    """Lossy counting: nodes go that at most one in ``RARE`` pages can have; how much text they had stays known."""
    most = tree.pages // RARE
    for node in tree.walk():
        rare = [k for k in node.kids if k.pages + k.missed <= most]
        if rare:
            node.kids = [k for k in node.kids if k.pages + k.missed > most]
            node.chars += sum(n.chars for k in rare if not k.label.startswith(OTHER_MARK) for n in k.walk())


@dataclass(eq=False)
class Wrapper:
    """What the pages of a host have in common, and which slot of it holds their articles."""

    tree: Node
    least: int
    slot: list[int]  # the place of the article's slot, kid by kid

    def constant(self, node: Node) -> bool:
        return bool(node.text) and node.pages + node.missed >= self.least


def induced(tree: Node) -> Wrapper | None:
    """The wrapper of a host's merged tree; none where too few different articles were seen.

    The article's slot is found from the root: down into the container with most of the varying text,
    as long as no varying heading stays behind.
    """
    if tree.pages < LEAST_PAGES:
        return None
    wrapper = Wrapper(tree, max(LEAST_PAGES, (tree.pages + 1) // 2), [])
    volume: dict[int, int] = {}
    titled: dict[int, bool] = {}
    for node in reversed(list(tree.walk())):
        if node.label.startswith(OTHER_MARK):
            volume[id(node)], titled[id(node)] = 0, False
            continue
        varies = not wrapper.constant(node) and node.chars > 0
        volume[id(node)] = node.chars * varies + sum(volume[id(k)] for k in node.kids)
        titled[id(node)] = (varies and node.label.split()[0] in TITLES) or any(titled[id(k)] for k in node.kids)
    node, total = tree, volume[id(tree)]
    while node.kids:
        i = max(range(len(node.kids)), key=lambda k: volume[id(node.kids[k])])
        kid = node.kids[i]
        if (
            kid.label.split()[0] not in CONTAINERS
            or kid.pages + kid.missed < wrapper.least
            or volume[id(kid)] < MOST_TEXT * total
            or any(titled[id(k)] for k in node.kids if k is not kid)
            or node.label.split()[0] == "article"
        ):
            break
        wrapper.slot.append(i)
        node = kid
    return wrapper


def aligned(page: Node, wrapper: Wrapper) -> tuple[list[Element], set[Element]]:
    """A page's elements in the article's slot, none if it lacks that, and those whose own text is template."""
    found = Matching(page, wrapper.tree)
    constant: set[Element] = set()
    place = wrapper.tree
    path = [place]
    for i in wrapper.slot:
        place = place.kids[i]
        path.append(place)
    slot: list[Element] = []
    todo = [(page, wrapper.tree, [])]
    while todo:
        x, y, beside = todo.pop()
        if y is place:
            slot = x.elements
            if x.label.split()[0] == "article":
                slot = [e for k in beside if k.label.split()[0] == "article" for e in k.elements]
        # A heading is never template: articles may share a title.
        if wrapper.constant(y) and y.text == x.text and x.label.split()[0] not in HEADINGS:
            constant.update(x.elements)
        todo.extend((x.kids[i], y.kids[j], x.kids) for i, j in found.pairs(x, y))
    return slot if wrapper.slot else [], constant


# -- main text ---------------------------------------------------------------------


def _mains(parts: list, everywhere: bool = False) -> list[Element]:
    """The outermost articles, or main elements, that are not within something else.

    A main element in which only headings stand outside its articles gives way to these.
    """
    found: list[Element] = []
    todo = list(reversed(parts))
    while todo:
        part = todo.pop()
        if isinstance(part, str) or (_apart(part) and (not everywhere or part.tag not in FENCES - OTHER_TAGS)):
            continue
        role = part.attributes.get("role")
        if part.tag == "article" or role == "article":
            found.append(part)
        elif part.tag == "main" or role == "main":
            found += _articles(part) or [part]
        else:
            todo.extend(reversed(part.parts))
    return found


def _articles(main: Element) -> list[Element]:
    """The articles of ``main`` if no text stands outside them, headings and other parts; else none."""
    found: list[Element] = []
    todo = list(reversed(main.parts))
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            if part.strip():
                return []
        elif part.tag == "article" or part.attributes.get("role") == "article":
            if not _apart(part):
                found.append(part)
        elif part.tag not in HEADINGS and not _apart(part):
            todo.extend(reversed(part.parts))
    return found


def _apart(element: Element) -> bool:
    """Whether an element with all in it is no part of the main text; the page's own frame never is."""
    return element.tag not in ("html", "body") and is_other(element)


def _text(regions: list[Element], skipped: set[Element]) -> str:
    """Text of ``regions``, one line per block, without the own text of ``skipped`` elements."""
    out: list[list[str]] = []
    for region in regions:
        out.append([])
        # Open elements: what is left of their parts, whether their own text goes, whether they are blocks.
        todo = [(iter(region.parts), region in skipped, True)]
        while todo:
            parts, gone, block = todo[-1]
            for part in parts:
                if isinstance(part, str):
                    if not gone:
                        out[-1].append(part)
                elif part.tag == "br":
                    out[-1].append(" ")
                elif _apart(part):
                    if part.tag in BLOCKS:
                        out.append([])
                else:
                    inner = part.tag in BLOCKS
                    if inner:
                        out.append([])
                    # An inline element's text is that of the block around it.
                    todo.append((iter(part.parts), part in skipped if inner else gone, inner))
                    break
            else:
                todo.pop()
                if block:
                    out.append([])
    return "\n".join(filter(None, (" ".join("".join(block).split()) for block in out)))


def _regions(root: Element) -> list[Element]:
    """Where a page's article is by its own elements."""
    regions = _mains(root.parts) or [root]
    if not _text(regions, set()):  # all of it is in an element named for something within it
        regions = _mains(root.parts, everywhere=True) or [root]
    return regions


def main_text(page: str, wrapper: Wrapper | None = None) -> str:
    """The article's text, one line per block.

    It stands in the slot that ``wrapper`` found for the host; there, or in the whole page where there
    is no wrapper or the page lacks the slot, articles and main elements go before what is around them,
    and elements named for something else are left out. Of it goes what ``wrapper`` knows to be
    constant, unless nothing would be left.
    """
    root = parse(page)
    if wrapper is not None:
        slot, constant = aligned(skeleton(root), wrapper)
        slot = [e for e in slot if not _apart(e)]
        regions = _mains(slot) or slot
        if not regions or not _text(regions, set()):
            regions = _regions(root)
        if text := _text(regions, constant):
            return text
        return _text(regions, set())
    return _text(_regions(root), set())


def article_key(root: Element) -> str:
    """Digest of the article's first heading, else of its longest block: near copies of an article share it."""
    regions = _regions(root)
    lines = [""]
    for region in regions:
        todo = [region]
        while todo:
            part = todo.pop()
            if part.tag in TITLES and (title := _text([part], set())):
                return xxhash.xxh3_64_hexdigest(title)
            todo.extend(p for p in reversed(part.parts) if not isinstance(p, str) and not _apart(p))
    lines += _text(regions, set()).split("\n")
    return xxhash.xxh3_64_hexdigest(max(lines, key=lambda line: (len(line), line)))


# -- Spark -------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; null where it has none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _merge_hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees sorted by host: one merged tree for each, one host in memory."""

    def row(host: str, tree: Node) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([host]), pa.array([tree.packed()])], names=["host", "tree"])

    current, tree = None, None
    for batch in batches:
        for host, packed in zip(batch.column("host").to_pylist(), batch.column("tree").to_pylist()):
            if host == current:
                tree = merged(tree, Node.unpacked(packed))
                continue
            if tree is not None:
                yield row(current, tree)
            current, tree = host, Node.unpacked(packed)
    if tree is not None:
        yield row(current, tree)


def host_templates(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One merged tree for every host, over all its pages; near copies of an article count once."""
    given = pages.select(host_of(pages[url_column]).alias("host"), F.coalesce(pages[html_column], F.lit("")).alias("html"))
    given = given.where(F.col("host").isNotNull())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, trees = [], []
            for page in batch.column("html").to_pylist():
                root = parse(page)
                keys.append(article_key(root))
                trees.append(skeleton(root).packed())
            columns = [batch.column("host"), pa.array(keys, pa.string()), pa.array(trees, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "key", "tree"])

    rows = given.mapInArrow(read, "host string, key string, tree string")
    # The least tree of an article, so that a task that runs again comes to the same one.
    articles = rows.groupBy("host", "key").agg(F.min("tree").alias("tree"))
    share = F.pmod(F.xxhash64("key"), F.lit(SHARES)).alias("share")
    merged_type = "host string, tree string"
    # A host's articles are merged by share of their keys, and then the shares.
    shared = articles.select("host", share, "tree").repartition("host", "share").sortWithinPartitions("host", "tree")
    whole = shared.mapInArrow(_merge_hosts, merged_type).repartition("host").sortWithinPartitions("host", "tree")
    return whole.mapInArrow(_merge_hosts, merged_type)


def extract_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: its id, its url, ``text`` and ``n_chars``.

    A null html counts as empty and gives an empty text. Pages without a host, and those
    of hosts with under ``LEAST_PAGES`` different articles, are read without a wrapper.
    """
    templates = materialize(host_templates(pages, url_column, html_column), "templates")
    keyed = pages.select(
        pages[id_column].alias("id"),
        pages[url_column].alias("url"),
        F.coalesce(pages[html_column], F.lit("")).alias("html"),
        host_of(pages[url_column]).alias("host"),
    )
    # Spark broadcasts the templates if they are small, and else deals both sides out.
    joined = keyed.join(templates, "host", "left").select("id", "url", "html", "tree")
    kind = pages.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, Wrapper | None] = {None: None}
        for batch in batches:
            texts = []
            for page, tree in zip(batch.column("html").to_pylist(), batch.column("tree").to_pylist()):
                if tree not in known:
                    if len(known) >= MOST_HOSTS:  # read again when they are met again
                        known = {None: None}
                    known[tree] = induced(Node.unpacked(tree))
                texts.append(main_text(page, known[tree]))
            columns = [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "url", "text"])

    out = joined.mapInArrow(run, f"id {kind}, url string, text string")
    return out.select(
        F.col("id").alias(id_column), F.col("url").alias(url_column), "text", F.length("text").cast("bigint").alias("n_chars")
    )
