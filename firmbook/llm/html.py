"""Main text of web pages by wrappers induced from pages of one host.

1. Every page becomes a small tree: its elements, equal neighbours merged, with
   a fingerprint and the length of the text each holds.
2. One page of each host is its reference. Simple tree matching aligns each page
   with it, and for every node of the reference the number of pages and of
   different texts is counted over all pages of the host.
3. Nodes with one text on all pages are template, the others slots. The wrapper
   of a host is the element that holds its varying text, apart from what is a
   menu, header, footer, sidebar, notice, advert, form or comment by its tag,
   role, class or id.
4. Each page is aligned again and the text of the wrapper's element is taken,
   with what else the page has beside it; but beside an article or main element
   nothing is. A page that does not fit its wrapper gives its article, main or
   body element.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmbook.llm.shared import settle, workspace

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand on lines of their own.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A new one ends an open one of the second kind, up to an element of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Elements that may hold the article.
HOLDERS = frozenset("html body main article section div center table tbody tr td form".split())
NOISE_TAGS = frozenset(
    "head title script style noscript template iframe object svg canvas nav header footer aside form button select "
    "textarea input label menu dialog audio video map".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner promo promotion promoted sponsor sponsored sponsors sidebar "
    "rail comment comments commentlist respond disqus replies reply cookie cookies consent gdpr notice notices alert alerts popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "breadcrumb breadcrumbs menu submenu nav navbar navigation pagination pager footer masthead topbar toolbar widget widgets "
    "skip hidden".split()
)
HEADER_NAMES = frozenset("header site-header page-header top-header".split())
_NAME = re.compile(r"[a-z0-9]+")
_DEEP = 200  # elements nested deeper are kept as children of this level


class Node:
    __slots__ = ("tag", "label", "noise", "parts", "parent", "depth")

    def __init__(self, tag: str, attrs: list, parent: Node | None):
        self.tag, self.parent, self.parts = tag, parent, []
        self.depth = parent.depth + 1 if parent else 0
        found = {k: (v or "").lower() for k, v in attrs}
        named = f"{found.get('class', '')} {found.get('id', '')}"
        words = set(_NAME.findall(re.sub(r"(?<=[a-z])(?=\d)", " ", named)))
        style = found.get("style", "").replace(" ", "")
        self.noise = (
            tag in NOISE_TAGS
            or found.get("role", "") in NOISE_ROLES
            or "hidden" in found
            or found.get("aria-hidden") == "true"
            or "display:none" in style
            or "visibility:hidden" in style
            or (tag not in ("html", "body", "main", "article") and (bool(words & NOISE_NAMES) or bool(set(named.split()) & HEADER_NAMES)))
        )
        classes = " ".join(sorted(found.get("class", "").split()))
        self.label = re.sub(r"\d+", "#", f"{tag}|{classes}|{found.get('id', '')}")


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", [], None)

    def _close(self, node: Node) -> None:
        self.at = node.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            node = self.at
            while node.parent and node.tag != "p" and node.tag not in BLOCKS:
                node = node.parent
            if node.tag == "p":
                self._close(node)
        if tag in ENDS:
            ended, within = ENDS[tag]
            node, last = self.at, None
            while node.parent and node.tag not in within:
                last = node if node.tag in ended else last
                node = node.parent
            if last:
                self._close(last)
        node = Node(tag, attrs, self.at)
        self.at.parts.append(node)
        if tag not in VOID and node.depth < _DEEP:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash does not end an element of HTML

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent and node.tag != tag:
            if tag not in BLOCKS and node.tag in BLOCKS:
                return  # ends nothing outside its block
            node = node.parent
        if node.parent:
            self._close(node)

    def handle_data(self, data: str) -> None:
        self.at.parts.append(data)


def parse(page: str | None) -> Node:
    tree = _Tree()
    tree.feed(page or "")
    tree.close()
    return tree.root


def text_of(nodes: list[Node], dropped: set[int] = frozenset()) -> str:
    """Blocks of the elements, one per line, without noise and dropped elements."""
    blocks, line = [], []

    def end() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    for top in nodes:
        waiting: list = [top]
        while waiting:
            part = waiting.pop()
            if part is None:
                end()
            elif isinstance(part, str):
                line.append(part)
            elif part.tag == "br":
                line.append(" ")
            elif (part is top or not part.noise) and id(part) not in dropped:
                if part.tag in BLOCKS:
                    end()
                    waiting.append(None)
                waiting.extend(reversed(part.parts))
        end()
    return "\n".join(blocks)


class Shape:
    """An element, or equal neighbours as one, in a page's small tree."""

    __slots__ = ("label", "nodes", "children", "noise")

    def __init__(self, nodes: list[Node]):
        self.label, self.noise, self.nodes = nodes[0].label, all(n.noise for n in nodes), nodes
        groups: list[list[Node]] = []
        for child in (p for n in nodes for p in n.parts if isinstance(p, Node)):
            if groups and groups[-1][0].label == child.label:
                groups[-1].append(child)
            elif child.tag in BLOCKS or child.noise:
                groups.append([child])
        self.children = [Shape(g) for g in groups]

    def outline(self) -> list:
        return [self.label, int(self.noise), [c.outline() for c in self.children]]

    def text(self) -> str:
        """Without the text of child blocks."""
        return " ".join(
            " ".join(p if isinstance(p, str) else "" if p.tag in BLOCKS or p.noise else text_of([p]) for p in n.parts)
            for n in self.nodes
        ).strip()


def _size(outline: list) -> int:
    return 1 + sum(map(_size, outline[2]))


def match(a: list, b: list, known: dict) -> tuple[int, list]:
    """Simple tree matching of two outlines: matched nodes, and pairs of their places in preorder."""
    key = json.dumps([a, b])
    if key not in known:
        if len(known) > 5000:
            known.clear()
        known[key] = _match(a, b)
    return known[key]


def _match(a: list, b: list) -> tuple[int, list]:
    if a[0] != b[0]:
        return 0, []
    left, right = a[2], b[2]
    pairs = [[_match(x, y) for y in right] for x in left]
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i in range(len(left)):
        for j in range(len(right)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + pairs[i][j][0])
    starts = []
    for side in (left, right):
        at, own = 1, []
        for child in side:
            own.append(at)
            at += _size(child)
        starts.append(own)
    found, i, j = [], len(left), len(right)
    while i and j:
        if pairs[i - 1][j - 1][0] and best[i][j] == best[i - 1][j - 1] + pairs[i - 1][j - 1][0]:
            i, j = i - 1, j - 1
            found += [(x + starts[0][i], y + starts[1][j]) for x, y in pairs[i][j][1]]
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[-1][-1] + 1, [(0, 0), *found]


def _preorder(shape: Shape) -> list[Shape]:
    out, waiting = [], [shape]
    while waiting:
        out.append(waiting.pop())
        waiting.extend(reversed(out[-1].children))
    return out


def host_of(url: str = "url") -> Column:
    """The host of an address in lower case, empty if it has none."""
    return F.lower(F.coalesce(F.try_parse_url(F.col(url), F.lit("HOST")), F.lit("")))


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, outline, and the fingerprint and length of the text at each of its nodes."""
    for batch in batches:
        out = []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html")):
            shape = Shape([parse(page.as_py())])
            texts = [s.text() for s in _preorder(shape)]
            prints = [xxhash.xxh3_64_intdigest(" ".join(t.split())) - (1 << 63) for t in texts]
            out.append((host, json.dumps(shape.outline()), prints, [len(t) for t in texts]))
        columns = list(zip(*out)) if out else [[]] * 4
        kinds = (pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "outline", "prints", "lengths"]
        )


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per page and node of the reference that the page has."""
    known: dict = {}
    for batch in batches:
        out = []
        for host, outline, reference, prints, lengths in zip(*(batch.column(c).to_pylist() for c in ("host", "outline", "reference", "prints", "lengths"))):
            _, pairs = match(json.loads(outline), json.loads(reference), known)
            out += [(host, node, prints[own], lengths[own]) for own, node in pairs]
        columns = list(zip(*out)) if out else [[]] * 4
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "node", "print", "length"]
        )


def _wrapper(rows: pd.DataFrame) -> pd.DataFrame:
    """The holder of a host's varying text, and its template nodes, from counts per node."""
    outline = json.loads(rows["reference"].iloc[0])
    flat: list[tuple[str, int, list[int]]] = []

    def number(part: list) -> int:
        own = len(flat)
        flat.append((part[0].split("|")[0], part[1], []))
        flat[own][2].extend(number(child) for child in part[2])
        return own

    number(outline)
    counts = rows.set_index("node")[["pages", "texts", "letters"]].to_dict("index")
    most = max(c["pages"] for c in counts.values())
    constant = {n for n, c in counts.items() if c["texts"] == 1 and c["letters"] and most >= 5 and c["pages"] == most}
    mass, article = [0.0] * len(flat), [0.0] * len(flat)  # article: of the largest article or main element in it
    for node in range(len(flat) - 1, -1, -1):
        tag, noise, children = flat[node]
        own = counts.get(node)
        varying = own["letters"] if own and node not in constant else 0
        mass[node] = 0 if noise else varying + sum(mass[c] for c in children)
        if not noise:
            article[node] = mass[node] if tag in ("article", "main") else max((article[c] for c in children), default=0)
    at = 0
    while mass[0]:
        # Only an article or main element may leave varying text outside.
        able = [c for c in flat[at][2] if flat[c][0] in HOLDERS and (mass[c] == mass[at] or article[c] >= 0.9 * mass[0])]
        heads = [c for c in flat[at][2] if mass[c] and c not in able and flat[c][0] in ("h1", "h2", "h3")]
        if not able or heads or flat[at][0] in ("article", "main"):
            break
        at = able[0]
    template = sorted(constant) if mass[0] else []
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "reference": [json.dumps(outline)], "holder": [at], "template": [template]})


def wrappers(pages: DataFrame) -> DataFrame:
    """host, reference (outline), holder (its node; 0: none), template (its constant nodes), for each host."""
    folder = workspace(pages.sparkSession)
    outlines = pages.select(host_of().alias("host"), "html").mapInArrow(_outlines, "host string, outline string, prints array<long>, lengths array<long>")
    outlines = settle(outlines, folder, "outlines")
    # The most frequent outline of a host is its reference.
    kinds = outlines.groupBy("host", "outline").agg(F.count("*").alias("pages"))
    references = kinds.groupBy("host").agg(F.max_by("outline", F.struct("pages", "outline")).alias("reference"))
    references = settle(references, folder, "references")
    nodes = outlines.join(references, "host").mapInArrow(_aligned, "host string, node int, print long, length long")
    texts = nodes.groupBy("host", "node", "print").agg(F.count("*").alias("pages"), F.sum("length").alias("letters"))
    counts = texts.groupBy("host", "node").agg(
        F.sum("pages").alias("pages"), F.count("*").alias("texts"), F.sum("letters").alias("letters")
    )
    # A group is the nodes of one outline, however many pages the host has.
    return counts.join(references, "host").groupBy("host").applyInPandas(
        _wrapper, "host string, reference string, holder int, template array<int>"
    )


def _fallback(root: Node) -> list[Node]:
    waiting, body = [root], [root]
    found: dict[str, list[Node]] = {"article": [], "main": [], "body": []}
    while waiting:
        node = waiting.pop()
        if node.tag in found and not node.noise:
            found[node.tag].append(node)
            if node.tag != "body":
                continue
        waiting.extend(p for p in reversed(node.parts) if isinstance(p, Node) and not p.noise)
    return found["article"] or found["main"] or found["body"] or body


def main_text(page: str | None, reference: str | None, holder: int | None, template: list[int] | None, known: dict) -> str:
    root = parse(page)
    nodes: list[Node] = []
    dropped: set[int] = set()
    if reference and holder:
        shapes = _preorder(shape := Shape([root]))
        _, pairs = match(shape.outline(), json.loads(reference), known)
        constant = set(template or ())
        nodes = [n for own, node in pairs if node == holder for n in shapes[own].nodes]
        dropped = {id(n) for own, node in pairs if node in constant for n in shapes[own].nodes if not shapes[own].children}
        if nodes and nodes[0].tag not in ("article", "main"):
            inside = {id(s) for own, node in pairs if node == holder for s in _preorder(shapes[own])}
            for own, node in pairs:
                if node in constant and id(shapes[own]) not in inside:
                    for n in shapes[own].nodes:  # its own text is template, not that of its blocks
                        n.parts = [p for p in n.parts if isinstance(p, Node) and (p.tag in BLOCKS or p.noise)]
            nodes = [root]
    return text_of(nodes, dropped) or text_of(_fallback(root))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("html", "reference", "holder", "template")))
        texts = [main_text(*row, known) for row in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row; blocks of text joined by a line feed.

    A null or empty page gives an empty text. Pages without a host, null urls
    too, count as pages of one host. A page without peers, or unlike them, gives
    its article, main or body element without noise. Repeated rows are kept.
    Text without a telling name is template only if the same on all of at least
    5 pages of a host; a host of fewer keeps it.
    Columns other than page_id, url and html are not looked at.
    """
    folder = workspace(pages.sparkSession)
    rules = settle(wrappers(pages.select("url", "html")), folder, "wrappers")
    hosted = pages.select("page_id", "url", "html", host_of().alias("host"))
    kinds = {f.name: f.dataType.simpleString() for f in hosted.schema}
    out = hosted.join(rules, "host", "left").mapInArrow(_extract, f"page_id {kinds['page_id']}, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
