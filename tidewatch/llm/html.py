"""Main text of web pages by wrapper induction over the pages of a host.

A page becomes the whole tree of its block elements (scripts, styles and the like out). Pages of a host with the same set of
label paths are a layout; layouts of under ``MIN_PAGES`` different pages go with the host's largest one. The trees of a layout
are aligned with one of them, its reference, by simple tree matching; every page but copies of another one votes on which of the
reference's nodes hold the same text. Nodes that are constant in ``CONSTANT`` of at least ``MIN_PAGES`` pages are template
and go, everything that varies is content, wherever it stands, but for marked slots: elements whose tag, role, or one whole
class or id says that they are menus, headers, footers, sidebars, notices, adverts, forms or comments. An element that
holds an article or the main part is never marked, nor is a form that holds sections of the page.

Where votes have no evidence (fewer pages, no host, or no unmarked text that varies: near copies) marks decide alone: unmarked
text counts, of a main part only what is in it, and only articles where these hold most of that text. Pages of a host are
joined with their reference row by row, and votes are summed up before they meet, so a host may hold most of the pages.

Character references are decoded, white space inside a block becomes one space, blocks are joined by line feeds in
page order, nothing else is left out. A null or empty page gives an empty text; a page without a host (null or odd urls) is
taken by itself. Rows are extracted one by one, so repeated rows and ids stay; other columns are not read.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import words as W
from tidewatch.session import stage

CONSTANT, MIN_PAGES = 0.9, 5

TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^"'>])*)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in ("script", "style", "noscript", "textarea", "title", "iframe", "template", "svg")}
#: Of these, the ones whose tag is ignored if they have no end.
SPARED = frozenset("noscript svg template".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var".split()
)
#: Open elements that the start of another one ends, and the elements beyond which it doesn't look.
ENDED_BY_BLOCK = frozenset({"p"})
ENDED = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
SCOPES = frozenset("ul ol dl table article section main body div nav aside select".split())
CUT_TAGS = frozenset("head nav footer aside form button select input dialog menu canvas object".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
CUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices notification popup modal "
    "overlay comment comments disqus reply replies share sharing social related recommended recommendations newsletter "
    "subscribe subscription signup login search pagination pager widget toolbar copyright".split()
)
#: Marked outside of an article only, where they hold its title.
HEADERS = frozenset({"header"})
#: What marks an article: its other names are often those of its subjects.
REMARKS = frozenset("comment comments reply replies".split())
#: A form around any of these is the page's own.
SECTIONS = frozenset("header nav main article section aside footer h1".split())


class Node:
    """``mark`` is the element's own; ``holds`` an article or main part, ``sections`` sections of the page."""

    __slots__ = ("tag", "label", "parts", "article", "main", "mark", "holds", "sections")

    def __init__(self, tag: str, label: str, article: bool, main: bool, mark: bool):
        self.tag, self.label, self.article, self.main, self.mark = tag, label, article, main, mark
        self.holds = self.sections = False
        self.parts: list[Node | list[str]] = []

    @property
    def cut(self) -> bool:
        return self.mark and not self.holds and not (self.tag == "form" and self.sections)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): references.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _open(tag: str, attributes: dict[str, str], stack: list[Node]) -> Node:
    inside = stack[-1]
    names = set(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split())
    role = attributes.get("role", "").lower()
    whole = tag in ("html", "body")  # their classes name states of the page
    own, main = tag == "article" or attributes.get("itemprop") == "articleBody", tag == "main" or role == "main"
    mark = tag in CUT_TAGS or role in CUT_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true"
    mark = mark or "display:none" in attributes.get("style", "").replace(" ", "").lower()
    mark = mark or not whole and bool(names & (REMARKS if own or main else CUT_NAMES))
    mark = mark or not inside.article and not whole and not own and not main and (tag == "header" or bool(names & HEADERS))
    if main or own and not mark:
        for node in reversed(stack):
            if node.holds:
                break
            node.holds = True
    if tag in SECTIONS:
        for node in reversed(stack):
            if node.sections:
                break
            node.sections = True
    # names with digits are those of one page, and so are those of an article's subjects
    shown = [] if whole or own else sorted(x for x in names if not any(map(str.isdigit, x)))
    return Node(tag, f"{tag}.{'.'.join(shown)}", inside.article or own, inside.main or main, mark)


def parse(page: str) -> Node:
    """The tree of block elements; text runs stand between them, as lists of pieces."""
    root = Node("", "", False, False, False)
    stack, at, endless = [root], 0, set()

    def text(piece: str) -> None:
        if piece:
            parts = stack[-1].parts
            if not parts or isinstance(parts[-1], Node):
                parts.append([])
            parts[-1].append(piece)

    while True:
        m = TAG.search(page, at)
        if m is None:
            text(references.unescape(page[at:]) if "&" in page[at:] else page[at:])
            return root
        if m.start() > at:
            piece = page[at : m.start()]
            text(references.unescape(piece) if "&" in piece else piece)
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # an end
            if tag not in INLINE:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
                    if tag in ("p", "li") and stack[k].tag in SCOPES:
                        break
            continue
        if tag in RAW:
            if tag == "svg" and (m[3] or m[6] or "").endswith("/") or tag in endless:
                continue
            end = RAW[tag].search(page, at)
            if end is None and tag in SPARED:
                endless.add(tag)  # there is none further on, either
                continue
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in INLINE:
            continue
        ended = ENDED.get(tag, ()) or ENDED_BY_BLOCK
        low = len(stack)
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in ended or stack[k].tag in ENDED_BY_BLOCK:
                low = k
            elif stack[k].tag in SCOPES:
                break
        del stack[low:]
        if tag in VOID:
            if tag == "hr":
                stack[-1].parts.append(Node(tag, tag, stack[-1].article, stack[-1].main, True))
            continue
        attributes = _attributes(m[3] or m[6] or "")
        node = _open(tag, attributes, stack)
        stack[-1].parts.append(node)
        if not (m[3] or m[6] or "").endswith("/"):
            stack.append(node)


#: What a node is: in a marked element; unmarked; of these, what counts where there are no votes.
MARKED, OPEN, ALONE = "012"


def flatten_all(root: Node) -> tuple[list[int], list[str], list[str], list[str]]:
    """Parents, labels, texts and kinds of all nodes in page order; the first node is the root.

    An element with one run of text and no blocks has it as its own; other runs are nodes of their own.
    """
    nodes, order = [], [(root, -1, root, False)]
    while order:  # in page order
        node, parent, holder, marked = order.pop()
        if isinstance(node, list):
            nodes.append((parent, "#", " ".join("".join(node).split()), holder, marked))
            continue
        marked = marked and not node.holds or node.cut
        own = len(nodes)
        runs = [p for p in node.parts if isinstance(p, Node) or any(x.strip() for x in p)]
        if len(runs) == 1 and isinstance(runs[0], list):
            nodes.append((parent, node.label, " ".join("".join(runs[0]).split()), node, marked))
        else:
            nodes.append((parent, node.label, "", node, marked))
            order += ((p, own, node, marked) for p in reversed(runs))
    counts = [not n[4] for n in nodes]
    size = lambda chosen: sum(len(n[2]) for n, c in zip(nodes, chosen, strict=True) if c)
    inside = [c and n[3].main for n, c in zip(nodes, counts, strict=True)]
    counts = inside if size(inside) else counts
    inside = [c and n[3].article for n, c in zip(nodes, counts, strict=True)]
    counts = inside if 2 * size(inside) > size(counts) else counts
    kinds = [MARKED if n[4] else ALONE if c else OPEN for n, c in zip(nodes, counts, strict=True)]
    return [n[0] for n in nodes], [n[1] for n in nodes], [n[2] for n in nodes], kinds


def flatten(root: Node) -> tuple[list[int], list[str], list[str]]:
    """Parents, labels and texts of the nodes, with the texts that count where there are no votes."""
    parents, labels, texts, kinds = flatten_all(root)
    return parents, labels, [t if k == ALONE else "" for t, k in zip(texts, kinds, strict=True)]


def _number(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) >> 1


def layout(parents: list[int], labels: list[str]) -> int:
    """A hash of the set of label paths."""
    paths: list[int] = []
    known: dict[tuple[int, str], int] = {}
    for parent, label in zip(parents, labels, strict=True):
        step = (paths[parent] if parent >= 0 else 0, label)
        if step not in known:
            known[step] = _number(f"{step[0]} {label}")
        paths.append(known[step])
    return _number(" ".join(map(str, sorted(set(known.values())))))


def pack_tree(parents: list[int], labels: list[str], texts: list[str], kinds: list[str] | None = None) -> bytes:
    """Parent, label hash, text hash and length of unmarked text of each node."""
    sizes = [0 if k == MARKED else len(x) for x, k in zip(texts, kinds or [OPEN] * len(texts), strict=True)]
    rows = [[p + 1 for p in parents], [_number(x) for x in labels], [_number(x) if x else 0 for x in texts], sizes]
    return pa.compress(np.array(rows, np.int64).tobytes(), "zstd", asbytes=True) + len(parents).to_bytes(4, "little")


class Tree:
    def __init__(self, packed: bytes):
        n = int.from_bytes(packed[-4:], "little")
        parents, self.labels, self.texts, self.sizes = (
            np.frombuffer(pa.decompress(packed[:-4], n * 32, "zstd", asbytes=True), np.int64).reshape(4, n).tolist()
        )
        self.children: list[list[int]] = [[] for _ in range(n)]
        for node, parent in enumerate(parents):
            if parent:
                self.children[parent - 1].append(node)
        #: Hash of the labels in each subtree and how they are nested, and its number of nodes. Children come after their parents.
        self.shapes, self.nodes = [0] * n, [1] * n
        for node in reversed(range(n)):
            kids = self.children[node]
            self.shapes[node] = hash((self.labels[node], *(self.shapes[k] for k in kids)))
            self.nodes[node] += sum(self.nodes[k] for k in kids)


#: Cells of a table that is kept whole; larger ones are halved, so that memory grows with a row.
TABLE = 1 << 10


def _last_row(weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The weight of the heaviest matching in order of all of ``x`` with every beginning of ``y``."""
    row = np.zeros(len(y) + 1, np.int64)
    for i in x.tolist():
        row[1:] = np.maximum(row[1:], row[:-1] + weights[i][y])
        np.maximum.accumulate(row, out=row)
    return row


def _in_order(weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Places in two sequences of classes that the heaviest matching in order pairs; ``weights`` are those of two classes."""
    todo, pairs = [(0, len(x), 0, len(y))], []
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if (b - a) * (d - c) <= TABLE or b - a == 1:
            table = [np.zeros(d - c + 1, np.int64)]
            for i in x[a:b].tolist():
                row = table[-1].copy()
                row[1:] = np.maximum(row[1:], row[:-1] + weights[i][y[c:d]])
                table.append(np.maximum.accumulate(row))
            i, j = b - a, d - c
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((a + i, c + j))
            continue
        middle = (a + b) // 2
        upper, lower = _last_row(weights, x[a:middle], y[c:d]), _last_row(weights, x[middle:b][::-1], y[c:d][::-1])
        cut = c + int((upper + lower[::-1]).argmax())
        todo += [(a, middle, c, cut), (middle, b, cut, d)]
    return pairs


class _Matching:
    """Simple tree matching of two trees, without recursion: nodes of equal subtrees are paired at once, sizes are kept by pair of shapes."""

    def __init__(self, a: Tree, b: Tree):
        self.a, self.b = a, b
        self.known: dict[tuple[int, int], int] = {}

    def ends(self, x: int, y: int) -> tuple[list[int], list[int], int, int]:
        """The children of two nodes, and how many at the beginning and at the end are equal subtrees."""
        kids_a, kids_b = self.a.children[x], self.b.children[y]
        head, most = 0, min(len(kids_a), len(kids_b))
        while head < most and self.a.shapes[kids_a[head]] == self.b.shapes[kids_b[head]]:
            head += 1
        tail = 0
        while tail < most - head and self.a.shapes[kids_a[-1 - tail]] == self.b.shapes[kids_b[-1 - tail]]:
            tail += 1
        return kids_a, kids_b, head, tail

    def middle(self, x: int, y: int):
        """Children between equal ends, their classes, and a node of each class."""
        kids_a, kids_b, head, tail = self.ends(x, y)
        kids_a, kids_b = kids_a[head : len(kids_a) - tail], kids_b[head : len(kids_b) - tail]
        if not kids_a or not kids_b:
            return kids_a, kids_b, [], [], None, None
        first_a, first_b = {self.a.shapes[k]: k for k in reversed(kids_a)}, {self.b.shapes[k]: k for k in reversed(kids_b)}
        of_a, of_b = ({shape: i for i, shape in enumerate(first)} for first in (first_a, first_b))
        classes_a = np.array([of_a[self.a.shapes[k]] for k in kids_a])
        classes_b = np.array([of_b[self.b.shapes[k]] for k in kids_b])
        return kids_a, kids_b, list(first_a.values()), list(first_b.values()), classes_a, classes_b

    def size(self, x: int, y: int) -> int | None:
        """The size of the matching of two nodes if it is known or plain."""
        if self.a.labels[x] != self.b.labels[y]:
            return 0
        if self.a.shapes[x] == self.b.shapes[y]:
            return self.a.nodes[x]
        if not self.a.children[x] or not self.b.children[y]:
            return 1
        return self.known.get((self.a.shapes[x], self.b.shapes[y]))

    def weights(self, nodes_a: list[int], nodes_b: list[int]) -> np.ndarray:
        return np.array([[self.size(i, j) for j in nodes_b] for i in nodes_a], np.int64)

    def measure(self, x: int, y: int) -> int:
        """The size of the matching of two nodes; what it needs is measured first, on a stack."""
        stack = [(x, y)]
        while stack:
            i, j = stack[-1]
            if self.size(i, j) is not None:
                stack.pop()
                continue
            kids_a, kids_b, nodes_a, nodes_b, classes_a, classes_b = self.middle(i, j)
            open_ = [(p, q) for p in nodes_a for q in nodes_b if self.size(p, q) is None]
            if open_:
                stack += open_
                continue
            stack.pop()
            all_a, _, head, tail = self.ends(i, j)
            equal = sum(self.a.nodes[k] for k in all_a[:head] + all_a[len(all_a) - tail :])
            best = int(_last_row(self.weights(nodes_a, nodes_b), classes_a, classes_b)[-1]) if nodes_a else 0
            self.known[self.a.shapes[i], self.b.shapes[j]] = 1 + equal + best
        return self.size(x, y)

    def pairs(self, x: int, y: int) -> list[tuple[int, int]]:
        out, stack = [], [(x, y)] if self.measure(x, y) else []
        while stack:
            i, j = stack.pop()
            out.append((i, j))
            if self.a.shapes[i] == self.b.shapes[j]:
                stack += zip(self.a.children[i], self.b.children[j], strict=True)
                continue
            all_a, all_b, head, tail = self.ends(i, j)
            stack += zip(all_a[:head], all_b[:head], strict=True)
            stack += zip(all_a[len(all_a) - tail :], all_b[len(all_b) - tail :], strict=True)
            kids_a, kids_b, nodes_a, nodes_b, classes_a, classes_b = self.middle(i, j)
            if nodes_a:
                stack += ((kids_a[p], kids_b[q]) for p, q in _in_order(self.weights(nodes_a, nodes_b), classes_a, classes_b))
        return out


def match(a: Tree, b: Tree, x: int = 0, y: int = 0) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two nodes: the size of the largest matching that keeps order and parents, and its pairs.

    Neither depth nor length is cut. Equal subtrees at the ends of two lists of children are paired at once, which no other
    matching beats. Of the rest, children of one shape are one class, and a list is aligned by rows: memory grows with the number of
    children and of pairs of different shapes, time with the product of the rests.
    """
    pairs = _Matching(a, b).pairs(x, y)
    return len(pairs), pairs


def _host(url: str):
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)), F.lit(""))


def _trees(pages: DataFrame, key: str, url: str, html: str, blocks: bool) -> DataFrame:
    """``id, url, host, layout, tree`` and, if asked for, the compressed ``blocks`` of every page (a line of kinds, then the texts);
    trees are null without any text."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "html", W.BLOCK_BYTES // 4):
            trees, layouts, bodies = [], [], []
            for page in block.column("html").to_pylist():
                parents, labels, texts, kinds = flatten_all(parse(page or ""))
                trees.append(pack_tree(parents, labels, texts, kinds) if any(texts) else None)
                layouts.append(layout(parents, labels))
                body = "\n".join(["".join(kinds), *texts]).encode() if any(texts) else b""
                bodies.append(len(body).to_bytes(4, "little") + (pa.compress(body, "zstd", asbytes=True) if body else b""))
            columns = [block.column(c) for c in ("id", "url", "host")] + [pa.array(layouts, pa.int64()), pa.array(trees, pa.binary())]
            names = ["id", "url", "host", "layout", "tree"]
            if blocks:
                columns, names = [*columns, pa.array(bodies, pa.binary())], [*names, "blocks"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), _host(url).alias("host"), F.col(html).alias("html"))
    return rows.mapInArrow(run, f"id {kind}, url string, host string, layout long, tree binary" + ", blocks binary" * blocks)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page and node of its reference: whether their texts are equal, and how long the page's unmarked one is.

    Node -1 has the text of what matches no node of the reference.
    """
    for batch in batches:
        rows, last, reference = [], None, None
        for host, shape, tree, packed in zip(*(batch.column(c).to_pylist() for c in ("host", "wrapper", "tree", "reference")), strict=True):
            if packed != last:
                last, reference = packed, Tree(packed)
            page = Tree(tree)
            pairs = match(page, reference)[1]
            rows += (
                (host, shape, y, int(page.texts[x] == reference.texts[y]), page.sizes[x])
                for x, y in pairs if page.texts[x] or reference.texts[y]
            )
            rows.append((host, shape, -1, 0, sum(page.sizes) - sum(page.sizes[x] for x, _ in pairs)))
        if rows:
            names = ["host", "wrapper", "node", "same", "size"]
            columns = zip(names, zip(*rows, strict=True), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "host" else pa.int64()) for n, c in columns], names)


def templates(trees: DataFrame) -> DataFrame:
    """``host, layout, reference, constant``: the template nodes of each layout's reference page, where votes have evidence."""
    known = stage(trees.filter("host IS NOT NULL AND tree IS NOT NULL").select("host", "layout", "id", "tree"), "trees")
    different = known.select("host", "layout", F.xxhash64("tree").alias("tree")).distinct()
    # written, so that joins with them can be split where a host is hot
    layouts = stage(different.groupBy("host", "layout").agg(F.count("*").alias("n")), "layouts")
    largest = layouts.groupBy("host").agg(F.max(F.struct("n", "layout")).alias("most"))
    largest = stage(largest.select("host", F.col("most.layout").alias("largest")), "largest")
    wrapper = F.when(F.col("n") >= MIN_PAGES, F.col("layout")).otherwise(F.col("largest")).alias("wrapper")
    layouts = stage(layouts.join(largest, "host").select("host", "layout", wrapper), "wrappers")
    first = known.groupBy("host", "layout").agg(F.min(F.struct("id", "tree")).alias("r"))
    first = first.select("host", F.col("layout").alias("wrapper"), F.col("r.tree").alias("reference"))
    references_ = stage(first.join(layouts.select("host", "wrapper").distinct(), ["host", "wrapper"]), "references")

    different = known.select("host", "layout", "tree").distinct()  # a copy has no vote of its own
    votes = different.join(layouts, ["host", "layout"]).join(references_, ["host", "wrapper"])
    votes = votes.mapInArrow(_votes, "host string, wrapper long, node long, same long, size long")
    nodes = votes.groupBy("host", "wrapper", "node").agg(F.count("*").alias("n"), F.sum("same").alias("same"), F.sum("size").alias("size"))
    constant = (F.col("node") >= 0) & (F.col("n") >= MIN_PAGES) & (F.col("same") >= CONSTANT * F.col("n"))
    found = nodes.groupBy("host", "wrapper").agg(
        F.array_compact(F.collect_list(F.when(constant, F.col("node")))).alias("constant"),
        F.sum(F.when(constant, 0).otherwise(F.col("size"))).alias("varying"),
        F.max(F.when(F.col("node") < 0, F.col("n"))).alias("pages"),
    )
    found = found.filter((F.col("pages") >= MIN_PAGES) & (F.col("varying") > 0))
    found = stage(found.join(references_, ["host", "wrapper"]).select("host", "wrapper", "reference", "constant"), "found")
    return layouts.join(found, ["host", "wrapper"]).select("host", "layout", "reference", "constant")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row ``key, url, text, n_chars``; the templates are made when this is called."""
    found = stage(templates(_trees(pages, key, url, html, False)), "templates")
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            columns = (batch.column(c).to_pylist() for c in ("tree", "blocks", "reference", "constant"))
            for tree, blocks, reference, constant in zip(*columns, strict=True):
                size = int.from_bytes(blocks[:4], "little")
                kinds, *lines = pa.decompress(blocks[4:], size, "zstd", asbytes=True).decode().split("\n") if size else [""]
                voted = constant is not None and tree is not None
                lines = [t if k == ALONE or voted and k == OPEN else "" for t, k in zip(lines, kinds, strict=True)]
                if voted:
                    gone = set(constant)
                    for x, y in match(Tree(tree), Tree(reference))[1]:
                        if y in gone:
                            lines[x] = ""
                texts.append("\n".join(x for x in lines if x))
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), lengths], [key, "url", "text", "n_chars"])

    rows = _trees(pages, key, url, html, True).join(found, ["host", "layout"], "left")
    return rows.mapInArrow(run, f"`{key}` {kind}, url string, text string, n_chars long")
