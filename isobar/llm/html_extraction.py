"""Main text of web pages by wrapper induction.

The pages of a host are told apart by layout, and each layout has a reference page, its
smallest. The tree of every page is aligned with that of its reference by simple tree
matching: the largest mapping that keeps the order of children and matches only nodes
whose parents match. A block of text thereby gets a slot, the reference node it is matched
to; a block that matches nothing has the path of its tags for one. Slots that hold the same
text on most of the distinct pages that have them are template, as far as so many pages
can prove it; slots whose text varies are content. Elements that say by their tag or role
what they are (menus, footers, forms and the like) are template anyway; names of classes
and ids only count for elements without an article and without most of the text.

Counts cover all pages of a host and are added up by Spark. A hot host is split like any
other: a page meets only its layout's reference tree and its layout's template slots.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.arrow import chunks, ship_package
from isobar.storage import materialise

#: A slot is template if it holds one text on more than this share of the distinct pages that
#: have the slot, with this certainty (standard errors of a share). All of seven pages do.
SHARE, CERTAINTY = 0.5, 2.58
#: Elements nested deeper become children of the last one above; their text stays where theirs would.
DEEPEST = 400
#: Cells of an alignment that are kept to trace it back; a larger one is halved first.
PAIRS = 250_000
#: References that a task gathers before it hands them on.
_GATHERED = 1000

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|aria-hidden|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td"
    " tfoot th thead tr ul".split()
)
#: An open element of these kinds ends where one of the others begins.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
_SCOPE = frozenset("table ul ol dl select body html article main div section nav aside footer header form".split())
_DROPPED_TAGS = frozenset(
    "nav footer aside form button select option label input menu dialog canvas object audio video head".split()
)
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Words of class and id names that speak against an element, and first words
# after which a name says that something else is there.
_DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation"
    " menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent notice gdpr popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended recommendations"
    " comment comments disqus respond replies widget toolbar pagination pager skip".split()
)
_ABOUT_OTHERS = frozenset("has have no not with without hide show is".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Node:
    tag: str
    dropped: bool = False
    children: list = field(default_factory=list)  # nodes and texts
    shape: int = 0
    hinted: bool = False  # its names speak against it
    names: str = ""


def _attributes(source: str) -> dict[str, str]:
    found = {}
    for name, *values in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), next((v for v in values if v), ""))
    return found


def _judged(tag: str, source: str, inside: bool) -> Node:
    """An element, dropped if its tag or role says that it is none of the article, hinted if its
    names do. ``inside``: it lies in an article."""
    node = Node(tag, tag in _DROPPED_TAGS or tag == "header" and not inside)
    if node.dropped or tag in ("html", "body") or not source:
        return node
    attributes = _attributes(source)
    node.names = attributes.get("class", "")
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        node.dropped = True
    elif re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")):
        node.dropped = True
    elif attributes.get("role", "").lower() in _DROPPED_ROLES:
        node.dropped = True
    elif tag not in ("article", "main"):
        for name in f"{node.names} {attributes.get('id', '')}".split():
            words = [word.lower() for word in _WORDS.findall(name)]
            if words and words[0] not in _ABOUT_OTHERS and (_DROPPED_WORDS & set(words) or "header" in words and not inside):
                node.hinted = True
    return node


def _settle(root: Node) -> None:
    """Drop what is only hinted at, unless it holds an article or most of the text."""
    held: dict[int, tuple[int, bool]] = {}

    def look(node: Node) -> tuple[int, bool]:
        size, article = 0, node.tag in ("article", "main")
        for child in node.children:
            if isinstance(child, str):
                size += len(child.strip())
            elif not child.dropped:
                more, holds = look(child)
                size, article = size + more, article or holds
        held[id(node)] = size, article
        return size, article

    total, _ = look(root)

    def judge(node: Node) -> None:
        for child in _nodes(node):
            if not child.dropped:
                size, article = held[id(child)]
                child.dropped = child.hinted and not article and 2 * size <= total
                if not child.dropped:
                    judge(child)

    judge(root)


def parse(source: str) -> Node:
    """A tree of elements and texts; markup that is not closed ends with its parent.

    The source is scanned once: markup that is still open where no ``>`` follows is text.
    """
    root = Node("#root")
    stack, inside = [root], [False]
    at, size, last = 0, len(source), source.rfind(">")
    beyond = 0  # where the stack has a judged element that lies too deep, if it has
    comment = re.compile(r"<!--")
    while at < size:
        match = _TOKEN.search(source, at) if at <= last else None
        if match is None:
            # An open comment hides what follows it, all else is text.
            hidden = comment.search(source, at)
            stack[-1].children.append(source[at : hidden.start() if hidden else size])
            break
        if match.start() > at:
            stack[-1].children.append(source[at : match.start()])
        at = match.end()
        closing, name, rest = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if not name:
            continue
        tag = name.lower()
        # How far a tag looks back; elements further up are left open.
        reach = range(len(stack) - 1, max(0, len(stack) - 1 - DEEPEST), -1)
        if closing:
            for depth in reach:
                if stack[depth].tag == tag:
                    del stack[depth:], inside[depth:]
                    break
                if stack[depth].tag in _SCOPE and tag not in _SCOPE:
                    break
            continue
        if tag in _RAW:
            if not rest.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b", re.I).search(source, at)
                close = source.find(">", end.end()) if end else -1
                at = close + 1 if close >= 0 else size
            continue
        ends = {"p"} if tag in _BLOCK else _ENDS.get(tag, ())
        ends = ends | _ENDS[tag] if tag in _ENDS and ends else ends
        if ends:
            for depth in reach:
                if stack[depth].tag in ends:
                    del stack[depth:], inside[depth:]
                    break
                if stack[depth].tag in _SCOPE:
                    break
        node = _judged(tag, rest, inside[-1])
        stack[-1].children.append(node)
        if tag not in _VOID and not rest.endswith("/"):
            if len(stack) > DEEPEST:
                # Too deep for a level of its own: what it holds goes on in the one above. One
                # level more is made for an element that may be dropped.
                beyond = beyond if beyond < len(stack) else 0
                if (node.dropped or node.hinted) and not beyond:
                    beyond = len(stack)
                else:
                    node = Node(tag, children=stack[-1].children)
            stack.append(node)
            inside.append(inside[-1] or tag in ("article", "main"))
    _settle(root)
    return root


def _nodes(node: Node) -> list[Node]:
    return [child for child in node.children if not isinstance(child, str)]


def _shaped(node: Node) -> int:
    """Set each node's shape: equal trees of tags have equal numbers."""
    node.shape = hash((node.tag, tuple(_shaped(child) for child in _nodes(node))))
    return node.shape


def skeleton(node: Node) -> list:
    """The tree of tags alone, as nested lists."""
    return [node.tag, *(skeleton(child) for child in _nodes(node))]


class Reference:
    """A reference tree: for each node its tag, children, place in page order and size."""

    def __init__(self, tree: list):
        self.tags: list[str] = []
        self.children: list[list[int]] = []
        self.shapes: list[int] = []
        self._add(tree)

    def _add(self, tree: list) -> int:
        place = len(self.tags)
        self.tags.append(tree[0])
        self.children.append([])
        self.shapes.append(0)
        self.children[place] = [self._add(child) for child in tree[1:]]
        self.shapes[place] = hash((tree[0], tuple(self.shapes[c] for c in self.children[place])))
        return place


class Matching:
    """Simple tree matching of a page with a reference."""

    def __init__(self, reference: Reference):
        self._reference = reference
        self._known: dict[tuple[int, int], int] = {}

    def size(self, node: Node, place: int) -> int:
        """Nodes in the largest mapping of two trees."""
        reference = self._reference
        if node.tag != reference.tags[place]:
            return 0
        key = node.shape, reference.shapes[place]
        if key not in self._known:
            own, others = _nodes(node), reference.children[place]
            self._known[key] = 1 + (self._total(own, others) if own and others else 0)
        return self._known[key]

    def _weights(self, own: list[Node], others: list[int]) -> Iterator[np.ndarray]:
        """For each own child its size with each of the others."""
        shapes = [self._reference.shapes[place] for place in others]
        kinds = {shape: place for shape, place in zip(shapes, others, strict=True)}
        number = {shape: i for i, shape in enumerate(kinds)}
        which = np.array([number[shape] for shape in shapes])
        known: dict[int, np.ndarray] = {}
        for node in own:
            if node.shape not in known:
                known[node.shape] = np.array([self.size(node, place) for place in kinds.values()], dtype=np.int64)[which]
            yield known[node.shape]

    def _rows(self, own: list[Node], others: list[int]) -> Iterator[np.ndarray]:
        """The rows of the alignment's table, of which each needs only the one above."""
        above = np.zeros(len(others) + 1, dtype=np.int64)
        for weights in self._weights(own, others):
            row = above.copy()
            np.maximum(row[1:], above[:-1] + np.where(weights > 0, weights, 0), out=row[1:])
            above = np.maximum.accumulate(row)
            yield above

    def _total(self, own: list[Node], others: list[int]) -> int:
        last = None
        for last in self._rows(own, others):
            pass
        return int(last[-1])

    def mapping(self, node: Node, place: int, out: dict[int, int]) -> None:
        """Fill ``out`` with the reference place of each matched node, by its identity."""
        out[id(node)] = place
        own, others = _nodes(node), self._reference.children[place]
        if not own or not others:
            return
        for child, other in self._pairs(own, others):
            self.mapping(child, other, out)

    def _pairs(self, own: list[Node], others: list[int]) -> list[tuple[Node, int]]:
        """The pairs of a largest alignment, whatever the number of children."""
        before, after = [], []
        same = lambda node, place: node.shape == self._reference.shapes[place]
        # Equal trees at either end are best matched with each other.
        first = 0
        while first < min(len(own), len(others)) and same(own[first], others[first]):
            before.append((own[first], others[first]))
            first += 1
        own, others = own[first:], others[first:]
        stop = 0
        while stop < min(len(own), len(others)) and same(own[-1 - stop], others[-1 - stop]):
            after.append((own[-1 - stop], others[-1 - stop]))
            stop += 1
        own, others = own[: len(own) - stop], others[: len(others) - stop]
        return before + self._between(own, others) + after[::-1]

    def _between(self, own: list[Node], others: list[int]) -> list[tuple[Node, int]]:
        if not own or not others:
            return []
        if len(own) > 1 and len(own) * len(others) > PAIRS:
            middle = len(own) // 2
            upper = lower = None
            for upper in self._rows(own[:middle], others):
                pass
            for lower in self._rows(own[middle:][::-1], others[::-1]):
                pass
            cut = int(np.argmax(upper + lower[::-1]))
            return self._between(own[:middle], others[:cut]) + self._between(own[middle:], others[cut:])
        rows = [np.zeros(len(others) + 1, dtype=np.int64), *self._rows(own, others)]
        pairs, i, j = [], len(own), len(others)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                pairs.append((own[i - 1], others[j - 1]))
                i, j = i - 1, j - 1
        return pairs[::-1]


def _text_size(node: Node) -> int:
    return sum(
        len(child.strip()) if isinstance(child, str) else 0 if child.dropped else _text_size(child)
        for child in node.children
    )


def main_parts(root: Node) -> tuple[list[Node], bool]:
    """The outermost main elements and articles in page order, and whether there are any with
    text; else the whole page."""
    found: list[Node] = []

    def look(node: Node) -> None:
        for child in _nodes(node):
            if not child.dropped:
                if child.tag in ("article", "main"):
                    found.append(child)
                else:
                    look(child)

    look(root)
    parts = [part for part in found if _text_size(part)]
    return (parts, True) if parts else ([root], False)


def layout(root: Node) -> int:
    """A number that pages of one layout share: what lies side by side where the page first branches."""
    node, seen = root, []
    while True:
        below = [child for child in _nodes(node) if child.tag != "head"]
        seen.append(sorted({(child.tag, re.sub(r"[0-9]+", "", child.names)) for child in below}))
        if len(below) != 1:
            return zlib.crc32(json.dumps(seen).encode())
        node = below[0]


def text_blocks(part: Node, slots: dict[int, int]) -> list[tuple[int, str]]:
    """(slot, text) of each block in page order; one that is matched to nothing has a number
    below zero, made of the tags that lead to it."""
    blocks: list[tuple[int, str]] = []
    pieces: list[str] = []
    path: list[str] = []

    def flush(owner: Node) -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            blocks.append((slots.get(id(owner), -1 - zlib.crc32("/".join(path).encode())), text))

    def walk(node: Node, owner: Node) -> None:
        for child in node.children:
            if isinstance(child, str):
                pieces.append(child)
            elif child.tag in ("br", "wbr", "img"):
                pieces.append(" " if child.tag == "br" else "")
            elif not child.dropped:
                if child.tag in _BLOCK:
                    flush(owner)
                    path.append(child.tag)
                    walk(child, child)
                    flush(child)
                    path.pop()
                else:
                    walk(child, owner)
            elif child.tag in _BLOCK:
                flush(owner)

    walk(part, part)
    flush(part)
    return blocks


def page_blocks(source: str, reference: Reference | None, root: Node | None = None) -> tuple[list[tuple[int, str]], bool]:
    root = parse(source) if root is None else root
    parts, named = main_parts(root)
    slots: dict[int, int] = {}
    if reference is not None:
        _shaped(root)
        Matching(reference).mapping(root, 0, slots)
    return [block for part in parts for block in text_blocks(part, slots)], named


def _limit() -> None:
    import sys

    sys.setrecursionlimit(20_000)


def _count(tree: list) -> int:
    return 1 + sum(_count(child) for child in tree[1:])


def _references(pages: DataFrame) -> DataFrame:
    """(host, layout, tree): the tags of the smallest page with text of each layout of a host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _limit()
        best: dict[tuple[str, int], tuple[int, str]] = {}

        def gathered() -> pa.RecordBatch:
            columns = [[key[0] for key in best], [key[1] for key in best], *([v[i] for v in best.values()] for i in (0, 1))]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            best.clear()
            return pa.RecordBatch.from_arrays(arrays, ["host", "layout", "nodes", "tree"])

        for batch in chunks(batches, "html"):
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                root = parse(source or "")
                if not page_blocks("", None, root)[0]:
                    continue
                tree = skeleton(root)
                key, found = (host, layout(root)), (_count(tree), json.dumps(tree))
                # Of pages of one size, the same one is taken in every run.
                best[key] = min(best.get(key, found), found)
                if len(best) >= _GATHERED:
                    yield gathered()
        yield gathered()

    each = pages.select("host", "html").mapInArrow(run, "host string, layout bigint, nodes bigint, tree string")
    smallest = F.min(F.struct("nodes", "tree")).alias("smallest")
    return each.groupBy("host", "layout").agg(smallest).select("host", "layout", "smallest.tree")


def _with_layout(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _limit()
        for batch in chunks(batches, "html"):
            found = pa.array([layout(parse(source or "")) for source in batch.column("html").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "layout"])

    kind = pages.schema["id"].dataType.simpleString()
    return pages.select("id", "url", "host", "html").mapInArrow(
        run, f"id {kind}, url string, host string, html string, layout bigint"
    )


def _blocks(pages: DataFrame, references: DataFrame) -> DataFrame:
    """(id, url, host, layout, named, slots, texts) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _limit()
        known: dict[tuple, Reference] = {}
        for batch in chunks(batches, "html"):
            slots, texts, named = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("host", "layout", "tree", "html"))
            for host, number, tree, source in zip(*columns, strict=True):
                key = host, number
                if tree is not None and key not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[key] = Reference(json.loads(tree))
                blocks, says = page_blocks(source or "", known[key] if tree is not None else None)
                slots.append([slot for slot, _ in blocks])
                texts.append([text for _, text in blocks])
                named.append(says)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "url", "host", "layout")), pa.array(named, pa.bool_()),
                    pa.array(slots, pa.list_(pa.int64())), pa.array(texts, pa.list_(pa.string())),
                ],
                ["id", "url", "host", "layout", "named", "slots", "texts"],
            )

    joined = _with_layout(pages).join(references, ["host", "layout"], "left").select("id", "url", "host", "layout", "tree", "html")
    kind = joined.schema["id"].dataType.simpleString()
    return joined.mapInArrow(
        run,
        f"id {kind}, url string, host string, layout bigint, named boolean, slots array<bigint>, texts array<string>",
    )


def _proven_share(seen: Column, pages: Column, certainty: float) -> Column:
    """The lower end of the interval (Wilson's) that holds the true share of ``seen`` in ``pages``."""
    square = certainty * certainty
    share = seen / pages
    spread = certainty * F.sqrt(share * (1 - share) / pages + square / (4 * pages * pages))
    return (share + square / (2 * pages) - spread) / (1 + square / pages)


def _templates(blocks: DataFrame, share: float, certainty: float) -> DataFrame:
    """(host, layout, fixed): the (slot, text hash) pairs on most distinct pages with the slot."""
    # Copies of a page say nothing about a template, so each text of a host counts once.
    pairs = F.array_distinct(F.arrays_zip("slots", F.transform("texts", lambda t: F.xxhash64(t)).alias("hash")))
    distinct = blocks.select("host", "layout", F.xxhash64("texts").alias("page"), pairs.alias("pairs"))
    distinct = distinct.dropDuplicates(["host", "layout", "page"])  # the hashes are shuffled, not the texts
    each = distinct.select("host", "layout", "page", F.explode("pairs").alias("pair"))
    keys = ["host", "layout", F.col("pair.slots").alias("slot")]
    seen = each.groupBy(*keys, F.col("pair.hash").alias("hash")).agg(F.count(F.lit(1)).alias("seen"))
    # A page may have several texts in one slot of the paths, but has the slot once.
    having = distinct.select("host", "layout", F.explode(F.array_distinct("pairs.slots")).alias("slot"))
    having = having.groupBy("host", "layout", "slot").agg(F.count(F.lit(1)).alias("pages"))
    fixed = seen.join(having, ["host", "layout", "slot"])
    fixed = fixed.where(_proven_share(F.col("seen"), F.col("pages"), certainty) > share)
    # A page holds most of the texts that are fixed in a slot, so the list is bounded by a page.
    pair = F.struct(F.col("slot").alias("slots"), "hash")
    return fixed.groupBy("host", "layout").agg(F.collect_list(pair).alias("fixed"))


def main_text(
    pages: DataFrame,
    share: float = SHARE,
    certainty: float = CERTAINTY,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per input row: id, url, ``text`` and ``n_chars``, its code points.

    The text is the blocks of the articles and main elements, or of the whole page where
    there are none, white space in them made one space, joined by line feeds. Null and empty
    pages have an empty text. Pages without a host, or with a null url, count as one host.
    A page all of whose blocks are template keeps them, as there is nothing to tell them
    from. Markup is scanned once, however long or broken it is. Repeated rows each give a
    row; other columns are ignored.
    """
    ship_package(pages.sparkSession)
    host = F.coalesce(F.lower(F.try_parse_url(F.col(url_col), F.lit("HOST"))), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html")
    )
    references = materialise(_references(rows), "references")
    blocks = materialise(_blocks(rows, references), "blocks")
    templates = materialise(_templates(blocks, share, certainty), "templates")

    joined = blocks.join(templates, ["host", "layout"], "left")
    zipped = F.arrays_zip("slots", "texts")
    varying = F.filter(
        zipped,
        lambda b: ~F.array_contains("fixed", F.struct(b["slots"].alias("slots"), F.xxhash64(b["texts"]).alias("hash"))),
    )
    kept = F.when(F.col("fixed").isNull() | (F.size(varying) == 0), F.col("texts")).otherwise(
        F.transform(varying, lambda b: b["texts"])
    )
    text = F.array_join(kept, "\n")
    return joined.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text"),
        F.length(text).cast("long").alias("n_chars"),
    )
