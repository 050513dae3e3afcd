"""Main text of web pages by wrapper induction.

Pages of a host are built from the same template. Each page becomes a tree of block elements in which equal neighbours (the
paragraphs of a text, the entries of a list) are one repeated node. The commonest tree of a host is its reference; every page is
aligned with it by simple tree matching. A node that shows the same text on most of the different pages is template,
a node whose text varies is a slot for content; inside a marked article this holds for each line of a repeated node as well. Pages
with near copies of one article are one family and count as one page. What stands in elements that are never content (menus, footers, adverts, comments and
the like) is left out in any case, and where a page marks its article only that part is read.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offermart.llm.common import stored, table
from offermart.llm.registry import query

MIN_PAGES, MIN_SHARE = 3, 0.6  # different pages that show a template node's text, and their share of all that have the node
MOST = 0.6  # share of the varying text that the part taken for the article holds at least
DEPTH = 60  # levels of the tree that are aligned; deeper blocks belong to the node above them
SHINGLE, BANDS, BAND = 5, 10, 4  # words of a shingle; smallest hashes that name a family, and how many of them a name has
UNIT = 1 << 30  # weight of a family; its pages share it
SMALL_HOSTS = 100_000  # a table of at most so many hosts is broadcast

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead"
    " title tr ul".split()
)
NEVER = set("nav footer aside form menu dialog fieldset head title".split())
SLOTS = set("article main".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
REPEATED = HEADINGS | set("blockquote dd dt figure li p pre td th tr".split())
# Start tags that end an open element of the same group within the nearest container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
# Whole class names, ids and roles of parts that are never the article. Words that articles use as well
# (notice, widget, header and the like) are left to the template.
BESIDE = set(
    "ad ads advert adverts advertisement sponsor sponsored cookie cookies consent nav navbar navigation menu breadcrumb breadcrumbs"
    " sidebar aside newsletter subscribe footer masthead comment comments disqus pagination toolbar login contentinfo complementary".split()
)

_ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
_CODE, _OBJECTS = "script|style", "noscript|template|textarea|svg|iframe|select|button|object"
# Code runs to its end tag or, as in HTML, to the end of the page. Another element that is not closed before the next
# of its kind is an ordinary tag, and one that closes itself ends there.
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:{_CODE}|{_OBJECTS})(?=[\s/>]){_ATTRIBUTES}/>|<({_CODE})(?=[\s/>]).*?(?:</\1\s*>|\Z)"
    rf"|<({_OBJECTS})(?=[\s/>])[^<]*+(?:<(?!/?\2[\s/>])[^<]*+)*+</\2\s*>"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRIBUTES})>|<[!?][^>]*>?|([^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


@dataclass
class Node:
    label: str
    tag: str
    beside: bool  # by its tag or that of a node above it
    slot: bool
    parent: int
    hinted: bool  # by a class, id or role of its own
    children: list[int] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)


@dataclass
class Page:
    nodes: list[Node]
    blocks: list[tuple[int, str, int]]  # node, text, letters of it inside links


def parse(source: str | None) -> Page:
    """Block elements and text blocks of a page; whatever is not closed ends where its container ends."""
    page = Page([Node("#", "#", False, False, -1, False)], [])
    stack, text, linked, links = [0], [], 0, 0

    def flush():
        nonlocal linked
        if text:
            block = " ".join("".join(text).split())
            if block:
                node = page.nodes[stack[-1]]
                node.blocks.append(len(page.blocks))
                page.blocks.append((stack[-1], block, linked))
            text.clear()
        linked = 0

    for code, raw, close, tag, attributes, words in _TOKEN.findall(source or ""):
        if words:
            decoded = entities.unescape(words) if "&" in words else words
            text.append(decoded)
            linked += len(decoded) if links else 0
            continue
        if code or raw or not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
        elif tag == "a":
            links = 0 if close else 1
        elif tag in BLOCK:
            flush()
            if close:
                at = next((i for i in range(len(stack) - 1, 0, -1) if page.nodes[stack[i]].tag == tag), 0)
                if at:
                    del stack[at:]
                    links = 0
                continue
            if page.nodes[stack[-1]].tag == "p":
                stack.pop()
            if tag in CLOSES:
                for i in range(len(stack) - 1, 0, -1):
                    open_tag = page.nodes[stack[i]].tag
                    if open_tag in HOLDS[tag]:
                        break
                    if open_tag in CLOSES[tag]:
                        del stack[i:]
                        break
            if tag == "hr":
                continue
            links = 0
            given = {n for found in _NAMES.findall(attributes) for n in "".join(found).lower().split()}
            names = sorted({n for g in given for n in re.split(r"[^a-z]+", g) if n})
            above = page.nodes[stack[-1]]
            beside = above.beside or tag in NEVER or (tag == "header" and not above.slot)
            if tag in ("html", "body"):
                beside = False
            hinted = tag not in ("html", "body") and not BESIDE.isdisjoint(given)
            node = Node(".".join([tag, *names]), tag, beside, above.slot or tag in SLOTS or "main" in names, stack[-1], hinted)
            above.children.append(len(page.nodes))
            stack.append(len(page.nodes))
            page.nodes.append(node)
    flush()
    _heed_hints(page)
    return page


def _heed_hints(page: Page) -> None:
    """Names put a node and all below it beside the article, unless that would hide every article or all text of the page."""
    nodes = page.nodes
    if not any(n.hinted for n in nodes):
        return
    hidden = [False] * len(nodes)

    def spread() -> None:
        for at, n in enumerate(nodes):  # a node comes after the one above it
            hidden[at] = n.beside or n.hinted or (at > 0 and hidden[n.parent] and n.tag != "body")

    spread()
    articles = [at for at, n in enumerate(nodes) if n.tag in SLOTS and not n.beside]
    if articles and all(hidden[at] for at in articles):
        for at in articles:
            while at >= 0 and nodes[at].tag != "#":
                nodes[at].hinted, at = False, nodes[at].parent
        spread()
    if all(hidden[at] for at, _, _ in page.blocks):
        return
    for n, beside in zip(nodes, hidden):
        n.beside = beside


def outline(page: Page) -> tuple[str, list[int], list[str]]:
    """The page's shape, for each of its nodes the position in the shape, and the text at each position.

    Neighbouring paragraphs, entries and the like with equal labels are one position, and so is all that lies below
    them or below ``DEPTH`` levels.
    """
    where, texts, shape = [0] * len(page.nodes), [], []

    def put(group: list[int], depth: int) -> None:
        position = len(texts)
        texts.append([])
        repeated = len(group) > 1 or depth >= DEPTH
        shape.append(page.nodes[group[0]].label + ("*" if repeated else ""))
        if repeated:
            todo = list(group)
            while todo:
                n = todo.pop()
                where[n] = position
                todo += page.nodes[n].children
            return
        node = group[0]
        where[node] = position
        children = page.nodes[node].children
        if children:
            shape.append("(")
            at = 0
            while at < len(children):
                end, first = at + 1, page.nodes[children[at]]
                while first.tag in REPEATED and end < len(children) and page.nodes[children[end]].label == first.label:
                    end += 1
                put(children[at:end], depth + 1)
                at = end
            shape.append(")")

    put([0], 0)
    for node, text, _ in page.blocks:
        texts[where[node]].append(text)
    return " ".join(shape), where, ["\n".join(t) for t in texts]


@lru_cache(maxsize=4096)
def shape_tree(shape: str) -> tuple[list[str], list[list[int]], list[str]]:
    """Labels, children and the shape of the subtree by position."""
    labels, children, open_ = [], [], []
    for part in shape.split(" "):
        if part == "(":
            open_.append(len(labels) - 1)
        elif part == ")":
            open_.pop()
        else:
            if open_:
                children[open_[-1]].append(len(labels))
            labels.append(part)
            children.append([])
    below = [""] * len(labels)
    for at in range(len(labels) - 1, -1, -1):
        below[at] = f"{labels[at]}({' '.join(below[c] for c in children[at])})"
    return labels, children, below


@lru_cache(maxsize=20_000)
def align(shape: str, reference: str) -> tuple[int, ...]:
    """Simple tree matching: for each position of the shape the matched position of the reference, or -1."""
    (a_labels, a_children, a_below), (b_labels, b_children, b_below) = shape_tree(shape), shape_tree(reference)
    same = lambda x, y: a_labels[x].rstrip("*") == b_labels[y].rstrip("*")
    known: dict[tuple[int, int], tuple[int, list]] = {}

    def match(x: int, y: int) -> tuple[int, list]:
        """Matched nodes, and the matched pairs of children."""
        if (x, y) in known:
            return known[x, y]
        xs, ys = a_children[x], b_children[y]
        # Equal subtrees at either end belong to some best matching; only what lies between them is tried out.
        head = 0
        while head < min(len(xs), len(ys)) and a_below[xs[head]] == b_below[ys[head]]:
            head += 1
        tail = 0
        while tail < min(len(xs), len(ys)) - head and a_below[xs[-1 - tail]] == b_below[ys[-1 - tail]]:
            tail += 1
        ends = [*zip(xs[:head], ys[:head]), *zip(xs[len(xs) - tail :], ys[len(ys) - tail :])]
        sure = sum(match(p, q)[0] for p, q in ends)
        xs, ys = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, p in enumerate(xs):
            for j, q in enumerate(ys):
                score = match(p, q)[0] if same(p, q) else 0
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + score)
        pairs, i, j = [], len(xs), len(ys)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((xs[i], ys[j]))
        known[x, y] = best[-1][-1] + sure + 1, pairs + ends
        return known[x, y]

    out = [-1] * len(a_labels)
    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        out[x] = y
        todo += match(x, y)[1]
    return tuple(out)


def is_marked(page: Page) -> bool:
    return any(n.slot and not n.beside and n.tag in SLOTS for n in page.nodes)


def main_text(
    page: Page, template: set[int], where: list[int], aligned: tuple[int, ...] | None, lines: set[tuple[int, int]] = frozenset()
) -> str:
    """The blocks of the article, one per line: the marked one, or else the part of the page that holds most of what varies.

    ``template`` are positions of the reference, ``lines`` are positions with the hash of a block that is template there. In a marked
    article a repeated line goes only where it stands at an end of the article or is mostly a link; one that other text follows, such as the heading of
    a section, stays.
    """
    marked = is_marked(page)
    kept = []  # number of the block, and whether most pages repeat it here
    for number, (at, text, linked) in enumerate(page.blocks):
        node = page.nodes[at]
        if node.beside or (marked and not node.slot):
            continue
        if node.slot and _in_header(page, at) and node.tag not in HEADINGS:
            continue
        position = -1 if aligned is None else aligned[where[at]]
        link = linked > len(text) / 2
        if marked:
            repeated = (position, _hash(text)) in lines
            if not (repeated and link):
                kept.append((number, repeated))
        elif position not in template and not (position < 0 and link):
            kept.append((number, False))
    if marked:
        while kept and kept[-1][1]:
            kept.pop()
        first = 0
        while first < len(kept) and kept[first][1] and page.nodes[page.blocks[kept[first][0]][0]].tag not in HEADINGS:
            first += 1
        chosen = [number for number, _ in kept[first:]]
    else:
        chosen = _article_blocks(page, [number for number, _ in kept])
    return "\n".join(page.blocks[number][1] for number in chosen)


def _article_blocks(page: Page, kept: list[int]) -> list[int]:
    """Of the blocks that vary, those below the innermost node that holds ``MOST`` of their letters outside links.

    The search stops where a heading would be left outside: it belongs to the text beside it.
    """
    if not kept:
        return kept
    mass, headed = [0] * len(page.nodes), [0] * len(page.nodes)
    for number in kept:
        at, text, linked = page.blocks[number]
        size = max(0, len(text) - linked)
        heading = page.nodes[at].tag in HEADINGS
        while at >= 0:
            mass[at] += size
            headed[at] += heading
            at = page.nodes[at].parent
    at = 0
    while True:
        inner = max(page.nodes[at].children, key=mass.__getitem__, default=None)
        if inner is None or page.nodes[inner].tag in REPEATED or mass[inner] < MOST * mass[at] or headed[inner] < headed[at]:
            break
        at = inner
    below = [False] * len(page.nodes)
    for n, node in enumerate(page.nodes):  # a node comes after the one above it
        below[n] = n == at or (n > 0 and below[node.parent])
    return [number for number in kept if below[page.blocks[number][0]]]


def _in_header(page: Page, at: int) -> bool:
    while at > 0 and page.nodes[at].tag not in SLOTS:
        if page.nodes[at].tag == "header":
            return True
        at = page.nodes[at].parent
    return False


def host(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _hash(text: str) -> int:
    data = text.encode("utf-8", "surrogatepass")
    return zlib.crc32(data) << 31 ^ zlib.adler32(data)


_rng = np.random.default_rng(23)
_TIMES = _rng.integers(0, 1 << 63, (BANDS * BAND, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.uint64(0x9E3779B97F4A7C15) ** np.arange(SHINGLE, dtype=np.uint64)


def families(text: str) -> list[int]:
    """Names of a text, each from several smallest hashes of its shingles: near copies share at least one, other texts hardly any."""
    words = text.lower().split()
    hashes = np.array([_hash(w) for w in words] + [0] * max(1, SHINGLE - len(words)), np.int64).astype(np.uint64)
    shingles = sum(hashes[k : len(hashes) - SHINGLE + 1 + k] * _PLACES[k] for k in range(SHINGLE))
    shingles = np.unique(shingles ^ (shingles >> np.uint64(31)))
    least = np.full((BANDS * BAND, 1), np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 1 << 14):
        mixed = _TIMES * shingles[at : at + (1 << 14)]
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(axis=1, keepdims=True))
    bands = least.reshape(BANDS, BAND)
    return [zlib.crc32(b.tobytes()) << 31 ^ zlib.adler32(b.tobytes()) ^ i for i, b in enumerate(bands)]


def _article(page: Page, where: list[int]) -> tuple[str, dict[int, set[int]]]:
    """The text inside the marked article, and the hashes of its blocks by position; nothing if none is marked."""
    if not is_marked(page):
        return "", {}
    blocks, lines = [], {}
    for at, text, _ in page.blocks:
        if page.nodes[at].slot and not page.nodes[at].beside:
            blocks.append(text)
            lines.setdefault(where[at], set()).add(_hash(text))
    return "\n".join(blocks), lines


def wrappers(pages: DataFrame) -> DataFrame:
    """``(host, reference, template, line_at, line)``: the reference shape of each host, its template positions, and the hashes of
    blocks that are template at a position.

    Counted over all pages ``(id, url, html)``. Pages with near copies of one marked article, or with the same texts if none is
    marked, weigh together as much as one page. A hot host is only ever counted by shape, family or text, in partial sums.
    """

    def outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, shapes, names, texts, lines = [], [], [], [], []
            for url, source in zip(batch.column(1), batch.column(2)):
                page = parse(source.as_py())
                shape, where, parts = outline(page)
                article, blocks = _article(page, where)
                hosts.append(host(url.as_py()))
                shapes.append(shape)
                texts.append([_hash(t) if t else -1 for t in parts])  # no nulls: pandas would make them floats
                # The whole text of a position need not be listed again.
                lines.append([sorted(blocks.get(i, set()) - {t}) for i, t in enumerate(texts[-1])])
                names.append(families(article) if article else [_hash("\n".join(parts))])
            long = pa.list_(pa.int64())
            data = [pa.array(hosts, pa.string()), pa.array(shapes, pa.string()), pa.array(names, long), pa.array(texts, long), pa.array(lines, pa.list_(long))]
            yield pa.RecordBatch.from_arrays(data, names=["host", "shape", "names", "texts", "lines"])

    schema = "host string, shape string, names array<long>, texts array<long>, lines array<array<long>>"
    seen = stored(pages.mapInArrow(outlines, schema), "page-outlines")
    votes = seen.groupBy("host", "shape").agg(F.count("*").alias("n"))
    reference = votes.groupBy("host").agg(F.max_by("shape", F.struct("n", "shape")).alias("reference"))
    reference = stored(reference, "host-references")

    # A page weighs one part of the largest family it belongs to; those alone in all their families need no row.
    alike = seen.groupBy("host", "names").agg(F.count("*").alias("n"))
    named = alike.select("host", "names", "n", F.explode("names").alias("family"))
    crowded = named.groupBy("host", "family").agg(F.sum("n").alias("size")).where("size > 1")
    weights = named.join(crowded, ["host", "family"]).groupBy("host", "names").agg(F.max("size").alias("size"))
    weighed = seen.join(weights, ["host", "names"], "left").withColumn("weight", (F.lit(UNIT) / F.coalesce("size", F.lit(1))).cast("long"))

    def matched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for h, ref, shape, weight, texts, lines in zip(*(pdf[c] for c in ("host", "reference", "shape", "weight", "texts", "lines"))):
                for position, text, more in zip(align(shape, ref), texts, lines):
                    if position >= 0 and text >= 0:
                        rows.append((h, ref, position, text, weight, weight))
                        rows += [(h, ref, position, int(line), weight, 0) for line in more]
            yield pd.DataFrame(rows, columns=["host", "reference", "position", "text", "weight", "whole"])

    known = weighed.join(_small(reference), "host").select("host", "reference", "shape", "weight", "texts", "lines")
    texts = known.mapInPandas(matched, "host string, reference string, position int, text long, weight long, whole long")
    place = ["host", "reference", "position"]
    same = texts.groupBy(*place, "text").agg(F.sum("weight").alias("n"), F.sum("whole").alias("whole"))
    least = int(MIN_PAGES * UNIT * 0.999)  # shares of a family are cut to whole numbers
    totals = same.groupBy(*place).agg(F.sum("whole").alias("all"), F.max("whole").alias("most"))
    enough = lambda n: (n >= least) & (n >= MIN_SHARE * F.col("all"))
    # Only what most pages show at a place is listed: as many texts as a page has lines there.
    slots = same.where(F.col("n") >= least).join(totals, place).where(enough(F.col("n")))
    slots = slots.groupBy(*place).agg(F.max(enough(F.col("most"))).alias("fixed"), F.collect_list("text").alias("often"))
    line = F.transform("often", lambda x: F.struct(F.col("position").alias("position"), x.alias("text")))
    constant = slots.groupBy("host", "reference").agg(
        F.array_sort(F.collect_list(F.when(F.col("fixed"), F.col("position")))).alias("template"),
        F.array_sort(F.flatten(F.collect_list(line))).alias("lines"),
    )
    constant = constant.select("host", "reference", "template", F.col("lines.position").alias("line_at"), F.col("lines.text").alias("line"))
    return stored(constant, "host-wrappers")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SMALL_HOSTS else df


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text)`` per row of ``pages``: its main text, empty if there is none.

    Null html is an empty page; pages without a host form one group. Repeated rows come back as often as they went in.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    hosts = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    joined = rows.withColumn("host", hosts).join(_small(wrappers(rows)), "host", "left").drop("host")
    schema = rows.select("id", "url", F.lit("").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for source, reference, template, *lines in zip(*batch.columns[2:]):
                page = parse(source.as_py())
                if reference.is_valid:
                    shape, where, _ = outline(page)
                    known = set(zip(*(x.as_py() for x in lines)))
                    out.append(main_text(page, set(template.as_py()), where, align(shape, reference.as_py()), known))
                else:
                    out.append(main_text(page, set(), [], None))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["id", "url", "text"])

    return joined.select("id", "url", "html", "reference", "template", "line_at", "line").mapInArrow(run, schema)


@query(tested_by="tests/llm/test_learned_operators.py")
def op10_wrappers(spark, sf_dir):
    found = extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
