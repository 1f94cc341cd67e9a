"""Main text of HTML pages by wrapper induction.

Pages of one host share a template. Every page is parsed once into blocks of text and the outline of its DOM tree, in which
runs of equal siblings are one node, so that articles of different length have one outline. Each page's outline is aligned
with a reference outline of its host by simple tree matching. A block whose text stands in the same slot on most of the
host's distinct pages, or of those with the same outline, is constant: template, whatever share of a page it is. What varies is
content. Regions whose element or name says that they are not the article (menus, footers, adverts, forms, comments and the
like) are no content whether they vary or not; inside an article only names that say so as a whole count, since headings and
sections are named after what they are about.

Counting runs over hashes of blocks and is combined before the shuffle, joins by host go over narrow rows that adaptive
execution can split, and the texts move once, to meet the few pages that lose a block.
"""

from __future__ import annotations

import functools
import hashlib
import html
import json
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import store, table
from .queries import query

#: A block is template when it stands in its slot on so large a share of at least so many distinct pages of a host.
TEMPLATE_SHARE = 0.6
LEAST_PAGES = 4
#: Levels of a tree that are aligned; what lies deeper stands in the slot of its ancestor there.
LEVELS = 200
#: Weights of pairs of subtrees that are remembered at a time.
MOST_WEIGHTS = 1 << 20

# Elements and names by their role.
HIDDEN = set("script style noscript template svg iframe object canvas head title math audio video button select textarea label datalist".split())
ASIDE = set("nav footer aside form fieldset menu dialog".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
NOT_CONTENT = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup share sharing social related recommended recommendations comment comments disqus respond reply replies widget toolbar pagination pager login search copyright complementary contentinfo".split()
)
#: Inside an article a name is furniture when all its words are above or here, and an id when it has one of ``PLAINLY``.
AROUND = set("area bar block bottom box button buttons container count form icon icons inner item items left link links list outer panel right row section slot top unit wrap wrapper zone".split())
PLAINLY = set("ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr newsletter popup modal comment comments disqus".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# Outside quotes a tag holds no "<", so a page of tags that are never closed is read once.
_TAG = re.compile(r"<!--.*?(?:-->|$)|<![^<>]*>|<\?[^<>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']+|\"[^\"]*\"|'[^']*')*+)>", re.S)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_CUT_OFF = re.compile(r"</?[a-zA-Z][^<>]*$")


def _furniture(tag: str, names: list[tuple[str, str]]) -> bool:
    """Whether an element inside an article is named as something around it."""
    for kind, value in names:
        if tag in HEADINGS and kind == "id":
            continue
        for token in value.split():
            words = {w.lower() for w in _PART.findall(token)}
            if words & NOT_CONTENT and words <= NOT_CONTENT | AROUND and (kind != "id" or words & PLAINLY):
                return True
    return False


class _Node:
    __slots__ = ("tag", "names", "children", "out", "article", "parent", "length")

    def __init__(self, tag: str, named: list[tuple[str, str]], parent: "_Node | None"):
        self.tag, self.names, self.parent = tag, " ".join(v for _, v in named), parent
        self.children: list[_Node] = []
        self.length = 0
        inside = parent.article if parent else ""
        self.article = "article" if tag == "article" or inside == "article" else "main" if tag == "main" or inside else ""
        words = {w.lower() for w in _PART.findall(self.names)}
        if inside == "article":
            aside = _furniture(tag, named)
        else:
            aside = tag not in ("html", "body", "article", "main") and bool(words & NOT_CONTENT or "header" in words and not inside)
        if tag == "article" and words & {"comment", "comments", "reply"}:
            aside = True
        self.out = bool(parent and parent.out) or tag in ASIDE or (tag == "header" and not inside) or aside

    def signature(self) -> str:
        return self.tag + ("." + _SPACE.sub(".", self.names.strip().lower()) if self.names.strip() else "")


def parse(page: str) -> tuple[_Node, list[tuple[_Node, str, float]]]:
    """The tree of block elements, and the blocks in page order: (element, text, share of its text inside links)."""
    root = _Node("#page", [], None)
    here, blocks, parts = root, [], []
    unclosed: set[str] = set()  # hidden elements without an end in the rest of the page
    inside: Counter = Counter()  # open elements by name
    links = linked = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text and not here.out:
                blocks.append((here, text, min(1.0, linked / max(1, len(text)))))
            parts.clear()
        linked = 0

    def leave(node: _Node, tag: str) -> _Node:
        """The element around the nearest ``tag``, which is open, and all in it."""
        while True:
            inside[node.tag] -= 1
            if node.tag == tag:
                return node.parent
            node = node.parent

    def add(raw: str) -> None:
        nonlocal linked
        parts.append(raw)
        if links:
            linked += len(raw.strip())

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            add(_CUT_OFF.sub("", page[at:]))
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):  # closing
            if tag == "a":
                links = max(0, links - 1)
            elif inside[tag]:
                flush()
                here = leave(here, tag)
            continue
        if tag in HIDDEN and not m.group(3).rstrip().endswith("/"):
            if tag == "head":
                continue
            close = None if tag in unclosed else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if close is None:
                unclosed.add(tag)
            at = close.end() if close else (end if tag in ("script", "style") else at)
            continue
        if tag == "br":
            add(" ")
        elif tag == "a":
            links += 1
        elif tag in BLOCKS:
            flush()
            links = 0
            if tag in CLOSED_BY:
                node = here
                while node.parent is not None and node.tag not in CLOSED_BY[tag] and node.tag not in ("ul", "ol", "dl", "table", "div", "body"):
                    node = node.parent
                if node.tag in CLOSED_BY[tag]:
                    here = leave(here, node.tag)
            while here.tag == "p" or here.tag in HEADINGS and tag in HEADINGS:
                here = leave(here, here.tag)
            if tag not in VOID:
                found = [(k.lower(), v.strip("\"'")) for k, v in _NAMES.findall(m.group(3))] if "=" in m.group(3) else []
                node = _Node(tag, found, here)
                here.children.append(node)
                here = node
                inside[tag] += 1
    flush()
    return root, blocks


def _article(root: _Node, blocks: list[tuple[_Node, str, float]]) -> list[tuple[_Node, str]]:
    """The blocks of the article: those inside article or main elements, otherwise those below the element that holds most
    running text. Inside an article a plain list goes that is nothing but links (a menu); numbered lists, cells and lists with
    other items stay. Elsewhere all items that are nothing but links go."""
    own = [b for b in blocks if b[0].article == "article"]
    if own:
        told = {id(n.parent) for n, _, share in own if n.tag == "li" and share <= 0.9}
        return [(n, t) for n, t, share in own if share <= 0.9 or n.tag != "li" or n.parent.tag != "ul" or id(n.parent) in told]
    kept = [b for b in blocks if not (b[2] > 0.9 and b[0].tag in ("li", "td", "div", "dd", "dt"))]
    own = [(n, t) for n, t, _ in kept if n.article == "main"]
    if own:
        return own
    for node, text, share in kept:
        if share < 0.5:
            weight, up = len(text), node if node.tag in ("div", "section", "td", "body", "#page") else node.parent
            for factor in (1.0, 0.5):
                if up is not None:
                    up.length += int(weight * factor)
                    up = up.parent
    best, todo = root, [root]
    while todo:
        node = todo.pop()
        if node.length > best.length:
            best = node
        todo.extend(node.children)
    below, todo = set(), [best]
    while todo:
        node = todo.pop()
        below.add(id(node))
        todo.extend(node.children)
    return [(n, t) for n, t, _ in kept if id(n) in below]


def outline(root: _Node, levels: int = LEVELS) -> tuple[str, dict[int, int]]:
    """The tree as JSON of [signature, children], with runs of equal siblings as one, and each element's number in it. Elements
    below ``levels`` have the number of their ancestor there."""
    shapes: dict[int, list] = {}
    keys: dict[int, bytes] = {}
    order, todo = [], [(root, 0)]
    top: dict[int, _Node] = {}  # the element of the outline that a deeper one belongs to
    while todo:
        node, depth = todo.pop()
        if depth > levels:
            top[id(node)] = top.get(id(node.parent), node.parent)
        else:
            order.append(node)
        todo.extend((c, depth + 1) for c in node.children)
    children: dict[int, list[_Node]] = {}
    stands: dict[int, _Node] = {}
    for node in reversed(order):
        mine: list[_Node] = []
        for child in node.children:
            if id(child) not in keys:
                continue
            if mine and keys[id(mine[-1])] == keys[id(child)]:
                stands[id(child)] = mine[-1]
            else:
                mine.append(child)
        children[id(node)] = mine
        shapes[id(node)] = [node.signature(), [shapes[id(c)] for c in mine]]
        keys[id(node)] = hashlib.sha1(b"\0".join([node.signature().encode("utf-8", "replace"), *[keys[id(c)] for c in mine]])).digest()
    numbers: dict[int, int] = {}
    todo = [root]
    while todo:
        node = todo.pop()
        numbers[id(node)] = len(numbers)
        todo.extend(reversed(children[id(node)]))
    for node in order:
        if id(node) in stands:
            pairs = [(node, stands[id(node)])]
            while pairs:
                one, model = pairs.pop()
                numbers[id(one)] = numbers[id(model)]
                pairs.extend(zip(children[id(one)], children[id(model)]))
    for deep, at in top.items():
        numbers[deep] = numbers[id(at)]
    return json.dumps(shapes[id(root)]), numbers


@functools.lru_cache(maxsize=512)
def align(page: str, reference: str) -> tuple[int, ...]:
    """Simple tree matching: for each node of one outline the node of the other it is matched with, or -1.

    Two trees match when their roots agree; their children are matched in order so that as many nodes as possible match, however
    many there are. Equal subtrees at the begin and at the end of both lists are matched at once, which never matches fewer nodes.
    Between them subtrees are weighed once per pair of different ones with one root, where subtrees count as equal that differ only
    in names that the other tree lacks; of the table of a level every ``stride``-th row is kept and the others are made again on
    the way back, so memory does not grow with the table.
    """
    ids: dict[tuple, int] = {}

    def numbered(tree, others: set[str]):
        """Size, kind (the same for equal subtrees), name and children of each node; size and kind without what has none of the names
        in ``others``; and the first node of each such kind."""
        size, kind, name, below, met, core, first = [], [], [], [], [], [], {}

        def add(t) -> int:
            k = len(size)
            for column, value in ((size, 1), (kind, -1), (name, t[0]), (below, None), (met, 1), (core, -1)):
                column.append(value)
            below[k] = [add(c) for c in t[1]]
            size[k] += sum(size[c] for c in below[k])
            kind[k] = ids.setdefault((t[0], *[kind[c] for c in below[k]]), len(ids))
            kept = [c for c in below[k] if name[c] in others]
            met[k] += sum(met[c] for c in kept)
            core[k] = ids.setdefault((t[0], *[core[c] for c in kept]), len(ids))
            first.setdefault(core[k], k)
            return k

        add(tree)
        return size, kind, name, below, met, core, first

    def names(tree) -> set[str]:
        found, todo = set(), [tree]
        while todo:
            name, children = todo.pop()
            found.add(name)
            todo.extend(children)
        return found

    a, b = json.loads(page), json.loads(reference)
    sa, ka, na, below_a, met_a, core_a, first_a = numbered(a, names(b))
    _, kb, nb, below_b, _, core_b, first_b = numbered(b, names(a))
    memo: dict[tuple[int, int], int] = {}

    def weigh(i: int, j: int) -> int:
        """Matched nodes of two subtrees."""
        if na[i] != nb[j]:
            return 0
        pair = core_a[i], core_b[j]
        if pair[0] == pair[1]:
            return met_a[i]
        if pair not in memo:
            total = table(first_a[pair[0]], first_b[pair[1]])[0]
            if len(memo) >= MOST_WEIGHTS:
                memo.clear()  # what is needed again is weighed again
            memo[pair] = total
        return memo[pair]

    def table(i: int, j: int):
        """Matched nodes of two elements of one name, the numbers of equal children at both ends, and for those between the kept rows,
        their distance and the step from a row to the next."""
        left, right = below_a[i], below_b[j]
        total, head, tail = 1, 0, 0
        while head < min(len(left), len(right)) and ka[left[head]] == kb[right[head]]:
            total += sa[left[head]]
            head += 1
        while tail < min(len(left), len(right)) - head and ka[left[-1 - tail]] == kb[right[-1 - tail]]:
            total += sa[left[-1 - tail]]
            tail += 1
        n, m = len(left) - head - tail, len(right) - head - tail
        if not n or not m:
            return total, head, tail, [], 1, None
        kinds, of = np.unique([core_b[q] for q in right[head : head + m]], return_inverse=True)
        named: dict[str, list[tuple[int, int]]] = {}
        for at, k in enumerate(kinds.tolist()):
            named.setdefault(nb[first_b[k]], []).append((at, first_b[k]))

        def after(row, p: int):
            weights = np.zeros(len(kinds), np.int64)
            for at, q in named.get(na[left[head + p]], ()):
                weights[at] = weigh(left[head + p], q)
            weights = weights[of]
            out = np.zeros(m + 1, np.int64)
            np.maximum.accumulate(np.maximum(row[1:], np.where(weights > 0, row[:-1] + weights, 0)), out=out[1:])
            return out

        stride = math.isqrt(n) + 1
        row, kept = np.zeros(m + 1, np.int64), []
        for p in range(n):
            if p % stride == 0:
                kept.append(row)
            row = after(row, p)
        return total + int(row[m]), head, tail, kept, stride, after

    def matches(i: int, j: int) -> list[tuple[int, int]]:
        """The children of two elements that are matched."""
        left, right = below_a[i], below_b[j]
        _, head, tail, kept, stride, after = table(i, j)
        pairs = [*zip(left[:head], right[:head]), *zip(left[len(left) - tail :], right[len(right) - tail :])]
        p, q = (len(left) - head - tail, len(right) - head - tail) if kept else (0, 0)
        start, rows = p, []
        while p and q:
            if p <= start:
                start = (p - 1) // stride * stride
                rows = [kept[start // stride]]
                for k in range(start, p):
                    rows.append(after(rows[-1], k))
            here, above = rows[p - start], rows[p - start - 1]
            if here[q] == above[q]:
                p -= 1
            elif here[q] == here[q - 1]:
                q -= 1
            else:
                p, q = p - 1, q - 1
                pairs.append((left[head + p], right[head + q]))
        return pairs

    matched = [-1] * len(sa)
    todo = [(0, 0)] if na[0] == nb[0] else []
    while todo:
        i, j = todo.pop()
        if ka[i] == kb[j]:
            matched[i : i + sa[i]] = range(j, j + sa[i])
            continue
        matched[i] = j
        todo.extend(matches(i, j))
    return tuple(matched)


def read_page(page: str) -> tuple[list[str], list[int], str]:
    """Texts of the article's blocks, the outline node of each, and the outline."""
    root, blocks = parse(page)
    own = _article(root, blocks)
    shape, numbers = outline(root)
    return [t for _, t in own], [numbers[id(n)] for n, _ in own], shape


def blocks(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) -> row (a fingerprint of all three), page_id, url, host, texts, nodes and outline; every page is parsed
    once, here."""

    def run(batches):
        for batch in batches:
            made = [read_page(h or "") for h in batch.column(3).to_pylist()]
            texts, nodes, shapes = zip(*made) if made else ([], [], [])
            arrays = [pa.array(texts, pa.list_(pa.string())), pa.array(nodes, pa.list_(pa.int32())), pa.array(shapes, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *arrays], names=["row", "page_id", "url", "texts", "nodes", "outline"])

    named = pages.select(F.xxhash64("page_id", "url", "html").alias("row"), "page_id", "url", "html")
    parsed = named.mapInArrow(run, "row long, page_id long, url string, texts array<string>, nodes array<int>, outline string")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return parsed.withColumn("host", host)


def _constant(slotted: DataFrame, by: list[str]) -> DataFrame:
    """(row, constant) of rows (row, .., n_pages, print, slots, hashes): positions of the blocks that stand in their slot on most of the
    ``n_pages`` distinct pages of the group ``by``."""
    each = slotted.select(*by, "n_pages", "print", F.explode(F.array_distinct(F.arrays_zip("slots", "hashes"))).alias("b")).where("b.slots >= 0")
    seen = each.groupBy(*by, "n_pages", F.col("b.slots").alias("slot"), F.col("b.hashes").alias("hash"), "print").agg(F.lit(1).alias("one")).groupBy(*by, "n_pages", "slot", "hash").agg(F.count("*").alias("n"))
    template = seen.where(F.col("n") >= F.col("n_pages") * TEMPLATE_SHARE).groupBy(*by).agg(F.collect_list(F.struct("slot", "hash")).alias("template"))
    met = slotted.join(store(template, "wrapper-templates"), by)
    at = F.filter(F.sequence(F.lit(0), F.size("hashes") - 1), lambda k: F.array_contains(F.col("template"), F.struct(F.get("slots", k).alias("slot"), F.get("hashes", k).alias("hash"))))
    return met.where(F.size("hashes") > 0).select("row", at.alias("constant")).where(F.size("constant") > 0)


def constant_blocks(parsed: DataFrame) -> DataFrame:
    """(row, constant): positions of the blocks of each page that a template of its host holds, of pages that have any.

    A host has a template of all its pages, by the alignment of their outlines with the most frequent one, and one per outline,
    so that a host of several layouts finds each. Both need ``LEAST_PAGES`` distinct pages.
    """
    hashes = F.transform("texts", lambda t: F.xxhash64(t))
    narrow = parsed.where(F.col("host") != "").select("row", "host", "outline", F.xxhash64("outline").alias("shape"), F.col("nodes").alias("slots"), hashes.alias("hashes"), F.xxhash64("texts").alias("print"))
    distinct = narrow.groupBy("host", "outline", "shape", "print").agg(F.lit(1).alias("one")).groupBy("host", "outline", "shape").agg(F.count("*").alias("n"))
    distinct = store(distinct, "wrapper-outlines")
    reference = distinct.groupBy("host").agg(F.max_by("outline", F.struct("n", "outline")).alias("reference"), F.sum("n").alias("n_pages"))  # the most frequent outline
    reference = store(reference.where(F.col("n_pages") >= LEAST_PAGES), "wrapper-references")

    def run(batches):
        for batch in batches:
            out = []
            for shape, nodes, ref in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(6).to_pylist()):
                to = align(shape, ref)
                out.append([to[k] for k in nodes])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32())), batch.column(4), batch.column(5), batch.column(7)], names=["row", "host", "slots", "hashes", "print", "n_pages"])

    joined = narrow.join(reference, "host").select("row", "host", "outline", "slots", "hashes", "print", "reference", "n_pages")
    slotted = store(joined.mapInArrow(run, "row long, host string, slots array<int>, hashes array<long>, print long, n_pages long"), "wrapper-slots")
    layouts = distinct.where(F.col("n") >= LEAST_PAGES).select("host", "shape", F.col("n").alias("n_pages"))
    found = _constant(slotted, ["host"]).unionByName(_constant(narrow.drop("outline").join(layouts, ["host", "shape"]), ["host", "shape"]))
    return found.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("constant"))).alias("constant"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text and n_chars (code points).

    A null or empty page has no text. A page without a host, or of a host with few distinct pages, loses no constant block. Rows
    without an id and rows that share one are pages of their own; rows alike in id, url and html share one decision. Very long
    pages are read whole, in time that grows with their length. Other columns are not read. An empty table gives no rows.
    """
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    parsed = store(blocks(base), "wrapper-blocks")
    constant = store(constant_blocks(parsed), "wrapper-constant")
    joined = parsed.select("row", "page_id", "url", "texts").join(constant, "row", "left")
    varying = F.filter("texts", lambda t, k: ~F.array_contains(F.col("constant"), k))
    text = F.array_join(F.when(F.col("constant").isNotNull(), varying).otherwise(F.col("texts")), "\n\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


@query("op5_html_extraction")
def op5_html_extraction(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))
