"""Main text of web pages by wrapper induction.

1. Every page is parsed into a tree; like siblings are collapsed, which leaves a skeleton: path, hash of the text
   under it and amount of text. Siblings of a skeleton differ in label, so each has one possible partner and whole
   skeletons are aligned in n log n steps, whatever their size.
2. Pages of one host are dealt into groups of about ``GROUP`` pages (a host of any size makes many groups), and
   inside a group every page's skeleton is aligned with its predecessor's by simple tree matching. An aligned
   pair of nodes votes "constant" when both hold the same text and "varying" otherwise. Pairs of pages that
   share most of the text that changes on the host (copies of one article) do not vote.
3. The votes are summed per (host, path), map-side first: a path whose text stays the same is template, any
   other is a slot. The wrapper of a host is the set of its template paths.
4. Every page is joined with its host's wrapper and read again: the content is the wrapper's slots, all of them, in page
   order. Where a host has no wrapper (too few pages, or nothing constant), the page's own elements decide: the content is what lies
   in its articles, else in its main element, else every slot. In both cases slots of menus, headers, footers, sidebars,
   notices, adverts, forms, scripts, styles and reader comments, known by element or class, are left out.

Defined cases: null and empty html give the empty text; html without markup is one block of text; pages of any length and depth
are read whole (a path is a 64-bit hash of the labels from the root, so depth costs no memory); a null url is a host of
its own kind; repeated rows keep one result row each; an empty table gives an empty result; other columns are ignored,
whatever their names. Character references are decoded, white space inside a block becomes one space, blocks
are joined by one newline.
"""

from __future__ import annotations

import functools
import hashlib
import html as htmllib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored, table, text_or_empty

GROUP = 64
VOTES = 3  # a path needs so many votes before it can be template

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style noscript template head title svg math iframe object embed noembed noframes canvas audio video map".split())
BOILER = frozenset("nav aside footer form button select option textarea input label fieldset dialog menu".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table
tbody td tfoot th thead title tr ul""".split())
CLOSES = {  # an opening tag ends these open elements
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "body": ("head",)}
CLASS_WORDS = re.compile(
    r"(?:^|[-_ ])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebar|side-bar|rail|menu|nav|navbar|navigation|breadcrumbs?|"
    r"cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|related|"
    r"recommend\w*|comments?|commentlist|disqus|replies|respond|footer|masthead|site-header|page-header|topbar|toolbar|widget|pagination|pager|"
    r"tags|skip-link|print-only|hidden)(?:$|[-_ ])", re.I)
COMMENTS = re.compile(r"(?:^|[-_ ])(?:comments?|commentlist|disqus|replies|respond)(?:$|[-_ ])", re.I)
STATES = re.compile(  # words on a layout that tell of another element: has-sidebar, comments-open
    r"(?:^|(?<= ))(?:has|no|with|without|hide|show)[-_][^ ]+|(?:^|(?<= ))[^ ]+[-_](?:open|closed|enabled|disabled|left|right|on|off|none)(?=$| )", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
# in a tag, a quote opens a value only right behind "="; elsewhere, and in values without quotes, it is a letter like any other
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*>|"
                   r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?>\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>", re.S)
ATTR = re.compile(r"([^\s=/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/$")
SPACE = re.compile(r"\s+")


class Node:
    """``path``: hash of the labels from the root. ``boiler``: left out. ``named``: it is so by a class or id alone (2: by one
    of reader comments). ``within``: below an article or main element; ``under``: in an element that is named."""

    __slots__ = ("tag", "path", "boiler", "named", "within", "under", "children", "parent")

    def __init__(self, tag: str, path: int, boiler: bool, named: int, parent):
        self.tag, self.path, self.boiler, self.named, self.parent, self.children = tag, path, boiler, named, parent, []
        self.within = parent is not None and (parent.within or parent.tag in ("article", "main"))
        self.under = named > 0 or (parent is not None and parent.under)


@functools.lru_cache(maxsize=100_000)
def _label(label: str) -> int:
    return int.from_bytes(hashlib.blake2b(label.encode("utf-8", "replace"), digest_size=8).digest(), "little")


def _below(path: int, label: str) -> int:
    """The path of an element of this label below ``path``: a signed 64-bit number."""
    x = (path * 0x9E3779B97F4A7C15 + _label(label)) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x ^= x >> 32
    return x - (1 << 64) if x >> 63 else x


def path_of(*labels: str) -> int:
    """The path of nested elements, each ``tag``, ``tag.class`` and so on."""
    path = 0
    for label in labels:
        path = _below(path, label)
    return path


def _open(tag: str, attrs: str, parent: Node) -> Node:
    names, named = "", 0
    boiler = tag in BOILER or (tag == "header" and not (parent.within or parent.tag in ("article", "main")))
    if attrs and ("=" in attrs or "hidden" in attrs):
        for m in ATTR.finditer(attrs):
            key = m[1].lower()
            value = m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                names += "." + SPACE.sub(".", value.strip())
                if tag not in ("html", "body", "article", "main") and CLASS_WORDS.search(value):
                    named = max(named, 2 if COMMENTS.search(STATES.sub(" ", value)) else 1)
            elif key == "role":
                boiler = boiler or value.strip().lower() in ROLES
            elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                boiler = True
    return Node(tag, _below(parent.path, tag + names), boiler or named > 0, 0 if boiler else named, parent)


def parse(page: str) -> Node:
    """A tree of ``Node`` and str children; unclosed, stray and raw-text elements are handled as browsers do
    in the common cases."""
    root = Node("#", 0, False, 0, None)
    cur, at, opened = root, 0, Counter()  # how many elements of a tag are open: end tags without one cost nothing

    def close(upto: Node) -> Node:
        """Ends the open elements from the current one to ``upto``; its parent is the current one then."""
        node = cur
        while node is not upto:
            opened[node.tag] -= 1
            node = node.parent
        opened[upto.tag] -= 1
        return upto.parent

    match = TOKEN.search(page, 0)
    while match:
        if match.start() > at:
            cur.children.append(page[at:match.start()])
        at = match.end()
        tag = match[3]
        if tag is None:
            if match[1]:
                cur.children.append(match[1])
        elif match[2]:
            tag = tag.lower()
            if opened[tag]:
                node = cur
                while node.tag != tag:
                    node = node.parent
                cur = close(node)
        else:
            tag = tag.lower()
            ends = CLOSES.get(tag, ("p",) if tag in BLOCK else ())
            if tag in BLOCK and "p" not in ends:
                ends = (*ends, "p")
            if any(opened[t] for t in ends):
                node = cur
                while node is not root:
                    if node.tag in ends:
                        above = node.parent
                        cur = close(node)
                        if node.tag == "p" or tag not in ("tr", "tbody"):
                            break
                        node = above
                        continue
                    if node.tag in ("table", "ul", "ol", "dl", "article", "section", "div", "td", "th", "main"):
                        break
                    node = node.parent
            node = _open(tag, match[4], cur)
            cur.children.append(node)
            closed = SELF_CLOSED.search(match[4]) is not None
            if tag in RAW and not closed:
                end = _raw_end(tag).search(page, at)
                stop = end.start() if end else len(page)
                node.children.append(page[at:stop])
                gt = page.find(">", stop) if end else -1
                at = gt + 1 if gt >= 0 else len(page)
            elif tag not in VOID and not closed:
                cur = node
                opened[tag] += 1
        match = TOKEN.search(page, at)
    if at < len(page):
        cur.children.append(page[at:])
    return root


@functools.lru_cache(maxsize=64)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}[\s/>]", re.I)


def _digests(root: Node) -> dict[int, tuple[int, int]]:
    """For every node, by identity: (hash, length) of the visible text below, children before parents."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        if n.tag not in HIDDEN:
            order.append(n)
            stack.extend(c for c in n.children if isinstance(c, Node))
    found: dict[int, tuple[int, int]] = {}
    for n in reversed(order):
        crc = chars = 0
        for c in n.children:
            if isinstance(c, str):
                c = c.strip()
                if c:
                    crc, chars = zlib.crc32(c.encode("utf-8", "replace"), crc), chars + len(c)
            elif id(c) in found and found[id(c)][1]:
                below = found[id(c)]
                crc, chars = zlib.crc32(below[0].to_bytes(4, "little"), crc), chars + below[1]
        found[id(n)] = (crc, chars)
    return found


# ---- skeletons and their alignment --------------------------------------------------------------------------------

def skeleton(page: str) -> list[list]:
    """Rows ``[parent row, path, text hash, characters]`` in breadth-first order; like siblings are one row."""
    root = parse(page)
    digests = _digests(root)
    rows: list[list] = []
    level: list[tuple[int, list[Node]]] = [(-1, [root])]
    while level:
        below = []
        for parent, nodes in level:
            crc = chars = 0
            for n in nodes:
                digest, size = digests[id(n)]
                crc, chars = zlib.crc32(digest.to_bytes(4, "little"), crc), chars + size
            rows.append([parent, nodes[0].path, crc, chars])
            me, groups = len(rows) - 1, {}
            for n in nodes:
                for c in n.children:
                    if isinstance(c, Node) and c.tag not in HIDDEN and c.tag not in VOID:
                        groups.setdefault(c.path, []).append(c)
            below.extend((me, g) for g in groups.values())
        level = below
    return rows


def _children(rows: list[list]) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in rows]
    for i, r in enumerate(rows):
        if r[0] >= 0:
            out[r[0]].append(i)
    return out


def _heaviest(links: list[tuple[int, int, int]]) -> list[int]:
    """Of ``(i, j, weight)`` sorted by i and falling j, the places of a heaviest chain with both i and j rising."""
    if all(x[0] < y[0] and x[1] < y[1] for x, y in zip(links, links[1:])):
        return list(range(len(links)))
    size = max(j for _, j, _ in links) + 1
    best: list[tuple[int, int]] = [(0, -1)] * (size + 1)  # Fenwick tree of (weight, last link)
    before = []
    for k, (_, j, weight) in enumerate(links):
        top, at = (0, -1), j
        while at:
            top = max(top, best[at])
            at &= at - 1
        before.append(top[1])
        top, at = (top[0] + weight, k), j + 1
        while at <= size:
            best[at] = max(best[at], top)
            at += at & -at
    top, at = (0, -1), size
    while at:
        top = max(top, best[at])
        at &= at - 1
    chain, k = [], top[1]
    while k >= 0:
        chain.append(k)
        k = before[k]
    return chain[::-1]


def align(a: list[list], b: list[list]) -> list[tuple[int, int]]:
    """Simple tree matching: pairs of rows in a largest order- and depth-preserving match of equal labels (below a pair of equal
    paths, equal labels are equal paths)."""
    if not a or not b or a[0][1] != b[0][1]:
        return []
    ka, kb = _children(a), _children(b)
    pairs, links = [(0, 0)], {}
    for x, y in pairs:  # grows: every pair of equal labels below a pair, parents first
        at: dict[int, list[int]] = {}
        for j in reversed(range(len(kb[y]))):
            at.setdefault(b[kb[y][j]][1], []).append(j)
        links[x, y] = [(i, j) for i, u in enumerate(ka[x]) for j in at.get(a[u][1], ())]
        pairs.extend((ka[x][i], kb[y][j]) for i, j in links[x, y])
    size: dict[tuple[int, int], int] = {}
    chosen: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for x, y in reversed(pairs):
        below = [(i, j, size[ka[x][i], kb[y][j]]) for i, j in links[x, y]]
        keep = [below[k] for k in _heaviest(below)]
        size[x, y] = 1 + sum(w for _, _, w in keep)
        chosen[x, y] = [(ka[x][i], kb[y][j]) for i, j, _ in keep]
    out = [(0, 0)]
    for pair in out:
        out.extend(chosen[pair])
    return out


def votes(a: list[list], b: list[list]) -> list[tuple[int, int, int]]:
    """(path, 1 constant or 0 varying, characters of a leaf) of the aligned rows that hold text."""
    below = _children(a)
    return [(a[x][1], int(a[x][2] == b[y][2]), 0 if below[x] else a[x][3]) for x, y in align(a, b) if x and (a[x][3] or b[y][3])]


def group_votes(pages: list[list[list]]) -> dict[int, list[int]]:
    """``path -> [votes, votes for constant]`` of pages aligned with their predecessors. Copies of one article do not
    vote: a pair with most of its text equal in paths whose text changes through the group. What never changes
    tells nothing of copies, however much of the page it is, nor does a path with two texts in all, such as an old
    and a new notice, unless the group is small."""
    pairs = [votes(a, b) for a, b in zip(pages, pages[1:])]
    texts: dict[int, set[int]] = {}
    for rows in pages:
        for _, path, digest, _ in rows:
            texts.setdefault(path, set()).add(digest)
    most = 1 if len(pages) < 8 else 2
    tally: dict[int, list[int]] = {}
    for pair in pairs:
        slots = [(chars, constant) for path, constant, chars in pair if len(texts[path]) > most]
        if sum(chars for chars, constant in slots if constant) > 0.5 * sum(chars for chars, _ in slots):
            continue
        for path, constant, _ in pair:
            t = tally.setdefault(path, [0, 0])
            t[0] += 1
            t[1] += constant
    return tally


def induce(pages: DataFrame) -> DataFrame:
    """``pages(page_id, host, html)`` -> the wrapper of each host: ``(host, template array<bigint>)``, its constant paths."""
    def skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [skeleton(p) for p in b.column(2).to_pylist()]
            kind = pa.list_(pa.struct([("parent", pa.int32()), ("path", pa.int64()), ("hash", pa.int64()), ("chars", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([[{"parent": p, "path": q, "hash": h, "chars": c} for p, q, h, c in r] for r in rows], kind)],
                ["page_id", "host", "rows"])

    rows_type = "array<struct<parent: int, path: bigint, hash: bigint, chars: int>>"
    trees = map_batches(pages.select("page_id", "host", "html"), skeletons, f"page_id bigint, host string, rows {rows_type}")
    trees = stored(trees.withColumn("key", F.xxhash64("rows")), "page-skeletons")
    large = trees.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > GROUP)
    parts = F.ceil(F.coalesce("n", F.lit(1)) / GROUP).cast("bigint")
    grouped = (trees.join(large, "host", "left").withColumn("part", F.pmod(F.xxhash64("page_id", "key"), parts))
               .select("host", "part", "page_id", "key", "rows")
               .repartition("host", "part"))  # else a host's groups stay together where the join put them

    def pair_votes(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("key").sort_values(["page_id", "key"])
        tally = group_votes([[[r["parent"], r["path"], r["hash"], r["chars"]] for r in rows] for rows in pdf["rows"]])
        host = pdf["host"].iloc[0]
        return pd.DataFrame([(host, p, n, c) for p, (n, c) in tally.items()], columns=["host", "path", "n", "same"])

    cast = grouped.groupBy("host", "part").applyInPandas(pair_votes, "host string, path bigint, n bigint, same bigint")
    tally = cast.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("same").alias("same"))
    return (tally.where((F.col("n") >= VOTES) & (F.col("same") >= 0.8 * F.col("n")))
            .groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("template")))  # one row per distinct path


# ---- extraction -----------------------------------------------------------------------------------------------------

def _keep_layouts(root: Node, template: frozenset) -> None:
    """Takes the mark from elements that only their class or id calls boilerplate, where they hold the main text: most
    of the page's slot text, or its main element, or its article when no article is outside such elements. An element
    named for reader comments must hold main, or all slot text there is."""
    order: list[Node] = []
    stack = [root]
    while stack:
        n = stack.pop()
        if not ((n.boiler and not n.named) or n.tag in HIDDEN or n.path in template):
            order.append(n)
            stack.extend(c for c in n.children if isinstance(c, Node))
    if not any(n.named for n in order):
        return
    held: dict[int, tuple[int, int, bool, bool]] = {}  # text without and with reader comments; whether it holds article, main
    for n in reversed(order):
        text = every = sum(len(c.strip()) for c in n.children if isinstance(c, str))
        article, main = n.tag == "article", n.tag == "main"
        for below in (held[id(c)] for c in n.children if isinstance(c, Node) and id(c) in held):
            text, every, article, main = text + below[0], every + below[1], article or below[2], main or below[3]
        held[id(n)] = (0, every, False, main) if n.named == 2 and not main else (text, every, article, main)
    total, every = held[id(root)][:2]

    def plain(tags) -> bool:
        stack = [root]
        while stack:
            n = stack.pop()
            if n.tag in tags:
                return True
            stack.extend(c for c in n.children if isinstance(c, Node) and id(c) in held and not c.boiler)
        return False

    has_main, has_article = plain(("main",)), plain(("article", "main"))
    stack = [root]
    while stack:
        n = stack.pop()
        text, all_text, article, main = held[id(n)]
        if n.named == 2:
            n.boiler = not ((main and not has_main) or (not total and 0 < all_text == every))
        elif n.named:
            n.boiler = not (2 * text > total or (main and not has_main) or (article and not has_article))
        if not n.boiler:
            stack.extend(c for c in n.children if isinstance(c, Node) and id(c) in held)


def _scopes(root: Node, template: frozenset) -> list[Node]:
    """The page's articles, outermost and in page order, else its main elements, else the whole page, so that every
    slot is read. Articles only in elements named for boilerplate, with less than half of the text, are a sidebar's teasers."""
    weight: dict[int, int] = {}
    order: list[Node] = []
    stack = [root]
    while stack:
        n = stack.pop()
        if n.boiler or n.tag in HIDDEN or n.path in template or n.tag == "a":
            continue
        order.append(n)
        stack.extend(c for c in reversed(n.children) if isinstance(c, Node))
    for n in reversed(order):
        own = sum(len(c.strip()) for c in n.children if isinstance(c, str))
        weight[id(n)] = own + sum(weight.get(id(c), 0) for c in n.children if isinstance(c, Node))
    for tag in ("article", "main"):
        found = [n for n in order if n.tag == tag]
        if found and not all(n.under and 2 * weight[id(n)] <= weight[id(root)] for n in found):
            inner = set()
            for n in order:  # parents come first
                if n.parent is not None and (n.parent.tag == tag or id(n.parent) in inner):
                    inner.add(id(n))
            return [n for n in found if id(n) not in inner]
    return [root]


def extract(page: str, template: frozenset = frozenset()) -> str:
    """The main text of one page; ``template`` has its host's constant paths (none: the host has no wrapper)."""
    if not page:
        return ""
    root = parse(page)
    _keep_layouts(root, template)
    starts = [root] if template else _scopes(root, template)
    blocks, part = [], []

    def flush() -> None:
        text = " ".join(htmllib.unescape("".join(part)).split())
        part.clear()
        if text:
            blocks.append(text)

    first = {id(n) for n in starts}
    stack: list = [x for n in reversed(starts) for x in (None, n)]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            part.append(x)
        elif x.tag == "br":
            part.append(" ")
        elif id(x) in first or not (x.boiler or x.tag in HIDDEN or x.path in template):
            if x.tag in BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(x.children))
    flush()
    return "\n".join(blocks)


def main_text(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> page_id, url, text, n_chars."""
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))
    rows = pages.select("page_id", "url", host.alias("host"), text_or_empty("html").alias("html"))
    wrappers = stored(induce(rows), "page-wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(p, frozenset(t or ())) for p, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    joined = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "template")
    return map_batches(joined, run, "page_id bigint, url string, text string, n_chars bigint")


def op2_main_text(spark, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
