"""Main text of web pages by consensus of the pages of a host.

Each page's containers are scored by the text outside links that stands in
their paragraphs.  A container's path is generalised to tag and class names
without numbers; hosts add up the scores of their pages by path, in Spark, and
the path with the most support is the host's.  Each page is then read again
with the winning path; a page that lacks it falls back to its own best
container.  From there the reading climbs to the lowest container that holds
all text blocks that are not mainly links.  Inside, navigation, notices, adverts, forms and comments are left
out by tag, role and name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenground.llm.common import text_batches
from evenground.session import written

# fixed values of the markup language
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select object canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("nav header footer aside form button dialog menu head fieldset".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ITEMS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select html body".split())
CONTAINERS = frozenset("article main section div td body".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar alertdialog toolbar".split())
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted nav navbar navigation menu sidebar side-bar "
    "aside footer header masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice newsletter subscribe subscription signup login popup modal "
    "overlay share sharing social related recommended recommendations widget widgets comment comments disqus pagination pager toolbar skip topbar "
    "copyright legal disclaimer paywall alert replies reply respond responses discussion tags toc".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/\"'>]+)")
NAMES = re.compile(r"[A-Za-z][A-Za-z-]*")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "path", "parent", "noise", "text", "linked", "order", "container")

    def __init__(self, tag: str, path: str, parent: Node | None, noise: bool, order: int) -> None:
        self.tag, self.path, self.parent, self.noise, self.order = tag, path, parent, noise, order
        self.text = self.linked = 0
        self.container = self if tag in CONTAINERS or parent is None else parent.container


def _attributes(text: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _noise(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """``inside``: an article's own header is part of the text."""
    if tag in DROPPED and not (tag == "header" and inside):
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    if tag in ("body", "html", "article", "main"):
        return False
    if attributes.get("role", "").lower() in ROLES:
        return True
    for name in NAMES.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()):
        if name in NOISE and not (inside and name == "header"):
            return True
        words = name.split("-")
        if len(words) > 1 and not NOISE.isdisjoint(words) and not (inside and "header" in words):
            return True
    return False


def parse(page: str) -> Iterator[tuple[Node, list[str], bool]]:
    """Blocks of a page: (innermost element, text pieces, in a link) in page
    order; a new block begins with every tag that is no inline tag."""
    stack = [Node("", "", None, False, 0)]
    pieces: list[tuple[str, bool]] = []
    order = at = 0
    links = 0

    def closed(upto: int) -> None:
        nonlocal links
        for node in stack[upto:]:
            links -= node.tag == "a"
        del stack[upto:]

    def block() -> tuple[Node, list[tuple[str, bool]]] | None:
        if not pieces:
            return None
        node = stack[-1]
        while node.tag in INLINE and node.parent is not None:
            node = node.parent
        out = (node, pieces.copy())
        pieces.clear()
        return out

    while at < len(page):
        m = TOKEN.search(page, at)
        stop = m.start() if m else len(page)
        if stop > at and not stack[-1].noise:
            pieces.append((page[at:stop], links > 0))
        if not m:
            break
        at = m.end()
        if m[0].startswith("<![CDATA["):
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag not in INLINE and (done := block()):
            yield done
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    closed(k)
                    break
                if stack[k].tag in ("td", "th", "table", "article", "body") and tag in INLINE | {"p"}:
                    break
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P or tag in ITEMS:
            ends = ITEMS.get(tag, {"p"})
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends or (tag in CLOSES_P and stack[k].tag == "p"):
                    closed(k)
                    break
                if stack[k].tag in SCOPES or (stack[k].tag in CLOSES_P and tag in CLOSES_P):
                    break
        attributes = _attributes(m[3]) if m[3].strip() else {}
        parent = stack[-1]
        inside = any(n.tag in ("article", "main") for n in stack)
        order += 1
        path = parent.path
        if tag in CONTAINERS:
            names = sorted({n.rstrip("-") for n in NAMES.findall(attributes.get("class", "").lower())})
            path += "/" + ".".join([tag, *names])
        stack.append(Node(tag, path, parent, parent.noise or _noise(tag, attributes, inside), order))
        links += tag == "a"
    if pieces and (done := block()):
        yield done


def _clean(pieces: list[tuple[str, bool]]) -> str:
    return SPACE.sub(" ", html.unescape("".join(p for p, _ in pieces))).strip()


def blocks(page: str) -> list[tuple[Node, str, int]]:
    """(element, text, characters in links) of the blocks with text."""
    out = []
    for node, pieces in parse(page):
        if not node.noise and (text := _clean(pieces)):
            linked = sum(len(p) for p, link in pieces if link)
            out.append((node, text, min(linked, len(text))))
    return out


def scores(found: list[tuple[Node, str, int]]) -> dict[str, float]:
    """Score of each container path of a page: the text of its own blocks
    counts in full, that of containers in it by half a level, links against
    it; the root counts like a body."""
    out: dict[str, float] = {}
    for node, text, linked in found:
        share, level = len(text) - 2.0 * linked, node.container
        if node.tag in ("p", "pre", "blockquote") and len(text) >= 80:
            share *= 1.5
        weight = 1.0
        while level is not None and weight > 0.02:
            named = 1.3 if level.tag in ("article", "main") else 1.0
            out[level.path] = out.get(level.path, 0.0) + share * weight * named
            weight *= 0.5
            level = level.parent.container if level.parent is not None else None
    return out


def main_text(page: str, winners: list[str]) -> str:
    """Text of a page's blocks in the lowest container that holds those under
    the best of ``winners`` that it has, else under its own best container, and
    all blocks that are not mainly links."""
    found = blocks(page)
    if not found:
        return ""
    own = scores(found)
    path = next((w for w in winners if own.get(w, 0.0) > 0), None) or max(own, key=lambda p: (own[p], -len(p), p), default="")

    def around(node: Node) -> list[Node]:
        """The containers of a node, the outermost first."""
        out, level = [], node.container
        while level is not None:
            out.append(level)
            level = level.parent.container if level.parent is not None else None
        return out[::-1]

    chains = [around(node) for node, _, _ in found]
    held = None
    for (_, text, linked), chain in zip(found, chains):
        depth = next((k for k, x in enumerate(chain) if x.path == path), None)
        if depth is None and 2 * linked > len(text):
            continue
        # a block under the winner asks for the winner, any other for its own container
        asked = chain if depth is None else chain[: depth + 1]
        held = asked if held is None else [x for x, y in zip(held, asked) if x is y]
    lowest = held[-1] if held else None
    return " ".join(text for (_, text, _), chain in zip(found, chains) if lowest is None or any(x is lowest for x in chain))


def host_of(column):
    host = F.lower(F.regexp_extract(F.coalesce(column.cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def host_paths(pages: DataFrame, url: str = "url", page: str = "html", kept: int = 3) -> DataFrame:
    """``host`` and ``paths``, the ``kept`` paths of the largest support.

    Support is the sum over pages of the square root of the page's score, so that one long page
    does not outvote the others; equal supports go to the shorter path.
    """
    text_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes: dict[tuple[str, str], float] = {}
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for path, score in scores(blocks(text)).items():
                    if score > 0:
                        votes[host, path] = votes.get((host, path), 0.0) + score**0.5
            yield pa.RecordBatch.from_arrays([
                pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.string()), pa.array(list(votes.values()), pa.float64())],
                names=["host", "path", "support"])

    rows = pages.select(host_of(F.col(url)).alias("host"), F.coalesce(F.col(page).cast("string"), F.lit("")).alias("html"))
    votes = rows.mapInArrow(run, "host string, path string, support double").groupBy("host", "path").agg(F.sum("support").alias("support"))
    order = Window.partitionBy("host").orderBy(F.round("support", 3).desc(), F.length("path"), "path")
    best = votes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= kept)
    return written(best.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("rank", "path"))).alias("p")).select(
        "host", F.transform("p", lambda x: x["path"]).alias("paths")), "paths")


def extract(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), url: str = "url", page: str = "html") -> DataFrame:
    """``keys``, ``text`` and ``n_chars`` of each page.

    NULL pages have an empty text; a NULL or odd url is of the host "" with its
    own vote; repeated rows vote and answer each; an empty table gives no rows.
    """
    names = [f"key{i}_" for i in range(len(keys))]
    rows = pages.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], host_of(F.col(url)).alias("host"),
                        F.coalesce(F.col(page).cast("string"), F.lit("")).alias("html"))
    # hosts are joined without moving pages where their table is small
    rows = rows.join(host_paths(pages, url, page), "host", "left").select(*names, "html", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns
            texts = [main_text(h, p or []) for h, p in zip(batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(n - 2)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*names, "text", "n_chars"])

    schema = ", ".join([*(f"{n} {pages.schema[k].dataType.simpleString()}" for k, n in zip(keys, names)), "text string", "n_chars bigint"])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "text", "n_chars")
