"""Main text of web pages: structure first, then the templates a site repeats.

Pages are parsed once into text blocks; the pieces of a block, one per element that text
stands in, have the hashes of all elements that contain them whole. Spark counts every element
subtree per host over pages with different content; recurring subtrees are its template and
their pieces of text go. In a marked main part, where real lines repeat as well, a subtree must
be on half of the host's pages; on a page that marks none, on a small share of them. Articles
that are little more than links beside the text of the page mark nothing.

A null or empty page has no text. Pages with a null or odd address form hosts of their own
name (null: empty). Copies of a page count once, so repeated articles are no template.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import keep

#: A subtree is template from this many different pages of a host on, and this share of them:
#: inside a marked main part, and on pages without one.
LEAST_PAGES, LEAST_SHARE, OPEN_SHARE = 4, 0.5, 0.02

#: Elements that never hold main text. Fixed values.
DROPPED_TAGS = frozenset(
    "head title nav footer aside form script style noscript template iframe svg canvas object button select"
    " option textarea menu dialog math audio video map label fieldset".split()
)
#: Whole names in class or id that mark an element as furniture. Fixed values; names that text
#: bears as well (alert, notice, header, search, related) are left to the counts.
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising ad-banner ad-container ad-slot ad-wrapper breadcrumb"
    " breadcrumbs comments comment-list comment-form comments-area cookie cookies cookie-banner cookie-consent"
    " cookie-notice consent disqus footer site-footer page-footer site-header login masthead menu main-menu modal"
    " nav nav-bar nav-menu main-nav site-nav top-nav navbar navigation newsletter newsletter-signup pagination"
    " popup promo related-articles related-posts share-buttons sidebar side-bar signup skip-link social-links"
    " social-share sponsor sponsored subscribe toolbar".split()
)
#: Whole names of what readers wrote: dropped with all it holds, articles too. The second set
#: names a single comment, which also is what some sites call an opinion piece: inside a main
#: part only. Fixed values.
COMMENT_NAMES = frozenset("comments comment-list comment-form comments-area comments-section commentlist disqus_thread".split())
ONE_COMMENT = frozenset("comment comment-body comment-content".split())
#: Text outside links in the marked main parts must come to this share of that beside them.
MAIN_SHARE = 0.25
DROPPED_ROLES = frozenset("alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
#: Furniture by name, and these tags, stay if one of these is inside or is the element itself.
YIELDING_TAGS, HELD_TAGS = frozenset({"form", "header"}), frozenset({"article", "main", "h1"})
BLOCK_TAGS = frozenset(
    "address article blockquote body dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html"
    " li main ol p pre section summary table tbody td tfoot th thead tr ul caption center".split()
) | (DROPPED_TAGS - {"button", "select", "label", "svg", "math"})
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag ends these open elements of its own level.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody"}, "body": {"head"},
}
_SCOPES = frozenset({"ul", "ol", "dl", "table", "select", "article", "main", "section", "div", "td", "body", "html"})

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|noscript|iframe|title|xmp)\b(?P<rawattrs>[^>]*)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_WHITE = re.compile(r"\s+")


class _Element:
    __slots__ = ("tag", "dropped", "furniture", "holds", "main", "link", "parts", "pieces", "parent")

    def __init__(self, tag: str, parent: _Element | None, dropped: bool, main: bool):
        self.tag, self.parent, self.dropped, self.main = tag, parent, dropped, main
        self.link = tag == "a" or (parent is not None and parent.link)
        self.furniture = False  # dropped at its end unless it holds a main part
        self.holds = tag in HELD_TAGS
        self.parts: list[bytes] = []  # what the subtree hash covers
        self.pieces: list[list] = []  # pieces of text inside, to be given the hash


def _attributes(raw: str) -> dict[str, str]:
    """Values by lower-case name; the first of equal names counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _names(attrs: dict[str, str]) -> set[str]:
    return {n for key in ("class", "id") for n in attrs.get(key, "").lower().split()}


def _is_dropped(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    if tag in DROPPED_TAGS - YIELDING_TAGS:
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or _NO_DISPLAY.search(attrs.get("style", "")):
        return True
    names = _names(attrs)
    return not COMMENT_NAMES.isdisjoint(names) or (in_main and not ONE_COMMENT.isdisjoint(names))


def _is_furniture(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    if tag == "form" or (tag == "header" and not in_main):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    roles = attrs.get("role", "").lower().split()
    return not (DROPPED_NAMES.isdisjoint(_names(attrs)) and DROPPED_ROLES.isdisjoint(roles))


def parse_blocks(page: str | None) -> tuple[list[list[tuple[str, list[int]]]], bool]:
    """Blocks in page order, as pieces with the subtree hashes around each; whether the page
    marks its main part, in which case only blocks in there are given. White space in a piece
    is single spaces."""
    text = page or ""
    root = _Element("", None, False, False)
    node, at = root, 0
    blocks: list[list] = []  # pieces: [texts, in main, hashes, element, dropped]
    current: list | None = None

    def add(raw: str) -> None:
        nonlocal current
        if not raw or node.dropped:
            return
        if current is None:
            if not raw.strip():
                return
            current = []
            blocks.append(current)
        if not current or current[-1][3] is not node:
            current.append([[], node.main, [], node, False])
            node.pieces.append(current[-1])
        current[-1][0].append(entities.unescape(raw) if "&" in raw else raw)
        node.parts.append(raw.encode("utf-8", "surrogatepass"))

    def close() -> None:
        nonlocal node, current
        gone, node = node, node.parent
        if gone.tag in BLOCK_TAGS:
            current = None
        if gone.dropped:
            return
        if gone.furniture and not gone.holds:
            for piece in gone.pieces:
                piece[4] = True
            return
        node.holds |= gone.holds
        if not gone.parts:
            node.pieces += gone.pieces
            return
        digest = blake2b(gone.tag.encode() + b"\0" + b"\1".join(gone.parts), digest_size=8).digest()
        number = int.from_bytes(digest, "little", signed=True)
        for piece in gone.pieces:
            piece[2].append(number)
        node.pieces += gone.pieces
        node.parts.append(digest)

    for m in _TOKEN.finditer(text):
        add(text[at : m.start()])
        at = m.end()
        if m["close"]:
            tag = m["close"].lower()
            seek = node
            while seek is not root and seek.tag != tag:
                seek = seek.parent
            if seek is not root:
                while node is not seek:
                    close()
                close()
            elif tag in ("p", "br"):
                current = None if tag == "p" else current
        elif m["open"]:
            tag = m["open"].lower()
            if tag in VOID_TAGS:
                if tag == "hr":
                    current = None
                elif tag == "br":
                    add(" ")
                continue
            if tag in BLOCK_TAGS:
                seek = node
                while seek is not root and seek.tag != "p" and seek.tag not in _SCOPES:
                    seek = seek.parent
                if seek.tag == "p":
                    while node is not seek:
                        close()
                    close()
            if tag in ENDS:
                seek = node
                while seek is not root and seek.tag not in ENDS[tag] and (seek.tag not in _SCOPES or seek.tag in ENDS[tag]):
                    seek = seek.parent
                if seek is not root and seek.tag in ENDS[tag]:
                    while node is not seek:
                        close()
                    close()
            raw = m["attrs"] or ""
            attrs = _attributes(raw) if raw else {}
            if tag in BLOCK_TAGS:
                current = None
            dropped = node.dropped or _is_dropped(tag, attrs, node.main)
            furniture = not dropped and _is_furniture(tag, attrs, node.main)
            node = _Element(tag, node, dropped, not dropped and (node.main or tag in ("article", "main")))
            node.furniture = furniture
            if raw.rstrip().endswith("/") and tag not in BLOCK_TAGS:
                close()
        elif m["raw"]:
            current = None if m["raw"].lower() not in ("script", "style") else current
    add(text[at:])
    while node is not root:
        close()
    held = {True: 0, False: 0}
    for block in blocks:
        for texts, main, _, element, gone in block:
            if not gone and not element.link:
                held[main] += sum(len(t.strip()) for t in texts)
    marked = any(piece[1] and not piece[4] for block in blocks for piece in block)
    marked = marked and held[True] >= MAIN_SHARE * held[False]
    out = []
    for block in blocks:
        pieces = [
            (_WHITE.sub(" ", "".join(texts)), hashes)
            for texts, main, hashes, _, gone in block
            if not gone and (main or not marked)
        ]
        if any(text.strip() for text, _ in pieces):
            out.append(pieces)
    return out, marked


def line_of(pieces: list[tuple[str, list[int]]]) -> str:
    return _WHITE.sub(" ", "".join(text for text, _ in pieces)).strip()


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without user, port and a leading ``www.``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def page_blocks(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, host, a hash of all its blocks, whether they are of a marked main
    part, and the blocks."""
    source = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    kind = pa.list_(pa.list_(pa.struct([("text", pa.string()), ("around", pa.list_(pa.int64()))])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, marks, rows = [], [], []
            for page in batch.column(3):
                found, marked = parse_blocks(page.as_py())
                marks.append(marked)
                digest = blake2b("\n".join(map(line_of, found)).encode("utf-8", "replace"), digest_size=8)
                bodies.append(int.from_bytes(digest.digest(), "little", signed=True))
                rows.append([[{"text": t.encode("utf-8", "replace").decode(), "around": h} for t, h in b] for b in found])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(bodies, pa.int64()), pa.array(marks, pa.bool_()), pa.array(rows, kind)],
                ["page_id", "url", "host", "body", "marked", "blocks"],
            )

    key = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"page_id {key}, url string, host string, body bigint, marked boolean, "
        "blocks array<array<struct<text:string,around:array<bigint>>>>",
    )


def _around(blocks: str) -> Column:
    return F.array_distinct(F.flatten(F.transform(F.flatten(blocks), lambda x: x["around"])))


def site_templates(parsed: DataFrame) -> DataFrame:
    """Per host with any: the hashes of its recurring subtrees, ``template`` by OPEN_SHARE and
    ``strict`` by LEAST_SHARE.

    A host's list is short: each entry is on a fixed share of its pages, so there are at most
    1 / OPEN_SHARE times as many as elements on an average page.
    """
    seen = (
        parsed.select("host", "body", F.explode(_around("blocks")).alias("subtree"))
        .groupBy("host", "subtree", "body")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("host", "subtree")
        .agg(F.count(F.lit(1)).alias("n_pages"))
        .where(F.col("n_pages") >= LEAST_PAGES)
    )
    sizes = parsed.groupBy("host", "body").agg(F.count(F.lit(1)).alias("n")).groupBy("host").agg(
        F.count(F.lit(1)).alias("host_pages")
    )
    strict = F.when(F.col("n_pages") >= LEAST_SHARE * F.col("host_pages"), F.col("subtree"))
    return (
        seen.join(sizes, "host")
        .where(F.col("n_pages") >= OPEN_SHARE * F.col("host_pages"))
        .groupBy("host")
        .agg(F.collect_list("subtree").alias("template"), F.collect_list(strict).alias("strict"))
    )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars."""
    parsed = keep(page_blocks(pages), "page-blocks")
    templates = keep(site_templates(parsed), "page-templates")
    joined = parsed.join(templates, "host", "left")
    listed = F.when(F.col("marked"), F.col("strict")).otherwise(F.col("template"))
    # Once per page, as the only element of an array: what of the host's list the page has.
    hits = F.array_intersect(_around("blocks"), F.coalesce(listed, F.array().cast("array<bigint>")))

    def line(block: Column, hit: Column) -> Column:
        own = F.filter(block, lambda x: ~F.arrays_overlap(x["around"], hit))
        return F.trim(F.regexp_replace(F.concat_ws("", F.transform(own, lambda x: x["text"])), " +", " "))

    lines = F.transform(F.array(hits), lambda hit: F.transform("blocks", lambda b: line(b, hit)))[0]
    text = F.concat_ws("\n", F.filter(lines, lambda t: t != ""))
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
