"""Main text of web pages, without the parts that a site repeats.

A page is parsed once into its text blocks; each carries the hashes of the element subtrees it lies in. Spark counts, for each host, on
how many of its distinct pages a subtree occurs, and blocks inside subtrees that recur on many of them are deleted. Menus, footers,
adverts and the like are also told by their tags and attributes, as a host with few pages has no counts to go by.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, column_bytes, written

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
DROPPED = frozenset("head nav footer aside form script style noscript template button select textarea iframe svg math canvas object dialog menu "
                    "audio video map datalist fieldset input label noembed noframes".split())
BLOCK = frozenset("html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure "
                  "figcaption address header hgroup details summary hr center nav footer aside form fieldset".split())
#: A start tag closes an open `p`, or an open sibling of its own kind, up to the nearest of the listed containers.
ENDS_P = BLOCK - {"html", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption"}
SIBLINGS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
            "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)),
            "thead": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)), "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",))}
#: Words of a class or id that mark a part as other than the article.
MARKED = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert "
                   "popup modal overlay newsletter subscribe subscription sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs crumbs toolbar pager "
                   "pagination masthead footer foot header topbar comment comments disqus respond reply replies discussion social share sharing sharebar related "
                   "recommended recommendations widget login signin signup skip copyright search paywall disclaimer".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
#: The few of them that count for an `article` or `main` too.
MARKED_ARTICLE = frozenset("ad ads advert advertisement sponsor sponsored promo comment comments reply replies related recommended".split())

TOKEN = r"""(?s)<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*(?:"[^"]*"|'[^']*')|[^>])*+)>"""
ATTRIBUTE = r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?"""
LAST_BIT = (1 << 63) - 1


class Node:
    __slots__ = ("tag", "parent", "items", "dropped", "marked", "main", "hash")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, marked: bool, main: bool):
        self.tag, self.parent, self.items, self.dropped, self.marked, self.main, self.hash = tag, parent, [], dropped, marked, main, 0


def marks(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element is dropped, is marked as other than the article by its names, is the main part."""
    if tag in DROPPED or tag == "header" and not in_article:
        return True, False, False
    main = tag in ("article", "main")
    if not attributes or attributes.isspace():
        return False, False, main
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in re.finditer(ATTRIBUTE, attributes)}
    role = found.get("role", "").lower()
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or role in ROLES or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True, False, False
    if tag in ("html", "body"):
        return False, False, False
    names = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", f"{found.get('class', '')} {found.get('id', '')}")
    words = set(re.findall(r"[a-z]+", names.lower()))
    marked = bool(words & (MARKED_ARTICLE if main else MARKED))
    return False, marked, not marked and (main or role in ("main", "article"))


def parse(page: str) -> Node:
    """Element tree of a page as browsers would nest it, as far as text is concerned."""
    root = Node("", None, False, False, False)
    at, pos, depth = root, 0, 0
    token = re.compile(TOKEN)
    while True:
        m = token.search(page, pos)
        text = page[pos : m.start() if m else len(page)]
        if text:
            at.items.append(text)
        if not m:
            return root
        pos = m.end()
        name = m[2]
        if not name:
            if m[0].startswith("<![CDATA["):
                at.items.append(m[0][9:-3].replace("&", "&amp;"))
            continue
        tag = name.lower()
        if m[1]:
            node, stops = at, ("ul", "ol", "menu") if tag == "li" else () if tag in BLOCK else BLOCK
            while node.parent and node.tag != tag and node.tag not in stops:
                node = node.parent
            if node.parent and node.tag == tag:
                while True:
                    depth -= at.tag == "article"
                    at = at.parent
                    if at is node.parent:
                        break
            continue
        closes, stops = (("p",), ("button", "table", "td", "th", "caption")) if tag in ENDS_P else ((), ())
        for closed, within in ((closes, stops), SIBLINGS.get(tag, ((), ()))):
            node = at if closed else root
            while node.parent and node.tag not in within and node.tag not in closed:
                node = node.parent
            if node.parent and node.tag in closed:
                while at is not node.parent:
                    depth -= at.tag == "article"
                    at = at.parent
                if tag in SIBLINGS and at.tag in closed:
                    while at.parent and at.tag in closed:
                        at = at.parent
        node = Node(tag, at, *marks(tag, m[3], depth > 0))
        at.items.append(node)
        if tag in RAW:
            end = re.compile(rf"(?i)</{tag}\s*>").search(page, pos)
            node.items.append(page[pos : end.start() if end else len(page)] if tag == "textarea" else "")
            pos = end.end() if end else len(page)
        elif tag not in VOID and not (m[3].endswith("/") and tag in ("svg", "path")):
            at = node
            depth += tag == "article"


def hash_subtrees(root: Node) -> None:
    """A hash of tag, own text and child subtrees for every element that has text; 0 for others. An element whose names mark it is dropped,
    unless it holds the main part."""
    import xxhash

    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [x for x in node.items if type(x) is Node]
    holds: set[int] = set()
    for node in reversed(order):
        if node.main or any(id(x) in holds for x in node.items if type(x) is Node and not x.dropped):
            holds.add(id(node))
        elif node.marked:
            node.dropped = True
        parts = [x.hash.to_bytes(8, "little") if type(x) is Node else " ".join(x.split()).encode("utf-8", "replace") for x in node.items]
        if any(p and p != bytes(8) for p in parts):
            node.hash = xxhash.xxh64_intdigest(node.tag.encode("utf-8", "replace") + b"\0" + b"\0".join(parts)) & LAST_BIT or 1


def blocks(page: str) -> list[tuple[str, list[int]]]:
    """Text blocks of the page's main part in page order, each with the hashes of the elements around it.

    The main part is what lies in `article` elements, else in `main` (or an element of that role), else in the whole body.
    """
    root = parse(page)
    hash_subtrees(root)
    found: list[Node] = []

    def collect(wanted) -> list[Node]:
        out, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.dropped:
                continue
            if wanted(node):
                out.append(node)
            else:
                stack += [x for x in reversed(node.items) if type(x) is Node]
        return [n for n in out if n.hash]

    found = collect(lambda n: n.tag == "article") or collect(lambda n: n.main) or [root]
    out: list[tuple[str, list[int]]] = []
    for top in found:
        pieces: list[str] = []
        owner: list[int] = []

        def close():
            text = " ".join(html.unescape("".join(pieces)).split()) if any(pieces) else ""
            if text:
                out.append((text, list(owner)))
            pieces.clear()

        stack: list[tuple] = [(top, False)]
        path: list[int] = []
        while stack:
            item, leaving = stack.pop()
            if type(item) is str:
                if not any(pieces):
                    owner[:] = path
                pieces.append(item)
                continue
            if leaving:
                if item.tag in BLOCK:
                    close()
                path.pop()
                continue
            if item.dropped:
                if item.tag in BLOCK:
                    close()
                continue
            if item.tag in BLOCK:
                close()
            elif item.tag in VOID:
                pieces.append(" ")
                continue
            # An inline element need not hold all of its block, so it does not stand for it.
            path.append(item.hash if item is not top and item.tag in BLOCK else 0)
            stack.append((item, True))
            stack += [(x, False) for x in reversed(item.items)]
        close()
    return [(text, [h for h in path if h]) for text, path in out]


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, blocks array<struct<text, inside array<long>>>) of every page."""
    arrow_batches(pages.sparkSession)
    kind = pa.struct([("text", pa.string()), ("inside", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [blocks(x.decode("utf-8", "replace")) for x in column_bytes(b, "html")]
            texts = pa.array([t for page in found for t, _ in page], pa.string())
            inside = pa.array([i for page in found for _, i in page], pa.list_(pa.int64()))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in found])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([texts, inside], fields=list(kind)))],
                                             names=["page_id", "url", "host", "blocks"])

    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.col("html"))
    return rows.mapInArrow(run, "page_id long, url string, host string, blocks array<struct<text string, inside array<bigint>>>")


def recurring(found: DataFrame, share: float, many: int, few: int) -> DataFrame:
    """(host, hashes): subtrees on many of a host's distinct pages, those whose blocks have unlike texts: on `share` of them, at least on `many`,
    or on half of the pages of a smaller host, at least on `few`. A host's list is no longer than 1 / share times the mean number of subtrees
    of its pages."""
    page = F.xxhash64("blocks.text")
    distinct = written(found.groupBy("host", page.alias("page")).agg(F.min(F.array_distinct(F.flatten("blocks.inside"))).alias("inside")))
    totals = distinct.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= few)
    counts = distinct.select("host", F.explode("inside").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= few)
    need = F.greatest(F.lit(few), F.least(F.lit(many), F.ceil(F.col("pages") / 2)), F.ceil(F.col("pages") * share))
    return counts.join(totals, "host").where(F.col("n") >= need).groupBy("host").agg(F.collect_list("hash").alias("hashes"))


def main_text(pages: DataFrame, share: float = 0.02, many: int = 5, few: int = 3, broadcast_hashes: int = 500_000) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, from its whole html.

    Null or empty html, and pages without a main part, give an empty text. Rows may repeat and ids and urls may be null; pages whose url has no
    host count as one host. Tables of templates of up to `broadcast_hashes` hashes are sent to the tasks, larger ones are joined by host.
    Empty input gives no rows; other columns are ignored.
    """
    found = written(parsed(pages))
    templates = written(recurring(found, share, many, few))
    size = templates.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]
    joined = found.join(F.broadcast(templates) if size <= broadcast_hashes else templates, "host", "left")
    kept = F.when(F.col("hashes").isNull(), F.col("blocks")).otherwise(F.element_at(F.transform(
        F.array(F.array_intersect(F.flatten("blocks.inside"), "hashes")), lambda cut: F.filter("blocks", lambda b: ~F.arrays_overlap(b.inside, cut))), 1))
    text = F.array_join(F.transform(kept, lambda b: b.text), "\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
