"""Main text of web pages, with removal of each site's template.

Two passes over the pages. The first parses a page into elements and hashes, from the leaves up, the subtree (tags and
text) of every container that does not hold the article, and of the article. Containers outside the article whose text
is all links also get a hash of their shape (tags and classes without text or repeated neighbours), so that
navigation recurs though its links change. Spark counts, per host, the pages each hash occurs on. A hash on at least ``MIN_PAGES`` pages and ``MIN_SHARE`` of the host's pages is template.
As a page has so many subtrees and each template hash takes a share of the pages, a host's list holds
at most ``subtrees per page / MIN_SHARE`` hashes. The second pass joins a page with its host's list,
deletes the recurring subtrees and what markup itself names as furniture (navigation, headers,
footers, sidebars, notices, adverts, forms, comments, scripts and the like), and reads the blocks
that remain in the article, else in the main part, else in the body.

Paragraphs, headings and list items that recur are text, not template, and an article that recurs as a
whole is a copy, inside which nothing counts as template. A text block's white space becomes single spaces; blocks are joined by an
empty line. Class words do not remove ``html``, ``body``, the only article, or what would leave the page without text.

Cases: null or empty html gives an empty text; broken markup never fails (an unclosed tag, comment
or quote ends at its line's next ">" or the end); a null or odd url counts as the host ""; repeated
pages count once each; further columns are not looked at.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthloom.llm.common import map_batches, texts

MIN_PAGES, MIN_SHARE = 10, 0.1
SALTS = 64  # tasks that share a host's pages in the join with its template
DEEPEST = 300  # elements further down become children of the one at this depth, as in browsers

# Element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
UNSEEN = RAW | frozenset("head object svg math canvas audio video map select option button datalist input label fieldset".split())
FURNITURE = frozenset("nav footer aside form dialog menu".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption option optgroup legend".split())
CONTAINER = frozenset("aside center dl div footer form header menu nav ol section table ul".split())
#: An opening tag ends open elements of these names, up to one of the others.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words in a class or id that name furniture.
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline captcha comment comments commentlist consent "
    "cookie cookies disclaimer disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination paywall popup promo promoted promotion recommended related respond reply replies share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)

#: With one of these a class names a state of the page, not an element.
STATES = frozenset("has no with without open closed on off enabled disabled".split())
#: What "related" has to stand beside, or alone, to name furniture.
RELATED = frozenset("article articles content items links news pages post posts products reading stories topics videos".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Element:
    __slots__ = ("tag", "parent", "children", "depth", "dropped", "named", "main", "classes", "holds", "heading", "subtree", "shape", "links", "other")

    def __init__(self, tag: str, parent: Element | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.depth = parent.depth + 1 if parent is not None else 0
        self.main = tag in ("article", "main")
        self.dropped = tag in UNSEEN or tag in FURNITURE
        self.named = False  # as furniture, by class or id
        self.classes = ""
        if attributes and not self.dropped and tag not in ("html", "body"):
            self.read(attributes)
        if parent is not None:
            parent.children.append(self)

    def read(self, attributes: str) -> None:
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or "").strip("\"'")
            if name in ("class", "id"):
                self.named |= any(map(names_furniture, value.split()))
                self.classes += value if name == "class" else ""
            elif name == "role":
                self.dropped |= value.lower() in ROLES
                self.main |= value.lower() in ("main", "article")
            elif name == "style":
                self.dropped |= bool(HIDDEN_STYLE.search(value))
            else:
                self.dropped |= name == "hidden" or value.lower() == "true"


def names_furniture(token: str) -> bool:
    words = set(re.split(r"[_-]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower()))
    if len(words) > 1 and "related" in words and words.isdisjoint(RELATED):
        words.discard("related")
    return words.isdisjoint(STATES) and not words.isdisjoint(WORDS)


def parse(html: str) -> Element:
    """Tree of elements and strings (character references not yet decoded)."""
    root = Element("#root", None)
    here, at, n = root, 0, len(html)
    for m in iter_tokens(html):
        a, b, closing, tag, attributes = m
        if a > at:
            here.children.append(html[at:a])
        at = b
        if tag is None:
            continue
        if closing:
            node = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                here = node.parent
            continue
        if tag in CLOSES_P:
            here = close(here, {"p"}, CONTAINER | {"td", "th", "article", "main", "blockquote", "li", "dd", "figure", "body"})
        if tag in IMPLIED:
            here = close(here, *IMPLIED[tag])
        node = Element(tag, here, attributes)
        if tag not in VOID and not attributes.endswith("/") and tag not in RAW and node.depth < DEEPEST:
            here = node
    if at < n:
        here.children.append(html[at:])
    return root


def iter_tokens(html: str):
    """``start, end, closing, tag, attributes`` of markup; tag is None for comments. Raw elements are one token."""
    at = 0
    while m := TOKEN.search(html, at):
        at = m.end()
        tag = m[2] or m[5]
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if tag:
            tag = tag.lower()
            if tag in RAW and not closing:
                end = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
        yield m.start(), at, bool(closing), tag, attributes.strip()


def close(here: Element, names: set[str], stops: set[str]) -> Element:
    """Where an opening tag belongs after ending the outermost open element of these names."""
    node, found = here, None
    while node.parent is not None and node.tag not in stops:
        if node.tag in names:
            found = node
        node = node.parent
    return found.parent if found else here


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def measure(node: Element, hashes: bool) -> Element:
    """Sets, from the leaves up, whether an element holds the article or a main heading and, with ``hashes``, what it is and looks like."""
    parts, shapes, links, other = [], [], 0, False
    node.holds, node.heading = node.main, node.tag == "h1"
    for child in node.children:
        if isinstance(child, str):
            if hashes and (text := " ".join(child.split())):
                parts.append(text)
                other = True
            continue
        measure(child, hashes)
        node.holds |= child.holds
        node.heading |= child.heading
        if hashes and child.tag not in UNSEEN:
            if child.subtree is not None:
                parts.append(f"\0{child.subtree}")
            if not shapes or shapes[-1] != child.shape:
                shapes.append(child.shape)
            links += child.links
            other |= child.other
    if hashes:
        is_link = node.tag == "a" and bool(parts)
        node.subtree = digest("\n".join([node.tag, *parts])) if parts else None
        node.shape = digest("\n".join(["\0shape", node.tag, re.sub(r"[0-9]+", "", node.classes), *map(str, shapes)]))
        node.links, node.other = (1, False) if is_link else (links, other)
    return node


def navigates(node: Element) -> bool:
    return node.links > 1 and not node.other


def subtrees(node: Element, found: set[int], inside: bool = False) -> set[int]:
    """Hashes of the containers that do not hold the article, of the article itself, and of the shapes of navigation."""
    for child in node.children:
        if not isinstance(child, str):
            if child.subtree is not None and (child.main or child.tag in CONTAINER and not child.holds):
                found.add(child.subtree)
                if not inside and not child.main and navigates(child):
                    found.add(child.shape)
            subtrees(child, found, inside or child.main)
    return found


def spare(node: Element) -> bool:
    """Whether an article or main part stands here that nothing names as furniture."""
    return any(not isinstance(c, str) and (c.main and not (c.dropped or c.named) or spare(c)) for c in node.children)


def remove_furniture(node: Element, template: frozenset[int], words: bool, spared: bool, inside: bool = False) -> None:
    """``words``: whether classes and ids count; ``spared``: whether an article is left that they do not name."""
    kept = []
    for child in node.children:
        if isinstance(child, str):
            kept.append(child)
            continue
        holds = child.holds or inside and child.heading
        header = child.tag == "header" and not inside
        recurring = bool(template) and child.tag in CONTAINER and not holds
        recurring = recurring and (child.subtree in template or not inside and navigates(child) and child.shape in template)
        named = words and child.named
        if child.tag in UNSEEN or not holds and (child.dropped or named or header or recurring) or child.main and (child.dropped or named and spared):
            continue
        kept.append(child)
        copied = child.main and bool(template) and child.subtree in template
        remove_furniture(child, frozenset() if copied else template, words, spared, inside or child.main)
    node.children = kept


def mains(node: Element, tag: str) -> list[Element]:
    """Outermost elements of a tag."""
    out = []
    for child in node.children:
        if not isinstance(child, str):
            out += [child] if child.tag == tag else mains(child, tag)
    return out


def blocks(nodes: list[Element]) -> list[str]:
    out, current = [], []

    def end() -> None:
        text = " ".join(unescape("".join(current)).split())
        if text:
            out.append(text)
        current.clear()

    def walk(node: Element) -> None:
        for child in node.children:
            if isinstance(child, str):
                current.append(child)
            elif child.tag == "br":
                current.append(" ")
            elif child.tag in BLOCK:
                end()
                walk(child)
                end()
            else:
                walk(child)

    for node in nodes:
        walk(node)
        end()
    return out


def main_text(html: str, template: frozenset[int] = frozenset()) -> str:
    nothing: frozenset[int] = frozenset()
    for own, words in dict.fromkeys(((template, True), (nothing, True), (nothing, False))):  # a page that is nothing but template keeps its text
        root = measure(parse(html), bool(own))
        remove_furniture(root, own, words, spare(root))
        for nodes in (mains(root, "article"), mains(root, "main"), [root]):
            if found := blocks(nodes):
                return "\n\n".join(found)
    return ""


def _host(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", "html", F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit(""))).alias("host"))


def templates(pages: DataFrame) -> DataFrame:
    """``host, template``: the hashes of the subtrees that recur across many of the host's pages."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            hosts, hashes = [], []
            for host, html in zip(batch.column(0).to_pylist(), texts(batch, "html"), strict=True):
                own = subtrees(measure(parse(html), True), set()) if html else set()
                hosts += [host] * (len(own) + 1)
                hashes += [None, *own]
            return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64())], ["host", "subtree"])

        return work

    seen = map_batches(_host(pages).select("host", "html"), make, "host string, subtree bigint")
    counts = seen.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("pages"))
    total = counts.filter("subtree is null").select("host", F.col("pages").alias("all_pages"))
    often = counts.filter((F.col("pages") >= MIN_PAGES) & F.col("subtree").isNotNull()).join(total, "host")
    return often.filter(F.col("pages") >= MIN_SHARE * F.col("all_pages")).groupBy("host").agg(F.collect_list("subtree").alias("template"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of ``pages(page_id, url, html)``."""

    def make():
        known: dict[str, frozenset[int]] = {}

        def template_of(host: str, column, i: int) -> frozenset[int]:
            if host not in known:
                if len(known) > 1000:
                    known.clear()
                known[host] = frozenset(column[i].as_py() or ())
            return known[host]

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            hosts, column = batch.column(3).to_pylist(), batch.column(4)
            found = [main_text(html, template_of(host, column, i)) if html else "" for i, (host, html) in enumerate(zip(hosts, texts(batch, "html"), strict=True))]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

        return work

    rows = _host(pages).withColumn("page_id", F.col("page_id").cast("bigint"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    spread = templates(pages).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.join(spread, ["host", "salt"], "left").select("page_id", "url", "html", "host", "template")
    return map_batches(joined, make, "page_id bigint, url string, text string, n_chars bigint")
