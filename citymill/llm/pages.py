"""Main text of HTML pages by removal of site templates and of elements that are never content.

1. Every page is read into a tree; each element's subtree is hashed together with its host.
2. Spark counts, for each host, in how many different pages a subtree occurs; pages that are
   copies of each other (the same text throughout and the same subtrees) count once. Subtrees (of
   block elements, in articles of containers) found in at least `min_pages` pages and in `share`
   of the host's pages are the site's template.
3. Template subtrees are deleted, and so are menus, headers, footers, sidebars, notices,
   adverts, forms, scripts, styles and comments, told by their element, role, class or id. An
   article is never told by its class, nor does it go with an element laid round it.
   Where a page has article (else main) elements, only their text is read.

Null or empty html gives the empty text. A null url is a host of its own. Very long pages are
read whole. Repeated rows get the same text; null ids stay; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MIN_PAGES = 8
SHARE = 0.5
BROADCAST_ROWS = 500_000  # template hashes, 4 MB; beyond that they are joined

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe|svg|math|template|object)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/!?a-zA-Z][^>]*+>""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label|hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr del label".split())
DROPPED = frozenset("nav footer aside form head button select dialog menu fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Class or id words that tell what is not content: a name of such words and of PARTS, as site-footer.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay sidebar sidenav widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer comment comments respond disqus related share sharing social newsletter subscribe signup login pagination pager masthead skip".split()
)
#: Words that say where or what part it is, and leave the meaning of a name to the others.
PARTS = frozenset("area bar block bottom box button buttons column container content float fixed form global group icon icons inline inner item left link links list main media mobile nav outer page panel post posts primary right row secondary section site slot sticky text title toggle top unit wrap wrapper".split())
#: These tell it only as a whole name, as in class="header".
WHOLE_NAMES = frozenset("header site-header page-header top-header topbar alert side rail toolbar search searchbox".split())
#: An open element on the left is closed when one of the elements on the right begins or a parent ends.
CLOSED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
}
SCOPES = frozenset("ul ol dl table select article section div body html main aside nav footer header form".split())
NEVER = frozenset("html head body meta article main".split())
HELD = frozenset(["article", "main"])
#: Elements that may be laid round a whole page, and go only where they hold no article.
AROUND = frozenset("div section form table tbody tr td fieldset span center".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre tr td th".split())
SPACES = re.compile(r"[\s ]+")


@dataclass
class Node:
    tag: str
    start: int
    dropped: bool
    parent: int
    first: int  # index of its first text run
    inner: int = -1  # where its first tag ends
    end: int = -1
    last: int = -1
    hash: int = 0
    hidden: bool = False
    content: bool = False  # in an article
    holds: bool = False  # an article, or a heading of the first rank


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    runs: list[tuple[str | None, int]] = field(default_factory=list)  # text, or None at a block's edge; its node


def unwanted(name: str) -> bool:
    """Whether a class or id names what is never content; a word that is neither in NAMES nor in PARTS makes it another thing."""
    if name in WHOLE_NAMES or name in NAMES:
        return True
    own = set(re.split(r"[^a-z]+", name)) - {""}
    return bool(own & NAMES) and own <= NAMES | PARTS


def names_drop(tag: str, attributes: str) -> bool:
    """Whether an element is never content, by its role, class or id."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role" and value.strip() in ROLES or name == "hidden" and tag != "body":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name in ("class", "id") and any(unwanted(whole) for whole in value.split()):
            return True
    return False


def parse(source: str) -> Page:
    """The tree of a page; unclosed elements end with their parents, stray end tags are ignored."""
    page = Page()
    nodes, runs = page.nodes, page.runs
    nodes.append(Node("#", 0, False, -1, 0))
    stack = [0]

    def close(at: int) -> None:
        node = nodes[stack.pop()]
        node.end, node.last = at, len(runs)
        if node.tag not in INLINE:
            runs.append((None, stack[-1] if stack else 0))

    position = 0
    for m in TOKEN.finditer(source):
        if m.start() > position:
            runs.append((source[position : m.start()], stack[-1]))
        position = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            if tag == "br":
                runs.append((None, stack[-1]))
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    while len(stack) > depth + 1:
                        close(m.start())
                    close(m.end())
                    break
                if nodes[stack[depth]].tag in SCOPES and tag in INLINE:
                    break
            continue
        if tag in VOID:
            if tag not in INLINE:
                runs.append((None, stack[-1]))
            continue
        for depth in range(len(stack) - 1, 0, -1):
            open_tag = nodes[stack[depth]].tag
            if tag in CLOSED_BY.get(open_tag, ()):
                while len(stack) > depth:
                    close(m.start())
                break
            if open_tag in SCOPES:
                break
        if tag not in INLINE:
            runs.append((None, stack[-1]))
        in_article = tag == "header" and any(nodes[i].tag in ("article", "main") for i in stack)
        dropped = tag in DROPPED or tag == "header" and not in_article or tag not in ("html", "body", "main", "article") and names_drop(tag, m[4])
        nodes.append(Node(tag, m.start(), dropped, stack[-1], len(runs), m.end()))
        if tag in HELD:
            for i in reversed(stack):
                if nodes[i].holds:
                    break  # and so do those around it
                nodes[i].holds = True
        stack.append(len(nodes) - 1)
        if m[4].endswith("/") and tag in INLINE:
            close(m.end())
    if position < len(source):
        runs.append((source[position:], stack[-1]))
    while stack:
        close(len(source))
    return page


def host_of(url: str | None) -> str:
    m = re.match(r"\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", (url or "").lower())
    return m[1] if m else ""


def subtree_hashes(source: str, host: str, page: Page) -> list[int]:
    """Signed 64-bit hash of (host, subtree) for each element that can be template, from the leaves up.

    An element's hash is that of its tag, its attributes, its own text and its children's hashes
    in order, so the work grows with the page and not with its depth. Inline elements cannot be
    template, nor can single paragraphs of an article: a sentence that a site repeats is content
    there, a container that it repeats is not.
    """
    nodes, out = page.nodes, []
    parts: list[list[tuple[int, int]]] = [[] for _ in nodes]
    texts: list[list[tuple[int, str]]] = [[] for _ in nodes]
    for at, (text, owner) in enumerate(page.runs):
        if text is not None and not text.isspace():
            texts[owner].append((at, text))
    for k in range(len(nodes) - 1, 0, -1):  # children come after their parents
        node = nodes[k]
        pieces = [*((at, f"t{SPACES.sub(' ', text).strip()}") for at, text in texts[k]), *((nodes[c].first, f"e{c_hash}") for c, c_hash in reversed(parts[k]))]
        pieces.sort(key=lambda x: x[0])
        lead = SPACES.sub(" ", source[node.start : node.inner])
        own = xxhash.xxh64_intdigest("\0".join([host, lead, *(p for _, p in pieces)]))
        parts[node.parent].append((k, own))
        node.hash = own - (1 << 63)
    for node in nodes[1:]:
        node.content = node.tag in ("article", "main") or nodes[node.parent].content
        if node.tag not in NEVER and node.tag not in INLINE and not (node.content and node.tag in PARAGRAPHS):
            out.append(node.hash)
        else:
            node.hash = 0
    return out


def main_text(source: str, page: Page, template: set[int]) -> str:
    """Text of the blocks that stay, each with its white space as one space, joined by one space."""
    nodes = page.nodes
    for node in nodes:
        node.hidden = node.dropped and not (node.holds and node.tag in AROUND) or node.parent >= 0 and nodes[node.parent].hidden or bool(template) and node.hash != 0 and node.hash in template
    inside = [False] * len(nodes)
    for wanted in ("article", "main"):
        for k, node in enumerate(nodes):
            inside[k] = not node.hidden and (node.tag == wanted or node.parent >= 0 and inside[node.parent])
        if any(inside[n] for t, n in page.runs if t and not t.isspace()):
            break
    else:
        inside = [not node.hidden for node in nodes]
    pieces = [" " if text is None else text for text, n in page.runs if text is None or inside[n]]
    blocks = html.unescape("".join(pieces)) if "&" in source else "".join(pieces)
    return SPACES.sub(" ", blocks).strip(" ")


def whole_text(page: Page) -> str:
    """All text of a page, that of paragraphs in articles too, which have no subtree of their own."""
    return SPACES.sub(" ", "".join(" " if text is None else text for text, _ in page.runs))


def _template(pages: DataFrame, min_pages: int, share: float) -> DataFrame:
    """hash of the subtrees that recur in a host's pages."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts, copies, hashes = [], [], []
        for url, source in zip(batch.column("url").to_pylist(), common.texts_of(batch, "html"), strict=True):
            host = host_of(url)
            page = parse(source)
            found = sorted(set(subtree_hashes(source, host, page)))
            hosts.append(xxhash.xxh64_intdigest(host) - (1 << 63))
            copies.append(xxhash.xxh64_intdigest(f"{found}\0{whole_text(page)}") - (1 << 63))
            hashes.append(found)
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.int64()), pa.array(copies, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))], ["host", "copy", "hashes"])

    found = common.map_batches(pages.select("url", "html"), work, "host long, copy long, hashes array<long>").dropDuplicates(["host", "copy"])
    # a page's own marker, hash null, counts the host's pages along with its subtrees
    counted = found.select("host", F.explode(F.concat(F.array(F.lit(None).cast("long")), "hashes")).alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages).checkpoint()
    totals = counted.where(F.col("hash").isNull()).select("host", F.col("n").alias("pages"))
    return counted.where(F.col("hash").isNotNull()).join(totals, "host").where(F.col("n") >= share * F.col("pages")).select("hash")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """page_id, url, text of every page; text has neither template nor boilerplate."""
    template = _template(pages, min_pages, share).checkpoint()
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    if template.count() <= broadcast_rows:
        shared = pages.sparkSession.sparkContext.broadcast(np.array([r.hash for r in template.collect()], np.int64))  # at most broadcast_rows numbers

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            known, out = set(shared.value.tolist()), []
            for url, source in zip(batch.column("url").to_pylist(), common.texts_of(batch, "html"), strict=True):
                page = parse(source)
                if known:
                    subtree_hashes(source, host_of(url), page)
                out.append(main_text(source, page, known))
            return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

        return common.map_batches(pages.select("page_id", "url", "html"), work, schema)

    def own(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, hashes = [], []
        for url, source in zip(batch.column("url").to_pylist(), common.texts_of(batch, "html"), strict=True):
            keys.append(xxhash.xxh64_intdigest(f"{url}\0{source}") - (1 << 63))
            hashes.append(sorted(set(subtree_hashes(source, host_of(url), parse(source)))))
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), batch.column("html"), pa.array(keys, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))], ["page_id", "url", "html", "key", "hashes"])

    keyed = common.map_batches(pages.select("page_id", "url", "html"), own, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, html string, key long, hashes array<long>")
    lists = keyed.select("key", F.explode("hashes").alias("hash")).distinct().join(template, "hash").groupBy("key").agg(F.collect_list("hash").alias("own"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for url, source, known in zip(batch.column("url").to_pylist(), common.texts_of(batch, "html"), batch.column("own").to_pylist(), strict=True):
            page = parse(source)
            subtree_hashes(source, host_of(url), page)
            out.append(main_text(source, page, set(known or ())))
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    return common.map_batches(keyed.drop("hashes").join(lists, "key", "left").select("page_id", "url", "html", "own"), cut, schema)


def op1_site_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
