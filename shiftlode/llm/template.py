"""Main text of web pages without the templates of their sites.

1. A page is read once into its tree. Every block element with text gets a hash of its
   whole subtree (tag, class, texts and hashes of its children). Every container (``CONTAINERS``) also gets a hash of its
   path, that is of the tags and class names from the root down to it, without any text. The texts between block tags
   are the blocks of the page; each remembers the subtrees and paths around it.
2. Spark counts, per host, the different pages on which a hash occurs and the text below a path: first one row per (host,
   hash, page content), so that copies of a page count once, then sums per (host, hash). Both combine
   before the shuffle, so the menu of a host with a third of all pages is one row per task.
3. A subtree on at least ``MIN_PAGES`` pages and ``SHARE`` of the pages of its host is template. Articles may quote the same
   lines, so an article and the prose elements inside it (paragraphs, lists, tables, headings) are template only from
   ``LINE_PAGES`` pages and ``LINE_SHARE`` of the pages of the host on.
4. Menus and adverts may have other words on every page, but stand at the same path. On hosts with ``LINE_PAGES`` or more
   different pages the content is the smallest container path that holds more than half of the text of the host
   (an article is not looked into). On pages that have it, each other container path that is on ``SHARE`` of the pages is template.
   A heading or paragraph beside the content, in no container of its own, stays.
5. Every block inside a template subtree or path is deleted. If pages have ``m`` hashes on average, at most ``m / SHARE`` of them
   can be template, so the lists of a host are bounded by the size of its pages, not by their number. They are
   written, so that Spark knows their size, and joined to the pages by host: broadcast while they are small, else with the
   pages of a hot host split.

Two low bits of a hash tell the kinds apart: 0 subtree, 1 prose of an article, 2 path, 3 path that may be the content.

Recurrence says nothing about hosts with a few pages, nor about parts that stand inside of the content, such
as reader comments. So elements go on all hosts whose name or role says what they are (``SKIPPED``, ``ROLES``), and those
with a class or id of which every word says so (``HINTS`` beside ``PLAIN`` words and numbers: ``related-posts``, not
``related-work``; ids of prose inside an article are anchors and say nothing).
On hosts with fewer than ``LINE_PAGES`` pages (and on pages without a host), where a page marks its article (or else
its main part), blocks outside it go as well; on all others recurrence decides about blocks outside and inside.

Defined cases: null or empty html gives the empty text; a page without host is compared with no other;
repeated rows are kept each; unclosed tags end with their parent, elements nested deeper than ``DEEPEST`` follow one another, unclosed comments and scripts
at the end of the page; very long pages are read whole; of two content paths with as much text the smaller hash counts; an empty table
gives an empty table; other columns are ignored.
"""

import html as entities
import re
from collections.abc import Iterator

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlode.llm.common import by_row
from shiftlode.session import settle

MIN_PAGES = 3
SHARE = 0.3
LINE_PAGES = 10
LINE_SHARE = 0.5
HALF = 0.5
PAGE = 2  # the path of the whole page
DEEPEST = 512  # elements below become siblings, as in browsers

# Names of HTML elements, roles and usual class words.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead tr ul".split()
)
PROSE = frozenset(
    "p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl li dt dd table caption thead tbody tfoot tr th td figure figcaption".split()
)
CONTAINERS = frozenset(
    "address article aside center details dialog dir div fieldset footer form header hgroup main menu nav search section "
    "table tbody td th thead tfoot tr".split()
)
SKIPPED = frozenset(
    "head script style title textarea xmp iframe noembed noframes noscript template nav aside footer form dialog menu "
    "button select datalist object svg canvas audio video map search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar widget widgets menu "
    "menus nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments disqus reply replies respond share "
    "sharing social related recommended recommendations pagination pager toolbar skip copyright".split()
)
PLAIN = frozenset(
    "area article articles bar block body bottom box button buttons center col column container content desktop entry field "
    "form global group holder icon icons inner item items label left link links list local main mobile more outer page panel "
    "post posts primary region right row secondary section side site slot stories text thread title top unit wrap wrapper".split()
)
HEADERS = frozenset("header heading topbar".split())  # only outside the article
CLOSED_BY = {
    **{name: frozenset(["p"]) for name in BLOCKS - {"li", "dd", "dt", "tr", "td", "th", "option", "body", "html", "head"}},
    "li": frozenset(["li", "p"]),
    "dd": frozenset(["dd", "dt", "p"]),
    "dt": frozenset(["dd", "dt", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]),
    "td": frozenset(["td", "th", "p"]),
    "th": frozenset(["td", "th", "p"]),
    "option": frozenset(["option"]),
    "body": frozenset(["head"]),
}
HOLDS = frozenset("ul ol dl table article section div main body td th blockquote form nav aside footer header".split())

MARKUP = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attributes>(?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|</[^A-Za-z][^>]*(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("name", "block", "skipped", "prose", "hash", "parts", "path")

    def __init__(self, name: str, skipped: bool, prose: bool, mark: str, path: int = 0):
        self.name, self.block, self.skipped, self.prose, self.path = name, name in BLOCKS, skipped, prose, path
        self.parts, self.hash = [mark], 0


def hashed(text: str, kind: int) -> int:
    """A signed 64-bit hash whose two low bits are the kind."""
    return (xxhash.xxh64_intdigest(text) - (1 << 63)) & ~3 | kind


def said(value: str, hints: frozenset) -> bool:
    """Whether every word of a class or id is a hint, a plain word or a number, and at least one a hint."""
    words = [word.lower() for word in WORDS.findall(value)]
    return any(w in hints for w in words) and all(w in hints or w in PLAIN or w.isdigit() for w in words)


def skipped_by_attributes(name: str, text: str, inside: bool) -> tuple[bool, str]:
    """Whether the attributes say that an element is no content, and its class words."""
    if not text or text == "/":
        return False, ""
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}
    label = f"{values.get('class', '')} {values.get('id', '')}"
    if name in ("html", "body", "main", "article"):
        return False, label
    own = values.get("class", "").split()
    if not (inside and name in PROSE):
        own += values.get("id", "").split()
    hints = HINTS if inside else HINTS | HEADERS
    hidden = "hidden" in values or re.search(r"display\s*:\s*none", values.get("style", ""))
    return bool(hidden or values.get("role", "").lower() in ROLES or any(said(value, hints) for value in own)), label


class Page:
    """Blocks of a page in order: text, whether it may be content, hashes of the elements around it."""

    def __init__(self, source: str):
        self.stack: list[Node] = [Node("#page", False, False, "")]
        self.text: list[str] = []
        self.blocks: list[tuple[str, bool, int, list[Node]]] = []  # text, skipped, level, elements around it
        self.articles = self.mains = 0  # open elements that mark the content
        at = 0
        while at < len(source):
            mark = MARKUP.search(source, at)
            if not mark:
                self.text.append(source[at:])
                break
            if mark.start() > at:
                self.text.append(source[at : mark.start()])
            at = mark.end()
            if mark["name"]:
                name = mark["name"].lower()
                if mark["close"]:
                    self.close(name)
                else:
                    self.open(name, mark["attributes"])
                    if name in RAW:
                        end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                        self.close(name)
                        at = end.end() if end else len(source)
        while len(self.stack) > 1:
            self.pop()
        self.flush()

    def flush(self) -> None:
        """End of a block: references are decoded after the markup is gone."""
        text = " ".join(entities.unescape("".join(self.text)).split())
        self.text = []
        if text:
            self.stack[-1].parts.append(text)
            path = [node for node in self.stack[1:] if node.block]
            self.blocks.append((text, any(node.skipped for node in self.stack), 2 if self.articles else int(self.mains > 0), path))

    def open(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.flush()
            ends = CLOSED_BY.get(name, ())
            for place in range(len(self.stack) - 1, 0, -1):
                node = self.stack[place]
                if node.name in ends:
                    while len(self.stack) > place:
                        self.pop()
                elif node.name in HOLDS:
                    break
        elif name == "br":
            self.text.append(" ")
        if name in VOID:
            return
        inside = self.articles > 0
        by_attributes, label = skipped_by_attributes(name, attributes, inside)
        skipped = by_attributes or name in SKIPPED or (name == "header" and not inside)
        node = Node(name, skipped, name == "article" or (inside and name in PROSE), f"<{name} {label}>", self.path(name, label, skipped))
        if skipped and not node.block:
            self.flush()  # an inline element that is no content must not share a block
        while len(self.stack) > DEEPEST:
            self.pop()
        self.stack.append(node)
        if not any(x.skipped for x in self.stack):
            self.articles += name == "article"
            self.mains += name == "main"

    def path(self, name: str, label: str, skipped: bool) -> int:
        """Hash of the tags and class names from the root to a new container; numbers in names do not count."""
        if name not in CONTAINERS:
            return self.stack[-1].path
        shown = "" if name in ("article", "main") else "".join(c for c in label if not c.isdigit())
        may = not (skipped or self.articles or any(node.skipped for node in self.stack))
        return hashed(f"{self.stack[-1].path}/{name} {shown}", 2 + may)

    def close(self, name: str) -> None:
        block = name in BLOCKS
        for place in range(len(self.stack) - 1, 0, -1):
            node = self.stack[place]
            if node.name == name:
                while len(self.stack) > place:
                    self.pop()
                return
            if node.block and not block:
                return

    def pop(self) -> None:
        node = self.stack[-1]
        if node.block or node.skipped:
            self.flush()
        if not any(x.skipped for x in self.stack):
            self.articles -= node.name == "article"
            self.mains -= node.name == "main"
        self.stack.pop()
        if len(node.parts) > 1:
            node.hash = hashed("\x00".join(node.parts), int(node.prose))
            self.stack[-1].parts.append(str(node.hash) if node.block else "\x01".join(node.parts[1:]))

    def rows(self) -> Iterator[tuple[str, bool, bool, list[int], list[int]]]:
        """text, whether it is skipped, whether it is in the marked part, subtrees and paths that delete it when they are template."""
        marked = max((level for _, skipped, level, _ in self.blocks if not skipped), default=0)
        for text, skipped, level, around in self.blocks:
            chain = [] if skipped else [node.hash for node in around if node.name not in ("html", "body", "main")]
            paths = [node.path for node in around if node.name in CONTAINERS]
            yield text, skipped, level == marked, chain, paths


def read_page(source: str | None) -> tuple[list[str], list[int], list[list[int]], int, list[list[int]], list[int], list[int]]:
    """Texts (empty if skipped), 1 for content by the marks of the page, subtrees, a hash of that content,
    paths, and the different paths with the text below them that is not skipped (the whole page first, as path 2)."""
    texts, content, chains, paths = [], [], [], []
    below: dict[int, int] = {PAGE: 0}
    for text, skipped, inside, chain, around in Page(source or "").rows():
        texts.append("" if skipped else text)
        content.append(int(inside and not skipped))
        chains.append(chain)
        paths.append(around)
        for path in {PAGE, *around}:
            below[path] = below.get(path, 0) + (0 if skipped else len(text))
    marked = "\x00".join(text if inside else "" for text, inside in zip(texts, content))
    return texts, content, chains, xxhash.xxh64_intdigest(marked) - (1 << 63), paths, list(below), list(below.values())


def host_of(url) -> F.Column:
    host = F.lower(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def templates(
    read: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE, line_pages: int = LINE_PAGES, line_share: float = LINE_SHARE
) -> DataFrame:
    """``_h`` (host), ``_template``: the subtrees that recur on its pages, and on hosts with many pages (``_large``)
    ``_main``, the path of the content, and ``_layout``, the paths beside it that recur."""
    known = read.filter("_host IS NOT NULL")
    subtrees = F.array_distinct(F.flatten("_chains"))
    found = F.concat(
        F.transform(subtrees, lambda h: F.struct(h.alias("h"), F.lit(0).cast("long").alias("s"))),
        F.zip_with("_outline", "_below", lambda h, s: F.struct(h.alias("h"), s.alias("s"))),
    )
    each = known.select("_host", "_content", F.explode(found).alias("_f")).select("_host", "_content", F.col("_f.h").alias("_hash"), F.col("_f.s").alias("_s"))
    pages = each.groupBy("_host", "_hash", "_content").agg(F.max("_s").alias("_s"))
    counts = pages.groupBy("_host", "_hash").agg(F.count("*").alias("_n"), F.sum("_s").alias("_size"))
    counts = settle(counts.filter((F.col("_n") >= min_pages) | (F.col("_hash") == PAGE)), "counts")
    sizes = counts.filter(F.col("_hash") == PAGE).select("_host", F.col("_n").alias("_pages"), F.col("_size").alias("_whole"))
    kind = F.col("_hash").bitwiseAND(F.lit(3).cast("long"))
    large = F.col("_pages") >= line_pages
    often = F.col("_n") >= share * F.col("_pages")
    lines = (F.col("_n") >= line_pages) & (F.col("_n") >= line_share * F.col("_pages"))
    most = F.col("_size") > HALF * F.col("_whole")
    met = counts.filter(F.col("_hash") != PAGE).join(sizes, "_host").filter(F.col("_pages") >= min_pages)
    lists = met.filter(often | lines).groupBy("_host").agg(
        F.collect_list(F.when(((kind == 0) & often) | ((kind == 1) & lines), F.col("_hash"))).alias("_template"),
        F.collect_list(F.when((kind >= 2) & large & often & ~most, F.col("_hash"))).alias("_layout"),
        F.min(F.when((kind == 3) & large & most, F.struct("_size", "_hash"))).alias("_least"),
    )
    found = sizes.select("_host", large.alias("_large")).join(lists, "_host", "left").filter("_large OR _template IS NOT NULL")
    return found.select(F.col("_host").alias("_h"), "_template", "_large", "_layout", F.col("_least._hash").alias("_main"))


def extract(
    df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
    min_pages: int = MIN_PAGES, share: float = SHARE, line_pages: int = LINE_PAGES, line_share: float = LINE_SHARE,
) -> DataFrame:
    """key, url, main text, its code points, and how many blocks were template."""

    def step():
        return lambda number, address, host, source: [(number, address, host, *read_page(source))]

    rows = df.select(
        F.col(key).cast("long").alias("_key"), F.col(url).cast("string").alias("_url"), host_of(F.col(url)).alias("_host"), F.col(html).alias("_html")
    )
    schema = (
        "_key long, _url string, _host string, _texts array<string>, _may array<int>, _chains array<array<long>>, _content long, "
        "_paths array<array<long>>, _outline array<long>, _below array<long>"
    )
    read = settle(by_row(rows, ["_key", "_url", "_host", "_html"], step, schema), "blocks")
    found = settle(templates(read, min_pages, share, line_pages, line_share), "templates")
    met = read.join(found, F.col("_host") == F.col("_h"), "left")
    none = F.array().cast("array<long>")
    recurring, layout = F.coalesce(F.col("_template"), none), F.coalesce(F.col("_layout"), none)
    blocks = F.arrays_zip(F.col("_texts").alias("t"), F.col("_may").alias("m"), F.col("_chains").alias("c"), F.col("_paths").alias("p"))
    large = F.coalesce(F.col("_large"), F.lit(False))
    inside = lambda paths: F.coalesce(F.array_contains(paths, F.col("_main")), F.lit(False))
    whole = F.exists("_paths", inside)  # the page has the content path of its host
    gone = lambda b: F.arrays_overlap(b["c"], recurring) | (F.col("_whole") & ~inside(b["p"]) & F.arrays_overlap(b["p"], layout))
    met = met.withColumn("_whole", whole).withColumn("_blocks", blocks).withColumn("_deleted", F.size(F.filter("_blocks", gone)))
    left = F.filter("_blocks", lambda b: ((b["m"] == 1) | (large & (b["t"] != ""))) & ~gone(b))
    text = F.array_join(F.transform(left, lambda b: b["t"]), "\n")
    return met.select(
        F.col("_key").alias(key), F.col("_url").alias(url), text.alias("text"), F.col("_deleted").cast("long").alias("n_template_blocks")
    ).select(key, url, "text", F.length("text").cast("long").alias("n_chars"), "n_template_blocks")
