"""Main text of HTML pages with a site style tree.

Pages of a host are merged by the style path of their nodes (tags and classes
from the body down). A node's importance combines

* presentation: the entropy of the sequences of child tags that its pages show
  there, over log(pages): 0 if all pages look alike, 1 if all differ;
* content: one minus the mean entropy of the texts directly in it, over
  log(pages): a text that every page repeats gives 0, one that a single page has gives 1;

as (1 - g) * presentation + g * content with g = 0.9 ^ children; a class that hints at boilerplate halves it.
Nodes below `LEAST_IMPORTANCE` are noise on that host, and so are single texts whose own importance is below it.
A branch is noise when it and all within it are. Inside an article only whole branches go: a passage that many
articles share is text of each. Pages with equal content count once, and `LEAST_PAGES` different ones are the least evidence.

A host whose pages are copies of each other isn't a template: where repeated texts hold more than half of all its text and
are at least half as long as its other texts on average (paragraphs, not menu entries), its tree takes nothing.
Both figures are the host's, so its pages are treated alike, whatever the template's share of a page.

A page's text is what its main branch (`article`, `main`, else the body) holds, without branches whose tag or
role says menu, header, footer, sidebar, notice, advert, form, script, style or comments, and
without what the host's tree finds to be noise. A class or id says so too if it consists of such words (`site-footer`); mixed
with other words (`article-header`) it counts outside of articles only and is a hint to the tree within; words of state (`has-sidebar`)
say nothing. Nothing named by class goes that holds the larger part of the page's text.

Edge cases: null or empty html gives an empty text. The host is the part of url after `//`; pages
without one share an empty host. Repeated rows give equal results. Null page_ids and ties need nothing special. Unclosed and
misnested tags are handled as browsers do for paragraphs and list items. Long and deeply nested pages take time in proportion to
their length. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import join_back
from .blocks import plain
from .common import cut_lineage, join_bounded, text_of

LEAST_IMPORTANCE = 0.3
LEAST_PAGES = 4
_GAMMA = 0.9
# Fixed values of HTML: elements without an end tag, elements that start a new
# block, elements whose content isn't text of the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
BRANCH = frozenset("center details dialog dir div dl fieldset figure menu ol pre section table ul".split())
NOISE_TAGS = frozenset(
    "aside button dialog footer head iframe input label math menu nav noscript object option script search select style svg template textarea title".split()
)
# Fixed words of class names: for parts that are never the text, for other parts of a page, for
# places and boxes, for states of an element.
APART_WORDS = frozenset("ad ads adv advert adverts advertisement advertising comment comments consent cookie cookies disqus".split())
NOISE_WORDS = APART_WORDS | frozenset(
    "banner breadcrumb breadcrumbs copyright footer form header masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo related respond replies reply share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
PLACE_WORDS = frozenset(
    "area articles bar block bottom box buttons container content global group inner item items left link links list main outer page "
    "posts primary reader right secondary section signup site slot stories thread top unit user wrap wrapper".split()
)
STATE_WORDS = frozenset("has hide is no not show with without".split())
NOISE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: An element of the left kind ends an open one of the right kinds.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+")


def key(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


HINT, NAMED, APART = 1, 2, 3


def mark(style: str) -> int:
    """What class and id say: nothing (0), boilerplate among other words (`HINT`), boilerplate (`NAMED`),
    adverts or reader comments (`APART`)."""
    most = 0
    for token in style.lower().split():
        found = set(_WORDS.findall(token))
        noisy = found & NOISE_WORDS
        if not noisy or found & STATE_WORDS:
            continue
        most = max(most, HINT if found - noisy - PLACE_WORDS else APART if noisy & APART_WORDS else NAMED)
    return most


class Node:
    __slots__ = ("tag", "path", "above", "holder", "mark", "noise", "main", "children", "chars", "main_chars")

    def __init__(self, tag: str, path: int, above: Node | None, mark: int, noise: bool, main: bool) -> None:
        self.tag, self.path, self.above, self.mark, self.noise, self.main = tag, path, above, mark, noise, main
        #: The block that text directly in this node belongs to.
        self.holder: Node = self if above is None or tag in BLOCK else above.holder
        self.children: list[str] = []
        self.chars = self.main_chars = 0


class Page(HTMLParser):
    """Blocks of text in page order, each with its containing node, and all nodes, parents first."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("", 0, None, 0, False, False)]
        self.open = [self.nodes[0]]
        self.depths: dict[str, list[int]] = defaultdict(list)  # of open elements, by tag
        self.block_depths: list[int] = []
        self.runs: list[list[tuple[Node, str]]] = []
        self.parts: list[tuple[Node, str]] = []
        self.feed(html)
        self.close()
        self._flush()
        self._drop_named()
        self.blocks: list[tuple[Node, str]] = []
        for run in self.runs:
            kept = [(n, t) for n, t in run if not n.noise]
            text = _SPACE.sub(" ", "".join(t for _, t in kept)).strip()
            if text:
                self.blocks.append((kept[0][0].holder, text))

    def _drop_named(self) -> None:
        """Settle which nodes that class, id or form name are noise: all but those with the larger part of the text."""
        for run in self.runs:
            for node, text in run:
                size = len(text) - text.count(" ")
                node.chars += size
                node.main_chars += size * node.main
        for node in reversed(self.nodes[1:]):
            node.above.chars += node.chars
            node.above.main_chars += node.main_chars
        chars, main_chars = self.nodes[0].chars, self.nodes[0].main_chars
        for node in self.nodes[1:]:
            if node.above.noise:
                node.noise = True
            elif node.mark and not node.noise:
                if node.main:
                    node.noise = node.mark > HINT
                elif main_chars:
                    node.noise = 2 * node.main_chars <= main_chars
                else:
                    node.noise = node.mark == APART or 2 * node.chars <= chars

    def _flush(self) -> None:
        if self.parts:
            self.runs.append(self.parts)
            self.parts = []

    def _pop(self, depth: int) -> None:
        if self.block_depths and self.block_depths[-1] >= depth:
            self._flush()
        while len(self.open) > depth:
            tag = self.open.pop().tag
            self.depths[tag].pop()
            if tag in BLOCK:
                self.block_depths.pop()

    def _deepest(self, tags: Iterable[str]) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths[t]), default=0)

    def _close_implied(self, tag: str) -> None:
        # A paragraph ends where a block starts.
        if tag in BLOCK and self.block_depths and self.open[self.block_depths[-1]].tag == "p":
            self._pop(self.block_depths[-1])
        if tag in ENDS:
            ended = self._deepest(ENDS[tag])
            if ended > self._deepest(HOLDERS[tag]):
                self._pop(ended)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("br", "hr"):
            self.parts.append((self.open[-1], " "))
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        self._close_implied(tag)
        if tag in BLOCK or tag in NOISE_TAGS:
            self._flush()
        given = dict(attrs)
        style, role = given.get("class") or "", (given.get("role") or "").lower()
        above = self.open[-1]
        noise = above.noise or tag in NOISE_TAGS or (tag == "header" and not above.main) or role in NOISE_ROLES or "hidden" in given
        named = 0 if tag in ("html", "body", "article", "main", "p") else APART if tag == "form" else mark(f"{style} {given.get('id') or ''}")
        main = above.main or tag in ("article", "main") or role in ("main", "article")
        node = Node(tag, key(str(above.path), tag, style), above, named, noise, main)
        above.children.append(tag)
        self.nodes.append(node)
        self.depths[tag].append(len(self.open))
        if tag in BLOCK:
            self.block_depths.append(len(self.open))
        self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.parts.append((self.open[-1], " "))
        if self.depths[tag]:
            self._pop(self.depths[tag][-1])
            if tag in NOISE_TAGS:
                self._flush()
        elif tag in BLOCK:
            self._flush()

    def handle_data(self, data: str) -> None:
        if not self.open[-1].noise:
            self.parts.append((self.open[-1], data))

    def content(self) -> list[tuple[Node, str]]:
        """Blocks of the main branch that no tag, role or class marks as noise."""
        main = [(n, t) for n, t in self.blocks if n.main]
        return main or self.blocks


def parsed(html: str) -> Page:
    """The page; what the parser can't read counts as text-free."""
    return Page(html) if html else Page("<p></p>")


def _is_container(node: Node) -> bool:
    return bool(node.children) and node.tag in BLOCK and node.tag not in ("html", "body") and not node.noise


Feature = tuple[int, int, int, int, bool]


def features(page: Page) -> tuple[int, list[Feature]]:
    """A key of the page's content, and its distinct (node, feature, children, chars, hint) rows:
    a text has children -1, a container's sequence of child tags their number."""
    blocks = page.content()
    rows = {(n.path, key(t), -1, len(t), n.mark == HINT) for n, t in blocks}
    rows |= {(n.path, key(*n.children), len(n.children), 0, n.mark == HINT) for n in page.nodes if _is_container(n)}
    return key(*(t for _, t in blocks)), sorted(rows)


_FEATURES = "struct<page:bigint,rows:array<struct<node:bigint,feature:bigint,children:int,chars:bigint,hint:boolean>>>"
_ROW = [("node", pa.int64()), ("feature", pa.int64()), ("children", pa.int32()), ("chars", pa.int64()), ("hint", pa.bool_())]
_FEATURES_ARROW = pa.struct([("page", pa.int64()), ("rows", pa.list_(pa.struct(_ROW)))])


def _features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for pages in batches:
        out = []
        for html in plain(pages):
            page, rows = features(parsed(html.as_py()))
            out.append({"page": page, "rows": [dict(zip((name for name, _ in _ROW), row)) for row in rows]})
        yield pa.array(out, _FEATURES_ARROW)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[^/?#]*//([^/?#]*)", 1)), F.lit(""))


def noise(pages: DataFrame) -> DataFrame:
    """(host, low): keys of low-importance nodes and texts of each host."""
    found = F.arrow_udf(_features, _FEATURES)(text_of(pages, "html"))
    rows = pages.select(F.xxhash64(host_of(pages["url"])).alias("host"), found.alias("f"))
    rows = rows.select("host", "f.page", F.explode("f.rows").alias("r")).select("host", "page", "r.*")
    # Copies count once: one row per host, content and feature.
    own = [F.max(c).alias(c) for c in ("children", "chars", "hint")]
    rows = cut_lineage(rows.groupBy("host", "page", "node", "feature").agg(*own), "page-features")
    per_feature = rows.groupBy("host", "node", "feature").agg(F.count(F.lit(1)).alias("n"), *own)
    node_pages = rows.select("host", "node", "page").distinct().groupBy("host", "node").agg(F.count(F.lit(1)).alias("m"))
    node_pages = node_pages.where(F.col("m") >= LEAST_PAGES)
    # A node of a host may hold most features of all pages: its rows are dealt to several tasks.
    at = F.struct("host", "node").alias("at")
    joined = join_back(per_feature.withColumn("at", at), node_pages.select(at, "m"), "at").drop("at")
    joined = cut_lineage(joined, "features")
    is_text = F.col("children") < 0
    # A text on n of m pages, evenly: its entropy over the pages is log n / log m.
    text_low = 1 - F.ln("n") / F.ln("m")
    share = F.col("n") / F.col("m")
    nodes = joined.groupBy("host", "node").agg(
        F.avg(F.when(is_text, text_low)).alias("content"),
        (-F.sum(F.when(~is_text, share * F.ln(share))) / F.ln(F.max("m"))).alias("presentation"),
        (F.sum(F.when(~is_text, F.col("children") * F.col("n"))) / F.sum(F.when(~is_text, F.col("n")))).alias("width"),
        F.max("hint").alias("hint"),
    )
    g = F.pow(F.lit(_GAMMA), F.coalesce("width", F.lit(0)))
    presentation = F.least(F.coalesce("presentation", F.lit(1.0)), F.lit(1.0))
    importance = ((1 - g) * presentation + g * F.coalesce("content", F.lit(1.0))) * F.when(F.col("hint"), 0.5).otherwise(1.0)
    low_nodes = nodes.where(importance < LEAST_IMPORTANCE).select("host", F.col("node").alias("low"))
    is_low = text_low < LEAST_IMPORTANCE
    low_texts = joined.where(is_text & is_low).select("host", F.col("node").bitwiseXOR(F.col("feature")).alias("low"))
    lows = low_nodes.unionByName(low_texts).groupBy("host").agg(F.collect_set("low").alias("low"))
    return join_bounded(lows, _copies(joined.where(is_text), is_low), "host", "left_anti")


def _copies(texts: DataFrame, repeated: Column) -> DataFrame:
    """Hosts whose repeated texts hold most of their text and are about as long as the others."""
    size = F.col("n") * F.col("chars")
    sums = texts.groupBy("host").agg(
        F.sum(F.when(repeated, size)).alias("again"), F.sum(F.when(repeated, F.col("n"))).alias("agains"),
        F.sum(F.when(~repeated, size)).alias("once"), F.sum(F.when(~repeated, F.col("n"))).alias("onces"),
    )
    as_long = 2 * F.col("again") * F.col("onces") >= F.col("once") * F.col("agains")
    return sums.where((F.col("again") > F.coalesce("once", F.lit(0))) & F.coalesce(as_long, F.lit(True))).select("host")


def main_text(html: str, low: set[int]) -> str:
    page = parsed(html)
    blocks = page.content()
    if not low:
        return "\n".join(t for _, t in blocks)
    is_low = [n.path in low or n.path ^ key(t) in low for n, t in blocks]
    # Nodes that hold a text worth keeping, upwards; each node is met once.
    held: set[Node] = set()
    for (node, _), low_text in zip(blocks, is_low):
        at: Node | None = None if low_text else node
        while at is not None and at not in held:
            held.add(at)
            at = at.above
    gone: set[Node] = set()
    for node in page.nodes[1:]:
        branch = node.tag in BRANCH and node.path in low and node not in held
        if branch or (node.above in gone and node.tag not in ("article", "main")):
            gone.add(node)
    return "\n".join(t for (n, t), low_text in zip(blocks, is_low) if not (n in gone if n.main else low_text))


def _texts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for pages, hosts, lows in batches:
        out, sets = [], {}
        for html, host, low in zip(plain(pages), hosts.to_pylist(), lows):
            if host not in sets:
                sets[host] = set(low.values.to_pylist()) if low.is_valid and len(low) else set()
            out.append(main_text(html.as_py(), sets[host]))
        yield pa.array(out, pa.string())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    html = text_of(pages, "html")
    rows = pages.select(pages["page_id"], pages["url"], html.alias("html"), F.xxhash64(host_of(pages["url"])).alias("host"))
    rows = join_bounded(rows, noise(pages), "host", "left")
    text = F.arrow_udf(_texts, "string").asNondeterministic()("html", "host", "low")  # evaluated once
    return rows.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
