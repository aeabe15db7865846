"""Main text of web pages by consensus of each host's pages on where it is.

First pass: every page scores its containers by the text of their blocks, less links; a
container passes half of its score to its parent. Each page gives 1000 votes to the
generalised paths of its containers (``html/body/div.post-#``: tags and first classes,
numbers as #), in proportion to their scores. Spark adds the votes up by host and path.
The path with most votes wins (ties: the longer, then the alphabetically first), and so does
every path that got a tenth of the host's votes for blocks of its own; these are ten at most.

Second pass: the text of all containers on winning paths of the page's host, without
menus, headers, footers, notices, adverts, forms and comments, which are known by their tag
or by words of their class, id or role. Winning containers of different paths under one
parent give the whole parent, unless that is the body, so that what stands between them
is kept; one inside an ``article`` or ``main`` gives that. A page without any winning
path uses its own.

Words of a class do not strike a container that holds all text of the page in several blocks, or
half of it and a ``main``, an ``h1`` or an unmarked ``article``, unless most of its text is links:
``page no-sidebar`` is a wrapper.

Containers may be nested to any depth. Steps of a path beyond 40 are written as one hash.

Votes are added up task by task before they are shuffled, so a host with a third of all
pages is a few rows. The winners, one row for each host, are broadcast if measured to be
small and joined by a shuffle that splits hot hosts otherwise.

Defined cases: null or empty html gives an empty text; so does a page of boilerplate only.
A null or odd url is host ''. Unclosed tags, comments and scripts end with the page. Repeated
rows give repeated rows. Columns other than the three are not read.
"""

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from html import unescape
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litsearch.llm.common import strings, table
from litsearch.operators.joins import lookup_join
from litsearch.sources.scratch import materialise

#: Fixed values of HTML: elements without an end, with raw content, that are containers, that end a block.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|select"
CONTAINER = frozenset(
    "html head body div article section main aside nav header footer form table thead tbody tfoot tr td th "
    "ul ol dl menu figure blockquote fieldset details dialog center".split())
BLOCK = CONTAINER | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr figcaption caption address summary".split())
#: Elements that hold no main text, and words of a class, id or role that say so.
LEFT_OUT = frozenset("head nav aside footer form menu dialog button".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager footer masthead comment comments disqus replies respond share sharing "
    "social related recommended newsletter subscribe signup login search toolbar widget copyright hidden "
    "complementary contentinfo".split())
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:\"[^\"<]*\"|'[^'<]*'|[^'\">])*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*+)>|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORDS = re.compile(r"[a-z]+")
NUMBER = re.compile(r"[0-9]+")
VOTES = 1000
#: A path with one vote in so many of its host's wins.
FAIR_SHARE = 10
WRITTEN_STEPS = 40


def element(tag: str, attributes: str, in_article: bool) -> tuple[str, bool, bool]:
    """The generalised step of a path, and whether the element is left out by its tag or by its words."""
    by_tag = tag in LEFT_OUT or (tag == "header" and not in_article)
    step, by_words = tag, False
    if attributes.strip():
        for name, *value in ATTRIBUTE.findall(attributes):
            text = "".join(value).lower()
            name = name.lower()
            if name == "hidden":
                by_tag = True
            elif name == "class" and text.split():
                step = f"{tag}.{NUMBER.sub('#', text.split()[0])}"
            by_words = by_words or not LEFT_OUT_WORDS.isdisjoint(WORDS.findall(text))
    return step, by_tag, by_words


class Block(NamedTuple):
    text: str
    linked: int
    node: int


@dataclass
class Page:
    """Blocks in order, and containers; a container comes after its parent, 0 is the page."""

    blocks: list[Block] = field(default_factory=list)
    tag: list[str] = field(default_factory=lambda: [""])
    parent: list[int] = field(default_factory=lambda: [0])
    path: list[str] = field(default_factory=lambda: [""])
    depth: list[int] = field(default_factory=lambda: [0])
    anchor: list[int] = field(default_factory=lambda: [0])  # innermost article or main, or 0
    by_tag: list[bool] = field(default_factory=lambda: [False])
    by_words: list[bool] = field(default_factory=lambda: [False])
    marked: list[bool] = field(default_factory=lambda: [False])  # holds main, h1 or an unmarked article

    def push(self, tag: str, attributes: str, parent: int) -> int:
        step, by_tag, by_words = element(tag, attributes, self.anchor[parent] > 0)
        node, depth = len(self.tag), self.depth[parent] + 1
        content = tag in ("article", "main")
        if depth <= WRITTEN_STEPS:
            path = f"{self.path[parent]}/{step}" if parent else step
        else:
            written, _, deeper = self.path[parent].partition("/~")
            path = f"{written}/~{xxhash.xxh3_64_hexdigest(f'{deeper}/{step}')}"
        self.tag.append(tag)
        self.parent.append(parent)
        self.path.append(path)
        self.depth.append(depth)
        self.anchor.append(node if content else self.anchor[parent])
        self.by_tag.append(by_tag)
        self.by_words.append(by_words and not content and tag not in ("html", "body"))
        self.marked.append(False)
        if content and not (by_words and tag == "article"):
            self.mark(parent)
        return node

    def mark(self, node: int):
        while node and not self.marked[node]:
            self.marked[node] = True
            node = self.parent[node]

    def left_out(self) -> list[bool]:
        """Is a container, or one around it, left out?"""
        count = range(1, len(self.tag))
        out = [False] * len(self.tag)
        for i in count:
            out[i] = out[self.parent[i]] or self.by_tag[i]
        if any(self.by_words):
            size, links, n = [0] * len(out), [0] * len(out), [0] * len(out)
            for text, linked, node in self.blocks:
                if not out[node]:
                    size[node] += len(text)
                    links[node] += linked
                    n[node] += 1
            for i in reversed(count):
                for held in (size, links, n):
                    held[self.parent[i]] += held[i]
            for i in count:
                whole = (size[i] == size[0] and n[i] > 1) or (self.marked[i] and 2 * size[i] >= size[0])
                struck = self.by_words[i] and not (whole and 2 * links[i] < size[i])
                out[i] = out[i] or out[self.parent[i]] or struck
        return out


def read_page(html: str) -> Page:
    """Blocks that are not left out, with their characters in links, and the containers they stand in."""
    page = Page()
    piece, linked, in_link = [], 0, False
    stack, open_tags = [0], Counter()
    at = 0

    def flush():
        nonlocal piece, linked
        if piece:
            text = " ".join(unescape("".join(piece)).split())
            if text:
                page.blocks.append(Block(text, min(linked, len(text)), stack[-1]))
            piece, linked = [], 0

    def add(text: str):
        nonlocal linked
        piece.append(text)
        if in_link:
            linked += len(text)

    for found in TOKEN.finditer(html):
        if found.start() > at:
            add(html[at:found.start()])
        at = found.end()
        closing, tag, attributes = found.group(2, 3, 4)
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in BLOCK:
            if tag == "a":
                in_link = not closing
            elif tag in VOID:
                piece.append(" ")
            continue
        flush()
        in_link = False
        if tag == "h1" and not closing:
            page.mark(stack[-1])
        if tag not in CONTAINER:
            continue
        if closing:
            while open_tags[tag]:
                ended = page.tag[stack.pop()]
                open_tags[ended] -= 1
                if ended == tag:
                    break
        else:
            stack.append(page.push(tag, attributes, stack[-1]))
            open_tags[tag] += 1
    if at < len(html):
        add(html[at:])
    flush()
    out = page.left_out()
    page.blocks = [b for b in page.blocks if not out[b.node]]
    return page


def votes(page: Page) -> dict[str, tuple[int, int]]:
    """A page's votes for the paths of its containers, all of them and those for blocks of their own."""
    own: dict[int, int] = defaultdict(int)
    for text, linked, node in page.blocks:
        own[node] += max(0, len(text) - 2 * linked)
    score: Counter = Counter()
    direct: Counter = Counter()
    for node, value in own.items():
        direct[page.path[node]] += value
        score[page.path[node]] += value
        if page.depth[node] > 1:
            score[page.path[page.parent[node]]] += value / 2
    total = sum(score.values())
    return {path: (round(VOTES * value / total), round(VOTES * direct[path] / total))
            for path, value in score.items() if value > 0}


def elect(counted: dict[str, tuple[int, int]]) -> set[str]:
    """The winning paths of one page's votes."""
    if not counted:
        return set()
    best = min(counted, key=lambda p: (-counted[p][0], -p.count("/"), p))
    total = sum(own for _, own in counted.values())
    return {best} | {p for p, (_, own) in counted.items() if own and own * FAIR_SHARE >= total}


def chosen(page: Page, winners: set[str]) -> set[int]:
    """Containers whose text is taken: on a winning path, their article or main, or the parent of several."""
    holds = [False] * len(page.tag)
    for b in page.blocks:
        node = b.node
        while node and not holds[node]:
            holds[node] = True
            node = page.parent[node]
    won = [i for i in range(len(page.tag)) if holds[i] and page.path[i] in winners]
    siblings = defaultdict(set)
    for i in won:
        siblings[page.parent[i]].add(page.path[i])
    out = set()
    for i in won:
        above = page.parent[i]
        several = len(siblings[above]) > 1 and page.tag[above] not in ("", "html", "body")
        out.add(page.anchor[i] or (above if several else i))
    return out


def main_text(html: str, winners: list[str] | None) -> str:
    page = read_page(html)
    for paths in (set(winners or ()), elect(votes(page))):
        taken = chosen(page, paths)
        inside = [False] * len(page.tag)
        for i in range(len(page.tag)):
            inside[i] = i in taken or inside[page.parent[i]]
        text = "\n".join(b.text for b in page.blocks if inside[b.node])
        if text:
            return text
    return "\n".join(b.text for b in page.blocks)


def host_winners(pages: DataFrame) -> DataFrame:
    """``host, winners`` from ``pages(host, html)``: one row for each host, at most eleven paths in it."""

    def count(batches):
        for batch in batches:
            counted: dict = defaultdict(lambda: [0, 0])
            for host, html in zip(batch.column("host").to_pylist(), strings(batch.column("html"))):
                for path, n in votes(read_page(html)).items():
                    for i in (0, 1):
                        counted[host, path][i] += n[i]
            yield pa.RecordBatch.from_arrays([
                pa.array([h for h, _ in counted], pa.string()), pa.array([p for _, p in counted], pa.string()),
                pa.array([n for n, _ in counted.values()], pa.int64()),
                pa.array([n for _, n in counted.values()], pa.int64())], names=["host", "path", "votes", "own"])

    summed = materialise(pages.mapInArrow(count, "host string, path string, votes long, own long")
                         .groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("own").alias("own")),
                         "path_votes")
    # of all paths with most votes and of greatest depth, the first by name
    order = F.struct(-F.col("votes"), -F.size(F.split("path", "/")), F.col("path"))
    hosts = summed.groupBy("host").agg(F.min_by("path", order).alias("best"), F.sum("own").alias("total"))
    fair = (lookup_join(summed, hosts, ["host"], "inner", spread=("path",))
            .filter((F.col("path") == F.col("best")) | ((F.col("own") > 0) & (F.col("own") * FAIR_SHARE >= F.col("total")))))
    return fair.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("winners"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    host = F.regexp_extract(F.lower(F.coalesce(url_col, F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    named = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                         F.col(html_col).alias("html"), host.alias("host"))
    winners = materialise(host_winners(named.select("host", "html")), "host_winners")

    def read(batches):
        for batch in batches:
            found = [main_text(html, paths) for html, paths in zip(
                strings(batch.column("html")), batch.column("winners").to_pylist())]
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
                pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    joined = lookup_join(named, winners, ["host"], "left", spread=("page_id",))
    return joined.select("page_id", "url", "html", "winners").mapInArrow(
        read, "page_id long, url string, text string, n_chars long")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
