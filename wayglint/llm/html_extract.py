"""HTML extraction: pages of a host vote on the path of the container that holds the main text."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, small_side

#: A comment, declaration or tag, with quoted attribute values taken whole (or, if a quote has no end, up to the next >);
#: markup that the page's end cuts off is markup.
MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Elements whose content is no markup.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "xmp", "math", "object", "canvas"}
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}
#: Elements that may hold the main text, and those that say that they do.
CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "table", "tbody", "tr", "center", "blockquote"}
MAIN = {"article", "main"}
#: Elements that are never part of it; a header inside of MAIN holds the headline and stays.
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "head"}
#: What a class, id or role calls boilerplate when it is the compound's head, as in "cookie-banner" but not "legal-news",
#: reader comments apart; and words that only shape or place it, as in "ad-container".
BOILERPLATE_HEADS = set(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsors sponsored promo promos promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs"
    " masthead footer sidebar side aside widget widgets cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup login search share sharing social related"
    " recommended recommendations pagination pager toolbar copyright imprint complementary contentinfo header".split()
)
COMMENT_HEADS = set("comment comments disqus respond response responses reply replies".split())
SHAPE_WORDS = set("container wrapper wrap box block list area left right top bottom inner outer section item items bar thread form panel links posts stories buttons region zone unit slot".split())
#: Elements whose words tell of the whole page ("has-sidebar", "comments-open"), not of what they are.
WHOLE = {"html", "body"} | MAIN
#: Share of a container's text that one inside must hold to stand for it, less if it is one of MAIN.
HELD, HELD_BY_MAIN = 0.9, 0.5
#: Elements that end a block of text. Void ones have no end tag.
BLOCKS = CONTAINERS | BOILERPLATE | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "pre", "hr", "figure", "figcaption", "address", "thead", "tfoot", "th", "caption", "details", "summary", "hgroup", "option", "legend"}
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
STRUCTURE = CONTAINERS | BOILERPLATE | {"ul", "ol", "dl", "li", "figure", "thead", "tfoot", "th", "details"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(slots=True)
class Node:
    """A structural element: a hash of its generalised path, what marks it, and the characters of its own blocks."""

    tag: str
    path: int
    parent: int
    hard: bool = False
    worded: str = ""
    in_main: bool = False
    junk: bool = False
    links: int = 0
    chars: int = 0
    prose: int = 0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    #: (node, text) of each block in page order
    blocks: list[tuple[int, str]] = field(default_factory=list)


def _head(token: str) -> str:
    """The word that a compound is about: "comment" of "comment-list", "news" of "legalNews"."""
    words = WORD.findall(token)
    while words and (len(words[-1]) == 1 or words[-1].lower() in SHAPE_WORDS):
        words.pop()
    return words[-1].lower() if words else ""


@lru_cache(1 << 14)
def _step(tag: str, attributes: str) -> tuple[str, str]:
    """The element's step of a path, digits left out, and the boilerplate that its words name, if any."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), next((v for v in m.groups()[1:] if v is not None), ""))
    heads = {_head(t) for v in found.values() for t in v.split()} if tag not in WHOLE else set()
    named = "comment" if heads & COMMENT_HEADS else next(iter(sorted(heads & BOILERPLATE_HEADS, key=lambda h: h == "header")), "")
    classes = sorted({re.sub(r"\d+", "", c) for c in found.get("class", "").split()} - {""})
    return ".".join([tag, *classes]), named


def path_hash(parent: int, step: str) -> int:
    """Names a path by its parent's name and its last step, so that deep pages take no more room than flat ones."""
    return xxhash.xxh64_intdigest(f"{parent}>{step}") >> 1


def _mark(page: Page) -> None:
    """Sets ``junk``: what tags or words mark, and all inside of it.

    Words can err. If no MAIN holds text, an element that words mark (but for comments) is no boilerplate if it has
    three quarters of the page's text or more. If the page has no MAIN and nothing but links is clean, of the
    outermost elements that words mark the one with most text is none, and so on inside of it until there is text.
    """
    nodes = page.nodes

    def junk() -> bool:
        clean = False
        for n in nodes:
            n.junk = n.hard or bool(n.worded) or (n.parent >= 0 and nodes[n.parent].junk)
            clean |= not n.junk and n.chars > n.links
        return clean

    clean = junk()
    if any(n.tag in MAIN and not n.junk for n in nodes) or not any(n.worded for n in nodes):
        return
    text = [n.chars - n.links for n in nodes]
    inside: list[list[int]] = [[] for _ in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        if not nodes[i].hard:
            inside[nodes[i].parent].append(i)
            text[nodes[i].parent] += max(text[i], 0)
    for i, n in enumerate(nodes):
        if n.worded and n.worded != "comment" and not n.hard and 4 * text[i] >= 3 * text[0] > 0:
            n.worded = ""
    clean, at = junk(), 0
    while not clean and text[at] > 0:
        open_, marked = [at], []
        while open_:
            i = open_.pop()
            nodes[i].worded = ""
            clean |= nodes[i].chars > nodes[i].links
            for k in inside[i]:
                (marked if nodes[k].worded else open_).append(k)
        if clean or not marked:
            break
        at = min(marked, key=lambda k: (-text[k], k))
    junk()


def parse(source: str) -> Page:
    """Blocks of text under structural elements. Inline elements, and ends without starts, make no difference.

    White space inside a block becomes one space, character references are decoded once, after markup is cut.
    An unclosed element ends with the structural element around it; what is open at the end of the page ends there.
    """
    page = Page([Node("", 0, -1)])
    stack, pieces, in_link, linked, prose = [0], [], False, 0, False

    def flush(opened: str = "") -> None:
        nonlocal linked, prose
        if pieces:
            text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                page.blocks.append((stack[-1], text))
                node = page.nodes[stack[-1]]
                node.chars += len(text)
                node.links += min(linked, len(text))
                node.prose += prose and len(text)
        linked, prose = 0, opened in PROSE

    at = 0
    while m := MARKUP.search(source, at):
        if m.start() > at:
            pieces.append(source[at : m.start()])
            linked += (m.start() - at) * in_link
        at = m.end()
        slash, tag, attributes = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
        if not tag:
            continue
        tag, closing = tag.lower(), bool(slash)
        if tag == "a":
            in_link = not closing
        if tag in RAW and not closing:
            if not m[0].endswith("/>"):
                end = RAW_END[tag].search(source, at)
                at = end.start() if end else len(source)
            if tag in ("title", "textarea"):
                flush()
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag not in BLOCKS:
            continue
        flush("" if closing else tag)
        if tag not in STRUCTURE:
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if page.nodes[stack[depth]].tag == tag:
                    del stack[depth:]
                    break
        elif not m[0].endswith("/>"):
            if tag == "li" and page.nodes[stack[-1]].tag == "li":
                stack.pop()
            if tag == "body" and page.nodes[stack[-1]].tag == "head":
                stack.pop()
            step, named = _step(tag, attributes)
            up = page.nodes[stack[-1]]
            named = "" if named == "header" and up.in_main else named
            hard = tag in BOILERPLATE and not (tag == "header" and up.in_main)
            page.nodes.append(Node(tag, path_hash(up.path, step), stack[-1], hard, named, up.in_main or tag in MAIN))
            stack.append(len(page.nodes) - 1)
    pieces.append(source[at:])
    flush()
    _mark(page)
    return page


def _sums(page: Page) -> list[int]:
    """Clean text less links, of each node with all inside of it."""
    out = [0 if n.junk else n.chars - 2 * n.links for n in page.nodes]
    for i in range(len(out) - 1, 0, -1):
        if not page.nodes[i].junk:
            out[page.nodes[i].parent] += out[i]
    return out


def best_node(page: Page) -> int | None:
    """The page's main container, or none if it has no clean text.

    From the page down to the container inside that holds nearly all its text less links (half for one of MAIN), as
    long as there is one. An article is not left, nor any other container but the page's body that has headings or
    paragraphs of its own. So a wrapper of the main text and little else loses to it, and a link list counts against
    whatever is around it.
    """
    nodes, sums = page.nodes, _sums(page)
    if not any(n.chars and not n.junk for n in nodes):
        return None
    holder, inside = [0] * len(nodes), [[] for _ in nodes]
    for i, n in enumerate(nodes[1:], 1):
        if n.tag in CONTAINERS and not n.junk:
            inside[holder[n.parent]].append(i)
            holder[i] = i
        else:
            holder[i] = holder[n.parent]
    at = 0
    while inside[at] and nodes[at].tag != "article" and (not nodes[at].prose or nodes[at].tag in ("", "html", "body")):
        k = max(inside[at], key=lambda i: (sums[i], -i))
        main = nodes[k].tag in MAIN
        if not (sums[k] > 0 or main) or (sums[k] < (HELD_BY_MAIN if main else HELD) * sums[at]):
            break
        at = k
    return at


def best_path(page: Page) -> int | None:
    at = best_node(page)
    return None if at is None else page.nodes[at].path


def text_under(page: Page, path: int | None) -> str:
    """The clean blocks of the container on ``path``, in page order, a line each.

    If that is the path of the page's own main container, it is that one; else all on the path, but for those with
    less than a tenth of the text of the longest; if none of these has text, the page's own.
    """
    nodes, own = page.nodes, best_node(page)
    if own is None:
        return ""
    chosen = {own}
    if path is not None and nodes[own].path != path:
        sums = _sums(page)
        on_path = [i for i, n in enumerate(nodes) if n.path == path and not n.junk and sums[i] > 0]
        most = max((sums[i] for i in on_path), default=0)
        chosen = {i for i in on_path if 10 * sums[i] >= most} or {own}
    under = [False] * len(nodes)
    for i, n in enumerate(nodes):
        under[i] = not n.junk and (i in chosen or (n.parent >= 0 and under[n.parent]))
    return "\n".join(t for i, t in page.blocks if under[i])


def _host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, path``: the container path with the most votes of the host's pages, each for its own best, ties by path."""

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best = [best_path(parse(t or "")) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.int64())], ["host", "path"])

    found = pages.select(_host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(votes, "host string, path long")
    counted = found.where("path is not null and host <> ''").groupBy("host", "path").agg(F.count("*").alias("n"))
    return counted.groupBy("host").agg(F.min(F.struct(-F.col("n"), "path")).alias("m")).select("host", "m.path")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of each row of ``pages(page_id, url, html)``: the main text by its host's winning path.

    Menus, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments, and headers outside of an
    article, are left out wherever tags or the heads of class words name them; what has no name goes by where it
    stands: the main container is the one that holds nearly all text that is no link. A page without the winning path,
    or of no host, uses its own main container; a page without text has an empty one, as have null and empty pages.
    Pages may be of any length and depth. Repeated rows give repeated rows; other columns are ignored. Votes are
    counted before they are shuffled, so a host may hold any share of the pages.
    """
    bounded_batches(pages.sparkSession)
    paths = materialize(host_paths(pages), "paths")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [text_under(parse(t or ""), p) for t, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), _host(F.col("url")).alias("host"))
    return rows.join(small_side(paths), "host", "left").select("page_id", "url", "html", "path").mapInArrow(texts, "page_id long, url string, text string")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op8_html": op8_html}
SQL: dict[str, str] = {}
