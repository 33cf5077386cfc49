"""Main text of web pages by consensus host paths.

Each page scores its containers, takes the deepest one that holds most of its running text, climbs from there to the one
that holds the whole article, and votes for it; a container is named by its generalised path of tags and classes (digits
out). Votes are summed per host, and each page of the host is then
re-extracted from the winning path. A page without it, or without a host, falls back on its own best container.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .scratch import materialise, unused, without

#: Elements whose content is raw text, up to their end tag or the page's end.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Elements without text of their own. One whose end tag is missing, or stands beyond the body's start tag, holds nothing.
EMPTY = frozenset("noscript template svg select math object canvas".split())
NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
#: The end of a tag, or an attribute with an opening quote or an unquoted value. No step gives back what it took, so tags of any
#: length are read in one pass.
ATTRIBUTE = re.compile(r"[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:([\"'])|([^\s>\"'][^\s>]*+)?+))?+)")
#: Elements that can hold the article, elements that only end a block, and elements without content.
CONTAINERS = frozenset("html body main article section div td center dd figure blockquote details".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt table thead tbody tfoot tr th caption pre hr address fieldset legend figcaption summary header footer nav aside form menu dialog button".split())
#: Parts of an article, never a whole one.
PARTS = frozenset("blockquote figure dd details".split())
#: Code points from which a block outside links is running text; shorter ones are labels.
RUNNING = 40
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
#: A header within one of these is that of the article or of a part of it.
SCOPES = frozenset("article main section".split())
#: Never part of an article, by element, by role, and by a word of the class or id.
NOT_TEXT = frozenset("nav footer aside form menu dialog button fieldset".split())
NOT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
NOT_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer foot sidebar aside rail ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay share sharing social related recommended recommendations newsletter subscribe subscription signup login "
    "search widget toolbar pagination pager comment comments disqus respond replies form hidden".split()
)
#: Words that say where or how, not what. A class tells something only if it consists of these and of words above: "share-buttons"
#: and "cookie-notice" do, "share-price", "form-factor" and "has-sidebar" don't.
NEUTRAL = frozenset(
    "box block wrap wrapper container content section area panel panels list links link button buttons btn icon icons inner outer group bar item items row col column top bottom left right "
    "main primary secondary site page global mobile desktop post posts article articles entry entries story stories slot unit text title heading body float fixed sticky module region zone "
    "reader user js is wp".split()
)
#: With one of these, a header is that of the article.
OF_ARTICLE = frozenset("post article entry story content section title".split())
#: An element closes open elements of these kinds when it starts: HTML lets authors leave out the end tags.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Element(NamedTuple):
    tag: str
    path: str | None  # of a container, else that of the container around it
    number: int  # of that container on the page
    skipped: bool


class Block(NamedTuple):
    text: str
    linked: int  # its code points within links
    within: tuple[tuple[int, str], ...]  # the containers around it, outermost first
    tag: str  # of the innermost element around it


def _named(tag: str, attributes: dict[str, str]) -> str:
    kinds = sorted({re.sub(r"\d+", "#", c.lower()) for c in attributes.get("class", "").split()})[:3]
    return ".".join([tag, *kinds])


def _skips(tag: str, attributes: dict[str, str], in_article: bool, by_words: bool) -> bool:
    if tag in NOT_TEXT or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in NOT_ROLES or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    if not by_words:
        return False
    for name in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
        parts = {x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if len(x) > 1}
        told = parts & NOT_WORDS
        if told == {"header"} and (in_article or parts & OF_ARTICLE):
            continue
        if told and parts <= NOT_WORDS | NEUTRAL:
            return True
    return False


def _ends(html: str, tag: str) -> dict[int, int]:
    """Of an element's start tags, by position, where the end tag that closes each begins."""
    out, opened = {}, []
    for m in re.finditer(rf"<(/?){tag}(?=[\s/>])", html, re.I):
        if not m[1]:
            opened.append(m.start())
        elif opened:
            out[opened.pop()] = m.start()
    return out


def tags(html: str) -> Iterator[tuple[int, int, bool, str, dict[str, str]]]:
    """Start, end, whether it is an end tag, name and attributes of each tag; the name is empty for what isn't text nor a tag.

    What stands between is text. Raw text and elements without text of their own are part of their start tag. A quote that
    is never closed is part of an unquoted value; a tag that never ends takes the rest of the page, as in browsers. The
    time is linear in the page: what is not found once is not searched again.
    """
    at, n = 0, len(html)
    closed: dict[str, bool] = {'"': True, "'": True}
    ends: dict[str, dict[int, int]] = {}
    body: list[int] | None = None
    while (start := html.find("<", at)) >= 0:
        at = start + 1
        slash = html.startswith("/", at)
        m = NAME.match(html, at + slash)
        if not m:
            if html.startswith("!--", at):
                end = html.find("-->", at + 1)  # "<!-->" is a whole comment
                at = n if end < 0 else end + 3
                yield start, at, False, "", {}
            elif html[at : at + 1] in ("!", "?", "/") and at < n:
                end = html.find(">", at)
                at = n if end < 0 else end + 1
                yield start, at, False, "", {}
            continue
        tag, at, attributes, alone = m[0].lower(), m.end(), {}, False
        while True:
            a = ATTRIBUTE.match(html, at)
            if not a:
                yield start, n, False, "", {}
                return
            at = a.end()
            if a[1]:
                alone = html[at - 2] == "/"
                break
            value = a[4] or ""
            if quote := a[3]:
                end = html.find(quote, at) if closed[quote] else -1
                if end < 0:
                    closed[quote] = False
                    while end < n and not (end >= 0 and (html[end] == ">" or html[end].isspace())):
                        end = max(at, end + 1)
                    value, at = html[at:end], end
                else:
                    value, at = html[at:end], end + 1
            attributes.setdefault(a[2].lower(), value)
        if not slash and tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = (html.find(">", end.end()) + 1 or n) if end else n
            tag = ""
        elif not slash and tag in EMPTY and not alone:
            if tag not in ends:
                ends[tag] = _ends(html, tag)
            if body is None:
                body = [x.start() for x in re.finditer(r"<body(?=[\s/>])", html, re.I)]
            end = ends[tag].get(start)
            k = bisect_right(body, start)
            if end is not None and end >= at and not (k < len(body) and body[k] < end):
                at = html.find(">", end) + 1 or n
                tag = ""
        yield start, at, slash, tag, attributes


def blocks(html: str, by_words: bool = True) -> list[Block]:
    """The blocks of a page outside menus, adverts and the like, in page order, white space made one space.

    Where words of classes and ids leave no text at all, they are taken back, and only elements and roles tell.
    """
    out: list[Block] = []
    stack: list[Element] = []
    around: list[tuple[int, str]] = []
    pieces: list[str] = []
    linked, link, skipping, articles, counter, at = 0, False, 0, 0, 0, 0
    told = False

    def flush() -> None:
        nonlocal linked
        if pieces:
            if text := " ".join(entities.unescape("".join(pieces)).split()):
                out.append(Block(text, linked, tuple(around), stack[-1].tag if stack else ""))
            pieces.clear()
            linked = 0

    def close() -> None:
        nonlocal skipping, articles
        e = stack.pop()
        skipping -= e.skipped
        articles -= e.tag in SCOPES
        if e.path is not None:
            around.pop()

    def skips(tag: str, attributes: dict[str, str]) -> bool:
        nonlocal told
        if not _skips(tag, attributes, articles > 0, by_words):
            return False
        told = told or by_words
        return True

    for start, end, slash, tag, attributes in tags(html):
        if start > at and not skipping:
            pieces.append(html[at:start])
            if link:
                linked += start - at
        at = end
        if not tag:
            continue
        if tag == "a":
            link = not slash
        if tag == "br":
            pieces.append(" ")
        if tag not in BLOCKS:
            # an inline element with a telling class can hide text too; those of the same kind within it are counted
            inside = bool(stack) and stack[-1].tag == tag
            if slash:
                if inside:
                    close()
            elif tag not in VOID and (inside or tag in ("span", "a", "ins", "label") and attributes and skips(tag, attributes)):
                stack.append(Element(tag, None, 0, not inside))
                skipping += not inside
            continue
        flush()
        if slash:
            if any(e.tag == tag for e in stack):
                while stack[-1].tag != tag:
                    close()
                close()
            continue
        if tag in VOID:
            continue
        while stack and (stack[-1].tag == "p" or stack[-1].tag in IMPLIED.get(tag, ())):
            close()
        skipped = skips(tag, attributes)
        path = None
        if tag in CONTAINERS:
            counter += 1
            path = (around[-1][1] + ">" if around else "") + _named(tag, attributes)
            around.append((counter, path))
        stack.append(Element(tag, path, counter, skipped))
        skipping += skipped
        articles += tag in SCOPES
    if at < len(html) and not skipping:
        pieces.append(html[at:])
    flush()
    return out if out or not told else blocks(html, False)


def _tag(path: str) -> str:
    return path.rsplit(">", 1)[-1].split(".", 1)[0]


def _whole(page: list[Block], chain: tuple[tuple[int, str], ...], held: dict[tuple[int, str], int]) -> tuple[int, str]:
    """Of a container and those around it (chain, outermost first), the least that holds the whole article.

    At least the article around it, or else the main. Within the main, or the page if it has neither, also every other
    block of running text, and a top heading that isn't the page's own (directly in the body); but nothing outside an
    article without a main, nor a main.
    """
    tags = [_tag(path) for _, path in chain]
    at, bound = len(chain) - 1, 0
    if "article" in tags or "main" in tags:
        bound = tags.index("main") if "main" in tags else tags.index("article")
        at = tags.index("article") if "article" in tags else bound
        bound = min(bound, at)
    for b in page:
        shared = sum(c == d for c, d in zip(b.within, chain))
        if not bound < shared <= at:
            continue
        heading = b.tag == "h1" and tags[shared - 1] not in ("html", "body")
        if heading or len(b.text) - 2 * b.linked >= RUNNING:
            at = shared - 1
    while at > bound and (tags[at] in PARTS or tags[at] == "td" and held.get(chain[at - 1], 0) > held[chain[at]]):
        at -= 1
    return chain[at]


def best_path(page: list[Block], share: float = 0.7) -> tuple[str | None, int]:
    """The path of the page's own best container, and the size of the running text that it holds.

    It is the deepest one that holds `share` of the running text, or the one around it that holds the whole article.
    """
    held: dict[tuple[int, str], int] = {}
    total = 0
    for b in page:
        plain = max(0, len(b.text) - 2 * b.linked)
        total += plain
        for c in b.within:
            held[c] = held.get(c, 0) + plain
    deep = [c for c, n in held.items() if n >= share * total]
    if not deep or not total:
        return None, 0
    deepest = max(deep)  # containers are numbered as they open, so the last is the deepest
    chain = next(b.within[: b.within.index(deepest) + 1] for b in page if deepest in b.within)
    best = _whole(page, chain, held)
    return best[1], held[best]


def text_of(page: list[Block], path: str | None) -> str:
    """The blocks within containers of a path; of the page's own best one if it has none; all if it has no container."""
    kept = [b.text for b in page if any(p == path for _, p in b.within)] if path else []
    if not kept:
        own, _ = best_path(page)
        kept = [b.text for b in page if own is None or any(p == own for _, p in b.within)]
    return "\n".join(kept)


def _votes(batches):
    for batch in batches:
        found = [best_path(blocks(x)) if x else (None, 0) for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())], names=["host", "path", "size"])


def _extract(batches, passed: list[str]):
    for batch in batches:
        texts = [text_of(blocks(x), path) if x else "" for x, path in zip(batch.column("html").to_pylist(), batch.column("host_path").to_pylist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), batch.column("host_path")], names=[*passed, "text", "n_chars", "host_path"])


def host_paths(pages: DataFrame) -> DataFrame:
    """host, host_path: the path with most votes of the host's pages; ties go to more text, then to the lesser path."""
    schema = StructType([StructField("host", StringType()), StructField("path", StringType()), StructField("size", LongType())])
    votes = pages.select(_host(), "html").filter("host is not null").mapInArrow(_votes, schema).filter("path is not null")
    tally = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    return tally.groupBy("host").agg(F.min_by("path", F.struct(-F.col("n"), -F.col("size"), "path")).alias("host_path"))


def _host():
    host = F.lower(F.regexp_extract(F.col("url"), r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host).alias("host")


def extract_pages(pages: DataFrame, few_hosts: int = 20_000) -> DataFrame:
    """The columns of pages(url, html, ...) with text, n_chars (code points) and host_path; one row per row.

    A null or empty html gives an empty text. A page whose url is null or has no host isn't part of a vote and uses its
    own best container. Repeated pages vote as often as they stand there. Columns named text, n_chars or host_path are
    replaced; all others stay. Hosts' paths are broadcast up to few_hosts of them and joined by shuffle beyond.
    """
    passed = without(pages, "text", "n_chars", "host_path")
    (host,) = unused(pages, "host")
    paths = materialise(host_paths(pages), "host-paths").withColumnRenamed("host", "host_")
    paths = F.broadcast(paths) if paths.count() <= few_hosts else paths
    rows = pages.select(*passed, _host().alias(host))
    rows = rows.join(paths, rows[host] == paths["host_"], "left").select(*(rows[c] for c in passed), "host_path")
    schema = StructType([*(pages.schema[c] for c in passed), StructField("text", StringType()), StructField("n_chars", LongType()), StructField("host_path", StringType())])
    return rows.mapInArrow(lambda it: _extract(it, passed), schema)
