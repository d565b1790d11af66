"""Main text of web pages: markup, and a suffix array of each host's token streams.

Every page becomes blocks of text in page order. What the page says about a block is read from its
elements: a stated article (``article``, ``main``, article roles and classes), or menus, headers,
footers, sidebars, notices, adverts, forms and comments. What it leaves open is decided by the host:
all tokens of its pages are laid together, stated article prose in a stream of its own for each page, their
suffixes are sorted to a depth of ``DEPTH`` tokens, and a substring of that many tokens or more that stands on two
distinct pages of the host is repeated, in whichever streams it stands. Suffixes with equal first tokens stand next to each other, so
neighbours are compared, as in any suffix array; longer substrings are chains of such suffixes. Covered
tokens go and the unique runs between them stay. Repetition alone would keep an advert seen once and
drop an article published twice, so it never overrules a stated article or a stated advert.

The text is the open and stated blocks of the innermost statement a page makes: those in an
``article`` if there is text in one, else in ``main``, else in an element named like content, else in
the page. Inside it, prose stays and blocks that are nothing but links are left to the host.

The array also judges that statement, on every page: every suffix of stated prose is in it. Prose whose suffixes all
stand on other pages of the host is a template that calls itself an article, if the page holds more words of its own
outside than are in it: the text is then what the array leaves of the next statement outwards. Otherwise it is an
article published twice, and stays.

Suffixes are placed and sorted by a 64-bit hash of host and first tokens, then by page, so equal ones are neighbours in one
task. A task's share is even however large a host is; a line gives a task one row for each page that has it. Suffixes are
shuffled as they are made, not stored before, and the rows hold numbers only. Every page joins what its host repeats of it.

Defined cases: a null, empty or textless page has an empty text; a null or odd address is a host of its own
name or none; repeated rows of one page count as one page and are returned as often as they occur;
pages are told apart by number, address and content; other columns are ignored; an empty table gives an
empty result. Unclosed elements, comments and tags end as browsers end them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.llm.staging import scratch, stage

DEPTH = 6
SPARSE = 24
HELD = 1 << 16

TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)|</?[A-Za-z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style noscript template iframe textarea title svg math object canvas select".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE = frozenset("nav footer aside form button fieldset dialog menu header".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup paywall sidebar widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs "
    "pagination pager header masthead topbar footer copyright disclaimer comment comments disqus reply replies respond share sharing social "
    "related recommended recommendations trending login search toolbar hidden".split()
)
NOT_ASIDE = frozenset("no has with without is".split())
CONTENT_NAMES = frozenset("article post entry story content body text main page".split())
OWN = frozenset("article post entry story".split())
# elements that end where one of their kind starts, and what shields them
ENDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}

WHOLE, NAMED, MAIN, ARTICLE = range(4)


class Block(NamedTuple):
    """A stretch of text that no block element interrupts."""

    text: str
    zone: int  # the innermost statement that this is the article
    aside: bool  # the page states that it is not
    links: bool  # nothing but links


@lru_cache(maxsize=4096)
def _stated(tag: str, attributes: str) -> tuple[int, bool]:
    """What an element states about its text: zone, aside."""
    zone = {"article": ARTICLE, "main": MAIN}.get(tag, WHOLE)
    aside = tag in ASIDE
    for name, value, hidden in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if hidden or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            aside = True
        elif name == "role":
            aside = aside or value in ASIDE_ROLES
            zone = max(zone, {"main": MAIN, "article": ARTICLE}.get(value, WHOLE))
        elif name == "itemprop" and value == "articleBody":
            zone = max(zone, NAMED)
        elif name in ("class", "id") and tag not in ("html", "body", "main") and tag not in HEADINGS:
            for one in value.split():
                parts = [p.lower() for p in NAME.findall(one)]
                if NOT_ASIDE & set(parts):
                    continue
                own_header = {"header"} if OWN & set(parts) else set()
                if ASIDE_NAMES & set(parts) - own_header:
                    aside = True
                elif parts and set(parts) <= CONTENT_NAMES and parts[-1] in ("article", "content", "body", "text", "story"):
                    zone = max(zone, NAMED)
    return zone, aside


def blocks(html: str) -> list[Block]:
    """The blocks of a page that have text, in page order."""
    found: list[Block] = []
    stack: list[tuple[str, int, bool]] = [("", WHOLE, False)]  # element, zone and aside inside it
    texts: list[str] = []
    linked, plain, in_link = False, False, False

    def end_block() -> None:
        nonlocal linked, plain
        if texts:
            text = " ".join("".join(texts).split())
            if text:
                found.append(Block(text, stack[-1][1], stack[-1][2], linked and not plain))
            texts.clear()
        linked = plain = False

    def read(text: str) -> None:
        nonlocal linked, plain
        if text:
            texts.append(unescape(text) if "&" in text else text)
            if not text.isspace():
                linked, plain = linked or in_link, plain or not in_link

    at, end = 0, len(html)
    while at < end:
        tag = TAG.search(html, at)
        if not tag:
            read(html[at:])
            break
        read(html[at : tag.start()])
        at = tag.end()
        if not tag[2]:
            continue
        name, closing = tag[2].lower(), tag[1]
        if name in BLOCK:
            end_block()
        if name in VOID:
            continue
        if closing:
            if name == "a" or name in BLOCK:
                in_link = False
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in UNREAD:
            if tag[3].endswith("/") and name in ("svg", "math"):
                continue
            closed = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = closed.end() if closed else end
            continue
        if name == "a":
            in_link = True
            continue
        if name not in BLOCK and not tag[3].strip(" /"):
            continue
        if name in BLOCK:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    del stack[k:]
                if k >= len(stack) or stack[k][0] in BLOCK:
                    break
        if name in ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in SAME.get(name, (name,)):
                    del stack[k:]
                    break
                if stack[k][0] in ENDS[name]:
                    break
        zone, aside = _stated(name, tag[3])
        around = stack[-1]
        if name in HEADINGS and around[1] == ARTICLE:  # the heading in an article's own header is text
            around = next(s for s in reversed(stack) if s[0] not in ("header", "hgroup"))
        stack.append((name, max(zone, around[1]), aside or around[2]))
    end_block()
    return found


class Page(NamedTuple):
    """Blocks with the place of their tokens in one of two streams: stated prose, and all other text."""

    blocks: list[tuple[Block, int]]
    zone: int  # the innermost statement that has text
    stream: list[str]
    prose: list[str]

    def stated(self, block: Block) -> bool:
        return self.zone != WHOLE and block.zone == self.zone and not block.aside and not block.links


def parse(html: str | None) -> Page:
    """The blocks of a page, and its token streams for the host's array."""
    found = blocks(html) if html else []
    page = Page([], max((b.zone for b in found if not b.aside), default=WHOLE), [], [])
    for block in found:
        stream = page.prose if page.stated(block) else page.stream
        page.blocks.append((block, len(stream)))
        stream += block.text.split(" ")
    return page


def suffix_hashes(tokens: list[str]) -> np.ndarray:
    """A 64-bit hash of the first DEPTH tokens of each suffix that has so many, in order; alike in every stream."""
    n = len(tokens) - DEPTH + 1
    if n < 1:
        return np.empty(0, dtype=np.int64)
    words = np.fromiter((xxhash.xxh64_intdigest(x, 1) for x in tokens), dtype=np.uint64, count=len(tokens))
    hashes = words[:n].copy()
    for k in range(1, DEPTH):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    return hashes.view(np.int64)


def chosen_suffixes(tokens: list[str]) -> dict[int, list[int]]:
    """A sketch of a stream, by minimizers: hash of the first DEPTH tokens -> where they stand. The array has every suffix."""
    hashes = suffix_hashes(tokens)
    chosen = np.arange(len(hashes))
    if len(hashes) > SPARSE:
        windows = np.lib.stride_tricks.sliding_window_view(hashes.view(np.uint64), SPARSE)
        chosen = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    found: dict[int, list[int]] = {}
    for gram, at in zip(hashes[chosen].tolist(), chosen.tolist()):
        found.setdefault(gram, []).append(at)
    return found


def text_of(page: Page, starts: list[int] | None) -> str:
    """The text, given where the suffixes stand that another page of the host has: first those of the stream, then those of the prose."""
    size = len(page.stream)
    covered = np.zeros(size + DEPTH, dtype=bool)
    repeated = 0
    for at in starts or ():
        if at < size:
            covered[at : at + DEPTH] = True
        else:
            repeated += 1
    if repeated and repeated == len(page.prose) - DEPTH + 1:
        outside = [(b, at) for b, at in page.blocks if not b.aside and b.zone < page.zone]
        left = [(b.zone, not b.links, " ".join(x for k, x in enumerate(b.text.split(" "), at) if not covered[k])) for b, at in outside]
        zone = max((z for z, prose, text in left if prose and text), default=WHOLE)
        if sum(len(text.split()) for z, prose, text in left if prose and z == zone) > len(page.prose):
            return " ".join(text for z, _, text in left if z == zone and text)
    kept: list[str] = []
    for block, at in page.blocks:
        text = ""
        if page.stated(block):
            text = block.text
        elif block.zone == page.zone and not block.aside:
            text = " ".join(x for k, x in enumerate(block.text.split(" "), at) if not covered[k])
        if text:
            kept.append(text)
    return " ".join(kept)


def host_of(url: Column) -> Column:
    """Host of an address, in lower case, without user and port."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (host, page, html) -> host, gram: its first DEPTH tokens, page, starts: where they stand there.

    A page has a suffix for each token, so a batch goes out after every ``HELD`` suffixes and not with each batch of pages.
    """
    hosts, pages, grams, counts, starts = [], [], [], [], []
    held = 0

    def made() -> pa.RecordBatch:
        flat = [np.concatenate([np.empty(0, np.int64), *x]) for x in (hosts, grams, pages)]
        ends = np.cumsum(np.concatenate([[0], *counts])).astype(np.int32)
        places = pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int32), *starts]))
        for x in (hosts, grams, pages, counts, starts):
            x.clear()
        return pa.RecordBatch.from_arrays([*map(pa.array, flat), places], ["host", "gram", "page", "starts"])

    for batch in batches:
        for host, page, html in zip(*batch.columns):
            read = parse(html.as_py())
            own = [suffix_hashes(x) for x in (read.stream, read.prose)]
            at = np.concatenate([np.arange(len(own[0])), len(read.stream) + np.arange(len(own[1]))])
            every = np.concatenate(own)
            order = np.argsort(every, kind="stable")
            distinct, times = np.unique(every, return_counts=True)
            grams.append(distinct)
            counts.append(times)
            starts.append(at[order].astype(np.int32))
            hosts.append(np.full(len(distinct), host.as_py()))
            pages.append(np.full(len(distinct), page.as_py()))
            held += len(distinct)
            if held >= HELD:
                yield made()
                held = 0
    yield made()


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes (page, gram, start) in order of gram and page -> page and start of those whose gram is on another page too.

    Of the last gram so far only the rows of a single page wait; once a second page is seen, it is known as repeated.
    """
    waiting = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)]
    known: int | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        page, gram, start = (np.concatenate([x, y.to_numpy()]) for x, y in zip(waiting, batch.columns))
        same, turned = gram[1:] == gram[:-1], page[1:] != page[:-1]
        fresh = np.concatenate([[True], ~same | turned | (start[1:] != start[:-1])])  # not the same page given twice
        run = np.cumsum(np.concatenate([[0], ~same]))
        mixed = np.zeros(run[-1] + 1, dtype=bool)
        mixed[run[1:][same & turned]] = True
        mixed[0] |= known is not None and known == gram[0]
        out, last = mixed[run] & fresh, (run == run[-1]) & fresh & ~mixed[-1]
        known = int(gram[-1]) if mixed[-1] else None
        waiting = [page[last], gram[last], start[last]]
        yield pa.RecordBatch.from_arrays([pa.array(page[out]), pa.array(start[out])], ["page", "start"])


def repeated_suffixes(pages: DataFrame) -> DataFrame:
    """(host, page, html) -> page, starts: where substrings of DEPTH tokens begin that another page of the host has too."""
    made = pages.select("host", "page", "html").mapInArrow(_suffixes, "host bigint, gram bigint, page bigint, starts array<int>")
    suffixes = made.select("page", F.xxhash64("host", "gram").alias("gram"), F.explode("starts").alias("start"))
    ordered = suffixes.repartition("gram").sortWithinPartitions("gram", "page", "start")
    covered = ordered.mapInArrow(_neighbours, "page bigint, start int")
    return covered.groupBy("page").agg(F.collect_set("start").alias("starts"))


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (page_id, url, html, starts) -> page_id, url, text."""
    for batch in batches:
        texts = [text_of(parse(html.as_py()), starts.as_py()) for html, starts in zip(batch.column(2), batch.column(3))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, one row per page."""
    spark = pages.sparkSession
    given = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), pages["html"].alias("html"))
    given = given.select("page_id", "url", F.xxhash64(host_of(F.col("url"))).alias("host"), F.xxhash64("page_id", "url", "html").alias("page"), "html")
    with scratch(spark):
        covered = stage(repeated_suffixes(given), keep=True)
    rows = given.join(covered, "page", "left").select("page_id", "url", "html", "starts")
    return rows.mapInArrow(_decided, "page_id bigint, url string, text string")
