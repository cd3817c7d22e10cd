"""Main text of web pages: markup first, then long strings that the pages of a host share."""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged
from ledgerloom.llm.url_filters import host_of
from ledgerloom.session import checked_broadcast

#: Words of a string that counts as boilerplate when distinct pages of a host share it.
RUN_WORDS = 12
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "select", "button"}
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
SPACED = {"br", "td", "th", "option"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track"}
#: Elements whose end matters; others are closed by the end of any of these around them.
CONTAINERS = CHROME | set("article main section div header ul ol table td tr blockquote body details figure p li span".split())
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Words in a class, id or role that mark page furniture, and words of names that only describe a layout.
FURNITURE = set(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices notification newsletter subscribe subscription signup sidebar sidenav widget widgets menu nav navbar"
    " navigation breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar comment comments commentlist disqus"
    " respond replies share sharing social related recommended popup modal overlay search login skip".split()
)
LAYOUT = set("with has no content main wrapper layout page body article post entry container text story".split())
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}


def is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in CHROME or (tag == "header" and not in_article):
        return True
    if not attributes.strip():
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name in ("class", "id"):
            for word in value.split():
                parts = set(re.split(r"[-_]+", word))
                if parts & FURNITURE and not parts & LAYOUT:
                    return True
    return False


def page_blocks(page: str) -> list[tuple[str, str, bool]]:
    """``(text, region, furniture)`` for every block of a page, in order. The region is article, main or empty."""
    out: list[tuple[str, str, bool]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, str]] = []  # tag, whether it began furniture, region that it began
    furniture, articles, mains = 0, 0, 0

    def end_block() -> None:
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append((text, "article" if articles else "main" if mains else "", furniture > 0))
            held.clear()

    at, raw = 0, ""
    lower = ""
    for found in TOKEN.finditer(page):
        if found.start() < at:
            continue
        if found.start() > at:
            held.append(html.unescape(page[at : found.start()]))
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        closing, attributes = found[1] or found[4], found[3] or found[6] or ""
        if tag in BLOCKS:
            end_block()
        elif tag in SPACED:
            held.append(" ")
        if closing:
            if tag in CONTAINERS and any(x[0] == tag for x in stack):
                while stack:
                    own, began, region = stack.pop()
                    furniture -= began
                    articles -= region == "article"
                    mains -= region == "main"
                    if own == tag:
                        break
            continue
        if tag in RAW and not attributes.endswith("/"):
            lower = lower or page.lower()
            stop = re.compile(rf"</{re.escape(tag)}\s*>").search(lower, at) if len(lower) == len(page) else None
            if stop is None:
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        if tag in VOID or tag not in CONTAINERS or attributes.endswith("/"):
            continue
        if tag in ("p", "li", "td", "tr"):  # the next one ends the one before
            if stack and stack[-1][0] == tag:
                furniture -= stack.pop()[1]
        began = is_furniture(tag, attributes, articles > 0)
        region = ""
        if tag in ("article", "main") or (tag in ("div", "section") and re.search(r"""role\s*=\s*["']?main""", attributes)):
            region = "article" if tag == "article" else "main"
            if not began:
                articles += region == "article"
                mains += region == "main"
            else:
                region = ""
        furniture += began
        if began or region or tag not in ("p", "span"):
            stack.append((tag, began, region))
    if at < len(page):
        held.append(html.unescape(page[at:]))
    end_block()
    return out


PARSED = "page_id long, url string, host string, h long, declared boolean, text string, blocks array<string>, uses array<byte>, stream string"
#: What becomes of a block: left out, its words kept unless pages share them, kept whole.
OUT, UNSHARED, WHOLE = 0, 1, 2


def block_uses(blocks: list[tuple[str, str, bool]]) -> list[int]:
    """The use of each block. Articles stay whole, and so does the main part of a page without any; the main part around
    articles, and all of a page that declares neither, stays unless shared."""
    regions = {region for _, region, furniture in blocks if not furniture}
    around = UNSHARED if "article" in regions else WHOLE
    uses = {"article": WHOLE, "main": around, "": OUT if regions - {""} else UNSHARED}
    return [OUT if furniture else uses[region] for _, region, furniture in blocks]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in PARSED.split(", ")]
    for whole in batches:
        for batch in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
            out: list[list] = [[] for _ in range(6)]
            for text in batch.column(3):
                page = text.as_py() or ""
                blocks = page_blocks(page)
                uses = block_uses(blocks)
                declared = UNSHARED not in uses and WHOLE in uses
                rest = [b[0] for b, use in zip(blocks, uses, strict=True) if not declared or use == OUT]
                out[0].append(int.from_bytes(hashlib.blake2b(page.encode(), digest_size=8).digest(), signed=True))
                out[1].append(declared)
                out[2].append("\n\n".join(b[0] for b, use in zip(blocks, uses, strict=True) if use) if declared else None)
                out[3].append([] if declared else [b[0] for b in blocks])
                out[4].append([] if declared else uses)
                out[5].append(" ".join(rest))
            types = (pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int8()), pa.string())
            arrays = [pa.array(x, t) for x, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names=names)


SUFFIX = "host string, suffix string, h long, place int, declared boolean"
INTERVAL = "host string, suffix string, least long, most long, edge boolean, pages array<long>, places array<int>"
#: Suffixes in a batch, and members of an interval in a row.
SOME = 10_000


def _suffixes(run_words: int):
    """Every suffix of a page's stream that has ``run_words`` words, up to that depth."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> pa.RecordBatch:
            hosts, hashes, closed, counts, suffixes, places = out
            per = [np.repeat(np.array(x, t), counts) for x, t in ((np.arange(len(hosts)), np.int64), (hashes, np.int64), (closed, bool))]
            return pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()).take(pa.array(per[0])), pa.array(suffixes, pa.string()), pa.array(per[1]),
                 pa.array(places, pa.int32()), pa.array(per[2])],
                names=["host", "suffix", "h", "place", "declared"],
            )

        out: list[list] = [[] for _ in range(6)]
        for batch in batches:
            for host, h, declared, stream in zip(*(batch.column(i) for i in range(4)), strict=True):
                text = stream.as_py()
                starts = [0]
                at = text.find(" ")
                while at >= 0:
                    starts.append(at + 1)
                    at = text.find(" ", at + 1)
                n = len(starts) - run_words + 1
                if n < 1:
                    continue
                ends = starts[run_words:] + [len(text) + 1]
                for x, value in zip(out, (host.as_py(), h.as_py(), declared.as_py(), n), strict=False):
                    x.append(value)
                out[4].extend([text[b : e - 1] for b, e in zip(starts, ends, strict=False)])
                out[5].extend(range(n))
                if len(out[4]) >= SOME:
                    yield made()
                    out = [[] for _ in range(6)]
        if out[4]:
            yield made()

    return rows


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The intervals of a sorted range of suffixes whose neighbours agree to the full depth.

    Those that touch an end of the range may go on in the next one and are marked as ``edge``; of the others only those
    with distinct pages are given. Members are the suffixes of pages that declare nothing, without repetition.
    """

    def made(now: list, edge: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x], kind) for x, (_, kind) in zip((*now[:4], edge, now[4], now[5]), fields, strict=True)], names=[name for name, _ in fields]
        )

    fields = [("host", pa.string()), ("suffix", pa.string()), ("least", pa.int64()), ("most", pa.int64()), ("edge", pa.bool_()),
              ("pages", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))]
    now: list | None = None  # host, suffix, least and most page, pages and places of the members not given yet
    first = True  # no interval has ended yet
    for batch in batches:
        if not batch.num_rows:
            continue
        host, suffix = batch.column(0), batch.column(1)
        h, place = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        member = ~batch.column(4).to_numpy(zero_copy_only=False)
        agree = _agrees(suffix) & _agrees(host)
        member[1:] &= ~(agree & (h[1:] == h[:-1]) & (place[1:] == place[:-1]))
        begins = np.flatnonzero(np.r_[True, ~agree])
        ends = np.r_[begins[1:], batch.num_rows]
        for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
            if begin == 0 or begin == begins[-1] or h[begin] != h[end - 1]:
                key = [host[begin].as_py(), suffix[begin].as_py()]
            else:  # neither end of the batch, one page
                key = None
            if now is not None and now[:2] != key:
                if first or now[2] != now[3]:
                    yield made(now, first)
                now, first = None, False
            if key is None:
                continue
            if now is None:
                now = [*key, int(h[begin]), int(h[begin]), [], []]
            now[3] = int(h[end - 1])
            for b in range(begin, end, SOME):
                own = np.flatnonzero(member[b : min(b + SOME, end)]) + b
                now[4] += h[own].tolist()
                now[5] += place[own].tolist()
                if len(now[4]) >= SOME and now[2] != now[3]:
                    yield made(now, True)
                    now[4], now[5] = [], []
    if now is not None:
        yield made(now, True)


def _agrees(column: pa.Array) -> np.ndarray:
    """Whether a value equals the one before it."""
    return pc.equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)


def _unique_runs(run_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for i in range(batch.num_rows):
                blocks, uses = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                covered: set[int] = set()
                for place in batch.column(4)[i].as_py() or ():
                    covered.update(range(place, place + run_words))
                kept, n = [], 0
                for block, use in zip(blocks, uses, strict=True):
                    words = block.split(" ")
                    if use == WHOLE:
                        kept.append(block)
                    elif use == UNSHARED:
                        kept.append(" ".join(w for j, w in enumerate(words, n) if j not in covered))
                    n += len(words)
                texts.append("\n\n".join(x for x in kept if x))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return rows


def shared_places(parsed: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """``(host, h, places)`` for pages that declare nothing: where strings of ``run_words`` words start in their streams
    that distinct pages of the host have too.

    The suffixes of all streams of ``parsed(host, h, declared, stream)`` are sorted by host and words into ranges of equal
    size, to the depth of ``run_words`` words: a word lies in a longer shared string exactly if it lies in a shared one of
    this length, so the order further down decides nothing. Neighbours are compared in their range; an interval of
    neighbours that agree to this depth is one shared string, and its first and last page tell whether pages differ.
    Only intervals at the ends of ranges are put together across tasks, so a string or a host with any share of all
    suffixes is spread.
    """
    order = ["host", "suffix", "h", "place"]
    suffixes = parsed.filter("host <> ''").select("host", "h", "declared", "stream").mapInArrow(_suffixes(run_words), SUFFIX)
    array = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    found = staged(array.mapInArrow(_intervals, INTERVAL), "intervals")
    spanning = found.filter("edge").groupBy("host", "suffix").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    spanning = spanning.filter("least <> most").select("host", "suffix")
    members = found.filter("size(pages) > 0")
    members = members.filter("not edge").unionByName(members.filter("edge").join(spanning, ["host", "suffix"], "left_semi"))
    zipped = members.select("host", F.explode(F.arrays_zip("pages", "places")).alias("m"))
    return zipped.groupBy("host", F.col("m.pages").alias("h")).agg(F.collect_set("m.places").alias("places"))


def extract_text(pages: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """``(page_id, url, text, n_chars long)`` for every row of ``pages(page_id, url, html)``.

    Markup is read in tasks: menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
    comments are known by element, role, class and id. What a page declares as its article is kept whole, and without any
    article what it declares as its main part. Other text is compared with all pages of the host: the text in the main
    part around articles, and everything on a page that declares neither, loses the words of strings of ``run_words``
    words or more that distinct pages of the host share, and what is left outside furniture is kept. The suffix array of
    a host (see ``shared_places``) holds the text of all of its pages, declared articles included; where every page is
    decided by its declarations, articles have nothing to be compared with and are left out of it.

    Character references are decoded, white space in a block becomes one space, blocks are joined by two line feeds.
    Null html is an empty text. A null url or one without ``://`` has an empty host, whose pages share nothing. Copies of
    one html on a host count as one page. Rows that repeat a page give repeated results; an empty table gives an empty
    result; other columns are not read.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), "html")
    parsed = staged(rows.mapInArrow(_parse, PARSED), "parsed")
    open_pages = parsed.filter("not declared")
    hosts = checked_broadcast(open_pages.filter("host <> ''").select("host").distinct())
    articles = parsed.filter("declared").join(hosts, "host", "left_semi").withColumn("stream", F.replace("text", F.lit("\n\n"), F.lit(" ")))
    streams = [df.select("host", "h", "declared", "stream") for df in (parsed, articles)]
    lists = shared_places(streams[0].unionByName(streams[1]), run_words)
    left = open_pages.join(lists, ["host", "h"], "left").select("page_id", "url", "blocks", "uses", "places")
    text = parsed.filter("declared").select("page_id", "url", "text").unionByName(
        left.mapInArrow(_unique_runs(run_words), "page_id long, url string, text string")
    )
    return text.withColumn("n_chars", F.length("text").cast("long"))
