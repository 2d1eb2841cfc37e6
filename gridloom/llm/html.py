"""Main text of web pages: block structure, then differencing against the nearest pages by URL.

A page is cut into text blocks. Elements that are never article text (menus,
footers, adverts, forms, comments...) go by their tag or by a whole class name,
id or role, but never with an article or main element inside them. Pages of
one host are then ordered by path and each is paired with the next one; the
blocks of a pair are aligned by a longest common subsequence, and shared
blocks are template text: they are deleted, unless they are prose inside an
article element, which the markup vouches for, or most of the page's prose is
shared, which means that the two pages are copies of one another.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.common import bounded_broadcast, numbered, running_total
from gridloom.session import cut_lineage

#: Share of a page's prose (by length) from which a neighbour counts as a copy of it.
COPY = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|iframe|svg|select|button)\b.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Elements whose content is never article text.
CUT_TAGS = frozenset("nav footer aside form head dialog menu header".split())
#: Of these, such as hold articles that are not the page's own (teasers) where another article or main element stands outside them.
_TEASERS = frozenset("nav footer aside menu".split())
#: Whole class names, ids and roles that mark such content.
CUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar complementary footer contentinfo header masthead cookie cookies consent gdpr notice notices "
    "alert popup modal newsletter subscribe share sharing social comment comments commentlist disqus reply replies related "
    "login signup search widget toolbar pagination pager".split()
)
#: Of these, such as an article's own title and remarks bear.
_OWN = frozenset("header notice notices alert".split())
_ARTICLE = frozenset(("article", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption caption".split())
_BLOCK = _PROSE | _ARTICLE | CUT_TAGS | frozenset(
    "html body div section ul ol dl table thead tbody tfoot tr figure hr address details summary center fieldset".split()
)
_VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())


def _names(tag: str, attributes: str) -> set[str]:
    """The class names, id and role of an element; ids of headings are link targets and say nothing."""
    out: set[str] = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "role") or name == "id" and tag not in _HEADINGS:
            out.update("".join(values).lower().split())
    return out


def blocks(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, inside an article element, prose) of each block that isn't cut by its markup, in page order."""
    out, holders = _blocks(page or "", frozenset())
    return _blocks(page or "", holders)[0] if holders else out


def _blocks(page: str, spared: frozenset[int]) -> tuple[list[tuple[str, bool, bool]], frozenset[int]]:
    """The blocks, and where the cut elements begin that hold the page's article or main element and are to be spared.

    What is cut inside an article stays cut, with the articles in there: those are comments.
    """
    out, buffer = [], []
    stack: list[tuple[str, int]] = []  # open elements: tag, and where it begins if it is cut, else -1
    cut = article = 0
    holders: set[int] = set()
    teasers: set[int] = set()
    own = False  # whether an article or main element stands outside the elements of teasers

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            tag = next((t for t, _ in reversed(stack) if t in _BLOCK), "")
            out.append((text, article > 0, tag in _PROSE))

    def pop() -> None:
        nonlocal cut, article
        tag, began = stack.pop()
        cut -= began >= 0
        article -= tag in _ARTICLE

    def text(a: int, b: int) -> None:
        if not cut and a < b:
            buffer.append(html.unescape(page[a:b]))

    end = 0
    for m in _TOKEN.finditer(page):
        text(end, m.start())
        end = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        block = tag in _BLOCK
        if block:
            flush()
        if m[2]:
            if any(t == tag for t, _ in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if block and stack and stack[-1][0] == "p":
            pop()
        if tag == "li" and stack and stack[-1][0] == "li":
            pop()
        if tag in _VOID:
            if tag == "br":
                buffer.append(" ")
            continue
        names = _names(tag, m[4]) & CUT_NAMES if m[4] else set()
        if article:  # an article's own header holds its title
            names -= _OWN
        is_cut = bool(names) and tag not in ("html", "body", "article", "main") or tag in CUT_TAGS and not (article and tag == "header")
        is_cut = is_cut and m.start() not in spared
        if tag in _ARTICLE and not article:
            around = [(t, began) for t, began in stack if began >= 0]
            if tag == "article" and any(t in _TEASERS for t, _ in around):
                teasers.update(began for _, began in around)
            else:
                holders.update(began for _, began in around)
                own = True
        if block or is_cut:
            stack.append((tag, m.start() if is_cut else -1))
            cut += is_cut
            article += tag in _ARTICLE
    text(end, len(page))
    flush()
    return out, frozenset(holders if own else teasers)


def _key(text: str) -> int:
    data = text.encode("utf-8", "surrogatepass")
    return zlib.crc32(data) << 31 ^ zlib.adler32(data) ^ len(data) << 52 & 0x7FF0000000000000


def common(a: Sequence, b: Sequence) -> tuple[list[int], list[int]]:
    """Places of one longest common subsequence in both sequences, by bit vectors over ``b``."""
    masks: dict = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        hit = row & masks.get(x, 0)
        row = (row + hit | row - hit) & full
        rows.append(row)
    i, j, in_a, in_b = len(a), len(b), [], []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                in_a.append(i)
                in_b.append(j)
    return in_a[::-1], in_b[::-1]


def _outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page, what the differencing needs: keys, lengths and flags of its blocks."""
    for b in batches:
        keys, sizes, open_ = [], [], []
        for page in b.column(2).to_pylist():
            made = blocks(page)
            keys.append([_key(t) for t, _, _ in made])
            sizes.append([len(t) if prose else 0 for t, _, prose in made])
            open_.append([not (inside and prose) for _, inside, prose in made])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(keys, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())), pa.array(open_, pa.list_(pa.bool_()))],
            ["row", "url", "keys", "sizes", "open"],
        )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each pair of pages, the open blocks of either that it shares with the other."""
    for b in batches:
        rows, places = [], []
        for a, keys, sizes, open_, a2, keys2, sizes2, open2 in zip(*(c.to_pylist() for c in b.columns)):
            found = common(keys, keys2)
            for row, at, size, free in ((a, found[0], sizes, open_), (a2, found[1], sizes2, open2)):
                copy = sum(size[k] for k in at) >= COPY * sum(size) if sum(size) else False
                gone = [] if copy else [k for k in at if free[k]]
                if gone:
                    rows.append(row)
                    places.append(gone)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(places, pa.list_(pa.int32()))], ["row", "gone"])


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty where there is none."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    return F.lower(F.regexp_extract(bare, r"^//([^/?#]*)", 1)), F.regexp_extract(bare, r"^(?://[^/?#]*)?([^?#]*)", 1)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages(page_id, url, html)``: ``page_id, url, text, n_chars``.

    Null and empty pages have an empty text. Pages without a host are not
    paired. Where a page has an article or main element, its text is what
    stands in there. Repeated rows are copies of one another and keep their
    prose. An empty table gives no row.
    """
    rows = numbered(pages, ["page_id", "url", "html"])
    outlined = rows.select("row", "url", "html").mapInArrow(
        _outlined, "row bigint, url string, keys array<bigint>, sizes array<int>, open array<boolean>"
    )
    host, path = url_parts(F.col("url"))
    held = cut_lineage(outlined.select("row", host.alias("host"), path.alias("path"), "keys", "sizes", "open"))
    named = held.where("host <> ''").select("row", "host", "path", F.lit(1).alias("_one"))
    placed = running_total(named, [F.col("host"), F.col("path"), F.col("row")], "_one", "at").select("row", "host", "at")
    placed = cut_lineage(placed)
    nxt = placed.select(F.col("row").alias("row2"), F.col("host").alias("host2"), (F.col("at") - 1).alias("at"))
    pairs = placed.join(nxt, "at").where("host = host2").select("row", "row2")
    fields = ("keys", "sizes", "open")
    pairs = pairs.join(held.select("row", *fields), "row").join(
        held.select(F.col("row").alias("row2"), *[F.col(c).alias(f"{c}2") for c in fields]), "row2"
    )
    gone = pairs.select("row", *fields, "row2", *[f"{c}2" for c in fields]).mapInArrow(_shared, "row bigint, gone array<int>")
    gone = cut_lineage(gone.groupBy("row").agg(F.flatten(F.collect_list("gone")).alias("gone")))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for page, deleted in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                made = blocks(page)
                inside = any(x[1] for x in made)
                deleted = set(deleted or ())
                out.append("\n".join(t for k, (t, a, _) in enumerate(made) if (a or not inside) and k not in deleted))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    joined = rows.join(bounded_broadcast(gone), "row", "left").select("page_id", "url", "html", "gone")
    return joined.mapInArrow(texts, f"page_id {kind}, url string, text string, n_chars bigint")
