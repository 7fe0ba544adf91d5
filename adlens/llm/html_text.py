"""Main text of HTML pages by nearest-URL page differencing (operator 1).

Every page becomes text lines (one per block element) with a zone each: *junk* (inside a
menu, header, footer, sidebar, notice, advert, form or comment element), *article*
(inside the page's content element) or *open*. Within a host, pages are ordered by URL
path, and each page is paired with the neighbour that shares the longer path prefix.
The lines of the two pages are aligned by their longest common subsequence; lines that
both share belong to the host's template and are deleted.

What the alignment may not delete: lines of the content element (an article that quotes
a passage other pages quote too must stay whole), and the open lines of a page whose
pair is a copy (80 % or more of the open text is shared), where sharing says nothing about
templates. Pairs are made from (host, path) keys alone; only line hashes are shuffled to
the partner, so a host with a third of all pages is spread over as many range partitions
as it needs.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import partitions, staged

OPEN, JUNK, ARTICLE = 0, 1, 2
COPY = 0.8

# Element names of the HTML standard by their role in a page.
RAW = {"script", "style", "template", "noscript", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "select", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
JUNK_TAGS = {"nav", "aside", "footer", "form", "button", "menu", "dialog", "fieldset", "head"}
JUNK_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
# Words in class names and ids that mark what is not the article.
JUNK_WORDS = {
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "masthead", "banner", "footer", "copyright", "colophon", "topbar",
    "sidebar", "aside", "widget", "widgets", "related", "recommended", "recommendations", "trending", "promo", "promotion", "sponsor",
    "sponsored", "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "cookie", "cookies", "consent", "gdpr",
    "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing",
    "social", "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "discussion", "search", "searchbox", "pagination", "pager", "toolbar",
    "skip", "disclaimer", "paywall"}
HEADER_WORDS = {"header", "head"}
COMMENT_WORDS = {"comment", "comments", "reply", "replies", "discussion", "respond", "disqus", "commentlist"}
CONTENT_TAGS = {"article", "main"}
CONTENT_NAMES = {"articlebody", "article-body", "article_body", "article-content", "post-content", "post-body", "entry-content", "story-body", "main-content", "maincontent", "content", "article", "post", "story", "main"}

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACES = re.compile(r"\s+")


def _zone(tag: str, raw: str, in_article: bool) -> int:
    """OPEN, JUNK or ARTICLE for an element by its name and attributes."""
    if tag in JUNK_TAGS or (tag == "header" and not in_article):
        return JUNK
    content = tag in CONTENT_TAGS
    if raw and not raw.isspace():
        for m in _ATTR.finditer(raw):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                return JUNK
            if name == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    return JUNK
            elif name == "role":
                if value.lower() in JUNK_ROLES:
                    return JUNK
                content = content or value.lower() in ("main", "article")
            elif name == "itemprop":
                content = content or value.lower() == "articlebody"
            elif name in ("class", "id") and tag not in ("body", "html"):
                for one in value.split():
                    if one.lower() in CONTENT_NAMES:
                        content = True
                        continue
                    words = {w.lower() for w in _WORDS.findall(one)}
                    if words & COMMENT_WORDS:
                        return JUNK
                    if words & {"has", "with", "no"} or tag in CONTENT_TAGS:
                        continue
                    if words & JUNK_WORDS or (words & HEADER_WORDS and not in_article and not words & {"article", "entry", "post", "content"}):
                        return JUNK
    return ARTICLE if content else OPEN


def text_lines(page: str | None) -> list[tuple[str, int]]:
    """(text, zone) of every block of a page, in page order; blocks without text are left out.

    Character references are decoded after markup is gone; white space inside a block is
    one space. Unclosed and misnested elements end with the nearest open parent; a null or
    empty page has no lines.
    """
    if not page:
        return []
    lines: list[tuple[str, int, int]] = []
    stack: list[tuple[str, int, int]] = []  # (element, zone in force, number of its content element)
    zone, part, parts = OPEN, 0, 0
    held: list[str] = []
    links = [0, 0]  # letters inside links, open links

    def flush() -> None:
        if held:
            text = _SPACES.sub(" ", entities.unescape("".join(held))).strip()
            if text:
                own = zone
                if own == OPEN and links[0] > 0.6 * len(text):
                    own = JUNK  # a block that is mostly links is a menu
                lines.append((text, own, part))
            held.clear()
        links[0] = 0

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        chunk = page[at:m.start() if m else size]
        if chunk:
            held.append(chunk)
            if links[1]:
                links[0] += len(chunk.strip())
        if not m:
            break
        at = m.end() if m.end() > m.start() else m.start() + 1
        tag = (m[2] or "").lower()
        if not tag:
            continue  # comment, doctype or processing instruction
        if m[1]:
            if tag == "a":
                links[1] = max(0, links[1] - 1)
            if tag in INLINE and all(e != tag for e, _, _ in stack):
                continue  # only hidden inline elements, and their kind inside them, are on the stack
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    zone, part = (stack[-1][1], stack[-1][2]) if stack else (OPEN, 0)
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "a":
            links[1] += 1
        if tag in INLINE and all(e != tag for e, _, _ in stack):
            if "hidden" not in m[3] or _zone(tag, m[3], zone == ARTICLE) != JUNK:
                continue
        flush()
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):  # these close an open one of their kind
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    zone, part = (stack[-1][1], stack[-1][2]) if stack else (OPEN, 0)
                    break
                if stack[i][0] not in ("p", "td", "th", "dt", "dd", "li"):
                    break
        own = _zone(tag, m[3], zone == ARTICLE)
        if zone == JUNK or own == JUNK:
            own = JUNK
        elif own == ARTICLE or zone == ARTICLE:
            if zone != ARTICLE:
                parts += 1
                part = parts
            own = ARTICLE
        stack.append((tag, own, part))
        zone = own
    flush()
    # The content element with the most text is the article, with others of at least half its
    # text. Shorter ones (teasers) and lines outside go if the article holds most of the text
    # that is not junk; otherwise the names say too little, and the page difference decides.
    weight: dict[int, int] = {}
    for text, z, p in lines:
        if z == ARTICLE:
            weight[p] = weight.get(p, 0) + len(text)
    most = max(weight.values(), default=0)
    large = sum(w for w in weight.values() if 2 * w >= most)
    if 2 * large > sum(len(text) for text, z, _ in lines if z != JUNK):
        return [(t, JUNK if (z == ARTICLE and 2 * weight[p] < most) or z == OPEN else z) for t, z, p in lines]
    return [(t, OPEN if z == ARTICLE else z) for t, z, _ in lines]


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of ``a`` and ``b``.

    Rows of the dynamic programme are bit vectors (whole numbers); pairs too long to keep
    all rows are split in half at an optimal place (Hirschberg).
    """
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    ha, hb = len(a), len(b)
    while ha > lo and hb > lo and a[ha - 1] == b[hb - 1]:
        ha, hb = ha - 1, hb - 1
    middle = _aligned(a[lo:ha], b[lo:hb], 1 << 26)
    return [*range(lo), *(lo + i for i in middle), *range(ha, len(a))]


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _aligned(a: list[int], b: list[int], bits: int) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > bits and len(a) > 1:
        half = len(a) // 2
        top = bottom = (1 << len(b)) - 1
        for top in _rows(a[:half], b):
            pass
        for bottom in _rows(a[:half - 1:-1], b[::-1]):
            pass
        n = len(b)
        # zeros of top below j + zeros of bottom below n - j, largest
        up, down = [0] * (n + 1), [0] * (n + 1)
        for j in range(n):
            up[j + 1] = up[j] + (not top >> j & 1)
            down[j + 1] = down[j] + (not bottom >> j & 1)
        cut = max(range(n + 1), key=lambda j: up[j] + down[n - j])
        return _aligned(a[:half], b[:cut], bits) + [half + i for i in _aligned(a[half:], b[cut:], bits)]
    rows = list(_rows(a, b))
    i, j, out = len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append(i)
    return out[::-1]


def main_text(lines: list[str], zones: list[int], shared: set[int]) -> str:
    """Article text of a page given its lines and which of them its partner shares."""
    open_text = sum(len(t) for t, z in zip(lines, zones) if z == OPEN)
    open_shared = sum(len(t) for i, (t, z) in enumerate(zip(lines, zones)) if z == OPEN and i in shared)
    copy = open_shared >= COPY * open_text
    return " ".join(t for i, (t, z) in enumerate(zip(lines, zones))
                    if z == ARTICLE or (z == OPEN and (copy or i not in shared)))


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path with query) of a URL; without a scheme the text up to the first slash is the host."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://|#.*$", "")
    return F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), F.regexp_extract(rest, r"^[^/?]*(.*)$", 1)


def partners(keys: DataFrame) -> DataFrame:
    """(rid, partner) for rows (rid, host, path): the neighbour in (host, path, rid) order,
    within the host, with the longer common path prefix; the earlier one on a tie; null on
    a host with one page."""
    n = partitions(keys.sparkSession)
    placed = staged(keys.repartitionByRange(n, "host", "path", "rid").withColumn("part", F.spark_partition_id()), "url-order")
    me = F.struct("host", "path", "rid")
    inside = Window.partitionBy("part").orderBy("host", "path", "rid")
    ends = placed.groupBy("part").agg(F.min(me).alias("first"), F.max(me).alias("last"))
    across = Window.orderBy("part")  # one row per range partition
    ends = ends.select("part", F.lag("last").over(across).alias("before"), F.lead("first").over(across).alias("after"))
    near = (placed.withColumn("prev", F.lag(me).over(inside)).withColumn("next", F.lead(me).over(inside))
            .join(ends, "part")
            .withColumn("prev", F.coalesce("prev", "before")).withColumn("next", F.coalesce("next", "after")))

    def prefix(other: Column) -> Column:
        a, b = F.split("path", "[/?&]"), F.split(other["path"], "[/?&]")
        both = F.least(F.size(a), F.size(b))
        alike = F.size(F.filter(F.sequence(F.lit(1), both), lambda k: F.slice(a, F.lit(1), k) == F.slice(b, F.lit(1), k)))
        return F.when(other["host"] == F.col("host"), alike).otherwise(F.lit(-1))

    ahead, behind = F.coalesce(prefix(F.col("prev")), F.lit(-1)), F.coalesce(prefix(F.col("next")), F.lit(-1))
    return near.select("rid", F.when((ahead >= behind) & (ahead >= 0), F.col("prev.rid")).when(behind >= 0, F.col("next.rid")).alias("partner"))


def _row_key() -> Column:
    """A page row's identity: the same in every pass, shared by equal rows only."""
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in ("page_id", "url", "html")]))


def _parsed(pages: DataFrame, texts: bool) -> DataFrame:
    """(rid, page_id, url, hashes[, lines]) per page; ``lines``: the zones and, but for junk,
    the texts of all lines, zstandard-compressed for the one shuffle they take."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            rows = [text_lines(h) for h in b["html"].tolist()]
            out = b.drop(columns="html").assign(hashes=[
                [xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) - (1 << 63) for t, _ in r] for r in rows])
            if texts:
                out["lines"] = [pack(json.dumps([[z, "" if z == JUNK else t] for t, z in r]).encode()) for r in rows]
            yield out

    raw = pages.select(_row_key().alias("rid"), F.col("page_id").cast("string").alias("page_id"), "url", "html")
    return raw.mapInPandas(run, "rid string, page_id string, url string, hashes array<long>" + (", lines binary" if texts else ""))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_lines, n_shared) per row of ``pages`` (page_id, url, html).

    A null html gives an empty text; pages without a URL form a host of their own; rows
    that share a URL or a page_id are rows of their own, but equal rows count as one page
    when partners are chosen; extra columns are not carried; an empty table gives no rows.

    Pages are parsed twice: for keys and line hashes, which are small and choose the
    partners, and for the texts, which are shuffled once, compressed, and never stored.
    """
    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for page, url, own, packed, other in zip(b["page_id"], b["url"], b["hashes"], b["lines"], b["other"]):
                lines = json.loads(unpack(packed))
                own, other = list(own), None if other is None else list(other)
                shared = set() if other is None else set(common_lines(own, other))
                text = main_text([t for _, t in lines], [z for z, _ in lines], shared)
                out.append((page, url, text, len(text), len(lines), len(shared)))
            yield pd.DataFrame(out, columns=["page_id", "url", "text", "n_chars", "n_lines", "n_shared"])

    keys = staged(_parsed(pages, texts=False).dropDuplicates(["rid"]).select("rid", "url", "hashes"), "line-hashes")
    host, path = split_url(F.col("url"))
    pair = partners(keys.select("rid", host.alias("host"), path.alias("path")))
    other = (pair.filter("partner is not null").join(keys.select(F.col("rid").alias("partner"), F.col("hashes").alias("other")), "partner")
             .select("rid", "other"))
    out = (_parsed(pages, texts=True).join(other, "rid", "left").select("page_id", "url", "hashes", "lines", "other")
           .mapInPandas(finish, "page_id string, url string, text string, n_chars long, n_lines long, n_shared long"))
    return out.withColumn("page_id", F.col("page_id").cast("long"))
