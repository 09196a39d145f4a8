"""Main text of web pages: structure first, then a suffix array over each host's pages.

A page is read as blocks of text, each with the part of the page it stands in:
``OUT`` (menus, headers, footers, sidebars, notices, adverts, forms, comments),
``MAIN`` (inside ``article`` or ``main``) or ``OPEN`` (neither).  The token
streams of a host's pages are concatenated and sorted in a suffix array; runs of
tokens that neighbouring suffixes share are the host's template if enough
distinct pages hold them, and what they cover is removed.  The unique runs stay.
Pages of a host with the same blocks are one page here, however many rows they are.

Suffix arrays are over shards of about ``SHARD_PAGES`` pages of a host, chosen by
a hash of the page, so a host with a third of all pages is many small groups.
The pages that hold a run are counted over the whole host: a run on a share of
the host's pages is on that share of some shard's pages, so the runs that are
frequent in a shard are the only ones to sum over all shards, by their hash.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import bounded, small
from tessera.session import checkpoint, scratch_path

SHARD_PAGES = 128           # pages of a host in one suffix array
SHARD_CHARS = 2_000_000     # and their characters
MIN_RUN = 8                 # tokens a template run has at least
OPEN_SHARE, OPEN_PAGES = 0.2, 3       # of a host's pages: a run outside the article is template
MAIN_SHARE, MAIN_PAGES = 0.8, 8       # a whole block inside the article is
RUN_ROWS = 100_000          # runs handed over at once
LINK_SHARE = 0.6            # an open block with more of its characters in links is a menu

MIX = np.uint64(0x9E3779B97F4A7C15)

OUT, OPEN, MAIN = 0, 1, 2
LINKS = 3                   # an open block that is a menu

# Names from HTML and common use.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg"}
OUT_TAGS = RAW | {"head", "nav", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section",
          "select", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"}
OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
OUT_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner",
             "sidebar", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "header",
             "masthead", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "comment", "comments", "reply",
             "replies", "disqus", "share", "sharing", "social", "related", "newsletter", "subscribe", "popup", "modal",
             "overlay", "login", "signup", "search", "widget", "toolbar", "pagination", "pager", "copyright"}
# words that a part's name has beside those
PART_WORDS = {"area", "bar", "block", "box", "button", "buttons", "container", "content", "form", "icons", "inner", "item", "items",
              "left", "link", "links", "list", "main", "outer", "panel", "posts", "right", "section", "slot", "thread", "top", "wrap",
              "wrapper", "bottom", "site", "page", "user", "reader"}
# elements that hold parts of an article; its headings, paragraphs and lists are never put aside by a name
HOLDERS = {"div", "section", "aside", "table", "figure", "details", "blockquote", "center", "fieldset", "span"}
COMMENT_IDS = {"comments", "comment-section", "disqus_thread", "respond", "reader-comments"}
# ... and of the words above, the ones that also end an article's own element
OUT_ARTICLES = {"ad", "ads", "advert", "advertisement", "sponsored", "comment", "comments", "reply", "replies",
                "related", "teaser", "promo"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORD = re.compile(r"[a-z0-9]+")


def _zone(name: str, attrs: str, around: int) -> int:
    """The part of the page that an element opens inside a part ``around``."""
    if around == OUT or name in OUT_TAGS:
        return OUT
    if not attrs and name not in ("header", "article", "main"):
        return around
    values = {k.lower(): v.strip("\"'").lower() for k, v in _ATTR.findall(attrs)} if attrs.strip() else {}
    if "hidden" in values or values.get("aria-hidden") == "true":
        return OUT
    if name == "header":
        return around if around == MAIN else OUT
    if values.get("role") in OUT_ROLES:
        return OUT
    if name in ("article", "main") or values.get("role") == "main":
        words = set(_WORD.findall(values.get("class", "") + " " + values.get("id", "")))
        return OUT if words & OUT_ARTICLES else MAIN
    if name in ("html", "body"):
        return around
    if around == MAIN:      # an id names what a part of the text is about
        named = name in HOLDERS and (any(map(_names_a_part, values.get("class", "").split())) or values.get("id") in COMMENT_IDS)
    else:
        named = any(map(_names_a_part, (values.get("class", "") + " " + values.get("id", "")).split()))
    return OUT if named else around


@lru_cache(maxsize=10_000)
def _names_a_part(token: str) -> bool:
    """Whether a class or id names a part beside the text: one of OUT_WORDS
    alone, or with others of these and PART_WORDS (``comments-area``, but not
    ``comments-on-the-war``)."""
    words = _WORD.findall(token)
    return any(w in OUT_WORDS for w in words) and all(w in OUT_WORDS or w in PART_WORDS or w.isdigit() for w in words)


def blocks(page: str | None, by_class: bool = True) -> list[tuple[int, str, float]]:
    """``(zone, text, share of characters in links)`` of the blocks of a whole
    page in order: references decoded, white space as one space, none empty.
    ``by_class=False`` goes by the elements' names alone."""
    page = page or ""
    lower = page.lower()
    found: list[tuple[int, str, float]] = []
    stack: list[tuple[str, int]] = []
    zone, links = OPEN, 0
    text: list[str] = []
    linked = 0

    def close():
        nonlocal text, linked
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                found.append((zone, whole, linked / max(1, sum(map(len, text)))))
        text, linked = [], 0

    def add(raw: str):
        nonlocal linked
        if raw:
            text.append(html.unescape(raw) if "&" in raw else raw)
            if links:
                linked += len(text[-1])

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name in BLOCKS:
            close()
        elif name in ("td", "th"):
            text.append(" ")
        if m["end"]:
            if any(n == name for n, _ in stack):
                close_to = max(i for i, (n, _) in enumerate(stack) if n == name)
                if zone != (outer := stack[close_to][1]):
                    close()
                links -= sum(n == "a" for n, _ in stack[close_to:])
                del stack[close_to:]
                zone = outer
            continue
        if name in VOID:
            continue
        if name in RAW:         # no markup inside
            close()
            end = lower.find(f"</{name}", at)
            at = len(page) if end < 0 else end
            if end >= 0:
                stack.append((name, zone))
                zone = OUT
            continue
        if name in ("p", "li", "a", "option", "dt", "dd") and stack:      # these end an open one of their kind
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    links -= sum(n == "a" for n, _ in stack[i:])
                    zone = stack[i][1]
                    del stack[i:]
                    break
                if stack[i][0] in BLOCKS and stack[i][0] not in ("p",):
                    break
        inner = _zone(name, m["attrs"] or "" if by_class else "", zone)
        if inner != zone:
            close()
        stack.append((name, zone))
        zone = inner
        links += name == "a"
    close()
    return found


# ---------------------------------------------------------------- suffix array


def suffix_order(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``(order, rank)``: suffixes sorted by their first ``depth`` tokens, by
    prefix doubling; equal beginnings have equal ranks.  ``tokens`` are numbers from 0."""
    rank, width = tokens, 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        step = min(width, depth - width)
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-step] = rank[step:] + 1
        key = rank * (int(ahead.max(initial=0)) + 1) + ahead
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        width += step
    return order, rank


def pages_per_run(tokens: np.ndarray, page: np.ndarray, run: int) -> np.ndarray:
    """For every position the number of distinct pages that hold the ``run``
    tokens that begin there (0 where they reach into the next page)."""
    if len(tokens) < run:
        return np.zeros(len(tokens), np.int64)
    # a mark of its own ends every page, so no run that crosses it equals another
    ends = np.flatnonzero(page[1:] != page[:-1]) + 1
    marked = np.insert(tokens, ends, int(tokens.max()) + 1 + np.arange(len(ends)))
    of_page = np.insert(page, ends, page[ends - 1])
    order, rank = suffix_order(marked, run)
    sorted_rank, sorted_page = rank[order], of_page[order]       # stable: pages rise within equal suffixes
    first = np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1]))
    new_page = first | np.concatenate(([True], sorted_page[1:] != sorted_page[:-1]))
    counts = np.add.reduceat(new_page.astype(np.int64), np.flatnonzero(first))
    out = np.empty(len(marked), np.int64)
    out[order] = counts[np.cumsum(first) - 1]
    out = np.delete(out, ends + np.arange(len(ends)))
    inside = np.zeros(len(tokens), bool)
    inside[:len(tokens) - run + 1] = page[:len(tokens) - run + 1] == page[run - 1:]
    return np.where(inside, out, 0)


def covered(counts: np.ndarray, least: float, run: int) -> np.ndarray:
    """Positions inside a run that at least ``least`` pages hold."""
    hit = np.zeros(len(counts) + run, np.int64)
    at = np.flatnonzero(counts >= least)
    np.add.at(hit, at, 1)
    np.add.at(hit, at + run, -1)
    return hit.cumsum()[:len(counts)] > 0


def _unique(template: np.ndarray) -> np.ndarray:
    """Positions of a block that stay: none if the template covers it whole,
    else all outside its stretches of at least MIN_RUN tokens; a shorter stretch
    is where a run from the next block ends by chance."""
    if template.all():
        return np.empty(0, np.int64)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], template, [False])).astype(np.int8)))
    keep = np.ones(len(template), bool)
    for a, b in zip(edge[0::2], edge[1::2]):
        if b - a >= MIN_RUN:
            keep[a:b] = False
    return np.flatnonzero(keep)


def layout(page: str | None) -> tuple[bytes, str]:
    """A page's blocks: a byte per block for its zone, and the texts joined by line feeds."""
    found = blocks(page)
    if all(z == OUT for z, _, _ in found):      # a page that its classes put aside as a whole, as where they name the layout
        found = blocks(page, by_class=False)
    return (bytes(LINKS if z == OPEN and linked > LINK_SHARE else z for z, _, linked in found),
            "\n".join([text for _, text, _ in found]))


def page_key(page: tuple[bytes, str]) -> bytes:
    """Digest of a page's blocks."""
    zones, text = page
    return xxhash.xxh3_128_digest(len(zones).to_bytes(8, "big") + zones + text.encode("utf-8", "surrogatepass"))


class Streams:
    """Token streams of distinct pages of one host."""

    def __init__(self, pages: list[tuple[bytes, str]]):
        self.pages = pages
        self.words = [[b.split(" ") for b in text.split("\n")] if zones else [] for zones, text in pages]
        known: dict[str, int] = {}
        self.tokens = np.array([known.setdefault(w, len(known)) for page in self.words for b in page for w in b], np.int64)
        self.page = np.repeat(np.arange(len(pages)), [sum(map(len, page)) for page in self.words])
        self.known = known
        self._runs: tuple | None = None

    def counts(self) -> np.ndarray:
        return pages_per_run(self.tokens, self.page, MIN_RUN)

    def runs(self, host: str) -> tuple[np.ndarray, np.ndarray]:
        """``(position, hash)`` of every run, the hash one of the host and the run's words; kept for the next call."""
        if self._runs is None or self._runs[0] != host:
            self._runs = host, self._hashed(host)
        return self._runs[1]

    def _hashed(self, host: str) -> tuple[np.ndarray, np.ndarray]:
        starts = max(0, len(self.tokens) - MIN_RUN + 1)
        of_word = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in self.known], np.uint64)
        keys = np.full(starts, xxhash.xxh3_64_intdigest(host.encode("utf-8", "surrogatepass")), np.uint64)
        for k in range(MIN_RUN if starts else 0):
            keys = keys * MIX + of_word[self.tokens[k:k + starts]]
        at = np.flatnonzero(self.page[:starts] == self.page[MIN_RUN - 1:]) if starts else np.empty(0, np.int64)
        return at, keys[at].view(np.int64)

    def listed(self, host: str, runs: np.ndarray) -> np.ndarray:
        """1 where a run of the sorted ``runs`` begins, else 0."""
        out = np.zeros(len(self.tokens), np.int64)
        if len(runs):
            at, keys = self.runs(host)
            out[at] = runs[np.minimum(np.searchsorted(runs, keys), len(runs) - 1)] == keys
        return out

    def texts(self, template: np.ndarray, always: np.ndarray) -> list[str]:
        """Main text of each page, given the positions under template runs and
        under those of nearly all pages."""
        out, at = [], 0
        for (zones, _), page_words in zip(self.pages, self.words):
            spans = []
            for ws in page_words:
                spans.append(slice(at, at + len(ws)))
                at += len(ws)
            main = [" ".join(ws) if zone == MAIN and not always[span].all() else None
                    for zone, ws, span in zip(zones, page_words, spans)]
            kept = [t for t in main if t]
            if OPEN in zones:
                open_ = [" ".join([ws[i] for i in _unique(template[span])]) if zone == OPEN else None
                         for zone, ws, span in zip(zones, page_words, spans)]
                # beside an article only where the unique runs outweigh it: the article is a teaser then
                if MAIN not in zones or sum(len(t) for t in open_ if t) > sum(map(len, kept)):
                    kept = [t for pair in zip(main, open_) for t in pair if t]
            out.append("\n".join(kept))
        return out


def host_texts(pages: list[tuple[bytes, str]]) -> list[str]:
    """Main text of each of a host's pages, which are distinct and in one shard."""
    streams = Streams(pages)
    counts = streams.counts()
    return streams.texts(covered(counts, max(OPEN_PAGES, OPEN_SHARE * len(pages)), MIN_RUN),
                         covered(counts, max(MAIN_PAGES, MAIN_SHARE * len(pages)), MIN_RUN))


def main_texts(pages: list[str | None]) -> list[str]:
    """Main text of each of a host's pages; equal ones are one page."""
    read = [layout(p) for p in pages]
    distinct = list(dict.fromkeys(read))
    texts = dict(zip(distinct, host_texts(distinct)))
    return [texts[p] for p in read]


def _packed(page: tuple[bytes, str]) -> bytes:
    zones, text = page
    raw = len(zones).to_bytes(8, "big") + zones + text.encode("utf-8", "surrogatepass")
    return len(raw).to_bytes(8, "big") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(packed: bytes) -> tuple[bytes, str]:
    raw = pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "big"), codec="zstd", asbytes=True)
    n = 8 + int.from_bytes(raw[:8], "big")
    return raw[8:n], raw[n:].decode("utf-8", "surrogatepass")


def _read(batches):
    """``(host, key, page)``: the digest of a page's blocks and the blocks, where a task meets them first on the host."""
    seen: set[tuple[str, bytes]] = set()
    for batch in bounded(batches, "h"):
        found = []
        for host, h in zip(batch.column("host").to_pylist(), batch.column("h").to_pylist()):
            page = layout(h)
            place = host, page_key(page)
            if place not in seen:
                seen.add(place)
                found.append((*place, _packed(page)))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.binary(), pa.binary()))], ["host", "key", "page"])


def _groups(batches):
    """``(host, shards, pages)`` of each shard from rows sorted by host, shard and key; equal pages once."""
    of, last, pages = None, None, []
    for batch in batches:
        for host, shard, shards, key, page in zip(*(batch.column(c).to_pylist() for c in (
                "host", "shard", "shards", "key", "page"))):
            if (host, shard, shards) != of:
                if pages:
                    yield of[0], of[2], pages
                of, last, pages = (host, shard, shards), None, []
            if key != last:
                last = key
                pages.append(page)
    if pages:
        yield of[0], of[2], pages


COMPARED = {"host": pa.string(), "pages": pa.int64(), "page": pa.binary(), "run": pa.int64(), "n": pa.int64()}


def _compare(batches):
    """Rows of COMPARED, other columns null: ``(host, pages)`` of a shard, ``(host,
    run, n)`` for the runs on a template's share of its pages, with their number
    if the host has no other shard; if it has, its pages ``(host, page)``."""
    def rows(size, **columns):
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(size, t)
                                           for c, t in COMPARED.items()], list(COMPARED))

    for host, shards, pages in _groups(batches):
        yield rows(1, host=[host], pages=[len(pages)])
        if shards > 1:
            yield rows(len(pages), host=[host] * len(pages), page=pages)
        streams = Streams([_unpacked(p) for p in pages])
        at, runs = streams.runs(host)
        n = streams.counts()[at]
        often = n >= min(OPEN_SHARE, MAIN_SHARE) * len(pages) - 1e-9
        if shards == 1:
            often &= n >= min(OPEN_PAGES, MAIN_PAGES)
        runs, first = np.unique(runs[often], return_index=True)
        n = n[often][first]
        for k in range(0, len(runs), RUN_ROWS):
            part = slice(k, k + RUN_ROWS)
            size = len(runs[part])
            yield rows(size, host=[host] * size, run=runs[part], **({"n": n[part]} if shards == 1 else {}))


def _runs(batches):
    """Every run of every page, once a page."""
    for batch in batches:
        found, size = [], 0
        for host, page in zip(batch.column("host").to_pylist(), batch.column("page").to_pylist()):
            found.append(np.unique(Streams([_unpacked(page)]).runs(host)[1]))
            size += len(found[-1])
            if size >= RUN_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["run"])
                found, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["run"])


def _cut(batches):
    """``(i, u, text, n_chars)`` from pages with their host's runs ``template`` and ``always``, both sorted."""
    none = np.empty(0, np.int64)
    for batch in bounded(batches, "h"):
        texts = []
        lists = [batch.column(c) for c in ("template", "always")]
        for k, (host, h) in enumerate(zip(batch.column("host").to_pylist(), batch.column("h").to_pylist())):
            streams = Streams([layout(h)])
            texts += streams.texts(*(covered(streams.listed(
                host, runs[k].values.to_numpy() if runs[k].is_valid else none), 1, MIN_RUN) for runs in lists))
        yield pa.RecordBatch.from_arrays(
            [batch.column("i"), batch.column("u"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["i", "u", "text", "n_chars"])


def extract(pages: DataFrame, host: Column, *, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` per row of ``pages``.

    Blocks are joined by one line feed.  Blocks inside ``article`` or ``main``
    are the main text; a block of it goes only if template runs, on nearly all
    pages of its host, cover it whole.  Pages without such an element keep the
    unique runs of their open blocks.  A page that a host holds several times,
    block by block, counts once and gives the same text each time.  A null or
    empty page, or one without main text, has an empty text.  Pages with a null
    host are one host; repeated rows give repeated rows; an empty table gives none.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("i"), F.col(url_col).alias("u"), F.col(html_col).alias("h"),
                        F.coalesce(host, F.lit("")).alias("host"))
    id_kind = pages.schema[id_col].dataType.simpleString()
    # Copies are told by their blocks below; the number of shards needs no more than the markup.
    sizes = (rows.select("host", F.xxhash64("h").alias("k"), F.coalesce(F.length("h"), F.lit(0)).alias("c")).distinct()
             .groupBy("host").agg(F.count("*").alias("n"), F.sum("c").alias("c")))
    shards = F.greatest(F.ceil(F.col("n") / SHARD_PAGES), F.ceil(F.col("c") / SHARD_CHARS)).cast("int")
    large = checkpoint(sizes.select("host", shards.alias("shards")).where("shards > 1"))
    dealt = (rows.select("host", "h").mapInArrow(_read, "host string, key binary, page binary")
             .join(small(large), "host", "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
             .withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards")))
             .select("host", "shard", "shards", "key", "page")
             .repartition("host", "shard").sortWithinPartitions("host", "shard", "key"))

    def stored(table: DataFrame, name: str) -> DataFrame:       # as Parquet: compressed, of known size
        path = scratch_path(spark, name)
        table.write.parquet(path, compression="zstd")
        return spark.read.parquet(path)

    compared = stored(dealt.mapInArrow(_compare, "host string, pages long, page binary, run long, n long"), "html-shards")
    total = compared.where("pages is not null").groupBy("host").agg(F.sum("pages").alias("pages"))
    listed = compared.where("run is not null")
    often = checkpoint(listed.where("n is null").select("host", "run").distinct())
    split = (compared.where("page is not null").select("host", "page").mapInArrow(_runs, "run long")
             .join(small(often), "run").groupBy("host", "run").agg(F.count("*").alias("n")))
    template = F.col("n") >= F.greatest(F.lit(OPEN_PAGES), F.lit(OPEN_SHARE) * F.col("pages"))
    always = F.col("n") >= F.greatest(F.lit(MAIN_PAGES), F.lit(MAIN_SHARE) * F.col("pages"))
    # a host has no more of these than its mean page has tokens, divided by the share
    templates = stored(listed.where("n is not null").select("host", "run", "n").union(split).join(total, "host")
                       .where(template | always).groupBy("host").agg(
        F.array_sort(F.collect_list(F.when(template, F.col("run")))).alias("template"),
        F.array_sort(F.collect_list(F.when(always, F.col("run")))).alias("always")), "html-templates")
    out = rows.join(templates, "host", "left").mapInArrow(_cut, f"i {id_kind}, u string, text string, n_chars long")
    return out.select(F.col("i").alias(id_col), F.col("u").alias(url_col), "text", "n_chars")
