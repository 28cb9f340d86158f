"""Main text of web pages: blocks by their markup, and boilerplate that a host repeats.

A page is three streams of token blocks: zones whose markup names them (menus, footers, adverts, forms,
comments), what an article or main element holds, and open blocks of unknown kind. Zones are no text, but
show with the open blocks what a host repeats: the streams outside articles of every page form a suffix
array for each host. Every place's suffix is named by its first `least` tokens, by doubling (names of
1, 2, 4, ... tokens are combined from pairs), and equal names meet in one aggregation by host and name,
combined in the tasks first, so a large host is spread by its names. Every page's articles and open blocks
are then looked up among the runs that `pages` distinct pages share: tokens of open blocks covered by one are
removed, unique runs stay. What an article holds stays whole, also where other pages quote or copy it, but
covered tokens do not count when an article is told from a teaser.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.leaks import bit_map, probes
from tidewatch.settings import parked

# Elements that are no text, elements that begin a block, and words of class names, ids and
# roles that mark a zone as no part of the article.
SKIPPED = set("aside button canvas dialog footer form head iframe menu nav noscript object script select style svg template textarea title video audio".split())
RAW = set("script style textarea title noscript iframe template".split())
BLOCKS = set(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
MARKS = set(
    "ad ads adsense advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies "
    "copyright dialog disclaimer disqus feedback footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination popup promo promotion related replies search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
PLACED = set("html body main".split())
OPEN_END = set("article main".split())

#: Kinds of blocks.
ZONE, ARTICLE, OPEN = "zone", "article", "open"

_PART = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*>?|<[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass(frozen=True)
class Repeats:
    """A run of at least `least` tokens (a power of two), or a whole block, on at least `pages` pages of a host."""

    least: int = 8
    pages: int = 3

    def __post_init__(self) -> None:
        if self.least < 1 or self.least & (self.least - 1):
            raise ValueError("the length of a run is a power of two")


def marked(tag: str, attributes: str) -> bool:
    """Whether an element's class, id or role says that it is no part of the article."""
    if not attributes or tag in PLACED:
        return False
    for names in _NAMES.findall(attributes):
        for name in "".join(names).lower().split():
            words = re.split(r"[-_:]+", name)
            if words[0] not in ("has", "no", "with", "without") and words[-1] != "results" and MARKS.intersection(words):
                return True
    return False


def streams(page: str | None) -> list[tuple[str, str]]:
    """The page's text blocks in order, each with its kind: ZONE, ARTICLE or OPEN."""
    found: list[tuple[str, str]] = []
    held: list[str] = []
    inside = 0
    skip, depth = "", 0

    def close() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            found.append((text, ZONE if skip else ARTICLE if inside else OPEN))

    page = page or ""
    at = 0
    while at < len(page):
        m = _PART.match(page, at)
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if not m[0].startswith(("<!", "<?", "</")) and not re.match("<[a-zA-Z]", m[0]):
                held.append(m[0])
            continue
        ends = bool(m[1])
        if skip:
            if tag in BLOCKS or tag == skip:
                close()
            if ends and tag == skip:
                depth -= 1
            elif not ends and tag == skip and not m[3].endswith("/"):
                depth += 1
            elif not ends and tag in OPEN_END and not marked(tag, m[3]):
                depth = 0
            elif not ends and tag in RAW and (end := _ends(tag).search(page, at)):
                at = end.end()
            if depth:
                continue
            ended, skip = skip, ""
            if ended == tag and ends:
                continue
        if tag in BLOCKS:
            close()
        elif tag == "br":
            held.append(" ")
        if not ends and tag not in VOID and (tag in SKIPPED or (tag == "header" and not inside) or marked(tag, m[3])):
            if tag in RAW:
                end = _ends(tag).search(page, at)
                at = end.end() if end else len(page)
            elif not m[3].endswith("/"):
                close()
                skip, depth = tag, 1
        elif tag in OPEN_END:
            inside = max(inside + (-1 if ends else 1), 0)
    close()
    return found


@functools.cache
def _ends(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\s*>", re.I)


def blocks(page: str | None) -> list[tuple[str, bool]]:
    """The page's text blocks outside zones in order, each with whether an article or main element holds it."""
    return [(text, kind == ARTICLE) for text, kind in streams(page) if kind != ZONE]


def host_of(url: str | None) -> str:
    m = re.search(r"://([^/?#]*)", url or "")
    return m[1].lower() if m else ""


def names(tokens: list[str], least: int) -> np.ndarray:
    """A hash of the next `least` tokens for every place that has as many, by doubling."""
    name = np.frombuffer(b"".join([xxhash.xxh64_digest(token.encode()) for token in tokens]), np.uint64)
    width = 1
    while width < least and len(name) > width:
        name = (name[:-width] * np.uint64(0x9E3779B97F4A7C15)) ^ (name[width:] + np.uint64(width))
        name ^= name >> np.uint64(31)
        width *= 2
    return name if width >= least else np.zeros(0, np.uint64)


def suffixes(texts: list[str], host: str, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, and first and one past the last token of what each stands for: long runs in a block, and whole blocks."""
    sizes = np.array([text.count(" ") + 1 for text in texts], np.int64)
    ends = np.cumsum(sizes)
    runs = names(" ".join(texts).split(" ") if texts else [], least)
    at = np.arange(len(runs))
    if len(runs):
        at = at[at + least <= np.repeat(ends, sizes)[: len(runs)]]
    wholes = np.array([xxhash.xxh64_intdigest(text.encode(), seed=1) for text in texts], np.uint64)
    salt = np.uint64(xxhash.xxh64_intdigest(host.encode(), seed=2))
    starts = np.concatenate([at, ends - sizes])
    return np.concatenate([runs[at], wholes]) ^ salt, starts, np.concatenate([at + least, ends])


def weighed(found: list[tuple[str, str]], host: str, gone: np.ndarray, least: int) -> str:
    """The page's text by its blocks and the names of the runs that its host repeats outside articles.

    Open blocks lose the tokens such runs cover. An article keeps all of its tokens, but only those that no run
    covers count for it: if they are fewer than the open tokens left, it is taken for a teaser, and the text is
    both, in page order; else it is the article.
    """
    inner = [(text, kind) for text, kind in found if kind != ZONE]
    return left_of(inner, suffixes([text for text, _ in inner], host, least) if len(gone) else None, gone)


def left_of(inner: list[tuple[str, str]], spans: tuple[np.ndarray, np.ndarray, np.ndarray] | None, gone: np.ndarray) -> str:
    """The text that `weighed` tells of, by the names and edges of all runs that may be gone."""
    edges = np.zeros(sum(text.count(" ") + 1 for text, _ in inner) + 1, np.int64)
    if len(gone):
        own, begins, ends = spans
        hit = np.isin(own, gone)
        np.add.at(edges, begins[hit], 1)
        np.add.at(edges, ends[hit], -1)
    covered = np.cumsum(edges)[:-1] > 0
    size, left, at = {ARTICLE: 0, OPEN: 0}, [], 0
    for text, kind in inner:
        own = covered[at : at + text.count(" ") + 1]
        at += len(own)
        hidden = int(np.count_nonzero(own))
        size[kind] += len(own) - hidden
        if hidden and kind == OPEN:
            text = " ".join([t for t, c in zip(text.split(" "), own.tolist()) if not c])
        left.append((text, kind))
    return "\n\n".join(text for text, kind in left if text and (kind == ARTICLE or size[ARTICLE] < size[OPEN]))


def extract(pages: DataFrame, repeats: Repeats = Repeats()) -> DataFrame:
    """page_id, url and text of every page: its blocks joined by two line feeds.

    A null or empty page has no text; equal pages are distinct if their ids or URLs differ, and repeated
    rows all stay. Every page goes the same way: the streams outside articles are named and counted by host; then
    the names of all its open blocks and articles are joined with those that the host repeats, and `weighed`
    decides. A bit map of the repeated names, of fixed size, keeps names that no host repeats out of the join.
    """
    read = "page_id long, url string, host string, texts array<string>, kinds array<string>, row binary"

    def parse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary())
        for part in parts:
            rows = []
            for page, url, source in zip(*(part.column(i).to_pylist() for i in range(3))):
                found = streams(source)
                row = xxhash.xxh3_128_digest(repr((page, url, source is None)).encode() + (source or "").encode())
                rows.append((page, url, host_of(url), [text for text, _ in found], [kind for _, kind in found], row))
            if rows:
                yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["page_id", "url", "host", "texts", "kinds", "row"])

    kept = parked(pages.select("page_id", "url", "html").mapInArrow(parse, read))

    def outside(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """host and name of every run outside articles, once a page."""
        for part in parts:
            for host, texts in zip(*(part.column(i).to_pylist() for i in range(2))):
                own = np.unique(suffixes(texts, host, repeats.least)[0]).view(np.int64)
                yield pa.record_batch([pa.array([host] * len(own), pa.string()), pa.array(own)], ["host", "name"])

    shown = "transform(filter(arrays_zip(texts, kinds), b -> b.kinds <> '%s'), b -> b.texts) AS texts" % ARTICLE
    named = kept.selectExpr("host", shown, "md5(to_json(struct(page_id, url))) AS key").where("size(texts) > 0").dropDuplicates(["key"])
    counted = named.select("host", "texts").mapInArrow(outside, "host string, name long").groupBy("host", "name").agg(F.count("*").alias("n"))
    common = parked(counted.where(F.col("n") >= repeats.pages).select("host", "name"))
    shared = pages.sparkSession.sparkContext.broadcast(bit_map(common.select(F.col("name").alias("gram"))))

    def look_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Open blocks and articles of every page, with the names the bit map lets through, and with their edges (all names, then all begins, then all ends)."""
        marked = np.frombuffer(shared.value, np.uint8)
        for part in parts:
            rows = []
            for host, texts, kinds in zip(*(part.column(name).to_pylist() for name in ("host", "texts", "kinds"))):
                inner = [i for i, kind in enumerate(kinds) if kind != ZONE]
                texts = [texts[i] for i in inner]
                own, begins, ends = suffixes(texts, host, repeats.least)
                hit = np.ones(len(own), bool)
                for p in probes(own):
                    hit &= (marked[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                places = np.concatenate([own[hit].view(np.int64), begins[hit], ends[hit]])
                rows.append((texts, [kinds[i] for i in inner], np.unique(own[hit]).view(np.int64), places))
            if rows:
                types = (pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()))
                found = [pa.array(x, k) for x, k in zip(zip(*rows), types)]
                kept_as = [part.column(name) for name in ("page_id", "url", "host", "row")]
                yield pa.record_batch([*kept_as, *found], ["page_id", "url", "host", "row", "texts", "kinds", "hits", "places"])

    looked = kept.mapInArrow(look_up, "page_id long, url string, host string, row binary, texts array<string>, kinds array<string>, hits array<long>, places array<long>")
    # Pages with hits are written, so that the others, most of them, are looked up once more and these not twice.
    hit_pages = parked(looked.where("size(hits) > 0"))
    asked = hit_pages.select("row", "host", F.explode("hits").alias("name"))
    covered = asked.join(common, ["host", "name"]).groupBy("row").agg(F.collect_set("name").alias("names"))

    def weigh(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            done = []
            for texts, kinds, places, gone in zip(*(part.column(i).to_pylist() for i in range(2, 6))):
                spans = tuple(np.array(places, np.int64).reshape(3, -1))
                done.append(left_of(list(zip(texts, kinds)), spans, np.array(gone or [], np.int64)))
            yield pa.record_batch([part.column(0), part.column(1), pa.array(done, pa.string())], ["page_id", "url", "text"])

    shape = ("page_id", "url", "texts", "kinds", "places", "names")
    met = hit_pages.drop("hits").join(covered, "row", "left").select(*shape)
    unmet = looked.where("size(hits) = 0").withColumn("names", F.expr("CAST(NULL AS ARRAY<BIGINT>)")).select(*shape)
    return met.unionByName(unmet).mapInArrow(weigh, "page_id long, url string, text string")
