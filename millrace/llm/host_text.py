"""Main text of web pages, with a suffix array for each host.

A page is read as blocks in page order, each with what the markup says of it: in
the article (``article``; else ``main`` and the like), furniture (``nav``,
``footer``, ``div class="ad"`` ...), or nothing. The words outside the article
make the page's token stream. The streams of a host are concatenated, their
suffixes sorted by their first ``RUN`` words (prefix doubling), and sequences
that are on enough distinct pages are boilerplate, as are all longer runs, which
consist of them. A page that declares an article has that as its text whole:
copies and shared passages in it are no boilerplate. On any other page unmarked
blocks stay unless half of their words are covered by boilerplate; a page on
which all is covered is a copy and keeps its unmarked blocks.

The pages of a big host are dealt into groups of about ``GROUP`` pages. A
sequence on T of the host's P pages is on T p / P of the p pages of some group,
so each group is mined at that share, and the sequences found are then counted
in all groups of the host. A group's suffixes are the largest thing in a task.
"""

from __future__ import annotations

import html as references
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import small
from millrace.llm.hosts import parts_of
from millrace.session import staged

#: Words of a sequence; distinct pages it must be on: so many, and this share of the host's.
RUN, LEAST_PAGES, SHARE = 6, 3, 0.1
#: Pages of a host from which it is dealt into groups, and pages of a group.
GROUP = 4_096

#: Most hosts and sequences of boilerplate that are sent to all tasks instead of dealing the pages out by host.
BROADCAST_SEQUENCES = 250_000

# What elements and names of classes mean.
RAW = {"script", "style", "iframe", "noembed", "noframes", "xmp", "textarea", "title"}
UNSEEN = {"script", "style"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small",
    "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
FURNITURE = {"head", "nav", "footer", "aside", "noscript", "template", "button", "select", "svg", "menu", "dialog", "object", "canvas", "audio", "video", "datalist", "math"}
LOOSE = {"form", "header"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BARRIERS = {"article", "main", "section", "nav", "footer", "aside", "header", "form", "table", "td", "body"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSED_IN = {"ul", "ol", "dl", "table", "select", "menu"} | BARRIERS
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "menu", "menubar", "toolbar", "alert"}
NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
    "footer", "masthead", "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "newsletter", "subscribe",
    "signup", "login", "share", "sharing", "social", "related", "recommended", "popup", "pagination", "pager", "copyright", "disclaimer", "skip", "hidden",
}
LOOSE_NAMES = {"banner", "widget", "modal", "overlay", "toolbar", "page-header", "site-header", "header"}
NOT_BY_NAME = {"html", "body", "main", "article"}
STATES = {"has", "with", "no", "without", "is", "not", "show", "hide", "js"}
BODIES = {"article", "article-body", "article-content", "post-content", "post-body", "entry-content", "story-body", "main-content"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|style|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|\Z)""", re.I)
_GONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

ARTICLE, BODY, UNMARKED, LOOSELY, FURNISHED = 4, 3, 2, 1, 0


def _by_name(words: str) -> int | None:
    """What the classes or the id say: furniture, loosely so, or nothing."""
    said = None
    for name in words.lower().split():
        parts = re.split(r"[-_]+", name)
        if parts[0] in STATES:
            continue
        if NAMES.intersection((parts[0], parts[-1])):
            return FURNISHED
        if name in LOOSE_NAMES or parts[-1] in LOOSE_NAMES - {"header"}:
            said = LOOSELY
    return said


def _kind(name: str, attributes: str, above: int) -> int:
    """What a block in this element is, given what it would be outside."""
    if above == FURNISHED or name in FURNITURE:
        return FURNISHED
    own, said = above, None
    named = dict.fromkeys(("class", "id", "role", "itemprop"), "")
    if attributes and not attributes.isspace():
        for key, *value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(value)
            if key == "hidden" or (key == "style" and _GONE.search(value)):
                return FURNISHED
            named[key] = value
        if named["role"].lower() in ROLES:
            return FURNISHED
        if name not in NOT_BY_NAME or named["class"].lower().split()[:1] in (["comment"], ["comments"]):
            said = _by_name(f"{named['class']} {named['id']}")
    if said == FURNISHED:
        return FURNISHED
    if name == "article":
        return ARTICLE
    if name == "main" or named["role"].lower() == "main" or "articleBody" in named["itemprop"] or BODIES.intersection(named["class"].lower().split()):
        return max(own, BODY)
    if own >= BODY:
        return LOOSELY if name in LOOSE else own  # in an article a header keeps its headings only, a form nothing
    return LOOSELY if name in LOOSE or said == LOOSELY else own


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(kind, text) of the blocks with text, in page order: references decoded, white space as one space."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    held: list[str] = []
    now, at, n = UNMARKED, 0, len(page)

    def end_of_block() -> None:
        if held:
            text = " ".join(references.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((now, text))

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            held.append(page[at:])
            break
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        name = name.lower()
        block = name not in INLINE and name not in UNSEEN
        if block:
            end_of_block()
        if m[1] or m[4]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if not block and stack[i][1] != now:
                        end_of_block()
                    del stack[i:]
                    break
                if stack[i][0] in BARRIERS and (name not in BARRIERS):
                    break
        elif name in RAW:
            close = re.compile(f"</{name}[^>]*>", re.I).search(page, at)
            at = close.end() if close else n
            continue
        elif name not in VOID:
            if block:
                wanted = CLOSES.get(name, ())
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p" or stack[i][0] in wanted:
                        del stack[i:]
                        break
                    if stack[i][0] not in INLINE and not (wanted and stack[i][0] not in CLOSED_IN):
                        break
            above = stack[-1][1] if stack else UNMARKED
            kind = _kind(name, m[3] or m[6] or "", above)
            if name in HEADINGS and above == LOOSELY and any(k >= BODY for _, k in stack):
                kind = max(k for _, k in stack)
            if not block and kind != now:
                end_of_block()
            stack.append((name, kind))
        now = stack[-1][1] if stack else UNMARKED
    end_of_block()
    return out


def declared(blocks: list[tuple[int, str]]) -> int | None:
    """The kind that holds the page's text by its markup, if any."""
    best = max((k for k, _ in blocks), default=UNMARKED)
    return best if best >= BODY else None


def outside(blocks: list[tuple[int, str]]) -> list[str]:
    """The texts of the blocks that aren't of the declared article."""
    article = declared(blocks)
    return [t for k, t in blocks if k != article]


def frequent_sequences(streams: list[list[str]], least: int, run: int = RUN) -> list[str]:
    """Sequences of ``run`` words on ``least`` distinct pages at least, from the sorted suffixes of all streams together."""
    number: dict[str, int] = {}
    sizes = np.array([len(s) for s in streams], np.int64)
    page = np.repeat(np.arange(len(streams)), sizes + 1)
    words = np.full(len(page), -1, np.int64)
    inside = np.ones(len(page), bool)
    inside[np.cumsum(sizes + 1) - 1] = False
    words[inside] = [number.setdefault(w, len(number)) for s in streams for w in s]
    left = np.concatenate([np.arange(s, -1, -1) for s in sizes]) if len(sizes) else np.zeros(0, int)
    rank, length = words + 1, 1
    while length < run:  # rank by the first 2, 4, ... words, from the ranks of both halves
        step = min(length, run - length)
        after = np.zeros_like(rank)
        after[: len(rank) - step] = rank[step:]
        _, rank = np.unique(rank * (rank.max(initial=0) + 1) + after, return_inverse=True)
        length += step
    starts = np.flatnonzero(left >= run)
    suffixes = starts[np.lexsort((page[starts], rank[starts]))]
    if not len(suffixes):
        return []
    by_rank, by_page = rank[suffixes], page[suffixes]
    head = np.concatenate([[True], by_rank[1:] != by_rank[:-1]])
    fresh = head | np.concatenate([[True], by_page[1:] != by_page[:-1]])
    heads = np.flatnonzero(head)
    pages = np.add.reduceat(fresh.astype(np.int64), heads)
    names = list(number)
    return [" ".join(names[w] for w in words[i : i + run]) for i in suffixes[heads[pages >= least]].tolist()]


def _hash(sequence: str) -> int:
    return xxhash.xxh64_intdigest(sequence) - 2**63


def _sequences(words: list[str]) -> list[int]:
    return [_hash(" ".join(words[i : i + RUN])) for i in range(len(words) - RUN + 1)]


def covered_words(texts: list[str], boilerplate: set[int]) -> list[int]:
    """Per block the number of words in boilerplate runs."""
    split = [t.split() for t in texts]
    words = [w for s in split for w in s]
    covered = bytearray(len(words))
    if boilerplate:
        for i, h in enumerate(_sequences(words)):
            if h in boilerplate:
                covered[i : i + RUN] = b"\x01" * RUN
    out, at = [], 0
    for s in split:
        out.append(sum(covered[at : at + len(s)]))
        at += len(s)
    return out


def main_text(page: str, boilerplate: set[int]) -> tuple[str, int]:
    """The text of a page and the number of words outside its article that are boilerplate by repetition."""
    blocks = blocks_of(page)
    article = declared(blocks)
    rest = [(k, t) for k, t in blocks if k != article]
    covered = covered_words([t for _, t in rest], boilerplate)
    if article is not None:
        kept = [t for k, t in blocks if k == article]
    else:
        open_ = [(t, c) for (k, t), c in zip(rest, covered, strict=True) if k == UNMARKED]
        kept = [t for t, c in open_ if 2 * c < len(t.split())] or [t for t, _ in open_]
    return " ".join(kept), sum(covered)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [" ".join(outside(blocks_of(x or ""))) for x in batch.column("__html").to_pylist()]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in ("__host", "__group", "__pages")], pa.array(words, pa.string())], names=["host", "group", "pages", "words"])


def _support(pages: int) -> int:
    return max(LEAST_PAGES, math.ceil(SHARE * pages))


def _mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of groups to one row for each group with sequences on enough of its pages."""

    def finished(key: tuple[str, int], pages: int | None, streams: list[list[str]]) -> Iterator[pa.RecordBatch]:
        # some group of p pages has a sequence on T p / P of them if it is on T of all P
        whole = pages or len(streams)
        found = frequent_sequences(streams, max(1, math.ceil(_support(whole) * len(streams) / whole)))
        if found:
            hashes = pa.array([sorted({_hash(x) for x in found})], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int32()), pa.array([pages], pa.int64()), hashes], names=["host", "group", "pages", "sequences"])

    now, total, streams = None, None, []
    for batch in batches:
        for host, group, pages, words in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if now is not None and (host, group) != now:
                yield from finished(now, total, streams)
                streams = []
            now, total = (host, group), pages
            streams.append(words.split())
    if now is not None:
        yield from finished(now, total, streams)


def _present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page the distinct sequences it has of those asked for."""
    for batch in batches:
        host, sequence = [], []
        for h, words, asked in zip(*[batch.column(n).to_pylist() for n in ("host", "words", "sequences")], strict=True):
            has = set(_sequences(words.split())).intersection(asked)
            host += [h] * len(has)
            sequence += has
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(sequence, pa.int64())], names=["host", "sequence"])


def boilerplate(keyed: DataFrame) -> DataFrame:
    """``__host``, ``__group``, ``sequences`` (hashes of the host's boilerplate) from pages with ``__host``, ``__group``, ``__pages`` (null unless the host is dealt into groups), ``__html``."""
    kind = "host string, group int, pages long, words string"
    streams = keyed.mapInArrow(_streams, kind)
    mined = streams.repartition("host", "group").sortWithinPartitions("host", "group").mapInArrow(_mined, "host string, group int, pages long, sequences array<long>")
    mined = staged(mined, "sequences")
    narrow = mined.filter("pages is null").select("host", "group", "sequences")

    parts = keyed.filter("__pages is not null")
    big = staged(parts.groupBy("__host", "__group").agg(F.max("__pages").alias("pages")).withColumnsRenamed({"__host": "host", "__group": "group"}), "groups")
    named = mined.filter("pages is not null").select("host", F.explode("sequences").alias("sequence")).distinct()
    asked = big.join(named.groupBy("host").agg(F.collect_list("sequence").alias("sequences")), "host").select("host", "group", "sequences")
    seen = parts.mapInArrow(_streams, kind).join(asked, ["host", "group"]).select("host", "words", "sequences").mapInArrow(_present, "host string, sequence long")
    total = big.groupBy("host").agg(F.max("pages").alias("pages"))
    least = F.greatest(F.lit(LEAST_PAGES), F.ceil(F.lit(SHARE) * F.col("pages")))
    wide = seen.groupBy("host", "sequence").count().join(total, "host").filter(F.col("count") >= least)
    wide = big.join(wide.groupBy("host").agg(F.collect_list("sequence").alias("sequences")), "host").select("host", "group", "sequences")
    return narrow.unionByName(wide).withColumnsRenamed({"host": "__host", "group": "__group"})


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``text`` (empty if none), ``n_chars`` (its code points) and ``n_repeated`` (words outside the article in boilerplate runs).

    A null html is empty; a null url or one without '://' has the empty host,
    whose pages are compared like those of any other. Pages of a host count by
    row, so repeated rows count each; a page is on one side of the limits for
    all its copies. Columns of the input with the names of results are replaced,
    all others stay; an empty table stays empty. Elements that are open at the
    end of a page are closed there, a tag that is cut off goes.
    """
    names = [c for c in pages.columns if c not in ("text", "n_chars", "n_repeated")]
    host, _ = parts_of(url)
    text = F.coalesce(F.col(html).cast("string"), F.lit(""))
    big = staged(pages.select(host.alias("__host")).groupBy("__host").agg(F.count(F.lit(1)).alias("__pages")).filter(F.col("__pages") > GROUP), "hosts")
    keyed = pages.select(*[F.col(f"`{c}`") for c in names], host.alias("__host"), text.alias("__html")).join(small(big), "__host", "left")
    groups = F.ceil(F.coalesce("__pages", F.lit(1)) / GROUP)
    keyed = keyed.withColumn("__group", F.pmod(F.xxhash64("__html", F.col(f"`{url}`")), groups).cast("int"))
    found = staged(boilerplate(keyed.select("__host", "__group", "__pages", "__html")), "boilerplate")
    groups, sequences = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("sequences")), F.lit(0))).first()
    if groups <= BROADCAST_SEQUENCES and sequences <= BROADCAST_SEQUENCES:  # at most a few MB; else the pages are dealt by host and group
        found = F.broadcast(found)
    joined = keyed.drop("__pages").join(found, ["__host", "__group"], "left")
    schema = T.StructType([pages.schema[c] for c in names]).add("text", "string").add("n_chars", "long").add("n_repeated", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, set()
        for batch in batches:
            rows = []
            for page, listed in zip(batch.column("__html").to_pylist(), batch.column("sequences"), strict=True):
                if last is None or not listed.equals(last):
                    last, known = listed, set(listed.as_py() or ())
                rows.append(main_text(page, known))
            made = [pa.array([t for t, _ in rows], pa.string()), pa.array([len(t) for t, _ in rows], pa.int64()), pa.array([n for _, n in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *made], names=schema.names)

    return joined.mapInArrow(run, schema)
