"""Main text of web pages by a suffix array over the pages of a host.

A page's markup is cut into blocks of text, each with its zone: inside an article or main
container, inside a container that names itself as menu, footer, advert, form, comments and the
like, or neither. An article inside a container named by class or id alone counts where the page has no other. The blocks' tokens of a host's pages are concatenated and their suffixes sorted
to the depth of the shortest repeat that counts; a run of tokens found on enough distinct pages
is covered. Named boilerplate goes. On a page with an article its blocks are the text, but for those
that are covered as a whole by runs on more than half of the host's pages and on ``article_pages`` of them: prose that
some pages share stays, and a handful of pages cannot tell it from a notice. On any other, covered tokens are cut out of the blocks and the unique runs stay. A block shorter than a run counts as
a run of its own.

The pages of a large host are dealt over groups of about ``group_pages``, so no host meets in one task, and runs
are counted over all of them under one threshold: a run on enough of a host's pages is on as large a share in
some group, so the groups' suffix arrays give the candidates, which all groups then count. Runs are known by 64-bit
hashes there.

Defined cases: null html is empty and gives an empty text; a null or odd url belongs to the host
''; pages of a host with equal text count as one page for repeats and each get their text; cut-off markup
at the end is dropped; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html as entities
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from callweave.llm.common import small, stored

MAIN, OTHER, NAMED = 2, 1, 0
_CLASSED, _INNER = -1, -2  # while a page is read: named by class or id alone, and an article in there

_PARTS = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?:svg|iframe)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>"
    # the rest is raw only if it is closed, before another of its kind begins
    r"|<(?P<held>noscript|template|svg|iframe|select|button)\b[^<]*(?:<(?!/?(?P=held)\b)[^<]*)*</(?P=held)\s*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[a-zA-Z/!?][^>]*(?:>|\Z)"
    r"|(?P<text><|[^<]+)",
    re.S | re.I,
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_CONTAINERS = frozenset("div section nav header footer aside form main article ul ol dl table figure fieldset body details dialog".split())
_NAMED_TAGS = frozenset("nav footer aside form dialog fieldset".split())
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|sidebar|side|footer|header|masthead|banner|ad|ads|advert|adverts|advertisement|"
    r"promo|promoted|sponsor|sponsored|cookie|cookies|consent|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|signup|"
    r"share|sharing|social|related|recommended|comment|comments|disqus|respond|reply|replies|breadcrumb|breadcrumbs|pagination|"
    r"pager|widget|login|search|toolbar|skip)(?:$|[\s_-])",
    re.I,
)
_MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|story|post|entry|main)(?:[\s_-](?:body|content|text))?(?:$|\s)", re.I)
#: Class names of layouts, which hold the text beside what they name.
_LAYOUT = re.compile(r"(?:has|with|without|no)[_-].+|content[_-]side(?:bar)?(?:[_-].*)?", re.I)
#: Whole name and value of each attribute in turn, so that no name is found within a value.
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")


def _named(value: str) -> bool:
    return _NAMES.search(value) is not None and any(_NAMES.search(v) and not _LAYOUT.fullmatch(v) for v in value.split())


def _zone(tag: str, rest: str, around: int, inside: bool) -> int:
    """Zone of a container in a zone ``around``; ``inside``: some container around is an article."""
    if tag == "form" and not inside and around != NAMED:
        return _CLASSED  # some pages are one form, with their article in it
    if around == NAMED or tag in _NAMED_TAGS:
        return NAMED
    main, classed = tag in ("article", "main"), False
    if rest:
        for m in _ATTRIBUTE.finditer(rest):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                return NAMED
            if name == "role" and value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog"):
                return NAMED
            classed = classed or (name in ("class", "id") and tag != "body" and _named(value))
            main = main or (name == "role" and value.lower() == "main") or (
                name in ("class", "id") and around != _CLASSED and bool(_MAIN_NAMES.search(value))
            )
    if classed:
        return NAMED if inside else _CLASSED
    if tag == "header" and around not in (MAIN, _INNER):
        return NAMED
    if around == _CLASSED:
        return _INNER if main else _CLASSED
    return MAIN if main and around != _INNER else around


def page_blocks(html: str | None) -> list[tuple[int, str]]:
    """``(zone, text)`` of each block in page order, character references decoded, white space single."""
    blocks: list[tuple[int, str]] = []
    if not html:
        return blocks
    stack: list[tuple[str, int]] = [("", OTHER)]
    parts: list[str] = []
    # from the body on, if there is one: the head has no text
    start = re.search(r"<body\b", html, re.I)

    def end() -> None:
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                blocks.append((stack[-1][1], text))

    for m in _PARTS.finditer(html, start.start() if start else 0):
        if (text := m["text"]) is not None:
            parts.append(text)
        elif tag := m["tag"]:
            tag = tag.lower()
            if tag in _INLINE:
                continue
            end()
            if m["close"]:
                if any(t == tag for t, _ in stack):
                    while stack[-1][0] != tag:
                        stack.pop()
                    stack.pop()
            elif tag in _CONTAINERS and not m["rest"].endswith("/"):
                inside = any(z in (MAIN, _INNER) for _, z in stack)
                stack.append((tag, _zone(tag, m["rest"], stack[-1][1], inside)))
    end()
    # an article in a container that only a class or id names is the text of a page without any other
    inner = NAMED if any(z == MAIN for z, _ in blocks) else MAIN
    return [(inner if z == _INNER else max(z, NAMED), t) for z, t in blocks]


# --------------------------------------------------------------------------
# Repeats over the pages of a group
# --------------------------------------------------------------------------
def suffix_order(stream: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(order, rank, depth)``: suffixes sorted by their first ``depth`` or more tokens and the dense
    rank of that prefix. Three ranks at a time make one key, so each sort triples the depth."""
    n = len(stream)
    rank, reached = stream.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while True:
        width = int(rank.max()) + 2
        many = 3 if width < 1 << 21 else 2
        key = rank + 1
        for k in range(1, many):
            after = np.zeros(n, np.int64)
            if reached * k < n:
                after[: n - reached * k] = rank[reached * k :] + 1
            key = key * width + after
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        reached *= many
        if reached >= depth:
            return order, rank, reached


def repeats(ids: np.ndarray, owner: np.ndarray, least: int) -> np.ndarray:
    """For each place of a stream of token numbers, in which 0 ends a block, on how many distinct pages
    (``owner`` of each place) the ``least`` tokens from there are; 0 where the block ends before."""
    # each block's end is a symbol of its own, so no run reaches past it
    ends = ids == 0
    coded = np.where(ends, np.cumsum(ends) - 1, ids - 1 + ends.sum())
    order, rank, depth = suffix_order(coded, least)
    if depth > least:  # rank by exactly ``least`` tokens: merge neighbours that differ only past it
        same = np.ones(len(order) - 1, bool)
        a, b = order[:-1], order[1:]
        for k in range(least):
            fits = (a + k < len(coded)) & (b + k < len(coded))
            same &= fits & (coded[np.minimum(a + k, len(coded) - 1)] == coded[np.minimum(b + k, len(coded) - 1)])
        group = np.concatenate(([0], np.cumsum(~same)))
    else:
        group = rank[order]
    many = int(owner.max()) + 1
    pair = np.unique(group.astype(np.int64) * many + owner[order])
    spread = np.bincount(pair // many, minlength=int(group[-1]) + 1)
    found = np.zeros(len(ids), np.int64)
    found[order] = spread[group]
    found[room(ids) < least] = 0
    return found


def room(ids: np.ndarray) -> np.ndarray:
    """Tokens from each place to the end of its block."""
    ends = np.nonzero(ids == 0)[0]
    return np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(len(ids))


def covered(hit: np.ndarray, least: int) -> np.ndarray:
    """The places that lie in the ``least`` from one in ``hit``."""
    step = np.zeros(len(hit) + least + 1, np.int64)
    at = np.nonzero(hit)[0]
    step[at] += 1
    np.add.at(step, at + least, -1)
    return np.cumsum(step)[: len(hit)] > 0


def covered_tokens(pages: list[list[np.ndarray]], least: int, min_pages: int) -> list[list[np.ndarray]]:
    """Per page and block, which tokens lie in a run of ``least`` or more that ``min_pages`` distinct
    pages have. Runs don't cross blocks."""
    parts = [np.append(ids, 0) for blocks in pages for ids in blocks]
    if not parts:
        return [[] for _ in pages]
    owner = np.repeat(np.arange(len(pages)), [sum(len(ids) + 1 for ids in blocks) for blocks in pages])
    flat = covered(repeats(np.concatenate(parts), owner, least) >= min_pages, least)
    cut = iter(np.split(flat, np.cumsum([len(x) for x in parts])[:-1]))
    return [[next(cut)[:-1] for _ in blocks] for blocks in pages]


class Streams:
    """The distinct pages of a group as one stream of token numbers. A block shorter than a run is filled up
    to one with the empty token, which no text has, so it repeats as a whole."""

    def __init__(self, pages: list[tuple[str, str]], least: int):
        number: dict[str | None, int] = defaultdict(itertools.count(1).__next__, {None: 0})
        self.least, first, self.distinct, rows = least, {}, [], []
        for _, text in pages:  # pages of equal text are one
            self.distinct.append(first.setdefault(text, len(first)))
            if len(rows) < len(first):
                words: list[str | None] = []
                for line in text.split("\n") if text else ():
                    said = line.split(" ")
                    words += said
                    if len(said) < least:
                        words += [""] * (least - len(said))
                    words.append(None)
                rows.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        self.count = len(rows)
        self.at = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)
        self.ids = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.owner = np.repeat(np.arange(len(rows)), np.diff(self.at))
        self.words = list(number)

    def repeats(self) -> np.ndarray:
        return repeats(self.ids, self.owner, self.least) if len(self.ids) else self.ids

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """``(places, key)``: where a whole run begins, and a 64-bit hash of its tokens that is the same in every group."""
        hashes = np.array([0] + [xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in self.words[1:]], np.uint64)
        each = hashes[self.ids]
        key, factor = np.zeros(len(each), np.uint64), 1
        for k in range(min(self.least, len(each))):
            factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
            key[: len(each) - k] += each[k:] * np.uint64(factor)
        places = np.nonzero(room(self.ids) >= self.least)[0]
        return places, key.view(np.int64)[places]

    def texts(self, pages: list[tuple[str, str]], hit: np.ndarray, most: np.ndarray) -> list[str]:
        """The text of each page; ``hit``: the places of the runs that repeat, ``most``: of those on most pages."""
        flat, all_over = covered(hit, self.least), covered(most, self.least)
        at = [slice(a, b) for a, b in zip(self.at, self.at[1:])]
        return [page_text(*page, flat[at[d]], all_over[at[d]], self.least) for page, d in zip(pages, self.distinct)]


def page_text(zones: str, text: str, flat: np.ndarray, all_over: np.ndarray, least: int) -> str:
    """The text of a page; ``flat``: which tokens are covered, ``all_over``: by runs on most pages of the host,
    ``least`` or more of each block and one for its end."""
    wanted = str(MAIN) if str(MAIN) in zones else str(OTHER)
    blocks = list(zip(zones, text.split("\n")))
    gone = all_over if wanted == str(MAIN) else flat
    if not gone.any():
        return "\n".join(t for z, t in blocks if z == wanted)
    out, at = [], 0
    for zone, block in blocks:
        words = block.split(" ")
        cut = gone[at : at + len(words)]
        if zone == str(MAIN) and not cut.all():
            out.append(block)
        elif zone == wanted == str(OTHER):
            out.append(" ".join(w for w, c in zip(words, cut.tolist()) if not c))
        at += max(len(words), least) + 1
    return "\n".join(t for t in out if t)


def _lines(html: str | None) -> tuple[str, str]:
    """``(zones, text)``: a digit and a line for each block."""
    blocks = page_blocks(html)
    return "".join(str(z) for z, _ in blocks), "\n".join(t for _, t in blocks)


def needed(count: int, min_pages: int, share: float) -> int:
    """On how many of a host's ``count`` distinct pages a run repeats."""
    return max(min_pages, int(share * count))


def main_texts(htmls: list[str | None], least: int, min_pages: int, share: float, article_pages: int = 10) -> list[str]:
    """The text of each page of a host."""
    pages = [_lines(h) for h in htmls]
    streams = Streams(pages, least)
    found = streams.repeats()
    hit = found >= needed(streams.count, min_pages, share)
    return streams.texts(pages, hit, hit & (2 * found > streams.count) & (found >= article_pages))


def _extract_batches(
    batches: Iterator[pa.RecordBatch], least: int, min_pages: int, share: float, article_pages: int
) -> Iterator[pa.RecordBatch]:
    """Rows (host, page_id, url, html) sorted by host, one host in memory at a time."""
    names = ["page_id", "url", "text"]

    def close(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        texts = main_texts(whole.column("html").to_pylist(), least, min_pages, share, article_pages)
        ids, urls = (whole.column(c).combine_chunks() for c in names[:2])
        return pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string())], names=names)

    held, group = [], None
    for batch in batches:
        keys = batch.column(0).to_pylist()
        at = 0
        while at < len(keys):
            to = at
            while to < len(keys) and keys[to] == keys[at]:
                to += 1
            if held and keys[at] != group:
                yield close(held)
                held = []
            group = keys[at]
            held.append(batch.slice(at, to - at))
            at = to
    if held:
        yield close(held)


# --------------------------------------------------------------------------
# Hosts of many groups
# --------------------------------------------------------------------------
def _deal_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, groups, owners, place, page_id, url, html) to (host, salt, counted, page_id, url, zones, lines). Of
    the copies of a text in a partition the first goes to the group that counts this text, all others to any."""
    seen = set()
    for batch in batches:
        hosts, groups, owners, places, htmls = (batch.column(k).to_pylist() for k in (0, 1, 2, 3, 6))
        salts, counted, pages = [], [], []  # pages: zones and lines
        for host, many, own, place, html in zip(hosts, groups, owners, places, htmls):
            page = _lines(html)
            same = xxh3_64_intdigest(page[1].encode("utf-8", "surrogatepass"))
            fresh = (host, same) not in seen
            seen.add((host, same))
            salts.append(same % own if fresh else place % many)
            counted.append(fresh)
            pages.append(page)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(salts, pa.int32()), pa.array(counted), batch.column(4), batch.column(5),
                *(pa.array([p[k] for p in pages], pa.string()) for k in (0, 1)),
            ],
            names=["host", "salt", "counted", "page_id", "url", "zones", "lines"],
        )


def _pages_of(rows: pa.Table, counted: bool = False) -> list[tuple[str, str]]:
    if counted:
        rows = rows.filter(rows.column("counted"))
    return list(zip(rows.column("zones").to_pylist(), rows.column("lines").to_pylist()))


def _candidates(key: tuple, rows: pa.Table, least: int, share: float) -> pa.Table:
    """The runs that could repeat over the host: were each run of a group on no more than share * pages - 1 of the
    group's pages, the host's total would stay below share * pages - 1, which ``needed`` never does."""
    streams = Streams(_pages_of(rows, True), least)
    places, keys = streams.keys()
    high = streams.repeats()[places] > share * streams.count - 1 - 1e-6
    runs = np.unique(keys[high])
    return pa.table({"host": pa.array([key[0].as_py()] * len(runs), pa.string()), "run": pa.array(runs, pa.int64())})


def _looked_up(keys: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ``keys`` are among the sorted ``runs``, and where."""
    at = np.minimum(np.searchsorted(runs, keys), max(len(runs) - 1, 0))
    return (runs[at] == keys if len(runs) else np.zeros(len(keys), bool)), at


def _count_candidates(key: tuple, rows: pa.Table, wanted: pa.Table, least: int) -> pa.Table:
    """On how many distinct pages of the group each wanted run is, and with a null run how many pages there are."""
    runs = np.sort(wanted.column("run").to_numpy())
    streams = Streams(_pages_of(rows, True), least)
    places, keys = streams.keys()
    hit, at = _looked_up(keys, runs)
    many = max(streams.count, 1)
    pair = np.unique(at[hit] * many + streams.owner[places[hit]])
    n = np.bincount(pair // many, minlength=len(runs))
    return pa.table({
        "host": pa.array([key[0].as_py()] * (len(runs) + 1), pa.string()),
        "run": pa.concat_arrays([pa.array(runs, pa.int64()), pa.nulls(1, pa.int64())]),
        "n": pa.array([*n.tolist(), streams.count], pa.int64()),
    })


def _cut_pages(key: tuple, rows: pa.Table, repeated: pa.Table, least: int) -> pa.Table:
    pages = _pages_of(rows)
    streams = Streams(pages, least)
    places, keys = streams.keys()
    repeated = repeated.sort_by("run")
    hit, most = np.zeros(len(streams.ids), bool), np.zeros(len(streams.ids), bool)
    hit[places], at = _looked_up(keys, repeated.column("run").to_numpy())
    if len(repeated):
        most[places] = repeated.column("most").to_numpy()[at]
    return rows.select(["page_id", "url"]).append_column("text", pa.array(streams.texts(pages, hit, hit & most), pa.string()))


def extract_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 6,
    min_pages: int = 3, share: float = 0.02, group_pages: int = 256, article_pages: int = 10,
) -> DataFrame:
    """``(page_id, url, text)`` per row of ``pages``."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(
        host.alias("host"), F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html")
    )
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType())])
    # copies go over all groups, texts are counted in the first of them
    counts = rows.groupBy("host").agg(
        F.ceil(F.count(F.lit(1)) / group_pages).cast("int").alias("groups"),
        F.ceil(F.approx_count_distinct(F.xxhash64("html")) / group_pages).cast("int").alias("owners"),
    )
    large = stored(counts.where("groups > 1").withColumn("owners", F.least("groups", F.greatest("owners", F.lit(1)))), "extraction-hosts")
    many = large.count()
    few = rows.join(small(large.select("host")), "host", "left_anti") if many else rows
    few = few.select("host", "page_id", "url", "html").repartition("host").sortWithinPartitions("host")
    few = few.mapInArrow(partial(_extract_batches, least=least, min_pages=min_pages, share=share, article_pages=article_pages), schema)
    if not many:
        return few

    place = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)).cast("int")
    dealt = rows.join(small(large), "host").select("host", "groups", "owners", place.alias("place"), "page_id", "url", "html")
    kept = [rows.schema["page_id"], rows.schema["url"]]
    dealt = dealt.mapInArrow(_deal_batches, T.StructType([
        T.StructField("host", T.StringType()), T.StructField("salt", T.IntegerType()), T.StructField("counted", T.BooleanType()), *kept,
        T.StructField("zones", T.StringType()), T.StructField("lines", T.StringType()),
    ]))
    # three steps over the same groups: in one query Spark shuffles them once
    grouped = dealt.groupBy("host", "salt")

    def over(runs: DataFrame, groups: str):
        """``runs`` for each of the host's groups."""
        each = runs.join(small(large), "host").select(*runs.columns, F.explode(F.sequence(F.lit(0), F.col(groups) - 1)).alias("salt"))
        return each.groupBy("host", "salt")

    def candidates(key, rows):
        return _candidates(key, rows, least, share)

    def count(key, rows, wanted):
        return _count_candidates(key, rows, wanted, least)

    def cut(key, rows, repeated):
        return _cut_pages(key, rows, repeated, least)

    wanted = grouped.applyInArrow(candidates, "host string, run long").distinct()
    counted = grouped.cogroup(over(wanted, "owners")).applyInArrow(count, "host string, run long, n long")
    totals = counted.groupBy("host", "run").agg(F.sum("n").alias("n"))
    totals = totals.withColumn("pages", F.max(F.when(F.col("run").isNull(), F.col("n"))).over(Window.partitionBy("host")))
    enough = F.greatest(F.lit(min_pages), F.floor(F.lit(share) * F.col("pages")))
    repeated = totals.where(F.col("run").isNotNull() & (F.col("n") >= enough))
    repeated = repeated.select("host", "run", ((2 * F.col("n") > F.col("pages")) & (F.col("n") >= article_pages)).alias("most"))
    return few.unionByName(grouped.cogroup(over(repeated, "groups")).applyInArrow(cut, schema))
