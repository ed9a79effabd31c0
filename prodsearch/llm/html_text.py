"""Main text of web pages by nearest-URL page differencing.

A page is read into blocks (lines of text), those in menus, headers,
footers, sidebars, notices, adverts, forms and comments left out by their
markup, but for an element that holds the longest article or most of the
page's text; if more prose stands outside the articles than in them, all that
is left counts as main text. What markup does not tell shows by difference: pages are put in the
order of host and URL path, each is aligned with its neighbours on the same
host by longest common subsequence of lines, and the shared lines are
deleted. Inside an article's own markup a shared line goes only if it is a
short label, since articles may quote the same passage. Pages with equal lines
are one page. A page that shares most of the words of the larger one with its
neighbour is a copy of it, and loses only the host's template: lines that three
or more pages and most pages of the host have. The template's words don't make
a copy, unless they are nearly all of a page.

The order is a range partition of hashes of lines, not of pages: a mass of
pages of one host is spread over tasks, and neighbours across the border of
two tasks are joined too.

Defined cases: a null or empty page has an empty text; a null URL sorts
before the others, as a host of its own; repeated rows are copies of each
other and keep their lines; cut-off markup ends the page; an empty table
gives an empty table; only id, URL and HTML are read.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prodsearch.llm.common import map_texts
from prodsearch.operators.guard import broadcast_if_small
from prodsearch.session import cut_lineage

LABEL_WORDS = 6             # a shared line of an article goes if it is this short and no sentence
COPY_SHARE = 0.5            # more shared words than this: a copy of the neighbour
TEMPLATE_PAGES = 3          # a line of the host's template is on as many pages and on most of them
OWN_SHARE = 0.2             # fewer words besides the template: its lines may be the text of copies
MAX_BROADCAST_MASKS = 500_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(script|style|noscript|template|textarea|select|svg|iframe|object|title)\b[^>]*(?:>.*?(?:</\1\s*>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
#: Words of class, id and role that name something other than the main text.
_ASIDE = re.compile(
    r"(?:^|[\s_-])(ads?|advert\w*|sponsor\w*|promo\w*|banner|side-?bar|menu|nav\w*|breadcrumbs?|footer|"
    r"header|masthead|cookies?|consent|notices?|alert|pop-?up|modal|comments?|disqus|respon[ds]e?s?|reply|"
    r"replies|share|sharing|social|related|recommend\w*|newsletter|subscri\w*|sign-?up|log-?in|search|"
    r"widget|toolbar|pagination|pager|copyright|disclaimer|complementary|contentinfo)(?=$|[\s_-])", re.I)
_DROPPED = frozenset("nav header footer aside form menu dialog button head".split())
_MAIN = frozenset(("article", "main"))
_MENUS = frozenset("nav menu dialog button".split())     # kept for an article inside, not for their own words
MOST_CHARS = 100            # an element this long may hold most of a page
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr picture source".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ENDS = re.compile(r"[.!?…:;。]['\")\]»”]*\Z")


def blocks(page: str | None) -> list[tuple[str, bool]]:
    """(text, inside an article) of the page's blocks in order."""
    out: list[tuple[str, tuple, int]] = []
    text: list[str] = []
    # open elements: name, the left-out elements and the outermost article around their text
    stack: list[tuple[str, tuple, int]] = []
    soft: list[bool] = []       # of each left-out element, whether its own words may keep it
    hidden: set[int] = set()
    mains = 0

    def close():
        line = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if line:
            out.append((line, *(stack[-1][1:] if stack else ((), 0))))

    at = 0
    page = page or ""
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        name = m[3] and m[3].lower()
        if not name:
            continue
        if m[2]:
            if name not in _INLINE:
                close()
            if any(e[0] == name for e in stack):
                if name in _INLINE:
                    close()         # an inline element on the stack was left out
                while stack.pop()[0] != name:
                    pass
            continue
        inline = name in _INLINE
        if not inline:
            close()
            # an open paragraph or list item ends where another block begins
            if stack and stack[-1][0] == "p" or stack and name == "li" and stack[-1][0] == "li":
                stack.pop()
        elif name == "br":
            text.append(" ")
        around, main = stack[-1][1:] if stack else ((), 0)
        # an article's own header holds its title
        unseen = bool(_HIDDEN.search(m[4])) and name not in ("body", "html")
        named = name not in ("body", "html") and (name not in _MAIN or main) and _named_aside(m[4], bool(main))
        drop = named or (name in _DROPPED and not (name == "header" and main))
        if name in _VOID or m[4].endswith("/"):
            continue
        if inline and not drop:
            continue                # inline elements are followed only where one is left out
        if inline:
            close()
        if drop:
            if unseen:
                hidden.add(len(soft))
            around += (len(soft),)
            soft.append(name not in _MENUS)
        if name in _MAIN and not main:
            mains += 1
            main = mains
        stack.append((name, around, main))
    if at < len(page):
        text.append(page[at:].split("<", 1)[0] if re.match(r"[^<]*<[a-zA-Z/!]", page[at:]) else page[at:])
    close()
    return _kept([b for b in out if not hidden.intersection(b[1])], soft)


def _kept(out: list[tuple[str, tuple, int]], soft: list[bool]) -> list[tuple[str, bool]]:
    """The blocks outside the left-out elements. The elements around the
    longest article are not left out; without an article, those that hold
    most of the page's text."""
    held, inside, first = defaultdict(int), defaultdict(int), {}
    for line, around, main in out:
        for e in around:
            held[e] += len(line)
        if main:
            # the elements around the article itself come first in its blocks' lists
            first[main] = around if main not in first else _common(first[main], around)
    for line, around, main in out:
        if main and around == first[main]:
            inside[main] += len(line)
    back: set[int] = set()
    if inside:
        back.update(first[max(inside, key=lambda k: (inside[k], -k))])
    else:
        total = sum(len(x[0]) for x in out)
        back.update(e for e, n in held.items() if soft[e] and n >= MOST_CHARS and 2 * n > total)
    return [(line, bool(main)) for line, around, main in out if back.issuperset(around)]


def _common(a: tuple, b: tuple) -> tuple:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return a[:n]


def _named_aside(attributes: str, in_article: bool) -> bool:
    if not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    # an article's own header holds its title
    return any(not in_article or w[1].lower() != "header" for m in _NAMES.finditer(attributes)
               for w in _ASIDE.finditer(next(filter(None, m.groups()), "")))


def _prose(line: str) -> int:
    return len(line) if len(line.split()) > LABEL_WORDS or _ENDS.search(line) else 0


def candidates(page: str | None) -> list[tuple[str, bool]]:
    """The blocks that may be main text: those of the articles, if the page
    marks them and has no more prose outside, or else all."""
    b = blocks(page)
    inside = [x for x in b if x[1]]
    prose = sum(_prose(t) for t, _ in inside)
    return inside if inside and sum(_prose(t) for t, _ in b) <= 2 * prose else b


def common_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence of two lists of line hashes,
    by the increasing runs of matching positions."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    where = defaultdict(list)
    for j in range(len(b) - end - 1, start - 1, -1):
        where[b[j]].append(j)
    tails: list[int] = []           # last position in b of the best run of each length
    held: list = []                 # its (i, j, link to the run before)
    for i in range(start, len(a) - end):
        for j in where.get(a[i], ()):
            k = bisect_left(tails, j)
            link = (i, j, held[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                held.append(link)
            else:
                tails[k], held[k] = j, link
    middle, link = [], held[-1] if held else None
    while link:
        middle.append(link[:2])
        link = link[2]
    return ([(i, i) for i in range(start)] + middle[::-1]
            + [(len(a) - k, len(b) - k) for k in range(end, 0, -1)])


def deletable(line: str, in_article: bool) -> bool:
    """Whether a line goes if a neighbour shares it."""
    return not in_article or (len(line.split()) <= LABEL_WORDS and not _ENDS.search(line))


def page_lines(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """(key, host, path, id, lines, words, may): the candidate lines of each
    page as hashes, with their numbers of words and whether each may go. The
    key is a hash of the row, so that equal rows have one."""
    u = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    row = pages.select(
        F.xxhash64(f"`{page_id}`", f"`{url}`", f"`{html}`").alias("key"),
        F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*|[?#].*$", "").alias("path"),
        F.col(f"`{html}`").alias("html"))

    def make():
        def of(pages_html: list) -> dict:
            out = {"lines": [], "words": [], "may": []}
            for h in pages_html:
                c = candidates(h)
                out["lines"].append([_line_hash(t) for t, _ in c])
                out["words"].append([len(t.split()) for t, _ in c])
                out["may"].append([int(deletable(t, a)) for t, a in c])
            return out
        return of

    return map_texts(row, ["key", "host", "path"], "html", make,
                     {"lines": "array<long>", "words": "array<long>", "may": "array<long>"})


def _line_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def distinct_pages(lines: DataFrame) -> DataFrame:
    """One row per host and list of lines, named by ``same``, which becomes the
    key, at its first path; ``may`` is 2 or 3 for lines of the host's template."""
    one = cut_lineage(lines.groupBy("host", F.col("same").alias("key")).agg(
        F.min("path").alias("path"), F.first("lines").alias("lines"), F.first("words").alias("words"),
        F.first("may").alias("may")))
    pages = one.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= TEMPLATE_PAGES)
    on = (one.select("host", F.explode(F.array_distinct("lines")).alias("line"))
          .groupBy("host", "line").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= TEMPLATE_PAGES))
    # at most twice as many lines as a page of the host has on average
    template = (on.join(pages, "host").where(2 * F.col("c") > F.col("n"))
                .groupBy("host").agg(F.collect_list("line").alias("template")))
    known = one.join(broadcast_if_small(cut_lineage(template), MAX_BROADCAST_MASKS), "host", "left")
    return known.withColumn("may", F.when(F.col("template").isNull(), F.col("may")).otherwise(F.zip_with(
        "lines", "may", lambda x, m: m + F.when(F.array_contains("template", x), 2).otherwise(0)))
    ).select("key", "host", "path", "lines", "words", "may")


def neighbours(lines: DataFrame) -> DataFrame:
    """Pairs of rows next to each other in the order of host and path, on one
    host: (key, lines, words, may, key_b, lines_b, words_b, may_b)."""
    cols = ["key", "lines", "words", "may"]
    partitions = max(1, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["host", "path", "key"]
    placed = cut_lineage(lines.dropDuplicates(["key"]).repartitionByRange(partitions, *order)
                         .sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id()))
    fields = placed.select("host", *cols)
    types = {f.name: f.dataType.simpleString() for f in fields.schema.fields}
    schema = ", ".join([f"{c} {types[c]}" for c in cols] + [f"{c}_b {types[c]}" for c in cols])

    def adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([last, t]) if last is not None else t
            last = t.slice(t.num_rows - 1)
            a, z = t.slice(0, t.num_rows - 1), t.slice(1)
            same = pa.array([x == y for x, y in zip(a["host"].to_pylist(), z["host"].to_pylist())], pa.bool_())
            a, z = a.select(cols).filter(same), z.select(cols).filter(same)
            yield from pa.table([*a.columns, *z.columns], names=cols + [c + "_b" for c in cols]
                                ).combine_chunks().to_batches()

    inner = fields.mapInArrow(adjacent, schema)
    # the borders: one row from either end of each partition
    whole = F.struct(*order, *[c for c in cols if c != "key"])
    ends = placed.groupBy("pid").agg(F.min(whole).alias("first"), F.max(whole).alias("last"))
    before = Window.orderBy("pid")          # as many rows as there are partitions
    border = (ends.withColumn("prev", F.lag("last").over(before))
              .where(F.col("prev.host") == F.col("first.host"))
              .select(*[F.col(f"prev.{c}").alias(c) for c in cols],
                      *[F.col(f"first.{c}").alias(f"{c}_b") for c in cols]))
    return inner.unionByName(border)


def shared_lines(pairs: DataFrame) -> DataFrame:
    """(key, gone): positions of the lines a page loses, over its neighbours;
    only pages that lose any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, gone = [], []
            for r in b.to_pylist():
                both = common_lines(r["lines"], r["lines_b"])
                sides = ((r["words"], r["may"]), (r["words_b"], r["may_b"]))
                own = [sum(w for w, m in zip(*s) if m < 2) for s in sides]
                template = all(o >= OWN_SHARE * sum(s[0]) for o, s in zip(own, sides))
                rest = both
                if template:
                    rest = [(i, j) for i, j in both if r["may"][i] < 2]
                else:
                    own = [sum(s[0]) for s in sides]
                if sum(r["words"][i] for i, _ in rest) > COPY_SHARE * max(own):
                    alike = set(rest)
                    both = [x for x in both if x not in alike]
                for key, at in ((r["key"], [i for i, _ in both if r["may"][i] & 1]),
                                (r["key_b"], [j for _, j in both if r["may_b"][j] & 1])):
                    if at:
                        keys.append(key)
                        gone.append(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(gone, pa.list_(pa.int64()))], ["key", "gone"])

    got = pairs.mapInArrow(run, "key long, gone array<long>")
    # two neighbours at most
    return got.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text (blocks joined by an empty line) and n_chars."""
    lines = cut_lineage(page_lines(pages, page_id, url, html).withColumn("same", F.xxhash64("host", "lines", "may")))
    gone = cut_lineage(shared_lines(neighbours(distinct_pages(lines))))
    masks = cut_lineage(lines.select("key", F.col("same")).distinct().join(
        broadcast_if_small(gone.withColumnRenamed("key", "same"), MAX_BROADCAST_MASKS), "same").select("key", "gone"))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{html}`").alias("html"),
                        F.xxhash64(f"`{page_id}`", f"`{url}`", f"`{html}`").alias("key"))
    known = rows.join(broadcast_if_small(masks, MAX_BROADCAST_MASKS), "key", "left")
    # the lines to delete ride in front of the page, which may hold any text
    packed = known.select("page_id", "url", F.concat(
        F.array_join(F.coalesce("gone", F.array().cast("array<long>")), ","), F.lit("\n"),
        F.coalesce("html", F.lit(""))).alias("packed"))

    def make():
        def of(packed_pages: list) -> dict:
            out = []
            for p in packed_pages:
                head, _, page = p.partition("\n")
                gone = set(map(int, head.split(","))) if head else set()
                out.append("\n\n".join(t for i, (t, _) in enumerate(candidates(page)) if i not in gone))
            return {"text": out, "n_chars": [len(t) for t in out]}
        return of

    return map_texts(packed, ["page_id", "url"], "packed", make, {"text": "string", "n_chars": "long"})
