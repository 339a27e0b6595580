"""Operator 1: main text of HTML pages by differencing with the page of the nearest URL.

1. A page becomes text lines, one per block element, each with a zone: page furniture
   (navigation, headers, footers, sidebars, notices, adverts, forms, comments, by
   element or by class, id and role), the marked article (article, main), or open.
2. Pages are sorted by host and path over range partitions; each partition also gets
   the page before and after it, so every page sees both neighbours of its host.
3. A page is paired with the neighbour whose path shares the longer prefix.  Their
   visible lines are aligned by longest common subsequence, and open lines that are
   shared are deleted.  A neighbour with more than ``copy_share`` of the lines in
   common is a copy of the page and tells nothing about furniture: the other
   neighbour is taken, or none.
4. Furniture is dropped; if the page marks an article, its lines are the text,
   otherwise the open lines that are left.

Lines of a marked article stay even if the neighbour has them: shared passages and
near copies of an article are text, which plain differencing would delete.

Nulls and edge cases: null html gives an empty text; a null url belongs to an empty
host; a host with one page has no pair and loses nothing to differencing; unclosed
elements end with the page; repeated pages are copies of each other; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from martcraft.llm.kernel import word_hashes
from martcraft.session import materialize

FURNITURE, OPEN, ARTICLE = 0, 1, 2

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                  r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?][^>]*>", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "select",
        "head"}
_FURNITURE_TAGS = {"nav", "footer", "aside", "form", "button", "dialog", "menu"}
_FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form"}
_FURNITURE_NAMES = {"nav", "navbar", "menu", "header", "footer", "notice", "notices", "banner", "promo", "share",
                    "social", "related", "widget", "popup", "modal", "toolbar", "pager", "pagination"}
_FURNITURE_PARTS = {"ad", "ads", "advert", "adverts", "advertisement", "cookie", "cookies", "consent", "comment",
                    "comments", "sidebar", "breadcrumb", "breadcrumbs", "sponsor", "sponsored", "newsletter",
                    "subscribe", "navigation"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
           "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
           "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "input"}
_VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_PLAIN = {"html", "body", "article", "main"}


def _is_furniture(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in _FURNITURE_TAGS or (tag == "header" and not in_article):
        return True
    if tag in _PLAIN or ("=" not in attrs):
        return False
    for name, value in _ATTR.findall(attrs):
        value = value.strip("\"'").lower()
        if name.lower() == "role":
            if value in _FURNITURE_ROLES:
                return True
            continue
        for token in value.split():
            if token in _FURNITURE_NAMES or not _FURNITURE_PARTS.isdisjoint(re.split(r"[^a-z0-9]+", token)):
                return True
    return False


def text_lines(page: str | None) -> list[tuple[str, int]]:
    """(line, zone) of every block with text, in page order."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    page = page or ""
    pos, article, hidden, hidden_depth = 0, 0, "", 0

    def flush() -> None:
        if held:
            line = " ".join(_html.unescape("".join(held)).split())
            if line:
                out.append((line, FURNITURE if hidden else ARTICLE if article else OPEN))
            held.clear()

    while True:
        m = _TAG.search(page, pos)
        if m is None:
            held.append(page[pos:])
            break
        if m.start() > pos:
            held.append(page[pos:m.start()])
        pos = m.end()
        tag = m.group(2) or m.group(5)
        if not tag:
            continue
        tag = tag.lower()
        closing = bool(m.group(1) or m.group(4))
        attrs = m.group(3) or m.group(6) or ""
        if tag in _INLINE:
            if tag == "br":
                held.append(" ")
            elif not closing and tag == "span" and not hidden and _is_furniture(tag, attrs, article > 0):
                flush()
                hidden, hidden_depth = tag, 1
                continue
            if hidden == tag:
                hidden_depth += -1 if closing else 1
                if not hidden_depth:
                    flush()
                    hidden = ""
            continue
        flush()
        if not closing and tag in _RAW and not attrs.endswith("/"):
            end = re.compile(rf"</{tag}\s*>" if tag != "head" else r"</head\s*>|(?=<body)", re.I).search(page, pos)
            pos = end.end() if end else len(page)
        elif hidden:
            if tag == hidden and tag not in _VOID:
                hidden_depth += -1 if closing else 1
                if not hidden_depth:
                    hidden = ""
        elif tag in ("article", "main"):
            article = max(0, article + (-1 if closing else 1))
        elif not closing and tag not in _VOID and _is_furniture(tag, attrs, article > 0):
            hidden, hidden_depth = tag, 1
    flush()
    return out


def common(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Places in a and in b of a longest common subsequence (by matches and increasing chains)."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    where: dict[int, list[int]] = {}
    for j in range(len(b) - hi - 1, lo - 1, -1):
        where.setdefault(b[j], []).append(j)            # from the back, so a line takes one place
    tails: list[int] = []
    nodes: list[tuple] = []
    for i in range(lo, len(a) - hi):
        for j in where.get(a[i], ()):
            k = bisect_left(tails, j)
            node = (i, j, nodes[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                nodes.append(node)
            else:
                tails[k], nodes[k] = j, node
    mid = []
    node = nodes[-1] if nodes else None
    while node:
        mid.append((node[0], node[1]))
        node = node[2]
    pairs = [(i, i) for i in range(lo)] + mid[::-1] + [(len(a) - hi + i, len(b) - hi + i) for i in range(hi)]
    return [p[0] for p in pairs], [p[1] for p in pairs]


@dataclass
class Page:
    key: int
    host: str
    path: str
    lines: list[int]
    zones: list[int]
    halo: bool


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def shared_lines(page: Page, before: Page | None, after: Page | None, copy_share: float) -> list[int]:
    """Open lines of a page that its nearest informative neighbour shares."""
    near = [n for n in (before, after) if n is not None and n.host == page.host]
    near.sort(key=lambda n: -_prefix(n.path, page.path))
    seen = [i for i, z in enumerate(page.zones) if z != FURNITURE]
    for n in near:
        other = [x for x, z in zip(n.lines, n.zones) if z != FURNITURE]
        mine, _ = common([page.lines[i] for i in seen], other)
        if mine and len(mine) <= copy_share * max(1, min(len(seen), len(other))):
            return [seen[i] for i in mine if page.zones[seen[i]] == OPEN]
        if not mine:
            return []
    return []


def _lined(pages: DataFrame) -> DataFrame:
    """key, host, path, lines (hashes), zones of every page."""
    def run(batches):
        for b in batches:
            rows = [text_lines(t.as_py()) for t in b.column(3)]
            flat = ["".join(line.split()) for r in rows for line, _ in r]
            hashed = np.zeros(len(flat), np.int64)
            for k, h in word_hashes(flat):
                hashed[k] = h.view(np.int64)[0] if len(h) else 0
            cut = np.cumsum([0] + [len(r) for r in rows])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2),
                 pa.array([hashed[x:y] for x, y in zip(cut, cut[1:])], pa.list_(pa.int64())),
                 pa.array([[z for _, z in r] for r in rows], pa.list_(pa.int8()))],
                ["key", "host", "path", "lines", "zones"])

    return pages.select("key", "host", "path", "html").mapInArrow(
        run, "key long, host string, path string, lines array<long>, zones array<tinyint>")


def _differenced(pages: DataFrame, copy_share: float) -> DataFrame:
    """(key, drop: places of deleted lines) of pages that lose lines."""
    spark = pages.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written once, so that all uses below see the same ranges
    rows = materialize(_lined(pages).repartitionByRange(n, "host", "path", "key").withColumn("part", F.spark_partition_id()))
    row = F.struct("host", "path", "key", "lines", "zones")
    order = F.struct("host", "path", "key")
    ends = rows.groupBy("part").agg(F.min_by(row, order).alias("first"), F.max_by(row, order).alias("last"))
    along = W.orderBy("part")                                  # one row per partition
    near = ends.select("first", "last", F.lead("part").over(along).alias("up"), F.lag("part").over(along).alias("down"))
    halo = (near.select(F.col("up").alias("part"), "last.*").union(near.select(F.col("down").alias("part"), "first.*"))
            .where("part is not null").withColumn("halo", F.lit(True)))
    both = rows.withColumn("halo", F.lit(False)).unionByName(halo)

    def run(batches):
        window: list[tuple[int, Page]] = []
        keys, drops = [], []

        def step(part: int, page: Page | None) -> None:
            """A new page arrives: the last one now has both neighbours."""
            window.append((part, page))
            if len(window) > 3:
                window.pop(0)
            if len(window) >= 2 and window[-2][1] is not None and not window[-2][1].halo:
                own = window[-2][0]
                before = window[-3][1] if len(window) > 2 and window[-3][0] == own else None
                after = page if part == own else None
                drop = shared_lines(window[-2][1], before, after, copy_share)
                if drop:
                    keys.append(window[-2][1].key)
                    drops.append(drop)

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(drops, pa.list_(pa.int32()))],
                                           ["key", "drop"])
            keys.clear()
            drops.clear()
            return b

        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(7))):
                step(r[0], Page(r[1], r[2], r[3], r[4], r[5], r[6]))
            if len(keys) > 1000:
                yield out()
        step(-1, None)
        if keys:
            yield out()

    return (both.repartition(n, "part").sortWithinPartitions("part", "host", "path", "key")
            .select("part", "key", "host", "path", "lines", "zones", "halo")
            .mapInArrow(run, "key long, drop array<int>"))


def main_text(lines: list[tuple[str, int]], drop: list[int] | None) -> str:
    gone = set(drop or ())
    zone = ARTICLE if any(z == ARTICLE for _, z in lines) else OPEN
    return "\n\n".join(line for i, (line, z) in enumerate(lines) if z == zone and i not in gone)


def extract(pages: DataFrame, copy_share: float = 0.8, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Per page: id, url, text, n_chars."""
    rest = F.coalesce(F.regexp_extract(url_col, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        F.xxhash64(id_col, url_col, html_col).alias("key"),
                        F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)).alias("host"),
                        F.regexp_extract(rest, r"^[^/?#]*(.*)$", 1).alias("path"))
    drops = _differenced(rows, copy_share).groupBy("key").agg(F.max("drop").alias("drop"))
    joined = rows.select("id", "url", "html", "key").join(drops, "key", "left").select("id", "url", "html", "drop")
    id_type, url_type = (dict(rows.dtypes)[c] for c in ("id", "url"))

    def run(batches):
        for b in batches:
            texts = [main_text(text_lines(t.as_py()), d.as_py()) for t, d in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             [id_col, url_col, "text", "n_chars"])

    return joined.mapInArrow(run, f"{id_col} {id_type}, {url_col} {url_type}, text string, n_chars long")
