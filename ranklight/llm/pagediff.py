"""HTML extraction by nearest-URL page differencing.

Each page is read into text lines, one for each block of its markup.  Pages of
one host are ordered by URL path, and a page is paired with the neighbour in
that order that shares the longer leading part of the path; pages with the
same lines as itself (copies at other addresses) are passed over, since they
share its text as well.  The lines of a
pair are aligned by their longest common subsequence; what a site prints on
every page is in both, so the shared lines are deleted.

What is never a candidate: lines of elements that name themselves as something
else than the main text (menus, headers and footers of the page, sidebars,
forms, scripts, adverts, comments, by tag, role, class or id) are dropped
without a second page, and lines inside an ``article`` or ``main`` element are
kept, since two copies of an article on one host share all of them.

Only hashes of lines are shuffled and compared.  The order over hosts and
paths is one distributed sort with numbered rows, so a host of any size is
spread over many tasks; the comparison reads pairs of pages.

Defined cases: null html gives an empty text; a page alone on its host, or
without a readable URL, has no pair; where all pages of a host are copies of
one another, those without an ``article`` or ``main`` keep all lines and the
others lose what stands outside; a copy that differs in any line is a page like
others; repeated rows each get their row; an empty table gives an empty result;
markup that is cut off is read to its end; of two neighbours at equally near
addresses the one before is taken; pages of very many lines are aligned in
memory linear in the lines; further columns are ignored.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranklight.functions.index import global_row_number
from ranklight.llm.common import prepare, table, written
from ranklight.llm.registry import register

#: Zones. NAMED: dropped for its class, id or role, or a form; a main text may yet lie inside.
DROP, NAMED, OPEN, MAIN = 0, 1, 2, 3
#: Pages of a block, numbered in one task.
BLOCK_ROWS = 1 << 16

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|math|iframe|object|textarea|select|title|canvas|audio|video)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z|(?=<))"
    r"|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "div", "dl",
          "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
          "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section",
          "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
_OTHER_TAGS = {"nav", "footer", "aside", "menu", "head", "button", "dialog", "label", "datalist"}
# Elements whose end tag is often missing, or that hold no blocks: kept track of only if they open a zone.
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "dd", "del", "dfn", "dt", "em", "font", "i", "ins", "kbd",
           "li", "mark", "option", "p", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "td", "th", "time",
           "tr", "tt", "u", "var"}
_OTHER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu",
                "menubar", "form", "toolbar"}
# Words of class and id names. A name counts if it holds a word of the first
# kind and no word but those of both: "related-posts", not "related-work".
_OTHER_WORDS = (r"ads?|advert\w*|sponsor\w*|promo\w*|banners?|nav\w*|menus?|menubar|breadcrumbs?|sidebars?|side-bar|foot(?:er)?|masthead|"
                r"site-?header|page-?header|cookies?|consent|notices?|alerts?|popup|modal|newsletter|subscribe|subscription|social|shar(?:e|ing)|"
                r"related|recommend\w*|comments?|commentlist|respond|disqus|widgets?|toolbar|pagination|pager|login|signup|search|skip-?link")
_PLAIN_WORDS = (r"site|page|main|top|bottom|left|right|list|box|bar|wrap|wrapper|container|block|section|area|inner|outer|primary|secondary|"
                r"links?|items?|posts?|articles?|stories|slot|unit|form|buttons?|icons?|overlay|group|desktop|mobile|global|sticky|fixed|js|"
                r"header|title|head|panel|column|col|row|thread|\d+")
_OTHER_NAME = re.compile(rf"(?:(?:{_PLAIN_WORDS})[-_]+)*(?:{_OTHER_WORDS})(?:[-_]+(?:{_OTHER_WORDS}|{_PLAIN_WORDS}))*", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# One attribute after another, each with its value.
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+)))?")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _zone(tag: str, attrs: str, inside: int, main_seen: bool) -> int:
    """The zone an element opens within a zone."""
    if inside == DROP or tag in _OTHER_TAGS or (tag == "header" and inside != MAIN):
        return DROP
    names, main = [], tag in ("article", "main")
    for m in _ATTR.finditer(attrs) if attrs else ():
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        low = value.lower()
        if key == "hidden" or (key == "aria-hidden" and low == "true") or (key == "style" and _HIDDEN_STYLE.search(value)):
            return DROP
        if key == "role":
            main = main or low in ("main", "article")
            if low in _OTHER_ROLES:
                return NAMED
        if key in ("class", "id"):
            names += value.split()
    named = tag == "form" or (tag not in ("html", "body", "main") and any(_OTHER_NAME.fullmatch(_CAMEL.sub("-", n)) for n in names))
    if named:
        return NAMED
    if main and (inside != NAMED or tag == "main" or not main_seen):
        return MAIN
    return inside


def lines_of(html: str | None) -> list[tuple[int, str]]:
    """(zone, text) of the page's non-empty lines, in page order.  White space
    inside a line is one space, character references are decoded."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []  # open elements and the zone around each
    zone, parts, at, page, main_seen = OPEN, [], 0, html or "", False

    def flush():
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((zone, text))
            parts.clear()

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag in _BLOCK:
            flush()
        if m[2]:  # an end tag closes up to the last open element of its name
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    flush()
                    zone = stack[k][1]
                    del stack[k:]
                    break
            continue
        if tag in _BLOCK and tag != "br":  # a block ends an open paragraph
            while stack and stack[-1][0] == "p":
                zone = stack.pop()[1]
        if tag in _VOID or m[4].endswith("/"):
            continue
        new = _zone(tag, m[4], zone, main_seen)
        if new != zone or tag not in _INLINE:
            if new != zone:
                flush()
            stack.append((tag, zone))
            zone = new
            main_seen = main_seen or new == MAIN
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def _lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of x and every start of y."""
    row = np.zeros(len(y) + 1, np.int32)
    for v in x:
        # The running maximum is the usual recurrence.
        row[1:] = np.maximum(row[1:], np.where(y == v, row[:-1] + 1, 0))
        np.maximum.accumulate(row, out=row)
    return row


def _common(x: np.ndarray, y: np.ndarray, at: int, out: list[int]) -> None:
    """Append the places (from ``at``) of a longest common subsequence in x.
    Halves x and cuts y where both halves' lengths add up to most, the first
    such place on ties: memory is linear in the lines."""
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if b - a == 1:
            if (y[c:d] == x[a]).any():
                out.append(at + a)
            continue
        mid = (a + b) // 2
        cut = c + int(np.argmax(_lengths(x[a:mid], y[c:d]) + _lengths(x[mid:b][::-1], y[c:d][::-1])[::-1]))
        todo += [(mid, b, cut, d), (a, mid, c, cut)]  # the first half is next


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of a and b."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    x, y = np.asarray(a[lo:len(a) - hi]), np.asarray(b[lo:len(b) - hi])
    keep = np.isin(x, y)  # lines of one page only cannot be shared
    places, y = np.flatnonzero(keep) + lo, y[np.isin(y, x)]
    middle: list[int] = []
    _common(x[keep], y, 0, middle)
    return [*range(lo), *places[middle].tolist(), *range(len(a) - hi, len(a))]


def _hash(text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _outline(batches):
    """(key, url, open lines, hashes of all lines that are not dropped)."""
    for batch in batches:
        opens, hashes = [], []
        for page in batch.column(2):
            found = [(z, _hash(t)) for z, t in lines_of(page.as_py()) if z >= OPEN]
            opens.append([i for i, (z, _) in enumerate(found) if z == OPEN])
            hashes.append([x for _, x in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(opens, pa.list_(pa.int32())),
             pa.array(hashes, pa.list_(pa.int64()))], names=["key", "url", "open", "lines"])


def _compare(batches):
    for batch in batches:
        keys, drops = [], []
        for key, opens, a, b in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            drop = sorted(set(shared_lines(a, b)) & set(opens))
            if drop:
                keys.append(key)
                drops.append(drop)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(drops, pa.list_(pa.int32()))], names=["key", "drop"])


def _text(batches):
    for batch in batches:
        texts = []
        for page, drop in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
            gone = set(drop or ())
            kept = [t for z, t in lines_of(page.as_py()) if z >= OPEN]
            texts.append("\n".join([t for i, t in enumerate(kept) if i not in gone]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                         names=["page_id", "url", "text"])


def _keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html and a key of the page's content and address."""
    p = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return p.withColumn("key", F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))))


def _runs(numbered: DataFrame) -> DataFrame:
    """The numbered pages with ``run``: neighbours on one host that have the
    same lines are one run, runs are numbered in page order."""
    before = numbered.select((F.col("row_num") + 1).alias("row_num"), F.col("host").alias("host_0"), F.col("content").alias("content_0"))
    same = F.coalesce((F.col("host") == F.col("host_0")) & (F.col("content") == F.col("content_0")), F.lit(False))
    marked = written(numbered.join(before, "row_num", "left")
                     .select("key", "host", "path", "row_num", F.when(same, 0).otherwise(1).alias("begins"),
                             F.floor(F.col("row_num") / BLOCK_ROWS).alias("block")), "page-begins")
    # One row a block, so a one-task window is fine here.
    counts = marked.groupBy("block").agg(F.sum("begins").alias("n"))
    ahead = counts.select("block", (F.sum("n").over(Window.orderBy("block")) - F.col("n")).alias("ahead"))
    w = Window.partitionBy("block").orderBy("row_num")
    return (marked.withColumn("run", F.sum("begins").over(w)).join(F.broadcast(ahead), "block")
            .select("key", "host", "path", "row_num", (F.col("run") + F.col("ahead")).alias("run")))


def shared_with_neighbour(pages: DataFrame) -> DataFrame:
    """(key, drop): the undecided lines that a page shares with the nearest
    differing page of its host, for pages that have such lines."""
    outline = _keyed(pages).select("key", "url", "html").mapInArrow(
        _outline, "key long, url string, open array<int>, lines array<long>")
    outline = written(outline.dropDuplicates(["key"]), "page-lines")
    bare = F.regexp_replace(F.lower("url"), "^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(bare, r"^(?:[^/?#]*@)?([^/?#:]+)", 1)
    path = F.regexp_extract(bare, r"^[^/?#]*([^?#]*)", 1)
    placed = (outline.withColumn("host", host).withColumn("path", path).where("url is not null and host != ''")
              .select("key", "host", "path", F.xxhash64("lines").alias("content")))
    numbered = written(global_row_number(placed, ["host", "path", "key"])
                       .select("key", "host", "path", "content", "row_num"), "page-order")
    runs = written(_runs(numbered), "page-runs")
    page = F.struct("row_num", "key", "host", "path")
    ends = written(runs.groupBy("run").agg(F.min(page).alias("head"), F.max(page).alias("tail")), "page-run-ends")
    side = lambda end, step, n, some=ends: some.select((F.col("run") + step).alias("run"), F.col(f"{end}.key").alias("near"),
                                                       F.col(f"{end}.host").alias("host_2"), F.col(f"{end}.path").alias("path_2"), F.lit(n).alias("side"))
    # Leading path segments that two pages share.
    same = F.zip_with(F.split("path", "/"), F.split("path_2", "/"), lambda a, b: a.eqNullSafe(b))
    other = F.array_position(same, False)
    # The last choice is a copy (side 2).
    common = F.when(F.col("side") == 2, -1).when(other == 0, F.size(same)).otherwise(other - 1)
    both = side("tail", 1, 0).union(side("head", -1, 1)).union(side("head", 0, 2, ends.where("head.row_num < tail.row_num")))
    near = (runs.join(both, "run").where("host = host_2")
            .groupBy("key").agg(F.max(F.struct(common.alias("common"), (-F.col("side")).alias("side"), "near")).alias("found"))
            .select("key", "found.near", (F.col("found.common") < 0).alias("copy")))
    # Only pages with undecided lines need a neighbour's; a copy tells only what stands outside a main text.
    a = (outline.where("size(open) > 0").select("key", "open", "lines").join(near, "key")
         .where("not copy or size(open) < size(lines)"))
    pairs = a.join(outline.select(F.col("key").alias("near"), F.col("lines").alias("lines_2")), "near")
    return pairs.select("key", "open", "lines", "lines_2").mapInArrow(_compare, "key long, drop array<int>")


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text."""
    prepare(pages, "page_id", "url", "html")
    drops = written(shared_with_neighbour(pages), "page-drops")
    # Few pages have lines to delete; Spark sends a small table of them to all tasks.
    joined = _keyed(pages).join(drops, "key", "left").select("page_id", "url", "html", "drop")
    return joined.mapInArrow(_text, "page_id long, url string, text string")


@register("op7_page_differencing")
def op7_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
