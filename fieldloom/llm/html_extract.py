"""Main text of web pages: structure, and differencing with the nearest URL of the host.

1. A page is read into lines, one per block element. Lines in menus, headers, footers,
   sidebars, notices, adverts, forms and reader comments are boilerplate by structure
   (inside an article or main element by names that say nothing else);
   lines in an ``article`` or ``main`` element are content; the others are undecided,
   but for those behind the first line of an article or main element, which are boilerplate
   if such elements hold at least as much text as all undecided lines.
2. Pages of a host are put in order of their URL paths. Each is compared with its
   neighbour whose path shares more leading characters (the one before, if equal) by a
   longest common subsequence of lines; undecided lines that are shared are deleted. If
   that would leave a page without any text, it is a copy of its neighbour and its
   undecided lines stay.

Neighbours are found by one global sort and an equi-join on the place in it, so a host
with very many pages is spread over all tasks.

Defined results: null and empty html give an empty text; a page without url or the only
one of its host has no neighbour; equal URLs are ordered by page id; repeated rows are
pages of their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Stage, small_side

UNDECIDED, CONTENT, BOILERPLATE = 0, 1, 2

# Element names and class words with a meaning in HTML pages.
RAW = ["script", "style", "title", "textarea", "template", "noscript", "iframe", "svg", "select", "object"]
SKIPPED = {"nav", "aside", "form", "footer", "button", "dialog", "menu", "datalist", "label"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
    "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre",
    "search", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
SPACES = {"br", "td", "th", "wbr", "img"}
IMPLIED_END = {"p", "li", "dt", "dd"}
BOILERPLATE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adbox", "adslot", "sponsor", "sponsored", "promo",
    "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "sidebar",
    "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "comment",
    "comments", "commentlist", "disqus", "respond", "share", "sharing", "social", "related", "recommended", "newsletter",
    "subscribe", "signup", "pagination", "pager", "toolbar", "banner", "complementary", "contentinfo", "search", "alert",
    "widget",
}
#: What stands beside such a word in the name of a boilerplate element, and means nothing by itself.
PLAIN_WORDS = {
    "area", "article", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "card", "center",
    "container", "content", "counts", "form", "group", "header", "heading", "icon", "icons", "inline", "inner",
    "item", "items", "label", "left", "link", "links", "list", "main", "media", "page", "panel", "post", "posts", "right",
    "row", "section", "site", "slot", "stories", "story", "text", "thread", "title", "tools", "top", "unit", "wrap",
    "wrapper",
}
HEADER_WORDS = {"header"}
NEVER_BY_CLASS = {"html", "body", "main"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(RAW)})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


def _marks(attributes: str) -> set[str]:
    if "=" not in attributes:
        return set()
    values = [m[2] or m[3] or m[4] or "" for m in _MARK.finditer(attributes)]
    return {w.lower() for v in values for w in _PARTS.findall(v)}


def _named_boilerplate(attributes: str) -> bool:
    """Is one of the names of an element all about boilerplate: ``share-buttons``, but not ``share-price``?"""
    if "=" not in attributes:
        return False
    for m in _MARK.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").split():
            parts = {p.lower().rstrip("0123456789") for p in _PARTS.findall(name)} - {""}
            if parts & BOILERPLATE_WORDS and parts <= BOILERPLATE_WORDS | PLAIN_WORDS:
                return True
    return False


def lines_of(page: str) -> list[tuple[str, int]]:
    """The lines of a page in order and what each is by structure."""
    lines: list[tuple[str, int]] = []
    held: list[str] = []
    skip, depth, by_comment = "", 0, False  # the element that is being skipped, and how deep
    inside = 0  # open article and main elements
    seen_content = False

    def close() -> None:
        nonlocal seen_content
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                kind = BOILERPLATE if skip else CONTENT if inside else UNDECIDED
                seen_content = seen_content or kind == CONTENT
                lines.append((text, kind))

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(html.unescape(page[at : m.start()]))
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        if name in SPACES:
            held.append(" ")
            continue
        ends, attributes = bool(m[2] or m[5]), m[4] or m[7] or ""
        is_block = name in BLOCKS
        if is_block:
            close()
            if skip in IMPLIED_END and (not ends or name != skip):
                skip = ""
        if skip:
            if name == skip and not attributes.endswith("/"):
                depth += -1 if ends else 1
                if depth == 0:
                    close()
                    skip = ""
                if name not in ("article", "main"):
                    continue
            if name in ("article", "main") and not ends and not by_comment and not _named_boilerplate(attributes):
                skip = ""  # the skipped element was never closed
            else:
                continue
        if name in ("article", "main"):
            if not ends and name == "article" and _named_boilerplate(attributes):
                skip, depth, by_comment = name, 1, True
                continue
            inside = max(0, inside + (-1 if ends else 1))
            continue
        if ends:
            continue
        marks = _marks(attributes)
        if inside:  # the article's own text, whatever words its names hold
            skipped = name in SKIPPED and name != "label" or _named_boilerplate(attributes)
        else:
            skipped = name in SKIPPED or name == "header" or marks & (BOILERPLATE_WORDS | HEADER_WORDS)
        if name not in NEVER_BY_CLASS and skipped:
            if not is_block:
                close()
            skip, depth, by_comment = name, 1, bool(marks & {"comment", "comments", "commentlist", "respond", "disqus"})
    if at < len(page):
        held.append(html.unescape(page[at:]))
    close()
    if not seen_content:
        return lines
    # headline and lede stand before the article; articles of little text are teasers beside the body
    sizes = {kind: sum(len(t) for t, k in lines if k == kind) for kind in (CONTENT, UNDECIDED)}
    if sizes[UNDECIDED] > sizes[CONTENT]:
        return lines
    first = next(i for i, (_, k) in enumerate(lines) if k == CONTENT)
    return [(t, BOILERPLATE if k == UNDECIDED and i > first else k) for i, (t, k) in enumerate(lines)]


def common_lines(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Places in ``a`` and ``b`` of a longest common subsequence.

    Rows of the table are bits of one number each; walking back through them finds the
    matches.
    """
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
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


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    line = pa.list_(pa.struct([("digest", pa.int64()), ("kind", pa.int8()), ("text", pa.string())]))
    for batch in batches:
        ids, urls = batch.column(0), batch.column(1)
        for low in range(0, batch.num_rows, 128):
            pages = [
                [{"digest": _digest(t), "kind": k, "text": None if k == BOILERPLATE else t} for t, k in lines_of(p or "")]
                for p in batch.column(2).slice(low, 128).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(low, 128), urls.slice(low, 128), pa.array(pages, line)], ["page_id", "url", "lines"]
            )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both sides of each pair: how many leading characters the paths share, and the shared lines."""
    for batch in batches:
        rows = []
        for a, b, path_a, path_b, lines_a, lines_b in zip(*(c.to_pylist() for c in batch.columns)):
            near = next((i for i, (x, y) in enumerate(zip(path_a, path_b)) if x != y), min(len(path_a), len(path_b)))
            in_a, in_b = common_lines(lines_a, lines_b)
            rows += [(a, near, 0, in_a), (b, near, 1, in_b)]  # for b, a is the page before
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["_row", "near", "before", "shared"]
        )


def extract_text(pages: DataFrame, stage: Stage, max_broadcast_rows: int = 100_000) -> DataFrame:
    """``page_id, url, text, n_deleted``: the main text and how many shared lines went.

    Pages from which lines go are few where sites mark their articles; their shared lines
    are broadcast up to ``max_broadcast_rows`` pages and joined by a shuffle beyond.
    """
    spark = pages.sparkSession
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html")
    )
    read = source.mapInArrow(
        _read_pages, "page_id long, url string, lines array<struct<digest:long,kind:tinyint,text:string>>"
    )
    kept = stage.numbered(read, "lines")
    address = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)(.*)$", 1)
    path = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^#]*)", 2)
    keys = kept.select(
        "_row",
        "page_id",
        F.lower(address).alias("host"),
        path.alias("path"),
        F.col("lines")["digest"].alias("digests"),
        F.exists("lines", lambda x: x["kind"] == UNDECIDED).alias("open"),
    ).where("host <> ''")
    ranged = keys.repartitionByRange("host", "path", "page_id", "_row").sortWithinPartitions("host", "path", "page_id", "_row")
    in_order = stage.table(ranged.withColumn("_at", F.monotonically_increasing_id()), "order")
    part = F.shiftright("_at", 33)
    # one row per partition of the sort
    sizes = sorted((r[0], r[1]) for r in in_order.groupBy(part).count().collect())
    offsets, total = [], 0
    for k, n in sizes:
        offsets.append((k, total))
        total += n
    starts = spark.createDataFrame(offsets, "_part long, _start long")
    placed = in_order.withColumn("_part", part).join(F.broadcast(starts), "_part").select(
        (F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias("place"), "_row", "host", "path", "digests", "open"
    )
    a, b = placed.alias("a"), placed.withColumn("place", F.col("place") - 1).alias("b")
    pairs = a.join(b, "place").where("a.host = b.host").select("a._row", "b._row", "a.path", "b.path", "a.digests", "b.digests")
    pairs = pairs.toDF("a", "b", "path_a", "path_b", "lines_a", "lines_b")
    sides = pairs.mapInArrow(_compare, "_row long, near int, before int, shared array<int>")
    nearest = sides.groupBy("_row").agg(F.max(F.struct("near", "before", "shared")).alias("n"))
    undecided = placed.where("open").select("_row")
    shared = stage.table(
        nearest.select("_row", F.col("n.shared").alias("shared")).where(F.size("shared") > 0).join(undecided, "_row", "left_semi"),
        "shared",
    )
    joined = kept.join(small_side(shared, max_broadcast_rows), "_row", "left")
    told = F.transform(
        "lines",
        lambda x, i: F.struct(
            x["text"].alias("text"),
            (x["kind"] == UNDECIDED).alias("open"),
            ((x["kind"] == UNDECIDED) & F.coalesce(F.array_contains("shared", i), F.lit(False))).alias("gone"),
        ),
    )
    seen = joined.select("page_id", "url", F.filter(told, lambda x: x["text"].isNotNull()).alias("t"))
    left = F.filter("t", lambda x: ~x["gone"])
    is_copy = F.size(left) == 0
    return seen.select(
        "page_id",
        "url",
        F.array_join(F.when(is_copy, F.col("t")).otherwise(left)["text"], "\n").alias("text"),
        F.when(is_copy, 0).otherwise(F.size("t") - F.size(left)).cast("long").alias("n_deleted"),
    )
