"""Main text of web pages: page structure, and the difference to the page of the nearest URL.

A page is read as a sequence of lines, one per block, each with the zone it stands in. Elements that are not content by
their name, role or class (menus, headers, footers, sidebars, adverts, notices, forms, comments, scripts, styles) make
up one zone; what the page marks as its article (`article`, else `main`, else `articleBody`) another.

Nearest-URL differencing finds what has no mark. Pages are sorted by host and path over the whole table, so that a page
stands beside those whose paths share the most with its own. Its lines are aligned with those of the nearer of its two
neighbours by longest common subsequence, and lines in the common part are template: they are deleted. Two limits:
a neighbour that shares more than half of the text is a copy, not a template, and the other neighbour is taken
instead; and inside a marked article, a paragraph, heading or list item that two articles share can be text of both, so
lines that are not in bare containers (`div`, `span`, `a`, ...) are deleted only if `SHARED_BY` pages of the host have them.

Pages of a host with equal lines are one page for the pairing; pages without a line take no part in it. Hosts of any size are cut by the range partitioning. Null
or empty html gives an empty text; a null URL or one without "://" counts as host and path "". Repeated rows give
repeated results. Html that is cut off or badly nested is read as far as it goes. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm import urls
from carelake.llm.common import Scratch, arrow
from carelake.llm.kernels import pieces
from carelake.operators.joins import join_summary

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes svg math object".split())
CHROME = frozenset("nav footer aside form menu dialog button select datalist label fieldset".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split())
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre td th caption figcaption".split())
CLOSED_BY_SELF = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"),
                  "th": ("tr", "table"), "option": ("select",)}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
#: Parts of a class or id that name what is not content.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside masthead topbar footer cookie cookies "
    "consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login search "
    "comment comments commentlist disqus respond replies share sharing social related recommended recommendations "
    "trending widget widgets pagination pager toolbar skip".split())
WRAPPERS = frozenset("html body main".split())
NEGATED = frozenset("no has with without".split())

#: Pages of a host, unlike in their lines, that have to share a paragraph of their articles before it can be template.
SHARED_BY = 5

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

OUTSIDE, PLAIN, ARTICLE, MAIN, BODY = 0, 1, 2, 4, 8


def _zone(name: str, attributes: str, above: int) -> int:
    """Zone of an element, from that of its parent."""
    if above == OUTSIDE or name in CHROME:
        return OUTSIDE
    inside = above & (ARTICLE | MAIN)
    if name == "header" and not inside:
        return OUTSIDE
    zone = above
    if name == "article":
        zone |= ARTICLE
    if name == "main":
        zone |= MAIN
    if not attributes or attributes.isspace():
        return zone
    told = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    role = told.get("role", "").lower()
    if role == "main":
        zone |= MAIN
    if role == "article":
        zone |= ARTICLE
    if "articlebody" in told.get("itemprop", "").lower():
        zone |= BODY
    if name in WRAPPERS:
        return zone
    if role in ROLES or "hidden" in told or told.get("aria-hidden", "").lower() == "true":
        return OUTSIDE
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", told.get("style", ""), re.I):
        return OUTSIDE
    for value in (told.get("class", ""), told.get("id", "")):
        for one in value.lower().split():
            parts = set(re.split(r"[^a-z0-9]+", one))
            if parts & NAMES and not parts & NEGATED:
                return OUTSIDE
            if "header" in parts and not inside and not parts & {"article", "post", "entry", "story"}:
                return OUTSIDE
    return zone


def lines(html: str | None) -> list[tuple[str, int, bool]]:
    """(text, zone, in flowing text) of every block with text, in page order."""
    out: list[tuple[str, int, bool]] = []
    if not html:
        return out
    stack: list[tuple[str, int, bool]] = [("", PLAIN, False)]
    held: list[str] = []

    def close() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, stack[-1][1], stack[-1][2]))

    def pop_to(name: str, stops: frozenset | tuple) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == name:
                del stack[k:]
                return
            if stack[k][0] in stops:
                return

    at = 0
    while (m := TOKEN.match(html, at)) is not None:
        at = m.end()
        name = m[2]
        if name is None:
            token = m[0]
            if token[0] != "<" or token == "<":
                held.append(token)
            elif token.startswith("<![CDATA["):
                held.append(entities.escape(token[9:-3]))
            continue
        name = name.lower()
        before = stack[-1][1]
        if name in BLOCK:
            close()
        if m[1]:
            if stack[-1][1] != before or name not in BLOCK:
                # the end of an inline element does not reach beyond the block it stands in
                inner = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name or stack[k][0] in BLOCK), 0)
                if inner and stack[inner][0] == name:
                    if any(z[1] != stack[inner - 1][1] for z in stack[inner:]):
                        close()
                    del stack[inner:]
            else:
                pop_to(name, ())
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            if not m[3].rstrip().endswith("/") or name in ("script", "style", "title", "textarea"):
                at = end.end() if end else len(html)
            continue
        if name in VOID:
            continue
        if name in BLOCK and any(s[0] == "p" for s in stack[1:]):
            pop_to("p", ("button", "table", "td", "th", "caption", "object"))
        if name in CLOSED_BY_SELF:
            pop_to(name, CLOSED_BY_SELF[name])
        zone = _zone(name, m[3], stack[-1][1])
        if zone != stack[-1][1]:
            close()
        stack.append((name, zone, name in FLOW or (stack[-1][2] and name not in BLOCK)))
    close()
    return out


def content(parsed: list[tuple[str, int, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """(lines that are content by structure, those of them that differencing may delete however few pages share them)."""
    zones = np.array([z for _, z, _ in parsed], np.int64)
    flow = np.array([f for _, _, f in parsed], bool)
    for mark in (ARTICLE, MAIN, BODY):
        inside = (zones & mark) > 0
        if inside.any():
            return inside, inside & ~flow
    plain = zones != OUTSIDE
    return plain, plain


def common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, by bit-parallel rows: one addition per line of `a`."""
    left = [(i, x) for i, x in enumerate(a) if x in set_b] if (set_b := set(b)) else []
    set_a = {x for _, x in left}
    right = [(j, x) for j, x in enumerate(b) if x in set_a]
    if not left:
        return []
    full = (1 << len(right)) - 1
    masks: dict[int, int] = {}
    for j, (_, x) in enumerate(right):
        masks[x] = masks.get(x, 0) | 1 << j
    rows, v = [], full
    for _, x in left:
        u = v & masks[x]
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    i, j, out = len(left), len(right), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append((left[i][0], right[j][0]))
    return out[::-1]


def template(own: list[int], sizes: list[int], counts: list[bool], may: list[bool],
             others: list[tuple[str, list[int]]], path: str) -> list[int]:
    """Lines to delete: those shared with the nearest of `others` (path, lines) that is not a copy of the page."""
    total = sum(s for s, c in zip(sizes, counts, strict=True) if c)

    def nearness(other: str) -> int:
        n = 0
        for x, y in zip(path, other, strict=False):
            if x != y:
                break
            n += 1
        return -n

    for _, lines_ in sorted(others, key=lambda o: nearness(o[0])):
        shared = [i for i, _ in common(own, lines_)]
        if 2 * sum(sizes[i] for i in shared if counts[i]) <= total:
            return [i for i in shared if may[i]]
    return []


def _key(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("key"))


def outlines(pages: DataFrame) -> DataFrame:
    """Per page with a line that differencing may delete or compare: host, path, and hash, size and kind of its lines."""

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in pieces(batch, "html", 4 << 20):
                hashes, sizes, kinds = [], [], []
                for page in run.column("html").to_pylist():
                    parsed = lines(page)
                    is_content, may = content(parsed)
                    hashes.append([xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) - (1 << 63) for t, _, _ in parsed])
                    sizes.append([len(t) for t, _, _ in parsed])
                    kinds.append((is_content + 2 * may).tolist())
                yield pa.RecordBatch.from_arrays([
                    run.column("key"), run.column("host"), run.column("path"), pa.array(hashes, pa.list_(pa.int64())),
                    pa.array(sizes, pa.list_(pa.int32())), pa.array(kinds, pa.list_(pa.int32()))],
                    names=["key", "host", "path", "hashes", "sizes", "kinds"])

    rows = _key(pages).select("key", urls.host(F.col("url")).alias("host"), urls.path(F.col("url")).alias("path"), "html")
    return arrow(rows, outline, "key long, host string, path string, hashes array<bigint>, sizes array<int>, kinds array<int>")


def often_shared(placed: DataFrame) -> DataFrame:
    """Per host and outline: the flowing lines of its article that `SHARED_BY` outlines of the host have."""
    flowing = F.filter(F.arrays_zip("hashes", "kinds"), lambda x: x["kinds"] == 1)
    rows = placed.select("host", "same", F.explode(F.array_distinct(F.transform(flowing, lambda x: x["hashes"]))).alias("line"))
    shared = rows.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SHARED_BY).drop("n")
    return join_summary(rows, shared, ["host", "line"], "inner").groupBy("host", "same").agg(F.collect_set("line").alias("often"))


def deletions(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """`key` of a page and `gone`, the numbers of its template lines; pages without any are left out."""
    every = scratch.keep(outlines(pages).withColumn("same", F.xxhash64("host", "hashes")), "outlines")
    one = every.where(F.size("hashes") > 0).groupBy("host", "same").agg(
        F.min(F.struct("path", "key", "hashes", "sizes", "kinds")).alias("o")).select("host", "same", "o.*")
    # Numbered over the whole table: place in the partition plus the sizes of the partitions before.
    ordered = one.repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key")
    placed = scratch.keep(ordered.withColumn("id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("id", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.withColumn("part", part).join(sizes.select("part", ahead.alias("ahead")), "part").withColumn(
        "nth", F.col("ahead") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1)))
    kinds = F.zip_with("kinds", "hashes", lambda k, h: F.when((k == 1) & F.array_contains("often", h), 3).otherwise(k))
    numbered = numbered.join(often_shared(placed), ["host", "same"], "left").withColumn(
        "kinds", F.when(F.col("often").isNull(), F.col("kinds")).otherwise(kinds))
    numbered = scratch.keep(numbered.select("nth", "same", "host", "path", "hashes", "sizes", "kinds"), "numbered")
    beside = [numbered.select((F.col("nth") + step).alias("nth"), F.col("host").alias(f"host_{s}"),
                              F.col("path").alias(f"path_{s}"), F.col("hashes").alias(f"hashes_{s}"))
              for s, step in (("before", 1), ("after", -1))]
    rows = numbered.where(F.exists("kinds", lambda k: k >= 2))
    for other in beside:
        rows = rows.join(other, "nth", "left")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                others = [(r[f"path_{s}"], r[f"hashes_{s}"]) for s in ("before", "after") if r[f"host_{s}"] == r["host"]]
                kinds = r["kinds"]
                gone = template(r["hashes"], r["sizes"], [k % 2 == 1 for k in kinds], [k >= 2 for k in kinds], others, r["path"])
                if gone:
                    found.append((r["host"], r["same"], gone))
            yield pa.RecordBatch.from_arrays([
                pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()),
                pa.array([f[2] for f in found], pa.list_(pa.int32()))], names=["host", "same", "gone"])

    masks = scratch.keep(arrow(rows, align, "host string, same long, gone array<int>"), "masks")
    out = every.select("key", "host", "same").distinct().join(masks, ["host", "same"])
    return scratch.keep(out.select("key", "gone").dropDuplicates(["key"]), "deletions")


def main_text(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """`page_id`, `url`, `text` and `n_chars` of every page."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in pieces(batch, "html", 4 << 20):
                texts = []
                for page, gone in zip(run.column("html").to_pylist(), run.column("gone").to_pylist(), strict=True):
                    parsed = lines(page)
                    keep, _ = content(parsed)
                    keep[gone or []] = False
                    texts.append(" ".join(parsed[i][0] for i in np.flatnonzero(keep)))
                yield pa.RecordBatch.from_arrays(
                    [run.column("page_id"), run.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    gone = deletions(pages, scratch)
    rows = _key(pages).join(gone, "key", "left").select("page_id", "url", "html", "gone")
    kind = dict(pages.dtypes)["page_id"]
    return arrow(rows, extract, f"page_id {kind}, url string, text string, n_chars long")
