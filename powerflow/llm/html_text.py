"""Main text of web pages by page differencing.

Pages are sorted by host and path, and each is compared with the nearest others there. What two
pages of one place share in the same order, their longest common subsequence of text lines, is the
site's and not the article's, and is deleted. Lines inside elements that are no article by their
own markup (menus, forms, adverts, comments and the like) go first.

Inside an article element shared lines go from its begin and its end on, if all of the up to four pages near share them:
articles quote the same passages, and fewer pages would drop main text. Lines beside the article are text if they are the page's own and more than it.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from powerflow.llm.common import arrow_schema, text_key
from powerflow.llm.url_filter import host_and_path
from powerflow.operators.grouping import fact_join
from powerflow.session import written

COPY_SHARE = 0.9  # pages that share so many lines of both may be copies
_KEPT = "host string, digest binary, kept binary"
OFTEN = 16  # pairs of equal lines, for each line of two pages, above which bits align them
BLOCK_PLACES = 256  # places compared in one group; two more on either side are read with them

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|object|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[a-zA-Z/!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul button select".split()
)
_FRAME_TAGS = frozenset("nav aside footer form fieldset dialog menu head button select".split())
# block elements that a paragraph may hold
_PHRASE = frozenset(("br", "button", "select"))
_CONTENT_TAGS = frozenset(("article", "main"))
# words of class names, ids and roles that mark what is no article, if no other word stands with them but for places and parts
_FRAME_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments commentlist "
    "complementary consent contentinfo cookie cookies dialog disqus footer footnav form gdpr login masthead menu modal nav "
    "navbar navigation newsletter notice overlay pagination pager popup promo related reply respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
_PLACES = frozenset(
    "area bar block bottom box button buttons column container content form global group header icons inline inner item items "
    "left link links list main outer page panel post posts primary right row secondary section site slot thread top wrap wrapper".split()
)
# an element of these names that opens again ends the one before it
_SELF_CLOSING = frozenset("p li dt dd tr td th option".split())


@dataclass
class Page:
    """Text lines of a page in order, and for each whether it is frame or within an article."""

    lines: list[str] = field(default_factory=list)
    frame: list[bool] = field(default_factory=list)
    inside: list[bool] = field(default_factory=list)


def _names_frame(name: str) -> bool:
    """A sidebar box or an ad slot 3, but not the social history that an article has a section on."""
    words = {part.lower() for part in _NAME_PART.findall(name)}
    return not words.isdisjoint(_FRAME_NAMES) and all(w in _FRAME_NAMES or w in _PLACES or w.isdigit() for w in words)


def _is_frame(tag: str, more: str, in_content: bool) -> bool:
    if tag in _FRAME_TAGS or tag == "header" and not in_content:
        return True
    if not more or more.isspace():
        return False
    for name, *values in _ATTRIBUTE.findall(more):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
        if name in ("class", "id", "role") and tag not in ("body", "html", "article", "main"):
            if any(map(_names_frame, value.split())):
                return True
            if not in_content and "header" in value.lower():
                return True
    return False


def parse(html: str) -> Page:
    """Lines of a page. Unclosed and stray tags are taken as browsers take them."""
    page = Page()
    stack: list[tuple[str, bool, bool]] = []  # tag, within a frame, within an article
    parts: list[str] = []

    def flush() -> None:
        line = " ".join(unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if line:
            _, frame, inside = stack[-1] if stack else ("", False, False)
            page.lines.append(line)
            page.frame.append(frame)
            page.inside.append(inside)

    def close(tag: str) -> None:
        for at in range(len(stack) - 1, -1, -1):
            if stack[at][0] == tag:
                del stack[at:]
                return
            if stack[at][0] in _CONTENT_TAGS and tag not in _BLOCK | _CONTENT_TAGS:
                return

    for token in _TOKEN.finditer(html):
        if (text := token["text"]) is not None:
            parts.append(text)
            continue
        if (tag := token["tag"]) is None:
            if token["raw"] is not None and token["raw"].lower() in ("title", "textarea"):
                flush()
            continue
        tag = tag.lower()
        if tag in _BLOCK:
            flush()
        if token["end"]:
            close(tag)
            continue
        if tag in _VOID:
            continue
        if tag in _SELF_CLOSING:
            nested = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in (tag, "ul", "ol", "table", "dl", "div", "article")), None)
            if nested is not None and stack[nested][0] == tag:
                del stack[nested:]
        if stack and stack[-1][0] == "p" and tag in _BLOCK and tag not in _PHRASE:
            stack.pop()
        _, frame, inside = stack[-1] if stack else ("", False, False)
        more = token["more"].rstrip("/") if token["more"] else ""
        content = tag in _CONTENT_TAGS
        stack.append((tag, frame or _is_frame(tag, more, inside), (inside or content) and not frame))
    flush()
    return page


def aligned(left: list, right: list) -> set[int]:
    """Indices in ``left`` of a longest common subsequence of two lists of lines.

    Work and memory follow the pairs of equal lines; where lines that repeat make too many of them, rows of bits find the same indices.
    """
    places: dict = {}
    for j, line in enumerate(right):
        places.setdefault(line, []).append(j)
    if sum(len(places.get(line, ())) for line in left) > OFTEN * (len(left) + len(right)):
        return _aligned_by_bits(left, places, len(right))
    tails: list[int] = []  # smallest end in ``right`` of a common subsequence of each length
    nodes: list[tuple[int, tuple | None]] = []
    for i, line in enumerate(left):
        for j in reversed(places.get(line, ())):
            at = bisect_left(tails, j)
            node = (i, nodes[at - 1] if at else None)
            if at == len(tails):
                tails.append(j)
                nodes.append(node)
            elif j < tails[at]:
                tails[at], nodes[at] = j, node
    found: set[int] = set()
    node = nodes[-1] if nodes else None
    while node is not None:
        found.add(node[0])
        node = node[1]
    return found


def _aligned_by_bits(left: list, places: dict, width: int) -> set[int]:
    """What ``aligned`` finds, with its ``tails`` as the zero bits of one number for each line of ``left``.

    A line costs a few operations on ``width`` bits, however often it occurs. The way back needs all rows: every so many are
    kept, and those between are computed again.
    """
    every = (1 << width) - 1
    used = [i for i, line in enumerate(left) if line in places]
    step = isqrt(len(used)) + 1

    @lru_cache(maxsize=16)
    def occurrences(line) -> int:
        bits = np.zeros(width, np.uint8)
        bits[places[line]] = 1
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")

    def rows(first: int, row: int) -> list[int]:
        found = [row]
        for i in used[first : first + step]:
            common = row & occurrences(left[i])
            row = (row + common | row - common) & every
            found.append(row)
        return found

    row, kept = every, []
    for first in range(0, len(used), step):
        kept.append((first, row))
        row = rows(first, row)[-1]
    found: set[int] = set()
    end = (every ^ row).bit_length() - 1
    while kept and end >= 0:
        first, row = kept.pop()
        before = rows(first, row)
        for at in range(len(before) - 2, -1, -1):
            if end >= 0 and before[at] >> end & 1:  # this line brought the end, so the one next to it is the end before
                found.add(used[first + at])
                end = ((every ^ before[at]) & ((1 << end) - 1)).bit_length() - 1
    return found


def _shared(lines: list, sizes: list[int], others: Iterable[list]) -> Iterator[set[int]]:
    """For each other page that shows the frame, the places of what it shares.

    A page that leaves nothing of ``lines`` shows no frame. One that has nearly all lines of both is a copy if the
    lines left are shorter than the shared ones: what differs between copies is a date or a number, what differs
    between articles in a long menu is the article.
    """
    for other in others:
        shared = aligned(lines, other)
        left = len(lines) - len(shared)
        if not left:
            continue
        if len(shared) >= COPY_SHARE * max(len(lines), len(other)):
            own = sum(size for i, size in enumerate(sizes) if i not in shared)
            if own * len(shared) < (sum(sizes) - own) * left:
                continue
        yield shared


def kept_lines(lines: list, sizes: list[int], inside: list[bool], others: Iterable[list]) -> list[int]:
    """Places of the main text among a page's open lines, or their hashes, given those of other pages, the nearest first."""
    found = _shared(lines, sizes, others)
    shared = next(found, set())
    own = [i for i in range(len(lines)) if i not in shared]
    if not any(inside):
        return own
    # articles quote each other, so within one it takes all pages near, two at least, and a place where no text stands outwards
    both, pages = set(shared), 1
    while both and (other := next(found, None)) is not None:
        both, pages = both & other, pages + 1
    both = both if pages > 1 else set()
    article = [i for i, within in enumerate(inside) if within]
    first, last = 0, len(article)
    while first < last and article[first] in both:
        first += 1
    while last > first and article[last - 1] in both:
        last -= 1
    article = article[first:last] or article
    beside = [i for i in own if not inside[i]] if shared else []
    if sum(sizes[i] for i in beside) > sum(sizes[i] for i in article):
        return sorted(article + beside)  # a teaser: most of what is the page's own is beside it
    return article


def main_text(page: Page, neighbours: list[Page]) -> str:
    """Text of a page, given its neighbours from the nearest on."""
    lines, inside = open_lines(page)
    kept = kept_lines(lines, [len(line) for line in lines], inside, [open_lines(other)[0] for other in neighbours])
    return " ".join(lines[i] for i in kept)


def open_lines(page: Page) -> tuple[list[str], list[bool]]:
    """Lines that the markup does not name as frame, and whether each is within an article."""
    open_ = [i for i, frame in enumerate(page.frame) if not frame]
    return [page.lines[i] for i in open_], [page.inside[i] for i in open_]


def _common_prefix(left: str, right: str) -> int:
    n = min(len(left), len(right))
    return next((i for i in range(n) if left[i] != right[i]), n)


def _hashes(lines: list[str]) -> bytes:
    return b"".join(hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=8).digest() for line in lines)


def _numbers(hashes: bytes) -> list[int]:
    return np.frombuffer(hashes, "<u8").tolist()


def page_lines(rows: DataFrame) -> DataFrame:
    """Hashes of the open lines of each different html of a host, with its least path as ``place``.

    ``shape`` has for each line its length and whether it is within an article.
    """
    schema = "host string, path string, digest binary, lines binary, shape binary"
    arrow = arrow_schema(schema)

    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [open_lines(parse(html.as_py())) for html in batch.column("html")]
            shapes = [np.array([2 * len(line) + i for line, i in zip(*page, strict=True)], "<u4").tobytes() for page in found]
            columns = [batch.column(name) for name in ("host", "path", "digest")]
            columns += [pa.array([_hashes(lines) for lines, _ in found], pa.binary()), pa.array(shapes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    found = rows.select("host", "path", "digest", "html").mapInArrow(lines_of, schema)
    return found.groupBy("host", "digest").agg(
        F.min("path").alias("place"), F.first("lines").alias("lines"), F.first("shape").alias("shape")
    )


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the lines that stay, from ``lines``, ``shape``, ``place`` and ``near``."""
    for batch in batches:
        out = []
        for lines, shape, place, near in zip(*(batch.column(name) for name in ("lines", "shape", "place", "near")), strict=True):
            shape, place = np.frombuffer(shape.as_py(), "<u4"), place.as_py()
            order = sorted((page for page in near.as_py() if page), key=lambda page: -_common_prefix(page["place"], place))
            kept = np.zeros(len(shape), dtype=bool)
            others = (_numbers(page["lines"]) for page in order)
            kept[kept_lines(_numbers(lines.as_py()), (shape >> 1).tolist(), (shape & 1).astype(bool).tolist(), others)] = True
            out.append(np.packbits(kept).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("digest"), pa.array(out, pa.binary())], names=["host", "digest", "kept"])


def lines_kept(contents: DataFrame) -> DataFrame:
    """Bits ``kept`` of the lines of each content, by comparison with the two places of its host before it and the two after it.

    A place has one content, of several that with the least digest: they are versions of one page. Places are sorted in
    ranges of (host, path) and numbered through, and blocks of numbers compared with the places beside them, so a host of any
    size is spread over tasks and no cut shows. Lines of the pages near are put beside a page's only after the last shuffle.
    """
    places = contents.groupBy("host", "place").agg(F.min(F.struct("digest", "lines", "shape")).alias("least"), F.count("*").alias("versions"))
    places = places.select("host", "place", "least.*", "versions")
    ranges = places.repartitionByRange("host", "place").sortWithinPartitions("host", "place")
    ranges = written(ranges.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("row")), "page-places")
    sizes = ranges.groupBy("range").agg(F.min(F.struct("host", "place")).alias("begin"), F.min("row").alias("least_row"), F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("begin").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows")
    # one row of a range, so one task orders them all
    numbers = written(sizes.select("range", (before - F.col("least_row")).alias("shift")), "page-ranges")
    numbered = ranges.join(numbers, "range").select(*places.columns, (F.col("row") + F.col("shift")).alias("row"))
    blocks = [F.floor((F.col("row") + n) / BLOCK_PLACES) for n in (0, -2, 2)]
    blocks = numbered.select("*", blocks[0].alias("home"), F.explode(F.array_distinct(F.array(*blocks))).alias("block"))
    within = Window.partitionBy("block").orderBy("row")
    own = F.struct("host", "place", "lines")
    steps = {"b1": (F.lag, 1), "a1": (F.lead, 1), "b2": (F.lag, 2), "a2": (F.lead, 2)}
    joined = blocks.select("*", *[move(own, n).over(within).alias(name) for name, (move, n) in steps.items()]).filter("block = home")
    near = [F.when(F.col(f"{name}.host") == F.col("host"), F.struct(f"{name}.place", f"{name}.lines")) for name in steps]
    joined = joined.withColumn("near", F.array(*near))
    wanted = ("host", "digest", "lines", "shape", "place", "near")
    found = joined.select(*wanted)
    if not ranges.filter("versions > 1").isEmpty():
        several = joined.filter("versions > 1").select("host", "place", F.col("digest").alias("least"), "near")
        found = found.union(fact_join(contents, several, ["host", "place"], "inner").filter("digest <> least").select(*wanted))
    return found.mapInArrow(_decide, _KEPT)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id``, ``url`` and ``text`` of each row.

    Pages of a host with the same html are one page at their least path, so copies have one text and are not compared with
    each other. Only hashes of lines are compared, so html is not moved, and the open text once. NULL and empty html have
    an empty text; rows without a host are pages of one nameless host.
    """
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
        html.alias("html"), host.alias("host"), path.alias("path"), text_key(html).alias("digest"),
    )
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("id", "url")}
    parsed = f"id {kinds['id']}, url {kinds['url']}, host string, digest binary, lines string"
    schema = f"id {kinds['id']}, url {kinds['url']}, text string"
    parsed_arrow, arrow = arrow_schema(parsed), arrow_schema(schema)

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = ["\n".join(open_lines(parse(html.as_py()))[0]) for html in batch.column("html")]
            columns = [batch.column(name).cast(parsed_arrow.field(name).type) for name in ("id", "url", "host", "digest")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], schema=parsed_arrow)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lines, kept in zip(batch.column("lines"), batch.column("kept"), strict=True):
                bits = np.unpackbits(np.frombuffer(kept.as_py(), np.uint8)).tolist()
                out.append(" ".join(line for line, bit in zip(lines.as_py().split("\n"), bits, strict=False) if bit))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(out, pa.string())], schema=arrow)

    kept = lines_kept(written(page_lines(rows), "page-lines"))
    moved = rows.select("id", "url", "html", "host", "digest").mapInArrow(texts_of, parsed)
    joined = fact_join(moved, kept, ["host", "digest"], "left")
    return joined.select("id", "url", "lines", "kept").mapInArrow(texts, schema)
