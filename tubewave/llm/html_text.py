"""Main text of web pages: the contiguous run of words and tags with the largest sum of weights."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_name, slices, texts_of, with_schema

#: Most labelled pages that weights are learned from, and most kinds of tags that get a weight of their own.
TRAINING_PAGES, MOST_TAGS = 500, 300
#: Used where no page is labelled.
DEFAULT_WEIGHTS = {"": 1.0, "a": -2.0, "li": -1.0, "ul": -1.0} | dict.fromkeys("p b i em strong br h1 h2 h3 span header blockquote code".split(), -0.05)
#: For tags without a weight; words weigh this much at least; tags weigh this much at most.
OTHER_TAG, LEAST_WORD, MOST_TAG = -0.25, 0.2, -0.01
#: Inside an ``article`` or ``main`` element no tag weighs less than this.
CONTENT_TAG = -0.05

# Names of elements, and parts of class, id and role names, as pages use them.
RAW = "script style textarea title".split()
#: Elements that hold something else than main text; one that is never closed, or closed by "/>", holds nothing.
EMBEDDED = set("noscript template svg iframe object select button canvas audio video".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
ASIDE = set("nav header footer aside form menu dialog head".split())
CONTENT = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
COMMENTS = set("comment comments commentlist disqus respond replies discussion".split())
NAMES = COMMENTS | set(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner sidebar widget widgets nav navbar navigation menu breadcrumb breadcrumbs"
    " pagination pager toolbar footer header masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription paywall share sharing"
    " social related recommended recommendations contentinfo complementary search login signup skip".split()
)

_RAW = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<({'|'.join(RAW)})(?=[\s/>])(?:[^>]*+(?<=/)>(?![^<]*+</\1)|[^>]*+>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z))",
    re.S | re.I,
)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?>[^>"']|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""")
_EMBEDDED_END = re.compile(rf"</({'|'.join(sorted(EMBEDDED))})(?=[\s/>])", re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*+=\s*+["']?true|display\s*+:\s*+none""", re.I)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


def _skipped(name: str, attributes: str, in_content: bool) -> bool:
    """Whether an element holds something other than main text, by its name, class, id or role."""
    if name in ASIDE:
        return not (name == "header" and in_content)
    if name in CONTENT or name in ("html", "body"):
        return name in CONTENT and bool(_name_parts(attributes) & COMMENTS)
    if not attributes:
        return False
    return bool(_name_parts(attributes) & NAMES) or bool(_HIDDEN.search(attributes))


def _name_parts(attributes: str) -> set[str]:
    return {part.lower() for m in _NAMES.finditer(attributes) for part in _PARTS.findall(m[2] or m[3] or m[4] or "")}


def tokens(page: str) -> list[tuple[str, str, bool, bool]]:
    """Tags and texts in page order as ``(tag name or "", text, in skipped element, in article or main element)``."""
    out: list[tuple[str, str, bool, bool]] = []
    # a raw element keeps what it is: words on its two sides are not one word
    page = _RAW.sub(lambda m: " " if m[1] else "", page)
    last_end = {m[1].lower(): m.start() for m in _EMBEDDED_END.finditer(page)}
    stack: list[tuple[str, bool]] = []  # open elements that count: name, whether it starts a skipped part
    skip = content = at = 0
    header = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            out.append(("", page[at : m.start()], skip > 0 or (header > 0 and not _in_heading(stack)), content > 0))
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if closing:
            if any(own == name for own, _ in stack):
                while stack:
                    own, was = stack.pop()
                    skip -= was
                    content -= own in CONTENT
                    header -= own == "header" and not was
                    if own == name:
                        break
            out.append((name, "", skip > 0, content > 0))
            continue
        if name in CONTENT and skip and not any(own in ("aside", "footer") or was == 2 for own, was in stack):
            stack, skip, content, header = [], 0, 0, 0  # a menu or notice that was never closed ends where the article starts
        if name in EMBEDDED and (attributes.endswith("/") or last_end.get(name, -1) < at):
            pass
        elif name not in VOID:
            starts = name in EMBEDDED or _skipped(name, attributes, content > 0)
            if name in BLOCKS or starts or name in CONTENT:
                stack.append((name, 0 if not starts else 1))
                skip += starts
                content += name in CONTENT
                header += name == "header" and not starts
                if name == "p" or name == "li":  # ended by the next block, not nested
                    stack.pop()
                    skip -= starts
        out.append((name, "", skip > 0, content > 0))
    if at < len(page):
        out.append(("", page[at:], skip > 0 or (header > 0 and not _in_heading(stack)), content > 0))
    return out


def _in_heading(stack: list[tuple[str, int]]) -> bool:
    return any(name in HEADINGS for name, _ in stack)


def main_text(page: str, weights: dict[str, float]) -> str:
    """Blocks of the best region, white space made single, joined by an empty line.

    Words weigh ``weights[""]``, tags what their name weighs. Words of menus, headers, footers, sidebars, notices, adverts,
    forms and reader comments weigh nothing and are never part of the text; on a page with an ``article`` or ``main`` element
    the words outside it count against a region. One scan finds the region; of equal ones the first, longest.
    """
    stream = tokens(page)
    marked = any(content for *_, content in stream)
    word = weights.get("", 1.0)
    best, best_from, best_to = 0.0, 0, -1
    total, start = 0.0, 0
    for k, (name, text, skipped, content) in enumerate(stream):
        if name:
            total += 0.0 if skipped else max(weights.get(name, OTHER_TAG), CONTENT_TAG if content else -math.inf)
        elif not skipped:
            total += len(text.split()) * (word if content or not marked else -word)
        if total <= 0:
            total, start = 0.0, k + 1
        elif total >= best:
            best, best_from, best_to = total, start, k
    blocks, current = [], []
    for name, text, skipped, content in stream[best_from : best_to + 1]:
        if name in BLOCKS:
            blocks.append("".join(current))
            current = []
        elif name == "br":
            current.append(" ")
        elif not name and not skipped and (content or not marked):
            current.append(html.unescape(text))
    blocks.append("".join(current))
    return "\n\n".join(b for b in (" ".join(block.split()) for block in blocks) if b)


def extract_text(pages: DataFrame, weights: dict[str, float], page: str = "html", text: str = "text") -> DataFrame:
    """All rows of ``pages`` with the main text in a column ``text``; NULL, empty and text-less pages give the empty text.

    Each page is read whole and on its own, without a shuffle. A column of ``pages`` named ``text`` gets underscores in front.
    """
    if text in pages.columns:
        pages = pages.withColumnRenamed(text, own_name(text, pages.columns))
        page = pages.columns[-1] if page == text else page

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, page):
            found = pa.array([main_text(body.decode(), weights) for body in texts_of(batch, page)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, text])

    return pages.mapInArrow(run, with_schema(pages, f"`{text}` string"))


def fit_weights(pages: DataFrame, page: str = "html", rows: int = TRAINING_PAGES) -> dict[str, float]:
    """Weights from at most ``rows`` pages that label their main text themselves, with an ``article`` or ``main`` element.

    A kind of token weighs the log of how much more often it is met inside than outside the labelled region; words stay
    positive and tags negative. Without labelled pages the default weights are returned.
    """
    marked = pages.select(F.col(page).alias(page), F.xxhash64(page).alias("_digest")).where(F.lower(page).rlike("<(article|main)[ >]"))
    chosen = marked.select(F.col("_digest").alias("_chosen")).distinct().orderBy("_chosen").limit(rows)
    found = marked.join(F.broadcast(chosen), F.col("_digest") == F.col("_chosen"))  # `rows` numbers at most
    labelled = found.groupBy("_digest").agg(F.first(page).alias(page)).select(page)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, page):
            inside: Counter[str] = Counter()
            outside: Counter[str] = Counter()
            for body in texts_of(batch, page):
                for name, text, _, content in tokens(body.decode()):
                    if name not in CONTENT:
                        (inside if content else outside)[name] += 1 if name else len(text.split())
            names = sorted({*inside, *outside})
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in (inside, outside))], ["name", "inside", "outside"])

    counted = labelled.mapInArrow(count, "name string, inside long, outside long").groupBy("name").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"))
    found = counted.orderBy(F.desc(F.col("i") + F.col("o")), "name").limit(MOST_TAGS).collect()
    all_in, all_out = sum(r.i for r in found), sum(r.o for r in found)
    if not all_in or not all_out:
        return dict(DEFAULT_WEIGHTS)
    odds = {r.name: math.log((r.i + 1) / (all_in + 1)) - math.log((r.o + 1) / (all_out + 1)) for r in found}
    return {name: round(max(LEAST_WORD, value) if not name else min(MOST_TAG, value), 4) for name, value in odds.items()}
