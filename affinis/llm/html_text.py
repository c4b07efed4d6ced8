"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, each as much as words
in such an element lie in the content of labelled pages; tags score negative, the
more the rarer they are in content. The contiguous stretch of the largest sum, found
in one scan, is the content region. Its blocks are the text, with all blocks of an
article or main element that it reaches into; elements that are never
content (menus, adverts, notices, forms, comments and the like) score nothing in it
and are left out of it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.scratch import Scratch

FIT_PAGES = 2_000  # labelled pages at most that the weights are learned from
TAG_COST, RARE_COST, BOILER_COST = 0.2, 5.0, 0.3

#: Names of elements.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = set("head title nav footer aside form script style noscript template button select option textarea iframe svg dialog menu object audio video canvas math input".split())
BOILER_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form status".split())
#: Words in class and id that mark what is not the article.
BOILER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice notices alert"
    " popup modal overlay newsletter subscribe subscription signup login sidebar aside widget widgets nav navbar navigation menu breadcrumb breadcrumbs"
    " pagination pager comment comments commentlist discussion respond reply replies disqus related recommended recommendations teaser share sharing social"
    " footer masthead toolbar search skip paywall disclaimer copyright".split()
)
CONTENT_TAGS = {"article", "main"}
#: Words of these that mark reader comments; inside an article its own parts are left out for no other name.
COMMENT_NAMES = set("comment comments commentlist respond reply replies disqus".split())
ARTICLE_PARTS = set("section p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table blockquote pre figure figcaption".split())
MODIFIERS = set("with has no without".split())
TOKEN = re.compile(
    # A tag that is not closed ends at the next one, so that no stretch is scanned for every "<" before it.
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^<>]*+>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^<>]*+>|[^<]++|<",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)


def says_boiler(name: str, value: str, inside: bool) -> bool:
    """Whether a class or id marks what is not the article.

    Outside an article a part of a compound name is enough, unless it says what the element is
    with or without; inside, only whole names count, and for its own parts only those of comments.
    """
    names = value.split()
    if inside:
        return not (COMMENT_NAMES if name in ARTICLE_PARTS else BOILER_NAMES).isdisjoint(names)
    parts = (re.split(r"[^a-z0-9]+", one) for one in names)
    return any(one[0] not in MODIFIERS and not BOILER_NAMES.isdisjoint(one) for one in parts)


def is_boiler(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is never content; a page's header isn't, an article's may be."""
    if name in BOILER_TAGS or (name == "header" and not inside):
        return True
    if not attributes:
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "role" and value in BOILER_ROLES:
            return True
        if key in ("class", "id") and name not in ("html", "body") and says_boiler(name, value, inside):
            return True
    return False


@dataclass
class Piece:
    """A tag or a stretch of text, in page order."""

    feature: str  # the tag, or "word in" the innermost block
    text: str  # empty for a tag
    block: int  # pieces of one block are one line of text
    boiler: bool
    content: int  # number of the outermost element that labels its words as content; 0: none


def pieces(page: str) -> list[Piece]:
    out: list[Piece] = []
    stack: list[tuple[str, bool, int]] = []  # name, boiler, content
    opened: Counter[str] = Counter()  # names on the stack
    block = marked = 0
    for found in TOKEN.finditer(page):
        raw, script, closing, name = found[0], found[1], found[2], found[3]
        boiler, content = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        if script:
            out.append(Piece(f"<{script.lower()}>", "", block, True, content))
        elif name:
            name = name.lower()
            if name not in INLINE:
                block += 1
            if closing:
                while opened[name]:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
            elif name not in VOID and not raw.endswith("/>"):
                if name not in INLINE and stack and stack[-1][0] == "p":
                    opened[stack.pop()[0]] -= 1
                boiler, content = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
                boiler = boiler or is_boiler(name, found[4], content > 0)
                if boiler:
                    content = 0
                elif name in CONTENT_TAGS and not content:
                    content = marked = marked + 1
                if name not in INLINE or boiler != (bool(stack) and stack[-1][1]):
                    stack.append((name, boiler, content))
                    opened[name] += 1
            out.append(Piece(f"<{name}>", "", block, boiler, content))
        elif raw[0] != "<" or raw == "<":
            where = next((s[0] for s in reversed(stack) if s[0] not in INLINE), "")
            out.append(Piece(f"word in {where}", raw, block, boiler, content))
    return out


@dataclass(frozen=True)
class Weights:
    """Share of content among the words and tags of each feature; an unknown one has ``usual``."""

    shares: dict[str, float] = field(default_factory=dict)
    usual: float = 0.97

    def of(self, piece: Piece) -> float:
        share = self.shares.get(piece.feature, self.usual)
        if not piece.text:
            return -BOILER_COST if piece.boiler else -(TAG_COST + RARE_COST * (1 - share))
        return 0.0 if piece.boiler else max(share, 0.01) * len(piece.text.split())


def region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous stretch of the largest positive sum; the longest of equals, then the first."""
    best, at, sums, start = (0.0, 0, 0), (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if sums < 0:
            sums, start = 0.0, i
        sums += score
        if sums > 0 and (round(sums, 9), i + 1 - start) > best[:2]:
            best, at = (round(sums, 9), i + 1 - start, start), (start, i + 1)
    return at


def main_text(page: str | None, weights: Weights) -> str:
    """The blocks of the content region, one to a line, references decoded and white space made one space."""
    found = pieces(page or "")
    first, last = region([weights.of(p) for p in found])
    if first == last:
        return ""
    marked = {p.content for p in found[first:last] if p.content and p.text}  # such an element counts as a whole
    blocks = {p.block for i, p in enumerate(found) if p.text and not p.boiler and (first <= i < last or p.content in marked)}
    lines: dict[int, list[str]] = {}
    for p in found:
        if p.block in blocks and not p.boiler:
            lines.setdefault(p.block, []).append(p.text or (" " if p.feature == "<br>" else ""))
    joined = (" ".join(html.unescape("".join(parts)).split()) for _, parts in sorted(lines.items()))
    return "\n".join(line for line in joined if line)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, within, n): words and tags of labelled pages, within and outside the content."""
    total: dict[tuple[str, bool], int] = {}
    for batch in batches:
        for page in batch.column("html").to_pylist():
            for p in pieces(page):
                if p.boiler:  # scores nothing anyhow, and would only say that lists or links are rare in content
                    continue
                key = (p.feature, p.content > 0)
                total[key] = total.get(key, 0) + (len(p.text.split()) if p.text else 1)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.bool_()), pa.array(list(total.values()), pa.int64())],
        names=["feature", "within", "n"],
    )


def fit(pages: DataFrame, labelled_pages: int = FIT_PAGES, scratch: Scratch | None = None) -> Weights:
    """Learn weights from pages that mark their content with an article or main element.

    At most ``labelled_pages`` of them, drawn by a hash, are looked at. Without any the
    weights are the usual ones.
    """
    labelled = pages.select("html").filter(F.lower("html").rlike("<(article|main)[ >]"))
    share = min(1.0, labelled_pages * 0.9 / max(1, labelled.count()))
    drawn = labelled.filter(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).limit(labelled_pages)
    counts = drawn.mapInArrow(_counts, "feature string, within boolean, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("within"), F.col("n")).otherwise(0)).alias("inside"), F.sum("n").alias("n")
    )
    # Names of elements on the pages drawn, at most FIT_PAGES.
    return Weights({r.feature: (r.inside + 0.8) / (r.n + 1) for r in counts.collect()})


def _texts(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py(), sent.value) for h in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.drop_columns(["html"]).columns, texts], names=["page_id", "url", "text"])

    return run


def extracted(pages: DataFrame, weights: Weights) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    The whole page is read. A null or empty html, or one without words, has an empty
    text. Repeated rows and nulls in the other columns stay; further columns are ignored.
    """
    id_type = pages.schema["page_id"].dataType.simpleString()
    sent = pages.sparkSession.sparkContext.broadcast(weights)
    texts = pages.select("page_id", "url", "html").mapInArrow(_texts(sent), f"page_id {id_type}, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
