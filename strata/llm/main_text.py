"""Main text of HTML pages as a maximum-scoring contiguous run of tokens.

A page becomes a row of tokens: words and tags. Tags score negative and words
positive, by weights learnt from labelled pages (those that mark their article),
except that words in parts that are never the article score negative. One linear
scan finds the contiguous region with the highest sum, and the region's blocks
of positive words are the text.

Null or blank pages have empty text; markup may be broken, unclosed or absent.
Every page is read whole; rows, nulls and other columns do not affect each other.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 2000   # labelled pages used for the weights
LEAST, MOST = 0.05, 3.0   # cost of a tag always in the article, and of one never in it; a word earns 1

# HTML elements by what they mean for text.
_SKIPPED = "script style noscript template svg math iframe object canvas select button textarea audio video"
_OUTSIDE = frozenset("head nav footer header aside form menu dialog".split())
_HEAD = frozenset("head title meta link base".split())
_PAGE = frozenset("html body main article".split())   # never judged by names
_BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody
td tfoot th thead title tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id and role attributes that name parts outside the article.
_ASIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
consent cookie cookies copyright disqus footer gdpr header menu modal nav navbar navigation newsletter notice notices
notification pager pagination popup promo promoted promotion recommended related replies reply respond search share
sharing sidebar signup site-footer site-header social sponsor sponsored subscribe subscription tags toolbar widget
widgets""".split())
_NOT = frozenset("no not with without has have".split())   # first parts of names that tell of another element
_TALK = frozenset("comment comments disqus discussion replies reply respond".split())   # readers' words
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_FEW = 8    # words of an article's own, headings left out, below which a named part may be its body

_TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(" + "|".join(_SKIPPED.split()) + r")\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*/?)>|<[!?][^>]*>|([^<]+|<)", re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)


def _looks(tag: str, attributes: str) -> int:
    """2 for a part that is never the article, 1 for a form, 3 for an element whose name
    tells that it is set aside, 4 where it tells of readers' comments, else 0.

    Of a compound name the last part says what the element is."""
    if tag in _OUTSIDE and tag != "form" or attributes and tag not in ("html", "body") and _HIDDEN.search(attributes):
        return 2
    if tag == "form":
        return 1
    look = 0
    for found in _NAMES.findall(attributes) if "=" in attributes and tag not in _PAGE else ():
        for name in " ".join(found).lower().replace("_", "-").split():
            parts = name.split("-")
            if name in _ASIDE_WORDS or parts[-1] in _ASIDE_WORDS and parts[0] not in _NOT:
                look = max(look, 4 if name in _TALK or parts[-1] in _TALK else 3)
    return look


def _outside(tags: list[str], parents: list[int], looks: list[int], items: list[tuple[str, str, int, bool]]) -> list[bool]:
    """Whether each element is, or is within, a part that is never the article.

    A name does not decide for an element around the longest article or main. Nor does
    it for one with half the words or more of the longest article (without article: main, page) if this has
    no text of its own beside its headings and named parts: comments and sidebars next to
    an article's text stay out however long they are, and comments always. A form with half the words counts as the article."""
    out = [False] * len(tags)
    for e in range(1, len(tags)):
        out[e] = out[parents[e]] or looks[e] == 2
    if not {1, 3, 4} & set(looks):
        return out
    words, body, heading = [0] * len(tags), [0] * len(tags), 0
    for kind, value, e, _ in items:
        if kind == "#text":
            n = len(value.split())
            words[e] += n
            body[e] += 0 if heading else n
        elif kind.lstrip("/") in _HEADINGS:
            heading = 0 if kind[0] == "/" else 1
    for e in range(len(tags) - 1, 0, -1):
        words[parents[e]] += words[e]
    base, around = 0, set()
    for tag in ("main", "article"):
        found = [e for e, t in enumerate(tags) if t == tag and not out[e]]
        if found:
            base = e = max(found, key=lambda e: words[e])
            while e > 0:
                e = parents[e]
                around.add(e)
    inside, named, own = [False] * len(tags), [False] * len(tags), 0
    for e in range(len(tags)):
        inside[e] = e == base or e > 0 and inside[parents[e]]
        named[e] = e not in around and e != base and (looks[e] in (2, 3, 4) or e > 0 and named[parents[e]])
        if inside[e] and not named[e]:
            own += body[e]
    for e in range(len(tags)):
        major = inside[e] and 2 * words[e] >= words[base] and (looks[e] == 1 or looks[e] == 3 and own < _FEW)
        out[e] = e > 0 and out[parents[e]] or looks[e] == 2 or looks[e] in (1, 3, 4) and not (major or e in around)
    return out


def tokens(page: str) -> Iterator[tuple[str, str, bool, bool]]:
    """``(kind, value, outside, marked)``: kind is a tag name or ``#text``.

    ``outside``: within a part that is never the article; ``marked``: within an
    element that names the article."""
    stack: list[tuple[str, int, bool]] = []
    tags, parents, looks = [""], [0], [0]        # by element; 0 is the page
    items: list[tuple[str, str, int, bool]] = []
    for found in _TOKENS.finditer(page):
        _, closing, tag, attributes, text = found.groups()
        element, marked = stack[-1][1:] if stack else (0, False)
        if text:
            items.append(("#text", text, element, marked))
        elif tag:
            tag = tag.lower()
            if closing:
                at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
                if at is not None:
                    del stack[at:]
                    marked = bool(stack) and stack[-1][2]
                items.append(("/" + tag, "", element, marked))
            else:
                if stack and tag not in _HEAD and any(s[0] == "head" for s in stack):
                    del stack[next(i for i, s in enumerate(stack) if s[0] == "head"):]
                    element, marked = stack[-1][1:] if stack else (0, False)
                if tag in _BLOCKS:  # a block ends an open paragraph; a list item or cell ends its like
                    while stack and (stack[-1][0] not in _BLOCKS or stack[-1][0] == "p"):
                        if not any(s[0] == "p" for s in stack):
                            break
                        stack.pop()
                    if stack and stack[-1][0] == tag and tag in ("li", "td", "th", "tr", "dt", "dd"):
                        stack.pop()
                    element, marked = stack[-1][1:] if stack else (0, False)
                # A header inside the article holds its own title.
                look = 0 if tag == "header" and marked else _looks(tag, attributes)
                if look or tag in ("article", "main"):
                    parents.append(element)
                    tags.append(tag)
                    looks.append(look)
                    element = len(tags) - 1
                if tag not in _VOID and not attributes.endswith("/"):
                    stack.append((tag, element, marked or tag in ("article", "main")))
                items.append((tag, "", element, marked))
    outside = _outside(tags, parents, looks, items)
    for kind, value, element, marked in items:
        yield kind, value, outside[element], marked


def learn(pages: list[str]) -> dict[str, float]:
    """Negative weight of each tag, from pages that mark their article.

    A tag costs the more the larger the share of it that stands around the article
    rather than in it (parts that are never the article do not count)."""
    inside, around = Counter(), Counter()
    for page in pages:
        for kind, _, outside, marked in tokens(page):
            if kind != "#text" and not outside:
                (inside if marked else around)[kind] += 1
    share = {tag: (around[tag] + 1) / (inside[tag] + around[tag] + 2) for tag in inside.keys() | around.keys()}
    return {tag: -max(LEAST, MOST * x * x) for tag, x in share.items()}


def best_region(values: list[float]) -> tuple[int, int] | None:
    """First and last place of the run of greatest sum, by one scan; None if no sum is above 0.

    Of equal sums the run that ends first."""
    best, total, begin, region = 0.0, 0.0, 0, None
    for i, value in enumerate(values):
        if total <= 0:
            total, begin = 0.0, i
        total += value
        if total > best:
            best, region = total, (begin, i)
    return region


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The page's main text: blocks in order, joined by an empty line."""
    blocks: list[list[str]] = [[]]
    path: list[tuple[float, int]] = []          # score and block of every token
    linked = 0
    for kind, value, outside, marked in tokens(page or ""):
        if kind == "#text":
            n = len(value.split())
            path.append((-LEAST * n if outside else 0.0 if linked > 0 and not marked else n, len(blocks) - 1))
            if not outside:
                blocks[-1].append(value)
            continue
        name = kind.lstrip("/")
        if name == "a":
            linked = 0 if kind[0] == "/" else 1
        edge = name in ("article", "main") and not outside
        cost = -LEAST if outside else weights.get(kind, -MOST / 4)
        path.append((-math.inf if edge and not marked else cost, len(blocks) - 1))
        if name in _BLOCKS:
            blocks.append([])
        elif name == "br":
            blocks[-1].append(" ")
    region = best_region([value for value, _ in path])
    if region is None:
        return ""
    texts = (" ".join(unescape("".join(parts)).split())
             for parts in blocks[path[region[0]][1]:path[region[1]][1] + 1])
    return "\n\n".join(t for t in texts if t)


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from at most ``sample`` distinct pages that mark their article, chosen by hash.

    The hashes are chosen first, so that only the sample's pages leave their tasks."""
    rows = (pages.select(F.col(html_col).alias("html"), F.xxhash64(html_col).alias("hash"))
            .where(F.col("html").rlike("(?i)<(article|main)[ >]")))
    chosen = rows.select("hash").distinct().orderBy("hash").limit(sample).toArrow()
    chosen = F.broadcast(pages.sparkSession.createDataFrame(chosen))
    found = rows.join(chosen, "hash").groupBy("hash").agg(F.min("html").alias("html")).orderBy("hash").toArrow()
    return learn(found["html"].to_pylist())


def main_text(pages: DataFrame, weights: dict[str, float], html_col: str = "html") -> DataFrame:
    """``pages`` without the html and with its main text as ``text``."""
    rest = [c for c in pages.columns if c not in (html_col, "text")]
    rows = pages.select(*[F.col(f"`{c}`") for c in rest], F.col(html_col).alias("__html"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [extract(page, weights) for page in part.column(len(rest)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*rest, "text"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rest)
    return rows.mapInArrow(run, schema + ", text string")


__all__ = ["tokens", "learn", "best_region", "extract", "fit", "main_text"]
