"""Main text of web pages by tag-path ratios.

A page is cut into blocks, each with its path of tags (and their classes) from the root. Per path, text length,
punctuation and linked text are added up over its blocks; the ratio of a path is its text per block, raised by
punctuation and lowered by links. Ratios are smoothed along the page, so that a heading beside long paragraphs
counts with them, fused with those of the path and of its surroundings, and paths above a share of the page's
weighted mean are content. Paths through elements that are furniture by their tag have no weight. Those marked by
class, id, role or a hidden attribute have less, unless the marked element holds most of the page's unlinked text;
paths outside of article and main have the less, the more of the unlinked text is inside.

The scanner never goes back: paths and marked elements are numbers with a parent, what is open is counted by tag, and
a search that found nothing is not made again. So its time is in proportion to the page, however deep the elements
and whatever quotes or tags lack their ends.

Defined results: null or empty html, or a page without content, gives the empty text; unclosed and stray tags
are taken as browsers take them, but a quote that nothing closes is a character; a tag without an end takes the rest of
the page with it; blocks of the same text stay as often as they occur; repeated pages get
equal rows; an empty table gives an empty result; a very long page is one row of one task. Extra columns are not
looked at.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: What a less-than sign starts: a comment, CDATA, a declaration, or a tag.
OPEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][^\s/>]*+))")
UP_TO_QUOTE = re.compile(r"[^\"'>]*+")
ATTRIBUTES = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub "
             "sup time tt u var wbr br img".split())
RAW = set("script style noscript template textarea title iframe svg math object select datalist noframes xmp".split())
#: Those that browsers read as mere text, to the end of the page where their end tag is missing.
MERE_TEXT = set("script style noscript template textarea title iframe noframes xmp".split())
HEAD = set("title meta link style script base noscript template head".split())
FURNITURE = set("nav footer aside button menu head".split())
#: Furniture, unless they hold the page.
FRAMES = set("form fieldset dialog select datalist option".split())
#: Parts of a class, id or role that mark furniture.
MARKS = set("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu "
            "breadcrumb breadcrumbs sidebar side aside footer header masthead topbar toolbar cookie cookies consent notice notices gdpr alert popup modal "
            "overlay newsletter subscribe subscription signup login comment comments commentlist reply replies disqus discussion respond "
            "related recommended recommendations share sharing social pagination pager widget widgets search form complementary "
            "contentinfo skip paywall copyright legal toc".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = set("ul ol dl table body html article main section div td th aside nav footer header form".split())
#: Where the search for elements that a new one closes looks.
STOPS = SCOPE | {"p"} | set().union(*CLOSES.values())
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？·¿¡«»“”\"']")
SIGMA = 1.0
SHARE = 0.12
MARKED = 0.1


def _attributes(attributes: str) -> dict[str, str]:
    """Attributes by name; of those named twice the first, as in browsers."""
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTES.findall(attributes):
        out.setdefault(name.lower(), "".join(values).lower())
    return out


def _marked(tag: str, attributes: dict[str, str], within: bool) -> bool:
    """Whether an element is marked as furniture. A header inside the article is not."""
    if tag in ("html", "body"):
        return False
    if tag in FRAMES or (tag == "header" and not within):
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    for name in ("class", "id", "role"):
        value = attributes.get(name)
        if not value:
            continue
        parts = set(re.split(r"[^a-z0-9]+", value))
        if "hidden" in value.split() or (parts & MARKS and not (within and parts & {"header"})):
            return True
    return False


class Block(NamedTuple):
    path: int
    text: str
    linked: int
    furniture: bool
    mark: int
    within: bool


class Element(NamedTuple):
    """An open element with what holds for text in it."""

    tag: str
    path: int
    furniture: bool
    mark: int
    within: bool
    links: int
    stop: int  # place on the stack of the nearest element, this one included, that is one of ``STOPS``; -1 for none


ROOT = Element("", 0, False, 0, False, 0, -1)


class Scanner:
    """Tags and text of a page, in one pass."""

    def __init__(self, page: str) -> None:
        self.page, self.gone = page, set()
        self.last = page.rfind(">")

    def find(self, what: str, at: int) -> int:
        """Like str.find, but what is not there any more is not looked for again."""
        if what in self.gone:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.gone.add(what)
        return found

    def end_of_tag(self, at: int) -> int:
        """Where the tag ends whose attributes start here; -1 if it has no end."""
        while at <= self.last:
            at = UP_TO_QUOTE.match(self.page, at).end()
            if at > self.last:
                return -1
            if self.page[at] == ">":
                return at
            close = self.find(self.page[at], at + 1)
            at = at + 1 if close < 0 else close + 1
        return -1

    def raw_end(self, tag: str, at: int) -> re.Match | None:
        """The end tag of an element whose content is no markup."""
        if f"</{tag}" in self.gone:
            return None
        found = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(self.page, at)
        if found is None:
            self.gone.add(f"</{tag}")
        return found


def blocks(page: str) -> tuple[list[Block], list[int]]:
    """The blocks with text, in order, and for each marked element (from 1) the marked one around it (0 for none)."""
    out: list[Block] = []
    stack: list[Element] = []
    opened: defaultdict[str, int] = defaultdict(int)
    paths: dict[tuple[int, str], int] = {}
    around = [0]
    text: list[str] = []
    linked, here, at = 0, ROOT, 0
    scan = Scanner(page)

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append(Block(here.path, joined, min(linked, len(joined)), here.furniture, here.mark, here.within))
            text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = html.unescape(piece)
            text.append(piece)
            if here.links:
                linked += len(piece.strip())

    def close(k: int) -> None:
        """Close the element at place k and those in it."""
        nonlocal here
        outer = stack[k - 1] if k else ROOT
        if any(e.tag not in INLINE for e in stack[k:]) or (k and (here.furniture, here.mark) != (outer.furniture, outer.mark)):
            flush()
        for e in stack[k:]:
            opened[e.tag] -= 1
        del stack[k:]
        here = outer

    def innermost(tag: str) -> int:
        k = len(stack) - 1
        while stack[k].tag != tag:
            k -= 1
        return k

    while (less := scan.find("<", at)) >= 0:
        m = OPEN.match(page, less)
        if m is None:  # a mere sign
            add(page[at : less + 1])
            at = less + 1
            continue
        add(page[at:less])
        if m[1]:
            end = scan.find("-->", m.end())
            at = len(page) if end < 0 else end + 3
            continue
        if m[2] and (end := scan.find("]]>", m.end())) >= 0:
            at = end + 3
            continue
        stop = page.find(">", m.end()) if m[2] or m[3] else scan.end_of_tag(m.end())
        if stop < 0:
            at = len(page)
            break
        at, tag, attributes = stop + 1, (m[5] or "").lower(), page[m.end() : stop]
        if not tag:
            continue
        if m[4]:
            if opened[tag] > 0:
                close(innermost(tag))
            elif tag == "p":
                flush()
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in RAW and not attributes.endswith("/"):
            if tag not in ("script", "style", "noscript", "template") and tag not in INLINE:
                flush()
            # what is inside is no markup: '<n;i++){}</script>' is not a tag
            end = scan.raw_end(tag, at)
            if end or tag in MERE_TEXT:
                at = end.end() if end else len(page)
                continue
        if tag not in INLINE:
            if tag not in HEAD and opened["head"] > 0:
                close(next(k for k, e in enumerate(stack) if e.tag == "head"))
            same = CLOSES.get(tag, ())
            k = here.stop if opened["p"] > 0 or any(opened[t] > 0 for t in same) else -1
            while k >= 0:
                name, below = stack[k].tag, stack[k - 1].stop if k else -1
                if name == "p" or name in same:
                    close(k)
                    if not same:
                        break
                elif name in SCOPE:
                    break
                k = below
            flush()
        if tag in VOID or attributes.endswith("/"):
            continue
        within = here.within or tag in ("article", "main")
        given = _attributes(attributes) if attributes else {}
        path = here.path
        if tag not in INLINE:
            names = ".".join(given["class"].split()) if "class" in given else ""
            path = paths.setdefault((here.path, f"{tag}.{names}" if names else tag), len(paths) + 1)
        mark = here.mark
        if _marked(tag, given, within):
            mark = len(around)
            around.append(here.mark)
            if tag in INLINE:
                flush()
        here = Element(
            tag, path, here.furniture or tag in FURNITURE, mark, within, here.links + (tag == "a"),
            len(stack) if tag in STOPS else here.stop)
        stack.append(here)
        opened[tag] += 1
    add(page[at:])
    flush()
    return out, around


def _mostly_unmarked(found: list[Block], around: list[int], plain: np.ndarray) -> np.ndarray:
    """Whether each block lies in a marked element that holds no more than half of the unlinked text."""
    own = np.bincount([b.mark for b in found], plain, len(around))
    for k in range(len(around) - 1, 0, -1):  # an inner element has a larger number than the one around it
        own[around[k]] += own[k] if around[k] else 0
    marked, half = np.zeros(len(around), bool), plain.sum() / 2
    for k in range(1, len(around)):
        marked[k] = own[k] <= half or marked[around[k]]
    return marked[[b.mark for b in found]]


def content(page: str | None) -> list[str]:
    """Texts of the content blocks of a page."""
    found, around = blocks(page or "")
    if not found:
        return []
    length = np.array([len(b.text) for b in found], float)
    points = np.array([len(PUNCTUATION.findall(b.text)) for b in found], float)
    links = np.array([b.linked for b in found], float)
    plain = length - links
    marked = _mostly_unmarked(found, around, plain)
    within = np.array([b.within for b in found])
    weight = np.where([b.furniture for b in found], 0, np.where(marked, MARKED, 1.0))
    if (inside := plain @ (weight * within)) > 0:  # the page says where its article is, or some of it
        weight = weight * np.where(within, 1, (1 - inside / (plain @ weight)) ** 2)
    if not weight.any():
        return []
    _, path = np.unique(np.array([[b.path, w] for b, w in zip(found, weight)]), axis=0, return_inverse=True)
    path = path.reshape(-1)
    per = lambda v: np.bincount(path, v)
    n, total = per(np.ones(len(found))), per(length)
    ratio = total / n * (1 + per(points) / n) * (1 - per(links) / total) ** 2
    ratio = np.log1p(ratio)[path] * weight
    reach = np.arange(-3, 4)
    kernel = np.exp(-0.5 * (reach / SIGMA) ** 2)
    smooth = np.convolve(ratio, kernel / kernel.sum(), "same") if len(ratio) >= len(kernel) else np.convolve(
        np.pad(ratio, len(kernel)), kernel / kernel.sum(), "same")[len(kernel) : -len(kernel)]
    fused = (per(ratio + smooth * weight) / 2 / n)[path]  # of the path, with its surroundings
    bar = SHARE * np.average(fused, weights=length * weight)
    return [b.text for b, f in zip(found, fused) if f > 0 and f >= bar]


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text (blocks joined by empty lines) and n_chars."""

    def texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["text"] = ["\n\n".join(content(h)) for h in f["html"]]
            f["n_chars"] = [len(t) for t in f["text"]]
            yield f[["page_id", "url", "text", "n_chars"]]

    rows = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html")
    return rows.mapInArrow(_by_arrow(texts), "page_id long, url string, text string, n_chars long")


def _by_arrow(fn):
    """Batches as frames without turning null ids into floats."""
    import pyarrow as pa

    def run(batches):
        frames = (b.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get) for b in batches)
        for f in fn(frames):
            yield pa.RecordBatch.from_pandas(f, preserve_index=False, schema=pa.schema(
                [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]))

    return run
