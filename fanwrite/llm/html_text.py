"""Main text of web pages by line-block distribution.

Markup is stripped to lines: one for each block-level element's own text,
white space folded, character references decoded.  Elements that never hold
main text (scripts, styles, navigation, headers, footers, asides, forms, and
those whose class, id or role says so, such as adverts, notices or reader
comments) leave a gap of empty lines, unless they stand in the flow of text.
A class or id says so only as a whole, never for a heading, and never for an
element that holds the page's content (``holders``).

On every page the line blocks choose the text (``main_lines``).  A line weighs the
length of its text less that of its links (nothing, if it is mostly links), and the
weights of each window of three lines are summed.  The text surges where a window
reaches the threshold and dives where a window sums to nothing; the stretch
round a surge, from the dive before it to the next, is text.  The element that
holds the heaviest line and most of the page's weight is the text's own: what
stands in it belongs to the text though it does not surge (a heading before an
aside, a last short paragraph, the first rows of a table), but for links after
the last text unless they stand in the element itself.  An ``article`` or ``main``
only bounds the search: if a page has one, lines outside weigh nothing, and the
text's own element is widened to it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINES = 3  # lines in a window
SURGE = 80  # weight of a window where the text surges (less, if no window of the page reaches it)
LINKS = 0.5  # share of a line's characters in links above which it counts as empty

# Elements of HTML by their role.
BLOCKS = frozenset(
    "address article blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form head header iframe input label map math menu nav noframes "
    "noscript object optgroup option script select style svg template textarea title video".split()
)
RAW = frozenset("script style textarea title iframe noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SELF_CLOSING = frozenset("dd dt li option p td th tr".split())  # a sibling ends them
CONTENT = frozenset(("article", "main"))

# Words in a class or id that mark what is not the main text.
MARKS = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment commenter commenters comments consent cookie cookies "
    "disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination "
    "popup promo promotion related recommended replies respond responses search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
COMMENTS = frozenset(("comment", "commenter", "commenters", "comments", "disqus", "replies", "respond", "responses"))
LISTS = COMMENTS | {"related", "recommended"}  # may hold articles that are not the page's
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words that, beside a mark, say where or how it stands.
PLACES = frozenset(
    "all area articles bar block body bottom box button buttons container end entry form group icons inner item items js left link links list main media "
    "outer panel post posts primary reader readers right secondary section site slot stories thread threads top unit user users wrap wrapper".split()
)
# What stands in the flow of an article: left out without a gap.
IN_FLOW = frozenset(
    "ad ads advert advertisement advertising adverts alert hidden newsletter notice notices popup promo promotion related "
    "share sharing social sponsor sponsored subscribe widget "
    "audio button canvas embed form iframe input map math noscript object script select style svg template textarea video".split()
)

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_MARK = re.compile(r"[a-z]+|[A-Z][a-z]+|[A-Z]+")
_SIZE = re.compile(r"(?:\bv)?\d+(?:x\d+)?")
_COPYRIGHT = re.compile(r"(?:©|\(c\)|copyright\b)", re.IGNORECASE)


class Element:
    """An open block: the lines from ``start`` to before ``end`` are in it."""

    __slots__ = ("end", "name", "parent", "start")

    def __init__(self, name: str, start: int, parent: Element | None) -> None:
        self.name, self.start, self.end, self.parent = name, start, math.inf, parent


class Line(NamedTuple):
    text: str
    links: int  # characters of it inside links
    content: bool  # inside an article or main element
    parent: Element


GAP = Line("", 0, True, Element("", 0, None))


def mark_of(name: str, attributes: str) -> tuple[str, bool]:
    """The word in an element's attributes that says it is not main text, or '',
    and whether it stands in a class or id."""
    if not attributes or name in ("html", "body", "main"):
        return "", False
    named = ""
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return "hidden", False
        if key == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return "hidden", False
        if key == "role" and value.strip().lower() in ROLES:
            return value.strip().lower(), False
        if key in ("class", "id") and not named and name not in HEADINGS:
            named = next(filter(None, (mark_in(word, COMMENTS if name == "article" else MARKS) for word in value.split())), "")
    return named, bool(named)


def mark_in(word: str, marks: frozenset[str]) -> str:
    """The mark that a class or id is, alone or with other marks and ``PLACES``, or ''."""
    if word.lower() in marks:
        return word.lower()
    parts = [q for p in _MARK.findall(_SIZE.sub("-", word)) for q in compound(p.lower(), marks)]
    return next((p for p in parts if p in marks), "") if all(p in marks or p in PLACES for p in parts) else ""


def compound(part: str, marks: frozenset[str]) -> tuple[str, ...]:
    """The two words that a part is written of without a break, if one is a longer mark."""
    if part not in marks and part not in PLACES:
        for i in range(4, len(part) - 3):
            a, b = part[:i], part[i:]
            if a in marks and b in PLACES or a in PLACES and b in marks:
                return a, b
    return (part,)


def ends(dropped: str, name: str, closing: bool) -> bool:
    """Whether a tag ends an open element that a sibling or its parent's end closes."""
    return dropped in SELF_CLOSING and name in BLOCKS and (closing and name != dropped or not closing and (name == dropped or dropped == "p"))


def holders(html: str) -> set[int]:
    """Where the elements begin whose class or id is a mark though they hold a
    ``main``, the longest ``article`` or most of the text (an article within
    reader comments or related pages does not count)."""
    found: list[tuple[int, int, int, int, bool]] = []  # place, text before it and at its end, main elements in it, may hold articles
    opened: dict[str, list] = {}  # marked and content elements by name: depth, [place, text, mains, mark] or [text] or None
    articles: list[tuple[int, int, int]] = []  # length, text at begin and end
    text = mains = depth = pos = 0
    dropped = ""

    def close(name: str) -> None:
        place = opened[name].pop()
        if place is None:
            return
        if place[3]:
            found.append((place[0], place[1], text, mains - place[2], place[3] not in LISTS))
        elif name == "article":
            articles.append((text - place[1], place[1], text))

    while pos < len(html):
        m = _TOKEN.match(html, pos)
        pos = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if not dropped and (html[m.start()] != "<" or m[0] == "<"):
                text += len(m[0].strip())
            continue
        closing, attributes = (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if not closing and name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE).search(html, pos)
            pos = end.end()
            continue
        if dropped:
            if name == dropped:
                depth += -1 if closing else 0 if dropped in SELF_CLOSING else 1
            if depth and ends(dropped, name, closing):
                depth = 0
                if not closing:
                    pos = m.start()
            if not depth:
                dropped = ""
            continue
        for other in [x for x in SELF_CLOSING if opened.get(x) and ends(x, name, closing)] if name in BLOCKS else ():
            while opened[other]:
                close(other)
        if closing:
            if opened.get(name):
                close(name)
            continue
        if name in VOID:
            continue
        mark, named = (name, False) if name in DROPPED else mark_of(name, attributes)
        if mark and not named:
            if not (attributes.endswith("/") and name == "svg"):
                dropped, depth = name, 1
            continue
        mains += name == "main"
        if mark or name == "article":
            opened.setdefault(name, []).append((m.start(), text, mains, mark))
        elif opened.get(name) and name not in SELF_CLOSING:
            opened[name].append(None)
    for name in opened:
        while opened[name]:
            close(name)
    _, begin, end = max(articles, default=(0, 0, 0))
    return {at for at, a, b, n, may in found if n or 2 * (b - a) > text or may and end > begin and a <= begin and end <= b}


def lines_of(html: str) -> list[Line]:
    """The page's lines; dropped elements leave ``LINES`` empty ones, but for
    those that stand in the flow of an article."""
    out: list[Line] = []
    held: list[str] = []
    linked: list[str] = []
    content = links = depth = pos = 0
    dropped = ""  # the element being left out, and how many of its name are open
    holding: set[int] | None = None
    stack: list[list] = [["", Element("", 0, None), True]]  # open blocks: name, element, whether blocks are in them
    opened: Counter[str] = Counter()

    def flush() -> None:
        text = " ".join(unescape("".join(held)).split())
        if text:
            name, element, parent = stack[-1]
            element = element if parent and name not in SELF_CLOSING or len(stack) == 1 else stack[-2][1]
            out.append(Line(text, len(" ".join(unescape("".join(linked)).split())), content > 0, element))
        held.clear()
        linked.clear()

    def close() -> None:
        name, element, _ = stack.pop()
        opened[name] -= 1
        element.end = len(out)

    while pos < len(html):
        m = _TOKEN.match(html, pos)
        pos = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if not dropped and (html[m.start()] != "<" or m[0] == "<"):
                held.append(m[0])
                if links:
                    linked.append(m[0])
            continue
        closing, attributes = (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if not closing and name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE).search(html, pos)
            pos = end.end()
            if not dropped and name != "xmp":
                continue
            if not dropped:
                held.append(html[m.end() : end.start()].replace("&", "&amp;"))
            continue
        if dropped:
            if name == dropped:
                depth += -1 if closing else 0 if dropped in SELF_CLOSING else 1
            if depth and ends(dropped, name, closing):
                depth = 0
                if not closing:
                    pos = m.start()  # the sibling is looked at again, for itself
            if not depth:
                dropped = ""
            continue
        mark, named = ("", False) if closing or name in VOID else (name, False) if name in DROPPED else mark_of(name, attributes)
        if named:
            holding = holders(html) if holding is None else holding
            mark = "" if m.start() in holding else mark
        if mark:
            if attributes.endswith("/") and name == "svg":
                continue
            if name in BLOCKS or mark not in IN_FLOW:
                stack[-1][2] = True
                flush()
            if mark not in IN_FLOW:
                out.extend([GAP] * LINES)
            dropped, depth = name, 1
            continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        elif name == "br":
            held.append(" ")
        elif name in BLOCKS:
            if not closing:
                stack[-1][2] = True
            flush()
            links = 0
            if closing:
                while opened[name]:
                    last = stack[-1][0]
                    close()
                    if last == name:
                        break
            else:
                if stack[-1][0] == "p" or name in SELF_CLOSING and stack[-1][0] == name:
                    close()
                if name not in VOID:
                    stack.append([name, Element(name, len(out), stack[-1][1]), False])
                    opened[name] += 1
            if name in CONTENT:
                content = max(0, content + (-1 if closing else 1))
    flush()
    return out


def weights_of(lines: list[Line]) -> list[int]:
    """What each line weighs: nothing outside a content element, if the page has one."""
    bounded = any(x.content and x.text for x in lines)
    inside = [bool(x.text) and (x.content or not bounded) for x in lines]
    weights = [len(x.text) - x.links if there and x.links <= LINKS * len(x.text) else 0 for x, there in zip(lines, inside, strict=True)]
    if bounded and not any(weights):  # an article of links
        return [len(x.text) if there else 0 for x, there in zip(lines, inside, strict=True)]
    return weights


def stretches(weights: list[int]) -> Iterator[tuple[int, int, bool]]:
    """The lines between two dives, without weightless ones at either end: first, the one
    after the last, and whether the text surges between them."""
    blocks = [sum(weights[i : i + LINES]) for i in range(len(weights))]
    threshold = min(SURGE, max(blocks, default=0))
    first = None
    for i, block in enumerate([*blocks, 0]):
        if block == 0 and first is not None:
            last = max(k for k in range(first, i) if weights[k])
            yield first, last + 1, max(blocks[first : last + 1]) >= threshold
            first = None
        elif first is None and block and weights[i]:
            first = i


def own_element(lines: list[Line], weights: list[int]) -> Element:
    """The innermost element that holds the heaviest line and over half of all
    weight, widened to the content element round it, if there is one."""
    sums = [0, *accumulate(weights)]
    at: Element = lines[max(range(len(lines)), key=weights.__getitem__)].parent
    while at.parent and 2 * (sums[min(at.end, len(lines))] - sums[at.start]) <= sums[-1]:
        at = at.parent
    wider: Element | None = at
    while wider and wider.name not in CONTENT:
        wider = wider.parent
    return wider or at


def main_lines(lines: list[Line]) -> list[str]:
    """The lines of the stretches in which the text surges and of the element that it has
    for its own (the page or its body is none: there a stretch must surge itself)."""
    weights = weights_of(lines)
    if not any(weights):
        return []
    kept = [False] * len(lines)
    for first, end, surges in stretches(weights):
        if surges:
            kept[first:end] = [True] * (end - first)
    bounded = any(x.content and x.text for x in lines)
    own = own_element(lines, weights)
    if own.name not in ("", "html", "body"):
        start, end = own.start, min(own.end, len(lines))
        if own.name not in CONTENT:
            heavy = [i for i in range(start, end) if weights[i]]
            start, last = heavy[0], heavy[-1]
            kept[last:end] = [kept[i] or i == last or lines[i].parent is own for i in range(last, end)]
            end = last
        kept[start:end] = [True] * (end - start)
    found = [x.text for x, keep in zip(lines, kept, strict=True) if keep and x.text and (x.content or not bounded)]
    while not bounded and len(found) > 1 and _COPYRIGHT.match(found[-1]):
        found.pop()
    return found


def main_text(html: str | None) -> str:
    """The main text, its blocks joined by an empty line; '' if there is none."""
    return "\n\n".join(main_lines(lines_of(html))) if html else ""


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with ``text``, the main text of the whole html.

    Null or empty html, and pages without any main text, give ''.  Broken or
    unclosed markup is read as far as it goes.  All rows and other columns
    stay (a column named ``text`` is replaced); an empty table stays empty.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h) for h in batch], dtype=object)

    return pages.withColumn(text, F.pandas_udf(run, "string")(F.col(html)))


def texts(pages: DataFrame) -> DataFrame:
    found = extract(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
