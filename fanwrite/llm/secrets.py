"""Secret scan: keyword prefilter, anchored expressions, checksums.

An Aho-Corasick automaton finds the keywords that a secret starts with, in
one pass over the text.  Only at such a hit is the kind's regular expression
tried, anchored there, and what it matches is validated.  Long hexadecimal
runs have no keyword: of every run of 32 characters one falls on each 32nd
position of the text, so those positions are probed and expanded instead.

Base kinds: ``assign`` (a name like password or token given a value of eight
characters or more), ``access`` (AKIA keys of 16 or more), ``hex`` (32 or
more).  Added kinds, only if their embedded check holds: ``github`` and
``npm`` tokens (the last six characters are a base-62 CRC-32 of the body),
``jwt`` (header and claims decode to JSON objects) and ``pem`` (a private key
block with matching begin and end lines, encrypted ones with their headers).

Every expression is tried once in a stretch of text or is of bounded length, so
the time grows with the text, whatever it repeats.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanwrite.llm import spans as S

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "jwt", "pem")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
GITHUB = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_JWT_PART = re.compile(r"[A-Za-z0-9_-]+")
# An encrypted block has header lines of its own before the body: ten at most, not too long.
_PEM = re.compile(
    r"-----BEGIN ((?:[A-Z0-9]{1,20} )?(?:ENCRYPTED )?PRIVATE KEY)-----\s{1,9}(?:[A-Za-z0-9-]{1,40}:[^\n]{0,200}\n){0,10}[A-Za-z0-9+/=\s]+-----END \1-----"
)
_DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX_LETTERS = frozenset("0123456789abcdef")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SHORTEST_HEX = 32


@cache
def keywords() -> ahocorasick.Automaton:
    """Names are looked up in the lower-cased text, the others as they are."""
    automaton = ahocorasick.Automaton()
    for kind, words in {"assign": NAMES, "access": ("akia",), "github": GITHUB, "npm": ("npm_",), "jwt": ("eyj",), "pem": ("-----begin",)}.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def ascii_lower(text: str) -> str:
    """A-Z in lower case, every other character as it is (lengths stay)."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def crc_holds(body: str, check: str) -> bool:
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = _DIGITS62[digit] + out
    return out == check


def json_object(part: str) -> bool:
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))), dict)
    except (binascii.Error, ValueError, RecursionError):  # the last: nested too deep to be claims
        return False


def _jwt(text: str, at: int) -> tuple[int, bool] | None:
    """As :func:`_match`.  The first part goes to the end of its run of letters; no other
    place of that run can begin a token if this one can't, so the scan goes on behind it."""
    if not text.startswith("eyJ", at):
        return None
    parts, end = [], at
    for k in range(3):
        m = _JWT_PART.match(text, end)
        if not m or (k < 2 and not (m[0].startswith("eyJ") and len(m[0]) > 3 and text.startswith(".", m.end()))):
            return (_JWT_PART.match(text, at).end(), False)
        parts.append(m[0])
        end = m.end() + (k < 2)
    return (end, all(json_object(p) for p in parts[:2]))


def _match(kind: str, text: str, at: int) -> tuple[int, bool] | None:
    """End of the match of a kind at a place and whether it validates; from there the
    kind is looked for again (None: from the next place on)."""
    if kind == "assign":
        return (m.end(), m.end(1) - m.start(1) >= 8) if (m := _ASSIGN.match(text, at)) else None
    if kind == "access":
        return (m.end(), m.end() - at >= 16) if (m := _ACCESS.match(text, at)) else None
    if kind in ("github", "npm"):
        return (m.end(), crc_holds(m[1], m[2])) if (m := _CHECKED.match(text, at)) else None
    if kind == "jwt":
        return _jwt(text, at)
    return (m.end(), True) if (m := _PEM.match(text, at)) else None


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for i, c in enumerate(text[SHORTEST_HEX - 1 :: SHORTEST_HEX]):
        at = (i + 1) * SHORTEST_HEX - 1
        if at < done or c not in _HEX_LETTERS:
            continue
        start = at
        while start > done and text[start - 1] in _HEX_LETTERS:
            start -= 1
        done = _HEX.match(text, at).end()
        if done - start >= SHORTEST_HEX:
            yield start, done


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text, by start, then kind as in ``KINDS``."""
    if not text:
        return []
    found = [(s, KINDS.index("hex"), e) for s, e in _hex_runs(text)]
    floor = dict.fromkeys(KINDS, 0)
    for last, (kind, size) in keywords().iter(ascii_lower(text)):
        at = last - size + 1
        if at >= floor[kind] and (m := _match(kind, text, at)):
            floor[kind] = m[0]
            if m[1]:
                found.append((at, KINDS.index(kind), m[0]))
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def find_spans(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans`` for every row of ``df``: the spans of the whole text.

    A null or empty text has no spans.  Overlaps between kinds stay; within a
    kind spans do not overlap.  Repeated rows and null keys keep their rows;
    other columns are not read.  An empty table gives an empty result.
    """
    return df.select(F.col(key), S.spans_of(find)(F.col(text)).alias("spans"))


def digests(df: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, all spans."""
    s = F.col("spans")
    return find_spans(df).select(
        "doc_id",
        *(S.count(s, k).alias(f"n_{k}") for k in BASE),
        S.digest(S.only(s, BASE)).alias("base_sha256"),
        S.as_text(s).alias("spans"),
    )
