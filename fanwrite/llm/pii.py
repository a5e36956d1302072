"""Personal data by anchor expansion.

An Aho-Corasick automaton passes once over the text and reports anchors:
at-signs, plus signs, digits, URL schemes and identifier cues.  A small
deterministic parser per kind expands around its anchor to the boundaries of
a candidate and validates it; a candidate that fails is dropped and the scan
goes on behind it.

Base kinds: ``email``, ``ip`` (parts up to 255), ``card`` (14-19 digits,
Luhn), ``phone`` (10-15 digits).  Added kinds: ``login`` (user part of a URL
after its scheme), ``iban`` (after its cue, checked modulo 97) and
``account`` (6-17 digits after an account or passport cue, ``ACCOUNT_WORDS``, in
several languages).
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanwrite.llm import spans as S

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "account")
ACCOUNT_WORDS = ("account", "acct", "konto", "kontonummer", "cuenta", "compte", "conto", "passport", "reisepass", "passeport", "pasaporte")
CUES = {"IBAN": "iban", "iban": "iban", "Iban": "iban"} | {c: "account" for w in ACCOUNT_WORDS for c in (w, w.capitalize(), w.upper())}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+:[A-Za-z0-9._~%!$&'()*+,;=:-]+(?=@)")
_NUMBER = r"no\.?|nr\.?|n[º°]\.?|number|nummer|número|numéro"
_IBAN = re.compile(rf"(?:\x20?(?i:{_NUMBER}))?[\x20:#=]{{0,3}}([A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}})")
_ACCOUNT = re.compile(rf"\x20?(?i:{_NUMBER}|#)?[\x20:#=]{{1,3}}([0-9]{{6,17}})(?![0-9A-Za-z])")


@cache
def anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word in ("@", "+", "://", *"0123456789", *CUES):
        automaton.add_word(word, word)
    automaton.make_automaton()
    return automaton


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


_IN_DIGITS = str.maketrans({c: str(int(c, 36)) for c in string.digits + string.ascii_letters})


def iban_checks(text: str) -> bool:
    code = text.replace(" ", "")
    return 15 <= len(code) <= 34 and int((code[4:] + code[:4]).translate(_IN_DIGITS)) % 97 == 1


def small(number: str) -> bool:
    """A part of an address is at most 255, whatever its leading zeros."""
    number = number.lstrip("0")
    return len(number) <= 3 and int(number or "0") <= 255


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text, by start, then kind as in ``KINDS``."""
    found: list[tuple[int, int, int]] = []
    if not text:
        return []
    floor = dict.fromkeys(KINDS, 0)  # where the next match of a kind may start

    def keep(kind: str, start: int, end: int) -> None:
        found.append((start, KINDS.index(kind), end))

    for end, word in anchors().iter(text):
        at = end - len(word) + 1
        if word == "@":
            start = at
            while start > floor["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                keep("email", start, m.end())
                floor["email"] = m.end()
        elif word == "+":
            if at >= floor["phone"] and (m := _PHONE.match(text, at)):
                floor["phone"] = m.end()
                if 10 <= len(digits_of(m[0])) <= 15:
                    keep("phone", at, m.end())
        elif word == "://":
            if m := _LOGIN.match(text, at + 3):
                keep("login", m.start(), m.end())
        elif word in CUES:
            if at >= floor[kind := CUES[word]]:
                _after_cue(text, kind, end + 1, floor, keep)
        else:
            if at >= floor["ip"]:
                run = _DOTTED.match(text, at)
                floor["ip"] = run.end()
                if run[0].count(".") >= 3:
                    _addresses(run[0], at, keep)
            if at >= floor["card"] and (m := _CARD.match(text, at)):
                floor["card"] = m.end()
                if 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                    keep("card", at, m.end())
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def _addresses(run: str, at: int, keep) -> None:  # noqa: ANN001
    """A run of dotted numbers holds an address in each four of them."""
    parts = run.split(".")
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        size = sum(map(len, four)) + 3
        if all(map(small, four)):
            keep("ip", at, at + size)
        at += size + 1


def _after_cue(text: str, kind: str, at: int, floor: dict[str, int], keep) -> None:  # noqa: ANN001
    if kind == "account":
        if m := _ACCOUNT.match(text, at):
            keep(kind, m.start(1), m.end(1))
            floor[kind] = m.end()
    elif m := _IBAN.match(text, at):
        code = m[1]
        while code:  # words may follow the number: give up one group at a time
            if iban_checks(code):
                keep(kind, m.start(1), m.start(1) + len(code))
                floor[kind] = m.start(1) + len(code)
                break
            code = code.rpartition(" ")[0]


def find_spans(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans`` for every row of ``df``: the spans of the whole text.

    A null or empty text has no spans.  Overlaps between kinds stay; within a
    kind spans do not overlap.  Repeated rows and null keys keep their rows;
    other columns are not read.  An empty table gives an empty result.
    """
    return df.select(F.col(key), S.spans_of(find)(F.col(text)).alias("spans"))


def mask(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets;
    overlapping spans are replaced as one stretch, named after the first."""
    if not text:
        return text
    out, done = [], 0
    for kind, start, end in find(text):
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with personal data in column ``text`` masked; all other columns
    and rows stay.  Null stays null, an empty table stays empty."""

    def masked(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([mask(t) for t in batch], dtype=object)

    return df.withColumn(text, F.pandas_udf(masked, "string")(F.col(text)))


def digests(df: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, all spans."""
    s = F.col("spans")
    return find_spans(df).select(
        "doc_id",
        *(S.count(s, k).alias(f"n_{k}") for k in BASE),
        S.digest(S.only(s, BASE)).alias("base_sha256"),
        S.as_text(s).alias("spans"),
    )
