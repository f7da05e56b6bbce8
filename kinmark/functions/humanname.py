"""Personal names taken apart, and how well two of them match."""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmark.functions.similarity import jaro_bytes

# Titles before and suffixes behind a personal name.
TITLES = frozenset("mr mrs ms miss dr prof rev sir lady dame lord hon capt captain col gen maj sgt lt fr sister brother".split())
SUFFIXES = frozenset("jr sr ii iii iv v esq phd md".split())
_BRACKETS = re.compile(r"[(\[].*?[)\]]")
_CONTROL = re.compile(r"[\x00-\x1f\x7f-\x9f]")
_NOT_LETTERS = re.compile(r"""[!"#$%&'()*+\-./:;<=>?@\[\\\]^_`{|}~0-9]""")
MAYBE = 0.89999


class HumanName(NamedTuple):
    """Parts of a personal name; absent ones are empty."""

    title: str
    first: str
    middle: str
    last: str
    suffix: str

    def parts(self) -> int:
        """Number of parts that are there."""
        return sum(map(bool, self))


def split_name(text: str) -> HumanName:
    """``Last, First Middle, Suffix`` or ``First Middle Last Suffix``; titles and suffixes by their words."""
    pieces = [p.split() for p in text.split(",")]
    title = ""

    def untitled(words: list[str]) -> list[str]:
        nonlocal title
        while words and words[0].lower() in TITLES:
            title = f"{title} {words[0]}".strip()
            words = words[1:]
        return words

    suffix = [w for p in pieces[1:] for w in p if w.lower() in SUFFIXES]
    title_words = [w for p in pieces[2:] for w in p if w.lower() in TITLES]
    if len(pieces) > 1 and any(w not in suffix for p in pieces[1:] for w in p):
        last = " ".join(pieces[0])
        given = untitled([w for w in pieces[1] if w not in suffix])
        first, middle = (given[0] if given else ""), " ".join(given[1:])
    else:
        words = untitled(pieces[0])
        while len(words) > 1 and words[-1].lower() in SUFFIXES:
            suffix.append(words.pop())
        first = words[0] if words else ""
        last = words[-1] if len(words) > 1 else ""
        middle = " ".join(words[1:-1])
    return HumanName(title or " ".join(title_words), first, middle, last, " ".join(suffix))


def cleaned(text: str) -> str:
    """Without bracketed text, punctuation but commas, digits, accents and control characters."""
    s = _NOT_LETTERS.sub(" ", _BRACKETS.sub("", text).strip())
    if not s.isascii():
        s = "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")
    return _CONTROL.sub("", " ".join(s.split()))


def match_quality(x: str, y: str) -> float:
    """0 to 1: how likely two names as written are one person's.

    Different family names, middle names or initials give 0; equal full names 1;
    an initial that stands for a full middle name 0.99; anything else the Jaro
    similarity, of which 0.9 and more counts as 0.89999 (a maybe).  A family
    name of one letter in the first name, the heading, decides nothing.
    """
    return _matched(*_taken_apart(x), *_taken_apart(y))


def _taken_apart(text: str) -> tuple[str, HumanName]:
    s = cleaned(text)
    return s, split_name(s)


def _matched(x: str, a: HumanName, y: str, b: HumanName) -> float:
    verdict: float | None = None
    if a.parts() > 1 and b.parts() > 1:
        if len(a.last) > 1:
            verdict = _by_parts(a, b)
    elif a.parts() == 1 and b.parts() == 1 and a.first and a.first == b.first:
        verdict = 1.0
    if verdict is not None:
        return verdict
    whole = jaro_bytes(x.encode(), y.encode())  # only where the parts leave it open
    return MAYBE if whole >= 0.9 else whole


def _by_parts(a: HumanName, b: HumanName) -> float | None:
    if a.last != b.last:
        return 0.0
    if a.first == b.first and len(a.first) > 1:
        if not a.middle or not b.middle:
            return None
        # a married woman's name may be her husband's; of the first name's title alone, of the second's if the titles differ
        if a.title.lower() == "mrs" or (b.title.lower() == "mrs" and a.title != b.title):
            return None
        if len(a.middle) > 1 and len(b.middle) > 1:
            return 1.0 if a.middle == b.middle else 0.0
        if a.middle[0] != b.middle[0]:
            return 0.0
        return 0.99
    if len(a.first) == 1 or len(b.first) == 1:
        same_middle = len(a.middle) > 1 and len(b.middle) > 1 and a.middle == b.middle
        if same_middle and a.first[:1] == b.first[:1]:
            return 1.0
    return None


@F.pandas_udf(T.DoubleType())
def _quality(x: pd.Series, y: pd.Series) -> pd.Series:
    known: dict[tuple[str, str], float] = {}
    apart: dict[str, tuple[str, HumanName]] = {}
    out: list[float | None] = []
    for k in zip(x, y, strict=True):
        if k not in known:
            for t in k:
                if t is not None and t not in apart:
                    apart[t] = _taken_apart(t)
            known[k] = None if k[0] is None or k[1] is None else _matched(*apart[k[0]], *apart[k[1]])
        out.append(known[k])
    return pd.Series(out, dtype="float64")


def name_match_quality(x: Column, y: Column) -> Column:
    """Column of match qualities; NULL for NULL."""
    return F.when(x.isNotNull() & y.isNotNull(), _quality(x, y))
