"""String normalisers as pure column expressions (no Python in the plan).

Every function takes and returns a column; NULL gives NULL and the empty text
gives the empty text.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it (for regular expressions).
WS = r"[\s\x1c-\x1f\x85\xa0  -     　]"
# ASCII punctuation.
PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
# Legal forms left out of the names of bodies.
CORPORATE_ABBREVIATIONS = "co corp llc lp llp pllc inc pc dba gp cic cio ltd plc eg ag sa sas ptp".split()
# Date-like words.
DATE_WORDS = "d b circa ca active approximately fl c approximate".split()


def _char_class(chars: str) -> str:
    return "[" + "".join(c if c.isalnum() else "\\" + c for c in chars) + "]"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def lower_strip(c: Column) -> Column:
    """Lower case, without white space at both ends."""
    return strip(F.lower(c))


def compress_spaces(c: Column) -> Column:
    """One blank for every run of white space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def remove_punctuation(c: Column, keep: str = "-", replace_with: str = "") -> Column:
    """ASCII punctuation removed or replaced, but for the characters of ``keep``; digits stay."""
    return F.regexp_replace(c, _char_class("".join(p for p in PUNCTUATION if p not in keep)), replace_with)


def remove_punctuation_and_digits(c: Column, keep: str = "-", replace_with: str = "") -> Column:
    """The same with ASCII digits."""
    chars = "".join(p for p in PUNCTUATION + "0123456789" if p not in keep)
    return F.regexp_replace(c, _char_class(chars), replace_with)


@lru_cache(maxsize=1)
def _accents() -> tuple[str, str]:
    """Letters with marks and their bases, then the marks themselves (which translate to nothing); made by rule."""
    letters, bases, marks = [], [], []
    for cp in range(0xA0, 0x30000):
        ch = chr(cp)
        if unicodedata.category(ch) == "Mn":
            marks.append(ch)
            continue
        bare = "".join(x for x in unicodedata.normalize("NFD", ch) if unicodedata.category(x) != "Mn")
        if bare != ch and len(bare) == 1:
            letters.append(ch)
            bases.append(bare)
    return "".join(letters + marks), "".join(bases)


def strip_accents(c: Column) -> Column:
    """Letters without their marks (canonical decomposition, non-spacing marks removed).

    One table look-up per character.  Syllables that decompose into several
    letters (Hangul) stay composed.
    """
    return F.translate(c, *_accents())


def normalize(c: Column) -> Column:
    """Lower case, punctuation but hyphens removed, accents stripped."""
    return strip_accents(remove_punctuation(lower_strip(c)))


def name_key(c: Column) -> Column:
    """The key ``name_norm``: punctuation but hyphens to blanks, accents stripped, blanks compressed."""
    return compress_spaces(strip_accents(remove_punctuation(lower_strip(c), replace_with=" ")))


def letters_key(c: Column, lowercase: bool = True) -> Column:
    """Punctuation but commas, and digits, to blanks; accents stripped; blanks compressed."""
    cleaned = lower_strip(c) if lowercase else strip(c)
    return compress_spaces(strip_accents(remove_punctuation_and_digits(cleaned, keep=",", replace_with=" ")))


def entry_key(c: Column) -> Column:
    """The key under which name entries are merged: accents stay."""
    blanked = F.regexp_replace(c, r"""[/!,"();:\.?{}\-¿¡<>]""", " ")
    return F.lower(compress_spaces(F.regexp_replace(blanked, r"[\[\]']", "")))


def strip_controls(c: Column) -> Column:
    """Without control characters."""
    return F.regexp_replace(c, r"[\x00-\x1f\x7f-\x9f]", "")


def _without_words(c: Column, words: list[str]) -> Column:
    return F.array_join(F.filter(F.split(c, " "), lambda w: ~w.isin(words)), " ")


def strip_corporate_abbreviations(c: Column) -> Column:
    """Without the words for legal forms."""
    return _without_words(c, CORPORATE_ABBREVIATIONS)


def strip_date_words(c: Column) -> Column:
    """Without date-like words."""
    return _without_words(c, DATE_WORDS)


def has_digits(c: Column, n: int = 2) -> Column:
    """Whether ``n`` digits stand in a row."""
    return c.rlike(rf"\d{{{n},}}")


def digit_runs(c: Column) -> Column:
    """All runs of digits."""
    return F.regexp_extract_all(c, F.lit(r"\d+"), F.lit(0))


def collapse(c: Column) -> Column:
    """Words without accents and case between single blanks (for token blocking)."""
    return compress_spaces(strip_accents(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\p{M}]+", " ")))
