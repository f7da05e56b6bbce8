"""Dates as archival records state them, and their compatibility."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinmark.functions.normalize import strip


def date_text(standard: Column, text: Column) -> Column:
    """The standard form if there is one, else the text without a leading "active "."""
    return strip(F.coalesce(standard, F.regexp_replace(text, "^active ", "")))


def parse_date(c: Column, end: bool = False) -> Column:
    """Date of yyyy, yyyy-mm or yyyy-mm-dd; a missing part is the first, or with ``end`` the last, of its range.

    ``0``, empty and other texts give NULL.
    """
    s = strip(c)
    year = F.when(s.rlike(r"^\d{4}$"), F.concat(s, F.lit("-12-31" if end else "-01-01")))
    month = F.when(s.rlike(r"^\d{4}-\d{1,2}$"), F.concat(s, F.lit("-1")))
    day = F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), s)
    first = F.try_to_date(F.coalesce(year, month, day), "yyyy-M-d")
    return F.when(month.isNotNull() & F.lit(end), F.last_day(first)).otherwise(first)


def pad_date(c: Column) -> Column:
    """Year padded to four digits, month and day to two; a leading hyphen (before the era) stays; one trailing ``-00`` goes."""
    era = F.when(c.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    pieces = F.split(F.regexp_replace(c, "^-", ""), "-")
    pad = lambda x, n: F.when(F.length(x) >= n, x).otherwise(F.lpad(x, n, "0"))
    padded = F.transform(pieces, lambda x, i: F.when(i == 0, pad(x, 4)).when(i <= 2, pad(x, 2)).otherwise(x))
    joined = F.concat(era, F.array_join(padded, "-"))
    return F.when(c == "", c).otherwise(F.regexp_replace(joined, "-00$", ""))


def quality(rec: Column, rec_type: Column, auth: Column, born: bool) -> Column:
    """How a record's date fits an authority's: 3 same year, 2 within ten years, 1 active inside, 0 contradiction, -1 unknown.

    ``born``: the beginning (birth) or the end (death).
    """
    apart = F.abs(F.year(rec) - F.year(auth))
    inside = (rec >= auth) if born else (rec <= auth)
    life = F.when(apart == 0, 3).when(apart < 10, 2).otherwise(0)
    fit = F.when(rec_type.endswith("#Active"), F.when(inside, 1).otherwise(0)).when(rec_type.endswith("#Birth" if born else "#Death"), life)
    return F.when(rec.isNull() | auth.isNull(), -1).otherwise(F.coalesce(fit, F.lit(-1)))


def better_existence(old: Column, old_type: Column, new: Column, new_type: Column, born: bool = True) -> Column:
    """Whether a new statement of the beginning (or the end) tells more: a birth (death) instead of an activity, or more detail of the same type."""
    life = new_type.endswith("#Birth" if born else "#Death") & (old_type.isNull() | old_type.endswith("#Active"))
    detail = (new_type == old_type) & (F.length(old) < F.length(new))
    return F.coalesce(old.isNotNull() & new.isNotNull() & (life | detail), F.lit(False))
