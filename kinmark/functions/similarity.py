"""String similarities."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jaro_bytes(a: bytes, b: bytes) -> float:
    """Jaro similarity of two byte strings, 0 to 1; two empty ones are unlike."""
    if a == b:
        return 1.0 if a else 0.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(0, max(n, m) // 2 - 1)
    # a text of one letter a byte, in which a letter that was met gives way to one that no byte is
    left = b.decode("latin-1")
    met: list[str] = []
    places: list[int] = []
    for i, c in enumerate(a.decode("latin-1")):
        j = left.find(c, max(0, i - reach), i + reach + 1)
        if j >= 0:
            left = f"{left[:j]}\u0100{left[j + 1 :]}"
            met.append(c)
            places.append(j)
    common = len(met)
    if not common:
        return 0.0
    swapped = sum(ord(x) != b[j] for x, j in zip(met, sorted(places), strict=True)) // 2
    return (common / n + common / m + (common - swapped) / common) / 3


@F.pandas_udf(T.DoubleType())
def _jaro(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple, float | None] = {}
    out = []
    for key in zip(a, b, strict=True):
        if key not in known:
            known[key] = None if key[0] is None or key[1] is None else jaro_bytes(key[0].encode(), key[1].encode())
        out.append(known[key])
    return pd.Series(out, dtype="float64")


def jaro(a: Column, b: Column) -> Column:
    """Jaro similarity on UTF-8 bytes; NULL for NULL."""
    return F.when(a.isNotNull() & b.isNotNull(), _jaro(a, b))


def relative_length(a: Column, b: Column) -> Column:
    """Difference of the lengths over their sum; NULL for two empty texts."""
    return F.try_divide(F.abs(F.length(a) - F.length(b)).cast("double"), (F.length(a) + F.length(b)).cast("double"))


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the words, each padded with two blanks before and one behind."""
    words = F.filter(F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams of both texts (by their arrays of trigrams)."""
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double"))
