"""One form for texts that look the same but differ in their characters.

Steps: compatibility normalization (full-width forms, ligatures, special
blanks), deletion of ignorable characters (zero-width, soft hyphen, marks of
direction), one blank for any run of blanks, one hyphen for its look-alikes;
then a lattice in which every letter stands beside its look-alikes of other
scripts, searched with Viterbi.  The state of a position is its script, its
score the log probability of the letter after the letter before it in that
script; a change of script costs little between words and much within one.
Letters that exist in one script only pin their word, so genuine names in
another script stay in it, and words made of shared shapes follow the letter
statistics and their neighbours.  Composition (NFC) comes last.

The letter statistics are counted over every given text, from words whose
letters can only be of one script; they are bounded by the square of the
alphabets, so the model is small whatever the corpus.

Edge cases: NULL stays NULL; an empty or blank text becomes the empty text;
very long texts are searched in linear time; without any training word the
penalties alone decide.
"""

from __future__ import annotations

import math
import unicodedata
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters of other scripts that look like a Latin letter, and that letter.
CYRILLIC = "аеорсухіѕјһԁԛԝӏүѵАВЕКМНОРСТУХІЅЈӀҮѴԌԚԜ"
CYRILLIC_AS_LATIN = "aeopcyxisjhdqwlyvABEKMHOPCTYXISJIYVGQW"
GREEK = "ονρυικγαΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲϹϳͿ"
GREEK_AS_LATIN = "ovpuikyaABEZHIKMNOPTYXcCjJ"
ARMENIAN = "օոսհցզյՕՍՏ"
ARMENIAN_AS_LATIN = "onuhgqjOUS"
# Characters that look like a hyphen or an apostrophe.
HYPHENS = "‐‑‒–−­"
APOSTROPHES = "‘’ʼ′"

SCRIPTS = "LCGA"
SWITCH_IN_WORD, SWITCH_BETWEEN_WORDS, FOREIGN = 14.0, 2.0, 40.0

_ALIKE: dict[str, dict[str, str]] = {}
for _own, _latin, _script in ((CYRILLIC, CYRILLIC_AS_LATIN, "C"), (GREEK, GREEK_AS_LATIN, "G"), (ARMENIAN, ARMENIAN_AS_LATIN, "A")):
    for _c, _l in zip(_own, _latin, strict=True):
        _ALIKE.setdefault(_l, {"L": _l}).setdefault(_script, _c)
# a letter that is not its script's first look-alike of a Latin one stays itself in its own script
for _own, _latin, _script in ((CYRILLIC, CYRILLIC_AS_LATIN, "C"), (GREEK, GREEK_AS_LATIN, "G"), (ARMENIAN, ARMENIAN_AS_LATIN, "A")):
    for _c, _l in zip(_own, _latin, strict=True):
        _ALIKE[_c] = {**_ALIKE[_l], _script: _c}
_FOLD = {ord(c): "-" for c in HYPHENS if c != "­"} | {ord(c): "'" for c in APOSTROPHES}


def script_of(c: str) -> str:
    """L, C, G or A for letters of these scripts, else empty."""
    o = ord(c)
    if o < 0x250 or 0x1E00 <= o < 0x1F00:
        return "L" if c.isalpha() else ""
    if 0x400 <= o < 0x530:
        return "C"
    if 0x530 <= o < 0x590:
        return "A" if c.isalpha() else ""
    return "G" if 0x370 <= o < 0x400 and c.isalpha() else ""


def tidy(text: str) -> str:
    """Compatibility normalization, ignorables deleted, blanks and hyphens unified."""
    s = unicodedata.normalize("NFKC", text).translate(_FOLD)
    if not s.isascii():
        s = "".join(c for c in s if unicodedata.category(c) != "Cf")
    return " ".join(s.split())


@dataclass
class LetterModel:
    """Bigram log probabilities by script; ``^`` stands for a word's start."""

    counts: dict[str, dict[str, float]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.logp: dict[str, dict[str, float]] = {}
        self.floor: dict[str, float] = {}
        for s in SCRIPTS:
            pairs = self.counts.get(s, {})
            left: dict[str, float] = {}
            for ab, n in pairs.items():
                left[ab[0]] = left.get(ab[0], 0) + n
            self.logp[s] = {ab: math.log((n + 0.1) / (left[ab[0]] + 10)) for ab, n in pairs.items()}
            self.floor[s] = -9.0 if pairs else -11.0

    def canonical(self, text: str) -> str:
        """The form in which texts that look the same are equal."""
        s = tidy(text)
        if s.isascii():
            return s
        scripts = {script_of(c) for c in s} - {""}
        if not scripts - {"L"}:
            return s
        return unicodedata.normalize("NFC", self._search(s))

    def _search(self, s: str) -> str:
        costs = {x: (0.0 if x == "L" else 0.5) for x in SCRIPTS}
        back: list[dict[str, tuple[str, str]]] = []
        last = {x: "^" for x in SCRIPTS}
        inside = False
        for c in s:
            own = script_of(c)
            if not own:
                if not unicodedata.combining(c):
                    inside = False
                    last = dict.fromkeys(SCRIPTS, "^")
                back.append({x: (x, c) for x in SCRIPTS})
                continue
            alike = _ALIKE.get(c) or {own: c}
            step: dict[str, tuple[str, str]] = {}
            new_costs: dict[str, float] = {}
            new_last: dict[str, str] = {}
            for x in SCRIPTS:
                letter = alike.get(x)
                low = (letter or c).lower()
                if letter is None:
                    emit = FOREIGN
                else:
                    emit = 0.0
                best = None
                for y in SCRIPTS:
                    cost = costs[y]
                    if y != x:
                        cost += SWITCH_IN_WORD if inside else SWITCH_BETWEEN_WORDS
                    if letter is not None:
                        before = last[y] if y == x or not inside else "^"
                        cost -= self.logp[x].get(before + low, self.floor[x])
                    if best is None or cost < best[0]:
                        best = (cost, y)
                new_costs[x] = best[0] + emit
                step[x] = (best[1], letter or c)
                new_last[x] = low
            costs, last, inside = new_costs, new_last, True
            back.append(step)
        at = min(costs, key=costs.get)
        out = []
        for step in reversed(back):
            at, c = step[at]
            out.append(c)
        return "".join(reversed(out))


def fit(names: DataFrame, *columns: str) -> LetterModel:
    """Letter statistics over all texts of the columns of ``names``."""
    only_cyrillic = f"[\\p{{IsCyrillic}}&&[^{CYRILLIC}]]"
    only_greek = f"[\\p{{IsGreek}}&&[^{GREEK}]]"
    only_armenian = f"[\\p{{IsArmenian}}&&[^{ARMENIAN}]]"
    texts = reduce(DataFrame.unionByName, [names.select(F.col(c).alias("t")) for c in columns]).where("t IS NOT NULL")
    bare = F.regexp_replace("t", r"\p{Cf}", "")
    words = texts.select(F.explode(F.regexp_extract_all(bare, F.lit(r"(?U)\p{L}+"), F.lit(0))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    script = (
        F.when(F.col("w").rlike(r"^\p{IsLatin}+$"), "L")
        .when(F.col("w").rlike(rf"^\p{{IsCyrillic}}+$") & F.col("w").rlike(only_cyrillic), "C")
        .when(F.col("w").rlike(rf"^\p{{IsGreek}}+$") & F.col("w").rlike(only_greek), "G")
        .when(F.col("w").rlike(rf"^\p{{IsArmenian}}+$") & F.col("w").rlike(only_armenian), "A")
    )
    padded = F.concat(F.lit("^"), F.lower("w"))
    pairs = F.transform(F.sequence(F.lit(1), F.length("w")), lambda i: F.substring(padded, i, F.lit(2)))
    counted = words.select(script.alias("s"), "n", "w").where("s IS NOT NULL").select("s", "n", F.explode(pairs).alias("p")).groupBy("s", "p").agg(F.sum("n").alias("n"))
    counts: dict[str, dict[str, float]] = {}
    for r in counted.collect():  # at most the square of the alphabets
        counts.setdefault(r.s, {})[r.p] = float(r.n)
    return LetterModel(counts)


def canonical(model: LetterModel, text: Column) -> Column:
    """Column of canonical forms; texts of ASCII only never leave the JVM."""

    @F.pandas_udf("string")
    def lattice(values: pd.Series) -> pd.Series:
        known: dict[str, str] = {}
        out = []
        for v in values:
            if v is not None and v not in known:
                known[v] = model.canonical(v)
            out.append(None if v is None else known[v])
        return pd.Series(out, dtype=object)

    plain = text.rlike(r"^\p{ASCII}*$")
    unchanged = F.trim(F.regexp_replace(text, r"[\s\x1c-\x1f]+", " "))
    return F.when(plain, unchanged).otherwise(lattice(F.when(~plain, text)))


def alike_pairs(df: DataFrame, row_id: str, canon: str, stored: str) -> DataFrame:
    """id_a, id_b (id_a < id_b) of rows with one canonical form whose stored texts differ.

    Equal stored texts are first merged to one variant; variants, not rows, are
    compared within a form, and rows come back only for pairs that are part of
    the result, so a text repeated a million times meets no other row in vain.
    """
    rows = df.where(F.col(stored).isNotNull()).select(F.col(row_id).alias("id"), F.col(canon).alias("form"), F.col(stored).alias("text"))
    variants = rows.select("form", "text").distinct()
    several = variants.groupBy("form").agg(F.count("*").alias("k")).where("k > 1").select("form")
    live = variants.join(several, "form")
    pairs = live.alias("a").join(live.alias("b"), "form").where(F.col("a.text") < F.col("b.text")).select("form", F.col("a.text").alias("text_a"), F.col("b.text").alias("text_b"))
    left = rows.select("form", F.col("text").alias("text_a"), F.col("id").alias("x"))
    right = rows.select("form", F.col("text").alias("text_b"), F.col("id").alias("y"))
    joined = pairs.join(left, ["form", "text_a"]).join(right, ["form", "text_b"])
    return joined.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
