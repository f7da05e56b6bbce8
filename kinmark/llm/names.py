"""Typed names of persons, bodies and families taken apart into comparable pieces.

A name in its canonical form is folded (case, marks, transliteration of
Cyrillic and equal-sounding spellings) and split into a core (family name, or
the distinctive word of a body), given names or the kind of body, a unit, and
years.  Nicknames and abbreviations are resolved to the formal given names they
may stand for.  Names of nobody in particular have no core.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd

# Cyrillic letters and the Latin spelling they come from.
_CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшыэюя", ["a", "b", "v", "g", "d", "e", "zh", "z", "i", "i", "k", "l", "m", "n", "o", "p", "r", "s", "t", "u", "f", "h", "ts", "kh", "sh", "i", "e", "iu", "ia"], strict=True))
_PLAIN = {"ø": "o", "ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i"}
# Nicknames and abbreviations of given names.
NICKNAMES = """
abigail: abby | alexander: alexr alex sandy | agnes: nessie | ambrose: amb | anthony: tony anty | arthur: art | augustus: augs gus
beatrix: trixie bea | benjamin: ben benj | catherine: cath kate kitty | charles: charlie chuck chas | charlotte: lottie | cornelius: neil corns
daniel: dan danl | dorothy: dot dolly | edward: edw ned ted eddie | eleanor: nell nora | elizabeth: betty bess liz eliza | frances: fanny fran
frederick: fredk fritz fred | george: geo georgie | gregory: greg | harriet: hatty hattie | helena: nell lena | henry: hal harry hy
isabella: bella ibby | james: jas jim jimmy | john: jno jack johnny | joseph: joe jos | josephine: josie jo | lawrence: larry laurie
leopold: leo poldi | margaret: maggie meg peggy margt | martha: patty mattie | mary: polly molly | michael: mike mick | nathaniel: nat nathl
philip: phil pip | philippa: pippa | rebecca: becky | richard: richd rick dick | robert: bob robt rob bobby | samuel: sam saml | sarah: sadie sally
susanna: sukey sue | theodore: theo teddy ted | theresa: terry tess | thomas: tom tommy thos | victoria: vicky tory | vincent: vince
walter: walt wat | wilhelmina: willa mina | william: billy wm bill will | zachary: zack
"""
# Words before or after a personal name.
TITLES = frozenset("rev capt dr prof sir lady miss mrs mr hon col maj gen lt sgt fr".split())
# Abbreviated words in the names of bodies.
ABBREVIATIONS = dict(x.split("=") for x in "co=company mfg=manufacturing publ=publishing soc=society univ=university bros=brothers bd=board geol=geological rwy=railway corp=corporation assn=association ins=insurance med=medical inst=institute hist=historical mus=museum coll=college agric=agricultural comm=committee dept=department obs=observatory lib=library sch=school fam=family".split())
# Words that tell the kind of a body.
KIND_WORDS = frozenset(
    "company manufacturing publishing society university brothers board geological railway corporation association insurance medical institute historical museum college "
    "agricultural shipping trading law theatre chamber orchestra savings bank textile typographical union mission athletic club house natural history observatory survey "
    "instrument works academy school hospital library council guild league press church trust foundation office bureau".split()
)
# Words in the names of units.
UNIT_WORDS = frozenset("department school board library committee women's auxiliary trustees publications music chemistry law office faculty section division".split())
# Words that stand for no name.
NOBODY = frozenset("anonymous anon unknown unidentified sitter unnamed nameless person artist author photographer not identified given no name nn".split())


def sound(word: str) -> str:
    """One spelling for a folded word's equal-sounding spellings."""
    w = word.replace("th", "t").replace("ph", "f").replace("ck", "k").replace("c", "k").replace("q", "k").replace("w", "v").replace("y", "i").replace("j", "i").replace("x", "ks")
    return re.sub(r"(.)\1+", r"\1", w)


def fold(text: str) -> str:
    """Lower case, marks removed, Cyrillic transliterated."""
    s = "".join(c for c in unicodedata.normalize("NFD", text.lower().replace("й", "и")) if unicodedata.category(c) != "Mn")
    if s.isascii():
        return s
    return "".join(_CYRILLIC.get(c) or _PLAIN.get(c) or c for c in s)


FORMAL: dict[str, frozenset[str]] = {}
for _entry in re.split(r"[|\n]", NICKNAMES):
    if _entry.strip():
        _formal, _nicks = _entry.split(":")
        _formal = sound(_formal.strip())
        FORMAL[_formal] = FORMAL.get(_formal, frozenset()) | {_formal}
        for _n in map(sound, _nicks.split()):
            FORMAL[_n] = FORMAL.get(_n, frozenset()) | {_formal}

_YEARS = re.compile(r"(?:(?<!\d)(\d{4})\s*-\s*(\d{4})?(?!\d))|(?:\bb\.?\s*(\d{4}))|(?:\bd\.?\s*(\d{4}))|(?:\bborn\s+(\d{4}))|(?:\bdied\s+(\d{4}))")
_WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_PAREN = re.compile(r"\(([^()]*)\)")
_KIND_SOUND = {sound(w): w for w in KIND_WORDS}
#: Given names of at least so many letters may differ by more than one error.
LONG_GIVEN = 9
_SKIP = frozenset("the and of for on in inc a s ltd".split())


def years(text: str) -> tuple[int | None, int | None]:
    """Years of birth and death stated in a folded text."""
    birth = death = None
    for m in _YEARS.finditer(text):
        b, d = m.group(1) or m.group(3) or m.group(5), m.group(2) or m.group(4) or m.group(6)
        birth, death = birth or (int(b) if b else None), death or (int(d) if d else None)
    return birth, death


def _given(text: str) -> list[str]:
    return [w for w in _WORDS.findall(text) if w not in TITLES]


def _kind(word: str) -> str | None:
    w = ABBREVIATIONS.get(word, word)
    if w in KIND_WORDS:
        return w
    s = sound(w)
    if s in _KIND_SOUND:
        return _KIND_SOUND[s]
    if len(s) >= 6:
        for k, v in _KIND_SOUND.items():
            if abs(len(k) - len(s)) <= 1 and k[0] == s[0] and near(k, s):
                return v
    return None


def near(a: str, b: str) -> bool:
    """One letter added, left out, changed, or two neighbours exchanged."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


Parts = tuple[str | None, str | None, str | None, str | None, int | None, int | None]


def parse(name: str | None, kind: str | None) -> Parts:
    """(core, other core, first given name or kind of body, second given name or unit, birth, death) of a canonical name.

    A NULL, empty or nobody's name gives NULL for the core.
    """
    if not name:
        return (None,) * 6
    text = fold(name)
    birth, death = years(text)
    if kind == "family" or (kind == "person" and re.search(r"\bfam(?:ily)?\b", text) and "," not in text):
        bare = re.sub(r"\bof\s+\S+.*$", " ", re.sub(r"\(\s*[\d-].*?\)", " ", text))
        words = [w for w in _WORDS.findall(bare) if w not in ("family", "fam", "the") and not near(w, "family")]
        return (sound("".join(words)) or None, None, "", "", birth, death)
    if kind == "corporateBody":
        return _parse_body(text, birth, death)
    return _parse_person(text, birth, death)


def _parse_person(text: str, birth: int | None, death: int | None) -> Parts:
    full: list[str] = []
    for inner in _PAREN.findall(text):
        full += [w for w in _given(inner) if len(w) > 1 and w not in ("b", "d", "ca")]
    text = re.sub(r"\[.*?\]", lambda m: m.group(0).strip("[]"), _PAREN.sub(" ", text))
    text = re.sub(r"\b(?:b|d|born|died|ca|active|fl)\.?\s*(?=\d)", " ", text)
    if "," in text:
        head, _, tail = text.partition(",")
        last, given = [w for w in _WORDS.findall(head.replace("-", " ")) if w not in TITLES], _given(tail)
    else:
        words = _given(text.replace("-", " ") if "-" in text and not re.search(r"\d", text) else text)
        last, given = words[-1:], words[:-1]
        if "-" in text and (m := re.search(r"([^\W\d_]+)-([^\W\d_]+)\s*$", text)):
            last, given = [m.group(1), m.group(2)], [w for w in given if w != m.group(1)]
    if not last or (set(last) | set(given)) <= NOBODY:
        return (None, None, None, None, birth, death)
    if full and all(len(w) == 1 for w in given):
        given = full
    given = [sound(w) for w in given]
    return (sound(last[0]), sound(last[1]) if len(last) > 1 else None, given[0] if given else "", given[1] if len(given) > 1 else "", birth, death)


def _parse_body(text: str, birth: int | None, death: int | None) -> Parts:
    if m := re.match(r"^(?:[^\W\d_]\.\s*){2,}\((.*)\)", text):
        text = m.group(1) + text[m.end() :]
    unit = ""
    text = _PAREN.sub(" ", text)
    if m := re.search(r"\.+\s+(?=[^\W\d_]{4,}|comm|dept|sch|lib)", text):
        after = text[m.end() :]
        words = [ABBREVIATIONS.get(w, w) for w in _WORDS.findall(after)]
        before = text[: m.start()]
        # an abbreviation's own full stop is no border unless a unit's words follow
        if words and words[0] in ("department", "school", "board", "library", "committee", "women's", "office", "faculty", "section", "auxiliary", "division"):
            unit, text = " ".join(sound(w) for w in words if w not in _SKIP), before
    if not unit and (m := re.match(r"(?:department|dept\.?|school|board|library|committee|comm\.?|women's|office|faculty)\b([^,]*),\s*(?=\S)", text)):
        first_word = text.split(",")[0]
        words = [ABBREVIATIONS.get(w, w) for w in _WORDS.findall(first_word)]
        if all(_kind(w) or w in _SKIP or w in UNIT_WORDS for w in words):
            unit, text = " ".join(sound(w) for w in words if w not in _SKIP), text[m.end() :]
    chunks = [[w for w in _WORDS.findall(c) if w not in _SKIP] for c in text.split(",")]
    kinds: list[str] = []
    core: str | None = None
    for chunk in chunks:
        found = [(w, _kind(w)) for w in chunk]
        names = [w for w, k in found if k is None]
        if core is None and names:
            core = sound("".join(names))
            kinds += [k for _, k in found if k]
        elif core is None or (any(k for _, k in found) and not kinds):
            kinds += [k for _, k in found if k]
    if core is None or set(re.findall(r"[a-z]+", core)) <= NOBODY:
        return (None, None, None, None, birth, death)
    return (core, None, " ".join(sorted(set(kinds))), unit, birth, death)


@lru_cache(maxsize=65536)
def formal(first: str) -> frozenset[str]:
    """The formal given names a typed one may stand for; a typing error within one letter is mended."""
    if first in FORMAL:
        return FORMAL[first]
    if len(first) >= 4:
        close = [f for f in FORMAL if abs(len(f) - len(first)) <= 1 and len(f) >= 4 and near(f, first)]
        if close:
            return frozenset().union(*(FORMAL[f] for f in close))
    return frozenset((first,)) if first else frozenset()


def agree(a: str, b: str) -> int:
    """2: one given name; 1: an initial or nothing speaks against it; 0: unknown on one side; -1: different."""
    if not a or not b:
        return 0
    fa, fb = formal(a), formal(b)
    if len(a) == 1 or len(b) == 1:
        return 1 if {x[0] for x in fa} & {x[0] for x in fb} or a[0] == b[0] else -1
    if fa & fb:
        return 2
    return 2 if one_given(a, b) else -1


def one_given(a: str, b: str) -> bool:
    """Whether two given names are one with typing errors: four fifths are common, and but for long ones all letters of the longer save one."""
    ratio = lcs_ratio(a, b)
    return ratio >= 0.8 and (ratio >= 1 - 1 / max(len(a), len(b)) - 1e-9 or min(len(a), len(b)) >= LONG_GIVEN)


def lcs_ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence's length over both lengths (bit-parallel)."""
    if not a or not b:
        return 0.0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return 2 * (len(a) - v.bit_count()) / (len(a) + len(b))


def initials(first: str) -> str:
    """Letters with which the formal given names begin that a typed one may stand for."""
    return "".join(sorted({f[0] for f in formal(first)} | {first[0]})) if first else ""


def error_keys(word):  # noqa: ANN001, ANN201
    """Column of keys of a word; two words one error apart (as in ``near``) have one in common.

    The word and all it gives when one letter is left out; of a long word, whose
    letters would make many keys, either end, one of which an error leaves as it was.
    """
    from pyspark.sql import functions as F

    n, end = F.length(word), 12
    less = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, n)))
    short = F.when((n > 0) & (n <= 2 * end + 2), F.concat(F.array(word), less))
    long = F.when(n >= 2 * end, F.array(F.concat(F.lit("<"), F.left(word, F.lit(end))), F.concat(F.lit(">"), F.right(word, F.lit(end)))))
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(short, none), F.coalesce(long, none)))


def near_keys(first):  # noqa: ANN001, ANN201
    """Column of few keys of a given name; two names one error apart have one in common.

    One error leaves three letters at one end of a name of seven and more; of
    shorter ones there are few keys in all.
    """
    from pyspark.sql import functions as F

    none, n = F.array().cast("array<string>"), F.length(first)
    ends = F.array(F.concat(F.lit("<"), F.left(first, F.lit(3))), F.concat(F.lit(">"), F.right(first, F.lit(3))))
    return F.concat(F.when(n <= 6, error_keys(first)).otherwise(none), F.when(n >= 6, ends).otherwise(none))


def formal_names(first):  # noqa: ANN001, ANN201
    """Column of the formal given names a typed one may stand for."""
    from pyspark.sql import functions as F

    @F.pandas_udf("array<string>")
    def names(first: pd.Series) -> pd.Series:
        return pd.Series([sorted(formal(x)) if x else [] for x in first], dtype=object)

    return names(first)


PARTS = "form string, core string, core2 string, first string, second string, initials string, birth int, death int"


def parts_column(model, name, kind):  # noqa: ANN001, ANN201
    """Column of the parts of a name, by way of its canonical form."""
    from pyspark.sql import functions as F

    @F.pandas_udf(PARTS)
    def split(names: pd.Series, kinds: pd.Series) -> pd.DataFrame:
        known: dict[tuple[str | None, str | None], tuple] = {}
        rows = []
        for key in zip(names, kinds, strict=True):
            if key not in known:
                form = None if key[0] is None else model.canonical(key[0])
                core, core2, first, second, birth, death = parse(form, key[1])
                known[key] = (form, core, core2, first, second, initials(first or "") if key[1] == "person" else "", birth, death)
            rows.append(known[key])
        out = pd.DataFrame(rows, columns=["form", "core", "core2", "first", "second", "initials", "birth", "death"])
        return out.astype({"birth": "Int32", "death": "Int32"})

    return split(name, kind)
