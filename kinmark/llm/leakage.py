"""Evaluation texts leaking into training text, by pigeonhole edit matching.

A case is a run of ``RUN`` words of an item, or a stretch of at least
``STRETCH`` words of it (a shorter item counts as a whole) with at most one
edit in ``PIECE`` words.  A stretch of 64 words and more has a shorter one
within it that is a case (of two parts one keeps to its budget), and one of 32
to 63 words may be cut to a multiple of 8; so only stretches of these few
lengths (``LENGTHS``) need be looked for, at every place of an item.

1. Pieces.  A stretch with a budget of k edits is split into k + 1 pieces, of
   which k edits leave one whole; its n - k unchanged words give that piece
   (n - k) / (k + 1) words.  The pieces of the stretches at every place are all
   turns of ``seed`` words of the item; they are looked up in the text by hash.
2. Hits.  An item goes on if around one of its hits as many words occur, no
   further off than there are edits, as a case keeps.
3. Verification.  A hit is extended to the longest unchanged run, and from there
   to both sides by Myers' bit-parallel distance, which gives the least number
   of edits for every number of words at once; all divisions of the edits
   between the sides are tried.  Neither kind of case can be missed, whatever
   lies between the unchanged words.

Texts are compared as words in lower case: markup and punctuation are removed,
entities are resolved, compatibility forms (full-width letters, ligatures,
combining accents) are normalised, and invisible characters (zero-width blanks
and joiners, soft hyphens) are deleted without cutting the word they stand in.

Scale: documents are never shuffled; the items are a stated query set that is
handled in blocks whose seed tables have a fixed bound (``BLOCK_WORDS``), one
pass over the corpus for each block.  Texts of plain ASCII are taken apart in
the JVM.

Edge cases: NULL or empty texts give no row; NULL or empty items are left out;
items shorter than a run are found as a whole only; repeated items are
reported under each id; a repeated document is reported once per row.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words in a piece; the edit budget is one word in PIECE.
PIECE = 8
#: An unchanged run of this many words is a case.
RUN = 16
#: A stretch with changed words is a case from this length on.
STRETCH = 32
#: Words of items in one table of seeds.
BLOCK_WORDS = 2_000_000
#: Words of documents that are looked up at once.
CHUNK_WORDS = 50_000
#: Lengths of the stretches of which every longer case holds one, the longest of them and the edits in it.
LENGTHS = range(STRETCH, 2 * STRETCH, PIECE)
SPAN = LENGTHS[-1]
FEW = SPAN // PIECE
#: Hits that are looked at together.
TOGETHER = 20_000

FOUND = "doc_id bigint, item_id bigint, run int, stretch int, distance int"


_TAG = regex.compile(r"<[^<>]{0,200}>")
_INVISIBLE = regex.compile(r"\p{Cf}+")
_WORD = regex.compile(r"[\p{L}\p{N}\p{M}]+")


def normalised(text: Column) -> Column:
    """Words in lower case between single blanks, markup and punctuation removed; for texts that are ``plain``."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(text, r"<[^<>]{0,200}>", " ")), r"[^a-z0-9]+", " "))


def plain(text: Column) -> Column:
    """Whether a text has characters of ASCII only and no entity."""
    return text.rlike(r"^\p{ASCII}*$") & ~F.contains(text, F.lit("&"))


def words_of(text: str) -> list[str]:
    """Words of any text, as ``normalised`` has them for a plain one."""
    bare = _TAG.sub(" ", text)
    if "&" in bare:
        bare = html.unescape(bare)
    return _WORD.findall(unicodedata.normalize("NFKC", _INVISIBLE.sub("", bare)).lower())


def pieces(words: list[str], piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, end) of the error-budget-plus-one pieces of an item, none longer than ``piece``."""
    n = -(-len(words) // piece)
    cuts = [len(words) * i // n for i in range(n + 1)] if n else []
    return list(zip(cuts, cuts[1:], strict=False))


def myers(pattern: list[str], text: list[str]) -> int:
    """Least edit distance, in words, of the pattern to any stretch of the text (bit-parallel)."""
    m = len(pattern)
    if not m:
        return 0
    eq: dict[str, int] = {}
    for i, w in enumerate(pattern):
        eq[w] = eq.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for w in text:
        e = eq.get(w, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        best = min(best, score)
    return best


def seed(n: int) -> int:
    """Words in a row that are unchanged in every case of an item of n words."""
    shortest = [m for m in LENGTHS if m <= n] or [n]
    return min(-(-(m - m // PIECE) // (m // PIECE + 1)) for m in shortest)


def hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` words in a row; equal words give equal hashes."""
    n = max(0, len(ids) - size + 1)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + n].astype(np.uint64)
        h ^= h >> np.uint64(29)
    return h


class Seeds:
    """Seeds of all items by length, and the numbers (from 1) of their words."""

    def __init__(self, items: list[tuple[int, list[str]]]) -> None:
        self.number: dict[str, int] = {}
        self.items = [[self.number.setdefault(w, len(self.number) + 1) for w in words] for _, words in items]
        # all items in one array, so far apart that what lies around a place is of one item
        self.length = np.array([len(x) for x in self.items])
        self.offset = SPAN + np.cumsum(self.length + SPAN) - self.length - SPAN
        self.flat = np.full(SPAN + int((self.length + SPAN).sum()), -1, dtype=np.int32)
        for start, x in zip(self.offset, self.items, strict=True):
            self.flat[start : start + len(x)] = x
        by_size: dict[int, list[int]] = {}
        for n, words in enumerate(self.items):
            by_size.setdefault(seed(len(words)), []).append(n)
        self.tables = []
        for size, numbers in sorted(by_size.items()):
            h = [hashes(np.array(self.items[n], dtype=np.int64), size) for n in numbers]
            item = np.repeat(np.array(numbers), [len(x) for x in h])
            at = np.concatenate([np.arange(len(x)) for x in h])
            h = np.concatenate(h)
            order = np.argsort(h, kind="stable")
            self.tables.append((size, h[order], item[order], at[order]))

    def ids(self, words: list[str]) -> np.ndarray:
        """Numbers of words; 0 for those that no item has."""
        return np.fromiter(map(self.number.get, words, repeat(0)), dtype=np.int64, count=len(words))

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, int, int, int, bool]]:
        """(position in ids, item number, position in the item, length, whether a case may pass here) of the first seed of every unchanged run."""
        wide = np.concatenate([np.zeros(SPAN + FEW, np.int32), ids.astype(np.int32), np.zeros(SPAN + FEW, np.int32)])
        for size, table, item, at in self.tables:
            n = max(0, len(ids) - size + 1)
            known = np.ones(n, dtype=bool)
            for i in range(size):
                known &= ids[i : i + n] > 0
            where = np.flatnonzero(known)
            h = hashes(ids, size)[where]
            first = np.searchsorted(table, h, "left")
            count = np.searchsorted(table, h, "right") - first
            j = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            for k in range(0, len(j), TOGETHER):
                block = j[k : k + TOGETHER]
                pos, n_item, place = np.repeat(where, count)[k : k + TOGETHER], item[block], at[block]
                begins = wide[pos + SPAN + FEW - 1] != self.flat[self.offset[n_item] + place - 1]
                pos, n_item, place = pos[begins], n_item[begins], place[begins]
                may = self.promising(wide, pos, n_item, place, size)
                yield from zip(pos.tolist(), n_item.tolist(), place.tolist(), repeat(size), may.tolist())

    def promising(self, wide: np.ndarray, pos: np.ndarray, item: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
        """Whether enough words around each hit are kept for a case to pass through it."""
        words = self.flat[(self.offset[item] + place)[:, None] + np.arange(-SPAN, SPAN)]
        around = wide[(pos + SPAN + FEW)[:, None] + np.arange(-SPAN - FEW, SPAN + FEW)]
        kept = np.zeros(words.shape, dtype=bool)
        for e in range(2 * FEW + 1):
            kept |= around[:, e : e + 2 * SPAN] == words
        may = (around[:, FEW + SPAN : FEW + SPAN + RUN] == words[:, SPAN : SPAN + RUN]).all(axis=1)
        may |= self.length[item] < STRETCH
        total = np.zeros((len(pos), 2 * SPAN + 1), dtype=np.int16)
        np.cumsum(kept, axis=1, out=total[:, 1:])
        for m in LENGTHS:
            a, b = SPAN + size - m, SPAN + 1
            may |= (total[:, a + m : b + m] - total[:, a:b] >= m - m // PIECE).any(axis=1)
        return may


def distances(pattern: list[int], text: list[int]) -> np.ndarray:
    """For 0, 1 ... leading words of the pattern: their least edit distance to any leading words of the text.

    Myers' bit vectors of every column give all rows' distances by one running sum.
    """
    m = len(pattern)
    eq: dict[int, int] = {}
    for i, w in enumerate(pattern):
        eq[w] = eq.get(w, 0) | 1 << i
    full = (1 << m) - 1
    pv, mv = full, 0
    size = m // 8 + 1
    ups, downs = [pv.to_bytes(size, "little")], [mv.to_bytes(size, "little")]
    for w in text:
        e = eq.get(w, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph = (mv | ~(xh | pv) & full) << 1 & full | 1
        mh = (pv & xh) << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv & full
        ups.append(pv.to_bytes(size, "little"))
        downs.append(mv.to_bytes(size, "little"))
    bits = lambda rows: np.unpackbits(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), size), axis=1, count=m, bitorder="little").astype(np.int16)
    least = ((bits(ups) - bits(downs)).cumsum(axis=1) + np.arange(len(ups))[:, None]).min(axis=0)
    return np.append(0, least)


def reach(a: list[int], b: list[int], edits: int) -> list[int]:
    """For 0, 1 ... ``edits``: the most leading words of a that so many edits turn into leading words of b."""
    return (np.searchsorted(distances(a, b), np.arange(edits + 1), "right") - 1).tolist()


def runs(doc: list[int], item: list[int], hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(diagonal, start, end in the item) of the longest unchanged runs around the hits (place, place in the item, length)."""
    out: dict[int, tuple[int, int, int]] = {}
    found = []
    for at, a, size in sorted(hits):
        d = at - a
        if d in out and out[d][2] >= a + size or doc[at : at + size] != item[a : a + size]:
            continue
        lo, hi = a, a + size
        while lo and d + lo > 0 and doc[d + lo - 1] == item[lo - 1]:
            lo -= 1
        while hi < len(item) and d + hi < len(doc) and doc[d + hi] == item[hi]:
            hi += 1
        out[d] = (d, lo, hi)
        found.append(out[d])
    return found


def stretches(doc: list[int], item: list[int], run: tuple[int, int, int], edits: int, span: int) -> tuple[int, int] | None:
    """(length, -edits) of the longest stretch through the run that is a case, of at most ``edits`` edits and ``span`` words on either side."""
    d, lo, hi = run
    left = reach(item[max(0, lo - span) : lo][::-1], doc[max(0, d + lo - span - edits) : d + lo][::-1], edits)
    right = reach(item[hi : hi + span], doc[d + hi : d + hi + span + edits], edits)
    least = min(STRETCH, len(item))
    cases = ((n, -x - y) for x, p in enumerate(left) for y, q in enumerate(right) if (n := hi - lo + p + q) >= least and x + y <= n // PIECE)
    return max(cases, default=None)


def verify(doc: list[int], item: list[int], hits: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """(longest run, stretch, distance) if the hits (place, place in the item, length) make a case."""
    found = runs(doc, item, hits)
    run = max((hi - lo for _, lo, hi in found), default=0)
    if run >= min(RUN, len(item)):
        return run, run, 0
    budget = len(item) // PIECE
    # every case has one of at most FEW edits within it; only where there is one, the longest is looked for
    if not any(stretches(doc, item, r, min(budget, FEW), SPAN) for r in found):
        return None
    n, edits = max(c for r in found if (c := stretches(doc, item, r, budget, len(item))))
    return run, n, -edits


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id and the evidence of every document that repeats an item."""
    listed = items.select("item_id", F.col("item_text").alias("t")).where("t IS NOT NULL")
    blocks: list[list[tuple[int, list[str]]]] = [[]]
    size = 0
    for r in listed.toLocalIterator():
        if words := words_of(r.t):
            if size > BLOCK_WORDS:
                blocks.append([])
                size = 0
            blocks[-1].append((r.item_id, words))
            size += len(words)
    text, clean = F.col("text"), plain(F.col("text"))
    texts = docs.where(text.isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), clean.alias("clean"), F.when(clean, normalised(text)).otherwise(text).alias("t"))
    return reduce(DataFrame.unionByName, [_find_block(texts, b) for b in blocks])


def _find_block(texts: DataFrame, items: list[tuple[int, list[str]]]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seeds = Seeds(items)
        for batch in batches:
            rows = []
            if items:
                for docs, ids, starts in _chunks(seeds, batch):
                    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
                    live: set[tuple[int, int]] = set()
                    owner = np.repeat(np.arange(len(docs)), np.diff(starts))
                    for at, n, a, size, may in seeds.hits(ids):
                        k = int(owner[at])
                        found.setdefault((k, n), []).append((at - int(starts[k]), a, size))
                        if may:
                            live.add((k, n))
                    for k, n in sorted(live):
                        case = verify(ids[starts[k] : starts[k + 1]].tolist(), seeds.items[n], found[k, n])
                        if case:
                            rows.append((docs[k], items[n][0], *case))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "run", "stretch", "distance"])

    return texts.mapInPandas(run, FOUND)


def _chunks(seeds: Seeds, batch: pd.DataFrame) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Ids of documents, the numbers of their words in one array with a 0 after each document, and where each begins."""
    docs: list[int] = []
    parts: list[np.ndarray] = []
    starts = [0]
    for doc_id, clean, t in zip(batch["doc_id"], batch["clean"], batch["t"], strict=True):
        docs.append(doc_id)
        parts.append(seeds.ids([*(t.split() if clean else words_of(t)), ""]))
        starts.append(starts[-1] + len(parts[-1]))
        if starts[-1] > CHUNK_WORDS:
            yield docs, np.concatenate(parts), np.array(starts)
            docs, parts, starts = [], [], [0]
    if docs:
        yield docs, np.concatenate(parts), np.array(starts)
