"""Pigeonhole edit matching: Myers against dynamic programming, planted passages, edge cases."""

import random
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from kinmark.llm import leakage as L

random.seed(11)
VOCAB = [f"w{i}" for i in range(4000)]
WORDS = st.lists(st.sampled_from("abcd"), max_size=14)


def slow(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


@given(WORDS, WORDS)
@settings(max_examples=300, deadline=None)
def test_myers(pattern, text):
    assert L.myers(pattern, text) == slow(pattern, text)


def words(n):
    return [random.choice(VOCAB) for _ in range(n)]


def test_pieces_cover_and_fit():
    for n in range(0, 160):
        p = L.pieces(list(range(n)))
        assert [x for a, b in p for x in range(a, b)] == list(range(n)) and all(0 < b - a <= L.PIECE for a, b in p)


def test_planted_cases(spark):
    items = [(i, " ".join(words(random.randint(45, 150)))) for i in range(12)] + [(90, None), (91, ""), (92, "short item"), (93, "...")]
    text = {i: t.split() for i, t in items if t and i < 90}
    docs, want = [], set()

    def doc(*parts):
        docs.append((len(docs), " ".join(x for p in parts for x in p)))
        return len(docs) - 1

    for i, w in text.items():
        want.add((doc(words(40), w, words(30)), i))  # whole
        a = random.randrange(len(w) - 16)
        want.add((doc(words(40), w[a : a + 16], words(30)), i))  # sixteen running words
        changed = [random.choice(VOCAB) if k % 12 == 7 else x for k, x in enumerate(w)]
        want.add((doc(words(9), changed, words(30)), i))  # single words changed
        dropped = [x for k, x in enumerate(w) if k % 15 != 7]
        want.add((doc(words(9), dropped, words(3)), i))  # single words left out
        doc(words(40), w[a : a + 12], words(30))  # a shorter turn of words
        doc(words(30), w[:8], words(20), w[8:16], words(10))  # pieces apart
    d = doc(text[0], words(5), text[1])
    want |= {(d, 0), (d, 1)}
    loud = doc()
    docs[loud] = (loud, "<p>" + ", ".join(x.upper() + "!" for x in text[2]).replace(" ", "\n\n") + "</p>")
    want.add((loud, 2))
    s = doc(words(5), ["short", "item"], words(5))
    want.add((s, 92))
    docs += [(len(docs), None), (len(docs) + 1, "")]
    long = (len(docs), " ".join(words(60000) + text[3]))
    docs.append(long)
    want.add((long[0], 3))
    dd = spark.createDataFrame([(*x, 5) for x in docs], "doc_id bigint, text string, t int").repartition(3)
    ii = spark.createDataFrame(items, "item_id bigint, item_text string")
    got = {(r.doc_id, r.item_id) for r in L.find(dd, ii).collect()}
    assert got == want
    assert L.find(dd, ii.limit(0)).count() == 0 and L.find(dd.limit(0), ii).count() == 0


def test_blocks_give_the_same(spark, monkeypatch):
    items = [(i, " ".join(words(60))) for i in range(6)]
    docs = [(i, " ".join(words(20) + items[i][1].split() + words(5))) for i in range(6)]
    dd, ii = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string")
    monkeypatch.setattr(L, "BLOCK_WORDS", 100)
    assert sorted((r.doc_id, r.item_id) for r in L.find(dd, ii).collect()) == [(i, i) for i in range(6)]


# texts of sf0.1: item 7145 and document 6524 (51 words, six edits), item 7220 and document 2522 (a stretch of 116 words with fourteen)
CHANGED = [
    (
        7145,
        "Der Streit mit Vincent Zalitomar über Milchertragsbücher endete erst 1891 in Peivopol. 9 Mappen aus Gagistead betreffen Milchertragsbücher, meist von M. Fliflopeick geordnet. Im Jahr 1896 kam Jereiskibec nach Beiholund und befasste sich dort mit die Entwässerung der Wiesen. Der Streit mit Zachary Breifliflilm über Milchertragsbücher endete erst 1935 in Meicimoor.",
        6524,
        "Der Streit mit Vincent Zalitomar über Milchertragsbücher endete erst 1891 in various Peivopol. 9 Mappen aus Gagistead betreffen Milchertragsbücher, meist von Fliflopeick M. geordnet. Im Jahr 1896 kam Jereiskibec nach Beiholund und sich befasste dort mit die Entwässerung der Wiesen. Der Streit mit Zachary Breifliflilm old über Milchertragsbücher endete erst 1935 in Meicimoor. Harriet Dikoverd aus Legruminster schrieb 1867 ausführlich über Milchertragsbücher und Obstbaumschnitt.",
        (11, 51, 6),
    ),
    (
        7220,
        "Fourteen bundles hold partnership ledgers, chiefly from Brugifield and from 1866 to 1878. Early in 1877 she entered the Wholesale Society at Brugifield as insurance agent, and the sale of the dye works became the main task. Few of the buyers described by C. Cikukralm reached Koceford after 1843. Few of the markets listed by J. Drutudemar can be traced after 1835. Harriet Babreneis, export broker at Tugrustead, had steered her toward shares in the tramway issue as early as 1872. Among the unsorted items are shares in the tramway issue (Stibustead, 1849) and a exact draft by P. Denacelm on credit given to shopkeepers. Letters to C. Skizadeir of Skigruville discuss mail-order catalogues and also dividends.",
        2522,
        "Fourteen bundles hold partnership ledgers, chiely from Brugifield and from 1866 to 1878. Early in 1877 she certain entered the Wholesale Society at Brugifield as insurance agent, and there sale of the dye works became the main task. of Few the buyers described by C. Cikukralm reached Koceford after Few 1843. of the markets listed by J. Drutudemar can be traced aftr 1835. Harriet Babreneis, export broker at Tugrustead, had steered her shares in the tramway issue as early as 1872. the Among unsorted items are shares in the tramway issue (Stibustead, and 1849) a exact draft by P. Denacelm on credit given to shopkeepers. there Letters to C. Skizadeir of Skigruville discuss mail-order catalogues and dividends. For 2 years she sent the Chamber of Trade yearly returns.",
        (11, 116, 14),
    ),
]


def test_changed_words_between_few_unchanged_pieces(spark):
    dd = spark.createDataFrame([(d, t) for _, _, d, t, _ in CHANGED], "doc_id bigint, text string")
    ii = spark.createDataFrame([(i, t) for i, t, *_ in CHANGED], "item_id bigint, item_text string")
    got = {(r.doc_id, r.item_id): (r.run, r.stretch, r.distance) for r in L.find(dd, ii).collect()}
    assert got == {(d, i): e for i, _, d, _, e in CHANGED}


def is_case(doc, item):
    """By trying every window of the item."""
    n = len(item)
    near = any(L.myers(item[a:b], doc) <= (b - a) // L.PIECE for a in range(n) for b in range(a + min(L.STRETCH, n), min(n, a + 2 * L.STRETCH) + 1))
    running = min(L.RUN, n)
    return near or any(L.myers(item[a : a + running], doc) == 0 for a in range(n - running + 1))


def test_every_window_tried():
    draw = random.Random(5)
    seen = set()
    for _ in range(150):
        vocab = [f"v{i}" for i in range(draw.choice([12, 3000]))]
        n = draw.choice([5, 9, 15, 20, 27, 31, 32, 39, 47, 56, 70])
        item = [draw.choice(vocab) for _ in range(n)]
        copy = list(item)
        for _ in range(round(n / draw.choice([5, 7, 8, 9]))):
            i = draw.randrange(len(copy))
            copy[i : i + 1] = draw.choice([[], [draw.choice(vocab)], [copy[i], draw.choice(vocab)]])
        doc = [draw.choice(vocab) for _ in range(9)] + copy + [draw.choice(vocab) for _ in range(9)]
        seeds = L.Seeds([(1, item)])
        ids = seeds.ids(doc)
        hits = list(seeds.hits(ids))
        case = L.verify(ids.tolist(), seeds.items[0], [h[:1] + h[2:4] for h in hits]) if any(h[4] for h in hits) else None
        assert (case is not None) == is_case(doc, item), (doc, item)
        if case and case[0] < min(L.RUN, n):
            assert case[1] >= min(L.STRETCH, n) and case[2] <= case[1] // L.PIECE
        seen.add((n < L.STRETCH, case is not None))
    assert len(seen) == 4


@given(st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=30), st.integers(0, 9))
@settings(max_examples=200, deadline=None)
def test_reach(a, b, edits):
    row = list(range(len(b) + 1))
    least = [0]
    for x in a:
        new = [row[0] + 1]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
        least.append(min(row))
    assert L.distances(a, b).tolist() == least
    assert L.reach(a, b, edits) == [max(p for p, d in enumerate(least) if d <= e) for e in range(edits + 1)]


def test_invisible_and_compatible_characters(spark):
    item = "Der Streit über Milchertragsbücher endete erst 1891 und die Akten of the fishing office were left " + " ".join(words(40))
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else "　" if c == " " else c for c in item)
    copies = [
        item.replace("e", "e​"),
        "­".join(item),
        wide,
        "".join(c + ("̈" if False else "") for c in __import__("unicodedata").normalize("NFD", item)),
        item.replace(" ", " "),
        item.replace("ü", "&uuml;").replace("fi", "ﬁ").replace("ff", "&#xFB00;"),
        "<b>" + item.replace(" ", "</b>&nbsp;<b>") + "</b>",
        item.upper(),
    ]
    dd = spark.createDataFrame([*enumerate(copies), (90, "​"), (91, "&amp;")], "doc_id bigint, text string")
    ii = spark.createDataFrame([(1, item), (2, "­ ​")], "item_id bigint, item_text string")
    assert sorted((r.doc_id, r.item_id, r.distance) for r in L.find(dd, ii).collect()) == [(i, 1, 0) for i in range(len(copies))]


def test_random_items_within_budget_are_found(spark):
    draw = random.Random(8)
    items, docs = [], []
    for i in range(40):
        n = draw.randint(45, 150)
        item = words(n)
        edits = draw.randint(0, n // L.PIECE)
        copy = list(item)
        for at in sorted(draw.sample(range(n), edits), reverse=True):
            copy[at : at + 1] = draw.choice([[], ["other"], [copy[at], "more"]])
        items.append((i, " ".join(item)))
        docs.append((i, " ".join(words(30) + copy + words(30))))
    dd, ii = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string")
    assert {(r.doc_id, r.item_id) for r in L.find(dd, ii).collect()} == {(i, i) for i in range(40)}
