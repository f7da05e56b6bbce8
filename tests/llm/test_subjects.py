"""Subject chains: held-out accuracy on planted documents, edge cases."""

import random

import numpy as np

from kinmark.llm import subjects as S

random.seed(4)
CODES = ["law", "music", "sport"]
TERMS = {"law": "statute verdict jury bail deeds writ warrant".split(), "music": "sonata choir organ motet fugue viola score".split(), "sport": "goal regatta relay medal umpire batsman team".split()}
FILLER = "the papers were given to a cousin in the year and kept in boxes with letters about the family house".split()


def sentence(code):
    body = random.sample(FILLER, 9)
    if code:
        for t in random.sample(TERMS[code], 2):
            body.insert(random.randrange(len(body)), t)
    return " ".join(body).capitalize() + "."


def document():
    k = random.choice([0, 1, 1, 1, 2, 2, 3])
    codes = random.sample(CODES, k)
    lines = [sentence(c) for c in codes for _ in range(4)] + [sentence(None) for _ in range(3)]
    if k == 1 and random.random() < 0.4:
        lines.append(sentence(random.choice([c for c in CODES if c not in codes])))  # in passing
    random.shuffle(lines)
    return " ".join(lines), random.choice([None, "scope_note"]), random.choice(["eng", None, "EN"]), codes


def test_held_out_accuracy():
    train = [d for d in (document() for _ in range(400)) if d[3]]
    model = S.fit(train, CODES)
    test = [document() for _ in range(200)]
    hit = model.predict([d[0] for d in test], [d[1] for d in test], [d[2] for d in test])
    got = [{CODES[j] for j in np.flatnonzero(r)} for r in hit]
    right = sum(len(g & set(d[3])) for g, d in zip(got, test, strict=True))
    assert right / sum(map(len, got)) > 0.93 and right / sum(len(d[3]) for d in test) > 0.9


def test_logistic_separates():
    x = np.random.default_rng(0).normal(size=(300, 2))
    y = (x[:, 0] > 0).astype(float)
    w = S._logistic(x, y, 0.1)
    assert ((x @ w[:-1] + w[-1] > 0) == (y > 0)).mean() > 0.97


def test_beam_takes_the_best_combination():
    rng = np.random.default_rng(1)
    k = 4
    own, shared = S.features(rng.random((20, k)) * 5, rng.random((20, 17)))
    width = S._link_features(own, shared, np.zeros((20, k)), 0).shape[1]
    chain = S.Chain(list(range(k)), [rng.normal(size=width + 1) * 0.4 for _ in range(k)], [(1.0, 0.0)] * k)
    got = chain.decode(own, shared, beam=64, most=3)
    import itertools

    for i in range(20):
        best, top = None, -1e9
        for combo in itertools.product([0, 1], repeat=k):
            if sum(combo) > 3:
                continue
            score, before = 0.0, np.zeros((20, k))
            for j in range(k):
                p = np.clip(chain.link(j, own, shared, before)[i], 1e-9, 1 - 1e-9)
                score += np.log(p if combo[j] else 1 - p)
                before[:, j] = combo[j]
            if score > top:
                best, top = combo, score
        assert tuple(got[i].astype(int)) == best


def test_tables(spark):
    rows = [(i, *document()) for i in range(120)]
    docs = spark.createDataFrame([(r[0], r[1], r[3], r[2], 0) for r in rows] + [(900, None, None, None, 0), (901, "", None, None, 0), (902, "x " * 40000, None, None, 0), (903, "...", None, None, 0)], "doc_id bigint, text string, lang string, source string, subject_code int")
    labels = spark.createDataFrame([(r[0], c) for r in rows[:80] for c in r[4]] * 2 + [(5000, "law"), (1, None), (None, "law")], "doc_id bigint, subject_code string")
    fitted = S.fit(S.labelled(docs, labels), CODES)
    out = S.assign(docs, fitted)
    got = out.collect()
    assert len(got) == len(set(got)) and not {r.doc_id for r in got} & {900, 901, 902, 903}
    assert S.assign(docs, S.fit([], CODES)).count() == 0
    assert S.assign(docs.limit(0), fitted).count() == 0
