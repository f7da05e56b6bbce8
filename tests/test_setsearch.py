"""Search by shared terms: as brute force, and without a row for every pair that shares one."""

import itertools
import random

import numpy as np
import pytest

from kinmark.operators import blocking, matching, setsearch

CLUSTER = "viaf_id string, name_type string, spirit boolean, headings array<string>, birth string, death string"


def shuffled(spark):
    """Rows that all stages so far wrote for others."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def letters(i):
    return "".join(chr(97 + i // 17**j % 17) for j in range(3))


def best(rows, docs, terms, k=10):
    """(qid, did, shared, rank) by trying all pairs."""
    of = {d: terms(t) for d, t in docs}
    out = set()
    for q, text in rows:
        mine = terms(text)
        order = sorted((-len(mine & t), -len(mine & t) / len(mine | t), d) for d, t in of.items() if mine & t)
        out |= {(q, d, -n, r) for r, (n, _, d) in enumerate(order[:k], 1)}
    return out


def test_ngram_search_makes_no_row_for_every_pair(spark):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choices("abcd", k=10))) for i in range(600)]
    records = spark.createDataFrame([(i, "person", t, t) for i, t in texts], "id bigint, r_type string, name string, name_norm string")
    clusters = spark.createDataFrame([(f"v{i:04}", "Personal", False, [t], None, None) for i, t in texts], CLUSTER)
    before = shuffled(spark)
    got = {tuple(r) for r in blocking.ngram_candidates(records, blocking.headings(clusters), whole=True).collect()}
    assert shuffled(spark) - before < 30_000
    grams = lambda s: {f" {s} "[i : i + 3] for i in range(len(s))}
    assert {r for r in got if r[0] < 60} == best(texts[:60], [(f"v{i:04}", t) for i, t in texts], grams)


def test_ranking_over_blocks_and_equal_documents(spark, monkeypatch):
    monkeypatch.setattr(setsearch, "BLOCK", 40)
    qs = [(i, "p", sorted({"a", letters(i)[:2], letters(i)[2]})) for i in range(50)] + [(90, "p", [f"w{i}" for i in range(300)])]
    ds = [(f"d{i:03}", "p", sorted({"a", letters(i % 45)[:2], letters(i)[1]})) for i in range(150)] + [("x", "p", [f"w{i}" for i in range(280)])]
    q, d = spark.createDataFrame(qs, "qid int, part string, terms array<string>"), spark.createDataFrame(ds, "did string, part string, terms array<string>")
    want = best([(i, t) for i, _, t in qs], [(i, t) for i, _, t in ds], set, 7)
    assert {tuple(r) for r in blocking.ranked_all(q, d, 7).collect()} == want and (90, "x", 280, 1) in want


@pytest.fixture(scope="module")
def hot(spark):
    """Records and clusters that share a family's word: 360,000 pairs."""
    rows = [(i, "person", f"{letters(i)} family", f"{letters(i)} family", None, None, None, None, None) for i in range(600)]
    records = spark.createDataFrame(rows, "id bigint, r_type string, name string, name_norm string, from_date date, from_date_type string, to_date date, to_date_type string, record_group_id bigint")
    return records, spark.createDataFrame([(f"v{i:04}", "Personal", False, [f"{letters(i)} family"], None, None) for i in range(600)], CLUSTER)


def test_cascade_makes_no_row_for_every_pair(spark, hot):
    records, clusters = hot
    none = spark.createDataFrame([], "id bigint, name string, g_type string, viaf_id string"), spark.createDataFrame([], "id bigint, record_group_id bigint, valid boolean")
    before = shuffled(spark)
    got = {r.record_id: r.viaf_id for r in matching.cascade(records, none[0], records, none[1], clusters).collect()}
    assert shuffled(spark) - before < 150_000
    assert got == {i: f"v{i:04}" for i in range(600)}


@pytest.fixture(scope="module")
def alike():
    rng = random.Random(6)
    return sorted({"".join(rng.choices("abc", k=10)) for _ in range(1200)})


def test_most_similar_makes_no_row_for_every_pair(spark, alike):
    rows = [(i, "person", n, n, None, None, None, None, i if i % 2 else None) for i, n in enumerate(alike)]
    records = spark.createDataFrame(rows, "id bigint, r_type string, name string, name_norm string, from_date date, from_date_type string, to_date date, to_date_type string, record_group_id bigint")
    before = shuffled(spark)
    got = {r.record_id: r.other_id for r in matching.in_database(records.where("id % 2 = 0"), records.where("id % 2 = 1")).collect()}
    assert shuffled(spark) - before < 50_000
    grams = [{f"  {n} "[i : i + 3] for i in range(11)} for n in alike]
    assert got and all(len(grams[x] & grams[y]) / len(grams[x] | grams[y]) > 0.75 for x, y in got.items())


def test_ngram_persons_make_no_row_for_every_pair(spark):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choices("abcd", k=10))) for i in range(600)]
    records = spark.createDataFrame([(i, "person", t, t, None, None, None, None) for i, t in texts], "id bigint, r_type string, name string, name_norm string, from_date date, from_date_type string, to_date date, to_date_type string")
    clusters = spark.createDataFrame([(f"v{i:04}", "Personal", False, [t], None, None) for i, t in texts], CLUSTER)
    before = shuffled(spark)
    got = {r.record_id: r.viaf_id for r in matching.ngram_person(records, blocking.headings(clusters)).collect()}
    assert shuffled(spark) - before < 60_000
    assert len(got) == 600 and all(texts[i][1] == texts[int(v[1:])][1] for i, v in got.items())


def test_keyword_search_makes_no_row_for_every_pair(spark, hot):
    records, clusters = hot
    before = shuffled(spark)
    got = {tuple(r) for r in blocking.keyword_candidates(records, blocking.headings(clusters), whole=True).collect()}
    assert shuffled(spark) - before < 60_000
    texts = [(i, f"{letters(i)} family") for i in range(600)]
    assert {r for r in got if r[0] < 60} == best(texts[:60], [(f"v{i:04}", t) for i, t in texts], lambda t: set(t.split()))


def test_similar_records_make_no_row_for_every_pair(spark, alike):
    records = spark.createDataFrame([(i, n, i) for i, n in enumerate(alike)], "id bigint, name_norm string, record_group_id bigint")
    before = shuffled(spark)
    got = {(r.record_id, r.other_id) for r in blocking.similar_records(records).collect()}
    assert shuffled(spark) - before < 50_000
    grams = [{f"  {n} "[i : i + 3] for i in range(11)} for n in alike]
    assert {p for p in got if p[0] < p[1]} == {(x, y) for x, y in itertools.combinations(range(len(alike)), 2) if len(grams[x] & grams[y]) / len(grams[x] | grams[y]) > 0.75}


def test_keyword_persons_make_no_row_for_every_pair(spark, hot):
    records, clusters = hot
    before = shuffled(spark)
    got = {r.record_id: r.viaf_id for r in matching.keyword_person(records, blocking.headings(clusters)).collect()}
    assert shuffled(spark) - before < 60_000
    assert got == {i: f"v{i:04}" for i in range(600)}


@pytest.mark.parametrize("n", [9, 64, 65, 700])
def test_best_of_many_equal_documents(n):
    rng = random.Random(n)
    docs = [tuple(sorted(rng.sample(range(12), rng.randrange(1, 6)))) for _ in range(n)] + [tuple(range(300))]
    flat = lambda sets: (np.array([t for s in sets for t in s], dtype=np.int64), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))
    index = setsearch.Best(*flat(docs))
    for asked in [tuple(sorted(rng.sample(range(12), rng.randrange(1, 9)))) for _ in range(40)] + [tuple(range(300))]:
        terms, _ = index.known(*flat([asked]))
        want = sorted((-len(set(asked) & set(d)), i) for i, d in enumerate(docs) if set(asked) & set(d))[:10]
        found, shared = index.best(terms, 10)
        assert [(-s, i) for i, s in zip(found.tolist(), shared.tolist(), strict=True)] == want
