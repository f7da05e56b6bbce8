"""Look-ups, blocking, matching, grouping, fusion and lineage against brute force and hand-made cases."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinmark.operators import audit, blocking, fusion, grouping, lineage, lookup, matching

random.seed(7)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def trigrams(s):
    return {("  " + w + " ")[i : i + 3] for w in s.split() for i in range(len(w) + 1)}


@pytest.fixture(scope="module")
def names(spark):
    base = ["".join(random.choice("abcdef") for _ in range(random.randint(3, 24))) for _ in range(60)]
    out = set(base) | {""}
    for b in base:
        for _ in range(2):
            c = list(b)
            for _ in range(random.randint(1, 4)):
                i = random.randrange(len(c) + 1)
                random.choice([lambda c=c, i=i: c.insert(i, "x"), lambda c=c, i=i: c.__delitem__(min(i, len(c) - 1)) if c else None])()
            out.add("".join(c))
    return sorted(out)


def test_close_names(spark, names):
    df = spark.createDataFrame([(n,) for n in names] + [(None,), (names[0],)], "name string")
    got = {(r.a, r.b, r.distance) for r in blocking.close_names(df).collect()}
    want = {(a, b, d) for a, b in itertools.combinations(names, 2) if (d := levenshtein(a, b)) < 5}
    assert got == want


def test_similar_names(spark, names):
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    got = {(r.a, r.b) for r in blocking.similar_names(df, 0.4).collect()}
    want = {(a, b) for a, b in itertools.combinations(names, 2) if trigrams(a) | trigrams(b) and len(trigrams(a) & trigrams(b)) / len(trigrams(a) | trigrams(b)) > 0.4}
    assert got == want


def test_ranked_prefers_shared_terms(spark):
    q = spark.createDataFrame([(1, "p", ["a", "b", "c"]), (2, "q", ["a"]), (3, "p", ["z"]), (4, "p", [])], "qid int, part string, terms array<string>")
    d = spark.createDataFrame([("x", "p", ["a", "b"]), ("y", "p", ["b", "c", "a"]), ("w", "p", ["a"]), ("v", "p", ["a", "d"])], "did string, part string, terms array<string>")
    assert [(r.qid, r.did, r.rank) for r in blocking.ranked(q, d, 2).orderBy("qid", "rank").collect()] == [(1, "y", 1)]
    assert [(r.did, r.rank) for r in blocking.ranked(q, d, 3, rare=3).orderBy("rank").collect()] == [("y", 1), ("x", 2), ("w", 3)]


RECORD = "id bigint, r_type string, name string, name_norm string, from_date date, from_date_type string, to_date date, to_date_type string, record_group_id bigint, processed boolean, collection_id string, source_id string, created_at timestamp, extra string"


def record(i, kind, name, norm=None, f=None, t=None, group=None, **k):
    import datetime

    d = lambda y: y and datetime.date(y, 1, 1)
    return (i, kind, name, norm or (name or "").lower().replace(",", ""), d(f), "x#Birth" if f else None, d(t), "x#Death" if t else None, group, k.get("processed", False), k.get("collection", "c"), k.get("source"), k.get("at"), "clash")


CLUSTER = "viaf_id string, name_type string, spirit boolean, headings array<string>, birth string, death string"


@pytest.fixture(scope="module")
def world(spark):
    rows = [
        record(1, "person", "Doe, Jane Quincy, 1900-1950", f=1900, t=1950, group=1),
        record(2, "person", "Doe, Jane Quincy, 1900-1950", f=1900),
        record(3, "person", "Doe, Jane Quincy, 1900-1950", f=1800),
        record(4, "person", "Roe, Richard Miles", f=1850, t=1900),
        record(5, "person", "Roe, Richard"),
        record(6, "corporateBody", "Acme Widget Manufacturing Co"),
        record(7, "corporateBody", "Acme Widgets Manufacturing"),
        record(8, "family", "Doe family"),
        record(9, "person", None),
        record(10, "person", "Poe, E. (Spirit)"),
    ]
    groups = spark.createDataFrame([(1, "doe jane quincy 1900-1950", "person", "v1"), (2, "gone", "invalid", None)], "id bigint, name string, g_type string, viaf_id string")
    merged = spark.createDataFrame([(1, 1, True, "person", "ark:/00000/a", None), (2, 2, False, "person", "ark:/00000/b", None)], "id bigint, record_group_id bigint, valid boolean, r_type string, canonical_id string, invalidates_record_id bigint")
    clusters = spark.createDataFrame(
        [("v1", "Personal", False, ["Doe, Jane Quincy, 1900-1950"], "1900", "1950"), ("v2", "Personal", None, ["Roe, Richard M."], "1850", "0"), ("v3", "Corporate", False, ["Acme Widget Manufacturing"], "0", "0"), ("v4", "Personal", True, ["Poe, E. (Spirit)"], "0", "0"), ("v5", "Personal", False, None, None, None)],
        CLUSTER,
    )
    return spark.createDataFrame(rows, RECORD), groups, merged, clusters


def test_cascade(spark, world):
    records, groups, merged, clusters = world
    got = {r.record_id: (r.stage, r.decision, r.group_id, r.viaf_id) for r in matching.cascade(records.where("record_group_id IS NULL"), groups, records, merged, clusters).collect()}
    assert got[2] == ("group", "accept", 1, None)
    assert got[3][1] == "new"
    assert got[4] == ("keyword", "accept", None, "v2")
    assert got[5][1:] == ("maybe", None, "v2")
    assert got[6] == ("keyword", "accept", None, "v3") and got[7][1:] == ("accept", None, "v3")
    assert got[8] == ("family", "new", None, None) and got[9][1] == "new"
    assert len(got) == 9


def test_cascade_on_empty_tables(spark, world):
    records, groups, merged, clusters = (t.limit(0) for t in world)
    assert matching.cascade(records, groups, records, merged, clusters).count() == 0


def test_identifier_match(spark, world):
    ids = spark.createDataFrame([(4, "http://x.example/ark/cb12/PUBLIC"), (5, None)], "record_id bigint, href string")
    auth = spark.createDataFrame([("cb12", "v9"), ("cb12", "v8")], "nsid string, viaf_id string")
    assert [tuple(r) for r in matching.identifier_match(world[0], ids, auth).collect()] == [(4, "v8")]


def test_groups_are_components(spark, world):
    decisions = spark.createDataFrame([(2, "accept", "v1"), (3, "accept", "v1"), (4, "maybe", "v2")], "record_id bigint, decision string, viaf_id string")
    got = {r.record_id: (r.group_no, r.viaf_id) for r in grouping.group_records(world[0], decisions).collect()}
    assert got[2] == got[3] == (2, "v1") and got[1] == (1, None) and got[8] == (8, None) and len(got) == 10


def test_components_against_union_find(spark):
    edges = [(random.randrange(80), random.randrange(80)) for _ in range(60)]
    parent = list(range(80))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    got = {r.id: r.component for r in grouping.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "t").collect()}
    for a, b in itertools.combinations(got, 2):
        assert (got[a] == got[b]) == (root(a) == root(b))


def test_lookups(spark, world):
    records, groups, merged, _ = world
    assert [r.id for r in lookup.page(lookup.unprocessed(records, "c", 3, 8), [F.col("id")], 2, 1).collect()] == [4, 5]
    ids = spark.createDataFrame([(0, 4), (1, 1), (2, 4), (3, 99)], "pos int, id bigint")
    assert [r.id for r in lookup.in_given_order(records, ids).orderBy("pos").collect()] == [4, 1, 4]
    assert [r.id for r in lookup.groups_without_merge(groups, merged.where("id = 9")).collect()] == [1]
    assert sorted(r.record_id for r in lookup.same_name_group(records, groups).collect()) == [1, 2, 3]
    bad = spark.createDataFrame([("x" * 199, "a"), ("," * 9 + "x" * 241, "a"), ("," * 8 + "x" * 242, "a"), ("x" * 300, "a"), ("a; b; " + "c" * 30, "oac"), ("a; b; " + "c" * 30, "a"), (None, "a")], "name string, collection_id string")
    assert lookup.loadable(bad, ["oac"]).count() == 4


def test_relations(spark):
    rel = spark.createDataFrame([(1, 1, "s1"), (1, 2, "s2"), (1, 3, "s3"), (1, 4, "s9")], "record_id bigint, relation_no int, source_id string")
    records = spark.createDataFrame([(1, "s1", 1), (2, "s1", 2), (3, "s2", None), (4, "s3", 7)], "id bigint, source_id string, record_group_id bigint")
    merged = spark.createDataFrame([(5, 1, "ark5", True), (6, 1, "ark6", True)], "id bigint, record_group_id bigint, canonical_id string, valid boolean")
    got = {r.relation_no: (r.outcome, r.canonical_id) for r in lookup.relation_targets(rel, records, merged).collect()}
    assert got == {1: ("resolved", "ark5"), 2: ("no group", None), 3: ("no merged record", None), 4: ("unknown record", None)}


def test_name_merge(spark):
    rows = [(1, "Doe J.", "DNB", "authorized_form", "viaf_auth", 0), (1, "doe j", "lc", "authorized_form", "cpf", 1), (1, "Doe, J.", "NKC", "alternative_form", "viaf_alts", 0), (1, "DOE J", "NKC", "authorized_form", "cpf", 2), (1, None, "x", None, "cpf", 3)]
    df = spark.createDataFrame(rows, "g int, name string, source string, n_type string, origin string, ord bigint").selectExpr("*", "'eng' lang", "cast(null as string) script_code", "cast(null as string) use_dates")
    names = fusion.merged_names(df, "g")
    got = {r.source: (r.n_type, r.name_origin, r.name) for r in names.collect()}
    assert got == {"DNB": ("authorized_form", "viaf_auth", "Doe J."), "lc": ("authorized_form", "cpf", "Doe J."), "NKC": ("authorized_form", "cpf", "Doe J.")}
    assert fusion.name_scores(names, "g").first().score == 99
    assert {(r.form, r.label) for r in fusion.printed_sources(names, "g").collect()} == {("authorizedForm", "VIAF"), ("authorizedForm", "lc"), ("authorizedForm", "NKC")}


def test_preferences(spark):
    rows = spark.createDataFrame([(1, "a", "t", 1), (1, "a", None, 2), (1, "b", "t", 3), (1, "b", "u", 4)], "e int, term string, kind string, pos int")
    assert {(r.term, r.pos) for r in fusion.untyped_preferred(rows, ["e", "term"], "kind", ["pos"]).collect()} == {("a", 2), ("b", 3)}
    assert {(r.term, r.n) for r in fusion.subjects(spark.createDataFrame([(1, "12-3"), (1, "x"), (1, "x"), (1, None)], "e int, term string"), "e", "term").collect()} == {("x", 2)}


def test_identifiers(spark):
    merged = spark.createDataFrame([(1, None), (2, "b"), (3, None), (4, None)], "id bigint, canonical_id string")
    stock = spark.createDataFrame([("c",), ("b",), ("a",), ("a",)], "canonical_id string")
    assert {(r.id, r.canonical_id) for r in fusion.assign_identifiers(merged, stock).collect()} == {(1, "a"), (3, "c")}
    assert fusion.assign_identifiers(merged.limit(0), stock).count() == 0


def test_lineage(spark):
    merged = spark.createDataFrame([(1, "a", 1, False, "person", None), (2, "b", 2, True, "person", 1), (3, "c", 3, True, "person", 1), (4, "d", None, False, "person", None), (5, "e", 5, False, "person", None), (6, "f", 6, True, "person", 5)], "id bigint, canonical_id string, record_group_id bigint, valid boolean, r_type string, invalidates_record_id bigint")
    got = sorted((r.id, r.relation, r.other_id) for r in lineage.tombstones(merged).collect())
    assert got == [(1, "SplitInto", "b"), (1, "SplitInto", "c"), (4, "Cancelled", None), (5, "MergedInto", "f")]
    assert {(r.id, r.relation, r.other_id) for r in lineage.origins(merged).collect()} == {(2, "SplitFrom", "a"), (3, "SplitFrom", "a"), (6, "MergedFrom", "e")}
    groups = spark.createDataFrame([(1, "person", "x"), (2, "person", "y"), (3, "person", "z"), (4, "invalid", "w"), (5, "person", "q")], "id bigint, g_type string, viaf_id string")
    codes = spark.createDataFrame([(2, 0, "LC|9"), (2, 1, "LC|1"), (3, 0, "LC|2"), (5, 0, "none")], "id bigint, pos int, source string")
    now = spark.createDataFrame([("x", ["LC|1"]), ("n", ["LC|2"])], "viaf_id string, sources array<string>")
    out = {r.id: (r.action, r.viaf_id, r.into_group) for r in lineage.refresh(groups, codes, now).collect()}
    assert out == {1: ("keep", "x", None), 2: ("merge", "x", 1), 3: ("repoint", "n", None), 5: ("lost", None, None)}
    records = spark.createDataFrame([(10, 2), (11, 3), (12, None)], "id bigint, record_group_id bigint")
    assert {(r.id, r.record_group_id) for r in lineage.remapped(records, lineage.refresh(groups, codes, now)).collect()} == {(10, 1), (11, 3), (12, None)}
    old = spark.createDataFrame([(1, "x", "<a/>"), (2, "y", "<b/>")], "id bigint, viaf_id string, viaf_record string")
    new = spark.createDataFrame([("x", "<a2/>"), ("y", "<b/>")], "viaf_id string, viaf_record string")
    assert [r.id for r in lineage.replaced_texts(old, new).collect()] == [1]


def test_audit(spark, world):
    records, groups, _, clusters = world
    odd = records.where("id = 4").withColumn("record_group_id", F.lit(1).cast("bigint"))
    got = audit.problematic(records.where("id = 1").unionByName(odd), groups, clusters).collect()
    assert [(r.record_id, r.group_id) for r in got] == [(4, 1)]
    assert got[0].quality == 0 and got[0].heading == "Doe, Jane Quincy, 1900-1950"


def test_in_database(spark, world):
    records, *_ = world
    pending, grouped = records.where("id IN (2, 3, 4, 7, 8)"), records.where("id IN (1, 5, 6, 8)")
    got = {r.record_id: (r.other_id, r.quality) for r in matching.in_database(pending, grouped).collect()}
    assert got[2] == (1, 1.0) and 3 not in got and 8 not in got
    assert got[7][0] == 6 and got[7][1] >= 0.85


def test_ranking_of_all_documents(spark):
    rng = random.Random(2)
    words = [f"t{i}" for i in range(14)]
    some = lambda n: sorted(set(rng.choices(words, range(1, 15), k=n)))
    qs = [(i, rng.choice("pq"), some(6)) for i in range(40)] + [(99, "p", [])]
    ds = [(f"d{i:03}", rng.choice("pq"), some(5)) for i in range(150)]
    q = spark.createDataFrame(qs, "qid int, part string, terms array<string>")
    d = spark.createDataFrame(ds, "did string, part string, terms array<string>")
    for k in (1, 10, 100):
        want = []
        for i, part, terms in qs:
            all_ = sorted((-len(s), -len(s) / len(set(terms) | set(t)), did) for did, p, t in ds if p == part and (s := set(terms) & set(t)))
            want += [(i, did, -n, r) for r, (n, _, did) in enumerate(all_[:k], 1)]
        for rare in (1, 3):
            assert sorted(tuple(r) for r in blocking.ranked_all(q, d, k, rare).collect()) == sorted(want)


def test_match_without_the_rarest_word(spark):
    rows = [record(1, "person", "Doe, Jane Quincy, clerk", "doe jane quincy clerk")]
    clusters = spark.createDataFrame([("1", "Personal", False, ["Doe, Jane Quincy"], None, None), ("2", "Personal", False, ["Clerk, Otto"], None, None), ("3", "Personal", False, ["Doe, Jane"], None, None)], CLUSTER)
    index = blocking.headings(clusters)
    r = spark.createDataFrame(rows, RECORD)
    assert [x.did for x in blocking.keyword_candidates(r, index).collect()] == ["2"]
    assert [x.did for x in blocking.keyword_candidates(r, index, whole=True).orderBy("rank").collect()] == ["1", "3", "2"]


def test_records_with_close_and_similar_names(spark, names):
    long = "n" * 254
    stored = [*names, names[0], long + "tail", long, "", ""]
    rows = [(i, n, i if i % 3 else None) for i, n in enumerate(stored)] + [(900, None, 1)]
    df = spark.createDataFrame(rows, "id bigint, name_norm string, record_group_id bigint")
    pairs = [(x, y) for x in rows for y in rows if x[0] != y[0] and y[2] is not None and x[1] is not None and y[1] is not None]
    assert {tuple(r) for r in blocking.close_records(df).collect()} == {(x[0], y[0], d) for x, y in pairs if (d := levenshtein(x[1], y[1][:254])) < 5}
    score = lambda a, b: len(trigrams(a) & trigrams(b)) / max(1, len(trigrams(a) | trigrams(b)))
    assert {(r.record_id, r.other_id) for r in blocking.similar_records(df, 0.4).collect()} == {(x[0], y[0]) for x, y in pairs if score(x[1], y[1]) > 0.4}


def test_records_go_to_groups_that_are_there(spark, world):
    schema = "record_id bigint, decision string, group_id bigint, viaf_id string"
    decisions = [(2, "accept", 77, None), (3, "accept", 77, None), (4, "accept", None, "v2"), (5, "maybe", None, "v2"), (6, "accept", None, "v3"), (7, "accept", None, "v3"), (8, "accept", None, "v2")]
    groups = spark.createDataFrame([(77, "doe", "person", None), (78, "roe", "person", "v2"), (79, "roe", "person", "v2"), (70, "gone", "invalid", "v3")], "id bigint, name string, g_type string, viaf_id string")
    out = grouping.group_records(world[0], spark.createDataFrame(decisions, schema), groups)
    got = {r.record_id: r for r in out.collect()}
    assert [(got[i].group_id, got[i].group_no) for i in (2, 3)] == [(77, 2)] * 2 and got[2].viaf_id is None
    assert (got[4].group_id, got[4].viaf_id) == (78, "v2") and got[8].group_id == 78
    assert got[5].group_id is None and got[5].viaf_id is None and got[5].maybe_viaf_id == "v2"
    assert got[6].group_no == got[7].group_no == 6 and got[6].group_id is None and got[6].viaf_id == "v3"
    assert [(r.group_no, r.candidate_type, r.candidate_id) for r in grouping.maybe_rows(out).collect()] == [(5, "viaf", "v2")]
    assert len(got) == 10 and grouping.group_records(world[0].limit(0), spark.createDataFrame([], schema), groups.limit(0)).count() == 0


def test_a_group_keeps_its_authority(spark, world):
    groups = spark.createDataFrame([(77, "doe", "person", "v5")], "id bigint, name string, g_type string, viaf_id string")
    decisions = spark.createDataFrame([(2, "accept", 77, "v1"), (3, "accept", 77, None)], "record_id bigint, decision string, group_id bigint, viaf_id string")
    got = {r.record_id: (r.group_id, r.viaf_id) for r in grouping.group_records(world[0], decisions, groups).collect()}
    assert got[2] == got[3] == (77, "v5")


def test_new_groups_by_name(spark):
    rows = [record(i, kind, name, f=f) for i, (kind, name, f) in enumerate([("person", "Doe, J.", None), ("person", "Doe, J.", None), ("person", "Doe, Jane Quincy", 1900), ("person", "Doe, Jane Quincy", 1900), ("person", "Doe, Jane Quincy", 1901), ("corporateBody", "Acme Widget Manufacturing", None), ("corporateBody", "Acme Widget Manufacturing", None), ("family", "Doe Roe Poe family of Leeds and York", None), ("family", "Doe Roe Poe family of Leeds and York", None), ("person", None, None), ("person", None, None)], 1)]
    none = spark.createDataFrame([], "record_id bigint, decision string, viaf_id string")
    got = {r.record_id: r.group_no for r in grouping.group_records(spark.createDataFrame(rows, RECORD), none).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 6, 7: 6, 8: 8, 9: 9, 10: 10, 11: 11}


def test_cascade_begins_with_identifiers(spark, world):
    records, groups, merged, clusters = world
    clusters = clusters.withColumn("sources", F.when(F.col("viaf_id") == "v2", F.array(F.lit("BNF|cb12"))))
    ids = spark.createDataFrame([(2, "http://x.example/ark/cb12/PUBLIC"), (8, "http://x.example/ark/cb12"), (4, "http://x.example/none")], "record_id bigint, href string")
    got = {r.record_id: (r.stage, r.decision, r.viaf_id) for r in matching.cascade(records.where("record_group_id IS NULL"), groups, records, merged, clusters, ids).collect()}
    assert got[2] == got[8] == ("identifier", "accept", "v2") and got[4] == ("keyword", "accept", "v2") and len(got) == 9


def test_a_family_stays_in_its_group(spark, world):
    rows = spark.createDataFrame([record(1, "family", "Doe family", group=5), record(2, "family", "Doe family")], RECORD)
    got = {r.record_id: (r.decision, r.group_id) for r in matching.cascade(rows, *(t.limit(0) if n != 1 else rows for n, t in enumerate((world[1], None, world[2], world[3])))).collect()}
    assert got == {1: ("accept", 5), 2: ("new", None)}


def test_resolved_relations(spark):
    rel = [(7, 1, 1, "old", "r", "knows", "s1"), (7, 1, 2, "old2", "r", "child", "s1"), (7, 2, 1, "x", "r", "knows", "s2"), (7, 2, 2, "y", "r", "knows", "s3"), (7, 2, 3, "keep", "r", "knows", "s9"), (7, 2, 4, "h", "r", "knows", None), (7, 2, 5, "h", "r", "knows", None), (7, 2, 6, None, "r", "knows", None), (7, 2, 7, "z", "r", "knows", "s4"), (7, 2, 8, "w", "r", "knows", "s5"), (8, 3, 1, "old", "r", "knows", "s1")]
    rows = spark.createDataFrame(rel, "group_id bigint, record_id bigint, relation_no int, href string, role string, arcrole string, source_id string")
    records = spark.createDataFrame([(1, "s1", 1), (3, "s2", None), (4, "s3", 7), (5, "s4", 2), (6, "s5", 3)], "id bigint, source_id string, record_group_id bigint")
    merged = spark.createDataFrame([(5, 1, "ark5", True), (6, 2, None, True), (7, 3, "ark7", False)], "id bigint, record_group_id bigint, canonical_id string, valid boolean")
    got = {(r.group_id, r.record_id, r.relation_no, r.href) for r in fusion.resolved_relations(rows, records, merged, "group_id").collect()}
    # no group or no merged record: left out; unknown and invalid ones stay; one without identifier gets an empty target
    assert got == {(7, 1, 1, "ark5"), (7, 2, 3, "keep"), (7, 2, 4, "h"), (7, 2, 6, None), (7, 2, 7, ""), (7, 2, 8, "w"), (8, 3, 1, "ark5")}


def test_a_name_of_a_third_of_all_records_is_searched_once(spark, world):
    """Equal records are one query: the searches see as many as there are different ones."""
    _, _, _, clusters = world
    rows = spark.createDataFrame([record(i, "person", "Roe, Richard Miles", f=1850, t=1900) for i in range(3000)] + [record(9000 + i, "person", f"Poe, Edgar {chr(97 + i)}") for i in range(5)], RECORD)
    index = blocking.headings(clusters)
    seen = []

    def match(r):
        seen.append(r.count())
        return matching.first_acceptable(r, blocking.keyword_candidates(r, index, whole=True), index)

    got = matching.by_kind(rows, match)
    assert seen == [6] and got.where("viaf_id = 'v2'").count() == 3000
    sets, back = blocking._term_sets(rows.select(F.col("id").alias("qid"), F.lit("p").alias("part"), blocking.tokens(F.col("name_norm")).alias("terms")))
    assert sets.count() == 6 and back(sets.select("qid")).count() == 3005
    other = matching.in_database(rows.where("id % 2 = 0"), rows.where("id % 2 = 1 OR id IN (0, 2)"))
    lowest = {r.record_id: r.other_id for r in other.where("record_id < 9000").collect()}
    assert lowest[0] == 1 and lowest[2] == 0 and set(lowest.values()) == {0, 1} and len(lowest) == 1500


def test_unknown_dates_are_no_other_kind(spark):
    rows = spark.createDataFrame([record(1, "person", "Doe", f=1900), record(2, "person", "Doe", t=1900), record(3, "person", "Doe")], RECORD)
    assert rows.select(matching.told_apart()).distinct().count() == 3


def test_short_names_at_every_distance(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcdefg") for _ in range(rng.choice([0, 1, 3, 4, 5, 6, 8, 9, 11]))) for _ in range(160)})
    got = {(r.a, r.b, r.distance) for r in blocking.close_names(spark.createDataFrame([(w,) for w in words], "name string")).collect()}
    assert got == {(a, b, d) for a, b in itertools.combinations(words, 2) if (d := levenshtein(a, b)) < 5}
