"""Nested records to flat tables: round trip, identities, edge cases."""

import xml.etree.ElementTree as ET

from kinmark.operators.nested import CLUSTER_KINDS, RECORD_KINDS, digests, nested_children, occurrences, shred

REC = """<e:eac-cpf xmlns:e="urn:isbn:1-931666-33-4" xmlns:xlink="http://www.w3.org/1999/xlink"><e:control><e:recordId>r1</e:recordId><e:sources><e:source><e:sourceEntry> s1
</e:sourceEntry></e:source><e:source/></e:sources></e:control><e:cpfDescription><e:identity><e:nameEntry><e:part>Doe &amp; <![CDATA[<Co>]]></e:part></e:nameEntry></e:identity>
<e:description><e:languageUsed><e:language languageCode="eng">English</e:language></e:languageUsed></e:description><e:relations><e:cpfRelation xlink:href="h1"><e:descriptiveNote><e:p><e:span>a</e:span><e:span>b</e:span></e:p></e:descriptiveNote></e:cpfRelation><e:cpfRelation xlink:href="h2"><e:descriptiveNote><e:p><e:span>a</e:span></e:p></e:descriptiveNote></e:cpfRelation></e:relations></e:cpfDescription></e:eac-cpf>"""
CLU = """<VIAFCluster xmlns="http://authority.example/cluster/terms#"><sources><source>LC|1</source></sources><mainHeadings><data><text>Doe</text><sources><s>LC</s><s>DNB</s></sources></data></mainHeadings>
<x400s><x400><datafield><subfield code="a">D</subfield></datafield></x400><x400><datafield><subfield code="a">E</subfield><subfield code="d">1</subfield></datafield><sources><s>NLA</s></sources></x400></x400s><titles><work><data><text>T</text></data></work></titles></VIAFCluster>"""


def tables(spark, rows, kind="record_data"):
    return spark.createDataFrame(rows, f"id bigint, {kind} string, child string, owner_id string")


def test_children(spark):
    recs = tables(spark, [(1, REC, "clash", "x"), (2, REC[:300], None, None), (3, None, None, None), (4, "", None, None), (1, REC, None, None)])
    clus = tables(spark, [(9, CLU, None, None)], "viaf_record")
    got = sorted(map(tuple, nested_children({"original_records": (recs, "id", "record_data", RECORD_KINDS), "record_groups": (clus, "id", "viaf_record", CLUSTER_KINDS)}).collect()), key=str)
    one = [("source", 0, 1, "s1"), ("source", 0, 2, None), ("nameEntry", 0, 1, "Doe & <Co>"), ("language", 0, 1, "eng"), ("cpfRelation", 0, 1, "h1"), ("cpfRelation", 0, 2, "h2"), ("span", 1, 1, "a"), ("span", 1, 2, "b"), ("span", 2, 1, "a")]
    two = [("cluster_source", 0, 1, "LC|1"), ("data", 0, 1, "Doe"), ("data_s", 1, 1, "LC"), ("data_s", 1, 2, "DNB"), ("subfield", 1, 1, "D"), ("subfield", 2, 1, "E"), ("subfield", 2, 2, "1"), ("x400_s", 2, 1, "NLA"), ("title", 0, 1, "T")]
    want = [("original_records", 1, *r) for r in one for _ in range(2)] + [("record_groups", 9, *r) for r in two]
    assert got == sorted(want, key=str)


def test_identical_objects_are_stored_once(spark):
    bridge, objects = shred(tables(spark, [(i, REC, None, None) for i in range(20)]), "id", "record_data", RECORD_KINDS, "t")
    spans = objects.where("child = 'span'").collect()
    assert sorted(r.child_key for r in spans) == ["a", "b"]
    assert bridge.where("child = 'span'").count() == 60


def test_digests_ignore_layout_and_prefix():
    a = ET.fromstring('<a xmlns="u"><b x="1" y="2">t</b></a>')
    b = ET.fromstring('<p:a xmlns:p="u">\n <p:b y="2" x="1"> t </p:b>\n</p:a>')
    c = ET.fromstring('<a xmlns="u"><b x="1" y="2">T</b></a>')
    assert digests(a)[a] == digests(b)[b] != digests(c)[c]


def test_depth_is_not_limited_and_bad_input_gives_nothing():
    deep = "<a>" * 5000 + "</a>" * 5000
    assert len(occurrences(deep, RECORD_KINDS)) == 1
    assert occurrences("<a><b></a>", RECORD_KINDS) == occurrences("no xml", RECORD_KINDS) == []


def test_empty_table(spark):
    assert nested_children({"x": (tables(spark, []), "id", "record_data", RECORD_KINDS)}).count() == 0


MIXED = """<a xmlns="u" xmlns:x="v" x:k="1 &lt; 2" k="&quot;q&quot;" xml:lang="en"><!-- note --><p>One <b>two</b> three &amp; <i/>four</p><p>One <b>two</b> three &amp; <i/>four</p>
<q xmlns=""> t </q></a>"""


def test_nothing_is_lost_in_the_store(spark):
    from kinmark.operators.nested import occurrences_in, rebuilt, store

    texts = {1: REC, 2: CLU, 3: MIXED, 4: REC, 5: "<deep>" + "<d>" * 30 + "</d>" * 30 + "</deep>"}
    rows = [*texts.items(), (6, None), (7, "<a>"), (8, "")]
    roots, subtrees = store(spark.createDataFrame([(*r, "clash") for r in rows], "id bigint, record_data string, digest string"), "id", "record_data", "t")
    back = {r.owner_id: r.xml for r in rebuilt(roots, subtrees, "t").collect()}
    assert set(back) == set(texts)
    for i, t in texts.items():
        before, after = ET.fromstring(t), ET.fromstring(back[i])
        assert digests(before)[before] == digests(after)[after]
        assert [(e.tag, e.attrib) for e in before.iter()] == [(e.tag, e.attrib) for e in after.iter()]
    assert back[1] == back[4] and roots.select("digest").distinct().count() == 4
    distinct = {n for t in texts.values() for n in digests(ET.fromstring(t)).values()}
    assert subtrees.count() == len(distinct)
    edges = {(r.parent, r.ordinal): r.child for r in occurrences_in(subtrees).collect()}
    root = ET.fromstring(MIXED)
    d = digests(root)
    assert [edges[d[root], n] for n in (1, 2, 3)] == [d[c] for c in root] and d[root[0]] == d[root[1]]


def test_store_of_nothing(spark):
    from kinmark.operators.nested import rebuilt, store

    roots, subtrees = store(tables(spark, []), "id", "record_data", "t")
    assert rebuilt(roots, subtrees, "t").count() == 0
