"""Sources and sinks on micro-fixtures."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from kinmark.sources import clusters, files, records

REC = """<eac-cpf xmlns="urn:isbn:1-931666-33-4" xmlns:xlink="http://www.w3.org/1999/xlink"><control><recordId>r{n}</recordId></control>
<cpfDescription><identity><entityType>{kind}</entityType><nameEntry xml:lang="eng"><part>{name}</part><authorizedForm>lc</authorizedForm></nameEntry>{more}</identity>
<description><existDates><dateRange><fromDate standardDate="1900" localType="http://term.example/control/term#Birth">1900</fromDate>
<toDate localType="http://term.example/control/term#Death">active 1950</toDate></dateRange></existDates><biogHist><p>Born <b>here</b>.</p><citation>c</citation></biogHist></description>
<relations><cpfRelation xlink:href="h" xlink:arcrole="a"><descriptiveNote><p><span>recordId: q7</span></p></descriptiveNote></cpfRelation></relations></cpfDescription></eac-cpf>"""
CLU = """<VIAFCluster xmlns="http://authority.example/cluster/terms#"><viafID>100</viafID><nameType>Personal</nameType><sources><source>LC|n  50034079</source></sources>
<mainHeadings><data><text>Doe, Jane Quincy, 1900-1950</text><sources><s>LC</s><s>DNB</s></sources></data><mainHeadingEl><id>LC|n  50034079</id><sources><s>LC</s></sources></mainHeadingEl></mainHeadings>
<x400s><x400><datafield dtype="MARC21" tag="400"><subfield code="a">Doe, J. Q.</subfield><subfield code="d">1900-1950</subfield></datafield></x400></x400s>
<fixed><gender>a</gender></fixed><birthDate>1900</birthDate><deathDate>1950</deathDate></VIAFCluster>"""


def rec(n, name="Doe, Jané Quincy, 1900-1950", kind="person", more=""):
    return REC.format(n=n, name=name, kind=kind, more=more)


def test_load(spark, tmp_path):
    os.makedirs(tmp_path / "oac/deep")
    (tmp_path / "oac/a.xml").write_text(rec(1))
    (tmp_path / "oac/deep/b.xml").write_text(rec(2, more='<nameEntry localType="x#Matchtarget"><part>Target</part></nameEntry>'))
    (tmp_path / "oac/c.xml").write_text(rec(3, kind="robot"))
    (tmp_path / "oac/d.xml").write_text(rec(4)[:200])
    (tmp_path / "oac/e.xml").write_text(rec(5, name="many; names; in one long line of text here"))
    (tmp_path / "oac/f.txt").write_text("no xml")
    out = records.load_collection(spark, "oac", {}, str(tmp_path), strict=("oac",))
    rows = {r.source_id: r for r in out.collect()}
    assert sorted(rows) == ["r1", "r2"]
    assert rows["r1"].name_norm == "doe jane quincy 1900-1950" and rows["r2"].name == "Target"
    assert (rows["r1"].from_date, rows["r1"].to_date) == (datetime.date(1900, 1, 1), datetime.date(1950, 12, 31))
    again = records.load_collection(spark, "oac", {"oac": str(tmp_path / "oac")}, "/nowhere", records=out.select("path"), strict=("oac",))
    assert again.count() == 0
    known = spark.createDataFrame([(out.first().path, None), ("other", "kept")], "path string, record_data string")
    filled = {r.path: r.record_data for r in records.backfilled(known, records.read_texts(spark, str(tmp_path / "oac"))).collect()}
    assert filled["other"] == "kept" and sum(v is not None for v in filled.values()) == 2


def test_fields():
    f = dict(zip([x.strip().split(" ")[0] for x in records._split(records.FIELDS)], records.fields(rec(1)), strict=True))
    assert f["relations"][0] == (1, "h", None, "a", None, "q7")
    assert f["biog_text"] == "<p>Born <b>here</b>.</p>" and f["biog_citation"] == "<citation>c</citation>"
    assert records.fields("") is records.fields(None) is records.fields("<a") is None


def test_clusters(spark):
    df = spark.createDataFrame([(1, CLU), (2, CLU[:100]), (3, None)], "id bigint, x string")
    rows = clusters.parsed(df, ["id"], "x")
    info = clusters.information(rows, ["id"]).collect()
    assert [(r.id, r.viaf_id, r.gender, r.birth, r.death) for r in info] == [(1, "100", "Female", "1900", "1950")]
    a = clusters.heading_addresses(rows, ["id"]).first()
    assert (a.source, a.lccn_wcid, a.lccn_lcid, a.url_id) == ("LC", "lccn-n50034079", "n50034079", None)
    names = {(r.name, r.n_type): list(r.sources) for r in clusters.name_forms(rows, ["id"]).collect()}
    assert names == {("Doe, Jane Quincy, 1900-1950", "authorized_form"): ["DNB", "LC"], ("Doe, J. Q. 1900-1950", "alternative_form"): ["VIAF"]}


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("ark:/00000/x1", "<a/>"), ("ark:/00000/x2", "<é/>"), (None, "<c/>"), ("ark:/00000/x3", None)], "canonical_id string, record_data string")
    out = str(tmp_path / "out")
    done = files.write_files(files.file_rows(df), out).collect()
    assert sorted((r.file_name, r.bytes) for r in done) == [("00000-x1.xml", 4), ("00000-x2.xml", 5)]
    assert sorted(r.canonical_id for r in files.listed_identifiers(spark, out).collect()) == ["ark:/00000/x1", "ark:/00000/x2"]
    ids = str(tmp_path / "ids")
    files.append_identifiers(files.mint(spark, 5, 2), ids)
    files.append_identifiers(spark.createDataFrame([(" 00000/z ",)], "canonical_id string"), ids)
    assert sorted(r.canonical_id for r in files.read_identifiers(spark, ids).collect()) == ["ark:/00000/k000000000005", "ark:/00000/k000000000006", "ark:/00000/z"]
    files.append_csv(df.select(F.lit(1).alias("a")), str(tmp_path / "csv"))
    files.append_csv(df.select(F.lit(1).alias("a")), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv")).count() == 8


def test_identifiers_of_a_service(spark, tmp_path):
    (tmp_path / "mint-3").write_text("id: 00000/a\nid: ark:/00000/b\n\nbye\nid: \n")
    got = files.service_identifiers(spark, f"file://{tmp_path}/mint-{{}}", 3)
    assert sorted(r.canonical_id for r in got.collect()) == ["ark:/00000/a", "ark:/00000/b"]
    with pytest.raises(OSError):
        files.service_identifiers(spark, f"file://{tmp_path}/none-{{}}", 3)


def test_a_machine_s_own_disk_is_no_place_for_files_of_a_cluster(spark, tmp_path, monkeypatch):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert files.shared_folder(spark, str(tmp_path)) == f"file://{tmp_path}" and files.shared_folder(spark, "hdfs://h/x") == "hdfs://h/x"
    monkeypatch.setattr(spark.sparkContext, "master", "spark://h:7077")
    with pytest.raises(ValueError, match="own disk"):
        files.shared_folder(spark, str(tmp_path))
    assert files.shared_folder(spark, f"{shared}/out") == f"{shared}/out" and files.shared_folder(spark, "hdfs://h/x") == "hdfs://h/x"
