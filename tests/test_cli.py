"""Commands write their tables; indexes hold their keys."""

import glob
import xml.etree.ElementTree as ET

import pytest

from kinmark import cli
from kinmark.operators import index

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    ("args", "tables"),
    [
        (["match", "--type", "corporateBody"], {"decisions", "groups"}),
        (["match", "--candidates", "--end", "400"], {"decisions", "groups", "new_candidates"}),
        (["merge"], {"new_merged_records", "identifiers"}),
        (["postprocess", "problems", "--start", "1"], {"problems"}),
        (["postprocess", "reload"], {"refreshed"}),
        (["export", "--collection", "nordlach"], {"written"}),
    ],
)
def test_commands(spark, tmp_path, args, tables):
    cli.main([*args, "--tables", DATA, "--out", str(tmp_path)])
    assert {p.split("/")[-1][:-8] for p in glob.glob(f"{tmp_path}/*.parquet")} == tables
    for t in tables:
        spark.read.parquet(f"{tmp_path}/{t}.parquet").count()
    for f in glob.glob(f"{tmp_path}/xml/*.xml"):
        ET.parse(f)


def test_indexes(spark):
    schema = "viaf_id string, name_type string, spirit boolean, headings array<string>, birth string, death string, sources array<string>, auth_forms array<struct<name:string,sources:array<string>>>, alt_forms array<struct<name:string,sources:array<string>>>"
    df = spark.createDataFrame([("1", "Personal", None, ["Doe, Jané", None], "1900", "0", ["LC|n 1"], None, [("Roe, J.", None)]), ("2", None, True, None, None, None, None, None, None), (None, "Personal", False, ["x"], "1", "1", None, None, None)], schema)
    got = {n: sorted((r.viaf_id, r.key) for r in index.keys(df, n).collect()) for n in index.INDEXES}
    assert got["idnumber"] == [("1", "LC n 1")] and got["xmainname"] == [("1", "doe jane")] and got["mainname"] == [("1", "doe"), ("1", "jane")]
    assert got["seerefs"] == [("1", "j"), ("1", "roe")] and got["birthdate"] == [("1", "1900")] and got["deathdate"] == []
    assert got["xmainnamenn"] == [("1", "Doe, Jané")] and len(got["xallnames"]) == 2 and ("1", " do") in got["mainnamengram"]
    assert got["nametype"] == [("1", "personal")] and got["spirit"] == [("1", "0"), ("2", "1")]
    terms = spark.createDataFrame([(1, "doe", "Personal"), (2, "doe", "Corporate")], "qid int, key string, name_type string")
    assert [(r.qid, r.viaf_id) for r in index.search(df, "mainname", terms, with_type=True).collect()] == [(1, "1")]
    assert index.sizes(df).count() == len(index.INDEXES)
    with pytest.raises(KeyError):
        index.keys(df, "none")


def test_export_of_a_listing(spark, tmp_path):
    arks = [r.canonical_id for r in spark.read.parquet(f"{DATA}/merged_records.parquet").where("valid AND canonical_id IS NOT NULL").orderBy("id").limit(3).collect()]
    listing = tmp_path / "listing"
    listing.mkdir()
    names = {a.removeprefix("ark:/").replace("/", "-") + ".xml" for a in arks}
    for n in names | {"00000-none.xml", "notes.txt"}:
        (listing / n).write_text("old")
    cli.main(["export", "--listing", str(listing), "--tables", DATA, "--out", str(tmp_path / "out")])
    assert {p.split("/")[-1] for p in glob.glob(f"{tmp_path}/out/xml/*")} == names


def test_see_also(spark):
    from kinmark.sources import clusters

    xml = '<c xmlns="u"><viafID>7</viafID><mainHeadings><data><text>Doe</text></data></mainHeadings><x500s><x500><datafield tag="500"><subfield code="a">Roe, J.</subfield><subfield code="d">1900</subfield></datafield></x500><x500><datafield/></x500></x500s></c>'
    rows = clusters.parsed(spark.createDataFrame([(1, xml), (2, None)], "id bigint, viaf_record string"), ["id"], "viaf_record")
    assert [r.see_also for r in rows.collect()] == [["Roe, J. 1900"]]
    df = rows.select("viaf_id", "headings", "see_also").selectExpr("*", "cast(null as array<struct<name:string>>) auth_forms", "cast(null as array<struct<name:string>>) alt_forms")
    assert {r.key for r in index.keys(df, "seealso").collect()} == {"roe", "j", "1900"} and {r.key for r in index.keys(df, "allnames").collect()} == {"doe", "roe", "j", "1900"}
