"""Authority cluster XML to typed rows.

Edge cases: NULL and malformed XML give no row; missing parts are NULL or empty
arrays; headings of sources other than the known ones carry no address.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmark.functions.identifiers import assembled_name, gender, lc_id, lc_number, wiki_id, worldcat_id

FIELDS = """
viaf_id string, name_type string, headings array<string>, heading_sources array<struct<name:string,sources:array<string>>>, heading_ids array<struct<id:string,source:string>>,
variants array<struct<tag:string,dtype:string,subfields:array<struct<code:string,value:string>>>>,
gender_code string, birth string, death string, titles array<string>, languages array<string>, nationalities array<string>, sources array<string>, see_also array<string>
"""
_NAMES = ["viaf_id", "name_type", "headings", "heading_sources", "heading_ids", "variants", "gender_code", "birth", "death", "titles", "languages", "nationalities", "sources", "see_also"]


def _text(e: ET.Element | None) -> str | None:
    return None if e is None or e.text is None else e.text.strip(" \t\r\n") or None


def fields(xml: str | None) -> tuple | None:
    """The row of ``FIELDS`` of one cluster; None if there is none to read."""
    if not xml:
        return None
    try:
        root = ET.fromstring(xml)
    except (ET.ParseError, ValueError):
        return None
    ns = root.tag[: root.tag.index("}") + 1] if root.tag[0] == "{" else ""
    q = lambda p: "/".join(x if x in (".", "") else ns + x for x in p.split("/"))
    texts = lambda p: [t for e in root.findall(q(p)) if (t := _text(e))]
    data = [(_text(d.find(q("text"))), [t for s in d.findall(q("sources/s")) if (t := _text(s))]) for d in root.findall(q("mainHeadings/data"))]
    ids = [(_text(h.find(q("id"))), _text(h.find(q("sources/s")))) for h in root.findall(q("mainHeadings/mainHeadingEl"))]
    variants = []
    for x in root.findall(q("x400s/x400")):
        f = x.find(q("datafield"))
        if f is not None:
            variants.append((f.get("tag"), f.get("dtype"), [(s.get("code"), _text(s)) for s in f.findall(q("subfield"))]))
    # names of related entities, subfields in their order
    related = [" ".join(t for s in f.findall(q("subfield")) if (t := _text(s))) for x in root.findall(q("x500s/x500")) for f in x.findall(q("datafield"))]
    one = lambda p: _text(root.find(q(p)))
    return (
        one("viafID"), one("nameType"), [n for n, _ in data if n], data, ids, variants, one("fixed/gender"), one("birthDate"), one("deathDate"),
        texts("titles//data/text"), texts("languageOfEntity//data/text"), texts("nationalityOfEntity//data/text"), texts("sources/source"), [r for r in related if r],
    )


def parsed(df: DataFrame, keep: list[str], xml: str) -> DataFrame:
    """``keep`` and the ``FIELDS`` of every well-formed cluster in column ``xml``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, r) for i, x in enumerate(batch["_xml"]) if (r := fields(x)) is not None]
            out = batch[keep].iloc[[i for i, _ in rows]].reset_index(drop=True)
            for j, name in enumerate(_NAMES):
                out[name] = pd.Series([r[j] for _, r in rows], dtype=object)
            yield out

    source = df.where(F.col(xml).isNotNull()).select(*keep, F.col(xml).alias("_xml"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema) + ", " + FIELDS
    return source.mapInPandas(run, schema)


def information(rows: DataFrame, keep: list[str]) -> DataFrame:
    """One row per cluster: gender, dates and headings resolved."""
    return rows.select(*keep, "viaf_id", "name_type", "headings", gender(F.col("gender_code")).alias("gender"), "birth", "death", "titles", "languages", "nationalities", "sources")


def heading_addresses(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Outside ids of a cluster's headings: LC numbers in two forms, wiki ids; other sources are left out."""
    ids = rows.select(*keep, F.explode("heading_ids").alias("h")).select(*keep, F.col("h.id").alias("heading_id"), "h.source")
    number = lc_number(F.col("heading_id"))
    out = ids.select(*keep, F.when(F.col("source").startswith("LC"), "LC").when(F.col("source").startswith("WKP"), "WKP").alias("source"), F.when(F.col("source").startswith("LC"), worldcat_id(number)).alias("lccn_wcid"), F.when(F.col("source").startswith("LC"), lc_id(number)).alias("lccn_lcid"), F.when(F.col("source").startswith("WKP"), wiki_id(F.col("heading_id"))).alias("url_id"))
    return out.where("source IS NOT NULL")


def name_forms(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Name forms of each cluster with their united sources: authorised ones from headings, alternative ones assembled from variant fields."""
    auth = rows.select(*keep, F.explode("heading_sources").alias("h")).where("h.name IS NOT NULL AND size(h.sources) > 0")
    auth = auth.groupBy(*keep, F.col("h.name").alias("name")).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("h.sources")))).alias("sources")).withColumn("n_type", F.lit("authorized_form"))
    v = rows.select(*keep, F.lower("name_type").alias("t"), F.explode("variants").alias("v")).select(*keep, "t", "v.tag", "v.dtype", "v.subfields")
    form = F.when(F.col("t") == "corporate", assembled_name("corporate", F.col("dtype"), F.col("tag"), F.col("subfields"))).otherwise(F.trim(assembled_name("person", F.col("dtype"), F.col("tag"), F.col("subfields"))))
    alt = v.select(*keep, form.alias("name")).where("name <> ''").distinct().select(*keep, "name", F.array(F.lit("VIAF")).alias("sources"), F.lit("alternative_form").alias("n_type"))
    return auth.unionByName(alt)
