"""Archival authority records: files or XML columns to typed rows.

Edge cases: NULL, empty and malformed XML give no row; unknown entity types are
dropped; optional parts are NULL or empty arrays; a missing date attribute or an
unreadable date gives NULL while its type stays.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmark.functions.dates import date_text, parse_date
from kinmark.functions.normalize import name_key
from kinmark.operators.lookup import loadable
from kinmark.operators.nested import XLINK_HREF

# Fixed value: the role of a relation to the same entity elsewhere.
SAME_AS = "http://www.w3.org/2002/07/owl#sameAs"
TYPES = ("person", "corporateBody", "family")
_LANG = "{http://www.w3.org/XML/1998/namespace}lang"
_XLINK = "{http://www.w3.org/1999/xlink}"

FIELDS = """
source_id string, entity_type string, name string, from_standard string, from_text string, from_type string, to_standard string, to_text string, to_type string,
entity_id string,
name_entries array<struct<seq_no:int,name:string,n_type:string,source:string,lang:string,script_code:string,use_dates:string>>,
occupations array<string>, functions array<struct<term:string,local_type:string>>, local_descriptions array<struct<local_type:string,term:string,place:string>>,
places array<string>, languages array<string>, sources array<string>,
relations array<struct<relation_no:int,href:string,role:string,arcrole:string,entry:string,source_id:string>>,
resources array<struct<role:string,entry:string>>,
biog_citation string, biog_text string, biog_data string, descriptions array<struct<kind:string,xml:string>>
"""


def _text(e: ET.Element | None) -> str | None:
    return None if e is None else "".join(e.itertext()).strip(" \t\r\n") or None


def _raw(e: ET.Element) -> str:
    """An element as it stood, in the default namespace."""
    text = re.sub(r"(</?)ns0:", r"\1", ET.tostring(e, encoding="unicode"))
    return re.sub(r' xmlns:ns0="[^"]*"', "", text).strip()


def _inner(e: ET.Element) -> str:
    return ((e.text or "") + "".join(map(_raw, e))).strip()


def fields(xml: str | None) -> tuple | None:
    """The row of ``FIELDS`` of one record; None if there is none to read."""
    if not xml:
        return None
    try:
        root = ET.fromstring(xml)
    except (ET.ParseError, ValueError):
        return None
    ns = root.tag[: root.tag.index("}") + 1] if root.tag[0] == "{" else ""
    one = lambda e, p: None if e is None else e.find("/".join(ns + x for x in p.split("/")))
    every = lambda e, p: [] if e is None else list(e.iter(ns + p))
    identity, description, rel = one(root, "cpfDescription/identity"), one(root, "cpfDescription/description"), one(root, "cpfDescription/relations")
    entries, preferred, target = [], None, None
    for i, ne in enumerate(every(identity, "nameEntry"), 1):
        name = _text(one(ne, "part"))
        sure, other = one(ne, "authorizedForm"), one(ne, "alternativeForm")
        entries.append((i, name, "authorized_form" if sure is not None else "alternative_form" if other is not None else None, _text(sure if sure is not None else other), ne.get(_LANG), ne.get("scriptCode"), _text(one(ne, "useDates"))))
        preferred = preferred or name
        if target is None and name and (ne.get("localType") or "").endswith("#Matchtarget"):
            target = name
    dates: dict[str, tuple] = {}
    plain: tuple | None = None
    for ed in every(description, "existDates"):
        for tag in ("fromDate", "toDate"):
            for d in ed.iter(ns + tag):
                if d.attrib:
                    dates[tag] = (d.get("standardDate"), _text(d), d.get("localType"))
        for d in ed.iter(ns + "date"):
            if d.attrib:
                plain = (d.get("standardDate"), _text(d), d.get("localType"))
    begin, end = dates.get("fromDate"), dates.get("toDate")
    if not begin and not end and plain:
        begin = plain
    nothing = (None, None, None)
    relations = []
    for i, c in enumerate([] if rel is None else rel.findall(ns + "cpfRelation"), 1):
        spans = every(c, "span")
        named = _text(spans[0]) if spans else None
        if named and named.startswith("recordId: "):
            named = named[len("recordId: ") :]
        relations.append((i, c.get(XLINK_HREF), c.get(_XLINK + "role"), c.get(_XLINK + "arcrole"), _text(one(c, "relationEntry")), named))
    resources = [(r.get(_XLINK + "role"), _text(one(r, "relationEntry"))) for r in ([] if rel is None else rel.findall(ns + "resourceRelation"))]
    hist = next(iter(every(root, "biogHist")), None)
    citation = text = data = None
    if hist is not None:
        p, c = one(hist, "p"), one(hist, "citation")
        if len(hist) <= 2 and p is not None and c is not None:
            citation, text = _raw(c), _raw(p)
        else:
            data = _inner(hist)
    kinds = ("legalStatus", "generalContext", "mandate", "structureOrGenealogy")
    return (
        _text(one(root, "control/recordId")), _text(one(identity, "entityType")), target or preferred, *(begin or nothing), *(end or nothing),
        _text(one(identity, "entityId")), entries,
        [t for o in every(description, "occupation") if (t := _text(one(o, "term")))],
        [(_text(one(f, "term")), f.get("localType")) for f in every(root, "function")],
        [(x.get("localType"), _text(one(x, "term")), _text(one(x, "placeEntry"))) for x in every(root, "localDescription")],
        [t for x in every(description, "place") if (t := _text(one(x, "placeEntry")))],
        [c.get("languageCode") for u in every(root, "languageUsed") for c in u.findall(ns + "language")],
        [t for x in every(one(root, "control/sources"), "source") if (t := _text(one(x, "sourceEntry")))],
        relations, resources, citation, text, data,
        [(k, _raw(x)) for k in kinds for x in every(description, k)],
    )


def parsed(df: DataFrame, keep: list[str], xml: str) -> DataFrame:
    """``keep`` and the ``FIELDS`` of every well-formed record in column ``xml``."""
    names = [f.strip().split(" ")[0] for f in _split(FIELDS)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, r) for i, x in enumerate(batch["_xml"]) if (r := fields(x)) is not None]
            out = batch[keep].iloc[[i for i, _ in rows]].reset_index(drop=True)
            for j, name in enumerate(names):
                out[name] = pd.Series([r[j] for _, r in rows], dtype=object)
            yield out

    source = df.where(F.col(xml).isNotNull()).select(*keep, F.col(xml).alias("_xml"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema) + ", " + FIELDS
    return source.mapInPandas(run, schema)


def _split(ddl: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, c in enumerate(ddl + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(ddl[at:i])
            at = i + 1
    return out


def loaded(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``parsed`` rows as records: type, preferred name, its key, dates with their types."""
    begin, end = date_text(F.col("from_standard"), F.col("from_text")), date_text(F.col("to_standard"), F.col("to_text"))
    return rows.where(F.col("entity_type").isin(*TYPES)).select(
        *keep,
        "source_id",
        F.col("entity_type").alias("r_type"),
        "name",
        name_key(F.col("name")).alias("name_norm"),
        parse_date(begin).alias("from_date"),
        F.col("from_type").alias("from_date_type"),
        parse_date(end, end=True).alias("to_date"),
        F.col("to_type").alias("to_date_type"),
    )


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, record_data: every XML file below a folder, whole."""
    files = spark.read.option("recursiveFileLookup", "true").option("wholetext", "true").option("pathGlobFilter", "*.xml").format("text").load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("record_data"))


def not_loaded(texts: DataFrame, records: DataFrame) -> DataFrame:
    """Files whose path no record has yet."""
    return texts.join(records.select("path").where("path IS NOT NULL"), "path", "left_anti")


def collection_path(name: str, registry: dict[str, str], base: str) -> str:
    """Folder of a collection: as registered, else below the base folder."""
    return registry.get(name) or f"{base.rstrip('/')}/{name}"


def load_collection(spark: SparkSession, name: str, registry: dict[str, str], base: str, records: DataFrame | None = None, strict: tuple[str, ...] = ()) -> DataFrame:
    """New records of a collection's folder, those with bad names left out.

    The id is a 63-bit hash of the path: the same file has the same id at every load.
    """
    texts = read_texts(spark, collection_path(name, registry, base))
    if records is not None:
        texts = not_loaded(texts, records)
    rows = loaded(parsed(texts.withColumn("xml", F.col("record_data")), ["path", "record_data"], "xml"), ["path", "record_data"])
    named = rows.where("name IS NOT NULL").withColumn("collection_id", F.lit(name))
    return loadable(named, list(strict)).withColumn("id", F.shiftrightunsigned(F.xxhash64("path"), 1)).withColumn("processed", F.lit(False))


def same_as(records: DataFrame) -> DataFrame:
    """record_id, href: the first address of each record that its XML declares to be the same."""
    rows = parsed(records, ["id"], "record_data").select(F.col("id").alias("record_id"), F.filter("relations", lambda r: r["arcrole"] == SAME_AS)[0]["href"].alias("href"))
    return rows.where("href IS NOT NULL AND href <> ''")


def backfilled(records: DataFrame, texts: DataFrame) -> DataFrame:
    """Records whose text is missing get that of their path."""
    found = texts.select("path", F.col("record_data").alias("_text"))
    return records.join(found, "path", "left").withColumn("record_data", F.coalesce("record_data", "_text")).drop("_text").select(*records.columns)
