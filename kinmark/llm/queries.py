"""Queries of the subpackage and the SQL beside them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmark.llm import leakage, linkage, lookalike, packing, subjects, survivor, variants
from kinmark.session import materialize, table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entry that supplies each field of every group of two or more."""
    return survivor.survivors(table(spark, sf_dir, "merged_name_entries"))


def p3_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving name entry of every group of two or more."""
    return survivor.fused(table(spark, sf_dir, "merged_name_entries"))


def _all_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """owner_table, id, name of both tables of names."""
    records = table(spark, sf_dir, "original_records").select(F.lit("original_records").alias("owner_table"), "id", "name")
    entries = table(spark, sf_dir, "name_entries").select(F.lit("name_entries").alias("owner_table"), F.col("entry_id").alias("id"), "name")
    return records.unionByName(entries)


def p5_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name beside the form in which it compares equal to what looks the same."""
    names = _all_names(spark, sf_dir)
    model = lookalike.fit(names, "name")
    return names.withColumn("form", lookalike.canonical(model, F.col("name")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rows whose names look identical but are stored differently."""
    forms = materialize(p5_canonical(spark, sf_dir), "p5-forms")
    parts = []
    for owner in ("original_records", "name_entries"):
        own = forms.where(F.col("owner_table") == owner)
        parts.append(lookalike.alike_pairs(own, "id", "form", "name").select(F.lit(owner).alias("owner_table"), "id_a", "id_b"))
    return parts[0].unionByName(parts[1])


def p7_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat a test item, with the longest run, the stretch and its edit distance."""
    return leakage.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat a test item."""
    return p7_evidence(spark, sf_dir).select("doc_id", "item_id")


def p6_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in windows of every capacity."""
    docs = table(spark, sf_dir, "documents")
    sizes: dict[bytes, DataFrame] = {}
    parts = []
    for r in table(spark, sf_dir, "pack_sizes").where("capacity_tokens > 0").orderBy("pack_name").collect():  # a row for each capacity
        vocabulary = packing.read_vocabulary(r.tokenizer)
        if vocabulary not in sizes:
            sizes[vocabulary] = materialize(packing.count_tokens(docs, vocabulary), "p6-sizes")
        parts.append(packing.pack(sizes[vocabulary], r.pack_name, r.capacity_tokens))
    return reduce(DataFrame.unionByName, parts)


def p6_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows and unused share of each capacity."""
    capacities = {r.pack_name: r.capacity_tokens for r in table(spark, sf_dir, "pack_sizes").collect()}
    return packing.usage(p6_packs(spark, sf_dir), capacities)


def p6_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and capacity, and whether the parts placed are its whole text."""
    return packing.placed(p6_packs(spark, sf_dir))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each of the subjects it is mainly about."""
    docs = table(spark, sf_dir, "documents")
    codes = [r.subject_code for r in table(spark, sf_dir, "subject_areas").where("subject_code IS NOT NULL").orderBy("subject_code").collect()]
    rows = subjects.labelled(docs, table(spark, sf_dir, "doc_subject_labels").where(F.col("subject_code").isin(codes)))
    return subjects.assign(docs, subjects.fit(rows, codes))


def p8_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and characters of each subject."""
    sizes = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return p8_found(spark, sf_dir).join(sizes, "doc_id").groupBy("subject_code").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("n_chars"))


def _forms(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Names of all pending records, of their entries and of all clusters, taken apart."""
    records, entries, clusters = (table(spark, sf_dir, t) for t in ("original_records", "name_entries", "viaf_clusters"))
    model = lookalike.fit(records, "name")
    names = variants.record_names(records.where("record_group_id IS NULL"), entries).unionByName(variants.cluster_names(clusters))
    return materialize(variants.parts(names, model), f"{label}-forms")


def p1_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending records with their clusters and the confidence of each match."""
    pending = table(spark, sf_dir, "original_records").where("record_group_id IS NULL")
    works = linkage.record_works(pending).unionByName(linkage.cluster_works(table(spark, sf_dir, "viaf_clusters")))
    return linkage.link(_forms(spark, sf_dir, "p1"), materialize(works, "p1-works"), linkage.record_relations(pending))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending records with the clusters that describe the same entity."""
    return p1_matches(spark, sf_dir).select("record_id", "viaf_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of pending records of one entity whose names differ visibly."""
    forms = _forms(spark, sf_dir, "p4")
    return variants.linked_pairs(forms, materialize(variants.entities(forms), "p4-entities"))


def p4_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending records with the entity they belong to: the links without all their pairs."""
    forms = _forms(spark, sf_dir, "p4")
    return variants.members(forms, materialize(variants.entities(forms), "p4-entities"))


QUERIES = {"p1_matches": p1_matches, "p1_found": p1_found, "p4_found": p4_found, "p4_members": p4_members, "p3_found": p3_found, "p3_fused": p3_fused, "p5_canonical": p5_canonical, "p5_found": p5_found, "p6_packs": p6_packs, "p6_usage": p6_usage, "p6_placed": p6_placed, "p7_evidence": p7_evidence, "p7_found": p7_found, "p8_found": p8_found, "p8_composition": p8_composition}

_P3 = """
WITH src AS (
  SELECT entry_id, s.source AS code, max(CASE WHEN s.n_type = 'authorized_form' THEN 1 ELSE 0 END) AS ok
  FROM (SELECT entry_id, unnest(sources) AS s FROM merged_name_entries) GROUP BY 1, 2),
sc AS (
  SELECT entry_id, max(CASE WHEN code = 'LC' THEN ok END) AS lc, max(CASE WHEN code = 'lc' THEN ok END) AS lc2,
    max(CASE WHEN code = 'LAC' THEN ok END) AS lac, max(CASE WHEN code = 'lac' THEN ok END) AS lac2,
    max(CASE WHEN code = 'NLA' THEN ok END) AS nla, max(CASE WHEN code = 'nla' THEN ok END) AS nla2, sum(ok) AS n
  FROM src GROUP BY 1),
e AS (
  SELECT m.*, CASE WHEN coalesce(lc, lc2) = 1 THEN 99 WHEN coalesce(lac, lac2) = 1 THEN 98 WHEN coalesce(nla, nla2) = 1 THEN 97 ELSE coalesce(n, 0) END AS score,
    len(regexp_extract_all(' ' || coalesce(regexp_replace(use_dates, '[0-9]{5,}', 'x', 'g'), '') || ' ', '[0-9]{4}')) AS years,
    count(*) OVER (PARTITION BY record_group_id) AS members
  FROM merged_name_entries m LEFT JOIN sc USING (entry_id)),
found AS (
  SELECT record_group_id, 'name' AS field_name, entry_id, row_number() OVER (PARTITION BY record_group_id ORDER BY score DESC, updated_at DESC, entry_id DESC) AS r
  FROM e WHERE members >= 2 AND name IS NOT NULL
  UNION ALL
  SELECT record_group_id, 'use_dates', entry_id, row_number() OVER (PARTITION BY record_group_id ORDER BY years DESC, updated_at DESC, entry_id DESC)
  FROM e WHERE members >= 2 AND years > 0
  UNION ALL
  SELECT record_group_id, 'lang', entry_id, row_number() OVER (PARTITION BY record_group_id ORDER BY updated_at DESC, entry_id DESC)
  FROM e WHERE members >= 2 AND lang IS NOT NULL AND trim(lower(lang)) NOT IN ('', 'und'))
"""
ORACLE = {
    "p6_placed": "SELECT p.pack_name, d.doc_id, true AS whole FROM documents d CROSS JOIN pack_sizes p WHERE p.capacity_tokens > 0",
    "p3_found": _P3 + "SELECT record_group_id, field_name, entry_id FROM found WHERE r = 1",
    "p3_fused": _P3
    + """SELECT f.record_group_id, max(CASE WHEN field_name = 'name' THEN m.name END) AS name,
  max(CASE WHEN field_name = 'use_dates' THEN m.use_dates END) AS use_dates, max(CASE WHEN field_name = 'lang' THEN m.lang END) AS lang
FROM found f JOIN merged_name_entries m USING (entry_id) WHERE r = 1 GROUP BY 1""",
}
