"""Queries of matching, grouping, fusion, lineage, sources and audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmark.functions.identifiers import SUBFIELD_ORDER
from kinmark.operators import audit, export, fusion, grouping, lineage, lookup, matching
from kinmark.operators.blocking import headings
from kinmark.plans import sqltext as S
from kinmark.plans import matchsql, xmlsql
from kinmark.plans.lookup_queries import ORACLE as _LOOKUPS
from kinmark.plans.lookup_queries import _DOCS, _GRAM, _RANK, _SPIRIT, _TOK, _TRI, _TYPE
from kinmark.session import materialize, table
from kinmark.sources import clusters as cluster_source
from kinmark.sources import files
from kinmark.sources import records as record_source

#: Addresses of outside authorities (the hosts of the test data).
HOSTS = {"viaf": "http://authority.example/cluster/", "worldcat": "http://catalogue.example/identities/", "loc": "http://names.example/authorities/", "wiki": "http://wiki.example/"}


#: Fixed value: the collection whose records state an authority's identifier.
STATING = ["ead_bnf"]


def _t(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "original_records").where("record_group_id IS NULL")


# matching


def m_in_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending persons by exact group name and members' dates."""
    records, groups, merged = _t(spark, sf_dir, "original_records", "record_groups", "merged_records")
    return matching.in_group(_pending(spark, sf_dir), groups, records, merged)


def m_exact_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending persons by exact heading."""
    return matching.exact_person(_pending(spark, sf_dir), headings(table(spark, sf_dir, "viaf_clusters")))


def m_exact_corporate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending bodies by exact group name or heading."""
    return matching.exact_corporate(_pending(spark, sf_dir), table(spark, sf_dir, "record_groups"), headings(table(spark, sf_dir, "viaf_clusters")))


def m_corporate_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending bodies by keyword candidates and Jaro similarity."""
    return matching.corporate_keyword(_pending(spark, sf_dir), headings(table(spark, sf_dir, "viaf_clusters")), whole=True)


def m_keyword_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending persons: first acceptable keyword candidate."""
    index, r = headings(table(spark, sf_dir, "viaf_clusters")), _pending(spark, sf_dir).where("r_type = 'person'")
    return matching.keyword_person(r, index)


def m_ngram_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending persons: first acceptable n-gram candidate."""
    index, r = headings(table(spark, sf_dir, "viaf_clusters")), _pending(spark, sf_dir).where("r_type = 'person'")
    return matching.ngram_person(r, index)


def m_in_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending records by the trigrams of grouped records' names."""
    return matching.in_database(_pending(spark, sf_dir), table(spark, sf_dir, "original_records").where("record_group_id IS NOT NULL"))


def f_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of every stored text without its namespaces."""
    from kinmark.functions.identifiers import strip_namespaces

    return table(spark, sf_dir, "record_groups").where("viaf_record IS NOT NULL").select("id", F.length(strip_namespaces(F.col("viaf_record"))).alias("n"))


def m_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision of the whole cascade for every pending record."""
    records, groups, merged, clusters = _t(spark, sf_dir, "original_records", "record_groups", "merged_records", "viaf_clusters")
    pending = _pending(spark, sf_dir)
    return matching.cascade(pending, groups, records, merged, clusters, record_source.same_as(pending.where(F.col("collection_id").isin(STATING))))


def m_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of the pending records from the cascade's decisions."""
    return grouping.group_records(_pending(spark, sf_dir), materialize(m_cascade(spark, sf_dir), "cascade"), table(spark, sf_dir, "record_groups"))


def m_maybes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates to be looked at, of the pending records' groups."""
    return grouping.maybe_rows(m_groups(spark, sf_dir))


def m_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped records by an outside identifier: the number of their authority's first source, as an address."""
    records, groups, clusters = _t(spark, sf_dir, "original_records", "record_groups", "viaf_clusters")
    first = clusters.where("size(sources) > 0").select("viaf_id", F.substring_index(F.col("sources")[0], "|", -1).alias("n"))
    g = groups.where("viaf_id IS NOT NULL").select(F.col("id").alias("record_group_id"), "viaf_id").join(first, "viaf_id")
    hrefs = records.select(F.col("id").alias("record_id"), "record_group_id").join(g, "record_group_id").select("record_id", F.concat(F.lit("http://ids.example/ark/"), "n", F.lit("/PUBLIC")).alias("href"))
    ids = clusters.select(F.explode("sources").alias("nsid"), "viaf_id").withColumn("nsid", F.substring_index("nsid", "|", -1))
    return matching.identifier_match(records, hrefs, ids)


# fields of records


def _children(spark: SparkSession, sf_dir: str, field: str) -> DataFrame:
    rows = record_source.parsed(table(spark, sf_dir, "original_records"), ["id", "record_group_id"], "record_data")
    flat = rows.select(F.col("id").alias("record_id"), F.col("record_group_id").alias("group_id"), F.posexplode(field).alias("child_no", "x"))
    kind = flat.schema["x"].dataType
    return flat.select("record_id", "group_id", "child_no", "x.*") if kind.typeName() == "struct" else flat.select("record_id", "group_id", "child_no", F.col("x").alias("term"))


def a_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject terms of every group by frequency."""
    rows = _children(spark, sf_dir, "local_descriptions").where("group_id IS NOT NULL AND local_type LIKE '%#AssociatedSubject'")
    return fusion.subjects(rows, "group_id", "term")


def a_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of every group by frequency."""
    return fusion.frequency(_children(spark, sf_dir, "places").where("group_id IS NOT NULL"), "group_id", "term")


def a_occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupations of every group, first wins."""
    rows = _children(spark, sf_dir, "occupations").where("group_id IS NOT NULL")
    return fusion.first_wins(rows, ["group_id", "term"], ["record_id", "child_no"])


def a_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Functions of every group, untyped ones preferred."""
    rows = _children(spark, sf_dir, "functions").where("group_id IS NOT NULL AND term IS NOT NULL")
    return fusion.untyped_preferred(rows, ["group_id", "term"], "local_type", ["record_id", "child_no"])


def a_label_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects by reader and frequency."""
    return fusion.frequency(table(spark, sf_dir, "doc_subject_labels"), "labelled_by", "subject_code")


def a_distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of every record's name entries."""
    return fusion.distinct_values(table(spark, sf_dir, "name_entries"), "record_id", "lang").select("record_id", F.array_join("values", "|").alias("langs"))


def a_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First entry of every record and source."""
    e = table(spark, sf_dir, "name_entries").select("record_id", "source_code", "entry_id", "seq_no", "name")
    return fusion.first_wins(e, ["record_id", "source_code"], ["seq_no", "entry_id"])


def a_untyped_preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry of every record and language, untyped ones preferred."""
    e = table(spark, sf_dir, "name_entries").select("record_id", "lang", "n_type", "entry_id", "seq_no")
    return fusion.untyped_preferred(e, ["record_id", "lang"], "n_type", ["seq_no", "entry_id"])


def a_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of every record and language as one list."""
    e = table(spark, sf_dir, "name_entries").where("lang IS NOT NULL").select("record_id", "lang", "source_code", "seq_no", "entry_id")
    out = fusion.grouped_citations(e, "record_id", "lang", "source_code", ["seq_no", "entry_id"])
    return out.select("record_id", "lang", F.array_join("citations", "|").alias("citations"))


def _origin_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name entries of every group: authority forms, variants, record forms."""
    records, entries, groups, clusters = _t(spark, sf_dir, "original_records", "name_entries", "record_groups", "viaf_clusters")
    none = F.lit(None).cast("string")
    g = groups.where("viaf_id IS NOT NULL").select(F.col("id").alias("group_id"), "viaf_id").join(clusters, "viaf_id")

    def forms(field: str, n_type: str, origin: str) -> DataFrame:
        f = g.select("group_id", F.posexplode(field).alias("ord", "x")).select("group_id", F.col("ord").cast("bigint").alias("ord"), "x.name", F.explode("x.sources").alias("source"))
        return f.select("group_id", "name", "source", F.lit(n_type).alias("n_type"), F.lit(origin).alias("origin"), "ord", none.alias("lang"), none.alias("script_code"), none.alias("use_dates"))

    own = entries.join(records.where("record_group_id IS NOT NULL").select(F.col("id").alias("record_id"), F.col("record_group_id").alias("group_id")), "record_id")
    cpf = own.select("group_id", "name", F.col("source_code").alias("source"), "n_type", F.lit("cpf").alias("origin"), F.col("entry_id").alias("ord"), "lang", "script_code", "use_dates")
    return forms("auth_forms", "authorized_form", "viaf_auth").unionByName(forms("alt_forms", "alternative_form", "viaf_alts")).unionByName(cpf)


def a_merged_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged name entries of every group with their sources."""
    return fusion.merged_names(_origin_entries(spark, sf_dir), "group_id").select("group_id", "name_key", "source", "n_type", "name_origin", "name", "lang")


def a_name_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference score of every merged name, best first within the group."""
    names = fusion.merged_names(_origin_entries(spark, sf_dir), "group_id")
    return lookup.top_k(fusion.name_scores(names, "group_id"), ["group_id"], [F.desc("score"), F.col("name_key")], 1 << 30)


def a_array_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference score of every stored merged entry."""
    return table(spark, sf_dir, "merged_name_entries").select("entry_id", fusion.array_score(F.col("sources")).alias("score"))


def r_printed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source lines of every merged name."""
    return fusion.printed_sources(fusion.merged_names(_origin_entries(spark, sf_dir), "group_id"), "group_id")


def a_exist_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of every group by priority."""
    groups, clusters, records = _t(spark, sf_dir, "record_groups", "viaf_clusters", "original_records")
    return fusion.exist_dates(groups, clusters, records)


def u_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of every group: the authority's, then others of its records."""
    groups, clusters = _t(spark, sf_dir, "record_groups", "viaf_clusters")
    a = groups.select(F.col("id").alias("group_id"), "viaf_id").join(clusters.select("viaf_id", "languages"), "viaf_id")
    used = _children(spark, sf_dir, "languages").where("group_id IS NOT NULL").withColumnRenamed("term", "code")
    return fusion.languages(a, used, "group_id")


def u_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of every group, one for each role and target."""
    return fusion.relations(_children(spark, sf_dir, "relations").where("group_id IS NOT NULL").drop("child_no"), "group_id")


def u_by_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of every group after they were resolved, once for each merged record."""
    records, merged = _t(spark, sf_dir, "original_records", "merged_records")
    rows = _children(spark, sf_dir, "relations").where("group_id IS NOT NULL").drop("child_no")
    return fusion.resolved_relations(rows, records, merged, "group_id").select("group_id", "record_id", "relation_no", "href", "role", "arcrole", "entry")


def j_relation_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of every relation that names a record."""
    records, merged = _t(spark, sf_dir, "original_records", "merged_records")
    rel = _children(spark, sf_dir, "relations").select("record_id", "relation_no", F.coalesce("source_id", F.regexp_extract("href", r"/id/(.+)$", 1)).alias("source_id")).where("source_id <> ''")
    return lookup.relation_targets(rel, records, merged)


def r_same_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outside addresses of every group."""
    groups, clusters = _t(spark, sf_dir, "record_groups", "viaf_clusters")
    return fusion.same_as(groups, clusters, HOSTS)


def r_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of every group."""
    src = _children(spark, sf_dir, "sources").where("group_id IS NOT NULL").select("group_id", F.col("term").alias("source"))
    return fusion.source_block(src, table(spark, sf_dir, "record_groups"))


def r_new_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged records for groups that have none."""
    return fusion.new_merged(*_t(spark, sf_dir, "record_groups", "merged_records"))


def r_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers for merged records without one, from a stock that holds used ones as well."""
    merged = table(spark, sf_dir, "merged_records")
    used = merged.where("canonical_id IS NOT NULL").select("canonical_id")
    stock = used.unionByName(merged.select(F.concat(F.lit("ark:/00000/y"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("canonical_id")))
    return fusion.assign_identifiers(merged, stock)


# lineage


def r_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New groups of splitting every merged record of more than one collection by collection."""
    merged, records = _t(spark, sf_dir, "merged_records", "original_records")
    valid = merged.where("valid").select(F.col("id").alias("merged_id"), "record_group_id")
    parts = records.where("record_group_id IS NOT NULL").select(F.col("id").alias("record_id"), "record_group_id", F.col("collection_id").alias("part"))
    assignment = valid.join(parts, "record_group_id").select("merged_id", "part", "record_id")
    several = assignment.groupBy("merged_id").agg(F.count_distinct("part").alias("k")).where("k > 1").select("merged_id")
    new, _, _ = lineage.split(merged, records, assignment.join(several, "merged_id", "left_semi"))
    return new


def r_absorb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves of records when merged records take over those they may be the same as."""
    merged, groups, maybes, records = _t(spark, sf_dir, "merged_records", "record_groups", "maybe_candidates", "original_records")
    pairs = lookup.maybe_edges(merged, groups, maybes).where("direction = 'forward' AND other_id <> id").groupBy(F.col("other_id").alias("target_id")).agg(F.min("id").alias("id"))
    moves, _ = lineage.absorb(merged, records, pairs)
    return moves


def r_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cancelled records and what became of them."""
    return lineage.tombstones(table(spark, sf_dir, "merged_records"))


def r_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What merged records came from."""
    return lineage.origins(table(spark, sf_dir, "merged_records"))


def _refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups, clusters = _t(spark, sf_dir, "record_groups", "viaf_clusters")
    # an authority in which the clusters of groups with even ids were renumbered
    codes = groups.where("viaf_id IS NOT NULL").select("id", "viaf_id").join(clusters.select("viaf_id", F.posexplode("sources").alias("pos", "source")), "viaf_id").select("id", "pos", "source")
    moved = groups.where("id % 2 = 0 AND viaf_id IS NOT NULL").select("viaf_id", F.lit(True).alias("moved"))
    now = clusters.join(moved, "viaf_id", "left").select(F.when(F.col("moved"), F.concat(F.lit("9"), "viaf_id")).otherwise(F.col("viaf_id")).alias("viaf_id"), "sources")
    return lineage.refresh(groups, codes, now)


def r_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh of authority ids after half of them were renumbered."""
    return _refreshed(spark, sf_dir)


def r_remapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates after the refresh."""
    return lineage.remapped(table(spark, sf_dir, "maybe_candidates"), _refreshed(spark, sf_dir))


def r_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped records none of whose authority's headings matches."""
    records, groups, clusters = _t(spark, sf_dir, "original_records", "record_groups", "viaf_clusters")
    return audit.problematic(records, groups, clusters)


# sources and export


def s_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as loaded from their XML."""
    rows = record_source.parsed(table(spark, sf_dir, "original_records"), ["id", "collection_id"], "record_data")
    return lookup.loadable(record_source.loaded(rows, ["id", "collection_id"]).where("name IS NOT NULL"), ["nordlach"])


def s_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters as parsed from the groups' XML."""
    rows = cluster_source.parsed(table(spark, sf_dir, "record_groups"), ["id"], "viaf_record")
    info = cluster_source.information(rows.drop("viaf_record"), ["id"])
    return info.select("id", "viaf_id", "name_type", F.array_join("headings", "|").alias("headings"), "gender", "birth", "death", F.array_join("titles", "|").alias("titles"))


def s_cluster_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name forms of the groups' clusters with their sources."""
    rows = cluster_source.parsed(table(spark, sf_dir, "record_groups"), ["id"], "viaf_record")
    return cluster_source.name_forms(rows, ["id"]).select("id", "name", "n_type", F.array_join("sources", "|").alias("sources"))


def s_cluster_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outside ids of the groups' clusters."""
    rows = cluster_source.parsed(table(spark, sf_dir, "record_groups"), ["id"], "viaf_record")
    return cluster_source.heading_addresses(rows, ["id"])


def s_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without text get that of another record of their source."""
    r = table(spark, sf_dir, "original_records")
    texts = r.where("record_data IS NOT NULL").groupBy("path").agg(F.min_by("record_data", "id").alias("record_data"))
    return record_source.backfilled(r, texts).select("id", F.length("record_data").alias("n"))


def s_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the tombstones that are stored."""
    return files.file_rows(table(spark, sf_dir, "merged_records"))


TERM, AGENCY, STAMP = "http://term.example/control/term#", "Merging agency", "2020-01-01T00:00:00"


def r_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The XML of every merged record."""
    records, groups, clusters, merged, maybes = _t(spark, sf_dir, "original_records", "record_groups", "viaf_clusters", "merged_records", "maybe_candidates")
    rows = record_source.parsed(records.where("record_group_id IS NOT NULL"), ["id", "record_group_id"], "record_data")
    rows = materialize(rows.select(F.col("id").alias("record_id"), F.col("record_group_id").alias("group_id"), "occupations", "functions", "local_descriptions", "places", "languages", "sources", "relations", "resources", "biog_citation", "biog_text", "biog_data"), "combined-rows")

    def field(name: str) -> DataFrame:
        flat = rows.select("record_id", "group_id", F.posexplode(name).alias("child_no", "x"))
        struct = flat.schema["x"].dataType.typeName() == "struct"
        return flat.select("record_id", "group_id", "child_no", "x.*") if struct else flat.select("record_id", "group_id", "child_no", F.col("x").alias("term"))

    fields = {n: field(n) for n in ("occupations", "functions", "local_descriptions", "places", "languages", "relations", "resources")}
    fields["biographies"] = rows.select("record_id", "group_id", "biog_citation", "biog_text", "biog_data")
    names = materialize(fusion.merged_names(_origin_entries(spark, sf_dir), "group_id"), "combined-names")
    sources = field("sources").select("group_id", F.col("term").alias("source"))
    blocks = {
        "control": export.control(merged, records, groups, sources, TERM, AGENCY, STAMP),
        "identity": export.identity(groups, names),
        "description": export.description(groups, clusters, records, fields, TERM),
        "relations": export.relations(groups, clusters, records, merged, maybes, fields, HOSTS, TERM),
    }
    return export.combined(blocks, merged)


#: What is counted in a merged record's XML, and the mark of it.
PARTS = {
    "n_sources": "<source>", "n_names": "<nameEntry ", "n_languages": "<language ", "n_functions": "<function>", "n_subjects": 'AssociatedSubject">', "n_places": "<place>", "n_occupations": "<occupation>",
    "n_relations": "<cpfRelation", "n_resources": "<resourceRelation",
}


def r_combined_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the XML of every merged record consists of: its identifier, type, dates, and the number of its parts."""
    x = r_combined(spark, sf_dir)
    one = lambda pattern: F.nullif(F.regexp_extract("record_data", pattern, 1), F.lit(""))
    counts = [F.regexp_count("record_data", F.lit(mark)).alias(n) for n, mark in PARTS.items()]
    return x.select(
        "canonical_id", "group_id", one("<recordId>([^<]*)<").alias("record_id"), one("<entityType>([^<]*)<").alias("kind"), one('<fromDate standardDate="([^"]*)"').alias("from_text"), one('<toDate standardDate="([^"]*)"').alias("to_text"),
        F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("record_data", F.lit('preferenceScore="([0-9]+)"'), F.lit(1)))), " ").alias("scores"), *counts,
    )


def r_tombstone_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The XML of every cancelled record."""
    merged, removed, records = _t(spark, sf_dir, "merged_records", "removed_references", "original_records")
    last = removed.join(records.select(F.col("id").alias("original_record_id"), "name"), "original_record_id").groupBy("record_group_id").agg(F.min_by("name", removed["id"]).alias("name"))
    previous = merged.select("id", "record_group_id").join(last, "record_group_id").select("id", "name")
    return export.tombstone_texts(merged, previous, TERM, AGENCY, STAMP)


_FUNCTIONS = [
    r_combined, r_combined_parts, r_tombstone_texts, m_in_group, m_exact_person, m_exact_corporate, m_corporate_keyword, m_keyword_person, m_ngram_person, m_in_database, f_namespaces, m_cascade, m_groups, m_maybes, m_identifier,
    a_subjects, a_places, a_occupations, a_functions, a_label_frequency, a_distinct_values, a_first_wins, a_untyped_preferred, a_citations, a_merged_names, a_name_scores, a_array_scores, a_exist_dates,
    u_languages, u_relations, u_by_target, j_relation_targets, r_printed_sources, r_same_as, r_sources, r_new_merged, r_identifiers, r_split, r_absorb, r_tombstones, r_origins, r_refresh, r_remapped, r_audit,
    s_loaded, s_clusters, s_cluster_names, s_cluster_addresses, s_backfill, s_files,
]
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_AUTH = f"a AS (SELECT viaf_id, {S.authority_date('birth', False)} AS af, {S.authority_date('death', True)} AS at FROM viaf_clusters)"
_QF, _QT = S.year_quality("o.from_date", "o.from_date_type", "{0}", True), S.year_quality("o.to_date", "o.to_date_type", "{1}", False)
_H = f"h AS (SELECT {S.name_key('heading')} AS key, name_type, spirit, min(viaf_id) AS viaf_id FROM (SELECT viaf_id, name_type, coalesce(spirit, false) AS spirit, unnest(headings) AS heading FROM viaf_clusters) GROUP BY 1, 2, 3)"
_SP = "coalesce(contains(lower(o.name), '(spirit)'), false)"
_CORP = "array_to_string(list_filter(string_split({0}, ' '), lambda w: NOT list_contains(" + S.CORPORATE + ", w)), ' ')"


def _ck(x: str) -> str:
    return _CORP.format(S.letters_key(x))


_KEY = """lower(""" + S.compress("""regexp_replace(regexp_replace(name, '[/!,"();:.?{}\\-\\x{bf}\\x{a1}<>]', ' ', 'g'), '[\\[\\]'']', '', 'g')""") + ")"
_ENTRIES = """
o AS (SELECT id AS record_id, record_group_id AS group_id FROM original_records WHERE record_group_id IS NOT NULL),
g AS (SELECT g.id AS group_id, v.* FROM record_groups g JOIN viaf_clusters v ON v.viaf_id = g.viaf_id),
af AS (SELECT group_id, unnest(range(0, len(auth_forms))) AS ord, unnest(auth_forms) AS x FROM g),
vf AS (SELECT group_id, unnest(range(0, len(alt_forms))) AS ord, unnest(alt_forms) AS x FROM g),
e0 AS (
  SELECT group_id, x.name AS name, unnest(x.sources) AS source, 'authorized_form' AS n_type, 'viaf_auth' AS origin, 0 AS r, ord, NULL AS lang FROM af
  UNION ALL SELECT group_id, x.name, unnest(x.sources), 'alternative_form', 'viaf_alts', 1, ord, NULL FROM vf
  UNION ALL SELECT o.group_id, n.name, n.source_code, n.n_type, 'cpf', 2, n.entry_id, n.lang FROM name_entries n JOIN o USING (record_id)),
e AS (SELECT *, """ + _KEY + """ AS name_key, r * 1000000000000 + ord AS pos FROM e0 WHERE name IS NOT NULL),
hd AS (SELECT group_id, name_key, min_by(name, pos) AS name, arg_min_null(lang, pos) AS lang FROM e GROUP BY 1, 2),
sr AS (SELECT group_id, name_key, source, arg_min_null(n_type, pos) AS ft, min_by(origin, pos) AS fo, min_by(origin, CASE WHEN n_type = 'authorized_form' THEN pos END) AS ao FROM e WHERE source IS NOT NULL GROUP BY 1, 2, 3),
m AS (SELECT hd.group_id, hd.name_key, sr.source, CASE WHEN ft = 'alternative_form' AND ao IS NOT NULL THEN 'authorized_form' ELSE ft END AS n_type, CASE WHEN ft = 'alternative_form' AND ao IS NOT NULL THEN ao ELSE fo END AS name_origin, hd.name, hd.lang FROM hd LEFT JOIN sr ON sr.group_id = hd.group_id AND sr.name_key = hd.name_key)"""
_SCORES = """, f AS (SELECT group_id, name_key,
  max(CASE WHEN source = 'LC' THEN (coalesce(n_type, '') = 'authorized_form')::INT END) AS a1, max(CASE WHEN source = 'lc' THEN (coalesce(n_type, '') = 'authorized_form')::INT END) AS a2,
  max(CASE WHEN source = 'LAC' THEN (coalesce(n_type, '') = 'authorized_form')::INT END) AS b1, max(CASE WHEN source = 'lac' THEN (coalesce(n_type, '') = 'authorized_form')::INT END) AS b2,
  max(CASE WHEN source = 'NLA' THEN (coalesce(n_type, '') = 'authorized_form')::INT END) AS c1, max(CASE WHEN source = 'nla' THEN (coalesce(n_type, '') = 'authorized_form')::INT END) AS c2,
  sum((coalesce(n_type, '') = 'authorized_form')::INT) AS n FROM m GROUP BY 1, 2),
s AS (SELECT group_id, name_key, CASE WHEN coalesce(a1, a2) = 1 THEN 99 WHEN coalesce(b1, b2) = 1 THEN 98 WHEN coalesce(c1, c2) = 1 THEN 97 ELSE n END AS score FROM f)
"""
_PAD = "CASE WHEN {0} IS NULL OR {0} = '' THEN {0} ELSE regexp_replace(array_to_string(list_transform(list_zip(string_split({0}, '-'), range(1, 1 + len(string_split({0}, '-')))), lambda p: CASE WHEN p[2] = 1 AND length(p[1]) < 4 THEN lpad(p[1], 4, '0') WHEN p[2] <= 3 AND p[2] > 1 AND length(p[1]) < 2 THEN lpad(p[1], 2, '0') ELSE p[1] END), '-'), '-00$', '') END"
_EDGES = """
f AS (SELECT record_group_id, min(id) AS mid, min_by(r_type, id) AS mtype FROM merged_records WHERE record_group_id IS NOT NULL GROUP BY 1),
fwd AS (
  SELECT m.id, f.mid, m.r_type, f.mtype FROM merged_records m JOIN maybe_candidates c ON c.record_group_id = m.record_group_id AND c.candidate_type = 'viaf' JOIN record_groups g ON g.viaf_id = c.candidate_id JOIN f ON f.record_group_id = g.id
  UNION ALL
  SELECT m.id, f.mid, m.r_type, f.mtype FROM merged_records m JOIN maybe_candidates c ON c.record_group_id = m.record_group_id AND c.candidate_type = 'postgres' JOIN f ON f.record_group_id = try_cast(c.candidate_id AS BIGINT))"""
_REFRESH = """
moved AS (SELECT viaf_id FROM record_groups WHERE id % 2 = 0 AND viaf_id IS NOT NULL),
now AS (SELECT CASE WHEN v.viaf_id IN (SELECT viaf_id FROM moved) THEN '9' || v.viaf_id ELSE v.viaf_id END AS viaf_id, sources FROM viaf_clusters v),
have AS (SELECT id, viaf_id AS old FROM record_groups WHERE viaf_id IS NOT NULL AND coalesce(g_type, '') <> 'invalid'),
k AS (SELECT source, min(viaf_id) AS new FROM (SELECT unnest(sources) AS source, viaf_id FROM now) GROUP BY 1),
c AS (SELECT g.id, unnest(range(0, len(v.sources))) AS pos, unnest(v.sources) AS source FROM record_groups g JOIN viaf_clusters v ON v.viaf_id = g.viaf_id),
gone AS (SELECT * FROM have WHERE old NOT IN (SELECT viaf_id FROM now)),
found AS (SELECT c.id, min_by(k.new, c.pos) AS new FROM c JOIN gone USING (id) JOIN k USING (source) GROUP BY 1),
holder AS (SELECT old AS new, min(id) AS holder FROM have GROUP BY 1),
r AS (
  SELECT id, 'keep' AS action, old AS viaf_id, NULL::BIGINT AS into_group FROM have WHERE old IN (SELECT viaf_id FROM now)
  UNION ALL
  SELECT gone.id, CASE WHEN found.new IS NULL THEN 'lost' WHEN holder IS NOT NULL THEN 'merge' ELSE 'repoint' END, found.new, holder FROM gone LEFT JOIN found USING (id) LEFT JOIN holder ON holder.new = found.new)"""
_WORDS_OF_BODY = _TOK.format(S.collapse(_ck("name_norm")))
_BODY_RANK = _RANK.format(docs=_DOCS, dterms=_TOK.format(S.collapse("text")), qterms=_WORDS_OF_BODY, type=_TYPE.format("r_type"), spirit=_SPIRIT).replace("WHERE name_norm IS NOT NULL", "WHERE name_norm IS NOT NULL AND record_group_id IS NULL AND r_type = 'corporateBody'").replace("SELECT qid, did, shared, rank FROM k WHERE rank <= 10", "")
ORACLE = {
    "m_corporate_keyword": _BODY_RANK
    + f""", hd AS (SELECT viaf_id, unnest(range(0, len(headings))) AS pos, unnest(headings) AS heading FROM viaf_clusters),
sc AS (SELECT k.qid, k.did, k.rank, hd.pos, jaro_similarity({_ck('o.name_norm')}, {_ck('hd.heading')}) AS quality FROM k JOIN hd ON hd.viaf_id = k.did JOIN original_records o ON o.id = k.qid WHERE k.rank <= 10 AND hd.heading IS NOT NULL),
ok AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank, pos) AS n FROM sc WHERE quality >= 0.85)
SELECT qid AS record_id, did AS viaf_id, round(quality, 6) AS quality FROM ok WHERE n = 1""",
    "s_clusters": "SELECT g.id, v.viaf_id, v.name_type, array_to_string(v.headings, '|') AS headings, CASE v.gender WHEN 'a' THEN 'Female' WHEN 'b' THEN 'Male' END AS gender, v.birth, v.death, array_to_string(coalesce(v.titles, []), '|') AS titles FROM record_groups g JOIN viaf_clusters v ON v.viaf_id = g.viaf_id WHERE regexp_matches(g.viaf_record, 'VIAFCluster>\\s*$')",
    "m_identifier": "WITH s AS (SELECT viaf_id, string_split(unnest(sources), '|')[2] AS n FROM viaf_clusters), k AS (SELECT n, min(viaf_id) AS viaf_id FROM s GROUP BY 1) SELECT o.id AS record_id, k.viaf_id FROM original_records o JOIN record_groups g ON g.id = o.record_group_id JOIN viaf_clusters v ON v.viaf_id = g.viaf_id JOIN k ON k.n = string_split(v.sources[1], '|')[2] WHERE len(v.sources) > 0",
    "f_namespaces": r"""SELECT id, length(regexp_replace(regexp_replace(regexp_replace(viaf_record, '\sxmlns(:[\w.-]+)?\s*=\s*("[^"]*"|''[^'']*'')', '', 'g'), '(</?)[\w.-]+:([\w.-])', '\1\2', 'g'), '(\s)[\w.-]+:([\w.-]+\s*=\s*["''])', '\1\2', 'g')) AS n FROM record_groups WHERE viaf_record IS NOT NULL""",
    "m_in_group": f"""
WITH n AS (SELECT name, min(id) AS group_id FROM record_groups WHERE g_type = 'person' AND name IS NOT NULL GROUP BY 1),
dead AS (SELECT record_group_id FROM merged_records WHERE record_group_id IS NOT NULL GROUP BY 1 HAVING NOT min_by(valid, id)),
q AS (SELECT o.id, n.group_id, o.name_norm, greatest(-1, max({_QF.format('x.from_date', 'x.to_date')})) AS qf, greatest(-1, max({_QT.format('x.from_date', 'x.to_date')})) AS qt
  FROM original_records o JOIN n ON n.name = o.name_norm LEFT JOIN original_records x ON x.record_group_id = n.group_id
  WHERE o.record_group_id IS NULL AND o.r_type = 'person' AND n.group_id NOT IN (SELECT record_group_id FROM dead) GROUP BY 1, 2, 3)
SELECT id AS record_id, group_id FROM q WHERE (length(name_norm) > 10 AND (qf > 0 OR qt > 0)) OR ((length(name_norm) > 30 OR regexp_matches(name_norm, '[0-9]{{2}}')) AND qf <> 0 AND qt <> 0)""",
    "m_exact_person": f"WITH {_H}, {_AUTH} SELECT o.id AS record_id, h.viaf_id FROM original_records o JOIN h ON h.key = o.name_norm AND h.name_type = 'Personal' AND h.spirit = {_SP} JOIN a ON a.viaf_id = h.viaf_id WHERE o.record_group_id IS NULL AND o.r_type = 'person' AND ({_QF.format('a.af', 'a.at')}) <> 0 AND ({_QT.format('a.af', 'a.at')}) <> 0 AND (length(o.name_norm) > 30 OR regexp_matches(o.name_norm, '[0-9]{{4}}'))",
    "m_exact_corporate": f"""
WITH {_H}, {_AUTH}, n AS (SELECT name, min(id) AS group_id, arg_min_null(viaf_id, id) AS viaf_id FROM record_groups WHERE g_type = 'corporateBody' AND name IS NOT NULL GROUP BY 1),
o AS (SELECT * FROM original_records WHERE record_group_id IS NULL AND r_type = 'corporateBody'),
b AS (SELECT o.id AS record_id, n.group_id, n.viaf_id FROM o JOIN n ON n.name = o.name_norm LEFT JOIN a ON a.viaf_id = n.viaf_id WHERE length(o.name_norm) >= 20 OR (n.viaf_id IS NOT NULL AND ({_QF.format('a.af', 'a.at')}) <> 0 AND ({_QT.format('a.af', 'a.at')}) <> 0))
SELECT * FROM b UNION ALL
SELECT o.id, NULL, h.viaf_id FROM o JOIN h ON h.key = o.name_norm AND h.name_type = 'Corporate' AND h.spirit = {_SP} JOIN a ON a.viaf_id = h.viaf_id WHERE o.id NOT IN (SELECT record_id FROM b) AND ({_QF.format('a.af', 'a.at')}) <> 0 AND ({_QT.format('a.af', 'a.at')}) <> 0""",
    "a_label_frequency": "SELECT labelled_by, subject_code, count(*) AS n FROM doc_subject_labels WHERE subject_code IS NOT NULL GROUP BY 1, 2",
    "a_distinct_values": "SELECT record_id, array_to_string(list_sort(list_distinct(list_filter(list(lang), lambda x: x IS NOT NULL))), '|') AS langs FROM name_entries GROUP BY 1",
    "a_first_wins": "SELECT record_id, source_code, entry_id, seq_no, name FROM (SELECT *, row_number() OVER (PARTITION BY record_id, source_code ORDER BY seq_no, entry_id) AS r FROM name_entries) WHERE r = 1",
    "a_untyped_preferred": "SELECT record_id, lang, n_type, entry_id, seq_no FROM (SELECT *, row_number() OVER (PARTITION BY record_id, lang ORDER BY n_type IS NOT NULL, seq_no, entry_id) AS r FROM name_entries) WHERE r = 1",
    "a_citations": "SELECT record_id, lang, string_agg(source_code, '|' ORDER BY seq_no, entry_id) AS citations FROM name_entries WHERE lang IS NOT NULL AND source_code IS NOT NULL GROUP BY 1, 2",
    "a_merged_names": f"WITH {_ENTRIES} SELECT * FROM m",
    "a_name_scores": f"WITH {_ENTRIES}{_SCORES} SELECT group_id, name_key, score, row_number() OVER (PARTITION BY group_id ORDER BY score DESC, name_key) AS rank FROM s",
    "a_array_scores": "WITH u AS (SELECT entry_id, s.source AS source, s.n_type AS n_type FROM (SELECT entry_id, unnest(sources) AS s FROM merged_name_entries)), m AS (SELECT entry_id AS group_id, 0 AS name_key, source, n_type FROM u)" + _SCORES + "SELECT e.entry_id, coalesce(s.score, 0) AS score FROM merged_name_entries e LEFT JOIN s ON s.group_id = e.entry_id",
    "r_printed_sources": f"""WITH {_ENTRIES},
p AS (SELECT group_id, name_key, source, coalesce(n_type, '') = 'authorized_form' AS ok, coalesce(n_type, '') = 'authorized_form' AND NOT (lower(source) IN ('lc', 'lac', 'nla', 'oac') OR coalesce(name_origin, '') = 'cpf') AS folded FROM m WHERE source IS NOT NULL),
q AS (SELECT *, max(folded) OVER (PARTITION BY group_id, name_key) AS has FROM p)
SELECT DISTINCT group_id, name_key, CASE WHEN ok THEN 'authorizedForm' ELSE 'alternativeForm' END AS form, CASE WHEN folded THEN 'VIAF' ELSE source END AS label FROM q WHERE NOT (NOT ok AND source = 'VIAF' AND has)""",
    "a_exist_dates": f"""
WITH a AS (SELECT g.id AS group_id, g.g_type, CASE WHEN v.birth <> '0' THEN v.birth END AS birth, CASE WHEN v.death <> '0' THEN v.death END AS death FROM record_groups g LEFT JOIN viaf_clusters v ON v.viaf_id = g.viaf_id),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_group_id ORDER BY id) AS n FROM original_records WHERE record_group_id IS NOT NULL AND (from_date IS NOT NULL OR to_date IS NOT NULL)) WHERE n = 1),
j AS (SELECT a.*, r.*, birth IS NOT NULL OR death IS NOT NULL AS stated FROM a LEFT JOIN r ON r.record_group_id = a.group_id)
SELECT group_id, CASE WHEN stated THEN 'authority' ELSE 'record' END AS origin, CASE WHEN stated THEN {_PAD.format('birth')} ELSE cast(from_date AS VARCHAR) END AS from_text,
  CASE WHEN stated THEN CASE WHEN birth IS NOT NULL THEN CASE WHEN g_type = 'person' THEN 'Birth' ELSE 'Active' END END ELSE regexp_extract(from_date_type, '[^#]*$') END AS from_type,
  CASE WHEN stated THEN {_PAD.format('death')} ELSE cast(to_date AS VARCHAR) END AS to_text, CASE WHEN stated THEN CASE WHEN death IS NOT NULL THEN 'Death' END ELSE regexp_extract(to_date_type, '[^#]*$') END AS to_type
FROM j WHERE stated OR n = 1""",
    "r_same_as": f"""
WITH g AS (SELECT g.id AS group_id, v.viaf_id, v.headings, v.heading_ids FROM record_groups g JOIN viaf_clusters v ON v.viaf_id = g.viaf_id WHERE g_type IN ('person', 'corporateBody')), h AS (SELECT group_id, unnest(heading_ids) AS h FROM g)
SELECT group_id, '{HOSTS['viaf']}' || viaf_id AS href FROM g WHERE len(headings) > 0 UNION ALL SELECT group_id, '{HOSTS['worldcat']}' || h.lccn_wcid FROM h WHERE h.lccn_wcid IS NOT NULL
UNION ALL SELECT group_id, '{HOSTS['loc']}' || h.lccn_lcid FROM h WHERE h.lccn_lcid IS NOT NULL UNION ALL SELECT group_id, '{HOSTS['wiki']}' || h.url_id FROM h WHERE h.url_id IS NOT NULL""",
    "r_new_merged": "SELECT id AS record_group_id, name, g_type AS r_type, true AS valid FROM record_groups g WHERE coalesce(g_type, '') <> 'invalid' AND NOT EXISTS (SELECT 1 FROM merged_records m WHERE m.record_group_id = g.id)",
    "r_identifiers": "WITH need AS (SELECT id, row_number() OVER (ORDER BY id) AS n FROM merged_records WHERE canonical_id IS NULL), stock AS (SELECT c AS canonical_id, row_number() OVER (ORDER BY c) AS n FROM (SELECT DISTINCT 'ark:/00000/y' || lpad(cast(id AS VARCHAR), 9, '0') AS c FROM merged_records) WHERE c NOT IN (SELECT canonical_id FROM merged_records WHERE canonical_id IS NOT NULL)) SELECT need.id, stock.canonical_id FROM need JOIN stock USING (n)",
    "r_split": "WITH a AS (SELECT m.id AS merged_id, o.collection_id AS part, o.id AS record_id, o.name_norm, o.r_type FROM merged_records m JOIN original_records o ON o.record_group_id = m.record_group_id WHERE m.valid), k AS (SELECT merged_id FROM a GROUP BY 1 HAVING count(DISTINCT part) > 1) SELECT merged_id, part, min_by(name_norm, record_id) AS name, min_by(r_type, record_id) AS g_type, count(*) AS n_records FROM a WHERE merged_id IN (SELECT merged_id FROM k) GROUP BY 1, 2",
    "r_absorb": f"WITH {_EDGES}, p AS (SELECT mid AS target_id, min(id) AS id FROM fwd WHERE r_type = mtype AND mid <> id GROUP BY 1) SELECT o.id AS record_id, t.record_group_id AS from_group, m.record_group_id AS to_group FROM p JOIN merged_records m ON m.id = p.id JOIN merged_records t ON t.id = p.target_id JOIN original_records o ON o.record_group_id = t.record_group_id",
    "r_tombstones": "WITH n AS (SELECT invalidates_record_id AS id, count(*) AS n FROM merged_records WHERE invalidates_record_id IS NOT NULL GROUP BY 1) SELECT d.id, d.canonical_id, d.r_type, CASE WHEN n = 1 THEN 'MergedInto' WHEN n > 1 THEN 'SplitInto' ELSE 'Cancelled' END AS relation, b.canonical_id AS other_id FROM merged_records d LEFT JOIN n ON n.id = d.id LEFT JOIN merged_records b ON b.invalidates_record_id = d.id WHERE NOT d.valid",
    "r_origins": "WITH n AS (SELECT invalidates_record_id AS id, count(*) AS n FROM merged_records WHERE invalidates_record_id IS NOT NULL GROUP BY 1) SELECT m.id, CASE WHEN n = 1 THEN 'MergedFrom' ELSE 'SplitFrom' END AS relation, o.canonical_id AS other_id FROM merged_records m JOIN n ON n.id = m.invalidates_record_id JOIN merged_records o ON o.id = m.invalidates_record_id",
    "r_refresh": f"WITH {_REFRESH} SELECT * FROM r",
    "r_remapped": f"WITH {_REFRESH} SELECT c.id, coalesce(r.into_group, c.record_group_id) AS record_group_id, c.candidate_type, c.candidate_id FROM maybe_candidates c LEFT JOIN r ON r.id = c.record_group_id AND r.action = 'merge'",
    "s_backfill": "WITH t AS (SELECT path, min_by(record_data, id) AS d FROM original_records WHERE record_data IS NOT NULL GROUP BY 1) SELECT o.id, length(coalesce(o.record_data, t.d)) AS n FROM original_records o LEFT JOIN t ON t.path = o.path",
    "s_files": "SELECT replace(regexp_replace(canonical_id, '^ark:/', ''), '/', '-') || '.xml' AS file_name, record_data AS xml FROM merged_records WHERE canonical_id IS NOT NULL AND record_data IS NOT NULL",
} | xmlsql.FIELDS

_PENDING = "WHERE name_norm IS NOT NULL AND record_group_id IS NULL AND r_type = 'person'"
_BEGIN, _END = _QF.format("a.af", "a.at"), _QT.format("a.af", "a.at")


def _person_rank(doc: str, query: str) -> str:
    sql = _RANK.format(docs=_DOCS, dterms=doc.format(S.collapse("text")), qterms=query.format(S.collapse("name_norm")), type=_TYPE.format("r_type"), spirit=_SPIRIT)
    return matchsql.acceptable(sql.replace("WHERE name_norm IS NOT NULL", _PENDING).rsplit("SELECT qid", 1)[0].rstrip(), _AUTH, _BEGIN, _END)


ORACLE |= {"m_keyword_person": _person_rank(_TOK, _TOK), "m_ngram_person": _person_rank(_GRAM, _GRAM), "r_audit": matchsql.AUDIT}
ORACLE["m_in_database"] = matchsql.in_database(_TRI, _QF.format("x.from_date", "x.to_date"), _QT.format("x.from_date", "x.to_date"))
ORACLE["m_cascade"] = matchsql.cascade(*[ORACLE[k] for k in ("m_in_group", "m_exact_person", "m_keyword_person", "m_ngram_person", "m_exact_corporate", "m_corporate_keyword")])
ORACLE["m_groups"] = matchsql.groups(ORACLE["m_cascade"])
ORACLE["m_maybes"] = f"SELECT group_no, group_id, 'viaf' AS candidate_type, maybe_viaf_id AS candidate_id FROM ({ORACLE['m_groups']}) WHERE maybe_viaf_id IS NOT NULL"
ORACLE["s_loaded"] = xmlsql.loaded(S.name_key("name"), S.authority_date("bt", False), S.authority_date("et", True))
ORACLE["s_cluster_names"] = xmlsql.cluster_names(SUBFIELD_ORDER)
ORACLE["r_tombstone_texts"] = xmlsql.tombstones(export.NAMESPACES, TERM, AGENCY, STAMP)


def _counted(name: str, sql: str, where: str = "true") -> str:
    return f"{name} AS (SELECT group_id, count(*) AS n FROM ({sql}) WHERE {where} GROUP BY 1)"


_MAYBE = f"""SELECT DISTINCT e.id, e.other_id, m.record_group_id AS group_id FROM ({_LOOKUPS['j_maybe_edges']}) e JOIN merged_records m ON m.id = e.id JOIN merged_records o ON o.id = e.other_id WHERE o.canonical_id IS NOT NULL AND o.name IS NOT NULL"""
_COUNTS = {
    "n_sources": ORACLE["r_sources"], "n_names": f"SELECT DISTINCT group_id, name_key FROM ({ORACLE['a_merged_names']})", "n_languages": ORACLE["u_languages"], "n_functions": ORACLE["a_functions"], "n_subjects": ORACLE["a_subjects"],
    "n_places": f"WITH {xmlsql.RECORDS}, {xmlsql.PLACES} SELECT group_id FROM places WHERE group_id IS NOT NULL", "n_occupations": ORACLE["a_occupations"],
    "n_relations": f"SELECT group_id FROM ({ORACLE['u_by_target']}) UNION ALL SELECT group_id FROM ({ORACLE['r_same_as']}) UNION ALL SELECT group_id FROM ({_MAYBE})",
    "n_resources": f"WITH {xmlsql.RECORDS}, {xmlsql.RESOURCES} SELECT group_id FROM resources WHERE group_id IS NOT NULL UNION ALL SELECT g.id FROM record_groups g JOIN (SELECT viaf_id, unnest(titles) AS t FROM viaf_clusters) v ON v.viaf_id = g.viaf_id WHERE v.t IS NOT NULL",
}
ORACLE["r_combined_parts"] = f"""WITH {', '.join(_counted(k, v) for k, v in _COUNTS.items())}, dt AS ({ORACLE['a_exist_dates']}),
sc AS (SELECT group_id, string_agg(DISTINCT lpad(cast(score AS VARCHAR), 2, '0'), ' ' ORDER BY lpad(cast(score AS VARCHAR), 2, '0')) AS scores FROM ({ORACLE['a_name_scores']}) GROUP BY 1)
SELECT m.canonical_id, m.record_group_id AS group_id, m.canonical_id AS record_id, g.g_type AS kind, dt.from_text, dt.to_text, coalesce(sc.scores, '') AS scores, {', '.join(f'coalesce({k}.n, 0) AS {k}' for k in _COUNTS)}
FROM merged_records m LEFT JOIN record_groups g ON g.id = m.record_group_id LEFT JOIN dt ON dt.group_id = m.record_group_id LEFT JOIN sc ON sc.group_id = m.record_group_id {' '.join(f'LEFT JOIN {k} ON {k}.group_id = m.record_group_id' for k in _COUNTS)}
WHERE m.valid AND m.canonical_id IS NOT NULL AND m.record_group_id IS NOT NULL"""
