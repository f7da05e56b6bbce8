"""Queries of look-ups, filters and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmark.operators import blocking, index, lookup
from kinmark.plans import sqltext as S
from kinmark.session import table
from kinmark.streaming.incremental import windowed_arrivals

_SINCE = "2013-06-01 00:00:00"
_MERGED = ["id", "canonical_id", "name", "r_type", "record_group_id"]


def _t(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]


def p_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page of unprocessed records of the largest collection from an id on (the page is the feature)."""
    r = table(spark, sf_dir, "original_records")
    return lookup.page(lookup.unprocessed(r, "nordlach", start=100), [F.col("id")], limit=100).select("id", "name", "collection_id")


def p_starting_with(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page of groups in order of id."""
    return lookup.page(lookup.starting_with(table(spark, sf_dir, "record_groups"), 10), [F.col("id")], limit=50, offset=50).select("id", "name")


def p_in_given_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records for a list of ids (those that were removed from groups, by time), with their places in the list."""
    removed, records = _t(spark, sf_dir, "removed_references", "original_records")
    ids = removed.select(F.col("id").alias("pos"), F.col("original_record_id").alias("id"))
    return lookup.in_given_order(records.select("id", "name"), ids).select("pos", "id", "name")


def p_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All merged records, ids and names only (the scan reads two columns)."""
    return table(spark, sf_dir, "merged_records").select("id", "name")


def p_first_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of the lowest id for every type and name."""
    return lookup.first_by(table(spark, sf_dir, "record_groups").select("id", "g_type", "name"), "g_type", "name")


def p_by_canonical_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A valid merged record by its identifier."""
    return lookup.by_key(table(spark, sf_dir, "merged_records"), "canonical_id", "ark:/00000/x000000002", valid_only=True).select(*_MERGED)


def p_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of bodies that have an authority id."""
    return lookup.of_type(table(spark, sf_dir, "record_groups"), "corporateBody", with_authority=True).select("id", "name", "viaf_id")


def p_without_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged records without identifier."""
    return lookup.without_canonical_id(table(spark, sf_dir, "merged_records")).select("id", "name")


def p_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged records with identifier that wait for export."""
    return lookup.assigned(table(spark, sf_dir, "merged_records"), 1).select("id", "canonical_id")


def p_candidates_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that name a cluster some group has."""
    maybes, groups = _t(spark, sf_dir, "maybe_candidates", "record_groups")
    named = maybes.where("candidate_type = 'viaf'")
    return named.join(groups.where("viaf_id IS NOT NULL").select(F.col("viaf_id").alias("candidate_id")), "candidate_id", "left_semi").select("id", "record_group_id", "candidate_id")


def a_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct collections."""
    return lookup.collections(table(spark, sf_dir, "original_records"))


def j_without_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups without merged record."""
    groups, merged = _t(spark, sf_dir, "record_groups", "merged_records")
    return lookup.groups_without_merge(groups, merged).select("id", "name", "g_type")


def j_by_authority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged records with their authority ids."""
    merged, groups = _t(spark, sf_dir, "merged_records", "record_groups")
    return lookup.merged_by_authority(merged, groups).select("id", "viaf_id", "record_group_id")


def j_changed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged records whose groups got records after a moment."""
    merged, records = _t(spark, sf_dir, "merged_records", "original_records")
    return lookup.changed_since(merged, records, _SINCE).select(*_MERGED)


def j_of_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged records of groups with records of two collections."""
    merged, records = _t(spark, sf_dir, "merged_records", "original_records")
    return lookup.of_collections(merged, records, ["nordlach", "tobra2"]).select(*_MERGED)


def j_same_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of each record's exact normalised name."""
    records, groups = _t(spark, sf_dir, "original_records", "record_groups")
    return lookup.same_name_group(records, groups)


def j_exact_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster whose heading is a record's normalised name."""
    records, clusters = _t(spark, sf_dir, "original_records", "viaf_clusters")
    return blocking.exact_heading(records, blocking.headings(clusters))


def j_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best clusters of every record by words."""
    records, clusters = _t(spark, sf_dir, "original_records", "viaf_clusters")
    return blocking.keyword_candidates(records, blocking.headings(clusters), whole=True)


def j_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best clusters of every record by trigrams."""
    records, clusters = _t(spark, sf_dir, "original_records", "viaf_clusters")
    return blocking.ngram_candidates(records, blocking.headings(clusters), whole=True)


def j_close_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised names of groups at an edit distance below five."""
    return blocking.close_names(table(spark, sf_dir, "record_groups").select("name"))


def j_similar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised names of groups that share more than three quarters of their trigrams."""
    return blocking.similar_names(table(spark, sf_dir, "record_groups").select("name"))


def j_close_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record and the other grouped records at an edit distance below five of the normalised names."""
    return blocking.close_records(table(spark, sf_dir, "original_records"))


def j_similar_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record and the other grouped records that share more than three quarters of their names' trigrams."""
    return blocking.similar_records(table(spark, sf_dir, "original_records"))


def j_source_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of each group by the source codes of its own cluster."""
    groups, clusters = _t(spark, sf_dir, "record_groups", "viaf_clusters")
    codes = groups.where("viaf_id IS NOT NULL").select("id", "viaf_id").join(clusters.select("viaf_id", F.posexplode("sources").alias("pos", "source")), "viaf_id").select("id", "pos", "source")
    return lookup.by_source_code(groups, clusters, codes)


def j_authority_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of groups by id and matching type."""
    groups, clusters = _t(spark, sf_dir, "record_groups", "viaf_clusters")
    g = groups.where("viaf_id IS NOT NULL").select("id", "viaf_id", blocking.name_type(F.col("g_type")).alias("name_type"))
    return g.join(clusters.select("viaf_id", "name_type", F.size("headings").alias("n_headings")), ["viaf_id", "name_type"])


def j_maybe_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged records that may be the same, both ways."""
    return lookup.maybe_edges(*_t(spark, sf_dir, "merged_records", "record_groups", "maybe_candidates"))


def j_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invalidated records and what invalidates them."""
    return lookup.lineage(table(spark, sf_dir, "merged_records"))


def j_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that once belonged to groups."""
    groups, removed, records = _t(spark, sf_dir, "record_groups", "removed_references", "original_records")
    return lookup.previous_records(groups, removed, records).select("group_id", "id", "name")


def t_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three newest entries of every merged group."""
    e = table(spark, sf_dir, "merged_name_entries").select("record_group_id", "entry_id", "updated_at")
    return lookup.top_k(e, ["record_group_id"], [F.desc("updated_at"), F.col("entry_id")], 3).select("record_group_id", "entry_id", "rank")


def s_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of each collection by 30 days of arrival."""
    out = windowed_arrivals(table(spark, sf_dir, "original_records"))
    return out.select("collection_id", F.unix_timestamp("from_ts").alias("from_s"), "n")


def x_index_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every search index."""
    return index.sizes(table(spark, sf_dir, "viaf_clusters"))


def x_all_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters that hold a record's whole normalised name among all their names."""
    records, clusters = _t(spark, sf_dir, "original_records", "viaf_clusters")
    terms = records.select(F.col("id").alias("qid"), F.col("name_norm").alias("key"), blocking.name_type(F.col("r_type")).alias("name_type"))
    return index.search(clusters, "xallnames", terms, with_type=True)


_FUNCTIONS = [
    x_index_sizes, x_all_names, p_unprocessed, p_starting_with, p_in_given_order, p_all, p_first_by_name, p_by_canonical_id, p_of_type, p_without_id, p_assigned, p_candidates_of, a_collections, j_without_merge, j_by_authority, j_changed_since,
    j_of_collections, j_same_name, j_exact_heading, j_keyword, j_ngram, j_close_names, j_similar_names, j_close_records, j_similar_records, j_source_code, j_authority_id, j_maybe_edges, j_lineage, j_previous, t_newest, s_arrivals,
]
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_M = "m.id, m.canonical_id, m.name, m.r_type, m.record_group_id"
_TYPE = "CASE {0} WHEN 'corporateBody' THEN 'Corporate' WHEN 'person' THEN 'Personal' WHEN 'family' THEN 'Personal' END"
_SPIRIT = "coalesce(contains(lower(name), '(spirit)'), false)"
_DOCS = "SELECT viaf_id AS did, name_type, coalesce(spirit, false) AS spirit, array_to_string(list_sort(list_distinct(list_filter(headings, lambda h: h IS NOT NULL))), ' ') AS text FROM viaf_clusters WHERE len(headings) > 0"
_RANK = """
WITH d0 AS ({docs}),
d AS (SELECT did, name_type, spirit, {dterms} AS terms FROM d0),
q AS (SELECT id AS qid, {type} AS name_type, {spirit} AS spirit, {qterms} AS terms FROM original_records WHERE name_norm IS NOT NULL),
dt AS (SELECT did, name_type, spirit, unnest(terms) AS term FROM d),
df AS (SELECT name_type, spirit, term, count(*) AS df FROM dt GROUP BY 1, 2, 3),
qt AS (SELECT q.qid, q.name_type, q.spirit, q.term, row_number() OVER (PARTITION BY qid ORDER BY df.df, q.term) AS r FROM (SELECT qid, name_type, spirit, unnest(terms) AS term FROM q) q JOIN df USING (name_type, spirit, term)),
c AS (SELECT DISTINCT qt.qid, dt.did FROM qt JOIN dt USING (name_type, spirit, term)),
s AS (SELECT c.qid, c.did, len(list_intersect(q.terms, d.terms)) AS shared, len(q.terms) + len(d.terms) AS total FROM c JOIN q USING (qid) JOIN d USING (did)),
k AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY shared DESC, shared / (total - shared) DESC, did) AS rank FROM s)
SELECT qid, did, shared, rank FROM k WHERE rank <= 10
"""
_TOK = "list_distinct(list_filter(string_split({0}, ' '), lambda w: w <> ''))"
_GRAM = "list_distinct(list_transform(range(1, greatest(1, length({0}) + 2 - 3 + 1) + 1), lambda i: substr(' ' || {0} || ' ', i, 3)))"
_TRI = "list_distinct(flatten(list_transform(list_filter(string_split(regexp_replace(lower(name), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"
ORACLE = {
    "x_all_names": f"WITH n AS (SELECT viaf_id, name_type, unnest(list_concat(coalesce(headings, []), list_concat(coalesce(list_transform(auth_forms, lambda x: x.name), []), coalesce(list_transform(alt_forms, lambda x: x.name), [])))) AS name FROM viaf_clusters), k AS (SELECT DISTINCT viaf_id, name_type, {S.name_key('name')} AS key FROM n) SELECT DISTINCT o.id AS qid, k.viaf_id FROM original_records o JOIN k ON k.key = o.name_norm AND k.name_type = {_TYPE.format('o.r_type')} WHERE o.name_norm <> ''",
    "p_unprocessed": "SELECT id, name, collection_id FROM original_records WHERE NOT coalesce(processed, false) AND collection_id = 'nordlach' AND id >= 100 ORDER BY id LIMIT 100",
    "p_starting_with": "SELECT id, name FROM record_groups WHERE id >= 10 ORDER BY id LIMIT 50 OFFSET 50",
    "p_in_given_order": "SELECT r.id AS pos, o.id, o.name FROM removed_references r JOIN original_records o ON o.id = r.original_record_id",
    "p_all": "SELECT id, name FROM merged_records",
    "p_first_by_name": "SELECT g_type, name, min(id) AS id FROM record_groups GROUP BY 1, 2",
    "p_by_canonical_id": f"SELECT {_M} FROM merged_records m WHERE canonical_id = 'ark:/00000/x000000002' AND valid",
    "p_of_type": "SELECT id, name, viaf_id FROM record_groups WHERE g_type = 'corporateBody' AND viaf_id IS NOT NULL",
    "p_without_id": "SELECT id, name FROM merged_records WHERE canonical_id IS NULL",
    "p_assigned": "SELECT id, canonical_id FROM merged_records WHERE canonical_id IS NOT NULL AND processed = false AND id >= 1",
    "p_candidates_of": "SELECT id, record_group_id, candidate_id FROM maybe_candidates WHERE candidate_type = 'viaf' AND candidate_id IN (SELECT viaf_id FROM record_groups WHERE viaf_id IS NOT NULL)",
    "a_collections": "SELECT DISTINCT collection_id FROM original_records",
    "j_without_merge": "SELECT id, name, g_type FROM record_groups g WHERE coalesce(g_type, '') <> 'invalid' AND NOT EXISTS (SELECT 1 FROM merged_records m WHERE m.record_group_id = g.id)",
    "j_by_authority": "SELECT m.id, g.viaf_id, m.record_group_id FROM merged_records m JOIN record_groups g ON g.id = m.record_group_id WHERE g.viaf_id IS NOT NULL",
    "j_changed_since": f"SELECT {_M} FROM merged_records m WHERE record_group_id IN (SELECT record_group_id FROM original_records WHERE record_group_id IS NOT NULL AND created_at > TIMESTAMPTZ '{_SINCE}+00')",
    "j_of_collections": f"SELECT {_M} FROM merged_records m WHERE record_group_id IN (SELECT record_group_id FROM original_records WHERE record_group_id IS NOT NULL AND collection_id IN ('nordlach', 'tobra2'))",
    "j_same_name": "SELECT o.id AS record_id, min(g.id) AS group_id FROM original_records o JOIN record_groups g ON g.g_type = o.r_type AND g.name = o.name_norm GROUP BY 1",
    "j_exact_heading": f"WITH h AS (SELECT {S.name_key('heading')} AS key, name_type, spirit, min(viaf_id) AS viaf_id FROM (SELECT viaf_id, name_type, coalesce(spirit, false) AS spirit, unnest(headings) AS heading FROM viaf_clusters) GROUP BY 1, 2, 3) SELECT o.id AS record_id, h.viaf_id FROM original_records o JOIN h ON h.key = o.name_norm AND h.name_type = {_TYPE.format('o.r_type')} AND h.spirit = coalesce(contains(lower(o.name), '(spirit)'), false)",
    "j_keyword": _RANK.format(docs=_DOCS, dterms=_TOK.format(S.collapse("text")), qterms=_TOK.format(S.collapse("name_norm")), type=_TYPE.format("r_type"), spirit=_SPIRIT),
    "j_ngram": _RANK.format(docs=_DOCS, dterms=_GRAM.format(S.collapse("text")), qterms=_GRAM.format(S.collapse("name_norm")), type=_TYPE.format("r_type"), spirit=_SPIRIT),
    "j_close_names": "WITH t AS (SELECT DISTINCT substr(name, 1, 254) AS t FROM record_groups WHERE name IS NOT NULL) SELECT a.t AS a, b.t AS b, levenshtein(a.t, b.t) AS distance FROM t a JOIN t b ON a.t < b.t AND abs(length(a.t) - length(b.t)) < 5 WHERE levenshtein(a.t, b.t) < 5",
    "j_similar_names": f"WITH t AS (SELECT name AS t, {_TRI} AS g FROM (SELECT DISTINCT name FROM record_groups WHERE name IS NOT NULL)) SELECT a.t AS a, b.t AS b, round(len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))), 6) AS similarity FROM t a JOIN t b ON a.t < b.t AND len(a.g) > 0 AND least(len(a.g), len(b.g)) > 0.75 * greatest(len(a.g), len(b.g)) WHERE len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))) > 0.75",
    "j_source_code": "WITH k AS (SELECT source, min(viaf_id) AS viaf_id FROM (SELECT viaf_id, unnest(sources) AS source FROM viaf_clusters) GROUP BY 1), c AS (SELECT g.id, unnest(range(0, len(v.sources))) AS pos, unnest(v.sources) AS source FROM record_groups g JOIN viaf_clusters v ON v.viaf_id = g.viaf_id) SELECT c.id, min_by(k.viaf_id, c.pos) AS viaf_id FROM c JOIN k USING (source) GROUP BY 1",
    "j_authority_id": f"SELECT v.viaf_id, v.name_type, g.id, len(v.headings) AS n_headings FROM record_groups g JOIN viaf_clusters v ON v.viaf_id = g.viaf_id AND v.name_type = {_TYPE.format('g.g_type')}",
    "j_maybe_edges": """
WITH f AS (SELECT record_group_id, min(id) AS mid, min_by(r_type, id) AS mtype FROM merged_records WHERE record_group_id IS NOT NULL GROUP BY 1),
fwd AS (
  SELECT m.id, f.mid, m.r_type, f.mtype FROM merged_records m JOIN maybe_candidates c ON c.record_group_id = m.record_group_id AND c.candidate_type = 'viaf' JOIN record_groups g ON g.viaf_id = c.candidate_id JOIN f ON f.record_group_id = g.id
  UNION ALL
  SELECT m.id, f.mid, m.r_type, f.mtype FROM merged_records m JOIN maybe_candidates c ON c.record_group_id = m.record_group_id AND c.candidate_type = 'postgres' JOIN f ON f.record_group_id = try_cast(c.candidate_id AS BIGINT)),
rev AS (SELECT m.id, f.mid, m.r_type, f.mtype FROM merged_records m JOIN record_groups g ON g.id = m.record_group_id JOIN maybe_candidates c ON c.candidate_id = g.viaf_id JOIN f ON f.record_group_id = c.record_group_id WHERE f.mid <> m.id)
SELECT id, mid AS other_id, 'forward' AS direction FROM fwd WHERE r_type = mtype UNION ALL SELECT id, mid, 'reverse' FROM rev WHERE r_type = mtype""",
    "j_lineage": "SELECT o.id, o.canonical_id, o.valid, n.id AS by_id, n.canonical_id AS by_canonical_id FROM merged_records o JOIN merged_records n ON n.invalidates_record_id = o.id",
    "j_previous": "SELECT r.record_group_id AS group_id, o.id, o.name FROM removed_references r JOIN record_groups g ON g.id = r.record_group_id JOIN original_records o ON o.id = r.original_record_id",
    "t_newest": "SELECT record_group_id, entry_id, rank FROM (SELECT record_group_id, entry_id, row_number() OVER (PARTITION BY record_group_id ORDER BY updated_at DESC, entry_id) AS rank FROM merged_name_entries) WHERE rank <= 3",
    "s_arrivals": "SELECT collection_id, cast(floor(epoch(created_at) / 2592000) * 2592000 AS BIGINT) AS from_s, count(*) AS n FROM original_records GROUP BY 1, 2",
}

_ALL = "list_concat(coalesce(headings, []), list_concat(coalesce(list_transform(auth_forms, lambda x: x.name), []), coalesce(list_transform(alt_forms, lambda x: x.name), [])))"


def _keys(name: str, values: str, key: str) -> str:
    return f"SELECT '{name}' AS name, viaf_id, {key} AS key FROM (SELECT viaf_id, unnest({values}) AS v FROM viaf_clusters WHERE viaf_id IS NOT NULL) WHERE v IS NOT NULL"


_V = "list_transform(alt_forms, lambda x: x.name)"
_WORDS_OF, _GRAMS_OF = f"unnest({_TOK.format(S.collapse('v'))})", f"unnest({_GRAM.format(S.collapse('v'))})"
_INDEX = " UNION ALL ".join(
    [
        _keys("idnumber", "sources", "replace(v, '|', ' ')"), _keys("viafid", "[viaf_id]", "v"), _keys("xmainname", "headings", S.name_key("v")), _keys("mainname", "headings", _WORDS_OF), _keys("seerefs", _V, _WORDS_OF),
        _keys("birthdate", "[CASE WHEN birth <> '0' THEN birth END]", "v"), _keys("deathdate", "[CASE WHEN death <> '0' THEN death END]", "v"), _keys("xmainnamenn", "headings", "v"), _keys("mainnamenn", "headings", "unnest(regexp_split_to_array(v, '\\s+'))"),
        _keys("xallnames", _ALL, S.name_key("v")), _keys("allnames", _ALL, _WORDS_OF), _keys("allnamesngram", _ALL, _GRAMS_OF), _keys("mainnamengram", "headings", _GRAMS_OF), _keys("nametype", "[lower(name_type)]", "v"), _keys("spirit", "[CASE WHEN spirit THEN '1' ELSE '0' END]", "v"),
    ]
)
ORACLE["x_index_sizes"] = f"SELECT name AS index, count(DISTINCT key) AS keys, count(DISTINCT (viaf_id, key)) AS entries FROM ({_INDEX}) WHERE key <> '' GROUP BY 1 UNION ALL SELECT 'seealso', 0, 0"
_STORED = "original_records o JOIN original_records x ON x.record_group_id IS NOT NULL AND x.id <> o.id"
# no SQL beside j_close_records: DuckDB's levenshtein counts bytes, and these names have letters of several
ORACLE["j_similar_records"] = f"""WITH t AS (SELECT name AS t, {_TRI} AS g FROM (SELECT DISTINCT name_norm AS name FROM original_records WHERE name_norm IS NOT NULL)),
s AS (SELECT a.t AS a, b.t AS b, round(len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))), 6) AS similarity FROM t a JOIN t b ON a.t <> b.t AND len(a.g) > 0 AND least(len(a.g), len(b.g)) > 0.75 * greatest(len(a.g), len(b.g)) WHERE len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))) > 0.75
  UNION ALL SELECT t, t, 1.0 FROM t WHERE len(g) > 0)
SELECT o.id AS record_id, x.id AS other_id, s.similarity FROM {_STORED} JOIN s ON s.a = o.name_norm AND s.b = x.name_norm"""
