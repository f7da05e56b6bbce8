"""Queries of the scalar functions, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmark.functions import dates, identifiers, normalize, similarity
from kinmark.operators import blocking, lookup
from kinmark.plans import sqltext as S
from kinmark.session import table


def _on_names(f, alias: str):  # noqa: ANN001, ANN202
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, "original_records").select("id", f(F.col("name")).alias(alias))

    return query


def _corporate(c: Column) -> Column:
    return normalize.strip_corporate_abbreviations(normalize.strip_accents(normalize.letters_key(c)))


def f_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digit tests and runs of every name."""
    n = F.col("name")
    return table(spark, sf_dir, "original_records").select("id", normalize.has_digits(n, 2).alias("two"), normalize.has_digits(n, 4).alias("four"), F.array_join(normalize.digit_runs(n), "|").alias("runs"), ((F.length(n) > 30) | normalize.has_digits(n, 4)).alias("guarded"))


def f_spirit_and_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spirit flag and authority type of every record."""
    return table(spark, sf_dir, "original_records").select("id", blocking.is_spirit(F.col("name")).alias("spirit"), blocking.name_type(F.col("r_type")).alias("name_type"), identifiers.capitalize(F.col("r_type")).alias("role"))


def _founder_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "record_groups").select(F.col("id").alias("record_group_id"), F.col("name").alias("group_name"))
    return table(spark, sf_dir, "original_records").select("id", "name_norm", "record_group_id").join(g, "record_group_id")


def f_jaro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jaro similarity and relative length of each record's and its group's name."""
    a, b = F.col("name_norm"), F.col("group_name")
    return _founder_pairs(spark, sf_dir).select("id", F.round(similarity.jaro(a, b), 6).alias("jaro"), F.round(similarity.relative_length(a, b), 6).alias("relative_length"))


def f_trigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram similarity of each record's and its group's name."""
    sim = similarity.trigram_similarity(similarity.trigrams(F.col("name_norm")), similarity.trigrams(F.col("group_name")))
    return _founder_pairs(spark, sf_dir).select("id", F.round(sim, 6).alias("similarity"))


def f_authority_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of every cluster: parsed and padded."""
    b, d = F.col("birth"), F.col("death")
    return table(spark, sf_dir, "viaf_clusters").select("viaf_id", dates.parse_date(b).alias("auth_from"), dates.parse_date(d, end=True).alias("auth_to"), dates.pad_date(b).alias("birth_padded"), dates.pad_date(d).alias("death_padded"))


def f_date_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compatibility of each grouped record's dates with its group's authority."""
    g = table(spark, sf_dir, "record_groups").where("viaf_id IS NOT NULL").select(F.col("id").alias("record_group_id"), "viaf_id")
    v = f_authority_dates(spark, sf_dir).select("viaf_id", "auth_from", "auth_to")
    j = table(spark, sf_dir, "original_records").join(g, "record_group_id").join(v, "viaf_id")
    return j.select("id", dates.quality(F.col("from_date"), F.col("from_date_type"), F.col("auth_from"), True).alias("qf"), dates.quality(F.col("to_date"), F.col("to_date_type"), F.col("auth_to"), False).alias("qt"))


def f_headings_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading ids of every cluster by kind."""
    h = table(spark, sf_dir, "viaf_clusters").select("viaf_id", F.posexplode("heading_ids").alias("pos", "h")).select("viaf_id", "pos", F.col("h.source").alias("raw"))
    number = identifiers.lc_number(F.col("raw"))
    return h.select("viaf_id", "pos", identifiers.worldcat_id(number).alias("wcid"), identifiers.lc_id(number).alias("lcid"), identifiers.wiki_id(F.col("raw")).alias("wiki"))


def f_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of merged records, back to identifiers, and escaped names."""
    m = table(spark, sf_dir, "merged_records").where("canonical_id IS NOT NULL")
    file = identifiers.ark_file_name(F.col("canonical_id"))
    return m.select("id", file.alias("file_name"), identifiers.file_name_ark(file).alias("back"), identifiers.full_ark(F.regexp_replace("canonical_id", "^ark:/", "")).alias("full"), identifiers.escape_xml(F.col("name")).alias("escaped"), identifiers.escape_attribute(F.col("name")).alias("attribute"))


def f_nationality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nationalities of every cluster by form, and its gender."""
    v = table(spark, sf_dir, "viaf_clusters").select("viaf_id", identifiers.gender(F.col("gender")).alias("gender_name"), F.explode("nationalities").alias("nationality"))
    return v.select("viaf_id", "gender_name", "nationality", F.when(identifiers.is_country_code(F.col("nationality")), "countryCode").otherwise("term").alias("form"))


def f_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of the addresses in date types."""
    r = table(spark, sf_dir, "original_records").where("from_date_type IS NOT NULL").select("id", F.concat("from_date_type", F.lit("?"), F.lit("x=1")).alias("u"), "from_date_type")
    scheme, host, path, query, fragment = identifiers.uri_parts(F.col("from_date_type"))
    return r.select("id", scheme, host, path, fragment)


def f_bad_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' first lines that would be no names."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("name"))
    return d.select("doc_id", lookup.malformed_name().alias("malformed"), lookup.overlong_name().alias("overlong"))


QUERIES = {
    "f_name_key": _on_names(normalize.name_key, "key"),
    "f_normalize": _on_names(normalize.normalize, "key"),
    "f_letters_key": _on_names(normalize.letters_key, "key"),
    "f_entry_key": _on_names(normalize.entry_key, "key"),
    "f_corporate_key": _on_names(_corporate, "key"),
    "f_strip_controls": _on_names(normalize.strip_controls, "key"),
    "f_date_words": _on_names(lambda c: normalize.strip_date_words(normalize.name_key(c)), "key"),
    "f_digits": f_digits,
    "f_spirit_and_type": f_spirit_and_type,
    "f_jaro": f_jaro,
    "f_trigram": f_trigram,
    "f_authority_dates": f_authority_dates,
    "f_date_quality": f_date_quality,
    "f_headings_ids": f_headings_ids,
    "f_files": f_files,
    "f_nationality": f_nationality,
    "f_addresses": f_addresses,
    "f_bad_names": f_bad_names,
}

_PAD = "CASE WHEN {0} = '' THEN {0} ELSE regexp_replace(CASE WHEN {0} LIKE '-%' THEN '-' ELSE '' END || array_to_string(list_transform(list_zip(string_split(regexp_replace({0}, '^-', ''), '-'), range(1, 1 + len(string_split(regexp_replace({0}, '^-', ''), '-')))), lambda p: CASE WHEN p[2] = 1 AND length(p[1]) < 4 THEN lpad(p[1], 4, '0') WHEN p[2] <= 3 AND p[2] > 1 AND length(p[1]) < 2 THEN lpad(p[1], 2, '0') ELSE p[1] END), '-'), '-00$', '') END"
_TRI = "list_distinct(flatten(list_transform(list_filter(string_split(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"
_NAMES = "SELECT id, {} AS key FROM original_records"
_WORDS = "['d','b','circa','ca','active','approximately','fl','c','approximate']"
_DATES = f"SELECT viaf_id, {S.authority_date('birth', False)} AS auth_from, {S.authority_date('death', True)} AS auth_to FROM viaf_clusters"
ORACLE = {
    "f_name_key": _NAMES.format(S.name_key("name")),
    "f_normalize": _NAMES.format(f"strip_accents(regexp_replace({S.strip('lower(name)')}, '{S.PUNCT}', '', 'g'))"),
    "f_letters_key": _NAMES.format(S.letters_key("name")),
    "f_entry_key": _NAMES.format(f"""lower({S.compress('''regexp_replace(regexp_replace(name, '[/!,"();:.?{}\\-\\x{bf}\\x{a1}<>]', ' ', 'g'), '[\\[\\]'']', '', 'g')''')})"""),
    "f_corporate_key": _NAMES.format(f"array_to_string(list_filter(string_split({S.letters_key('name')}, ' '), lambda w: NOT list_contains({S.CORPORATE}, w)), ' ')"),
    "f_strip_controls": _NAMES.format("regexp_replace(name, '[\\x00-\\x1f\\x7f\\x{80}-\\x{9f}]', '', 'g')"),
    "f_date_words": _NAMES.format(f"array_to_string(list_filter(string_split({S.name_key('name')}, ' '), lambda w: NOT list_contains({_WORDS}, w)), ' ')"),
    "f_digits": "SELECT id, regexp_matches(name, '[0-9]{2}') AS two, regexp_matches(name, '[0-9]{4}') AS four, array_to_string(regexp_extract_all(name, '[0-9]+'), '|') AS runs, length(name) > 30 OR regexp_matches(name, '[0-9]{4}') AS guarded FROM original_records",
    "f_spirit_and_type": "SELECT id, coalesce(contains(lower(name), '(spirit)'), false) AS spirit, CASE r_type WHEN 'corporateBody' THEN 'Corporate' WHEN 'person' THEN 'Personal' WHEN 'family' THEN 'Personal' END AS name_type, upper(substr(r_type, 1, 1)) || lower(substr(r_type, 2)) AS role FROM original_records",
    "f_jaro": "SELECT o.id, round(jaro_similarity(o.name_norm, g.name), 6) AS jaro, round(CASE WHEN length(o.name_norm) + length(g.name) > 0 THEN abs(length(o.name_norm) - length(g.name)) / (length(o.name_norm) + length(g.name)) END, 6) AS relative_length FROM original_records o JOIN record_groups g ON o.record_group_id = g.id",
    "f_trigram": f"WITH p AS (SELECT o.id, {_TRI.format('o.name_norm')} AS a, {_TRI.format('g.name')} AS b FROM original_records o JOIN record_groups g ON o.record_group_id = g.id) SELECT id, round(CASE WHEN len(list_distinct(list_concat(a, b))) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 6) AS similarity FROM p",
    "f_authority_dates": f"SELECT viaf_id, {S.authority_date('birth', False)} AS auth_from, {S.authority_date('death', True)} AS auth_to, {_PAD.format('birth')} AS birth_padded, {_PAD.format('death')} AS death_padded FROM viaf_clusters",
    "f_date_quality": f"WITH v AS ({_DATES}) SELECT o.id, {S.year_quality('o.from_date', 'o.from_date_type', 'v.auth_from', True)} AS qf, {S.year_quality('o.to_date', 'o.to_date_type', 'v.auth_to', False)} AS qt FROM original_records o JOIN record_groups g ON o.record_group_id = g.id JOIN v ON v.viaf_id = g.viaf_id",
    "f_headings_ids": "WITH h AS (SELECT viaf_id, unnest(range(0, len(heading_ids))) AS pos, unnest(heading_ids) AS h FROM viaf_clusters), n AS (SELECT viaf_id, pos, h.source AS raw, CASE WHEN h.source LIKE 'LC%' THEN regexp_replace(string_split(h.source, '|')[2], '\\s+', ' ', 'g') END AS num FROM h) SELECT viaf_id, pos, 'lccn-' || CASE WHEN len(string_split(num, ' ')) > 1 THEN string_split(num, ' ')[1] || string_split(num, ' ')[2] ELSE num END AS wcid, replace(num, ' ', '') AS lcid, CASE WHEN raw LIKE 'WKP%' THEN string_split(raw, '|')[2] END AS wiki FROM n",
    "f_files": "SELECT id, replace(regexp_replace(canonical_id, '^ark:/', ''), '/', '-') || '.xml' AS file_name, canonical_id AS back, canonical_id AS full, replace(replace(replace(name, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped, replace(replace(replace(replace(replace(replace(replace(name, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(13), '&#xD;'), chr(10), '&#xA;'), chr(9), '&#x9;') AS attribute FROM merged_records WHERE canonical_id IS NOT NULL",
    "f_nationality": "SELECT viaf_id, gender_name, nationality, CASE WHEN regexp_matches(nationality, '^\\p{Lu}+$') THEN 'countryCode' ELSE 'term' END AS form FROM (SELECT viaf_id, CASE gender WHEN 'a' THEN 'Female' WHEN 'b' THEN 'Male' END AS gender_name, unnest(nationalities) AS nationality FROM viaf_clusters)",
    "f_addresses": "SELECT id, regexp_extract(from_date_type, '^([a-z]+):', 1) AS scheme, regexp_extract(from_date_type, '^[a-z]+://([^/]+)', 1) AS host, regexp_extract(from_date_type, '^[a-z]+://[^/]+([^#?]*)', 1) AS path, regexp_extract(from_date_type, '#(.*)$', 1) AS fragment FROM original_records WHERE from_date_type IS NOT NULL",
    "f_bad_names": "WITH d AS (SELECT doc_id, string_split(text, chr(10))[1] AS name FROM documents) SELECT doc_id, length(name) >= 30 AND regexp_matches(name, '^[^\\n]*;[^\\n]*;') AS malformed, length(name) >= 300 OR (length(name) >= 200 AND (length(name) - length(replace(name, ',', '')) > 8 OR length(name) - length(replace(name, ';', '')) > 5)) AS overlong FROM d",
}
