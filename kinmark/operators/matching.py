"""The matching cascade: cheap exact stages first, fuzzy ones for what is left.

Each stage is a set-at-a-time join; a later stage sees only the records that no
earlier one decided (an anti-join).  Candidates are scored pairwise and the
first acceptable one in rank order wins, as in a search that stops at its first
hit.

Edge cases: records without name or type are not matched; NULL dates are
unknown and contradict nothing; clusters without headings are no candidates;
repeated records are matched each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmark.functions.dates import parse_date, quality
from kinmark.functions.humanname import name_match_quality
from kinmark.functions.normalize import has_digits, letters_key, strip_accents, strip_corporate_abbreviations
from kinmark.functions.similarity import jaro, relative_length
from kinmark.operators.blocking import exact_heading, headings, keyword_candidates, ngram_candidates, similar_names
from kinmark.operators.lookup import first_by, top_k
from kinmark.session import materialize

#: What is compared of a record.
COMPARED = ["r_type", "name", "name_norm", "from_date", "from_date_type", "to_date", "to_date_type"]
FUZZY, PERSON_ACCEPT, CORPORATE_ACCEPT = 0.85, 0.9, 0.95


def record_quality(auth_from: Column, auth_to: Column) -> tuple[Column, Column]:
    """(from, to) date qualities of the record columns against two authority dates."""
    begin = quality(F.col("from_date"), F.col("from_date_type"), auth_from, born=True)
    end = quality(F.col("to_date"), F.col("to_date_type"), auth_to, born=False)
    return begin, end


def with_authority_dates(index: DataFrame) -> DataFrame:
    """viaf_id, auth_from, auth_to of every cluster in the index of headings."""
    d = index.select("viaf_id", parse_date(F.col("birth")).alias("auth_from"), parse_date(F.col("death"), end=True).alias("auth_to"))
    return d.dropDuplicates(["viaf_id"])


def in_group(records: DataFrame, groups: DataFrame, members: DataFrame, merged: DataFrame) -> DataFrame:
    """record_id, group_id: persons whose exact name is a group's and whose dates fit a member's.

    The best quality over the members counts; groups whose first merged record
    is invalid are passed over.
    """
    named = first_by(groups.where("name IS NOT NULL AND g_type = 'person'").select("id", "name"), "name").select(F.col("id").alias("group_id"), F.col("name").alias("name_norm"))
    dead = merged.where("record_group_id IS NOT NULL").groupBy("record_group_id").agg(F.min_by("valid", "id").alias("valid")).where("NOT valid").select(F.col("record_group_id").alias("group_id"))
    q = records.where("r_type = 'person'").join(named.join(dead, "group_id", "left_anti"), "name_norm")
    other = members.where("record_group_id IS NOT NULL").select(F.col("record_group_id").alias("group_id"), F.col("from_date").alias("mf"), F.col("to_date").alias("mt"))
    # qualities depend on a member's dates only: distinct dates meet, not members
    other = other.distinct()
    begin, end = record_quality(F.col("mf"), F.col("mt"))
    best = q.join(other, "group_id", "left").groupBy("id", "group_id", "name_norm").agg(F.greatest(F.lit(-1), F.max(begin)).alias("qf"), F.greatest(F.lit(-1), F.max(end)).alias("qt"))
    sure = (F.length("name_norm") > 10) & ((F.col("qf") > 0) | (F.col("qt") > 0))
    telling = ((F.length("name_norm") > 30) | has_digits(F.col("name_norm"), 2)) & (F.col("qf") != 0) & (F.col("qt") != 0)
    return best.where(sure | telling).select(F.col("id").alias("record_id"), "group_id")


def exact_person(records: DataFrame, index: DataFrame) -> DataFrame:
    """record_id, viaf_id: persons whose long or dated name is a heading, dates not contradicting."""
    hit = exact_heading(records.where("r_type = 'person'"), index).join(with_authority_dates(index), "viaf_id")
    r = records.select(F.col("id").alias("record_id"), "name_norm", "from_date", "from_date_type", "to_date", "to_date_type")
    begin, end = record_quality(F.col("auth_from"), F.col("auth_to"))
    long = (F.length("name_norm") > 30) | has_digits(F.col("name_norm"), 4)
    return hit.join(r, "record_id").where((begin != 0) & (end != 0) & long).select("record_id", "viaf_id")


def exact_corporate(records: DataFrame, groups: DataFrame, index: DataFrame) -> DataFrame:
    """record_id, group_id, viaf_id: bodies by exact group name (20 letters or more, or an authority's dates fit) or heading."""
    bodies = records.where("r_type = 'corporateBody'")
    named = first_by(groups.where("name IS NOT NULL AND g_type = 'corporateBody'").select("id", "name", "viaf_id"), "name").select(F.col("id").alias("group_id"), F.col("name").alias("name_norm"), "viaf_id")
    dates = with_authority_dates(index)
    begin, end = record_quality(F.col("auth_from"), F.col("auth_to"))
    by_name = bodies.join(named, "name_norm").join(dates, "viaf_id", "left").where((F.length("name_norm") >= 20) | (F.col("viaf_id").isNotNull() & (begin != 0) & (end != 0)))
    first = by_name.select(F.col("id").alias("record_id"), "group_id", "viaf_id")
    rest = bodies.join(first.select(F.col("record_id").alias("id")), "id", "left_anti")
    hit = exact_heading(rest, index).join(dates, "viaf_id").join(rest.select(F.col("id").alias("record_id"), "from_date", "from_date_type", "to_date", "to_date_type"), "record_id")
    by_heading = hit.where((begin != 0) & (end != 0)).select("record_id", F.lit(None).cast("bigint").alias("group_id"), "viaf_id")
    return first.unionByName(by_heading)


def told_apart() -> Column:
    """One number for records alike in all that is compared."""
    return F.xxhash64(*[x for c in COMPARED for x in (F.col(c).isNull(), F.col(c))])


def by_kind(records: DataFrame, match: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``match`` finds (record_id, ...), asked once for all records alike in type, name and dates.

    A name borne by a third of all records is searched for as often as it has
    dates.
    """
    keyed = records.withColumn("kind_no", told_apart())
    first = materialize(keyed.groupBy("kind_no").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in COMPARED]), "kinds")
    found = match(first).join(first.select(F.col("id").alias("record_id"), "kind_no"), "record_id").drop("record_id")
    return found.join(keyed.select("kind_no", F.col("id").alias("record_id")), "kind_no").drop("kind_no")


def keyword_person(records: DataFrame, index: DataFrame) -> DataFrame:
    """record_id, viaf_id, quality: persons by keyword candidates."""
    return by_kind(records, lambda r: first_acceptable(r, keyword_candidates(r, index, whole=True), index))


def ngram_person(records: DataFrame, index: DataFrame) -> DataFrame:
    """record_id, viaf_id, quality: persons by n-gram candidates."""
    return by_kind(records, lambda r: first_acceptable(r, ngram_candidates(r, index, whole=True), index))


def first_acceptable(records: DataFrame, candidates: DataFrame, index: DataFrame) -> DataFrame:
    """record_id, viaf_id, quality: for persons the first candidate in rank order that is acceptable.

    A contradiction of dates rules a candidate out; both dates exact and the
    first five letters of its first heading equal to the name's give 1; else its
    first heading with a match quality of ``FUZZY`` or more counts.
    """
    r = records.select(F.col("id").alias("qid"), F.col("name"), "from_date", "from_date_type", "to_date", "to_date_type")
    begin, end = record_quality(F.col("auth_from"), F.col("auth_to"))
    pairs = candidates.select("qid", F.col("did").alias("viaf_id"), "rank").join(r, "qid").join(with_authority_dates(index), "viaf_id").where((begin != 0) & (end != 0))
    pairs = pairs.join(index.select("viaf_id", "pos", "heading"), "viaf_id").withColumn("exact", (begin == 3) & (end == 3))
    starts = F.startswith(F.col("name"), F.substring("heading", 1, 5))
    shortcut = F.coalesce(F.col("exact") & (F.col("pos") == 0) & starts, F.lit(False))
    q = name_match_quality(strip_accents(F.col("heading")), strip_accents(F.col("name")))
    scored = pairs.select("qid", "viaf_id", "rank", F.when(shortcut, -1).otherwise(F.col("pos")).alias("pos"), F.when(shortcut, F.lit(1.0)).otherwise(q).alias("quality")).where(F.col("quality") >= FUZZY)
    best = scored.groupBy("qid").agg(F.min_by(F.struct("viaf_id", "quality"), F.struct("rank", "pos")).alias("m"))
    return best.select(F.col("qid").alias("record_id"), "m.viaf_id", F.round("m.quality", 6).alias("quality"))


def in_database(records: DataFrame, grouped: DataFrame, bound: float = 0.75) -> DataFrame:
    """record_id, other_id, quality: the most similar grouped record of a record's type, by trigrams of the normalised name.

    The similarity exceeds ``bound``, dates do not contradict, and the names
    match by ``FUZZY`` or more: persons by name quality, bodies by Jaro, others
    by their lengths.
    """
    # records alike in all that is compared are one row: a name borne by a third of all records meets as often as it has dates
    usable = lambda df: df.where("name_norm IS NOT NULL AND r_type IS NOT NULL").withColumn("mine", told_apart())
    names = records.select("name_norm").unionByName(grouped.select("name_norm")).where("name_norm IS NOT NULL").distinct()
    near = similar_names(names.select(F.col("name_norm").alias("name")), bound)
    same = names.select(F.col("name_norm").alias("a"), F.col("name_norm").alias("b"), F.lit(1.0).alias("similarity"))
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity")).unionByName(same)
    mine = usable(records).groupBy("mine").agg(*[F.first(c).alias(c) for c in COMPARED])
    # of the grouped ones the two lowest ids stay, as one may be the record itself
    lowest = top_k(usable(grouped).select("mine", "id", *COMPARED), ["mine"], [F.col("id")], 2)
    other = lowest.groupBy("mine").agg(F.collect_list("id").alias("o_ids"), *[F.first(c).alias(f"o_{c}") for c in COMPARED]).drop("mine")
    pairs = mine.join(both, F.col("name_norm") == F.col("a")).join(other, (F.col("b") == F.col("o_name_norm")) & (F.col("r_type") == F.col("o_r_type")))
    begin, end = record_quality(F.col("o_from_date"), F.col("o_to_date"))
    fits = pairs.where((begin != 0) & (end != 0))
    q = F.when(F.col("r_type") == "person", name_match_quality(strip_accents(F.col("o_name")), strip_accents(F.col("name")))).when(F.col("r_type") == "corporateBody", jaro(F.col("o_name_norm"), F.col("name_norm"))).otherwise(1 - relative_length(F.col("o_name_norm"), F.col("name_norm")))
    scored = fits.select("mine", "similarity", F.explode("o_ids").alias("o_id"), q.alias("quality")).where(F.col("quality") >= FUZZY)
    # the two best for each kind of record: where the first is the record itself, the second is its match
    two = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("similarity")).alias("s"), "o_id", "quality"))), 1, 2)
    best = top_k(scored, ["mine"], [F.desc("similarity"), F.col("o_id")], 2).groupBy("mine").agg(two.alias("two"))
    found = usable(records).select("id", "mine").join(best, "mine")
    first = F.filter("two", lambda t: t["o_id"] != F.col("id"))
    return found.where(F.size(first) > 0).select(F.col("id").alias("record_id"), first[0]["o_id"].alias("other_id"), F.round(first[0]["quality"], 6).alias("quality"))


def corporate_key(c: Column) -> Column:
    """A body's name for comparison: letters only, legal forms left out."""
    return strip_corporate_abbreviations(strip_accents(letters_key(c)))


def corporate_keyword(records: DataFrame, index: DataFrame, whole: bool = False) -> DataFrame:
    """record_id, viaf_id, quality: bodies by keyword candidates, first heading whose Jaro similarity is ``FUZZY`` or more."""
    bodies = records.where("r_type = 'corporateBody'")
    key = corporate_key(F.col("name_norm"))
    if whole:
        return by_kind(bodies, lambda b: _first_heading(b, keyword_candidates(b, index, query=key, whole=True), index, key))
    return _first_heading(bodies, keyword_candidates(bodies, index, query=key), index, key)


def _first_heading(bodies: DataFrame, found: DataFrame, index: DataFrame, key: Column) -> DataFrame:
    pairs = found.select("qid", F.col("did").alias("viaf_id"), "rank").join(bodies.select(F.col("id").alias("qid"), key.alias("q")), "qid").join(index.select("viaf_id", "pos", "heading"), "viaf_id")
    scored = pairs.select("qid", "viaf_id", "rank", "pos", jaro(F.col("q"), corporate_key(F.col("heading"))).alias("quality")).where(F.col("quality") >= FUZZY)
    best = scored.groupBy("qid").agg(F.min_by(F.struct("viaf_id", "quality"), F.struct("rank", "pos")).alias("m"))
    return best.select(F.col("qid").alias("record_id"), "m.viaf_id", F.round("m.quality", 6).alias("quality"))


def identifier_match(records: DataFrame, identifiers: DataFrame, authority_ids: DataFrame) -> DataFrame:
    """record_id, viaf_id: records with an outside identifier (record_id, href) that an authority carries (nsid, viaf_id)."""
    nsid = F.regexp_extract(F.regexp_replace("href", "/PUBLIC$", ""), r"([^/]+)$", 1)
    ids = authority_ids.groupBy("nsid").agg(F.min("viaf_id").alias("viaf_id"))
    hits = identifiers.select("record_id", nsid.alias("nsid")).join(ids, "nsid").groupBy("record_id").agg(F.min("viaf_id").alias("viaf_id"))
    return hits.join(records.select(F.col("id").alias("record_id")), "record_id", "left_semi")


def cascade(records: DataFrame, groups: DataFrame, members: DataFrame, merged: DataFrame, clusters: DataFrame, identifiers: DataFrame | None = None) -> DataFrame:
    """record_id, stage, decision (accept, maybe, new), group_id, viaf_id, quality for every record.

    First, for all types, the authority that carries a record's outside
    identifier (``identifiers``: record_id, href; of records whose collection
    states such).  Persons: group by name, heading, keywords, then n-grams where
    keywords gave no sure match.  Bodies: group or heading, then keywords.
    Families stay in their group or begin one of their own.  What a stage found
    is written once, so that the next stage's residual is one anti-join and no
    stage is computed again.
    """
    index = materialize(headings(clusters), "cascade-index")
    none_long, none_text, sure = F.lit(None).cast("bigint"), F.lit(None).cast("string"), F.lit(1.0)
    records = records.select("id", "r_type", "name", "name_norm", "from_date", "from_date_type", "to_date", "to_date_type", "record_group_id")
    left = lambda df, found: df.join(found.select(F.col("record_id").alias("id")), "id", "left_anti")
    rows: list[DataFrame] = []

    def add(df: DataFrame, stage: str, decision: Column, group: Column, viaf: Column, q: Column) -> None:
        rows.append(df.select("record_id", F.lit(stage).alias("stage"), decision.alias("decision"), group.alias("group_id"), viaf.alias("viaf_id"), q.alias("quality")))

    if identifiers is not None:
        codes = clusters.where("viaf_id IS NOT NULL").select(F.explode("sources").alias("code"), "viaf_id").select(F.substring_index("code", "|", -1).alias("nsid"), "viaf_id")
        stated = materialize(identifier_match(records, identifiers, codes), "cascade-identifier")
        add(stated, "identifier", F.lit("accept"), none_long, F.col("viaf_id"), sure)
        records = left(records, stated)
    persons = records.where("r_type = 'person'")
    grouped = materialize(in_group(persons, groups, members, merged), "cascade-group")
    add(grouped, "group", F.lit("accept"), F.col("group_id"), none_text, sure)
    persons = left(persons, grouped)
    exact = materialize(exact_person(persons, index), "cascade-heading")
    add(exact, "heading", F.lit("accept"), none_long, F.col("viaf_id"), sure)
    persons = left(persons, exact)
    by_word = materialize(keyword_person(persons, index).where(F.col("quality") > PERSON_ACCEPT), "cascade-keyword")
    add(by_word, "keyword", F.lit("accept"), none_long, F.col("viaf_id"), F.col("quality"))
    persons = left(persons, by_word)
    by_gram = materialize(ngram_person(persons, index), "cascade-ngram")
    add(by_gram, "ngram", F.when(F.col("quality") > PERSON_ACCEPT, "accept").otherwise("maybe"), none_long, F.col("viaf_id"), F.col("quality"))
    rest = left(persons, by_gram).select(F.col("id").alias("record_id"))
    add(rest, "none", F.lit("new"), none_long, none_text, F.lit(None).cast("double"))

    bodies = records.where("r_type = 'corporateBody'")
    exact_body = materialize(exact_corporate(bodies, groups, index), "cascade-body")
    add(exact_body, "exact", F.lit("accept"), F.col("group_id"), F.col("viaf_id"), sure)
    bodies = left(bodies, exact_body)
    worded = materialize(corporate_keyword(bodies, index, whole=True), "cascade-word")
    add(worded, "keyword", F.when(F.col("quality") >= CORPORATE_ACCEPT, "accept").otherwise("maybe"), none_long, F.col("viaf_id"), F.col("quality"))
    add(left(bodies, worded).select(F.col("id").alias("record_id")), "none", F.lit("new"), none_long, none_text, F.lit(None).cast("double"))

    families = records.where("r_type = 'family'").select(F.col("id").alias("record_id"), "record_group_id")
    own = F.col("record_group_id").isNotNull()
    add(families, "family", F.when(own, "accept").otherwise("new"), F.col("record_group_id"), none_text, F.when(own, sure))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
