"""Fusion of a group's records into one merged record, field by field.

Each field is one aggregation over exploded rows keyed by the entity; the
fields meet in one join at the end.  "First" always means the lowest (record
id, position).  A group of any size is safe: what is gathered is the distinct
result of a field, never the group's rows.

Edge cases: NULL terms are left out; groups without a field lack its row (NULL
in the combined record); repeated values count in frequencies and once in sets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmark.functions.dates import pad_date
from kinmark.functions.identifiers import is_country_code
from kinmark.functions.normalize import entry_key
from kinmark.operators.lookup import numeric_term

AUTHORIZED, ALTERNATIVE = "authorized_form", "alternative_form"
# Sources whose authorised forms are kept by name, and scores of the preferred ones.
KEPT_SOURCES = ["lc", "lac", "nla", "oac"]
PREFERRED = [("LC", 99), ("LAC", 98), ("NLA", 97)]


def frequency(rows: DataFrame, entity: str, term: str) -> DataFrame:
    """entity, term, n: how often each term occurs."""
    return rows.where(F.col(term).isNotNull()).groupBy(entity, term).agg(F.count("*").alias("n"))


def subjects(rows: DataFrame, entity: str, term: str) -> DataFrame:
    """Frequencies of subject terms, those of digits only left out."""
    return frequency(rows.where(~numeric_term(F.col(term))), entity, term)


def distinct_values(rows: DataFrame, entity: str, value: str) -> DataFrame:
    """entity, values: sorted distinct values."""
    return rows.groupBy(entity).agg(F.sort_array(F.collect_set(value)).alias("values"))


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in order."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return best.select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])


def untyped_preferred(rows: DataFrame, keys: list[str], type_column: str, order: list[str]) -> DataFrame:
    """One row per key: the first without a type if there is one, else the first."""
    typed = F.col(type_column).isNotNull()
    return first_wins(rows.withColumn("_typed", typed), keys, ["_typed", *order]).drop("_typed")


def grouped_citations(rows: DataFrame, entity: str, text: str, citation: str, order: list[str]) -> DataFrame:
    """entity, text, citations: citations of identical texts in order."""
    items = rows.where(F.col(citation).isNotNull()).groupBy(entity, text).agg(F.sort_array(F.collect_list(F.struct(*order, citation))).alias("c"))
    return items.select(entity, text, F.transform("c", lambda x: x[citation]).alias("citations"))


def merged_names(entries: DataFrame, entity: str) -> DataFrame:
    """entity, name_key, source, n_type, name_origin, name, lang, script_code, use_dates: name entries merged by their key.

    ``entries`` has name, source, n_type, origin (viaf_auth, viaf_alts, cpf),
    ord (position), lang, script_code, use_dates.  Authority forms come before
    variants and these before record forms; the first name, language, script
    and dates stay; sources are united, and an alternative one becomes
    authorised (with its origin) as soon as any entry authorises it.
    """
    rank = F.when(F.col("origin") == "viaf_auth", 0).when(F.col("origin") == "viaf_alts", 1).otherwise(2)
    e = entries.where("name IS NOT NULL").withColumn("name_key", entry_key(F.col("name"))).withColumn("pos", F.struct(rank.alias("r"), F.col("ord").alias("o")))
    head = e.groupBy(entity, "name_key").agg(F.min_by(F.struct("name", "lang", "script_code", "use_dates"), "pos").alias("h"))
    first = F.min_by(F.struct("n_type", "origin"), F.col("pos"))
    sure = F.min_by(F.struct("n_type", "origin"), F.when(F.col("n_type") == AUTHORIZED, F.col("pos")))
    s = e.where("source IS NOT NULL").groupBy(entity, "name_key", "source").agg(first.alias("f"), sure.alias("a"))
    upgraded = F.when((F.col("f.n_type") == ALTERNATIVE) & F.col("a").isNotNull(), F.col("a")).otherwise(F.col("f"))
    s = s.select(entity, "name_key", "source", upgraded.alias("t"))
    out = head.join(s, [entity, "name_key"], "left")
    return out.select(entity, "name_key", "source", F.col("t.n_type").alias("n_type"), F.col("t.origin").alias("name_origin"), "h.name", "h.lang", "h.script_code", "h.use_dates")


def name_scores(names: DataFrame, entity: str) -> DataFrame:
    """entity, name_key, score: preference of each merged name (99, 98, 97 for preferred sources, else authorised sources)."""
    ok = F.coalesce(F.col("n_type") == AUTHORIZED, F.lit(False))
    has = lambda code: F.max(F.when(F.col("source") == code, ok))
    flags = [F.coalesce(has(code), has(code.lower()), F.lit(False)).alias(code) for code, _ in PREFERRED]
    g = names.groupBy(entity, "name_key").agg(*flags, F.count_if(ok).alias("n"))
    score = reduce(lambda acc, p: F.when(F.col(p[0]), p[1]).otherwise(acc), reversed(PREFERRED), F.col("n"))
    return g.select(entity, "name_key", score.cast("int").alias("score"))


def array_score(sources: Column) -> Column:
    """The same score of a column of source structs."""
    ok = F.filter(sources, lambda s: s["n_type"] == AUTHORIZED)
    has = lambda arr, code: F.exists(arr, lambda s: s["source"] == code)
    flag = lambda code: F.when(has(sources, code), has(ok, code)).otherwise(has(ok, code.lower()))
    count = F.size(F.array_distinct(F.transform(ok, lambda s: s["source"])))
    out = reduce(lambda acc, p: F.when(flag(p[0]), p[1]).otherwise(acc), reversed(PREFERRED), count)
    return F.coalesce(F.when(sources.isNotNull(), out), F.lit(0)).cast("int")


def printed_sources(names: DataFrame, entity: str) -> DataFrame:
    """entity, name_key, form, label: the source lines of a merged name.

    Authorised forms keep their label if it is a kept source or comes from a
    record; all others together print one ``VIAF``; an alternative ``VIAF`` is
    not printed beside an authorised one.
    """
    ok = F.coalesce(F.col("n_type") == AUTHORIZED, F.lit(False))
    kept = F.lower("source").isin(KEPT_SOURCES) | (F.col("name_origin") == "cpf")
    rows = names.where("source IS NOT NULL").select(entity, "name_key", F.when(ok, "authorizedForm").otherwise("alternativeForm").alias("form"), F.when(ok & ~F.coalesce(kept, F.lit(False)), "VIAF").otherwise(F.col("source")).alias("label"), (ok & ~F.coalesce(kept, F.lit(False))).alias("folded"))
    flagged = rows.groupBy(entity, "name_key").agg(F.max("folded").alias("has"))
    out = rows.join(flagged, [entity, "name_key"]).where("NOT (form = 'alternativeForm' AND label = 'VIAF' AND has)")
    return out.select(entity, "name_key", "form", "label").distinct()


def exist_dates(groups: DataFrame, authority: DataFrame, records: DataFrame) -> DataFrame:
    """group_id, origin, from_text, from_type, to_text, to_type: the authority's dates if it states any, else the first record's.

    The end's type is ``Death`` for every entity whose dates come from the authority.
    """
    known = lambda c: F.when(F.col(c) != "0", F.col(c))
    a = groups.select(F.col("id").alias("group_id"), "g_type", "viaf_id").join(authority.select("viaf_id", known("birth").alias("birth"), known("death").alias("death")), "viaf_id", "left")
    r = records.where("record_group_id IS NOT NULL AND (from_date IS NOT NULL OR to_date IS NOT NULL)").groupBy(F.col("record_group_id").alias("group_id")).agg(F.min_by(F.struct("from_date", "from_date_type", "to_date", "to_date_type"), "id").alias("r"))
    short = lambda c: F.substring_index(c, "#", -1)
    stated = F.col("birth").isNotNull() | F.col("death").isNotNull()
    both = a.join(r, "group_id", "left").where(stated | F.col("r").isNotNull())
    start = F.when(F.col("birth").isNotNull(), F.when(F.col("g_type") == "person", "Birth").otherwise("Active"))
    return both.select(
        "group_id",
        F.when(stated, "authority").otherwise("record").alias("origin"),
        F.when(stated, pad_date(F.col("birth"))).otherwise(F.col("r.from_date").cast("string")).alias("from_text"),
        F.when(stated, start).otherwise(short("r.from_date_type")).alias("from_type"),
        F.when(stated, pad_date(F.col("death"))).otherwise(F.col("r.to_date").cast("string")).alias("to_text"),
        F.when(stated, F.when(F.col("death").isNotNull(), "Death")).otherwise(short("r.to_date_type")).alias("to_type"),
    )


def languages(authority: DataFrame, used: DataFrame, entity: str) -> DataFrame:
    """entity, code, origin: the authority's languages, then those of the records that are not among them, first wins."""
    a = authority.select(entity, F.explode("languages").alias("code")).where("code IS NOT NULL").distinct()
    r = first_wins(used.where("code IS NOT NULL").select(entity, F.trim("code").alias("code"), "record_id", "child_no"), [entity, "code"], ["record_id", "child_no"]).select(entity, "code")
    return a.select(entity, "code", F.lit("authority").alias("origin")).unionByName(r.join(a, [entity, "code"], "left_anti").withColumn("origin", F.lit("record")))


def nationality_form(c: Column) -> Column:
    """How a nationality is given: by country code or by term."""
    return F.when(is_country_code(c), "countryCode").otherwise("term")


def relations(rows: DataFrame, entity: str) -> DataFrame:
    """Relations of an entity, once for each role and target over the whole entity; those without a target all stay."""
    targeted = first_wins(rows.where("href IS NOT NULL AND arcrole IS NOT NULL"), [entity, "arcrole", "href"], ["record_id", "relation_no"])
    return targeted.unionByName(rows.where("href IS NULL OR arcrole IS NULL"), allowMissingColumns=True)


def resolved_relations(rows: DataFrame, records: DataFrame, merged: DataFrame, entity: str) -> DataFrame:
    """``relations`` after those that name a record (source_id) point to its merged record's identifier.

    A relation to a record without group or merged record is left out; one to an
    unknown record, or to merged records of which none is valid, stays as it
    was; one to a merged record without identifier gets an empty target.  Of an
    entity's relations to one identifier the first stays, whatever its role.
    """
    from kinmark.operators.lookup import relation_targets

    named = relation_targets(rows.where("source_id IS NOT NULL"), records, merged)
    known = named.where(F.col("outcome").isin("resolved", "no identifier")).withColumn("href", F.coalesce("canonical_id", F.lit("")))
    once = first_wins(known, [entity, "href"], ["record_id", "relation_no"])
    asis = named.where(F.col("outcome").isin("unknown record", "no valid record"))
    own = relations(rows.where("source_id IS NULL"), entity)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [own, asis.drop("canonical_id", "outcome"), once.drop("canonical_id", "outcome")])


def same_as(groups: DataFrame, clusters: DataFrame, hosts: dict[str, str]) -> DataFrame:
    """group_id, href: outside addresses of a group's authority and its headings; ``hosts`` gives the address by kind."""
    g = groups.where("g_type IN ('person', 'corporateBody')").select(F.col("id").alias("group_id"), "viaf_id").join(clusters.select("viaf_id", "headings", "heading_ids"), "viaf_id")
    own = g.where("size(headings) > 0").select("group_id", F.concat(F.lit(hosts["viaf"]), "viaf_id").alias("href"))
    ids = g.select("group_id", F.explode("heading_ids").alias("h")).select("group_id", "h.*")
    add = lambda col, kind: ids.where(F.col(col).isNotNull()).select("group_id", F.concat(F.lit(hosts[kind]), col).alias("href"))
    return reduce(DataFrame.unionByName, [own, add("lccn_wcid", "worldcat"), add("lccn_lcid", "loc"), add("url_id", "wiki")])


def new_merged(groups: DataFrame, merged: DataFrame) -> DataFrame:
    """record_group_id, name, r_type, valid: a merged record for every group that has none; invalid groups get none."""
    rest = groups.where("coalesce(g_type, '') <> 'invalid'").join(merged.select(F.col("record_group_id").alias("id")), "id", "left_anti")
    return rest.select(F.col("id").alias("record_group_id"), "name", F.col("g_type").alias("r_type"), F.lit(True).alias("valid"))


def numbered(df: DataFrame, order: str, label: str) -> DataFrame:
    """``df`` with n = 1, 2, ... in the order of a column, without one global sort task.

    Rows are range-partitioned, numbered inside each partition and shifted by the
    sizes of the partitions before: only one number per partition is gathered.
    """
    from kinmark.session import materialize

    parts = materialize(df.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id()), label)
    sizes = {r["_p"]: r["k"] for r in parts.groupBy("_p").agg(F.count("*").alias("k")).collect()}
    shift, total = {}, 0
    for p in sorted(sizes):
        shift[p] = total
        total += sizes[p]
    if not shift:
        return df.withColumn("n", F.lit(0).cast("bigint"))
    from pyspark.sql import Window

    base = F.create_map(*[F.lit(x) for kv in shift.items() for x in kv])
    return parts.withColumn("n", F.row_number().over(Window.partitionBy("_p").orderBy(order)) + base[F.col("_p")]).drop("_p")


def assign_identifiers(merged: DataFrame, stock: DataFrame) -> DataFrame:
    """id, canonical_id: unused identifiers of ``stock`` (canonical_id), in order, for merged records that have none, in order of id."""
    need = numbered(merged.where("canonical_id IS NULL").select("id"), "id", "ids-need")
    unused = stock.select("canonical_id").distinct().join(merged.where("canonical_id IS NOT NULL").select("canonical_id"), "canonical_id", "left_anti")
    return need.join(numbered(unused, "canonical_id", "ids-stock"), "n").select("id", "canonical_id")


def source_block(sources: DataFrame, groups: DataFrame, entity: str = "group_id") -> DataFrame:
    """entity, source: sources of all records; the authority is added only where there are any."""
    own = sources.where("source IS NOT NULL").select(entity, "source")
    have = own.select(entity).distinct()
    viaf = groups.where("viaf_id IS NOT NULL").select(F.col("id").alias(entity), F.concat(F.lit("viaf:"), "viaf_id").alias("source")).join(have, entity, "left_semi")
    return own.unionByName(viaf)
