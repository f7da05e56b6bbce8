"""Look-ups, filters and joins over the entity tables.

Every function takes and returns DataFrames and adds no Python to the plan.
Where the order of rows or the choice among several matters, ties go to the
lowest id.  NULL never equals anything; empty inputs give empty results.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def page(df: DataFrame, order: list, limit: int | None = None, offset: int | None = None) -> DataFrame:
    """Ordered rows from ``offset``, at most ``limit`` of them (the feature is the page)."""
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out.limit(limit) if limit is not None else out


def unprocessed(records: DataFrame, collection: str | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """Records not processed yet, by collection and range of ids."""
    out = records.where(~F.coalesce("processed", F.lit(False)))
    if collection is not None:
        out = out.where(F.col("collection_id") == collection)
    if start is not None:
        out = out.where(F.col("id") >= start)
    return out.where(F.col("id") <= end) if end is not None else out


def starting_with(df: DataFrame, start: int) -> DataFrame:
    """Rows from an id on."""
    return df.where(F.col("id") >= start)


def in_given_order(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` for the ids of ``ids`` (pos, id), with their position; repeated ids repeat the row."""
    return ids.join(df, "id")


def first_by(df: DataFrame, *keys: str) -> DataFrame:
    """For each key the row of the lowest id: one partial aggregation, no sort."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col("id")).alias("row"))
    return best.select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])


def by_key(df: DataFrame, key: str, value: str, valid_only: bool = False) -> DataFrame:
    """Point look-up; ``valid_only`` leaves out invalid rows."""
    out = df.where(F.col(key) == value)
    return out.where("valid") if valid_only else out


def of_type(groups: DataFrame, kind: str, with_authority: bool = False, start: int | None = None, end: int | None = None) -> DataFrame:
    """Groups of one type, optionally only those with an authority id, in a range of ids."""
    out = groups.where(F.col("g_type") == kind)
    if with_authority:
        out = out.where("viaf_id IS NOT NULL")
    if start is not None:
        out = out.where(F.col("id") >= start)
    return out.where(F.col("id") <= end) if end is not None else out


def without_canonical_id(merged: DataFrame) -> DataFrame:
    """Merged records that have no identifier yet."""
    return merged.where("canonical_id IS NULL")


def assigned(merged: DataFrame, start: int, end: int | None = None, again: bool = False) -> DataFrame:
    """Merged records with an identifier from an id on; only unprocessed ones unless ``again``."""
    out = merged.where((F.col("id") >= start) & F.col("canonical_id").isNotNull())
    if end is not None:
        out = out.where(F.col("id") <= end)
    return out if again else out.where("processed = false")


def collections(records: DataFrame) -> DataFrame:
    """Distinct collections."""
    return records.select("collection_id").distinct()


def malformed_name(name_column: str = "name"):  # noqa: ANN201
    """Condition: 30 or more characters, with two semicolons in the first line."""
    c = F.col(name_column)
    return (F.length(c) >= 30) & c.rlike(r"^[^\n]*;[^\n]*;")


def overlong_name(name_column: str = "name"):  # noqa: ANN201
    """Condition: 300 or more characters, or 200 and more with over 8 commas or over 5 semicolons."""
    c = F.col(name_column)
    count = lambda ch: F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))
    return (F.length(c) >= 300) | ((F.length(c) >= 200) & ((count(",") > 8) | (count(";") > 5)))


def loadable(records: DataFrame, strict_collections: list[str]) -> DataFrame:
    """Records whose names are no lists or descriptions: the malformed test in strict collections, the length test elsewhere."""
    strict = F.coalesce(F.col("collection_id").isin(strict_collections), F.lit(False))
    bad = F.when(strict & malformed_name(), True).otherwise(overlong_name())
    return records.where(~F.coalesce(bad, F.lit(False)))


def numeric_term(c):  # noqa: ANN001, ANN201
    """Condition: a term of digits, blanks and hyphens only."""
    return c.rlike(r"^[0-9 -]+$")


def groups_without_merge(groups: DataFrame, merged: DataFrame, kind: str | None = None) -> DataFrame:
    """Groups that have no merged record; groups marked invalid are left out."""
    out = groups.where("coalesce(g_type, '') <> 'invalid'")
    if kind is not None:
        out = out.where(F.col("g_type") == kind)
    return out.join(merged.select(F.col("record_group_id").alias("id")), "id", "left_anti")


def merged_by_authority(merged: DataFrame, groups: DataFrame) -> DataFrame:
    """Merged records with their group's authority id."""
    return merged.join(groups.where("viaf_id IS NOT NULL").select(F.col("id").alias("record_group_id"), "viaf_id"), "record_group_id")


def changed_since(merged: DataFrame, records: DataFrame, since: datetime | str) -> DataFrame:
    """Merged records of groups that got a record after a moment (a semi-join: no row twice), in order of id."""
    recent = records.where(F.col("record_group_id").isNotNull() & (F.col("created_at") > F.lit(since).cast("timestamp"))).select("record_group_id")
    return merged.join(recent, "record_group_id", "left_semi").orderBy("id")


def of_collections(merged: DataFrame, records: DataFrame, names: list[str]) -> DataFrame:
    """Merged records of groups with a record of one of the collections."""
    wanted = records.where(F.col("record_group_id").isNotNull() & F.col("collection_id").isin(names)).select("record_group_id")
    return merged.join(wanted, "record_group_id", "left_semi")


def same_name_group(records: DataFrame, groups: DataFrame) -> DataFrame:
    """record_id, group_id: the group of a record's type and exact normalised name, lowest id first."""
    named = first_by(groups.where("name IS NOT NULL").select("id", "g_type", "name"), "g_type", "name").withColumnRenamed("id", "group_id")
    keys = records.select(F.col("id").alias("record_id"), F.col("r_type").alias("g_type"), F.col("name_norm").alias("name"))
    return keys.join(named, ["g_type", "name"]).select("record_id", "group_id")


def by_source_code(groups: DataFrame, clusters: DataFrame, codes: DataFrame) -> DataFrame:
    """id, viaf_id: for groups with source codes (id, pos, source) the cluster of the first code that any cluster has."""
    known = clusters.select(F.explode("sources").alias("source"), "viaf_id").groupBy("source").agg(F.min("viaf_id").alias("viaf_id"))
    hits = codes.join(known, "source").groupBy("id").agg(F.min_by("viaf_id", "pos").alias("viaf_id"))
    return groups.select("id").join(hits, "id")


def relation_targets(relations: DataFrame, records: DataFrame, merged: DataFrame) -> DataFrame:
    """Outcome of each relation (record_id, relation_no, source_id): canonical id, or why there is none.

    A chain of equi-joins: source id to record (lowest id), its group, the group's
    valid merged record of the lowest id.
    """
    one = records.where("source_id IS NOT NULL").groupBy("source_id").agg(F.min_by(F.struct("id", "record_group_id"), "id").alias("o")).select("source_id", F.col("o.id").alias("target_record"), F.col("o.record_group_id").alias("target_group"))
    valid = merged.where("record_group_id IS NOT NULL").groupBy(F.col("record_group_id").alias("target_group")).agg(F.min_by(F.struct("canonical_id"), F.when(F.col("valid"), F.col("id"))).alias("m"))
    valid = valid.select("target_group", F.col("m.canonical_id").alias("canonical_id"), F.col("m").isNotNull().alias("has_merge"))
    out = relations.join(one, "source_id", "left").join(valid, "target_group", "left")
    outcome = (
        F.when(F.col("target_record").isNull(), "unknown record")
        .when(F.col("target_group").isNull(), "no group")
        .when(F.col("has_merge").isNull(), "no merged record")
        .when(~F.col("has_merge"), "no valid record")
        .when(F.col("canonical_id").isNull(), "no identifier")
        .otherwise("resolved")
    )
    rest = [c for c in relations.columns if c not in ("record_id", "relation_no", "source_id", "canonical_id", "outcome")]
    return out.select("record_id", "relation_no", "source_id", *rest, "canonical_id", outcome.alias("outcome"))


def maybe_edges(merged: DataFrame, groups: DataFrame, maybes: DataFrame) -> DataFrame:
    """id, other_id, direction: merged records that may be the same as others of their type, both ways.

    Forward: a group's candidate, by authority id or by group id; reverse: the
    candidates that name a group's authority id.  A bag: repeated candidates repeat the edge.
    """
    first = merged.where("record_group_id IS NOT NULL").groupBy("record_group_id").agg(F.min_by(F.struct("id", "r_type"), "id").alias("m")).select("record_group_id", F.col("m.id").alias("mid"), F.col("m.r_type").alias("mtype"))
    by_viaf = first.join(groups.where("viaf_id IS NOT NULL").select(F.col("id").alias("record_group_id"), "viaf_id"), "record_group_id")
    me = merged.where("record_group_id IS NOT NULL").select("id", "r_type", "record_group_id")
    mine = me.join(maybes.select("record_group_id", "candidate_type", "candidate_id"), "record_group_id")
    via = mine.where("candidate_type = 'viaf'").join(by_viaf.select(F.col("viaf_id").alias("candidate_id"), "mid", "mtype"), "candidate_id")
    pg = mine.where("candidate_type = 'postgres'").withColumn("gid", F.expr("try_cast(candidate_id AS bigint)")).join(first.select(F.col("record_group_id").alias("gid"), "mid", "mtype"), "gid")
    forward = via.select("id", "r_type", "mid", "mtype").unionByName(pg.select("id", "r_type", "mid", "mtype")).withColumn("direction", F.lit("forward"))
    own = me.join(groups.where("viaf_id IS NOT NULL").select(F.col("id").alias("record_group_id"), "viaf_id"), "record_group_id")
    named = maybes.select(F.col("candidate_id").alias("viaf_id"), F.col("record_group_id").alias("cg")).join(first.select(F.col("record_group_id").alias("cg"), "mid", "mtype"), "cg")
    back = own.join(named, "viaf_id").where("mid <> id").select("id", "r_type", "mid", "mtype").withColumn("direction", F.lit("reverse"))
    return forward.unionByName(back).where("mtype = r_type").select("id", F.col("mid").alias("other_id"), "direction")


def lineage(merged: DataFrame) -> DataFrame:
    """Invalidated merged records beside the records that invalidate them."""
    new = merged.where("invalidates_record_id IS NOT NULL").select(F.col("invalidates_record_id").alias("id"), F.col("id").alias("by_id"), F.col("canonical_id").alias("by_canonical_id"))
    return merged.select("id", "canonical_id", "valid").join(new, "id")


def previous_records(groups: DataFrame, removed: DataFrame, records: DataFrame) -> DataFrame:
    """Records that once belonged to a group."""
    bridge = removed.select(F.col("record_group_id").alias("group_id"), F.col("original_record_id").alias("id"))
    return bridge.join(groups.select(F.col("id").alias("group_id")), "group_id", "left_semi").join(records, "id")


def top_k(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each key (a feature: ranked results)."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
