"""Splits, absorptions, tombstones and the refresh of authority ids.

All functions return the new rows or the remapped ids; nothing is updated in
place, so a step can be run again with the same result.

Edge cases: ids that do not exist are left out; NULL groups take no part; a
group whose authority vanished without a replacement keeps what it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split(merged: DataFrame, records: DataFrame, assignment: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split merged records by ``assignment`` (merged_id, part, record_id).

    Gives the new groups (merged_id, part, name: of the lowest record id), the
    records' moves (record_id, from_group, merged_id, part: the lineage rows)
    and the old records, now invalid.
    """
    m = merged.select(F.col("id").alias("merged_id"), F.col("record_group_id").alias("from_group"))
    moves = assignment.join(m, "merged_id").join(records.select(F.col("id").alias("record_id"), "name_norm", "r_type"), "record_id")
    new = moves.groupBy("merged_id", "part").agg(F.min_by("name_norm", "record_id").alias("name"), F.min_by("r_type", "record_id").alias("g_type"), F.count("*").alias("n_records"))
    old = merged.join(assignment.select(F.col("merged_id").alias("id")), "id", "left_semi").withColumn("valid", F.lit(False))
    return new, moves.select("record_id", "from_group", "merged_id", "part"), old


def absorb(merged: DataFrame, records: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Let merged records take over others: ``pairs`` has id and target_id.

    Gives the records' moves (record_id, from_group, to_group) and the lineage
    (id, invalidates_record_id); targets without a group are left out.
    """
    own = merged.select("id", F.col("record_group_id").alias("to_group"))
    gone = merged.where("record_group_id IS NOT NULL").select(F.col("id").alias("target_id"), F.col("record_group_id").alias("from_group"))
    both = pairs.join(own, "id").join(gone, "target_id")
    moves = records.select(F.col("id").alias("record_id"), F.col("record_group_id").alias("from_group")).join(both.select("from_group", "to_group"), "from_group")
    return moves.select("record_id", "from_group", "to_group"), both.select("id", F.col("target_id").alias("invalidates_record_id"))


def tombstones(merged: DataFrame) -> DataFrame:
    """id, canonical_id, r_type, relation, other_id: cancelled records and what became of them.

    ``MergedInto`` one record that invalidates it, ``SplitInto`` each of several;
    ``Cancelled`` where there is none.
    """
    dead = merged.where("NOT valid").select("id", "canonical_id", "r_type")
    by = merged.where("invalidates_record_id IS NOT NULL").select(F.col("invalidates_record_id").alias("id"), F.col("canonical_id").alias("other_id"))
    n = by.groupBy("id").agg(F.count("*").alias("n"))
    out = dead.join(n, "id", "left").join(by, "id", "left")
    return out.select("id", "canonical_id", "r_type", F.when(F.col("n") == 1, "MergedInto").when(F.col("n") > 1, "SplitInto").otherwise("Cancelled").alias("relation"), "other_id")


def origins(merged: DataFrame) -> DataFrame:
    """id, relation, other_id: what a valid record came from (``MergedFrom`` or ``SplitFrom``)."""
    n = merged.where("invalidates_record_id IS NOT NULL").groupBy("invalidates_record_id").agg(F.count("*").alias("n"))
    old = merged.select(F.col("id").alias("invalidates_record_id"), F.col("canonical_id").alias("other_id"))
    me = merged.where("invalidates_record_id IS NOT NULL").select("id", "invalidates_record_id")
    return me.join(n, "invalidates_record_id").join(old, "invalidates_record_id").select("id", F.when(F.col("n") == 1, "MergedFrom").otherwise("SplitFrom").alias("relation"), "other_id")


def refresh(groups: DataFrame, group_sources: DataFrame, clusters: DataFrame) -> DataFrame:
    """id, action, viaf_id, into_group: what the present authority says of each group that has an authority id.

    ``keep`` if the id exists; else the first source code (``group_sources``: id,
    pos, source) that any cluster carries gives a replacement: ``repoint``, or
    ``merge`` into the group that already has it; ``lost`` if there is none.
    """
    live = clusters.select("viaf_id").where("viaf_id IS NOT NULL").distinct()
    have = groups.where("viaf_id IS NOT NULL AND coalesce(g_type, '') <> 'invalid'").select("id", F.col("viaf_id").alias("old"))
    kept = have.join(live, have["old"] == live["viaf_id"], "left_semi")
    gone = have.join(live, have["old"] == live["viaf_id"], "left_anti")
    by_code = clusters.select(F.explode("sources").alias("source"), "viaf_id").groupBy("source").agg(F.min("viaf_id").alias("new"))
    found = group_sources.join(gone.select("id"), "id", "left_semi").join(by_code, "source").groupBy("id").agg(F.min_by("new", "pos").alias("new"))
    holder = have.groupBy(F.col("old").alias("new")).agg(F.min("id").alias("holder"))
    moved = gone.join(found, "id", "left").join(holder, "new", "left")
    action = F.when(F.col("new").isNull(), "lost").when(F.col("holder").isNotNull(), "merge").otherwise("repoint")
    return kept.select("id", F.lit("keep").alias("action"), F.col("old").alias("viaf_id"), F.lit(None).cast("bigint").alias("into_group")).unionByName(moved.select("id", action.alias("action"), F.col("new").alias("viaf_id"), F.col("holder").alias("into_group")))


def remapped(df: DataFrame, refreshed: DataFrame, column: str = "record_group_id") -> DataFrame:
    """Records or candidates with the groups that a refresh merged replaced by their targets."""
    m = refreshed.where("action = 'merge'").select(F.col("id").alias(column), "into_group")
    return df.join(m, column, "left").withColumn(column, F.coalesce("into_group", column)).drop("into_group").select(*df.columns)


def replaced_texts(groups: DataFrame, current: DataFrame) -> DataFrame:
    """id: groups whose stored authority text differs from the present one (viaf_id, viaf_record)."""
    now = current.select("viaf_id", F.col("viaf_record").alias("now"))
    return groups.where("viaf_id IS NOT NULL").join(now, "viaf_id").where("NOT viaf_record <=> now").select("id")
