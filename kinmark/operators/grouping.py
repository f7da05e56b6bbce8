"""Groups from match decisions, without a sequential scan.

A record goes to the group it was accepted into, or to the group that has the
authority it was accepted for; else records accepted for one authority begin a
group together, and of the rest those that share a name by which a new group
would be found again.  All of this is decided by equal keys, so the groups are
one aggregation; a group is named by its first record.

Edge cases: a record without name or authority stays alone; repeated rows fall
into one group; several groups with one authority count as the one of the
lowest id; an empty table gives no groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmark.functions.normalize import has_digits
from kinmark.session import materialize


def connected_components(edges: DataFrame, label: str, rounds: int = 30) -> DataFrame:
    """id, component (the least id): components of the undirected edges (a, b: bigint)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, f"{label}-edges")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("c")), f"{label}-labels")
    for n in range(rounds):
        near = both.join(labels.select(F.col("a").alias("b"), F.col("c").alias("cb")), "b").groupBy("a").agg(F.min("cb").alias("m"))
        jump = labels.select(F.col("a").alias("c"), F.col("c").alias("cc"))
        new = labels.join(near, "a").join(jump, "c", "left").select("a", F.least("c", "m", F.coalesce("cc", "c")).alias("c"), F.col("c").alias("old"))
        new = materialize(new, f"{label}-labels{n}")
        labels = new.select("a", "c")
        if not new.where("c <> old").limit(1).count():
            break
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return labels.select(F.col("a").alias("id"), F.col("c").alias("component"))


def name_joins(kind: str = "r_type", name: str = "name_norm"):  # noqa: ANN201
    """Condition: records of one such name (and equal years) are one group without any authority.

    Bodies' names of 20 letters and more; persons' names of over 30 letters or
    with two digits in a row, and those of over 10 letters with a date.
    """
    n = F.length(name)
    dated = F.col("from_date").isNotNull() | F.col("to_date").isNotNull()
    person = (n > 30) | has_digits(F.col(name), 2) | ((n > 10) & dated)
    return F.coalesce(((F.col(kind) == "corporateBody") & (n >= 20)) | ((F.col(kind) == "person") & person), F.lit(False))


def group_records(records: DataFrame, decisions: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """record_id, group_no, group_id, group_name, viaf_id, maybe_viaf_id: the group of every record.

    ``group_id`` is that of an existing group (``groups``: id, viaf_id) and NULL
    for a new one; ``group_no`` is the lowest record id of the group, its name
    that record's.  ``viaf_id`` is the authority the group has or gets: one that
    has any keeps it.  ``maybe_viaf_id`` is a candidate to be looked at, of a
    record that was not accepted.
    """
    if "group_id" not in decisions.columns:
        decisions = decisions.withColumn("group_id", F.lit(None).cast("bigint"))
    taken = F.col("decision") == "accept"
    d = decisions.groupBy("record_id").agg(
        F.min(F.when(taken, F.col("group_id"))).alias("group_id"), F.min(F.when(taken, F.col("viaf_id"))).alias("viaf_id"), F.min(F.when(F.col("decision") == "maybe", F.col("viaf_id"))).alias("maybe_viaf_id")
    )
    r = records.select(F.col("id").alias("record_id"), "r_type", "name_norm", "from_date", "to_date").join(d, "record_id", "left")
    if groups is None:
        r = r.withColumn("held", F.lit(None).cast("string"))
    else:
        of_authority = groups.where("viaf_id IS NOT NULL AND coalesce(g_type, '') <> 'invalid'").groupBy("viaf_id").agg(F.min("id").alias("by_authority"))
        held = groups.select(F.col("id").alias("group_id"), F.col("viaf_id").alias("held"))
        r = r.join(of_authority, "viaf_id", "left").withColumn("group_id", F.coalesce("group_id", "by_authority")).drop("by_authority").join(held, "group_id", "left")
    none = F.lit(None).cast("string")
    years = F.concat_ws("-", F.coalesce(F.year("from_date").cast("string"), F.lit("")), F.coalesce(F.year("to_date").cast("string"), F.lit("")))
    key = F.xxhash64(
        F.coalesce(F.col("group_id").cast("string"), F.lit("")),
        F.when(F.col("group_id").isNull(), F.coalesce(F.concat(F.col("r_type"), F.lit("|"), F.col("viaf_id")), none)),
        F.when(F.col("group_id").isNull() & F.col("viaf_id").isNull(), F.when(name_joins(), F.concat_ws("|", F.lit("n"), "r_type", "name_norm", F.when(F.col("r_type") == "person", years))).otherwise(F.col("record_id").cast("string"))),
    )
    keyed = r.withColumn("key", key)
    one = keyed.groupBy("key").agg(F.min("record_id").alias("group_no"), F.min_by("name_norm", "record_id").alias("group_name"), F.min(F.coalesce("held", "viaf_id")).alias("viaf_id"))
    return keyed.select("record_id", "key", "group_id", "maybe_viaf_id").join(one, "key").select("record_id", "group_no", "group_id", "group_name", "viaf_id", "maybe_viaf_id")


def maybe_rows(grouped: DataFrame) -> DataFrame:
    """group_no, group_id, candidate_type, candidate_id: the candidates of ``group_records`` as rows of the table of candidates."""
    rows = grouped.where("maybe_viaf_id IS NOT NULL")
    return rows.select("group_no", "group_id", F.lit("viaf").alias("candidate_type"), F.col("maybe_viaf_id").alias("candidate_id"))
