"""Best representative of each duplicate group by skyline selection.

Each group's entries are compared on several criteria at once: completeness
(a language is stated, number of years stated), trust (preference score) and
recency.  An entry is dominated when another is at least as good on all of
them and better on one.  Undominated entries form layer 1; the undominated of
the rest layer 2, and so on (the layer is the longest chain of dominators).
Each field then takes its value by a lexicographic policy inside the first
layer that can supply it, and a field that is NULL there is filled from the
next layers.

Scale: before anything is gathered, a group's entries are reduced, map-side
first, to one representative for each cell (criteria values and mask of stated
fields): the latest.  Any other entry of the cell is dominated by it and no
field would take it.  The number of cells is bounded by the criteria's distinct
values, not by the group's rows, so a group holding a third of all rows still
gathers a few hundred cells where entries state up to a hundred years.

Edge cases: NULL name, sources, dates or language count as not stated; groups
with a NULL id are left out; repeated rows are one cell; equal recency is
resolved by the higher entry id; groups of one entry are left out (nothing to
choose); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmark.operators.fusion import array_score

#: Language values that state nothing (fixed values).
NO_LANGUAGE = ["", "und"]


def years_stated(text: Column) -> Column:
    """Number of four-digit years in a text (not part of longer digit runs)."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?<!\d)\d{4}(?!\d)"), F.lit(0)))


def cells(entries: DataFrame) -> DataFrame:
    """One row per group and cell of (years, language stated, score, mask): its latest entry, and the group's cells."""
    e = entries.where(F.col("record_group_id").isNotNull()).select(
        "record_group_id",
        "entry_id",
        F.col("updated_at").alias("at"),
        years_stated(F.col("use_dates")).alias("years"),
        F.when(F.coalesce(F.trim(F.lower("lang")), F.lit("")).isin(NO_LANGUAGE), 0).otherwise(1).alias("has_lang"),
        array_score(F.col("sources")).alias("score"),
        F.col("name").isNotNull().cast("int").alias("has_name"),
    )
    keys = ["record_group_id", "years", "has_lang", "score", "has_name"]
    latest = e.groupBy(*keys).agg(F.max(F.struct("at", "entry_id")).alias("last"), F.count("*").alias("n"))
    return latest.select(*keys, "last.at", "last.entry_id", "n")


def layered(cell: DataFrame) -> DataFrame:
    """Each group's cells with their dominance layer, as an array of structs."""
    # in this order every dominator of a cell stands before it
    groups = cell.groupBy("record_group_id").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "score", "years", "has_lang", "has_name", "entry_id")), asc=False).alias("cells")
    )
    kind = "array<struct<at:timestamp,score:int,years:int,has_lang:int,has_name:int,entry_id:bigint,layer:int>>"

    def at_least(o: Column, c: Column) -> Column:
        same_or_more = [F.coalesce(o["at"], F.lit(0).cast("timestamp")) >= F.coalesce(c["at"], F.lit(0).cast("timestamp"))]
        same_or_more += [o[k] >= c[k] for k in ("score", "years", "has_lang", "has_name")]
        out = same_or_more[0]
        for x in same_or_more[1:]:
            out = out & x
        return out

    def add(acc: Column, c: Column) -> Column:
        above = F.transform(F.filter(acc, lambda o: at_least(o, c)), lambda o: o["layer"])
        layer = F.coalesce(F.array_max(above), F.lit(0)) + 1
        return F.concat(acc, F.array(F.struct(*[c[k].alias(k) for k in ("at", "score", "years", "has_lang", "has_name", "entry_id")], layer.alias("layer"))).cast(kind))

    return groups.select("record_group_id", "n", F.aggregate("cells", F.array().cast(kind), add).alias("cells"))


def survivors(entries: DataFrame) -> DataFrame:
    """record_group_id, field_name, entry_id: the entry that supplies each field of a group of two or more."""
    g = layered(cells(entries)).where("n >= 2")

    def best(able: Column, *policy: str) -> Column:
        ranked = F.transform(F.filter("cells", lambda c: c[able] > 0), lambda c: F.struct((-c["layer"]).alias("layer"), *[c[p].alias(p) for p in policy], c["at"].alias("at"), c["entry_id"].alias("entry_id")))
        return F.array_max(ranked)["entry_id"]

    fields = F.array(
        F.struct(F.lit("name").alias("field_name"), best("has_name", "score").alias("entry_id")),
        F.struct(F.lit("use_dates").alias("field_name"), best("years", "years").alias("entry_id")),
        F.struct(F.lit("lang").alias("field_name"), best("has_lang").alias("entry_id")),
    )
    return g.select("record_group_id", F.inline(fields)).where("entry_id IS NOT NULL")


def fused(entries: DataFrame) -> DataFrame:
    """One surviving name entry per group, each field's value from its best entry."""
    chosen = survivors(entries)
    values = entries.select("entry_id", "name", "use_dates", "lang")
    taken = chosen.join(values, "entry_id")
    pick = lambda f: F.max(F.when(F.col("field_name") == f, F.col(f))).alias(f)
    return taken.groupBy("record_group_id").agg(pick("name"), pick("use_dates"), pick("lang"))
