"""Audit of accepted matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmark.functions.humanname import name_match_quality
from kinmark.functions.normalize import strip_accents

LEAST = 0.85


def problematic(records: DataFrame, groups: DataFrame, clusters: DataFrame) -> DataFrame:
    """record_id, group_id, name, heading, quality: records none of whose authority's headings matches their name.

    The heading and quality are the best ones.  Records of groups without an
    authority or headings are not audited.
    """
    g = groups.where("viaf_id IS NOT NULL").select(F.col("id").alias("record_group_id"), "viaf_id")
    h = clusters.select("viaf_id", F.explode("headings").alias("heading"))
    r = records.where("record_group_id IS NOT NULL AND name IS NOT NULL").select(F.col("id").alias("record_id"), "record_group_id", strip_accents(F.col("name")).alias("name"))
    pairs = r.join(g, "record_group_id").join(h, "viaf_id").withColumn("heading", strip_accents(F.col("heading")))
    # a name and a heading meet often: each distinct pair is judged once
    judged = pairs.select("name", "heading").distinct().withColumn("quality", name_match_quality(F.col("name"), F.col("heading")))
    best = pairs.join(judged, ["name", "heading"]).groupBy("record_id", F.col("record_group_id").alias("group_id"), "name").agg(F.max(F.struct("quality", "heading")).alias("b"))
    return best.where(F.col("b.quality") < LEAST).select("record_id", "group_id", "name", F.col("b.heading").alias("heading"), F.round("b.quality", 6).alias("quality"))
