"""Queries of the nested-record operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmark.operators.nested import CLUSTER_KINDS, RECORD_KINDS, nested_children, occurrences_in, rebuilt, store
from kinmark.plans import xmlsql
from kinmark.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat child rows of every well-formed record and cluster."""
    return nested_children(
        {
            "original_records": (table(spark, sf_dir, "original_records"), "id", "record_data", RECORD_KINDS),
            "record_groups": (table(spark, sf_dir, "record_groups"), "id", "viaf_record", CLUSTER_KINDS),
        }
    )


def p2_subtrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct subtree of all records and clusters by its kind of element: how many there are and how many occurrences they stand for."""
    rows = []
    for name, key, xml in (("original_records", "id", "record_data"), ("record_groups", "id", "viaf_record")):
        roots, subtrees = store(table(spark, sf_dir, name), key, xml, f"subtrees-{name}")
        bridge = occurrences_in(subtrees).groupBy("child").agg(F.count("*").alias("n")).unionByName(roots.groupBy(F.col("digest").alias("child")).agg(F.count("*").alias("n")))
        rows.append(subtrees.join(bridge, subtrees["digest"] == bridge["child"]).groupBy("tag").agg(F.count_distinct("digest").alias("subtrees"), F.sum("n").alias("bridge_rows")).select(F.lit(name).alias("owner_table"), "tag", "subtrees", "bridge_rows"))
    return rows[0].unionByName(rows[1])


def p2_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clusters' XML made again from their distinct subtrees."""
    roots, subtrees = store(table(spark, sf_dir, "record_groups"), "id", "viaf_record", "rebuilt")
    return rebuilt(roots, subtrees, "rebuilt")


QUERIES = {"p2_found": p2_found, "p2_subtrees": p2_subtrees, "p2_rebuilt": p2_rebuilt}
ORACLE: dict[str, str] = {"p2_found": xmlsql.NESTED}
