"""Command line: load, match, merge, export and postprocess over a folder of parquet tables.

    python -m kinmark.cli load     --tables T --out O --collection NAME --base FOLDER
    python -m kinmark.cli match    --tables T --out O [--type person|corporateBody|family] [--start N] [--end N] [--stating NAME ...] [--candidates]
    python -m kinmark.cli merge    --tables T --out O [--identifiers FILE | --service ADDRESS]
    python -m kinmark.cli export   --tables T --out O [--since TIME] [--collection NAME ...] [--id ARK ...] [--listing FOLDER]
    python -m kinmark.cli postprocess --tables T --out O (reload | problems) [--start N] [--end N]

Every command reads tables and writes new ones; nothing is changed in place, so
a command can be run again.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmark.operators import audit, fusion, grouping, lineage, lookup, matching
from kinmark.session import materialize, table
from kinmark.sources import files
from kinmark.sources import records as record_source
from kinmark.streaming.incremental import postprocess


def _between(df: DataFrame, a: argparse.Namespace) -> DataFrame:
    if a.start is not None:
        df = df.where(F.col("id") >= a.start)
    return df.where(F.col("id") <= a.end) if a.end is not None else df


def load(spark: SparkSession, a: argparse.Namespace) -> dict[str, DataFrame]:
    """New records of a collection."""
    known = table(spark, a.tables, "original_records") if a.tables else None
    return {"original_records": record_source.load_collection(spark, a.collection[0], {}, a.base, known)}


def match(spark: SparkSession, a: argparse.Namespace) -> dict[str, DataFrame]:
    """Decisions and groups of unprocessed records."""
    records, groups, merged, clusters = (table(spark, a.tables, t) for t in ("original_records", "record_groups", "merged_records", "viaf_clusters"))
    todo = _between(lookup.unprocessed(records), a)
    if a.type:
        todo = todo.where(F.col("r_type") == a.type)
    stated = record_source.same_as(todo.where(F.col("collection_id").isin(a.stating or [])))
    decisions = materialize(matching.cascade(todo, groups, records, merged, clusters, stated), "cli-decisions")
    grouped = materialize(grouping.group_records(todo, decisions, groups), "cli-groups")
    out = {"decisions": decisions, "groups": grouped}
    return out | {"new_candidates": grouping.maybe_rows(grouped)} if a.candidates else out


def merge(spark: SparkSession, a: argparse.Namespace) -> dict[str, DataFrame]:
    """Merged records for groups without one, and identifiers for records without one."""
    groups, merged = table(spark, a.tables, "record_groups"), table(spark, a.tables, "merged_records")
    need = lookup.without_canonical_id(merged).count()
    if a.service:
        stock = files.service_identifiers(spark, a.service, need)
    else:
        stock = files.read_identifiers(spark, a.identifiers) if a.identifiers else files.mint(spark, merged.count(), need)
    return {"new_merged_records": fusion.new_merged(groups, merged), "identifiers": fusion.assign_identifiers(merged, stock)}


def export(spark: SparkSession, a: argparse.Namespace) -> dict[str, DataFrame]:
    """XML files of merged records: all, those changed since a moment, of collections, or by identifier."""
    from kinmark.plans.fusion_queries import r_combined, r_tombstone_texts

    merged, records = table(spark, a.tables, "merged_records"), table(spark, a.tables, "original_records")
    wanted = merged
    if a.since:
        wanted = lookup.changed_since(wanted, records, a.since)
    if a.collection:
        wanted = lookup.of_collections(wanted, records, a.collection)
    if a.listing:
        wanted = wanted.join(files.listed_identifiers(spark, a.listing), "canonical_id", "left_semi")
    if a.id:
        wanted = wanted.where(F.col("canonical_id").isin(a.id))
    texts = r_combined(spark, a.tables).select("canonical_id", "record_data").unionByName(r_tombstone_texts(spark, a.tables))
    chosen = texts.join(wanted.select("canonical_id"), "canonical_id", "left_semi")
    return {"written": files.write_files(files.file_rows(chosen), f"{a.out}/xml")}


def post(spark: SparkSession, a: argparse.Namespace) -> dict[str, DataFrame]:
    """Refresh of authority ids, or the audit of accepted matches."""
    groups, clusters = table(spark, a.tables, "record_groups"), table(spark, a.tables, "viaf_clusters")
    if a.what == "problems":
        return {"problems": postprocess(groups, lambda g: audit.problematic(table(spark, a.tables, "original_records"), g, clusters), a.start, a.end)}
    codes = clusters.select("viaf_id", F.posexplode("sources").alias("pos", "source"))

    def step(g: DataFrame) -> DataFrame:
        own = g.where("viaf_id IS NOT NULL").select("id", "viaf_id").join(codes, "viaf_id").select("id", "pos", "source")
        return lineage.refresh(g, own, clusters)

    return {"refreshed": postprocess(groups, step, a.start, a.end)}


def main(args: list[str] | None = None) -> None:
    """Run one command and write its tables below ``--out``."""
    p = argparse.ArgumentParser(prog="kinmark")
    p.add_argument("command", choices=("load", "match", "merge", "export", "postprocess"))
    p.add_argument("what", nargs="?", choices=("reload", "problems"), default="problems")
    p.add_argument("--tables")
    p.add_argument("--out", required=True)
    p.add_argument("--base", default=".")
    p.add_argument("--collection", nargs="*")
    p.add_argument("--type")
    p.add_argument("--start", type=int)
    p.add_argument("--end", type=int)
    p.add_argument("--identifiers")
    p.add_argument("--service", help="address of a service that mints identifiers, with {} for their number")
    p.add_argument("--since")
    p.add_argument("--id", nargs="*")
    p.add_argument("--listing", help="export again the records by whose identifiers the files of this folder are named")
    p.add_argument("--candidates", action="store_true", help="write the rows that the table of candidates gets as well")
    p.add_argument("--stating", nargs="*", help="collections whose records state an authority's identifier")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("kinmark").getOrCreate()
    run = {"load": load, "match": match, "merge": merge, "export": export, "postprocess": post}[a.command]
    for name, df in run(spark, a).items():
        df.write.mode("overwrite").parquet(f"{a.out}/{name}.parquet")


if __name__ == "__main__":
    main()
