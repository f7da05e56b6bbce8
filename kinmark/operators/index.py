"""The authority's search indexes as key tables, and searches in them.

Every index is a flat table (viaf_id, key): built by one pass over the clusters,
joined on the key.  ``EXACT`` indexes hold whole normalised texts, ``KEYWORD``
ones words, ``NGRAM`` ones character trigrams.

Edge cases: NULL and empty values have no keys; repeated keys of a cluster
count once; an unknown index name raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmark.functions.normalize import name_key
from kinmark.operators.blocking import ngrams, tokens


def _none() -> Column:
    return F.array().cast("array<string>")


def _see_also(clusters: DataFrame) -> Column:
    """Names of related entities, where the table states them (``see_also``)."""
    return F.coalesce("see_also", _none()) if "see_also" in clusters.columns else _none()


def _all_names(clusters: DataFrame) -> Column:
    forms = lambda c: F.coalesce(F.transform(c, lambda x: x["name"]), _none())
    return F.array_distinct(F.concat(F.coalesce("headings", _none()), forms("auth_forms"), forms("alt_forms"), _see_also(clusters)))


def _variants(clusters: DataFrame) -> Column:  # noqa: ARG001
    return F.transform("alt_forms", lambda x: x["name"])


def _exact(c: Column) -> Column:
    return F.array(c)


#: index name: (values of a cluster, keys of a value)
INDEXES = {
    "idnumber": (lambda _: F.col("sources"), lambda c: F.array(F.replace(c, F.lit("|"), F.lit(" ")))),
    "viafid": (lambda _: F.array("viaf_id"), _exact),
    "xmainname": (lambda _: F.col("headings"), lambda c: F.array(name_key(c))),
    "mainname": (lambda _: F.col("headings"), tokens),
    "seerefs": (_variants, tokens),
    "seealso": (_see_also, tokens),
    "birthdate": (lambda _: F.array(F.when(F.col("birth") != "0", F.col("birth"))), _exact),
    "deathdate": (lambda _: F.array(F.when(F.col("death") != "0", F.col("death"))), _exact),
    "xmainnamenn": (lambda _: F.col("headings"), _exact),
    "mainnamenn": (lambda _: F.col("headings"), lambda c: F.split(c, r"\s+")),
    "xallnames": (_all_names, lambda c: F.array(name_key(c))),
    "allnames": (_all_names, tokens),
    "allnamesngram": (_all_names, ngrams),
    "mainnamengram": (lambda _: F.col("headings"), ngrams),
    "nametype": (lambda _: F.array(F.lower("name_type")), _exact),
    "spirit": (lambda _: F.array(F.coalesce(F.col("spirit"), F.lit(False)).cast("int").cast("string")), _exact),
}


def keys(clusters: DataFrame, name: str) -> DataFrame:
    """viaf_id, key: the keys of one index."""
    values, split = INDEXES[name]
    flat = clusters.where("viaf_id IS NOT NULL").select("viaf_id", F.explode(values(clusters)).alias("value")).where("value IS NOT NULL")
    return flat.select("viaf_id", F.explode(split(F.col("value"))).alias("key")).where("key IS NOT NULL AND key <> ''").distinct()


def search(clusters: DataFrame, name: str, terms: DataFrame, with_type: bool = False) -> DataFrame:
    """qid, viaf_id: clusters that hold a key; ``terms`` has qid, key and, with ``with_type``, name_type."""
    hits = terms.join(keys(clusters, name), "key")
    if with_type:
        hits = hits.join(clusters.select("viaf_id", "name_type"), ["viaf_id", "name_type"], "left_semi")
    return hits.select("qid", "viaf_id").distinct()


def sizes(clusters: DataFrame) -> DataFrame:
    """index, keys, entries: size of every index."""
    out = None
    for name in INDEXES:
        one = keys(clusters, name).agg(F.count_distinct("key").alias("keys"), F.count("*").alias("entries")).select(F.lit(name).alias("index"), "keys", "entries")
        out = one if out is None else out.unionByName(one)
    return out
