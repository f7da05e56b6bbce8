"""Candidate search over authority headings and names.

The search engine's ranking is defined here (it is not given elsewhere): a
document must hold the rarest of the query's tokens (or one of its ``RARE``
rarest n-grams); among these the order is by shared distinct tokens, then by
the share of the union, then by id.  Joining on the rarest key only keeps the
join as small as the data allows, however common the other tokens are.
``ranked_all`` ranks all documents that share any token, by the same order.

Edge cases: NULL or empty names have no tokens and no candidates; repeated
tokens count once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmark.functions.normalize import collapse, name_key
from kinmark.functions.similarity import trigrams
from kinmark.operators import setsearch
from kinmark.operators.lookup import top_k
from kinmark.session import materialize

RARE = 3
NAME_TYPES = {"person": "Personal", "corporateBody": "Corporate", "family": "Personal"}


def name_type(kind: Column) -> Column:
    """The authority's type for a record's type."""
    return F.when(kind == "corporateBody", "Corporate").when(kind.isin("person", "family"), "Personal")


def is_spirit(name: Column) -> Column:
    """Whether a name is a spirit's: such records match flagged clusters only, all others only unflagged ones."""
    return F.coalesce(F.lower(name).contains("(spirit)"), F.lit(False))


def headings(clusters: DataFrame) -> DataFrame:
    """viaf_id, name_type, spirit, pos, heading, birth, death: the index of main headings."""
    flat = clusters.where("viaf_id IS NOT NULL").select("viaf_id", "name_type", F.coalesce("spirit", F.lit(False)).alias("spirit"), "birth", "death", F.posexplode("headings").alias("pos", "heading"))
    return flat.where("heading IS NOT NULL")


def tokens(c: Column) -> Column:
    """Distinct words."""
    return F.array_distinct(F.filter(F.split(collapse(c), " "), lambda w: w != ""))


def ngrams(c: Column, n: int = 3) -> Column:
    """Distinct character n-grams of the words joined by blanks."""
    # the text is bound to a lambda's variable: a lambda computes what it captures anew for every element
    text = F.array(F.concat(F.lit(" "), collapse(c), F.lit(" ")))
    grams = F.transform(text, lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(s) - n + 1)), lambda i: F.substring(s, i, F.lit(n))))
    return F.array_distinct(F.flatten(grams))


def exact_heading(records: DataFrame, index: DataFrame) -> DataFrame:
    """record_id, viaf_id: the cluster with a heading of the same normalised form, type and spirit flag; lowest id first."""
    keys = index.select("viaf_id", "name_type", "spirit", name_key(F.col("heading")).alias("key")).groupBy("key", "name_type", "spirit").agg(F.min("viaf_id").alias("viaf_id"))
    q = records.select(F.col("id").alias("record_id"), F.col("name_norm").alias("key"), name_type(F.col("r_type")).alias("name_type"), is_spirit(F.col("name")).alias("spirit"))
    return q.join(keys, ["key", "name_type", "spirit"]).select("record_id", "viaf_id")


def ranked(queries: DataFrame, docs: DataFrame, k: int = 10, rare: int = 1) -> DataFrame:
    """qid, did, shared, rank: the k best documents of each query.

    ``queries`` has qid, part, terms (array); ``docs`` did, part, terms; only
    equal parts meet.  Documents must hold one of the ``rare`` rarest terms of
    the query that occur at all.
    """
    doc_terms = docs.select("part", "did", F.explode("terms").alias("term"))
    df = doc_terms.groupBy("part", "term").agg(F.count("*").alias("df"))
    sets, back = _term_sets(queries)
    q = sets.select("qid", "part", F.explode("terms").alias("term")).join(df, ["part", "term"])
    return back(_best(sets, docs, doc_terms, top_k(q, ["qid"], [F.col("df"), F.col("term")], rare), k))


def _term_sets(queries: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Distinct sets of terms as queries, and how their results come back to those who asked: equal queries are searched once."""
    keyed = queries.withColumn("set_no", F.xxhash64(F.col("part").isNull(), "part", F.array_sort("terms")))
    sets = materialize(keyed.groupBy("set_no").agg(F.first("part").alias("part"), F.first("terms").alias("terms")).withColumnRenamed("set_no", "qid"), "term-sets")

    def back(found: DataFrame) -> DataFrame:
        return keyed.select("qid", "set_no").join(found.withColumnRenamed("qid", "set_no"), "set_no").drop("set_no")

    return sets, back


def ranked_all(queries: DataFrame, docs: DataFrame, k: int = 10, rare: int = RARE) -> DataFrame:
    """As ``ranked``, over all documents that share a term with the query, however common (``rare`` has no effect).

    Equal sets are one query and one document; no row is made for a pair that
    is not among the k best of a block of documents (``setsearch``).
    """
    sets, back = _term_sets(queries.where("part IS NOT NULL AND size(terms) > 0").select("qid", setsearch.part_no().alias("part"), setsearch.coded("terms").alias("terms")))
    return back(setsearch.ranked(setsearch.document_sets(docs, k), sets, k)).select("qid", "did", "shared", "rank")


def _best(queries: DataFrame, docs: DataFrame, doc_terms: DataFrame, keys: DataFrame, k: int) -> DataFrame:
    """The k best of the documents that hold one of the query's ``keys``."""
    pairs = keys.select("qid", "part", "term").join(doc_terms, ["part", "term"]).select("qid", "did").distinct()
    # 64-bit numbers instead of texts: the intersection of two sets runs on primitive arrays
    coded = F.transform("terms", lambda t: F.xxhash64(t))
    full = pairs.join(queries.select("qid", coded.alias("qt")), "qid").join(docs.select("did", coded.alias("dt")), "did")
    shared = F.size(F.array_intersect("qt", "dt"))
    scored = full.select("qid", "did", shared.alias("shared"), (shared / (F.size("qt") + F.size("dt") - shared)).alias("jaccard"))
    return top_k(scored, ["qid"], [F.desc("shared"), F.desc("jaccard"), F.col("did")], k).select("qid", "did", "shared", "rank")


def _documents(index: DataFrame, terms: Column) -> DataFrame:
    one = index.groupBy("viaf_id", "name_type", "spirit").agg(F.array_join(F.sort_array(F.collect_set("heading")), " ").alias("text"))
    return one.select(F.col("viaf_id").alias("did"), F.struct("name_type", "spirit").alias("part"), terms.alias("terms"))


def _queries(records: DataFrame, terms: Column) -> DataFrame:
    part = F.struct(name_type(F.col("r_type")).alias("name_type"), is_spirit(F.col("name")).alias("spirit"))
    return records.where("name_norm IS NOT NULL").select(F.col("id").alias("qid"), part.alias("part"), terms.alias("terms"))


def keyword_candidates(records: DataFrame, index: DataFrame, k: int = 10, query: Column | None = None, whole: bool = False) -> DataFrame:
    """Best clusters by words of their headings; ``whole`` ranks all that share a word."""
    q, d = _queries(records, tokens(F.col("name_norm") if query is None else query)), _documents(index, tokens(F.col("text")))
    return ranked_all(q, d, k) if whole else ranked(q, d, k)


def ngram_candidates(records: DataFrame, index: DataFrame, k: int = 10, whole: bool = False) -> DataFrame:
    """Best clusters by character trigrams of their headings; ``whole`` ranks all that share one."""
    q, d = _queries(records, ngrams(F.col("name_norm"))), _documents(index, ngrams(F.col("text")))
    return ranked_all(q, d, k) if whole else ranked(q, d, k, RARE)


def close_names(names: DataFrame, bound: int = 5, cut: int | None = 254) -> DataFrame:
    """a, b, distance: pairs of distinct texts (column name; its first ``cut`` letters) at an edit distance below ``bound``.

    Blocking without loss: at most ``bound - 1`` edits leave one of ``bound``
    pieces of the shorter text unchanged, shifted by at most as many places.
    Texts shorter than ``bound``, all of which are within reach of each other, meet by length instead.
    """
    edits = bound - 1
    t = names.select((F.col("name") if cut is None else F.substring("name", 1, cut)).alias("t")).where("t IS NOT NULL").distinct().withColumn("n", F.length("t"))
    long = t.where(F.col("n") >= bound)
    # pieces of a text of length n: cut at n * i / bound; a text of length m is searched at every shift for every n within reach
    cut = lambda n, i: F.floor(n * i / bound).cast("int")
    piece_rows = [long.select("t", F.col("n").alias("len"), F.lit(i).alias("i"), F.substring(F.col("t"), cut(F.col("n"), i) + 1, cut(F.col("n"), i + 1) - cut(F.col("n"), i)).alias("piece")) for i in range(bound)]
    pieces = piece_rows[0]
    for p in piece_rows[1:]:
        pieces = pieces.unionByName(p)
    reach = long.select("t", "n", F.explode(F.sequence(F.greatest(F.col("n") - edits, F.lit(bound)), F.col("n"))).alias("len"))
    rows = []
    for i in range(bound):
        at = cut(F.col("len"), i)
        size = cut(F.col("len"), i + 1) - at
        shifts = F.explode(F.sequence(F.greatest(F.lit(0), at - edits), at + edits))
        rows.append(reach.select("t", "len", F.lit(i).alias("i"), size.alias("size"), shifts.alias("s")).select("t", "len", "i", F.substring(F.col("t"), F.col("s") + 1, F.col("size")).alias("piece")).distinct())
    probes = rows[0]
    for p in rows[1:]:
        probes = probes.unionByName(p)
    found = pieces.alias("p").join(probes.alias("q"), ["len", "i", "piece"]).where(F.col("p.t") != F.col("q.t")).select(F.least("p.t", "q.t").alias("a"), F.greatest("p.t", "q.t").alias("b")).distinct()
    short = t.where(F.col("n") < bound)
    near = t.where(F.col("n") < bound + edits)
    banded = near.select("t", F.explode(F.sequence(F.greatest(F.lit(0), F.col("n") - edits), F.col("n") + edits)).alias("n"))
    small = short.alias("x").join(banded.alias("y"), "n").where(F.col("x.t") != F.col("y.t")).select(F.least("x.t", "y.t").alias("a"), F.greatest("x.t", "y.t").alias("b")).distinct()
    pairs = found.unionByName(small).distinct()
    d = F.levenshtein("a", "b", edits)
    return pairs.withColumn("distance", d).where("distance >= 0")


def similar_names(names: DataFrame, bound: float = 0.75) -> DataFrame:
    """a, b, similarity: pairs of distinct texts whose trigram similarity exceeds ``bound``.

    Prefix filter: sets whose overlap exceeds the bound share one of the rarest
    trigrams of each, so only the lists of those are read (``setsearch``); no
    row is made for a pair below the bound.
    """
    t = names.select(F.col("name").alias("t")).where("t IS NOT NULL").distinct().withColumn("g", trigrams(F.col("t")))
    return setsearch.similar(t.select("t", setsearch.coded("g").alias("terms")), bound)


def close_records(records: DataFrame, bound: int = 5) -> DataFrame:
    """record_id, other_id, distance: every record and the other grouped records at an edit distance below ``bound``, nearest first.

    Whole names are compared with the first 254 letters of the grouped records'
    names, as stored; equal names are at distance 0.
    """
    r, o = _record_texts(records, F.substring("name_norm", 1, 254))
    texts = r.select(F.col("a").alias("name")).unionByName(o.select(F.col("b").alias("name"))).distinct()
    return _by_record(r, o, close_names(texts, bound, None), texts.select(F.col("name").alias("a"), F.col("name").alias("b"), F.lit(0).alias("distance")), "distance")


def similar_records(records: DataFrame, bound: float = 0.75) -> DataFrame:
    """record_id, other_id, similarity: every record and the other grouped records whose trigram similarity exceeds ``bound``, most similar first."""
    r, o = _record_texts(records, F.col("name_norm"))
    texts = r.select(F.col("a").alias("name")).distinct()
    same = texts.where(F.size(trigrams(F.col("name"))) > 0).select(F.col("name").alias("a"), F.col("name").alias("b"), F.lit(1.0).alias("similarity"))
    return _by_record(r, o, similar_names(texts, bound), same, "similarity")


def _record_texts(records: DataFrame, stored: Column) -> tuple[DataFrame, DataFrame]:
    named = records.where("name_norm IS NOT NULL")
    return named.select(F.col("id").alias("record_id"), F.col("name_norm").alias("a")), named.where("record_group_id IS NOT NULL").select(F.col("id").alias("other_id"), stored.alias("b"))


def _by_record(r: DataFrame, o: DataFrame, pairs: DataFrame, same: DataFrame, value: str) -> DataFrame:
    both = pairs.select("a", "b", value).unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), value)).unionByName(same)
    nearest = F.col(value) if value == "distance" else F.desc(value)
    return r.join(both, "a").join(o, "b").where("record_id <> other_id").select("record_id", "other_id", value).orderBy("record_id", nearest, "other_id")
