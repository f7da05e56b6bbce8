"""Matching records with authority clusters without keys, by collective graph linkage.

1. Attributes.  Records and clusters get composite attributes from every name
   form, the years, the works and the kind (family name with initial and year,
   with formal given name or the given name less one letter, with the initials
   of two given names, with initial and a work's title ...).  A cluster also
   gets the attributes of records whose core is one error away from its own,
   wherever the error lies; only such as some record has.  Every attribute says
   more than a family name with an initial, which alone could never be accepted
   and would make blocks of a hot family name's rows.
2. Candidate graph.  An edge joins a record and a cluster that share an
   attribute, weighted by the sum of ln(N / df) of what they share: rare shared
   attributes count most.
3. Meta-blocking.  An edge stays if its weight is at least ``KEEP`` of the
   largest weight at one of its ends.
4. Similarity.  Names (longest-common-subsequence ratio of the family names,
   given names with nicknames and initials), years and works give each edge a
   score, of which up to ``COMMON_COST`` goes where all that is shared is
   common; different kinds or years are a contradiction.
5. Propagation.  Records are neighbours if they share an identifying attribute
   (family name, initial and year, or full given names), or family name and
   initial together with a related record or a work: an edge gains from its
   neighbours' edges to the same cluster and loses from their stronger edges to
   others, round after round, until no score moves by more than ``STABLE``.
   This decides where names and years leave several clusters, or none, open.
6. A record takes its best clusters above ``ACCEPT``; if clusters with
   different years are equally good, it takes none.  The score is the
   confidence.

Scale: the graph's edges are what propagation works on; neighbours meet at
their shared attribute, where the best score of each cluster is one row, and
never in pairs.

Edge cases: NULL, empty or nobody's names have no candidates; NULL dates and
works say nothing; repeated records are matched each; clusters without names or
id take no part; an empty table gives no rows; scores that have not settled
after ``ROUNDS`` rounds raise an error.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmark.llm.names import LONG_GIVEN, agree, error_keys, formal_names, lcs_ratio, near, near_keys
from kinmark.session import materialize

KEEP = 0.5
ACCEPT = 0.55
COMMON_COST = 0.15
STABLE = 0.02
ROUNDS = 50  # the scores settle after two or three
SHARE = 0.25  # of a score that neighbours can give or take

_RELATION = r"<(?:\w+:)?resourceRelation\b[^>]*>\s*<(?:\w+:)?relationEntry[^>]*>\s*(?:<!\[CDATA\[)?\s*([^<\]]*?)\s*(?:\]\]>)?\s*</"


_TARGET = r"""<(?:\w+:)?cpfRelation\b[^>]*\shref\s*=\s*["']([^"']+)["']|<(?:\w+:)?cpfRelation\b[^>]*:href\s*=\s*["']([^"']+)["']"""


def plain(text: Column) -> Column:
    """A title's words in lower case."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?:&\w+;|[^\p{L}\p{N}])+", " "))


def record_works(records: DataFrame) -> DataFrame:
    """node, work: titles of the resources a record names."""
    found = F.regexp_extract_all("record_data", F.lit(_RELATION), F.lit(1))
    return records.where("record_data IS NOT NULL").select(F.concat(F.lit("r"), "id").alias("node"), F.explode(F.array_distinct(F.transform(found, plain))).alias("work")).where("work <> ''")


def record_relations(records: DataFrame) -> DataFrame:
    """node, target: addresses of what a record is related to."""
    found = F.regexp_extract_all("record_data", F.lit(_TARGET), F.lit(2))
    return records.where("record_data IS NOT NULL").select(F.concat(F.lit("r"), "id").alias("node"), F.explode(F.array_distinct(found)).alias("target")).where("target <> ''")


def cluster_works(clusters: DataFrame) -> DataFrame:
    """node, work: titles of a cluster."""
    rows = clusters.where("viaf_id IS NOT NULL").select(F.concat(F.lit("v"), "viaf_id").alias("node"), F.explode("titles").alias("t"))
    return rows.select("node", plain(F.col("t")).alias("work")).where("work <> ''").distinct()


def letters_of(forms: DataFrame) -> DataFrame:
    """Forms of persons, a row for each part of the family name and each letter the given name may begin with."""
    person = forms.where("kind = 'person' AND core IS NOT NULL").withColumn("core", F.explode(F.array_compact(F.array("core", "core2"))))
    return person.withColumn("i", F.explode(F.when(F.col("initials") == "", F.array(F.lit("?"))).otherwise(F.split("initials", "")))).where("i <> ''")


def attributes(forms: DataFrame, works: DataFrame | None = None) -> DataFrame:
    """node, kind, attr (64 bits), firm: composite attributes of every form; firm ones identify."""
    years = forms.groupBy("node").agg(F.min("b").alias("b"), F.min("d").alias("d"))
    f = forms.where("core IS NOT NULL").drop("b", "d", "form", "main").distinct().join(years, "node")
    is_record = F.col("node").startswith("r")
    starts, ends = F.substring("core", 1, 5), F.right("core", F.lit(5))

    none = F.lit(None).cast("int")
    person = letters_of(f)
    if works is None:
        person = person.withColumn("works", F.lit(None).cast("array<string>"))
    else:
        person = person.join(works.groupBy("node").agg(F.collect_set("work").alias("works")), "node", "left")
    person = person.withColumn("formals", formal_names(F.col("first")))
    undated = F.col("b").isNull() & F.col("d").isNull()

    def key(tag: str, core: str | Column, rest: str | Column, year: str | Column = none) -> Column:
        """An attribute; ``whole`` are its parts if it has the whole core, else NULL."""
        core = F.col(core) if isinstance(core, str) else core
        rest = F.col(rest) if isinstance(rest, str) else rest
        year = F.col(year) if isinstance(year, str) else year
        parts = F.struct(F.lit(tag).alias("tag"), core.alias("core"), rest.alias("rest"), year.cast("int").alias("year"))
        whole = F.lit(None).cast("struct<tag:string,core:string,rest:string,year:int>") if len(tag) > 1 else parts
        return F.struct(F.xxhash64(F.lit(tag), core, rest, year.cast("int")).alias("attr"), F.lit(tag[0].isupper()).alias("firm"), whole.alias("whole"))

    when = lambda cond, k: F.when(cond, F.array(k))
    has_b, has_d = F.col("b").isNotNull(), F.col("d").isNotNull()
    full, second = F.length("first") > 1, F.substring("second", 1, 1)
    once = full & (F.col("i") == F.substring("initials", 1, 1))  # what does not depend on the letter, of one of a name's rows only
    # a record without years is compared with all, one with years with those of the same year and those without
    sides = [("Gehwl", ~is_record | undated), ("ufgxm", undated | is_record)]
    undated_keys = []
    for tags, side in sides:
        each = lambda tag, arr: F.transform(arr, lambda x: key(tag, "core", x))
        undated_keys += [
            F.when(side & once, each(tags[0], F.col("formals"))),
            F.when(side & once, each(tags[1], near_keys(F.col("first")))),
            F.when(side & (second != ""), F.array(key(tags[2], "core", F.concat(F.col("i"), F.lit("."), second)))),
            F.when(side & F.col("works").isNotNull(), F.transform("works", lambda w: key(tags[3], "core", F.concat(F.col("i"), F.lit(" "), w)))),
            F.when(side & (F.length("first") >= LONG_GIVEN), F.array(key(tags[4], "core", "i"))),
        ]
    open_side = sides[0][1]
    keys = F.array_distinct(
        F.flatten(
            F.array_compact(
                F.array(
                    when(has_b, key("B", "core", "i", "b")),
                    when(has_d, key("D", "core", "i", "d")),
                    when(has_b, key("b1", starts, "i", "b")),
                    when(has_d, key("d1", starts, "i", "d")),
                    when(has_b, key("b2", ends, "i", "b")),
                    when(has_d, key("d2", ends, "i", "d")),
                    when(open_side & once, key("g1", starts, "first")),
                    when(open_side & once, key("g2", ends, "first")),
                    *undated_keys,
                )
            )
        )
    )
    people = person.select("node", "kind", F.explode(keys).alias("k"))
    other = f.where("kind <> 'person'")
    unit = F.concat_ws("|", "kind", F.coalesce("first", F.lit("")), F.coalesce("second", F.lit("")))
    keys = F.array(key("K", "core", unit), key("k1", starts, unit), key("k2", ends, unit))
    rest = other.select("node", "kind", F.explode(keys).alias("k"))
    exact = materialize(people.unionByName(rest).select("node", "k.attr", "k.firm", "k.whole").distinct(), "p1-exact")
    return exact.select("node", "attr", "firm").unionByName(one_error(exact)).distinct()


def neighbour_keys(forms: DataFrame, works: DataFrame, relations: DataFrame | None) -> DataFrame:
    """rec, attr: records of one family name and initial that share a work or what they are related to."""
    told = works.where(F.col("node").startswith("r")).select("node", F.xxhash64(F.lit("w"), "work").alias("e"))
    if relations is not None:
        told = told.unionByName(relations.select("node", F.xxhash64(F.lit("t"), "target").alias("e")))
    names = letters_of(forms.where(F.col("node").startswith("r"))).select("node", "core", "i").distinct()
    return names.join(told, "node").select(F.col("node").alias("rec"), F.xxhash64(F.lit("n"), "core", "i", "e").alias("attr")).distinct()


def one_error(exact: DataFrame) -> DataFrame:
    """node, attr, firm: attributes of records that clusters would have but for one error in the core.

    Spellings, and then distinct attributes, meet before nodes do.
    """
    whole = exact.where("whole IS NOT NULL")
    of = lambda side: whole.where(F.col("node").startswith(side))
    keyed = lambda side, name: of(side).select(F.col("whole.core").alias(name)).distinct().select(name, F.explode(error_keys(F.col(name))).alias("key"))
    pairs = keyed("r", "x").join(keyed("v", "y"), "key").where("x <> y AND levenshtein(x, y, 2) >= 0").select("x", "y").distinct()

    @F.pandas_udf("boolean")
    def one_spelling(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([near(p, q) and lcs_ratio(p, q) >= 0.8 for p, q in zip(x, y, strict=True)], dtype=bool)

    pairs = pairs.where(one_spelling("x", "y"))
    stated = of("v").select("attr", "whole.*").distinct().join(pairs.withColumnRenamed("y", "core"), "core")
    moved = stated.select("attr", F.xxhash64("tag", "x", "rest", "year").alias("other"))
    real = moved.join(of("r").select(F.col("attr").alias("other")).distinct(), "other")
    return of("v").select("node", "attr").join(real, "attr").select("node", F.col("other").alias("attr"), F.lit(False).alias("firm"))


def candidates(attrs: DataFrame, works: DataFrame, sizes: int) -> DataFrame:
    """rec, clu, weight, common, titles: edges of the candidate graph after meta-blocking; ``common`` is 0 for what only two share, 1 for what all do."""
    title = works.select("node", F.xxhash64(F.lit("w"), "work").alias("attr"))
    both = attrs.select("node", "attr").unionByName(title)
    df = both.groupBy("attr").agg(F.count("*").alias("df"), F.max(F.col("node").startswith("v")).alias("v"), F.max(F.col("node").startswith("r")).alias("r")).where("v AND r")
    # a work's title alone makes no candidate (stock titles); it adds to the weight of edges that names made
    worth = F.log(F.lit(float(max(sizes, 2))) / F.col("df"))
    named = attrs.select("node", "attr").join(df.select("attr", worth.alias("w")), "attr")
    rec, clu = named.where(F.col("node").startswith("r")), named.where(F.col("node").startswith("v"))
    edges = rec.select("attr", F.col("node").alias("rec"), "w").join(clu.select("attr", F.col("node").alias("clu")), "attr").groupBy("rec", "clu").agg(F.sum("w").alias("weight"), F.max("w").alias("rarest"))
    titled = title.join(df.select("attr", worth.alias("w")), "attr")
    tr, tc = titled.where(F.col("node").startswith("r")), titled.where(F.col("node").startswith("v"))
    by_title = tr.select("attr", F.col("node").alias("rec"), "w").join(tc.select("attr", F.col("node").alias("clu")), "attr").join(edges.select("rec", "clu"), ["rec", "clu"], "left_semi").groupBy("rec", "clu").agg(F.sum("w").alias("tw"), F.count("*").alias("titles"))
    edges = edges.join(by_title, ["rec", "clu"], "left").select("rec", "clu", (F.col("weight") + F.coalesce("tw", F.lit(0.0))).alias("weight"), (1 - F.col("rarest") / F.log(F.lit(float(max(sizes, 2))))).alias("common"), F.coalesce("titles", F.lit(0)).cast("int").alias("titles"))
    edges = materialize(edges, "p1-graph")
    most_r = edges.groupBy("rec").agg(F.max("weight").alias("mr"))
    most_c = edges.groupBy("clu").agg(F.max("weight").alias("mc"))
    return edges.join(most_r, "rec").join(most_c, "clu").where(f"weight >= {KEEP} * mr OR weight >= {KEEP} * mc").select("rec", "clu", "weight", "common", "titles")


def described(forms: DataFrame) -> DataFrame:
    """node, kind, its forms as one array of strings, and its years."""
    one = F.concat_ws("|", "core", F.coalesce("core2", F.lit("")), "first", "second")
    return forms.where("core IS NOT NULL").groupBy("node", "kind").agg(F.collect_set(one).alias("forms"), F.min("b").alias("b"), F.min("d").alias("d"))


def form_score(a: str, b: str, kind: str) -> float:
    """How well two forms agree, 0 to 0.8."""
    core_a, other_a, first_a, second_a = a.split("|")
    core_b, other_b, first_b, second_b = b.split("|")
    best = 0.0
    for x in (core_a, other_a):
        for y in (core_b, other_b):
            if x and y:
                if x == y:
                    best = 1.0
                elif best < 0.95 and near(x, y) and lcs_ratio(x, y) >= 0.8:
                    best = 0.95
                elif best < 0.8 and min(len(x), len(y)) >= 7 and lcs_ratio(x, y) >= 0.8:
                    best = 0.8
    if not best:
        return 0.0
    if kind != "person":
        return 0.8 * best if (first_a, second_a) == (first_b, second_b) else 0.0
    g, m = agree(first_a, first_b), agree(second_a, second_b)
    if g < 0 or m < 0:
        return 0.0
    return best * (0.4 + (0.2 if g == 2 else 0.1 if g == 1 else 0.0) + (0.15 if m == 2 else 0.1 if m == 1 else 0.05 if second_a == second_b else 0.0))


def scored(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with their own similarity s0; contradictions are gone."""
    side = lambda n, p: nodes.select(F.col("node").alias(n), F.col("kind").alias(f"{p}k"), F.col("forms").alias(f"{p}f"), F.col("b").alias(f"{p}b"), F.col("d").alias(f"{p}d"))
    e = edges.join(side("rec", "r"), "rec").join(side("clu", "c"), "clu").where("rk = ck AND coalesce(rb = cb, true) AND coalesce(rd = cd, true)")

    @F.pandas_udf("double")
    def names(rf: pd.Series, cf: pd.Series, kind: pd.Series) -> pd.Series:
        return pd.Series([max((form_score(a, b, k) for a in x for b in y), default=0.0) for x, y, k in zip(rf, cf, kind, strict=True)])

    same = lambda x, y: F.coalesce((F.col(x) == F.col(y)).cast("double"), F.lit(0.0))
    extra = 0.2 * same("rb", "cb") + 0.15 * same("rd", "cd") + 0.2 * F.least("titles", F.lit(2))
    with_names = e.withColumn("n", names("rf", "cf", "rk")).where("n > 0")
    own = F.least(F.lit(1.0), F.col("n") + extra) - COMMON_COST * F.greatest(F.lit(0.0), F.col("common"))
    return with_names.select("rec", "clu", "weight", own.alias("s0"), F.col("cb").alias("b"), F.col("cd").alias("d"))


def propagated(edges: DataFrame, attrs: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Scores after the neighbours' support has settled: rec, clu, s, b, d."""
    firm = attrs.where("firm").select(F.col("node").alias("rec"), "attr").unionByName(neighbours).join(edges.select("rec").distinct(), "rec", "left_semi")
    shared = firm.groupBy("attr").agg(F.count("*").alias("k")).where("k > 1").select("attr")
    star = firm.join(shared, "attr")
    now = materialize(edges.withColumn("s", F.col("s0")), "p1-score-0")
    # each edge at each of its record's attributes
    seats = materialize(star.join(now.select("rec", "clu"), "rec"), "p1-neighbours")
    for n in range(1, ROUNDS + 1):
        # at an attribute: the best score of each cluster and the best of all, over the records that have it
        at = seats.join(now.select("rec", "clu", "s"), ["rec", "clu"]).groupBy("attr", "clu").agg(F.max("s").alias("m"))
        top = at.groupBy("attr").agg(F.max("m").alias("t"))
        support = seats.join(at.join(top, "attr"), ["attr", "clu"]).groupBy("rec", "clu").agg(F.max("m").alias("m"), F.max(F.col("t") - F.col("m")).alias("lost"))
        new = now.join(support, ["rec", "clu"], "left").withColumn(
            "new", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("s0") + SHARE * F.greatest(F.lit(0.0), F.coalesce("m", "s") - F.col("s0")) - SHARE * F.coalesce("lost", F.lit(0.0))))
        )
        new = materialize(new.select("rec", "clu", "s0", "b", "d", F.col("s").alias("old"), F.col("new").alias("s")), f"p1-score-{n}")
        now = new.drop("old")
        if new.where(F.abs(F.col("s") - F.col("old")) > STABLE).limit(1).count() == 0:
            return now
    raise RuntimeError(f"scores have not settled after {ROUNDS} rounds")


def accepted(scores: DataFrame) -> DataFrame:
    """rec, clu, confidence of the matches."""
    best = scores.groupBy("rec").agg(F.max("s").alias("top"))
    near_best = scores.join(best, "rec").where(f"s >= {ACCEPT} AND s >= top - 0.1")
    years = near_best.groupBy("rec").agg(F.count_distinct("b").alias("nb"), F.count_distinct("d").alias("nd"))
    return near_best.join(years.where("nb <= 1 AND nd <= 1"), "rec").select("rec", "clu", F.round("s", 4).alias("confidence"))


def link(forms: DataFrame, works: DataFrame, relations: DataFrame | None = None) -> DataFrame:
    """record_id, viaf_id, confidence; ``works`` (node, work) and ``relations`` (node, target) are further evidence."""
    attrs = materialize(attributes(forms, works), "p1-attributes")
    nodes = materialize(described(forms), "p1-nodes")
    edges = materialize(scored(candidates(attrs, works, nodes.count()), nodes), "p1-scored")
    scores = propagated(edges, attrs, neighbour_keys(forms, works, relations))
    return accepted(scores).select(F.expr("cast(substring(rec, 2) AS bigint)").alias("record_id"), F.expr("substring(clu, 2)").alias("viaf_id"), "confidence")
