"""Variant spellings of names that people typed, by suffix blocking.

1. Every name (of a record, of its name entries, of an authority cluster) is
   taken apart into a core, given names or the kind of body, and years.
2. Cores (not records) are blocked by their token suffixes.  All suffixes of
   ``LEAST`` letters and more are counted; a core's block is its shortest suffix
   that at most ``COMMON`` cores share (longer ones would give parts of that
   block).  A suffix that is more common, or shorter, makes no block by itself:
   it is refined with the rest of the core less one letter, so that two cores
   one error apart meet however common their ending is and wherever the error
   lies, whatever the size of the input.  Common suffixes are refined with
   other fields as well, the given name's suffix and the year of birth; there
   two errors may lie between the cores.
3. Pairs inside a block are compared by their longest-common-subsequence ratio.
   It has to leave at most one letter of the longer core unmatched, and that in
   its place or changed for its neighbour; within a block refined with given
   name and year it has to reach ``DATED_RATIO``.  Every spelling follows its
   most frequent neighbour, to the end of the chain.
4. Persons with one family name are told apart by given names (nicknames and
   initials allowed, typing errors by the same ratio) and years; a name that
   fits several persons with different years is linked to none of them.  Bodies
   must agree in kind and unit; a family is its name.
5. Links are closed transitively over records and clusters.

Scale: the pairs of step 3 are pairs of distinct spellings in bounded blocks;
those of step 4 are pairs of distinct (given names, years) of one family name
and initial that share a year, or lack one.  The work is aggregated to distinct
spellings and profiles before anything meets, so repeated rows cost nothing
there; the result's pairs are found between distinct names of an entity, and
rows come back only for these.  Components are labelled by rounds of joins,
written to the shared folder; nothing is gathered in the driver.

Edge cases: NULL, empty and nobody's names ("Anonymous") are never linked;
NULL dates are unknown; repeated records are linked when their names differ
visibly; an empty table gives no rows; a record without entries counts alone.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmark.llm.lookalike import LetterModel
from kinmark.llm.names import LONG_GIVEN, agree, error_keys, formal_names, lcs_ratio, parts_column
from kinmark.operators.grouping import connected_components as components
from kinmark.session import materialize

LEAST = 4
#: Suffixes of longer cores, which would make many keys, are taken up to this length.
LONG = 26
COMMON = 40
RATIO = 0.8
#: For spellings whose bearers share given name and year of birth, two errors may lie between them.
DATED_RATIO = 0.75


def record_names(records: DataFrame, entries: DataFrame) -> DataFrame:
    """node, kind, name, birth_known, death_known, main: names of the given records and of their entries."""
    own = records.select(F.col("id"), F.col("r_type").alias("kind"), "name", F.year("from_date").alias("b"), F.year("to_date").alias("d"))
    more = entries.where("seq_no IS NULL OR seq_no > 1").select(F.col("record_id").alias("id"), F.col("name").alias("other"))
    joined = own.join(more, "id").where("other IS NOT NULL AND NOT other <=> name").dropDuplicates(["id", "other"])
    mains = own.select("id", "kind", "name", "b", "d", F.lit(True).alias("main"))
    others = joined.select("id", "kind", F.col("other").alias("name"), "b", "d", F.lit(False).alias("main"))
    return mains.unionByName(others).select(F.concat(F.lit("r"), "id").alias("node"), "kind", "name", "b", "d", "main")


def cluster_names(clusters: DataFrame) -> DataFrame:
    """The same of authority clusters: headings, authorised and alternative forms."""
    year = lambda c: F.when(F.col(c).rlike(r"^\d{4}"), F.substring(c, 1, 4).cast("int")).otherwise(F.lit(None).cast("int"))
    none = F.array().cast("array<string>")
    names = F.array_distinct(
        F.concat(
            F.coalesce("headings", none),
            F.coalesce(F.transform("auth_forms", lambda x: x["name"]), none),
            F.coalesce(F.transform("alt_forms", lambda x: x["name"]), none),
        )
    )
    is_family = F.exists(names, lambda n: F.lower(n).rlike(r"\bfam(ily)?\b"))
    kind = F.when(F.col("name_type") == "Corporate", "corporateBody").when(is_family, "family").otherwise("person")
    rows = clusters.where("viaf_id IS NOT NULL").select(F.concat(F.lit("v"), "viaf_id").alias("node"), kind.alias("kind"), names.alias("names"), year("birth").alias("b"), year("death").alias("d"))
    return rows.select("node", "kind", F.explode("names").alias("name"), "b", "d", F.lit(False).alias("main"))


def parts(names: DataFrame, model: LetterModel) -> DataFrame:
    """Names taken apart; years stated in a name serve where the row has none."""
    p = names.withColumn("p", parts_column(model, F.col("name"), F.col("kind")))
    return p.select(
        "node", "kind", "main", "p.form", "p.core", "p.core2", "p.first", "p.second", "p.initials",
        F.coalesce("b", "p.birth").alias("b"), F.coalesce("d", "p.death").alias("d"),
    )


def suffix_blocks(cores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(core, key) of the blocks of rare suffixes, and of common or short suffixes refined with the rest of the core."""
    n = F.length("core")
    # a core that is itself a common ending has no rare suffix: its length stands one beyond
    suffixes = cores.select("core", F.explode(F.transform(F.sequence(F.lit(LEAST), F.least(n, F.lit(LONG))), lambda k: F.right("core", k))).alias("suffix"))
    shared = suffixes.groupBy("suffix").agg(F.count("*").alias("df")).where(F.col("df") <= COMMON)
    shortest = suffixes.join(shared, "suffix").groupBy("core").agg(F.min(F.struct(F.length("suffix").alias("r"), "df")).alias("s"))
    found = materialize(cores.select("core").join(shortest, "core", "left").select("core", F.coalesce("s.r", n + 1).alias("r"), F.coalesce("s.df", F.lit(0)).alias("df")), "p4-suffixes")
    rare = found.where("df > 1").select("core", F.concat(F.lit("s|"), F.expr("right(core, r)")).alias("key"))
    # what precedes a suffix shorter than the rare one, less one letter, and that suffix: the core less a letter near its end
    less = F.transform(F.sequence(F.greatest(F.lit(1), n - F.col("r")), n), lambda i: F.concat(F.substring("core", F.lit(1), i - 1), F.substring("core", i + 1, n)))
    ends = F.array(F.concat(F.lit("<"), F.left("core", F.lit(LONG // 2 - 1))), F.concat(F.lit(">"), F.right("core", F.lit(LONG // 2 - 1))))
    none = F.array().cast("array<string>")
    keys = F.concat(F.when(n <= LONG, F.concat(F.array("core"), less)).otherwise(none), F.when(n >= LONG - 2, ends).otherwise(none))
    refined = found.select("core", F.explode(F.array_distinct(keys)).alias("key")).select("core", F.concat(F.lit("r|"), "key").alias("key"))
    return rare, refined


def one_spelling(x: str, y: str, dated: bool) -> bool:
    """Whether two cores are spellings of one, by their longest common subsequence."""
    ratio = lcs_ratio(x, y)
    if dated and ratio >= DATED_RATIO and min(len(x), len(y)) >= 7:
        return True
    if ratio < max(RATIO, 1 - 1 / max(len(x), len(y)) - 1e-9):
        return False
    i = 0
    while i < min(len(x), len(y)) and x[i] == y[i]:
        i += 1
    j = 0
    while j < min(len(x), len(y)) - i and x[-1 - j] == y[-1 - j]:
        j += 1
    p, q = x[i : len(x) - j], y[i : len(y) - j]
    return max(len(p), len(q)) < 2 or p == q[::-1] or len(p) != len(q) and len(p) + len(q) < 4


def spelling_pairs(forms: DataFrame, cores: DataFrame) -> DataFrame:
    """x, y: pairs of cores that are spellings of one."""
    rare, refined = suffix_blocks(cores.where(F.length("core") > LEAST))
    given = F.when(F.length("first") >= LEAST, F.right("first", F.lit(LEAST)))
    person = forms.where((F.col("kind") == "person") & (F.length("core") > LEAST) & F.col("b").isNotNull() & given.isNotNull())
    halves = F.explode(F.array(F.concat(F.lit("<"), F.substring("core", 1, 3)), F.concat(F.lit(">"), F.right("core", F.lit(LEAST)))))
    dated = person.select("core", given.alias("g"), "b", halves.alias("half")).select("core", F.concat_ws("|", F.lit("g"), "g", "b", "half").alias("key"))
    keys = rare.unionByName(refined).unionByName(dated).distinct()
    a, b = keys.alias("a"), keys.alias("b")
    pairs = a.join(b, "key").where(F.col("a.core") < F.col("b.core")).select(F.col("a.core").alias("x"), F.col("b.core").alias("y"), F.col("key").startswith("g|").alias("dated"))
    pairs = pairs.groupBy("x", "y").agg(F.max("dated").alias("dated"))

    @F.pandas_udf("boolean")
    def same(x: pd.Series, y: pd.Series, dated: pd.Series) -> pd.Series:
        return pd.Series([one_spelling(p, q, bool(t)) for p, q, t in zip(x, y, dated, strict=True)], dtype=bool)

    return pairs.where(same("x", "y", "dated")).select("x", "y")


def spelling_classes(forms: DataFrame) -> DataFrame:
    """core, cls: each spelling of a core and the spelling it follows, to the end of the chain."""
    cores = forms.where("core IS NOT NULL").groupBy("core").agg(F.countDistinct("node").alias("n"))
    cores = materialize(cores, "p4-cores")
    alike = spelling_pairs(forms, cores)
    both = alike.unionByName(alike.select(F.col("y").alias("x"), F.col("x").alias("y")))
    sizes = cores.select(F.col("core").alias("y"), F.col("n").alias("ny"))
    best = both.join(sizes, "y").groupBy("x").agg(F.max(F.struct("ny", "y")).alias("up"))
    at = cores.join(best, cores["core"] == best["x"], "left").select(
        "core", F.when(F.struct(F.col("up.ny"), F.col("up.y")) > F.struct("n", "core"), F.col("up.y")).otherwise(F.col("core")).alias("cls")
    )
    at = materialize(at, "p4-parents")
    while True:  # every round halves the way to the end of a chain; a chain has an end, as it only leads to more frequent spellings
        up = at.where("core <> cls").select(F.col("core").alias("cls"), F.col("cls").alias("further"))
        new = materialize(at.join(up, "cls", "left").select("core", F.coalesce("further", "cls").alias("cls"), F.col("further").isNotNull().alias("moved")), "p4-parents")
        at = new.select("core", "cls")
        if not new.where("moved").limit(1).count():
            return at


def profiles(forms: DataFrame, classes: DataFrame) -> DataFrame:
    """One row for each node and family name of a person, with its fullest given names and its years."""
    two = forms.where("kind = 'person' AND core IS NOT NULL")
    cores = two.select("node", "first", "second", "initials", "b", "d", F.explode(F.array_compact(F.array("core", "core2"))).alias("core"))
    full = F.struct((F.length("first") > 1).alias("x"), (F.length("second") > 0).alias("y"), F.length("second").alias("z"), F.length("first").alias("w"), "first", "second", "initials")
    node_years = forms.groupBy("node").agg(F.min("b").alias("b"), F.min("d").alias("d"))
    rows = cores.drop("b", "d").join(classes, "core").groupBy("node", "cls").agg(F.max(full).alias("g"))
    named = rows.join(node_years, "node").select("node", "cls", "g.first", "g.second", "g.initials", "b", "d")
    return named.withColumn("vertex", F.xxhash64(F.lit("person"), "cls", "first", "second", F.coalesce("b", F.lit(0)), F.coalesce("d", F.lit(0))))


def compared(prof: DataFrame) -> DataFrame:
    """Pairs of distinct profiles of one family name that may be one person: v, w, rank and the years of w.

    Profiles with years meet by year.  One without meets those that have a
    formal given name in common, or one letter left out, or of whose given name
    only the initial is known; the initial of two full given names, which would
    make one block of a hot family name, is a key for long ones only, between
    which several errors may lie.
    """
    p = prof.select("vertex", "cls", "first", "second", "initials", "b", "d").dropDuplicates(["vertex"])
    by_letter = p.withColumn("i", F.explode(F.split("initials", "")))
    keyed = by_letter.where("i <> ''")
    key = lambda kind, year: F.xxhash64("cls", "i", F.lit(kind), year)
    dated = keyed.select("*", F.explode(F.array_compact(F.array(F.when(F.col("b").isNotNull(), key("b", "b")), F.when(F.col("d").isNotNull(), key("d", "d"))))).alias("key"))
    cols = ["vertex", "first", "second", "b", "d"]
    left = lambda df: df.select("key", *[F.col(c).alias(f"{c}_v") for c in cols])
    right = lambda df: df.select("key", *[F.col(c).alias(f"{c}_w") for c in cols])
    same_year = left(dated).join(right(dated), "key").where("vertex_v < vertex_w")
    size = F.length("first")
    tagged = lambda df, tag, value: df.withColumn("key", F.xxhash64(F.lit(tag), "cls", value))
    full, short = keyed.where(size > 1), keyed.where(size == 1)
    given = p.where(size > 1).withColumn("formals", formal_names(F.col("first")))
    named = given.withColumn("x", F.explode("formals"))
    erring = given.withColumn("x", F.explode(error_keys(F.col("first"))))
    alike = [tagged(named, "f", "x").drop("formals", "x"), tagged(erring, "e", "x").drop("formals", "x"), tagged(full.where(size >= LONG_GIVEN), "l", "i").drop("i")]
    alike = reduce(DataFrame.unionByName, [df.select("key", *cols) for df in alike])
    undated = F.col("b").isNull() & F.col("d").isNull()
    meetings = [(alike.where(undated), alike), (tagged(short, "i", "i").where(undated), tagged(keyed, "i", "i")), (tagged(full, "s", "i").where(undated), tagged(short, "s", "i"))]
    lacking = reduce(DataFrame.unionByName, [left(v).join(right(w), "key") for v, w in meetings]).where("vertex_v <> vertex_w")
    # of two without years each pair stays once, whichever came first
    swapped = F.col("b_w").isNull() & F.col("d_w").isNull() & (F.col("vertex_v") > F.col("vertex_w"))
    lacking = lacking.select("key", *[F.when(swapped, F.col(f"{c}_{y}")).otherwise(F.col(f"{c}_{x}")).alias(f"{c}_{x}") for x, y in ("vw", "wv") for c in cols])
    pairs = same_year.unionByName(lacking).drop("key")
    pairs = pairs.where("coalesce(b_v <> b_w, false) = false AND coalesce(d_v <> d_w, false) = false").dropDuplicates(["vertex_v", "vertex_w"])

    @F.pandas_udf("int")
    def rank(fv: pd.Series, fw: pd.Series, sv: pd.Series, sw: pd.Series) -> pd.Series:
        known: dict[tuple, int] = {}
        out = []
        for k in zip(fv, fw, sv, sw, strict=True):
            if k not in known:
                a, b = agree(k[0], k[1]), agree(k[2], k[3])
                known[k] = 0 if a < 0 or b < 0 else 1 + 2 * (a == 2) + (b > 0) + (b == 2)
            out.append(known[k])
        return pd.Series(out, dtype="int32")

    years = F.coalesce((F.col("b_v") == F.col("b_w")).cast("int"), F.lit(0)) + F.coalesce((F.col("d_v") == F.col("d_w")).cast("int"), F.lit(0))
    ranked = pairs.withColumn("r", rank("first_v", "first_w", "second_v", "second_w")).where("r > 0")
    return ranked.select("vertex_v", "vertex_w", (F.col("r") + 5 * years).alias("rank"), "b_v", "d_v", "b_w", "d_w")


def same_person(pairs: DataFrame) -> DataFrame:
    """v, w: the pairs of profiles that are one person; a profile that fits several persons equally well is linked to none."""
    turned = pairs.select(F.col("vertex_w").alias("vertex_v"), F.col("vertex_v").alias("vertex_w"), "rank", F.col("b_w").alias("b_v"), F.col("d_w").alias("d_v"), F.col("b_v").alias("b_w"), F.col("d_v").alias("d_w"))
    both = pairs.unionByName(turned)
    top = both.groupBy("vertex_v", "rank").agg(F.first("b_v").alias("b_v"), F.first("d_v").alias("d_v"), F.min("b_w").alias("b0"), F.max("b_w").alias("b1"), F.min("d_w").alias("d0"), F.max("d_w").alias("d1"))
    # the best rank that says anything of years decides which years are the profile's
    telling = (F.col("b0").isNotNull() & F.col("b_v").isNull()) | (F.col("d0").isNotNull() & F.col("d_v").isNull())
    best = top.groupBy("vertex_v").agg(F.max_by(F.struct("b0", "b1", "d0", "d1"), F.when(telling, F.col("rank"))).alias("y"), F.first("b_v").alias("b_v"), F.first("d_v").alias("d_v"))
    verdict = best.select(
        "vertex_v",
        F.coalesce("b_v", F.when(F.col("y.b0") == F.col("y.b1"), F.col("y.b0"))).alias("b"),
        F.coalesce("d_v", F.when(F.col("y.d0") == F.col("y.d1"), F.col("y.d0"))).alias("d"),
        (F.coalesce(F.col("b_v").isNull() & (F.col("y.b0") < F.col("y.b1")), F.lit(False)) | F.coalesce(F.col("d_v").isNull() & (F.col("y.d0") < F.col("y.d1")), F.lit(False))).alias("torn"),
    )
    v = verdict.select("vertex_v", F.col("b").alias("bv"), F.col("d").alias("dv"), F.col("torn").alias("tv"))
    w = verdict.select(F.col("vertex_v").alias("vertex_w"), F.col("b").alias("bw"), F.col("d").alias("dw"), F.col("torn").alias("tw"))
    kept = pairs.join(v, "vertex_v").join(w, "vertex_w")
    fits = "NOT tv AND NOT tw AND coalesce(bv = bw, true) AND coalesce(dv = dw, true)"
    return kept.where(fits).select(F.col("vertex_v").alias("v"), F.col("vertex_w").alias("w"))


def entities(forms: DataFrame) -> DataFrame:
    """node, component of all records and clusters that have a name."""
    classes = materialize(spelling_classes(forms), "p4-classes")
    prof = materialize(profiles(forms, classes), "p4-profiles")
    pairs = materialize(compared(prof), "p4-compared")
    person_edges = same_person(pairs).select(F.col("v").alias("a"), F.col("w").alias("b"))
    node_id = F.xxhash64(F.lit("node"), "node")
    member = prof.select(node_id.alias("a"), F.col("vertex").alias("b"))
    others = forms.where("kind <> 'person' AND core IS NOT NULL").join(classes, "core").select(node_id.alias("a"), F.xxhash64("kind", "cls", "first", "second").alias("b")).distinct()
    labelled = components(person_edges.unionByName(member).unionByName(others), "p4-cc")
    nodes = forms.select("node").distinct().withColumn("id", node_id)
    return nodes.join(labelled, "id").select("node", "component")


def conflict(x: str, y: str) -> Column:
    """Both years known and different."""
    return F.coalesce(F.col(x) != F.col(y), F.lit(False))


def linked_pairs(forms: DataFrame, component: DataFrame) -> DataFrame:
    """record_a, record_b: records of one entity whose names differ visibly.

    Distinct (name, years) of an entity meet, not its records: a name borne by a
    million of them is one row until it is part of the result.
    """
    mains = forms.where("main AND core IS NOT NULL").select("node", "kind", "form", "b", "d")
    rows = mains.join(component, "node").select("component", "kind", "form", "b", "d", F.expr("cast(substring(node, 2) as bigint)").alias("id"))
    rows = materialize(rows.withColumn("variant", F.xxhash64("component", "kind", "form", F.coalesce("b", F.lit(0)), F.coalesce("d", F.lit(0)))), "p4-rows")
    variant = rows.groupBy("variant").agg(*[F.first(c).alias(c) for c in ("component", "kind", "form", "b", "d")])
    side = lambda p: variant.select("component", "kind", *[F.col(c).alias(f"{c}{p}") for c in ("variant", "form", "b", "d")])
    pairs = side("a").join(side("b"), ["component", "kind"]).where("forma < formb").where(~conflict("ba", "bb") & ~conflict("da", "db")).select("varianta", "variantb")
    x = rows.select(F.col("variant").alias("varianta"), F.col("id").alias("x"))
    y = rows.select(F.col("variant").alias("variantb"), F.col("id").alias("y"))
    return pairs.join(x, "varianta").join(y, "variantb").select(F.least("x", "y").alias("record_a"), F.greatest("x", "y").alias("record_b"))


def members(forms: DataFrame, component: DataFrame) -> DataFrame:
    """record_id, entity: the entity of each record that has a name; entities are told by number only."""
    mains = forms.where("main AND core IS NOT NULL").select("node").distinct()
    return mains.join(component, "node").select(F.expr("cast(substring(node, 2) as bigint)").alias("record_id"), F.col("component").alias("entity"))
