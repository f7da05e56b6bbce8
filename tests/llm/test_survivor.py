"""Skyline selection against brute-force layers."""

import datetime
import random

from pyspark.sql import functions as F

from kinmark.llm import survivor

SCHEMA = "record_group_id bigint, entry_id bigint, name string, sources array<struct<source:string,n_type:string,name_origin:string>>, lang string, use_dates string, updated_at timestamp, n int, cells string"
random.seed(3)


def make(groups):
    rows, e = [], 0
    for g in range(groups):
        for k in range(random.randint(1, 9)):
            e += 1
            src = [(random.choice(["LC", "lc", "LAC", "nla", "x", "y"]), random.choice(["authorized_form", "alternative_form", None]), "cpf") for _ in range(random.randint(0, 3))]
            seen, kept = set(), []
            for s in src:
                if s[0] not in seen:
                    seen.add(s[0])
                    kept.append(s)
            at = datetime.datetime(2020, 1, 1) + datetime.timedelta(hours=random.randint(0, 10**6))
            rows.append((g, e, f"n{e}", random.choice([kept, kept, None]), random.choice(["eng", "", "und", None, "deu"]), random.choice([None, "1900-1950", "b. 1900", "unknown", "12345"]), at, 1, "clash"))
    return rows


def score(src):
    d = {s[0]: s[1] for s in src or []}
    for code, v in (("LC", 99), ("LAC", 98), ("NLA", 97)):
        if (d[code] if code in d else d.get(code.lower())) == "authorized_form":
            return v
    return sum(t == "authorized_form" for t in d.values())


def test_against_plain_rule(spark):
    import re

    rows = make(80)
    got = {(r.record_group_id, r.field_name): r.entry_id for r in survivor.survivors(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {}
    for g in range(80):
        e = [r for r in rows if r[0] == g]
        if len(e) < 2:
            continue
        want[g, "name"] = max(e, key=lambda r: (score(r[3]), r[6]))[1]
        years = lambda r: len(re.findall(r"(?<!\d)\d{4}(?!\d)", r[5] or ""))
        if dated := [r for r in e if years(r)]:
            want[g, "use_dates"] = max(dated, key=lambda r: (years(r), r[6]))[1]
        if tongues := [r for r in e if r[4] not in (None, "", "und")]:
            want[g, "lang"] = max(tongues, key=lambda r: r[6])[1]
    assert got == want


def test_layers_are_longest_chains(spark):
    rows = make(30)
    layered = survivor.layered(survivor.cells(spark.createDataFrame(rows, SCHEMA)))
    for g in layered.collect():
        cells = [c.asDict() for c in g.cells]
        keys = ("at", "score", "years", "has_lang", "has_name")
        above = lambda a, b: a is not b and all(a[k] >= b[k] for k in keys) and any(a[k] > b[k] for k in keys)
        depth = {}

        def layer(i):
            if i not in depth:
                depth[i] = 1 + max((layer(j) for j in range(len(cells)) if above(cells[j], cells[i])), default=0)
            return depth[i]

        assert [layer(i) for i in range(len(cells))] == [c["layer"] for c in cells]


def test_hot_group_is_reduced_to_cells(spark):
    df = spark.range(20000).select(F.lit(1).cast("bigint").alias("record_group_id"), F.col("id").alias("entry_id"), F.lit("n").alias("name"), F.array().cast("array<struct<source:string,n_type:string,name_origin:string>>").alias("sources"), F.lit("eng").alias("lang"), F.lit("1900").alias("use_dates"), F.timestamp_seconds("id").alias("updated_at"))
    assert survivor.cells(df).count() == 1
    assert {r.entry_id for r in survivor.survivors(df.unionByName(df)).collect()} == {19999}


def test_empty_nulls_and_ties(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert survivor.survivors(empty).count() == 0 and survivor.fused(empty).count() == 0
    at = datetime.datetime(2020, 1, 1)
    rows = [(1, 1, None, None, None, None, None, 1, ""), (1, 2, "b", None, "eng", None, at, 1, ""), (1, 3, "c", None, "eng", None, at, 1, ""), (None, 4, "d", None, None, None, at, 1, ""), (2, 5, "e", None, None, None, at, 1, "")]
    got = {(r.record_group_id, r.field_name): r.entry_id for r in survivor.survivors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, "name"): 3, (1, "lang"): 3}
