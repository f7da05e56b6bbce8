"""The merged record of each group as one XML text, and the tombstones of cancelled ones.

Every block is built from its field's flat rows: lines with their place in the
block.  The lines of all blocks meet in one aggregation by group, so that a
record costs one shuffle of its text.  What is gathered per group is its merged
result, which the export has to hold as one text anyway.

Edge cases: groups without a block get none; NULL texts are left out; names and
terms are escaped; timestamps come from a parameter, so that equal input gives
equal output.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmark.functions.identifiers import capitalize, escape_attribute, escape_xml, is_country_code
from kinmark.operators import fusion, lineage

NAMESPACES = 'xmlns="urn:isbn:1-931666-33-4" xmlns:xlink="http://www.w3.org/1999/xlink"'


def element(tag: str, text: Column, **attributes: Column) -> Column:
    """An element with escaped text; attributes that are NULL are left out."""
    attrs = [F.coalesce(F.concat(F.lit(f' {name.replace("__", ":")}="'), escape_attribute(value.cast("string")), F.lit('"')), F.lit("")) for name, value in attributes.items()]
    return F.concat(F.lit(f"<{tag}"), *attrs, F.lit(">"), escape_xml(text.cast("string")), F.lit(f"</{tag}>"))


def _lines(df: DataFrame, place: Column, line: Column) -> DataFrame:
    return df.select("group_id", place.cast("double").alias("place"), line.alias("line"))


def control(merged: DataFrame, records: DataFrame, groups: DataFrame, sources: DataFrame, term: str, agency: str, stamp: str) -> DataFrame:
    """Identifiers of merged, split and authority records, status, agency, history and sources."""
    m = merged.where("valid").select("record_group_id", "canonical_id", "id").withColumnRenamed("record_group_id", "group_id")
    own = _lines(m, F.lit(0), element("recordId", F.col("canonical_id")))
    came = lineage.origins(merged).join(m.select("id", "group_id"), "id")
    others = _lines(came, F.lit(1), element("otherRecordId", F.col("other_id"), localType=F.concat(F.lit(term), "relation")))
    parts = records.where("record_group_id IS NOT NULL AND source_id IS NOT NULL").select(F.col("record_group_id").alias("group_id"), "source_id")
    merged_ids = _lines(parts, F.lit(2), element("otherRecordId", F.col("source_id"), localType=F.lit(f"{term}MergedRecord")))
    viaf = groups.where("viaf_id IS NOT NULL").select(F.col("id").alias("group_id"), "viaf_id")
    authority = _lines(viaf, F.lit(3), element("otherRecordId", F.col("viaf_id"), localType=F.lit(f"{term}viafID")))
    fixed = F.concat(F.lit("<maintenanceStatus>revised</maintenanceStatus>"), F.lit(f"<maintenanceAgency><agencyName>{agency}</agencyName></maintenanceAgency>"), F.lit(f'<maintenanceHistory><maintenanceEvent><eventType>revised</eventType><eventDateTime standardDateTime="{stamp}">{stamp}</eventDateTime><agentType>machine</agentType></maintenanceEvent></maintenanceHistory>'))
    status = _lines(m, F.lit(4), fixed)
    from_where = fusion.source_block(sources, groups)
    opened = _lines(from_where.select("group_id").distinct(), F.lit(5), F.lit("<sources>"))
    listed = _lines(from_where, F.lit(6), F.concat(F.lit("<source>"), element("sourceEntry", F.col("source")), F.lit("</source>")))
    closed = _lines(from_where.select("group_id").distinct(), F.lit(7), F.lit("</sources>"))
    return reduce(DataFrame.unionByName, [own, others, merged_ids, authority, status, opened, listed, closed])


def identity(groups: DataFrame, names: DataFrame) -> DataFrame:
    """Types and names of a group, the preferred names first, each with its score, language and sources."""
    types = _lines(groups.select(F.col("id").alias("group_id"), "g_type"), F.lit(-1e6), element("entityType", F.col("g_type")))
    scores = fusion.name_scores(names, "group_id")
    printed = fusion.printed_sources(names, "group_id")
    line = F.concat(F.lit("<"), "form", F.lit(">"), escape_xml(F.col("label")), F.lit("</"), "form", F.lit(">"))
    forms = printed.withColumn("line", line).groupBy("group_id", "name_key").agg(F.array_join(F.sort_array(F.collect_list("line"), asc=False), "").alias("forms"))
    head = names.groupBy("group_id", "name_key").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("name", "lang", "script_code", "use_dates")])
    rows = head.join(scores, ["group_id", "name_key"]).join(forms, ["group_id", "name_key"], "left")
    attrs = [F.coalesce(F.concat(F.lit(f' {a}="'), escape_attribute(F.col(c)), F.lit('"')), F.lit("")) for a, c in (("xml:lang", "lang"), ("scriptCode", "script_code"))]
    text = F.concat(F.lit('<nameEntry preferenceScore="'), F.lpad(F.col("score").cast("string"), 2, "0"), F.lit('"'), *attrs, F.lit(">"), element("part", F.col("name")), F.coalesce("forms", F.lit("")), F.coalesce(element("useDates", F.col("use_dates")), F.lit("")), F.lit("</nameEntry>"))
    return types.unionByName(_lines(rows, -F.col("score"), text))


def description(groups: DataFrame, clusters: DataFrame, records: DataFrame, fields: dict[str, DataFrame], term: str) -> DataFrame:
    """Dates, languages, functions, subjects, places, nationality, gender, occupations and histories of a group."""
    dates = fusion.exist_dates(groups, clusters, records)
    begin = element("fromDate", F.col("from_text"), standardDate=F.col("from_text"), localType=F.concat(F.lit(term), "from_type"))
    end = element("toDate", F.col("to_text"), standardDate=F.col("to_text"), localType=F.concat(F.lit(term), "to_type"))
    lines = [_lines(dates, F.lit(0), F.concat(F.lit("<existDates><dateRange>"), F.coalesce(begin, F.lit("")), F.coalesce(end, F.lit("")), F.lit("</dateRange></existDates>")))]
    a = groups.where("viaf_id IS NOT NULL").select(F.col("id").alias("group_id"), "viaf_id").join(clusters.select("viaf_id", "languages", "nationalities", "gender"), "viaf_id")
    tongues = fusion.languages(a, fields["languages"].withColumnRenamed("term", "code"), "group_id")
    lines.append(_lines(tongues, F.lit(1), F.concat(F.lit('<languageUsed><language languageCode="'), escape_attribute(F.lower("code")), F.lit('"/></languageUsed>'))))
    functions = fusion.untyped_preferred(fields["functions"].where("term IS NOT NULL"), ["group_id", "term"], "local_type", ["record_id", "child_no"])
    lines.append(_lines(functions, F.lit(2), F.concat(F.lit("<function>"), element("term", F.col("term")), F.lit("</function>"))))
    subjects = fusion.subjects(fields["local_descriptions"].where("local_type LIKE '%#AssociatedSubject'"), "group_id", "term")
    lines.append(_lines(subjects, 4 - F.col("n") / (F.col("n") + 1), F.concat(F.lit(f'<localDescription localType="{term}AssociatedSubject">'), element("term", F.col("term")), F.lit("</localDescription>"))))
    lines.append(_lines(fields["places"], F.lit(5), F.concat(F.lit("<place>"), element("placeEntry", F.col("term")), F.lit("</place>"))))
    nations = a.select("group_id", F.explode(F.array_distinct("nationalities")).alias("n"))
    form = F.when(is_country_code(F.col("n")), F.concat(F.lit('<placeEntry countryCode="'), escape_attribute(F.col("n")), F.lit('"/>'))).otherwise(element("term", F.col("n")))
    lines.append(_lines(nations, F.lit(6), F.concat(F.lit(f'<localDescription localType="{term}nationalityOfEntity">'), form, F.lit("</localDescription>"))))
    gender = F.when(F.col("gender") == "a", "Female").when(F.col("gender") == "b", "Male")
    lines.append(_lines(a, F.lit(7), F.concat(F.lit(f'<localDescription localType="{term}gender">'), element("term", gender), F.lit("</localDescription>"))))
    work = fusion.first_wins(fields["occupations"], ["group_id", "term"], ["record_id", "child_no"])
    lines.append(_lines(work, F.lit(8), F.concat(F.lit("<occupation>"), element("term", F.col("term")), F.lit("</occupation>"))))
    cited = fusion.grouped_citations(fields["biographies"].where("biog_text IS NOT NULL"), "group_id", "biog_text", "biog_citation", ["record_id"])
    plain = fields["biographies"].where("biog_data IS NOT NULL").groupBy("group_id", "biog_data").agg(F.min("record_id").alias("record_id"))
    histories = _lines(cited, F.lit(9.1), F.concat("biog_text", F.array_join("citations", ""))).unionByName(_lines(plain, F.lit(9.2), F.col("biog_data")))
    has = histories.select("group_id").distinct()
    lines += [_lines(has, F.lit(9), F.lit("<biogHist>")), histories, _lines(has, F.lit(9.3), F.lit("</biogHist>"))]
    return reduce(DataFrame.unionByName, lines)


def relations(groups: DataFrame, clusters: DataFrame, records: DataFrame, merged: DataFrame, maybes: DataFrame, fields: dict[str, DataFrame], hosts: dict[str, str], term: str) -> DataFrame:
    """Relations of a group, outside addresses, what it may be the same as, resources and the authority's titles.

    Relations to records point to the merged records' identifiers, once each.
    """
    from kinmark.operators.lookup import maybe_edges

    own = fusion.resolved_relations(fields["relations"], records, merged, "group_id")
    lines = [_lines(own, F.lit(0), F.concat(F.lit("<cpfRelation"), *[F.coalesce(F.concat(F.lit(f' xlink:{a}="'), escape_attribute(F.col(a)), F.lit('"')), F.lit("")) for a in ("href", "role", "arcrole")], F.lit(">"), F.coalesce(element("relationEntry", F.col("entry")), F.lit("")), F.lit("</cpfRelation>")))]
    kind = groups.select(F.col("id").alias("group_id"), capitalize(F.col("g_type")).alias("kind"))
    link = lambda arc, entry: F.concat(F.lit(f'<cpfRelation xlink:type="simple" xlink:arcrole="{term}{arc}" xlink:href="'), escape_attribute(F.col("href")), F.lit(f'" xlink:role="{term}'), "kind", F.lit('">'), entry, F.lit("</cpfRelation>"))
    outside = fusion.same_as(groups, clusters, hosts).join(kind, "group_id")
    lines.append(_lines(outside, F.lit(1), link("sameAs", F.lit(""))))
    edges = maybe_edges(merged, groups, maybes).select("id", "other_id").distinct().join(merged.select("id", F.col("record_group_id").alias("group_id")), "id")
    named = merged.where("canonical_id IS NOT NULL AND name IS NOT NULL").select(F.col("id").alias("other_id"), F.col("canonical_id").alias("href"), "name")
    lines.append(_lines(edges.join(named, "other_id").join(kind, "group_id"), F.lit(2), link("mayBeSameAs", element("relationEntry", F.col("name")))))
    resource = lambda entry: F.concat(F.lit(f'<resourceRelation xlink:role="{term}BibliographicResource" xlink:type="simple">'), element("relationEntry", entry), F.lit("</resourceRelation>"))
    lines.append(_lines(fields["resources"].where("entry IS NOT NULL"), F.lit(3), resource(F.col("entry"))))
    titles = groups.where("viaf_id IS NOT NULL").select(F.col("id").alias("group_id"), "viaf_id").join(clusters.select("viaf_id", F.explode("titles").alias("t")), "viaf_id")
    lines.append(_lines(titles, F.lit(4), resource(F.col("t"))))
    return reduce(DataFrame.unionByName, lines)


def combined(blocks: dict[str, DataFrame], merged: DataFrame) -> DataFrame:
    """canonical_id, group_id, record_data: the XML of every valid merged record with an identifier.

    ``blocks``: lines (group_id, place, line) of control, identity, description
    and relations, in this order.  All lines of a group meet once.
    """
    m = merged.where("valid AND canonical_id IS NOT NULL AND record_group_id IS NOT NULL").select(F.col("record_group_id").alias("group_id"), "canonical_id")
    lines = reduce(DataFrame.unionByName, [df.where("line IS NOT NULL").select("group_id", F.lit(n).alias("block"), "place", "line") for n, df in enumerate(blocks.values())])
    gathered = lines.groupBy("group_id").agg(F.sort_array(F.collect_list(F.struct("block", "place", "line"))).alias("l"))
    out = m.join(gathered, "group_id", "left").withColumn("l", F.coalesce("l", F.array().cast("array<struct<block:int,place:double,line:string>>")))

    def part(n: int, tag: str) -> Column:
        own = F.transform(F.filter("l", lambda x: x["block"] == n), lambda x: x["line"])
        return F.when(F.size(own) > 0, F.concat(F.lit(f"<{tag}>"), F.array_join(own, ""), F.lit(f"</{tag}>"))).otherwise("")

    first, *rest = [part(n, tag) for n, tag in enumerate(blocks)]
    text = F.concat(F.lit(f"<eac-cpf {NAMESPACES}>"), first, F.lit("<cpfDescription>"), *rest, F.lit("</cpfDescription></eac-cpf>"))
    return out.select("canonical_id", "group_id", text.alias("record_data"))


def tombstone_texts(merged: DataFrame, previous: DataFrame, term: str, agency: str, stamp: str) -> DataFrame:
    """canonical_id, record_data: the short XML of cancelled records; ``previous`` (id, name) gives their last names."""
    t = lineage.tombstones(merged)
    others = t.where("other_id IS NOT NULL").groupBy("id").agg(F.array_join(F.sort_array(F.collect_list(element("otherRecordId", F.col("other_id"), localType=F.concat(F.lit(term), "relation")))), "").alias("others"))
    one = t.select("id", "canonical_id", "r_type").distinct().join(others, "id", "left").join(previous, "id", "left").where("canonical_id IS NOT NULL")
    history = f"<maintenanceStatus>cancelled</maintenanceStatus><maintenanceAgency><agencyName>{agency}</agencyName></maintenanceAgency><maintenanceHistory><maintenanceEvent><eventType>cancelled</eventType><eventDateTime>{stamp}</eventDateTime><agentType>machine</agentType></maintenanceEvent></maintenanceHistory>"
    text = F.concat(F.lit(f"<eac-cpf {NAMESPACES}><control>"), element("recordId", F.col("canonical_id")), F.coalesce("others", F.lit("")), F.lit(f"{history}</control><cpfDescription><identity>"), element("entityType", F.col("r_type")), F.lit("<nameEntry>"), element("part", F.coalesce("name", F.lit(""))), F.lit("</nameEntry></identity></cpfDescription></eac-cpf>"))
    return one.select("canonical_id", text.alias("record_data"))
