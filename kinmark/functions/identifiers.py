"""Identifiers, codes and escapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefix of the identifiers given to merged records.
ARK = "ark:/"
# Order of subfields in assembled name forms, by format and tag.
SUBFIELD_ORDER = {
    ("person", "MARC21", "400"): "acjbdq",
    ("person", "UNIMARC", "400"): "abcdfg",
    ("corporate", "MARC21", "410"): "abcdeg",
    ("corporate", "MARC21", "411"): "aecdghnq",
    ("corporate", "UNIMARC", "410"): "abcdefgh",
    ("corporate", "UNIMARC", "411"): "abcdefgh",
}


def gender(code: Column) -> Column:
    """Female for a, Male for b, else NULL."""
    return F.when(code == "a", "Female").when(code == "b", "Male")


def lc_number(heading_id: Column) -> Column:
    """The number of ``LC|n  50034079`` with single blanks; NULL for other sources."""
    return F.when(heading_id.startswith("LC"), F.regexp_replace(F.get(F.split(heading_id, r"\|"), F.lit(1)), r"\s+", " "))


def worldcat_id(number: Column) -> Column:
    """``lccn-`` with prefix and number of an LC number."""
    parts = F.split(number, " ")
    return F.concat(F.lit("lccn-"), F.when(F.size(parts) > 1, F.concat(parts[0], F.get(parts, F.lit(1)))).otherwise(parts[0]))


def lc_id(number: Column) -> Column:
    """An LC number without blanks."""
    return F.replace(number, F.lit(" "), F.lit(""))


def wiki_id(heading_id: Column) -> Column:
    """The id of a ``WKP|`` heading; NULL for other sources."""
    return F.when(heading_id.startswith("WKP"), F.get(F.split(heading_id, r"\|"), F.lit(1)))


def escape_xml(c: Column) -> Column:
    """Ampersand and angle brackets escaped."""
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def escape_attribute(c: Column) -> Column:
    """The same with quotes and white space control characters."""
    out = F.replace(escape_xml(c), F.lit('"'), F.lit("&quot;"))
    for ch, to in (("\r", "&#xD;"), ("\n", "&#xA;"), ("\t", "&#x9;")):
        out = F.replace(out, F.lit(ch), F.lit(to))
    return out


def quote_path(c: Column) -> Column:
    """Percent-encoding of a path: blanks as %20, slashes kept."""
    return F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def full_ark(c: Column) -> Column:
    """With the prefix if it lacks it."""
    return F.when(c.startswith(ARK), c).otherwise(F.concat(F.lit(ARK), c))


def ark_file_name(c: Column) -> Column:
    """File name of an identifier: without the prefix, hyphens for slashes."""
    return F.concat(F.replace(F.regexp_replace(c, f"^{ARK}", ""), F.lit("/"), F.lit("-")), F.lit(".xml"))


def file_name_ark(c: Column) -> Column:
    """The identifier of a file name."""
    return F.concat(F.lit(ARK), F.replace(F.regexp_replace(c, r"\.xml$", ""), F.lit("-"), F.lit("/")))


def uri_parts(c: Column) -> list[Column]:
    """Scheme, host, path, query and fragment of an address."""
    return [F.try_parse_url(c, F.lit(p)).alias(a) for p, a in (("PROTOCOL", "scheme"), ("HOST", "host"), ("PATH", "path"), ("QUERY", "query"), ("REF", "fragment"))]


def query_map(c: Column) -> Column:
    """The query of an address as a map."""
    return F.str_to_map(F.try_parse_url(c, F.lit("QUERY")), F.lit("&"), F.lit("="))


def strip_namespaces(xml: Column) -> Column:
    """XML text without namespace declarations and prefixes of tags and attributes."""
    bare = F.regexp_replace(xml, r"""\sxmlns(?::[\w.-]+)?\s*=\s*(?:"[^"]*"|'[^']*')""", "")
    tags = F.regexp_replace(bare, r"(</?)[\w.-]+:(?=[\w.-])", "$1")
    return F.regexp_replace(tags, r"""(\s)[\w.-]+:([\w.-]+\s*=\s*["'])""", "$1$2")


def is_country_code(c: Column) -> Column:
    """Whether a nationality is given as a code: letters only, all capitals."""
    return c.rlike(r"^\p{Lu}+$")


def capitalize(c: Column) -> Column:
    """First letter upper, the rest lower case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def assembled_name(kind: str, dtype: Column, tag: Column, subfields: Column) -> Column:
    """Name form of a variant field from its subfields (array of code, value); the last of equal codes counts.

    Tags of another kind give the empty text.
    """
    last_wins = F.map_from_entries(F.aggregate(subfields, F.array().cast("array<struct<code:string,value:string>>"), lambda acc, x: F.concat(F.filter(acc, lambda y: y["code"] != x["code"]), F.array(F.struct(x["code"].alias("code"), x["value"].alias("value"))))))
    out = F.lit("")
    for (k, d, t), order in SUBFIELD_ORDER.items():
        if k == kind:
            joined = F.array_join(F.filter(F.transform(F.array(*map(F.lit, order)), lambda code: F.get(F.array(last_wins[code]), F.lit(0))), lambda v: v.isNotNull() & (v != "")), " ")
            if k == "corporate" and d == "UNIMARC":
                joined = F.when(joined != "", F.concat(F.lit(" "), joined)).otherwise(joined)
            unimarc = F.coalesce(dtype == "UNIMARC", F.lit(False))
            out = F.when((tag == t) & (unimarc if d == "UNIMARC" else ~unimarc), joined).otherwise(out)
    return out
