"""Nested records to related flat tables by Merkle subtree identities.

Every element of a record's XML is canonicalised and hashed bottom-up: its
digest covers the qualified name, the sorted attributes, the text (trimmed,
unless text and elements are mixed) and the digests of its children in order.
Equal subtrees therefore have equal digests wherever they occur, in one record
or in millions.  Two operators use them:

* ``shred`` gives the children of stated kinds as flat rows: ``objects``, one
  row per distinct digest and kind with its key text, and ``bridge``, one row
  per occurrence with the owner, the digests of parent and child, and both
  ordinals.
* ``store`` keeps everything: one row per distinct subtree with its name,
  attributes, text and the digests of its children, and the root's digest of
  every owner.  ``occurrences_in`` are its bridge rows; ``rebuilt`` makes every
  owner's XML from it again.

Edge cases: NULL or malformed XML gives no row at all; an element without the
expected content gives a row whose ``child_key`` is NULL; an empty table gives
empty tables; repeated owners keep one occurrence per input row; depth is not
limited (no recursion).  Comments, instructions and blanks between elements are
no content.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmark.session import materialize

XLINK_HREF = "{http://www.w3.org/1999/xlink}href"
_BLANK = " \t\r\n"


@dataclass(frozen=True)
class Kind:
    """One kind of child: where it lies below its parent and where its key is.

    ``path`` is relative to the record's root (or to the parent element where
    ``parent`` names another kind).  ``key`` is a path below the element, ``.``
    for the element's own text, or ``@name`` for an attribute.
    """

    name: str
    path: str
    key: str
    parent: str | None = None


#: Children of an archival authority record.
RECORD_KINDS = (
    Kind("source", "control/sources/source", "sourceEntry"),
    Kind("nameEntry", "cpfDescription/identity//nameEntry", "part"),
    Kind("occupation", "cpfDescription/description//occupation", "term"),
    Kind("function", "cpfDescription/description//function", "term"),
    Kind("localDescription", "cpfDescription/description//localDescription", "term"),
    Kind("place", "cpfDescription/description//place", "placeEntry"),
    Kind("language", "cpfDescription/description//language", "@languageCode"),
    Kind("cpfRelation", "cpfDescription/relations/cpfRelation", "@" + XLINK_HREF),
    Kind("span", ".//span", ".", "cpfRelation"),
    Kind("resourceRelation", "cpfDescription/relations/resourceRelation", "relationEntry"),
)

#: Children of an authority cluster; x400 itself is a parent without a key of its own.
CLUSTER_KINDS = (
    Kind("cluster_source", "sources/source", "."),
    Kind("data", "mainHeadings/data", "text"),
    Kind("data_s", "sources/s", ".", "data"),
    Kind("mainHeadingEl", "mainHeadings/mainHeadingEl", "id"),
    Kind("x400", "x400s/x400", "-"),
    Kind("subfield", "datafield/subfield", ".", "x400"),
    Kind("x400_s", "sources/s", ".", "x400"),
    Kind("title", "titles/work/data/text", "."),
)

OCCURRENCE = T.StructType(
    [
        T.StructField("owner_id", T.LongType()),
        T.StructField("child", T.StringType()),
        T.StructField("parent_no", T.IntegerType()),
        T.StructField("child_no", T.IntegerType()),
        T.StructField("parent_hash", T.BinaryType()),
        T.StructField("child_hash", T.BinaryType()),
        T.StructField("is_new", T.BooleanType()),
        T.StructField("child_key", T.StringType()),
    ]
)
_ARROW = pa.schema(
    [
        ("owner_id", pa.int64()),
        ("child", pa.string()),
        ("parent_no", pa.int32()),
        ("child_no", pa.int32()),
        ("parent_hash", pa.binary()),
        ("child_hash", pa.binary()),
        ("is_new", pa.bool_()),
        ("child_key", pa.string()),
    ]
)


def content(e: ET.Element) -> tuple[str, list[str]]:
    """Text of an element and the texts after its children, if there are any; blanks count only where text and elements are mixed."""
    text = e.text or ""
    if not len(e):
        return text.strip(_BLANK), []
    if text.strip(_BLANK) or any(c.tail and c.tail.strip(_BLANK) for c in e):
        return text, [c.tail or "" for c in e]
    return "", []


def digests(root: ET.Element) -> dict[ET.Element, bytes]:
    """Digest of every element, bottom-up."""
    out: dict[ET.Element, bytes] = {}
    for e in reversed(list(root.iter())):
        text, tails = content(e)
        head = e.tag
        if e.attrib:
            head += "".join(f"\x1e{k}\x1d{v}" for k, v in sorted(e.attrib.items()))
        data = f"{head}\x1c{text}".encode()
        if tails:
            data += b"".join([b"\x1b" + out[c] + t.encode() for c, t in zip(e, tails, strict=True)])
        elif len(e):
            data += b"\x1b" + b"\x1b".join([out[c] for c in e])
        out[e] = blake2b(data, digest_size=16).digest()
    return out


def _qualify(path: str, ns: str) -> str:
    return "/".join(p if p in ("", ".", "*") else ns + p for p in path.split("/"))


def _key(e: ET.Element, key: str, ns: str) -> str | None:
    if key == "-":
        return None
    if key[0] == "@":
        value = e.get(key[1:])
    elif key == ".":
        value = "".join(e.itertext())
    else:
        found = e.find(ns + key)
        value = None if found is None else "".join(found.itertext())
    return None if value is None else value.strip(_BLANK)


def occurrences(xml: str, kinds: tuple[Kind, ...]) -> list[tuple]:
    """(child, parent_no, child_no, parent_hash, child_hash, child_key) of one record; [] if malformed.

    The record itself comes first, as child ``#record`` number 1 of no parent.
    """
    try:
        root = ET.fromstring(xml)
    except (ET.ParseError, ValueError):
        return []
    ns = root.tag[: root.tag.index("}") + 1] if root.tag[0] == "{" else ""
    digest = digests(root)
    rows = [("#record", 0, 1, None, digest[root], None)]
    of_kind: dict[str, list[ET.Element]] = {}
    for kind in kinds:
        path = _qualify(kind.path, ns)
        found: list[ET.Element] = []
        parents = of_kind.get(kind.parent, []) if kind.parent else [root]
        for n, parent in enumerate(parents, 1):
            for i, e in enumerate(parent.findall(path), 1):
                rows.append((kind.name, n if kind.parent else 0, i, digest[parent], digest[e], _key(e, kind.key, ns)))
                found.append(e)
        of_kind[kind.name] = found
    return rows


def shred(df: DataFrame, owner_id: str, xml: str, kinds: tuple[Kind, ...], label: str) -> tuple[DataFrame, DataFrame]:
    """``(bridge, objects)`` of the records in column ``xml`` of ``df``.

    bridge: owner_id, child, parent_no, child_no, parent_hash, child_hash.
    objects: child_hash, child, child_key, one row for each distinct object.
    Within a task the content is written with the first occurrence of a digest
    only (a map-side combine); the distinct objects are then one small
    aggregation over those rows.  The parse happens once: both tables read what
    it wrote to the shared folder.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            cols: list[list] = [[] for _ in _ARROW]
            for owner, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for child, parent_no, child_no, up, down, key in occurrences(text, kinds):
                    tagged = down + child.encode()
                    if new := tagged not in seen:
                        if len(seen) > 1_000_000:  # bounds the task's memory; a repeat is merged by the aggregation
                            seen.clear()
                        seen.add(tagged)
                    for col, value in zip(cols, (owner, child, parent_no, child_no, up, down, new, key if new else None), strict=True):
                        col.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW, strict=True)], schema=_ARROW)

    source = df.where(F.col(xml).isNotNull()).select(F.col(owner_id).cast("long").alias("owner_id"), F.col(xml).alias("xml"))
    store = materialize(source.mapInArrow(run, OCCURRENCE), label)
    bridge = store.drop("is_new", "child_key")
    objects = store.where("is_new").groupBy("child_hash", "child").agg(F.max("child_key").alias("child_key"))
    return bridge, objects


def flat_children(bridge: DataFrame, objects: DataFrame) -> DataFrame:
    """Every occurrence with its content: the bridge joined to the distinct objects by digest."""
    return bridge.join(objects, ["child_hash", "child"]).select("owner_id", "child", "parent_no", "child_no", "child_key")


def nested_children(tables: dict[str, tuple[DataFrame, str, str, tuple[Kind, ...]]], hidden: tuple[str, ...] = ("#record", "x400")) -> DataFrame:
    """Flat child rows of several tables: name → (table, id column, XML column, kinds)."""
    parts = []
    for name, (df, owner_id, xml, kinds) in tables.items():
        bridge, objects = shred(df, owner_id, xml, kinds, f"nested-{name}")
        keep = ~F.col("child").isin(*hidden)
        parts.append(flat_children(bridge.where(keep), objects.where(keep)).select(F.lit(name).alias("owner_table"), "*"))
    return reduce(DataFrame.unionByName, parts).select("owner_table", "owner_id", "child", "parent_no", "child_no", "child_key")


SUBTREE = "owner_id bigint, digest binary, tag string, attributes map<string,string>, text string, height int, children array<struct<digest:binary,tail:string>>"
_SUBTREE = pa.schema(
    [
        ("owner_id", pa.int64()), ("digest", pa.binary()), ("tag", pa.string()), ("attributes", pa.map_(pa.string(), pa.string())), ("text", pa.string()), ("height", pa.int32()),
        ("children", pa.list_(pa.struct([("digest", pa.binary()), ("tail", pa.string())]))),
    ]
)


def store(df: DataFrame, owner_id: str, xml: str, label: str) -> tuple[DataFrame, DataFrame]:
    """``(roots, subtrees)`` of the records in column ``xml``: nothing of their content is lost.

    roots: owner_id, digest.  subtrees: digest, tag, attributes, text, height,
    children (digest and following text of each, in order), once for every
    distinct subtree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            rows: list[tuple] = []
            for owner, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    root = ET.fromstring(text)
                except (ET.ParseError, ValueError):
                    continue
                known = digests(root)
                rows.append((owner, known[root], None, None, None, None, None))
                height: dict[ET.Element, int] = {}
                for e, digest in known.items():  # children come first
                    height[e] = 1 + max((height[c] for c in e), default=-1)
                    if digest not in seen:
                        if len(seen) > 1_000_000:  # bounds the task's memory; a repeat is merged by the aggregation
                            seen.clear()
                        seen.add(digest)
                        text, tails = content(e)
                        rows.append((None, digest, e.tag, sorted(e.attrib.items()), text, height[e], [{"digest": known[c], "tail": t} for c, t in zip(e, tails or [""] * len(e), strict=True)]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SUBTREE)], schema=_SUBTREE)

    source = df.where(F.col(xml).isNotNull()).select(F.col(owner_id).cast("long").alias("owner_id"), F.col(xml).alias("xml"))
    rows = materialize(source.mapInArrow(run, SUBTREE), label)
    roots = rows.where("tag IS NULL").select("owner_id", "digest")
    subtrees = rows.where("tag IS NOT NULL").drop("owner_id").groupBy("digest").agg(*[F.first(c).alias(c) for c in ("tag", "attributes", "text", "height", "children")])
    return roots, subtrees


def occurrences_in(subtrees: DataFrame) -> DataFrame:
    """parent, ordinal (from 1), child: the bridge rows of the distinct subtrees."""
    return subtrees.select(F.col("digest").alias("parent"), F.posexplode("children").alias("n", "c")).select("parent", (F.col("n") + 1).alias("ordinal"), F.col("c.digest").alias("child"))


def _escaped(c: Column, quote: bool = False) -> Column:
    pairs = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")] + ([('"', "&quot;"), ("\n", "&#10;"), ("\t", "&#9;")] if quote else [])
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def rebuilt(roots: DataFrame, subtrees: DataFrame, label: str) -> DataFrame:
    """owner_id, xml: every record's XML made of its distinct subtrees, level by level from the leaves.

    A subtree's text is made once, however many records hold it; every element
    declares its own namespace.
    """
    local = lambda c: F.regexp_extract(c, r"^(?:\{[^}]*\})?(.*)$", 1)
    space = lambda c: F.regexp_extract(c, r"^\{([^}]*)\}", 1)
    xml_space = "http://www.w3.org/XML/1998/namespace"

    def attribute(a: Column, i: Column) -> Column:
        name, value = a["key"], F.concat(F.lit('="'), _escaped(a["value"], quote=True), F.lit('"'))
        prefix = F.concat(F.lit("a"), i.cast("string"))
        own = F.concat(F.lit(" xmlns:"), prefix, F.lit('="'), _escaped(space(name), quote=True), F.lit('" '), prefix, F.lit(":"), local(name), value)
        return F.when(space(name) == "", F.concat(F.lit(" "), name, value)).when(space(name) == xml_space, F.concat(F.lit(" xml:"), local(name), value)).otherwise(own)

    declared = F.concat(F.lit(' xmlns="'), _escaped(space("tag"), quote=True), F.lit('"'))
    begin = F.concat(F.lit("<"), local("tag"), declared, F.array_join(F.transform(F.map_entries("attributes"), attribute), ""), F.lit(">"), _escaped(F.col("text")))
    parts = materialize(subtrees.select("digest", "height", "children", begin.alias("begin"), F.concat(F.lit("</"), local("tag"), F.lit(">")).alias("end")), f"{label}-parts")
    highest = parts.agg(F.max("height")).first()[0]
    texts = [materialize(parts.where("height = 0").select("digest", F.concat("begin", "end").alias("xml")), f"{label}-0")]
    for h in range(1, (highest or 0) + 1):
        level = parts.where(F.col("height") == h)
        below = level.select("digest", F.posexplode("children").alias("n", "c")).select("digest", "n", F.col("c.digest").alias("child"), "c.tail")
        known = reduce(DataFrame.unionByName, texts).select(F.col("digest").alias("child"), "xml")
        inner = below.join(known, "child").groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("n", F.concat("xml", _escaped(F.col("tail"))).alias("xml")))).alias("l"))
        made = level.select("digest", "begin", "end").join(inner, "digest").select("digest", F.concat("begin", F.array_join(F.transform("l", lambda x: x["xml"]), ""), "end").alias("xml"))
        texts.append(materialize(made, f"{label}-{h}"))
    return roots.join(reduce(DataFrame.unionByName, texts), "digest").select("owner_id", "xml")
