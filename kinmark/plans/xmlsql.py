"""SQL that reads the records' and clusters' XML with regular expressions, for the queries that run beside ours."""

from __future__ import annotations

BLANK = r"E' \t\r\n'"


def plain_xml(x: str) -> str:
    """XML text with CDATA escaped, comments, declarations and prefixes of tags removed."""
    escaped = "replace(replace(substr(p, 1, strpos(p, ']]>') - 1), '&', '&amp;'), '<', '&lt;')"
    flat = f"array_to_string(list_transform(string_split({x}, '<![CDATA['), lambda p, i: CASE WHEN i = 1 OR strpos(p, ']]>') = 0 THEN p ELSE {escaped} || substr(p, strpos(p, ']]>') + 3) END), '')"
    return rf"regexp_replace(regexp_replace({flat}, '<!--.*?-->|<\?.*?\?>', '', 'gs'), '(</?)[A-Za-z][\w.-]*:', '\1', 'g')"


def elements(x: str, tag: str) -> str:
    """List of the elements of a name; such as hold none of the same name."""
    return rf"regexp_extract_all({x}, '<{tag}(?:\s[^>]*)?/>|<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>', 0, 's')"


def first(x: str, tag: str) -> str:
    """The first element of a name, or the empty text."""
    return rf"regexp_extract({x}, '<{tag}(?:\s[^>]*)?/>|<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>', 0, 's')"


def unescaped(x: str) -> str:
    """Text with the predefined and the numeric references resolved."""
    rest = "substr(p, strpos(p, ';') + 1)"
    code = r"""CASE WHEN p LIKE 'amp;%' THEN '&' WHEN p LIKE 'lt;%' THEN '<' WHEN p LIKE 'gt;%' THEN '>' WHEN p LIKE 'quot;%' THEN '"' WHEN p LIKE 'apos;%' THEN '''' WHEN p LIKE '#x%' THEN chr(try_cast('0x' || regexp_extract(p, '^#x([0-9A-Fa-f]+);', 1) AS INTEGER)) ELSE chr(try_cast(regexp_extract(p, '^#([0-9]+);', 1) AS INTEGER)) END"""
    return f"CASE WHEN contains({x}, '&') THEN array_to_string(list_transform(string_split({x}, '&'), lambda p, i: CASE WHEN i = 1 THEN p ELSE {code} || {rest} END), '') ELSE {x} END"


def text(x: str) -> str:
    """Trimmed text of an element; NULL if there is none."""
    bare = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    return f"nullif(trim({unescaped(bare)}, {BLANK}), '')"


def attribute(x: str, name: str) -> str:
    """Value of an attribute of an element; NULL if it lacks it."""
    tag = rf"regexp_extract({x}, '^<[^>]*>')"
    found = rf"""coalesce(nullif(regexp_extract({tag}, '\s{name}\s*=\s*"([^"]*)"', 1), ''), nullif(regexp_extract({tag}, '\s{name}\s*=\s*''([^'']*)''', 1), ''))"""
    return unescaped(found)


def well_formed(x: str, root: str) -> str:
    """Whether a text ends with the end of its root element (others are cut off)."""
    return rf"regexp_matches({x}, '</([A-Za-z][\w.-]*:)?{root}\s*>\s*$')"


RECORDS = f"""
x0 AS (SELECT id AS record_id, record_group_id AS group_id, collection_id, {plain_xml('record_data')} AS d FROM original_records WHERE {well_formed('record_data', 'eac-cpf')}),
x AS (SELECT record_id, group_id, collection_id, d, {first('d', 'identity')} AS identity, {first('d', 'description')} AS description, {first('d', 'relations')} AS rel FROM x0)"""


def children(field: str, source: str, tag: str, values: str, keep: str = "true") -> str:
    """CTE of a field's rows: record_id, group_id, child_no from 0 over those kept, and ``values`` of element ``el``."""
    return f"""
{field}_0 AS (SELECT record_id, group_id, unnest({elements(source, tag)}) AS el, generate_subscripts({elements(source, tag)}, 1) AS nth FROM x),
{field}_1 AS (SELECT record_id, group_id, nth, {values} FROM {field}_0),
{field} AS (SELECT * EXCLUDE (nth), row_number() OVER (PARTITION BY record_id ORDER BY nth) - 1 AS child_no FROM {field}_1 WHERE {keep})"""


def _term(tag: str) -> str:
    return text(first("el", tag))


OCCUPATIONS = children("occupations", "description", "occupation", f"{_term('term')} AS term", "term IS NOT NULL")
FUNCTIONS = children("functions", "d", "function", f"{_term('term')} AS term, {attribute('el', 'localType')} AS local_type")
LOCALS = children("locals", "d", "localDescription", f"{_term('term')} AS term, {attribute('el', 'localType')} AS local_type")
PLACES = children("places", "description", "place", f"{_term('placeEntry')} AS term", "term IS NOT NULL")
LANGUAGES = children("languages", "d", "language", f"{attribute('el', 'languageCode')} AS code")
SOURCES = children("sources", first("d", "sources"), "source", f"{_term('sourceEntry')} AS term", "term IS NOT NULL")
_SPAN = text(first("el", "span"))
RELATIONS = children(
    "relations", "rel", "cpfRelation", f"{attribute('el', 'xlink:href')} AS href, {attribute('el', 'xlink:role')} AS role, {attribute('el', 'xlink:arcrole')} AS arcrole, {_term('relationEntry')} AS entry, regexp_replace({_SPAN}, '^recordId: ', '') AS source_id"
)
RESOURCES = children("resources", "rel", "resourceRelation", f"{_term('relationEntry')} AS entry", "entry IS NOT NULL")
_REL = "SELECT record_id, group_id, child_no + 1 AS relation_no, href, role, arcrole, entry, source_id FROM relations"
TARGETS = f"""
rel AS ({_REL}),
one AS (SELECT source_id, min(id) AS target_record, min_by(coalesce(record_group_id, -1), id) AS target_group FROM original_records WHERE source_id IS NOT NULL GROUP BY 1),
mg AS (SELECT record_group_id, count(*) FILTER (WHERE valid) > 0 AS has, min(id) FILTER (WHERE valid) AS mid FROM merged_records WHERE record_group_id IS NOT NULL GROUP BY 1),
m1 AS (SELECT mg.record_group_id, mg.has, m.canonical_id FROM mg LEFT JOIN merged_records m ON m.id = mg.mid)"""
OUTCOME = "CASE WHEN one.target_record IS NULL THEN 'unknown record' WHEN one.target_group = -1 THEN 'no group' WHEN m1.has IS NULL THEN 'no merged record' WHEN NOT m1.has THEN 'no valid record' WHEN m1.canonical_id IS NULL THEN 'no identifier' ELSE 'resolved' END"

FIELDS = {
    "a_subjects": f"WITH {RECORDS}, {LOCALS} SELECT group_id, term, count(*) AS n FROM locals WHERE group_id IS NOT NULL AND local_type LIKE '%#AssociatedSubject' AND term IS NOT NULL AND NOT regexp_full_match(term, '[0-9 -]+') GROUP BY 1, 2",
    "a_places": f"WITH {RECORDS}, {PLACES} SELECT group_id, term, count(*) AS n FROM places WHERE group_id IS NOT NULL GROUP BY 1, 2",
    "a_occupations": f"WITH {RECORDS}, {OCCUPATIONS} SELECT group_id, term, record_id, child_no FROM (SELECT *, row_number() OVER (PARTITION BY group_id, term ORDER BY record_id, child_no) AS n FROM occupations WHERE group_id IS NOT NULL) WHERE n = 1",
    "a_functions": f"WITH {RECORDS}, {FUNCTIONS} SELECT group_id, term, record_id, child_no, local_type FROM (SELECT *, row_number() OVER (PARTITION BY group_id, term ORDER BY local_type IS NOT NULL, record_id, child_no) AS n FROM functions WHERE group_id IS NOT NULL AND term IS NOT NULL) WHERE n = 1",
    "u_languages": f"""WITH {RECORDS}, {LANGUAGES},
a AS (SELECT DISTINCT g.id AS group_id, c.code FROM record_groups g JOIN (SELECT viaf_id, unnest(languages) AS code FROM viaf_clusters) c ON c.viaf_id = g.viaf_id WHERE c.code IS NOT NULL),
r AS (SELECT DISTINCT group_id, trim(code) AS code FROM languages WHERE group_id IS NOT NULL AND code IS NOT NULL)
SELECT group_id, code, 'authority' AS origin FROM a UNION ALL SELECT group_id, code, 'record' FROM r WHERE (group_id, code) NOT IN (SELECT group_id, code FROM a)""",
    "u_relations": f"""WITH {RECORDS}, {RELATIONS}, rel AS ({_REL})
SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY group_id, arcrole, href ORDER BY record_id, relation_no) AS n FROM rel WHERE group_id IS NOT NULL) WHERE n = 1 OR href IS NULL OR arcrole IS NULL""",
    "j_relation_targets": f"""WITH {RECORDS}, {RELATIONS}, {TARGETS},
s AS (SELECT record_id, relation_no, coalesce(source_id, regexp_extract(href, '/id/(.+)$', 1)) AS source_id FROM rel)
SELECT s.record_id, s.relation_no, s.source_id, CASE WHEN {OUTCOME} = 'resolved' THEN m1.canonical_id END AS canonical_id, {OUTCOME} AS outcome
FROM s LEFT JOIN one ON one.source_id = s.source_id LEFT JOIN m1 ON m1.record_group_id = one.target_group WHERE s.source_id <> ''""",
    "u_by_target": f"""WITH {RECORDS}, {RELATIONS}, {TARGETS},
t AS (SELECT rel.*, {OUTCOME} AS outcome, m1.canonical_id FROM rel LEFT JOIN one ON one.source_id = rel.source_id LEFT JOIN m1 ON m1.record_group_id = one.target_group WHERE rel.group_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY group_id, arcrole, href ORDER BY record_id, relation_no) AS n FROM t WHERE source_id IS NULL),
res AS (SELECT *, row_number() OVER (PARTITION BY group_id, coalesce(canonical_id, '') ORDER BY record_id, relation_no) AS n FROM t WHERE source_id IS NOT NULL AND outcome IN ('resolved', 'no identifier'))
SELECT group_id, record_id, relation_no, href, role, arcrole, entry FROM own WHERE n = 1 OR href IS NULL OR arcrole IS NULL
UNION ALL SELECT group_id, record_id, relation_no, href, role, arcrole, entry FROM t WHERE source_id IS NOT NULL AND outcome IN ('unknown record', 'no valid record')
UNION ALL SELECT group_id, record_id, relation_no, coalesce(canonical_id, ''), role, arcrole, entry FROM res WHERE n = 1""",
    "r_sources": f"""WITH {RECORDS}, {SOURCES}, s AS (SELECT group_id, term AS source FROM sources WHERE group_id IS NOT NULL)
SELECT * FROM s UNION ALL SELECT id, 'viaf:' || viaf_id FROM record_groups WHERE viaf_id IS NOT NULL AND id IN (SELECT group_id FROM s)""",
}

CLUSTERS = f"""
y AS (SELECT id, {plain_xml('viaf_record')} AS d FROM record_groups WHERE {well_formed('viaf_record', 'VIAFCluster')}),
z AS (SELECT id, d, {first('d', 'mainHeadings')} AS heads, {first('d', 'x400s')} AS variants, {first('d', 'titles')} AS titles FROM y)"""


def _whole(x: str) -> str:
    """Trimmed text of an element, empty if it has none; NULL if there is no element."""
    return f"CASE WHEN {x} <> '' THEN trim({unescaped(f"regexp_replace({x}, '<[^>]*>', '', 'g')")}, {BLANK}) END"


def _kind(child: str, owner: str, table: str, source: str, tag: str, key: str) -> str:
    """Rows of p2_found of one kind below the record."""
    return f"""SELECT '{owner}' AS owner_table, {'record_id' if table == 'x' else 'id'} AS owner_id, '{child}' AS child, 0 AS parent_no, nth AS child_no, {key} AS child_key FROM (SELECT *, unnest({elements(source, tag)}) AS el, generate_subscripts({elements(source, tag)}, 1) AS nth FROM {table})"""


def _below(child: str, owner: str, table: str, source: str, parent: str, tag: str, key: str) -> str:
    """The same of a kind below another element."""
    inner = f"SELECT *, unnest({elements(source, parent)}) AS up, generate_subscripts({elements(source, parent)}, 1) AS up_no FROM {table}"
    return f"""SELECT '{owner}', {'record_id' if table == 'x' else 'id'}, '{child}', up_no, nth, {key} FROM (SELECT *, unnest({elements('up', tag)}) AS el, generate_subscripts({elements('up', tag)}, 1) AS nth FROM ({inner}))"""


_O, _G = "original_records", "record_groups"
_EL = _whole("el")
NESTED = f"WITH {RECORDS}, {CLUSTERS} " + " UNION ALL ".join(
    [
        *[_kind(c, _O, "x", s, c, _whole(first("el", k))) for c, s, k in (("source", first("d", "sources"), "sourceEntry"), ("nameEntry", "identity", "part"), ("occupation", "description", "term"), ("function", "description", "term"), ("localDescription", "description", "term"), ("place", "description", "placeEntry"), ("resourceRelation", "rel", "relationEntry"))],
        _kind("language", _O, "x", "description", "language", f"trim({attribute('el', 'languageCode')}, {BLANK})"),
        _kind("cpfRelation", _O, "x", "rel", "cpfRelation", f"trim({attribute('el', 'xlink:href')}, {BLANK})"),
        _below("span", _O, "x", "rel", "cpfRelation", "span", _EL),
        _kind("cluster_source", _G, "z", "d", "source", _EL),
        _kind("data", _G, "z", "heads", "data", _whole(first("el", "text"))),
        _below("data_s", _G, "z", "heads", "data", "s", _EL),
        _kind("mainHeadingEl", _G, "z", "heads", "mainHeadingEl", _whole(first("el", "id"))),
        _below("subfield", _G, "z", "variants", "x400", "subfield", _EL),
        _below("x400_s", _G, "z", "variants", "x400", "s", _EL),
        _kind("title", _G, "z", "titles", "text", _EL),
    ]
)


def loaded(name_key: str, begin: str, end: str) -> str:
    """Records as loaded; ``name_key`` of column name, ``begin`` and ``end`` the dates of columns bt and et."""
    dated = lambda tag: rf"list_filter({elements('ex', tag)}, lambda e: regexp_matches(e, '^<{tag}\s+[\w:]+\s*='))[-1]"
    stated = lambda x: f"coalesce({attribute(x, 'standardDate')}, regexp_replace({text(x)}, '^active ', ''))"
    return rf"""WITH {RECORDS},
l0 AS (SELECT record_id AS id, collection_id, {text(first('d', 'recordId'))} AS source_id, {text(first('identity', 'entityType'))} AS r_type, {elements('identity', 'nameEntry')} AS ne, {first('description', 'existDates')} AS ex FROM x),
l1 AS (SELECT *, list_filter(ne, lambda e: {text(first('e', 'part'))} IS NOT NULL) AS ok, {dated('fromDate')} AS f0, {dated('toDate')} AS t, {dated('date')} AS p FROM l0),
l2 AS (SELECT *, coalesce(list_filter(ok, lambda e: regexp_matches(e, '^<nameEntry[^>]*localType="[^"]*#Matchtarget"'))[1], ok[1]) AS one, CASE WHEN f0 IS NULL AND t IS NULL THEN p ELSE f0 END AS f FROM l1),
l3 AS (SELECT id, collection_id, source_id, r_type, {text(first('one', 'part'))} AS name, trim({stated('f')}, {BLANK}) AS bt, {attribute('f', 'localType')} AS from_date_type, trim({stated('t')}, {BLANK}) AS et, {attribute('t', 'localType')} AS to_date_type FROM l2)
SELECT id, collection_id, source_id, r_type, name, {name_key} AS name_norm, {begin} AS from_date, from_date_type, {end} AS to_date, to_date_type FROM l3
WHERE r_type IN ('person', 'corporateBody', 'family') AND name IS NOT NULL AND NOT coalesce(CASE WHEN collection_id = 'nordlach' AND length(name) >= 30 AND regexp_matches(name, '^[^\n]*;[^\n]*;') THEN true
  ELSE length(name) >= 300 OR (length(name) >= 200 AND (length(name) - length(replace(name, ',', '')) > 8 OR length(name) - length(replace(name, ';', '')) > 5)) END, false)"""


_NUMBER = r"regexp_replace(string_split(i, '|')[2], '\s+', ' ', 'g')"
FIELDS["s_cluster_addresses"] = rf"""WITH {CLUSTERS},
h AS (SELECT id, unnest({elements('heads', 'mainHeadingEl')}) AS el FROM z), i AS (SELECT id, {text(first('el', 'id'))} AS i, {text(first('el', 's'))} AS s FROM h),
n AS (SELECT id, CASE WHEN s LIKE 'LC%' THEN 'LC' WHEN s LIKE 'WKP%' THEN 'WKP' END AS source, CASE WHEN i LIKE 'LC%' THEN {_NUMBER} END AS num, CASE WHEN i LIKE 'WKP%' THEN string_split(i, '|')[2] END AS wiki FROM i)
SELECT id, source, CASE WHEN source = 'LC' THEN 'lccn-' || string_split(num, ' ')[1] || coalesce(string_split(num, ' ')[2], '') END AS lccn_wcid, CASE WHEN source = 'LC' THEN replace(num, ' ', '') END AS lccn_lcid, CASE WHEN source = 'WKP' THEN wiki END AS url_id FROM n WHERE source IS NOT NULL"""


def cluster_names(orders: dict[tuple[str, str, str], str]) -> str:
    """Name forms of the clusters; ``orders`` of subfields by (kind, format, tag)."""
    cases = []
    for (kind, form, tag), codes in orders.items():
        joined = f"array_to_string(list_filter(list_transform(string_split('{codes}', ''), lambda c: list_filter(sf, lambda s: s.code = c)[-1].value), lambda v: v IS NOT NULL AND v <> ''), ' ')"
        kinds = "kind = 'corporate'" if kind == "corporate" else "coalesce(kind, '') <> 'corporate'"
        lead = f"CASE WHEN {joined} <> '' THEN ' ' || {joined} ELSE '' END" if (kind, form) == ("corporate", "UNIMARC") else joined
        cases.append(f"WHEN {kinds} AND tag = '{tag}' AND {'' if form == 'UNIMARC' else 'NOT '}coalesce(dtype = 'UNIMARC', false) THEN {lead}")
    return f"""WITH {CLUSTERS},
h AS (SELECT id, unnest({elements('heads', 'data')}) AS el FROM z), h1 AS (SELECT id, {text(first('el', 'text'))} AS name, unnest({elements('el', 's')}) AS s FROM h),
a AS (SELECT id, name, 'authorized_form' AS n_type, array_to_string(list_sort(list_distinct(list({text('s')}))), '|') AS sources FROM h1 WHERE name IS NOT NULL AND {text('s')} IS NOT NULL GROUP BY 1, 2),
v AS (SELECT id, lower({text(first('d', 'nameType'))}) AS kind, unnest({elements('variants', 'x400')}) AS el FROM z),
w AS (SELECT id, kind, {first('el', 'datafield')} AS df FROM v), w1 AS (SELECT id, kind, {attribute('df', 'tag')} AS tag, {attribute('df', 'dtype')} AS dtype, list_transform({elements('df', 'subfield')}, lambda e: {{'code': {attribute('e', 'code')}, 'value': {text('e')}}}) AS sf FROM w WHERE df <> ''),
w2 AS (SELECT DISTINCT id, CASE {' '.join(cases)} ELSE '' END AS name FROM w1)
SELECT id, name, n_type, sources FROM a UNION ALL SELECT id, name, 'alternative_form', 'VIAF' FROM w2 WHERE name <> ''"""


def escaped(x: str) -> str:
    """Text with ampersand and angle brackets escaped."""
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def tombstones(namespaces: str, term: str, agency: str, stamp: str) -> str:
    """The XML of cancelled records."""
    history = f"<maintenanceStatus>cancelled</maintenanceStatus><maintenanceAgency><agencyName>{agency}</agencyName></maintenanceAgency><maintenanceHistory><maintenanceEvent><eventType>cancelled</eventType><eventDateTime>{stamp}</eventDateTime><agentType>machine</agentType></maintenanceEvent></maintenanceHistory>"
    return f"""WITH old AS (SELECT r.record_group_id, arg_min_null(o.name, r.id) AS name FROM removed_references r JOIN original_records o ON o.id = r.original_record_id GROUP BY 1),
nb AS (SELECT invalidates_record_id AS id, CASE WHEN count(*) = 1 THEN 'MergedInto' ELSE 'SplitInto' END AS kind FROM merged_records WHERE invalidates_record_id IS NOT NULL GROUP BY 1),
ot AS (SELECT d.id, string_agg('<otherRecordId localType="{term}' || nb.kind || '">' || {escaped('b.canonical_id')} || '</otherRecordId>', '' ORDER BY {escaped('b.canonical_id')}) AS others FROM merged_records d JOIN merged_records b ON b.invalidates_record_id = d.id JOIN nb ON nb.id = d.id WHERE NOT d.valid AND b.canonical_id IS NOT NULL GROUP BY 1)
SELECT d.canonical_id, '<eac-cpf {namespaces}><control><recordId>' || {escaped('d.canonical_id')} || '</recordId>' || coalesce(ot.others, '') || '{history}</control><cpfDescription><identity><entityType>' || {escaped('d.r_type')} || '</entityType><nameEntry><part>' || {escaped("coalesce(old.name, '')")} || '</part></nameEntry></identity></cpfDescription></eac-cpf>' AS record_data
FROM merged_records d LEFT JOIN ot ON ot.id = d.id LEFT JOIN old ON old.record_group_id = d.record_group_id WHERE NOT d.valid AND d.canonical_id IS NOT NULL"""
