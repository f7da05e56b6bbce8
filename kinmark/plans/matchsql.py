"""SQL of the matching cascade, its person names and the groups, for the queries that run beside ours."""

from __future__ import annotations

from kinmark.functions import humanname
from kinmark.plans import sqltext as S


def _list(words: frozenset[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in sorted(words)) + "]"


_T, _S = _list(humanname.TITLES), _list(humanname.SUFFIXES)
_NOT_LETTERS = r"""[!"#$%&''()*+\-./:;<=>?@\[\\\]^_`{|}~0-9]"""


def _join(x: str) -> str:
    return f"array_to_string({x}, ' ')"


def name_quality(pairs: str) -> str:
    """CTEs that end in nq (h, n, quality): the match quality of every distinct pair (h, n) of the CTE ``pairs``."""
    clean = S.compress(rf"strip_accents(regexp_replace({S.strip(r"regexp_replace(t, '[(\[].*?[)\]]', '', 'g')")}, '{_NOT_LETTERS}', ' ', 'g'))")
    suffix, title = f"list_contains({_S}, lower(w))", f"list_contains({_T}, lower(w))"
    leading = f"coalesce(nullif(list_position(list_transform(base, lambda w: {title}), false), 0), len(base) + 1) - 1"
    trailing = f"coalesce(nullif(list_position(list_transform(list_reverse(rest), lambda w: {suffix}), false), 0), len(rest) + 1) - 1"
    return rf"""
np AS (SELECT DISTINCT h, n FROM {pairs} WHERE h IS NOT NULL AND n IS NOT NULL),
n0 AS (SELECT t, regexp_replace({clean}, '[\x00-\x1f\x7f-\x{{9f}}]', '', 'g') AS c FROM (SELECT h AS t FROM np UNION SELECT n FROM np)),
n1 AS (SELECT t, c, list_transform(string_split(c, ','), lambda p: list_filter(string_split(p, ' '), lambda w: w <> '')) AS ps FROM n0),
n2 AS (SELECT t, c, ps, flatten(ps[2:]) AS tail, list_filter(flatten(ps[3:]), lambda w: {title}) AS late FROM n1),
n3 AS (SELECT *, len(list_filter(tail, lambda w: NOT {suffix})) > 0 AS comma, list_filter(tail, lambda w: {suffix}) AS sfx FROM n2),
n4 AS (SELECT *, CASE WHEN comma THEN list_filter(ps[2], lambda w: NOT {suffix}) ELSE ps[1] END AS base FROM n3),
n5 AS (SELECT *, base[{leading} + 1:] AS rest, {_join(f'base[1:{leading}]')} AS lead FROM n4),
n6 AS (SELECT *, CASE WHEN comma THEN 0 ELSE greatest(0, least(len(rest) - 1, {trailing})) END AS k FROM n5),
n7 AS (SELECT *, rest[1:len(rest) - k] AS w FROM n6),
nm AS (SELECT t, c, CASE WHEN lead <> '' THEN lead ELSE {_join('late')} END AS title, coalesce(w[1], '') AS first,
  CASE WHEN comma THEN {_join('ps[1]')} WHEN len(w) > 1 THEN w[len(w)] ELSE '' END AS last, CASE WHEN comma THEN {_join('w[2:]')} ELSE {_join('w[2:len(w) - 1]')} END AS middle,
  len(sfx) > 0 OR k > 0 AS suffixed FROM n7),
nz AS (SELECT *, (title <> '')::INT + (first <> '')::INT + (last <> '')::INT + (middle <> '')::INT + suffixed::INT AS parts FROM nm),
nw AS (SELECT np.h, np.n, jaro_similarity(a.c, b.c) AS whole, a.parts AS ap, b.parts AS bp, a.title AS ta, b.title AS tb, a.first AS af, b.first AS bf, a.middle AS am, b.middle AS bm, a.last AS al, b.last AS bl
  FROM np JOIN nz a ON a.t = np.h JOIN nz b ON b.t = np.n),
nq AS (SELECT h, n, coalesce(CASE
  WHEN ap > 1 AND bp > 1 THEN CASE
    WHEN length(al) <= 1 THEN NULL WHEN al <> bl THEN 0
    WHEN length(af) > 1 AND af = bf THEN CASE
      WHEN am = '' OR bm = '' OR lower(ta) = 'mrs' OR (lower(tb) = 'mrs' AND ta <> tb) THEN NULL
      WHEN length(am) > 1 AND length(bm) > 1 THEN (am = bm)::INT WHEN left(am, 1) <> left(bm, 1) THEN 0 ELSE 0.99 END
    WHEN (length(af) = 1 OR length(bf) = 1) AND length(am) > 1 AND am = bm AND left(af, 1) = left(bf, 1) THEN 1 END
  WHEN ap = 1 AND bp = 1 AND af <> '' AND af = bf THEN 1 END::DOUBLE, CASE WHEN whole >= 0.9 THEN 0.89999 ELSE whole END) AS quality FROM nw)"""


def acceptable(rank: str, auth: str, begin: str, end: str) -> str:
    """The first acceptable of the ten best clusters of each person; ``rank`` are the CTEs that end in k (qid, did, rank)."""
    return f"""{rank}, {auth},
hd AS (SELECT viaf_id, unnest(range(0, len(headings))) AS pos, unnest(headings) AS heading FROM viaf_clusters),
c0 AS (SELECT k.qid, k.did, k.rank, o.name, {begin} AS qf, {end} AS qt FROM k JOIN original_records o ON o.id = k.qid JOIN a ON a.viaf_id = k.did WHERE k.rank <= 10),
c1 AS (SELECT c0.qid, c0.did, c0.rank, hd.pos, coalesce(qf = 3 AND qt = 3 AND hd.pos = 0 AND starts_with(name, substr(heading, 1, 5)), false) AS sure, strip_accents(heading) AS h, strip_accents(name) AS n
  FROM c0 JOIN hd ON hd.viaf_id = c0.did WHERE qf <> 0 AND qt <> 0 AND heading IS NOT NULL),
{name_quality('c1')},
c2 AS (SELECT qid, did, rank, -1 AS pos, 1.0::DOUBLE AS quality FROM c1 WHERE sure UNION ALL SELECT qid, did, rank, pos, quality FROM c1 JOIN nq USING (h, n) WHERE NOT sure AND quality >= 0.85),
c3 AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank, pos) AS r FROM c2)
SELECT qid AS record_id, did AS viaf_id, round(quality, 6) AS quality FROM c3 WHERE r = 1"""


AUDIT = f"""
WITH p AS (SELECT o.id AS record_id, o.record_group_id AS group_id, strip_accents(o.name) AS h, strip_accents(v.heading) AS n
  FROM original_records o JOIN record_groups g ON g.id = o.record_group_id JOIN (SELECT viaf_id, unnest(headings) AS heading FROM viaf_clusters) v ON v.viaf_id = g.viaf_id WHERE o.name IS NOT NULL AND v.heading IS NOT NULL),
{name_quality('p')},
b AS (SELECT p.*, nq.quality, row_number() OVER (PARTITION BY record_id ORDER BY nq.quality DESC, n DESC) AS r FROM p JOIN nq USING (h, n))
SELECT record_id, group_id, h AS name, n AS heading, round(quality, 6) AS quality FROM b WHERE r = 1 AND quality < 0.85"""


def in_database(trigrams: str, begin: str, end: str) -> str:
    """The most similar grouped record of every pending record."""
    return f"""
WITH nn AS (SELECT DISTINCT name_norm AS name FROM original_records WHERE name_norm IS NOT NULL),
t AS (SELECT name AS t, {trigrams} AS g FROM nn),
s AS (SELECT a.t AS a, b.t AS b, round(len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))), 6) AS similarity FROM t a JOIN t b ON a.t <> b.t AND len(a.g) > 0 AND least(len(a.g), len(b.g)) > 0.75 * greatest(len(a.g), len(b.g))
  WHERE len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))) > 0.75 UNION ALL SELECT t, t, 1.0 FROM t),
p0 AS (SELECT o.id, x.id AS o_id, s.similarity, o.r_type, o.name_norm AS nn, x.name_norm AS on, strip_accents(x.name) AS h, strip_accents(o.name) AS n, {begin} AS qf, {end} AS qt
  FROM original_records o JOIN s ON s.a = o.name_norm JOIN original_records x ON x.name_norm = s.b AND x.r_type = o.r_type AND x.record_group_id IS NOT NULL WHERE o.record_group_id IS NULL AND x.id <> o.id),
p AS (SELECT * FROM p0 WHERE qf <> 0 AND qt <> 0), pp AS (SELECT h, n FROM p WHERE r_type = 'person'),
{name_quality('pp')},
q AS (SELECT id, o_id, similarity, CASE r_type WHEN 'person' THEN nq.quality WHEN 'corporateBody' THEN jaro_similarity(on, nn) ELSE 1 - abs(length(on) - length(nn)) / (length(on) + length(nn)) END AS quality FROM p LEFT JOIN nq ON nq.h = p.h AND nq.n = p.n),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, o_id) AS r FROM q WHERE quality >= 0.85)
SELECT id AS record_id, o_id AS other_id, round(quality, 6) AS quality FROM b WHERE r = 1""".replace(" AS on,", ' AS "on",').replace("(on, nn)", '("on", nn)').replace("length(on)", 'length("on")')


def cascade(in_group: str, exact_person: str, keyword: str, ngram: str, exact_body: str, body_keyword: str) -> str:
    """Decision of the whole cascade, from the queries of its stages."""
    n = "NULL::BIGINT"
    return f"""
WITH sg AS ({in_group}), sh AS ({exact_person}), sk AS ({keyword}), sn AS ({ngram}), sb AS ({exact_body}), sw AS ({body_keyword}),
pe AS (SELECT id AS record_id FROM original_records WHERE record_group_id IS NULL AND r_type = 'person'), bo AS (SELECT id AS record_id FROM original_records WHERE record_group_id IS NULL AND r_type = 'corporateBody'),
d1 AS (SELECT record_id, 'group' AS stage, 'accept' AS decision, group_id, NULL::VARCHAR AS viaf_id, 1.0::DOUBLE AS quality FROM sg),
d2 AS (SELECT record_id, 'heading', 'accept', {n}, viaf_id, 1.0 FROM sh WHERE record_id NOT IN (SELECT record_id FROM d1)),
d3 AS (SELECT record_id, 'keyword', 'accept', {n}, viaf_id, quality FROM sk WHERE quality > 0.9 AND record_id NOT IN (SELECT record_id FROM d1 UNION ALL SELECT record_id FROM d2)),
d4 AS (SELECT record_id, 'ngram', CASE WHEN quality > 0.9 THEN 'accept' ELSE 'maybe' END, {n}, viaf_id, quality FROM sn WHERE record_id NOT IN (SELECT record_id FROM d1 UNION ALL SELECT record_id FROM d2 UNION ALL SELECT record_id FROM d3)),
d5 AS (SELECT record_id, 'exact', 'accept', group_id, viaf_id, 1.0 FROM sb),
d6 AS (SELECT record_id, 'keyword', CASE WHEN quality >= 0.95 THEN 'accept' ELSE 'maybe' END, {n}, viaf_id, quality FROM sw WHERE record_id NOT IN (SELECT record_id FROM d5)),
dd AS (SELECT * FROM d1 UNION ALL SELECT * FROM d2 UNION ALL SELECT * FROM d3 UNION ALL SELECT * FROM d4 UNION ALL SELECT * FROM d5 UNION ALL SELECT * FROM d6)
SELECT record_id, stage, decision, group_id, viaf_id, quality FROM dd
UNION ALL SELECT record_id, 'none', 'new', {n}, NULL, NULL FROM (SELECT * FROM pe UNION ALL SELECT * FROM bo) WHERE record_id NOT IN (SELECT record_id FROM dd)
UNION ALL SELECT id, 'family', 'new', {n}, NULL, NULL FROM original_records WHERE record_group_id IS NULL AND r_type = 'family'"""


def groups(decisions: str) -> str:
    """Group of every pending record, from the query of the decisions."""
    joins = "coalesce((r_type = 'corporateBody' AND length(name_norm) >= 20) OR (r_type = 'person' AND (length(name_norm) > 30 OR regexp_matches(name_norm, '[0-9]{2}') OR (length(name_norm) > 10 AND (from_date IS NOT NULL OR to_date IS NOT NULL)))), false)"
    return f"""
WITH dc AS ({decisions}),
va AS (SELECT viaf_id, min(id) AS id FROM record_groups WHERE viaf_id IS NOT NULL AND coalesce(g_type, '') <> 'invalid' GROUP BY 1),
r0 AS (SELECT o.id AS record_id, o.r_type, o.name_norm, o.from_date, o.to_date, CASE WHEN dc.decision = 'accept' THEN dc.viaf_id END AS viaf, CASE WHEN dc.decision = 'accept' THEN dc.group_id END AS gid, CASE WHEN dc.decision = 'maybe' THEN dc.viaf_id END AS maybe_viaf_id
  FROM original_records o LEFT JOIN dc ON dc.record_id = o.id WHERE o.record_group_id IS NULL),
r1 AS (SELECT r0.* REPLACE (coalesce(gid, va.id) AS gid) FROM r0 LEFT JOIN va ON va.viaf_id = r0.viaf),
r2 AS (SELECT r1.*, g.viaf_id AS held, CASE WHEN gid IS NOT NULL THEN 'g|' || gid WHEN viaf IS NOT NULL THEN 'v|' || r_type || '|' || viaf
  WHEN {joins} THEN concat_ws('|', 'n', r_type, name_norm, CASE WHEN r_type = 'person' THEN coalesce(cast(year(from_date) AS VARCHAR), '') || '-' || coalesce(cast(year(to_date) AS VARCHAR), '') END) ELSE 'r|' || record_id END AS key FROM r1 LEFT JOIN record_groups g ON g.id = r1.gid),
one AS (SELECT key, min(record_id) AS group_no, min_by(name_norm, record_id) AS group_name, min(coalesce(held, viaf)) AS viaf_id FROM r2 GROUP BY 1)
SELECT r2.record_id, one.group_no, r2.gid AS group_id, one.group_name, one.viaf_id, r2.maybe_viaf_id FROM r2 JOIN one USING (key)"""
