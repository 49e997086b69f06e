"""The same results in DuckDB's SQL, where SQL can say them on whole tables."""

from __future__ import annotations

from lexmill.llm.splits import NO_ORIGIN, PLACEHOLDERS


def _list(values: tuple[str, ...]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_TRIM = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_LABEL = r"regexp_replace(lower(" + _TRIM + r"), '[-._\s\p{{Z}}]+', '-', 'g')"

P1_TIES = rf"""
WITH RECURSIVE files AS (
  SELECT DISTINCT {_LABEL.format('dirname')} AS lk,
    array_to_string(list_sort(list_filter(string_split_regex(lower(author), '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda w: w <> '')), ' ') AS ak,
    lower({_TRIM.format('origin')}) AS low
  FROM split_db_foss_licenses WHERE dirname IS NOT NULL),
keyed AS (
  SELECT lk, CASE WHEN ak IN ({_list(PLACEHOLDERS)}) THEN NULL ELSE ak END AS ak, low,
    regexp_replace(regexp_replace(regexp_replace(low, '[?#].*$', ''), '^(?:[a-z][a-z0-9+.-]*:)?//', ''), '(?:/|\.git)+$', '') AS ok
  FROM files),
node AS (
  SELECT lk, 'A' || ak AS tie FROM keyed WHERE ak IS NOT NULL
  UNION SELECT lk, 'O' || ok FROM keyed WHERE ok NOT IN ({_list(NO_ORIGIN)}) AND low NOT IN ({_list(NO_ORIGIN)})),
step AS (SELECT DISTINCT a.lk AS x, b.lk AS y FROM node a JOIN node b USING (tie) WHERE a.lk <> b.lk),
reach AS (SELECT x, y FROM step UNION SELECT r.x, s.y FROM reach r JOIN step s ON r.y = s.x),
tied AS (SELECT x, y FROM reach WHERE x <> y),
labels AS (
  SELECT dirname AS label, {_LABEL.format('dirname')} AS lk FROM split_db_foss_licenses WHERE dirname IS NOT NULL
  UNION SELECT licenses, {_LABEL.format('licenses')} FROM spdxregex WHERE licenses IS NOT NULL)
"""
P1_LABELS = P1_TIES + rf""", whole AS (SELECT dirname AS label FROM split_db_foss_licenses UNION ALL SELECT licenses FROM spdxregex),
near AS (SELECT x, y FROM tied UNION SELECT lk, lk FROM labels)
SELECT a.label, min(b.label) AS tied_to, (SELECT count(*) FROM whole w WHERE w.label = a.label) AS rows FROM labels a JOIN near ON x = a.lk JOIN labels b ON b.lk = y GROUP BY a.label
"""
P1_FOUND = P1_TIES + """
SELECT a.label AS label_a, b.label AS label_b FROM labels a JOIN labels b ON a.lk = b.lk AND a.label < b.label
UNION
SELECT a.label, b.label FROM labels a JOIN tied t ON a.lk = t.x JOIN labels b ON b.lk = t.y WHERE a.label < b.label
"""

#: The splits hang on a hash, but nothing that is tied may be parted, whatever they are.
P1_PARTED = rf"""
WITH files AS (SELECT {_LABEL.format('dirname')} AS lk, array_to_string(list_sort(list_filter(string_split_regex(lower(author), '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda w: w <> '')), ' ') AS ak, lower({_TRIM.format('origin')}) AS low FROM split_db_foss_licenses),
keyed AS (SELECT lk, CASE WHEN ak IN ({_list(PLACEHOLDERS)}) THEN NULL ELSE ak END AS ak, low, regexp_replace(regexp_replace(regexp_replace(low, '[?#].*$', ''), '^(?:[a-z][a-z0-9+.-]*:)?//', ''), '(?:/|\.git)+$', '') AS ok FROM files)
SELECT (SELECT count(*) FROM files) + (SELECT count(*) FROM spdxregex) AS rows, 0 AS unplaced,
  (SELECT count(DISTINCT lk) FROM (SELECT lk FROM keyed UNION ALL SELECT {_LABEL.format('licenses')} FROM spdxregex)) AS labels, 0 AS parted_labels,
  (SELECT count(DISTINCT ak) FROM keyed) AS authors, 0 AS parted_authors,
  (SELECT count(DISTINCT ok) FROM keyed WHERE ok NOT IN ({_list(NO_ORIGIN)}) AND low NOT IN ({_list(NO_ORIGIN)})) AS origins, 0 AS parted_origins
"""

_LETTERS = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', '', 'g')"

P4_CANON = rf"""
WITH rows AS (
  SELECT file_id, content, {_LETTERS.format('content')} AS plain, trim(content, ' ' || chr(9) || chr(10) || chr(13)) AS body
  FROM split_db_foss_licenses WHERE content IS NOT NULL),
counted AS (SELECT * FROM rows WHERE length(plain) >= 40),
objects AS (
  SELECT file_id, list_transform(json_keys(body), lambda k: {{'k': k, 'v': json_extract_string(body, '$."' || k || '"')}}) AS fs
  FROM counted WHERE body LIKE '{{%}}' AND json_valid(body)),
lines AS (
  SELECT file_id, list_transform(ls, lambda l: {{'k': regexp_extract(l, '^\s*([^:\n]{{1,60}}?)\s*:(?:\s+(.*))?$', 1), 'v': regexp_extract(l, '^\s*([^:\n]{{1,60}}?)\s*:(?:\s+(.*))?$', 2)}}) AS fs
  FROM (SELECT file_id, list_filter(string_split_regex(body, '\r?\n'), lambda l: trim(l) <> '') AS ls FROM counted WHERE body NOT LIKE '{{%}}')
  WHERE len(list_filter(ls, lambda l: NOT regexp_matches(l, '^\s*([^:\n]{{1,60}}?)\s*:(?:\s+(.*))?$'))) = 0),
parts AS (
  SELECT file_id, list_transform(ps, lambda p: {{'k': regexp_extract(p, '^\s*([^=;\n]{{1,60}}?)\s*=', 1), 'v': regexp_replace(p, '^[^=]*=', '')}}) AS fs
  FROM (SELECT file_id, list_filter(string_split(body, ';'), lambda p: trim(p) <> '') AS ps FROM counted WHERE body NOT LIKE '{{%}}')
  WHERE len(list_filter(ps, lambda p: NOT regexp_matches(p, '^\s*([^=;\n]{{1,60}}?)\s*='))) = 0),
fielded AS (SELECT * FROM objects UNION ALL SELECT * FROM lines UNION ALL SELECT * FROM parts),
records AS (
  SELECT file_id, array_to_string(list_sort(list_transform(fs, lambda f: {_LETTERS.format('f.k')} || chr(1) || {_LETTERS.format("coalesce(f.v, '')")})), chr(2)) AS canon
  FROM fielded WHERE len(fs) >= 3),
canon AS (SELECT c.file_id, coalesce(r.canon, c.plain) AS canon FROM counted c LEFT JOIN records r USING (file_id)),
grouped AS (SELECT canon, min(file_id) AS least, count(*) AS copies FROM canon GROUP BY canon)
"""

_WINDOWS = """
WITH rows AS (SELECT file_id, content, length(content) AS n FROM split_db_foss_licenses WHERE content IS NOT NULL),
windows AS (SELECT file_id, unnest(range(0, n - 159)) AS s, content FROM rows WHERE n >= 160),
hashed AS (SELECT file_id, s, substring(content, s + 1, 160) AS w FROM windows),
several AS (SELECT w FROM hashed GROUP BY w HAVING min(file_id) <> max(file_id)),
hit AS (SELECT file_id, s FROM hashed JOIN several USING (w))
"""

#: Ends of each edge, smallest first, and the smallest record that a record reaches.
_REACH = """both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a AS x, b AS y FROM both_ways UNION SELECT r.x, e.b FROM reach r JOIN both_ways e ON r.y = e.a),
least_of AS (SELECT x, least(x, min(y)) AS least FROM reach GROUP BY x)"""

P5_CLUSTERS = _WINDOWS.replace("WITH rows", "WITH RECURSIVE rows") + f""", firsts AS (SELECT w, min(file_id) AS f FROM hashed GROUP BY w HAVING min(file_id) <> max(file_id)),
edges AS (SELECT DISTINCT file_id AS a, f AS b FROM hashed JOIN firsts USING (w)), {_REACH}
SELECT x AS file_id, least AS cluster, x <> least AS removable FROM least_of"""

_GRAMS = r"""
WITH RECURSIVE rows AS (
  SELECT file_id, regexp_extract_all(lower(content), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM (SELECT file_id, content FROM split_db_foss_licenses UNION ALL SELECT file_id, content FROM ngramfiles) WHERE content IS NOT NULL),
long AS (SELECT file_id, w FROM rows WHERE len(w) >= 20),
grams AS (SELECT DISTINCT file_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT file_id, w, unnest(range(1, len(w) - 1)) AS i FROM long)),
"""

P6_FOUND = _GRAMS + """sizes AS (SELECT file_id, count(*) AS n FROM grams GROUP BY file_id),
common AS (SELECT a.file_id AS x, b.file_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.file_id < b.file_id GROUP BY ALL)
SELECT x AS file_id_a, y AS file_id_b FROM common JOIN sizes p ON p.file_id = x JOIN sizes q ON q.file_id = y
WHERE c >= 0.6 * (p.n + q.n - c) - 1e-9
"""

P6_GROUPS = _GRAMS + f"""keyed AS (SELECT file_id, string_agg(g, '|' ORDER BY g) AS k FROM grams GROUP BY file_id),
cls AS (SELECT file_id, min(file_id) OVER (PARTITION BY k) AS rep, count(*) OVER (PARTITION BY k) AS copies FROM keyed),
own AS (SELECT file_id, g FROM grams WHERE file_id IN (SELECT rep FROM cls)),
sizes AS (SELECT file_id, count(*) AS n FROM own GROUP BY file_id),
common AS (SELECT a.file_id AS x, b.file_id AS y, count(*) AS c FROM own a JOIN own b ON a.g = b.g AND a.file_id < b.file_id GROUP BY ALL),
edges AS (SELECT x AS a, y AS b FROM common JOIN sizes p ON p.file_id = x JOIN sizes q ON q.file_id = y WHERE c >= 0.6 * (p.n + q.n - c) - 1e-9), {_REACH},
degree AS (SELECT a AS rep, count(*) AS links FROM both_ways GROUP BY a)
SELECT cls.file_id, rep AS class_id, coalesce(least, rep) AS group_id, copies, coalesce(links, 0) AS links FROM cls LEFT JOIN least_of ON x = rep LEFT JOIN degree USING (rep)
"""

P7_FOUND = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
asked AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL),
d AS (SELECT doc_id, array_to_string(w[i:i + 14], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 13)) AS i FROM words)),
e AS (SELECT item_id, array_to_string(w[i:i + 14], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 13)) AS i FROM asked))
SELECT DISTINCT doc_id, item_id FROM d JOIN e USING (g)
"""

#: Characters stand in for tokens: by the statement of the problem the margins are wide.
P8_FOUND = r"""
WITH docs AS (
  SELECT regexp_replace(lower(regexp_replace(source, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), '[-_.\s\p{Z}]+', '_', 'g') AS source, length(text) AS n
  FROM documents WHERE text IS NOT NULL),
own AS (SELECT source, sum(n) AS n FROM docs GROUP BY source)
SELECT t.source FROM mix_targets t LEFT JOIN own ON own.source = t.source
WHERE coalesce(own.n, 0) * t.max_repeats < t.weight * (SELECT sum(n) FROM docs)
"""


def oracle_sql() -> dict[str, str]:
    """SQL by query."""
    return {
        "p1_found": P1_FOUND,
        "p1_labels": P1_LABELS,
        "p1_parted": P1_PARTED,
        "p4_found": P4_CANON + "SELECT g.least AS file_id_a, c.file_id AS file_id_b FROM canon c JOIN grouped g USING (canon) WHERE c.file_id <> g.least",
        "p4_copies": P4_CANON + "SELECT least AS file_id, copies FROM grouped",
        "p5_found": _WINDOWS + "SELECT DISTINCT file_id FROM hit",
        "p5_shares": _WINDOWS + """, laid AS (SELECT file_id, s, max(s + 160) OVER (PARTITION BY file_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM hit),
covered AS (SELECT file_id, sum(160 - greatest(0, coalesce(e, 0) - s)) AS c FROM laid GROUP BY file_id)
SELECT file_id, n::INT AS n_chars, coalesce(c, 0)::BIGINT AS shared_chars, CASE WHEN n > 0 THEN coalesce(c, 0)::DOUBLE / n ELSE 0.0 END AS share FROM rows LEFT JOIN covered USING (file_id)""",
        "p5_clusters": P5_CLUSTERS,
        "p6_found": P6_FOUND,
        "p6_groups": P6_GROUPS,
        "p7_found": P7_FOUND,
        "p8_found": P8_FOUND,
    }
