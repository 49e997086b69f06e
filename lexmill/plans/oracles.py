"""The core's results in DuckDB's SQL."""

from __future__ import annotations

_WS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
_W = r"[\p{L}\p{N}_]"


def _all(text: str, pattern: str, to: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{to}', 'g')"


def _strip(x: str) -> str:
    return _all(x, f"^{_WS}+|{_WS}+$", "")


def _collapse(x: str) -> str:
    return _all(x, f"{_WS}+", " ")


def _no_digits(x: str) -> str:
    return _all(x, rf"{_W}*\p{{Nd}}{_W}*", "")


def _no_punct(x: str, to: str = "") -> str:
    return _all(x, r"[!-/:-@\[-`{-~]", to)


def _clean(x: str) -> str:
    one = _no_punct(_strip(f"regexp_replace({_no_digits(x)}, '\\n+', chr(10), 'g')"))
    single = rf"(^|[^\p{{L}}\p{{N}}_])[a-zA-Z]([^\p{{L}}\p{{N}}_]|$)"
    return _collapse(_all(_all(one, single, r"\1\2"), single, r"\1\2"))


def _tokens(x: str) -> str:
    return rf"regexp_extract_all({x}, '[!-/:-@\[-`{{-~]|[^!-/:-@\[-`{{-~\s\x0B\x1C-\x1F\x{{85}}\p{{Z}}]+')"


def _newlines(x: str) -> str:
    return f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"


def _sentences(x: str) -> str:
    return f"list_transform(string_split(replace({_newlines(x)}, chr(10), chr(10) || ' '), '. '), lambda s: {_strip('s')})"


def _paragraphs(x: str) -> str:
    return f"string_split({_newlines(x)}, chr(10) || chr(10))"


def _unquote(x: str) -> str:
    s = _strip(x)
    return f"""(CASE WHEN length({s}) >= 2 AND {s} LIKE '"%' AND {s} LIKE '%"' THEN substring({s}, 2, length({s}) - 2) ELSE {s} END)"""


def _expand(x: str) -> str:
    return f"replace(replace(replace({x}, '=FEW=', '.{{1,32}}'), '=SOME=', '.{{1,60}}'), '=ANY=', '.{{1,60}}')"


def _erase(x: str) -> str:
    return _all(x, "=FEW=|=SOME=|=ANY=", "")


_KINDS = (("group", "(.{1,32} (AND|OR)){1,4}"), ("few", "=FEW="), ("few", ".{1,32}"), ("some", "=SOME="), ("any", "=ANY="), ("some", ".{1,60}"))


def _case(x: str, then, other: str) -> str:
    return "(CASE " + " ".join(f"WHEN contains({x}, '{m}') THEN {then(k, m)}" for k, m in _KINDS) + f" ELSE {other} END)"


def _exploded(table: str, key: str, text: str, column: str, split: str) -> str:
    return f"SELECT {key}, (i - 1)::INT AS pos, l[i] AS {column} FROM (SELECT {key}, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT {key}, {split} AS l FROM {table} WHERE {text} IS NOT NULL))"


def _scan(x: str) -> str:
    return _strip(f"lower({_collapse(_no_punct(x, ' '))})")


def _windows(where: str = "text IS NOT NULL", units: str | None = None, sep: str = "'. '") -> str:
    units = units or _sentences("text")
    return f"""SELECT license, source, 'window' AS kind, (i - 1)::INT AS start_at, w::INT AS width, array_to_string(u[i:i + w - 1], {sep}) AS fragment
FROM (SELECT *, unnest(range(1, len(u) - w + 2)) AS i FROM (SELECT license, source, u, unnest(range(1, len(u) + 1)) AS w FROM (SELECT license, source, {units} AS u FROM licenses WHERE {where})))"""


_FRAGMENTS = _windows("text IS NOT NULL AND license IS NOT NULL") + f"""
UNION ALL SELECT license, source, 'paragraph', (i - 1)::INT, NULL, u[i] FROM (SELECT *, unnest(range(1, len(u) + 1)) AS i FROM (SELECT license, source, {_paragraphs('text')} AS u FROM licenses WHERE text IS NOT NULL AND license IS NOT NULL))"""


def _grams(table: str, n: int, keep: str, text: str = "text", where: str = "") -> str:
    pad = "list_concat([" + ", ".join(["'<START>'"] * (n - 1)) + "], k)" if n > 1 else "k"
    context = f"array_to_string(p[i:i + {n - 2}], ' ')" if n > 1 else "''"
    return f"""SELECT {keep}, {context} AS context, p[i + {n - 1}] AS token FROM (
SELECT *, unnest(range(1, len(p) - {n} + 2)) AS i FROM (SELECT {keep}, {pad} AS p FROM (
SELECT {keep}, {_tokens('s')} AS k FROM (SELECT {keep}, unnest(list_transform(string_split({text}, '.'), lambda x: x || '.')) AS s FROM {table} WHERE {text} IS NOT NULL {where})) WHERE len(k) > 0))"""


def _counts(table: str, n: int, label: str, text: str = "text") -> str:
    return f"SELECT {label}, {n} AS n, context, token, count(*) AS cnt FROM ({_grams(table, n, label, text)}) GROUP BY ALL"


def _model(table: str, n: int, label: str, text: str = "text") -> str:
    return f"""SELECT *, cum::DOUBLE / ctx_cnt AS cdf, cnt::DOUBLE / ctx_cnt AS prob FROM (
SELECT *, (sum(cnt) OVER (PARTITION BY {label}, n, context ORDER BY token ROWS UNBOUNDED PRECEDING))::BIGINT AS cum, (sum(cnt) OVER (PARTITION BY {label}, n, context))::BIGINT AS ctx_cnt FROM ({_counts(table, n, label, text)}))"""


_MARKS = r"!@#$%^&*()[]{};:,./<>?\|`~-=_+"


def _chain(x: str) -> str:
    return f"lower(translate({x}, '{_MARKS}', ''))"


def _transitions(table: str, label: str) -> str:
    return f"""SELECT {label}, {_chain(_no_digits('w[i]'))} AS w1, {_chain('w[i + 1]')} AS w2, count(*) AS cnt
FROM (SELECT *, unnest(range(1, len(w))) AS i FROM (SELECT {label}, string_split(text, ' ') AS w FROM {table} WHERE text IS NOT NULL)) GROUP BY ALL"""


_M = "18446744073709551616::UHUGEINT"


def _numbers(rows: str, step: str, out: str) -> str:
    """``rows`` with a number in [0, 1) by its base ``b``, ``seed`` and ``step``: 64-bit arithmetic in wider integers."""
    first = f"SELECT *, (b + (seed * 64 + {step})::UHUGEINT * 11400714819323198485::UHUGEINT) % {_M} AS z0 FROM ({rows})"
    second = f"SELECT *, (xor(z0, z0 >> 30) * 13787848793156543929::UHUGEINT) % {_M} AS z1 FROM ({first})"
    third = f"SELECT *, (xor(z1, z1 >> 27) * 10723151780598845931::UHUGEINT) % {_M} AS z2 FROM ({second})"
    return f"SELECT * EXCLUDE (z0, z1, z2), (xor(z2, z2 >> 31) >> 11)::DOUBLE / 9007199254740992.0 AS {out} FROM ({third})"


_TEXTS = """texts AS MATERIALIZED (SELECT row_number() OVER () AS rid, license, source, text, length(text) - 1 AS seeds,
  md5(concat_ws('|', coalesce(license, ''), coalesce(source, ''), text)) AS key FROM licenses WHERE length(text) > 1)"""
_FRESH = "array_to_string(list_transform(range(n - 1), lambda i: '<START>'), ' ')"


def _base_of(rest: str) -> str:
    return f"('0x' || substring(md5(key || '|' || {rest}), 1, 16))::UBIGINT::UHUGEINT AS b"


_MODELS = f"""{_TEXTS},
toks AS (SELECT rid, {_tokens('s')} AS k FROM (SELECT rid, unnest(list_transform(string_split(text, '.'), lambda x: x || '.')) AS s FROM texts)),
grams AS (SELECT rid, n, array_to_string(p[i:i + n - 2], ' ') AS context, p[i + n - 1] AS token FROM (
  SELECT *, unnest(range(1, len(p) - n + 2)) AS i FROM (SELECT rid, n, list_concat(list_transform(range(n - 1), lambda i: '<START>'), k) AS p FROM toks, (SELECT unnest(range(2, 8)) AS n)))),
model AS MATERIALIZED (SELECT rid, n, context, list(token ORDER BY token) AS succ FROM grams GROUP BY ALL)"""


def _walks(low: int, high: int, name: str) -> str:
    """Walks of ``low`` to ``high`` tokens, as CTEs: ``name`` has license, source, n, seed and phrase."""
    begun = _numbers(f"SELECT rid, n, b, unnest(range(1, seeds + 1)) AS seed FROM (SELECT *, {_base_of(f"n || '|{low}'")} FROM texts, (SELECT unnest(range(2, 8)) AS n))", "63", "u")
    return f"""{name}_begun AS ({begun}),
{name}_walk AS (
  SELECT rid, n, seed, b, {low} + floor(u * {high - low + 1})::INT AS many, {_FRESH} AS context, '' AS phrase, 0 AS step FROM {name}_begun
  UNION ALL
  SELECT rid, n, seed, b, many, CASE WHEN tok = '.' THEN {_FRESH} ELSE array_to_string(list_concat(string_split(context, ' ')[2:], [tok]), ' ') END,
    CASE WHEN step = 0 THEN tok ELSE phrase || ' ' || tok END, step + 1
  FROM (SELECT w.*, m.succ[1 + floor(w.u * len(m.succ))::INT] AS tok FROM ({_numbers(f"SELECT * FROM {name}_walk WHERE step < many", "step", "u")}) w JOIN model m ON m.rid = w.rid AND m.n = w.n AND m.context = w.context)),
{name} AS (SELECT license, source, n::INT AS n, seed::INT AS seed, phrase FROM {name}_walk JOIN texts USING (rid) WHERE step = many)
"""


_NGRAM_WALKS = f"WITH RECURSIVE {_MODELS}, {_walks(6, 30, 'made')}"


def _label_key(x: str) -> str:
    return f"lower(regexp_replace({x}, '[-._ ]+', ' ', 'g'))"


def _pool(name: str, walks: str) -> str:
    return f"""{name} AS MATERIALIZED (SELECT k, phrase, row_number() OVER (PARTITION BY k ORDER BY phrase) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM (
  SELECT DISTINCT {_label_key('license')} AS k, lower({_clean('phrase')}) AS phrase FROM {walks} WHERE license IS NOT NULL) WHERE phrase <> '')"""


def _assembled() -> str:
    u = lambda key: f"(('0x' || substring(md5({key}), 1, 8))::BIGINT::DOUBLE / 4294967296.0)"
    own = f"""SELECT p.regex_id, {_label_key('licenses')} AS k, {_case('rx', lambda k, m: f"'{k}'", "'none'")} AS kind, {_erase('prefix')} AS p, {_erase('suffix')} AS s
  FROM (SELECT regex_id, licenses, {_unquote('regex')} AS rx FROM spdxregex) r JOIN ({_PARTS}) p USING (regex_id) WHERE licenses IS NOT NULL AND rx IS NOT NULL"""
    parts = [
        f"""SELECT regex_id, any_value(kind) AS kind, round::INT AS round, any_value(p) || ' ' || string_agg(phrase || ' (and|or) ', '' ORDER BY j) || ' ' || any_value(s) AS assembled
FROM (SELECT d.*, q.phrase FROM (SELECT *, floor({u("regex_id || '|' || round || '|' || j")} * n)::BIGINT AS i FROM (
  SELECT *, unnest(range(1, 2 + floor({u("regex_id || '|' || round || '|times'")} * 4)::INT)) AS j FROM (SELECT own.*, z.n, unnest(range(1, 21)) AS round FROM own JOIN (SELECT DISTINCT k, n FROM {pool}) z USING (k) WHERE kind IN ({kinds})))) d
  JOIN {pool} q ON q.k = d.k AND q.i = d.i) GROUP BY regex_id, round"""
        for pool, kinds in (("pool", "'group', 'few'"), ("long_pool", "'some', 'any'"))
    ]
    return f"WITH RECURSIVE {_MODELS}, {_walks(6, 30, 'made')}, {_walks(12, 59, 'far')}, {_pool('pool', 'made')}, {_pool('long_pool', 'far')}, own AS ({own}) " + " UNION ALL ".join(parts)


_CHAIN_WALKS = f"""WITH RECURSIVE {_TEXTS},
worded AS (SELECT rid, list_transform(string_split({_no_digits('text')}, ' '), lambda w: {_chain('w')}) AS w1, list_transform(string_split(text, ' '), lambda w: {_chain('w')}) AS w2 FROM texts),
chain AS MATERIALIZED (SELECT rid, w1[i] AS word, list(w2[i + 1] ORDER BY i) AS succ FROM (SELECT *, unnest(range(1, len(w1))) AS i FROM worded) GROUP BY ALL),
begun AS ({_numbers(_numbers(f"SELECT rid, b, unnest(range(1, seeds + 1)) AS seed FROM (SELECT *, {_base_of("'chain'")} FROM texts)", "63", "u"), "62", "v")}),
walk AS (
  SELECT rid, seed, b, floor(u * 32)::INT - 1 AS steps, w1[1 + floor(v * len(w1))::INT] AS word, w1[1 + floor(v * len(w1))::INT] AS phrase, 0 AS step FROM begun JOIN worded USING (rid)
  UNION ALL
  SELECT rid, seed, b, steps, nxt, phrase || ' ' || nxt, step + 1
  FROM (SELECT w.*, c.succ[1 + floor(w.u * len(c.succ))::INT] AS nxt FROM ({_numbers("SELECT * FROM walk WHERE step < steps", "step", "u")}) w JOIN chain c ON c.rid = w.rid AND c.word = w.word))
SELECT license, source, seed::INT AS seed, phrase FROM (SELECT rid, seed, arg_max(phrase, step) AS phrase FROM walk GROUP BY ALL) JOIN texts USING (rid)"""

_MARK_OF = _case("rx", lambda k, m: f"'{m}'", "NULL")
_PARTS = f"""SELECT regex_id, CASE WHEN mark IS NULL THEN rx ELSE substring(rx, 1, instr(rx, mark) - 1) END AS prefix,
CASE WHEN rx IS NULL THEN NULL WHEN mark IS NULL THEN '' ELSE substring(rx, instr(rx, mark) + length(mark)) END AS suffix,
CASE WHEN rx IS NULL THEN NULL WHEN mark IS NULL THEN '' ELSE string_split(rx, mark)[-1] END AS last_suffix
FROM (SELECT *, {_MARK_OF} AS mark FROM (SELECT regex_id, {_unquote('regex')} AS rx FROM spdxregex))"""

#: Entries of the catalogues that the queries write, straight from the table.
_ENTRIES = f"""SELECT lower(split_part(licenses, '-', 1)) AS doc, regex_id * 20 + 2 AS line, fam || lic AS entry_id, trim(fam, '_') AS family, lic AS license,
CASE WHEN nocheck THEN NULL ELSE 'terms' END AS key_regex, {_unquote("coalesce(regex, '')")} AS str_regex, coalesce(nocheck, FALSE) AS nocheck, regex_id % 5 = 0 AS optional_str, licenses AS aliases
FROM (SELECT *, CASE WHEN regex_id % 2 = 0 THEN '_LT_' ELSE '_SPDX_' END AS fam, regexp_replace(licenses, '[-.+]', '_', 'g') AS lic FROM spdxregex WHERE licenses IS NOT NULL)"""

_SENTENCE_SIGNATURES = f"""SELECT *, concat_ws('/', regex, key_regex) AS signature FROM (
SELECT DISTINCT '\\<' || w[3] || ' ' || w[4] || 's?\\>' AS regex, '\\b' || w[3] || ' ' || w[4] || 's?\\b' AS own, CASE WHEN length(w[-1]) % 2 = 0 THEN '(' || w[-1] || '|=YEAR=)' END AS key_regex, w[-1] AS k
FROM (SELECT string_split({_scan('s')}, ' ') AS w FROM (SELECT unnest({_sentences('text')}) AS s FROM licenses WHERE license IS NOT NULL AND text IS NOT NULL))
WHERE len(w) >= 6 AND regexp_full_match(array_to_string(w[1:4], ''), '[a-z]+') AND regexp_full_match(w[-1], '[a-z]+'))"""


def _keyed_scan(texts: str) -> str:
    return f"""SELECT DISTINCT id, signature FROM (SELECT id, text, {_scan('text')} AS t FROM ({texts}) WHERE text IS NOT NULL)
JOIN ({_SENTENCE_SIGNATURES}) ON regexp_matches(t, own) AND (key_regex IS NULL OR regexp_matches(text, '(?i)(' || k || '|[0-9]{{4}})'))"""


P2_FOUND = r"""
SELECT DISTINCT CAST(json_extract(line, '$.file_id') AS BIGINT) AS file_id
FROM (SELECT regexp_replace(unnest(string_split(payload, chr(10))), '\r$', '') AS line FROM landed_files WHERE payload IS NOT NULL)
WHERE trim(line) <> '' AND json_valid(line) AND json_extract(line, '$.file_id') IS NOT NULL
"""


P2_VALIDATION = r"""
WITH lines AS (
  SELECT landed_at, file_path, i AS line_no, regexp_replace(l[i], '\r$', '') AS line, octet_length(encode(l[i])) AS n
  FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM (SELECT landed_at, file_path, string_split(payload, chr(10)) AS l FROM landed_files WHERE payload IS NOT NULL))),
told AS (SELECT *, octet_length(encode(line)) AS b, CASE WHEN trim(line) = '' THEN 'blank' WHEN json_valid(line) AND json_extract(line, '$.file_id') IS NOT NULL THEN 'complete' ELSE 'torn' END AS kind FROM lines),
once AS (SELECT b FROM told WHERE kind = 'complete' QUALIFY row_number() OVER (PARTITION BY CAST(json_extract(line, '$.file_id') AS BIGINT) ORDER BY landed_at NULLS LAST, file_path, line_no) = 1),
sums AS (SELECT count(*) FILTER (kind = 'complete') AS complete_lines, count(*) FILTER (kind = 'torn') AS torn_lines, coalesce(sum(b) FILTER (kind = 'torn'), 0)::BIGINT AS torn_bytes, count(*) FILTER (kind = 'blank') AS blank_lines FROM told),
source AS (SELECT count(payload) AS files, sum(octet_length(encode(payload)))::BIGINT AS source_bytes, count(*) FILTER (octet_length(encode(payload)) <> n_bytes) AS wrong_length FROM landed_files)
SELECT (SELECT count(*) FROM once) AS records, (SELECT sum(b)::BIGINT FROM once) AS bytes, files, source_bytes, wrong_length, complete_lines, torn_lines, torn_bytes, blank_lines, TRUE AS valid FROM sums, source
"""


def oracle_sql() -> dict[str, str]:
    """SQL by query."""
    lines = f"string_split({_newlines('text')}, chr(10))"
    return {
        "p2_found": P2_FOUND,
        "p2_validation": P2_VALIDATION,
        "p2_frames": "SELECT count(*) AS files, sum(octet_length(encode(payload)))::BIGINT AS bytes, sum(length(payload) - length(replace(payload, chr(10), '')))::BIGINT AS lines FROM landed_files WHERE payload <> ''",
        "clean_text": f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents",
        "para_join": f"SELECT doc_id, array_to_string({_paragraphs('text')}, '. ') AS joined FROM documents",
        "blank_lines": f"SELECT doc_id, (len(list_filter({lines}, lambda x: regexp_full_match(x, '{_WS}*'))) - CASE WHEN {lines}[-1] = '' THEN 1 ELSE 0 END + 1)::INT AS blank_lines FROM documents",
        "ws_count": f"SELECT doc_id, (len(regexp_extract_all(text, '{_WS}')) + 1)::INT AS ws_count FROM documents",
        "scan_text": f"SELECT doc_id, {_scan('text')} AS scanned FROM documents",
        "drop_digit_words": f"SELECT doc_id, {_no_digits('text')} AS kept FROM documents",
        "collapse_blanks": f"SELECT doc_id, {_strip(_collapse('text'))} AS collapsed FROM documents",
        "normalize_license_id": "SELECT file_id, regexp_replace(dirname, '[-.+]', '_', 'g') AS label_key, split_part(dirname, '-', 1) AS prefix FROM split_db_foss_licenses",
        "macro_expand": f"SELECT regex_id, {_expand(_unquote('regex'))} AS expanded FROM spdxregex",
        "macro_erase": f"SELECT regex_id, {_erase(_unquote('regex'))} AS erased FROM spdxregex",
        "wildcard_class": "SELECT regex_id, CASE WHEN regex IS NOT NULL THEN " + _case("regex", lambda k, m: f"'{k}'", "'none'") + " END AS kind, (CASE WHEN regex IS NOT NULL THEN " + _case("regex", lambda k, m: f"(length(regex) - length(replace(regex, '{m}', ''))) // {len(m)}", "0") + " END)::INT AS marks FROM spdxregex",
        "regex_parts": _PARTS,
        "path_label": "SELECT file_path, string_split(file_path, '/')[-2] AS label, lower(file_path) LIKE '%.txt' AS is_txt FROM landed_files",
        "src_url_rewrite": "SELECT file_id, 'https://base.example/' || filename AS url FROM split_db_foss_licenses",
        "tokenize": _exploded("documents", "doc_id", "text", "token", _tokens("text")),
        "sentence_split": _exploded("documents", "doc_id", "text", "sentence", _sentences("text")),
        "train_sentences": _exploded("documents", "doc_id", "text", "sentence", "list_transform(string_split(text, '.'), lambda s: s || '.')"),
        "paragraph_split": _exploded("documents", "doc_id", "text", "paragraph", _paragraphs("text")),
        "markov_words": _exploded("documents", "doc_id", "text", "word", f"list_transform(string_split(text, ' '), lambda w: {_chain('w')})"),
        "token_freq": f"SELECT token, count(*) AS cnt FROM (SELECT unnest({_tokens('text')}) AS token FROM documents WHERE text IS NOT NULL) GROUP BY token",
        "filter_nonempty": f"SELECT file_id, length(content)::INT AS n_chars FROM split_db_foss_licenses WHERE {_strip('content')} <> ''",
        "sliding_windows": f"SELECT license, source, width, start_at, fragment FROM ({_windows()})",
        "paragraph_windows": f"SELECT license, source, width, start_at, fragment FROM ({_windows(units=_paragraphs('text'), sep='chr(10) || chr(10)')})",
        "cumulative_splits": f"""SELECT file_id, pos::INT AS pos, {_strip(_collapse("array_to_string(list_transform(o[1:pos], lambda k: u[k + 1]), ' ')"))} AS fragment
FROM (SELECT *, unnest(range(1, len(o) + 1)) AS pos FROM (SELECT file_id, u, list_filter(flatten(list_transform(range(1, len(u)), lambda c: range(0, len(u) - c + 1, c))), lambda i: u[i + 1] <> '')[1:1001] AS o
FROM (SELECT file_id, {_sentences('content')} AS u FROM split_db_foss_licenses WHERE content IS NOT NULL) WHERE len(u) >= 2))""",
        "fragments_all": _FRAGMENTS,
        "fragment_distinct": f"SELECT DISTINCT license, fragment FROM ({_FRAGMENTS})",
        "fragment_numbering": f"""SELECT license, fragment, seq::INT AS seq, license || '-' || seq || '.txt' AS name FROM (
SELECT license, fragment, row_number() OVER (PARTITION BY license ORDER BY kind, width, start_at, fragment) AS seq FROM (
SELECT license, fragment, min(kind) AS kind, min(coalesce(width, 0)) AS width, min(start_at) AS start_at FROM ({_FRAGMENTS}) GROUP BY ALL))""",
        "next_numbers": "SELECT dirname, (max(seq) + 1)::INT AS next_seq FROM split_db_foss_licenses GROUP BY dirname",
        "ngram_extract": _grams("licenses", 3, "license, source"),
        "ngram_counts": " UNION ALL ".join(_counts("licenses", n, "source") for n in range(1, 8)),
        "ngram_context": f"SELECT source, n, context, count(*) AS tokens, sum(cnt)::BIGINT AS ctx_cnt, min(token) AS first_token, max(token) AS last_token FROM ({_counts('documents', 2, 'source')}) GROUP BY ALL",
        "ngram_successors": f"SELECT source, context, string_agg(token || '=' || cnt, ' ' ORDER BY token) AS successors FROM ({_counts('documents', 2, 'source')}) GROUP BY ALL",
        "ngram_prob": f"SELECT source, context, token, cnt, ctx_cnt, prob FROM ({_model('documents', 2, 'source')})",
        "ngram_cdf": f"SELECT source, context, token, cnt, prob, cdf FROM ({_model('documents', 2, 'source')})",
        "ngram_prob_lookup": f"""WITH m AS ({_model("(SELECT 'all' AS lab, text FROM licenses)", 2, 'lab')}),
asked AS (SELECT DISTINCT context, token FROM ({_grams("(SELECT 'all' AS lab, content FROM ngramfiles)", 2, 'lab', 'content')}))
SELECT context, token, coalesce(prob, 0.0) AS prob FROM asked LEFT JOIN m USING (context, token)""",
        "markov_transitions": _transitions("documents", "source"),
        "ngram_generate": _NGRAM_WALKS + "SELECT * FROM made",
        "markov_generate": _CHAIN_WALKS,
        "phrase_pool": _NGRAM_WALKS + f"SELECT DISTINCT license, source, phrase FROM (SELECT license, source, lower({_clean('phrase')}) AS phrase FROM made) WHERE phrase <> ''",
        "assembled_regexes": _assembled(),
        "lookup_exact": """SELECT file_id, coalesce(r.regex, '') AS regex FROM split_db_foss_licenses f LEFT JOIN (
SELECT licenses, arg_min(coalesce(regex, ''), regex_id) AS regex FROM spdxregex WHERE licenses IS NOT NULL GROUP BY licenses) r ON r.licenses = f.dirname""",
        "lookup_contains": "SELECT key, regex_id FROM (SELECT DISTINCT license AS key FROM licenses WHERE license <> '') JOIN spdxregex ON regexp_matches(licenses, key)",
        "lookup_prefix": "SELECT key, regex_id FROM (SELECT DISTINCT split_part(dirname, '-', 1) AS key FROM split_db_foss_licenses) JOIN spdxregex ON key <> '' AND contains(licenses, key)",
        "vocab_join": "SELECT f.file_id, l.source, length(l.text)::INT AS vocab_chars FROM split_db_foss_licenses f JOIN licenses l ON l.license = f.dirname WHERE l.text <> ''",
        "sig_parse": f"""SELECT regex_id, '_SPDX_' || regexp_replace(licenses, '[-.+]', '_', 'g') AS entry_id, 'SPDX' AS family, regexp_replace(licenses, '[-.+]', '_', 'g') AS license,
CASE WHEN nocheck THEN NULL ELSE 'terms' END AS key_regex, {_unquote("coalesce(regex, '')")} AS str_regex, coalesce(nocheck, FALSE) AS nocheck, licenses AS aliases FROM spdxregex WHERE licenses IS NOT NULL""",
        "sig_parse_catalogue": _ENTRIES,
        "sig_definitions": "SELECT lower(split_part(licenses, '-', 1)) AS doc, regex_id * 20 + 8 AS line, 'N' || regex_id AS name, length(licenses) || '+1' AS value FROM spdxregex WHERE licenses IS NOT NULL",
        "union_families": f"SELECT license, family, {_expand('str_regex')} AS regex FROM ({_ENTRIES}) WHERE str_regex <> ''",
        "sig_scan_keys": _keyed_scan("SELECT 'd' || doc_id AS id, text FROM documents UNION ALL SELECT 'f' || file_id, content FROM ngramfiles"),
        "license_scores": f"""SELECT doc_id, score, CASE WHEN score >= 9 THEN 'license' WHEN score >= 4 THEN 'unsure' ELSE 'none' END AS verdict FROM (
SELECT doc_id, coalesce(n, 0) AS score FROM documents LEFT JOIN (SELECT id AS doc_id, count(*) AS n FROM ({_keyed_scan("SELECT doc_id AS id, text FROM documents")}) GROUP BY ALL) USING (doc_id))""",
        "sig_scan": f"""SELECT DISTINCT file_id, regex_id FROM (SELECT file_id, {_scan('content')} AS t FROM (SELECT file_id, content FROM split_db_foss_licenses UNION ALL SELECT file_id, content FROM ngramfiles) WHERE content IS NOT NULL)
JOIN (SELECT regex_id, {_strip(_collapse(_all(_expand(_unquote('regex')), r'([\p{L}])-([\p{L}])', r'\1 \2')))} AS rx FROM spdxregex) ON rx <> '' AND regexp_matches(t, '(?i)' || rx)""",
        "union_regexes": f"WITH r AS (SELECT licenses, {_unquote('regex')} AS regex FROM spdxregex WHERE licenses IS NOT NULL AND trim(regex) <> '') SELECT * FROM r UNION ALL SELECT licenses, {_expand('regex')} FROM r",
        "regex_language": f"""SELECT regex_id, unnest(CASE WHEN contains(rx, 'licen[cs]e') THEN [replace(rx, 'licen[cs]e', 'license'), replace(rx, 'licen[cs]e', 'licence')] WHEN rx LIKE '%notices?' THEN [rx[:-3], rx[:-2]]
WHEN rx LIKE '%terms?' THEN [rx[:-3], rx[:-2]] WHEN contains(rx, '(grant|gift)') THEN [replace(rx, '(grant|gift)', 'grant'), replace(rx, '(grant|gift)', 'gift')] ELSE [rx] END) AS expansion
FROM (SELECT regex_id, {_unquote('regex')} AS rx FROM spdxregex) WHERE rx <> '' AND {_case('rx', lambda k, m: "FALSE", "TRUE")}""",
        "label_counts": "SELECT dirname, count(*) AS count FROM split_db_foss_licenses GROUP BY dirname",
        "label_collisions": "SELECT content, count(DISTINCT dirname) AS labels, count(*) AS rows FROM split_db_foss_licenses WHERE content IS NOT NULL GROUP BY content HAVING count(DISTINCT dirname) > 1",
        "chunk_assign": "SELECT doc_id, rn, ((rn * 6) // n)::INT AS chunk FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rn, count(*) OVER () AS n FROM documents)",
        "thirds_assign": "SELECT doc_id, rn, CASE WHEN rn < n // 3 THEN 0 WHEN rn < 2 * n // 3 THEN 1 ELSE 2 END AS part FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rn, count(*) OVER () AS n FROM documents)",
        "first_fragments": "SELECT dirname, seq, file_id FROM split_db_foss_licenses QUALIFY row_number() OVER (PARTITION BY dirname ORDER BY seq, file_id) <= 100",
        "json_field": "SELECT event_id, json_extract_string(props, '$.k') AS k, len(json_keys(props))::INT AS keys FROM events",
        "sink_by_license": "SELECT license, count(*) AS texts, sum(length(text))::BIGINT AS chars FROM licenses WHERE license IS NOT NULL AND text IS NOT NULL GROUP BY license",
    }
