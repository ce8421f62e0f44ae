"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import url_filter
from .license_scan import LEAST, VARIANTS, VERSION, all_templates, template_marks, template_words

SPACE = r"[\x20\x09-\x0D]+"


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licences() -> str:
    """Operator 1: every unit within the size bound, and every window of a template's
    length, against every template; marks (variant words, versions) must agree."""
    names = all_templates()
    rows = [(name, template_words(text)) for name in sorted(names) for text in names[name]]
    strings = lambda x: f"[{', '.join(map(literal, x))}]::VARCHAR[]"
    known = ", ".join(f"({i}, {literal(name)}, {strings([f'{a} {b}' for a, b in zip(w, w[1:])])}, {strings(template_marks(w))})"
                      for i, (name, w) in enumerate(rows) if len(w) > 1)
    marks = lambda w: (f"list_sort(list_distinct(list_concat(list_filter({w}, lambda y: list_contains({strings(VARIANTS)}, y)), "  # noqa: E731
                       f"regexp_extract_all(array_to_string({w}, ' '), {literal(VERSION)}, 1))))")
    return rf"""
WITH known AS (SELECT tid, name, grams, marks, len(grams) AS m FROM (VALUES {known}) t(tid, name, grams, marks)),
clean AS (SELECT row_number() OVER () AS rid, doc_id, regexp_replace(lower(coalesce(text, '')), '[^a-z0-9
]+', ' ', 'g') AS t FROM documents),
units AS (
  SELECT rid, doc_id, list_distinct(list_filter(list_transform(list_concat(string_split(t, chr(10)),
    list_transform(string_split_regex(t, '
(?: *
)+'), lambda p: replace(p, chr(10), ' ')), [replace(t, chr(10), ' ')]),
    lambda u: trim(regexp_replace(u, ' +', ' ', 'g'))), lambda u: u <> '')) AS units,
    trim(regexp_replace(replace(t, chr(10), ' '), ' +', ' ', 'g')) AS whole FROM clean),
unit AS (SELECT rid, unnest(units) AS u FROM units),
words AS (SELECT rid, row_number() OVER () AS uid, string_split(u, ' ') AS w FROM unit),
pairs AS (
  SELECT rid, uid, w, tid, name, marks, m, len(w) - 1 AS n FROM words, known
  WHERE least(len(w) - 1, m) * 200 >= (len(w) - 1 + m) * {LEAST}),
template_grams AS (SELECT tid, g, count(*) AS c FROM (SELECT tid, unnest(grams) AS g FROM known) GROUP BY ALL),
unit_grams AS (SELECT uid, g, count(*) AS c FROM (SELECT uid, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
  FROM words WHERE uid IN (SELECT uid FROM pairs)) GROUP BY ALL),
common AS (SELECT p.uid, p.tid, sum(least(a.c, b.c)) AS shared FROM (SELECT DISTINCT uid, tid FROM pairs) p
  JOIN unit_grams a ON a.uid = p.uid JOIN template_grams b ON b.tid = p.tid AND b.g = a.g GROUP BY ALL),
in_units AS (SELECT rid, name, shared, n + m AS total FROM pairs p JOIN common USING (uid, tid)
  WHERE shared * 200 >= (n + m) * {LEAST} AND {marks('w')} = marks),
text AS (SELECT rid, string_split(whole, ' ') AS w FROM units WHERE whole <> ''),
places AS (SELECT rid, pos, w[pos] || ' ' || w[pos + 1] AS g FROM (SELECT rid, w, unnest(range(1, len(w))) AS pos FROM text)),
hits AS (SELECT rid, tid, pos, g, b.c FROM places JOIN template_grams b USING (g)),
enough AS (SELECT rid, tid, m FROM hits JOIN known USING (tid) GROUP BY rid, tid, m HAVING count(*) * 200 >= 2 * m * {LEAST}),
starts AS (SELECT DISTINCT rid, tid, m, s FROM (SELECT rid, tid, m, unnest(range(pos - m + 1, pos + 1)) AS s FROM hits JOIN enough USING (rid, tid))
  JOIN text USING (rid) WHERE s >= 1 AND s + m <= len(w)),
in_window AS (SELECT rid, tid, s, m, g, count(*) AS n, any_value(c) AS c FROM starts JOIN hits USING (rid, tid) WHERE pos BETWEEN s AND s + m - 1 GROUP BY ALL),
windows AS (SELECT rid, tid, s, m, sum(least(n, c)) AS shared FROM in_window GROUP BY ALL HAVING sum(least(n, c)) * 200 >= 2 * m * {LEAST}),
in_windows AS (SELECT rid, k.name, shared, 2 * k.m AS total FROM windows x JOIN known k USING (tid) JOIN text USING (rid)
  WHERE {marks('w[s:s + k.m]')} = marks),
best AS (
  SELECT rid, name, shared, total FROM (SELECT * FROM in_units UNION ALL SELECT * FROM in_windows)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY shared::DOUBLE / total DESC, name, total DESC) = 1),
tried AS (SELECT rid, count(*) AS n FROM pairs GROUP BY 1)
SELECT u.doc_id, len(units)::BIGINT AS n_units, coalesce(tried.n, 0)::BIGINT AS n_candidates, best.name AS license,
  best.shared::BIGINT AS shared, best.total::BIGINT AS total
FROM units u LEFT JOIN tried USING (rid) LEFT JOIN best USING (rid)
"""


#: The verdict of operator 2, with its features, over a table ``docs`` of (doc_id, text).
RULES_SQL = rf"""
w AS (SELECT doc_id, text, list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') AS words,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
windows AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 7], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS pos FROM w WHERE len(words) > 8)),
again AS (SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS p FROM again) GROUP BY 1),
f AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g'))::BIGINT AS word_chars,
  (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
  length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[A-Z]', '', 'g')) AS n_capitals,
  len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) AS n_echoes
  FROM w LEFT JOIN hit USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words OR n_dup_lines >= 5 AND 10 * n_dup_lines > 3 * n_lines
    OR 10 * n_echoes > 3 * n_words OR 2 * n_capitals > word_chars AS failed FROM f)
"""

RULES = f"""
WITH docs AS (SELECT doc_id, text FROM documents), {RULES_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR failed) AS kept FROM judged
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a, v b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""

WINDOWS = rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') AS words FROM documents),
windows AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 34], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS pos FROM d WHERE len(words) >= 35)),
again AS (SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY win) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 35)) AS p FROM again),
word AS (SELECT doc_id, unnest(words) AS x, generate_subscripts(words, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

#: Bytes as pairs of hexadecimal digits.
BYTES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 400)) AS win
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS pos FROM d WHERE length(h) >= 400)),
again AS (SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY win) > 1),
runs AS (SELECT doc_id, pos, coalesce(pos > 200 + lag(pos) OVER (PARTITION BY doc_id ORDER BY pos), true) AS new FROM again),
spans AS (SELECT doc_id, min(pos) AS a, max(pos) + 200 AS z FROM (
  SELECT doc_id, pos, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM runs) GROUP BY doc_id, k),
cuts AS (SELECT doc_id, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z, sum(z - a) AS gone, count(*) AS n FROM spans GROUP BY 1)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN h ELSE array_to_string(list_transform(range(0, n + 1),
    lambda i: substr(h, 2 * (CASE WHEN i = 0 THEN 0 ELSE z[i] END) + 1,
      2 * ((CASE WHEN i = n THEN length(h) // 2 ELSE a[i + 1] END) - (CASE WHEN i = 0 THEN 0 ELSE z[i] END)))), '') END)) AS kept_sha256
FROM d LEFT JOIN cuts USING (doc_id)
"""


def _urls() -> str:
    rules = sorted(url_filter.RULES, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))

    def rule(host: str, path: str) -> str:
        cases = " ".join(f"WHEN ({host} = {literal(h)} OR ends_with({host}, {literal('.' + h)})) AND starts_with({path}, {literal(p)}) THEN {literal(h + p)}" for h, p, _ in rules)
        return f"CASE {cases} END"

    allow = ", ".join(literal(h + p) for h, p, ok in rules if ok)
    lower = lambda x: f"translate({x}, '{url_filter.CAPITALS}', '{url_filter.CAPITALS.lower()}')"
    host = lambda u: lower(f"coalesce(regexp_extract({u}, '{url_filter.HOST}', 1), '')")
    path = lambda u: f"coalesce(regexp_extract({u}, '{url_filter.PATH}', 1), '')"
    head = "regexp_extract(bare, '(?s)^.*?://[^/?#]*', 0)"

    def address(bare: str) -> str:
        """Scheme and host in lower case, path without dot segments (one after another from an empty path on)."""
        h, p = head.replace("bare", bare), path(bare)
        kept = f"""list_reduce(list_prepend('', string_split({p}, '/')[2:]), lambda acc, x: CASE x WHEN '.' THEN acc
          WHEN '..' THEN regexp_replace(acc, '/[^/]*$', '') ELSE acc || '/' || x END)"""
        clean = rf"""CASE WHEN regexp_matches({p}, '/\.\.?(/|$)') THEN {kept} || CASE WHEN regexp_matches({p}, '/\.\.?$') THEN '/' ELSE '' END ELSE {p} END"""
        return f"{lower(h)} || ({clean}) || substr({bare}, length({h}) + length({p}) + 1)"

    absolute = "regexp_matches(t, '^([A-Za-z][A-Za-z0-9+.-]*:)?//')"
    return rf"""
WITH RECURSIVE page AS (SELECT page_id, url, html, regexp_replace(url, '(?s)#.*$', '') AS bare FROM pages),
p AS (SELECT page_id, url, html, {address('bare')} AS node, {host('url')} AS host, {path('url')} AS path, {path('bare')} AS own FROM page),
tags AS (
  SELECT url, node, own, regexp_extract(tag, '{url_filter.HREF.replace("'", "''")}', 1) AS target FROM (
    SELECT *, unnest(regexp_extract_all(html, '{url_filter.LINK_TAG}')) AS tag FROM p WHERE contains(url, '://'))
  WHERE regexp_matches(tag, '{url_filter.CANONICAL.replace("'", "''")}')
  UNION ALL
  SELECT url, node, own, regexp_extract(tag, '{url_filter.REFRESH_URL.replace("'", "''")}', 1) FROM (
    SELECT *, unnest(regexp_extract_all(html, '{url_filter.META_TAG}')) AS tag FROM p WHERE contains(url, '://'))
  WHERE regexp_matches(tag, '{url_filter.REFRESH.replace("'", "''")}')),
t AS (SELECT node, own, regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme, regexp_extract(url, '(?s)^.*?://[^/?#]*', 0) AS root,
  trim(replace(regexp_replace(target, '^["'']|["'']$', '', 'g'), '&amp;', '&')) AS t FROM tags),
found AS (SELECT node, {absolute} AS whole, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN scheme || ':' || t
  WHEN t = '' OR starts_with(t, '#') OR regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN starts_with(t, '/') THEN root || t
  WHEN starts_with(t, '?') THEN root || own || t
  ELSE root || regexp_extract(CASE WHEN own = '' THEN '/' ELSE own END, '(?s)^.*/', 0) || t END AS given FROM t),
bare AS (SELECT node, whole, given, regexp_replace(given, '(?s)#.*$', '') AS bare FROM found WHERE given IS NOT NULL),
edges AS (SELECT node AS a, {address('bare')} AS b, whole, given FROM bare),
both_ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach AS (SELECT a AS node, a AS r FROM both_ways UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
judged AS (SELECT page_id, node, host, path, {rule('host', 'path')} AS rule FROM p),
shown AS (SELECT b AS r, CASE WHEN whole THEN given ELSE b END AS seen FROM edges WHERE a <> b),
evidence AS (SELECT node AS r, rule FROM judged UNION SELECT r, {rule(host('seen'), path('seen'))} FROM shown),
said AS (SELECT node, rule FROM reach JOIN evidence USING (r)),
bad AS (SELECT node FROM said GROUP BY node HAVING bool_or(rule IS NOT NULL AND rule NOT IN ({allow})) AND NOT bool_or(coalesce(rule IN ({allow}), false)))
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN CASE WHEN rule IN ({allow}) THEN 'allow' ELSE 'block' END
  WHEN node IN (SELECT node FROM bad) THEN 'block' ELSE 'allow' END AS verdict FROM judged
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII, bit by bit."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))),
    4294967295::BIGINT)"""


#: Operator 12: every node with its members, then each node's ancestors by its own prefixes.
TRIE_SQL = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
coded AS (SELECT conv_id, turn, sha256(strlen(role) || ':' || role || text) AS code, strlen(text)::BIGINT AS size FROM turns),
lists AS (SELECT conv_id, list(code ORDER BY turn NULLS FIRST, code) AS codes, list(size ORDER BY turn NULLS FIRST, code) AS sizes FROM coded GROUP BY 1),
heads AS (SELECT *, conv_id - ((conv_id % 5) + 5) % 5 AS base, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM lists),
rebuilt AS (SELECT a.conv_id, list_concat(coalesce(b.codes[:a.h], []), a.codes[a.h + 1:]) AS codes,
  list_concat(coalesce(b.sizes[:a.h], []), a.sizes[a.h + 1:]) AS sizes FROM heads a LEFT JOIN lists b ON b.conv_id = a.base),
places AS (SELECT conv_id, d::BIGINT AS depth, array_to_string(codes[:d], ',') AS node, CASE WHEN d > 0 THEN array_to_string(codes[:d - 1], ',') END AS parent,
  CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(codes) AS ends
  FROM (SELECT *, unnest(range(0, len(codes) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT depth, node, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(size) AS saved,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM places GROUP BY depth, node),
kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
above AS (SELECT p.depth, p.node, sum(n.saved)::BIGINT AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM nodes n LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node JOIN places p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
  a.leaves::BIGINT AS n_leaves, a.saved AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.parent LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node
JOIN above a ON a.depth = n.depth AND a.node = n.node
"""

#: Operator 13, from a list of each text's lines.
FILL_SQL = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
  ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM h),
cut AS (SELECT *, len(lines)::BIGINT AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
parts AS (SELECT *, array_to_string(lines[:a], '') AS p, array_to_string(lines[a + 1:b], '') AS m, array_to_string(lines[b + 1:], '') AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

ORACLE = {
    "op1_license_scans": _licences(),
    "op2_quality_rules": RULES,
    "op4_top_k": TOP_K,
    "op7_substring_dedup": WINDOWS,
    "op9_suffix_array": BYTES,
    "op10_url_filters": _urls(),
    "op12_conversation_trie": TRIE_SQL,
    "op13_fill_middle": FILL_SQL,
}
