"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from orderflow.llm import lexical, license_scan, line_dedup, merkle, metric_join, phrases


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
bad AS (
  SELECT source, trim(line) AS line FROM lines JOIN totals USING (source)
  WHERE trim(line) <> '' GROUP BY source, trim(line), pages
  HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_PAGES}
     AND count(DISTINCT doc_id) / pages > {line_dedup.RATIO}),
marked AS (
  SELECT doc_id, n, l.line, bad.line IS NULL AS kept
  FROM lines l LEFT JOIN bad ON bad.source = l.source AND bad.line = trim(l.line))
SELECT doc_id, count(*)::INT AS n_lines, count_if(NOT kept)::INT AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (kept), '') AS text
FROM marked GROUP BY doc_id
"""

URL_FILTER = """
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut),
own AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
  FROM parts),
best AS (
  SELECT page_id, arg_max(r.host || r.path, (length(r.host || r.path), length(r.host))) AS rule,
         arg_max(r.verdict, (length(r.host || r.path), length(r.host))) AS verdict
  FROM own JOIN rules r
    ON (own.host = r.host OR ends_with(own.host, '.' || r.host)) AND starts_with(own.path, r.path)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM own LEFT JOIN best USING (page_id)
"""

_TEMPLATES = ", ".join(
    f"({i}, {_quoted(name)}, {_quoted(license_scan.normalised(text))})"
    for i, (name, text) in enumerate(license_scan.TEMPLATES)
)
_PAIRS = """list_distinct(list_transform(generate_series(1, len({w}) - 1),
           lambda i: {w}[i] || ' ' || {w}[i + 1]))"""
LICENSE_SCAN = f"""
WITH templates AS (
  SELECT rank, license, {_PAIRS.format(w="string_split(body, ' ')")} AS own
  FROM (VALUES {_TEMPLATES}) t(rank, license, body)),
units AS (
  SELECT doc_id, -1 AS line_no, text AS unit FROM documents
  UNION ALL
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1,
         unnest(string_split(text, chr(10))) FROM documents),
words AS (
  SELECT doc_id, line_no, string_split(trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
  FROM units),
paired AS (SELECT doc_id, line_no, {_PAIRS.format(w="w")} AS pairs FROM words WHERE len(w) > 1),
scored AS (
  SELECT doc_id, line_no, rank, license,
         2e0 * len(list_intersect(pairs, own)) / (len(pairs) + len(own)) AS dice
  FROM paired JOIN templates ON len(pairs) BETWEEN len(own) * 0.6 AND len(own) * 1.6),
best AS (
  SELECT doc_id, arg_max(license, (dice, -rank, -line_no)) AS license, max(dice) AS dice,
         arg_max(line_no, (dice, -rank, -line_no)) AS line_no
  FROM scored WHERE dice >= {license_scan.THRESHOLD} GROUP BY doc_id)
SELECT doc_id, license, dice, line_no::INT AS line_no FROM documents LEFT JOIN best USING (doc_id)
"""

CHAT_FORMAT = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
whole AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS said
  FROM turns GROUP BY conv_id),
inner_prefixes AS (
  SELECT DISTINCT said[1:n] AS prefix
  FROM (SELECT said, unnest(generate_series(1, len(said) - 1)) AS n FROM whole)),
kept AS (
  SELECT min(conv_id) AS conv_id, count(*) AS copies, said FROM whole
  WHERE said NOT IN (SELECT prefix FROM inner_prefixes) GROUP BY said)
SELECT conv_id, len(said) AS n_turns, copies,
       array_to_string(list_transform(said, lambda x: '<|' || x.role || '|>' || chr(10) || x.text
         || chr(10) || '<|end|>' || chr(10)), '') AS chat
FROM kept
"""

_LEAVES = f"""list_transform(regexp_extract_all({{t}}, '{merkle.PIECES}'),
           lambda x: left(sha256(x), 16))"""
_SECTIONS = """list_transform(list_filter(string_split(array_to_string(list_transform({l},
     lambda x: x || CASE WHEN left(x, 1) IN ('0', '1') THEN ';' ELSE ',' END), ''), ';'),
     lambda s: s <> ''), lambda s: rtrim(s, ','))"""
_PRINT = """sha256(array_to_string(list_transform({s}, lambda s: left(sha256(s), 32)), '')) || ':'
    || array_to_string(list_transform({s}, lambda s: left(sha256(s), 32) || '(' || s || ')'), '')"""
_LIKE = """CASE WHEN len({a}) + len({b}) = 0 THEN 1e0 ELSE 2e0 * len(list_intersect({a}, {b}))
           / (len(list_distinct({a})) + len(list_distinct({b}))) END"""
MERKLE = f"""
WITH chained AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id),
                  first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS next_text
  FROM documents),
edited AS (
  SELECT *, length(text) AS n_chars,
         left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) AS edited
  FROM chained),
trees AS (
  SELECT *, {_LEAVES.format(t="text")} AS own, {_LEAVES.format(t="edited")} AS changed,
         {_LEAVES.format(t="next_text")} AS following
  FROM edited),
sections AS (
  SELECT *, {_SECTIONS.format(l="own")} AS own_sections,
         {_SECTIONS.format(l="changed")} AS changed_sections
  FROM trees)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256,
       {_PRINT.format(s="own_sections")} AS fingerprint, {_PRINT.format(s="changed_sections")} AS edited_fingerprint,
       {_LIKE.format(a="own", b="changed")} AS near_edited,
       {_LIKE.format(a="own", b="following")} AS near_next,
       array_to_string(list_sort(list_distinct(
         list_filter(own, lambda x: NOT list_contains(changed, x)))), ',') AS gone
FROM sections
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = (
    f"unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
)

LEXICAL_SEARCH = f"""
WITH said AS (SELECT doc_id, {_TERMS} AS term FROM documents),
counted AS (SELECT doc_id, term, count(*) AS tf FROM said GROUP BY doc_id, term),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS size FROM counted GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(size)::BIGINT AS words FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, totals GROUP BY term, docs),
wanted AS (SELECT item_id, {_TERMS} AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * docs) // words))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN counted USING (term) JOIN sizes USING (doc_id), totals
  GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {lexical.BEST}
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
said AS (SELECT lang, k, w[i:i + k - 1] AS p FROM placed, (VALUES (1), (2), (3)) AS sizes(k)
         WHERE i + k - 1 <= len(w)),
grams AS (SELECT lang, k, p, count(*) AS f FROM said GROUP BY lang, k, p),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, p, f AS a FROM grams WHERE k > 1 AND f >= {phrases.LEAST}),
cuts AS (
  SELECT c.lang, c.p, a, cut, x.f AS l, y.f AS r,
         (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN grams x ON x.lang = c.lang AND x.p = c.p[:cut]
  JOIN grams y ON y.lang = c.lang AND y.p = c.p[cut + 1:]),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
around AS (
  SELECT lang, p, max(a) AS most FROM (
    SELECT lang, p[1:2] AS p, a FROM candidates WHERE k = 3
    UNION ALL SELECT lang, p[2:3], a FROM candidates WHERE k = 3) GROUP BY lang, p),
ranked AS (
  SELECT c.lang, array_to_string(c.p, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
  FROM lowest c JOIN totals t ON t.lang = c.lang
  LEFT JOIN around b ON b.lang = c.lang AND b.p = c.p
  WHERE most IS NULL OR 100 * most < {phrases.COVERED} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank,
       phrase, a, l, r, n, score
FROM ranked QUALIFY rank <= {phrases.BEST}
"""

METRIC_JOIN = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= {metric_join.COSINE} END),
counts AS (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a),
reached(vec_id, other) AS (
  SELECT a, b FROM pairs UNION SELECT r.vec_id, p.b FROM reached r JOIN pairs p ON p.a = r.other),
least AS (SELECT vec_id, min(other) AS other FROM reached GROUP BY vec_id)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id,
       vec_id <= coalesce(other, vec_id) AS kept
FROM embeddings LEFT JOIN counts USING (vec_id) LEFT JOIN least USING (vec_id)
"""

ORACLE = {
    "op2_line_dedup": LINE_DEDUP,
    "op6_merkle": MERKLE,
    "op7_url_filter": URL_FILTER,
    "op8_license_scan": LICENSE_SCAN,
    "op9_chat_format": CHAT_FORMAT,
    "op11_lexical_search": LEXICAL_SEARCH,
    "op12_collocations": COLLOCATIONS,
    "op13_metric_join": METRIC_JOIN,
}
