"""Expected results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = _WORDS.format(text="coalesce(text, '')")

SUBSTRING_DEDUP = f"""
WITH docs AS (SELECT doc_id, {_PLAIN} AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM docs),
numbered AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i + 19], ' ') ORDER BY doc_id, i) AS nth
  FROM starts),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM numbered WHERE nth > 1),
placed AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS place, unnest(ws) AS word FROM docs),
marked AS (
  SELECT p.doc_id, p.place, p.word, r.place IS NOT NULL AS gone
  FROM placed p LEFT JOIN removed r ON p.doc_id = r.doc_id AND p.place = r.place),
counted AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM docs d LEFT JOIN counted c ON d.doc_id = c.doc_id
"""

QUALITY_RULES = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {_PLAIN} AS ws FROM documents),
grams AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM docs)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM twice)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM docs),
measured AS (
  SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(ls) AS n_lines,
    length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
    length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations
  FROM docs d JOIN lines l ON d.doc_id = l.doc_id LEFT JOIN covered c ON d.doc_id = c.doc_id),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 14 * n_words
      OR 2 * n_capitals > n_letters OR 5 * n_exclamations > n_words AS more_failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT more_failed AS kept
FROM judged
"""

_CORE_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

BENCHMARK_DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_CORE_WORDS} AS ws FROM documents),
items AS (SELECT item_id, {_CORE_WORDS} AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, width, array_to_string(ws[i:i + width - 1], ' ') AS g
  FROM (SELECT item_id, ws, least(10, len(ws)) AS width, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
        FROM items WHERE len(ws) > 0)),
widths AS (SELECT DISTINCT width FROM item_windows),
doc_windows AS (
  SELECT doc_id, width, i, array_to_string(ws[i:i + width - 1], ' ') AS g
  FROM (SELECT doc_id, ws, width, unnest(range(1, len(ws) - width + 2)) AS i FROM docs, widths WHERE len(ws) >= width)),
hits AS (
  SELECT DISTINCT d.doc_id, d.i, d.width, w.item_id
  FROM doc_windows d JOIN item_windows w ON d.width = w.width AND d.g = w.g),
places AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + width)) AS place FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(p.n, 0) AS n_hit, coalesce(n.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN places p ON d.doc_id = p.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
"""

MINHASH_NEAR_DEDUP = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM docs WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS r FROM docs UNION SELECT reached.doc_id, l.b FROM reached JOIN both_ways l ON reached.r = l.a),
component AS (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM docs d JOIN component c ON d.doc_id = c.doc_id LEFT JOIN sizes s ON d.doc_id = s.doc_id
"""


EXACT_DEDUP = r"""
WITH docs AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain FROM documents),
grouped AS (
  SELECT doc_id, plain, min(doc_id) OVER (PARTITION BY plain) AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size
  FROM docs)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(plain) AS text_sha256 FROM grouped
"""

SOURCE_DIVERGENCE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
words AS (SELECT r, lang, source, unnest(ts) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w SEMI JOIN kept k ON w.lang = k.lang AND w.term = k.term
  GROUP BY w.lang, w.source, w.term),
own AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (coalesce(o.n, 0) + s.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (k.n + 1)) // (s.n + s.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN sizes s ON g.lang = s.lang
  LEFT JOIN own o ON g.lang = o.lang AND g.source = o.source
  LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

_CRC_BYTE = """list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
  lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"""

#: The cheapest edits row by row; up to two insertions may stand before a row or at the end (more never help).
#: States: 0 nothing yet, 1 system, 2 user, 3 assistant.
CONVERSATION_REPAIR = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
coded AS (
  SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, b: {_CRC_BYTE}), 4294967295) % 20 AS fault FROM keyed),
broken AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fault = 0 THEN [] WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail, substr(role, 1, 1) AS initial
  FROM broken),
faulted AS (
  SELECT *, CASE WHEN tail = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    i > 1 AND lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM placed),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n
  FROM faulted GROUP BY conv_id),
nexts(st, name, after) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
inserts AS (
  SELECT st, 0 AS cost, '' AS letters, [] AS lines, st AS after FROM nexts
  UNION ALL SELECT st, 3, 'I', [name || ':'], after FROM nexts
  UNION ALL SELECT a.st, 6, 'II', [a.name || ':', b.name || ':'], b.after FROM nexts a JOIN nexts b ON a.after = b.st),
edits AS (
  SELECT f.conv_id, f.i, n.st, 4 AS cost, 'D' AS letter, [] AS lines, n.st AS after FROM faulted f, nexts n
  UNION ALL
  SELECT f.conv_id, f.i, n.st, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R', [n.name || ':' || f.text], n.after
  FROM faulted f, nexts n WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT f.conv_id, f.i, n.st, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', [f.role || ':' || f.text],
    CASE initial WHEN 's' THEN 1 ELSE n.after END
  FROM faulted f, nexts n
  WHERE fault NOT IN ('blank', 'duplicate')
    AND (initial = 's' AND n.st = 0 OR initial = 'u' AND n.after = 2 OR initial = 'a' AND n.after = 3)),
paths AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS st, {{'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS best FROM stats
  UNION ALL
  SELECT p.conv_id, p.i + 1, e.after, min({{'cost': p.best.cost + s.cost + e.cost,
    'audit': p.best.audit || s.letters || e.letter, 'lines': p.best.lines || s.lines || e.lines}})
  FROM paths p JOIN inserts s ON p.st = s.st
  JOIN edits e ON p.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = p.i + 1 AND e.st = s.after
  GROUP BY p.conv_id, p.i + 1, e.after),
ended AS (
  SELECT p.conv_id, min({{'cost': p.best.cost + s.cost, 'audit': p.best.audit || s.letters, 'lines': p.best.lines || s.lines}}) AS best
  FROM paths p JOIN stats t ON p.conv_id IS NOT DISTINCT FROM t.conv_id AND p.i = t.n JOIN inserts s ON p.st = s.st
  WHERE s.after IN (0, 3) GROUP BY p.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats s ON c.conv_id IS NOT DISTINCT FROM s.conv_id
LEFT JOIN ended e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": SUBSTRING_DEDUP,
        "op3_quality_rules": QUALITY_RULES,
        "op4_benchmark_decontamination": BENCHMARK_DECONTAMINATION,
        "op6_minhash_near_dedup": MINHASH_NEAR_DEDUP,
        "op11_exact_dedup": EXACT_DEDUP,
        "op12_source_divergence": SOURCE_DIVERGENCE,
        "op13_conversation_repair": CONVERSATION_REPAIR,
    }
