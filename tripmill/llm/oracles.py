"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from tripmill.llm.license_scan import TEMPLATES

ORACLES: dict[str, str] = {}

ORACLES["op5_line_dedup"] = """
WITH docs AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), windows AS (
  SELECT doc_id, i, lines[i:i + 2] AS w
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM docs)
), ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM windows
), covered AS (
  SELECT DISTINCT doc_id, i + step AS i FROM ranked, (VALUES (0), (1), (2)) s(step) WHERE k > 1
), numbered AS (
  SELECT doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM docs
), kept AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.i) FILTER (WHERE c.i IS NULL) AS text,
         count(*) AS n_lines, count(c.i) AS n_removed
  FROM numbered n LEFT JOIN covered c USING (doc_id, i) GROUP BY n.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

ORACLES["op3_decontamination"] = r"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), items AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), phrases AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS phrase, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM phrases),
windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)
), hits AS (SELECT doc_id, i, n, item_id FROM windows JOIN phrases USING (n, phrase)),
per_word AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1
), per_item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN per_word USING (doc_id) LEFT JOIN per_item USING (doc_id)
"""


def _values(rows: tuple[tuple[str, str], ...]) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


ORACLES["op1_license_scan"] = rf"""
WITH units AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM documents
  UNION ALL SELECT doc_id, text FROM documents WHERE contains(text, chr(10))
), templates(license, unit) AS (VALUES {_values(TEMPLATES)}),
unit_words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM units
), template_words AS (
  SELECT license, list_filter(string_split_regex(
    translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM templates
), a AS (
  SELECT doc_id, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS s FROM unit_words WHERE len(w) > 1
), b AS (
  SELECT license, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS s FROM template_words
), scored AS (
  SELECT doc_id, license, 2.0::DOUBLE * len(list_intersect(a.s, b.s)) / (len(a.s) + len(b.s)) AS dice
  FROM a JOIN b ON len(a.s) <= 2 * len(b.s) AND len(b.s) <= 2 * len(a.s)
), best AS (
  SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
         first(license ORDER BY dice DESC, license) AS best_license, max(dice) AS best_dice
  FROM scored WHERE dice >= 0.75 GROUP BY doc_id
)
SELECT doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses, best_license, best_dice
FROM documents LEFT JOIN best USING (doc_id)
"""

ORACLES["op13_filter_audit"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(w) < 200,
     100 * len(list_distinct(w)) < 50 * len(w),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
     regexp_matches(text, '[#$%&*|]'),
     coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM docs LEFT JOIN marks USING (doc_id)
), sets AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM judged GROUP BY part, fails
), letters(x) AS (VALUES (1), (2), (3), (4), (5)),
orders AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (SELECT o, step FROM orders, (SELECT unnest(range(1, 6)) AS step)),
counted AS (
  SELECT part, o, step, o[step] AS own, n, n_good, n_toxic, fails[o[step]] AS fails_own,
         len(list_filter(o[1:step - 1], lambda k: fails[k])) > 0 AS gone,
         len(list_filter(fails, lambda f: f)) AS n_fails
  FROM sets, steps
), per_step AS (
  SELECT part, o, step, own,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails_own), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND fails_own), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND fails_own), 0) AS redundant,
         coalesce(sum(n) FILTER (fails_own AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(n_good) FILTER (NOT gone AND fails_own), 0) AS good_lost,
         coalesce(sum(n_toxic) FILTER (NOT gone AND fails_own), 0) AS toxic_lost
  FROM counted GROUP BY part, o, step, own
)
SELECT part, array_to_string(list_transform(o, lambda k: substr('ABCDE', k, 1)), '') AS filter_order, CAST(step AS INTEGER) AS step,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM per_step
"""

ORACLES["op12_conversation_trie"] = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS r, role, text,
         len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n_words
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), lists AS (
  SELECT conv_id, list(sha256(length(role) || ':' || role || text) ORDER BY r) AS t, list(n_words ORDER BY r) AS w
  FROM turns GROUP BY conv_id
), heads AS (
  SELECT conv_id, t, w, conv_id - conv_id % 20 AS base,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
        lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))) % 4 AS h
  FROM lists
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.t[1:c.h], []), c.t[c.h + 1:]) AS t,
         list_concat(coalesce(b.w[1:c.h], []), c.w[c.h + 1:]) AS w
  FROM heads c LEFT JOIN lists b ON b.conv_id = c.base
), prefixes AS (
  SELECT conv_id, d, len(t) AS n, w[d] AS n_words, array_to_string(t[1:d], '') AS key,
         CASE WHEN d > 0 THEN array_to_string(t[1:d - 1], '') END AS pkey
  FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT key, any_value(pkey) AS pkey, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * coalesce(any_value(n_words), 0) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM prefixes GROUP BY key
), children AS (SELECT pkey AS key, count(*) AS n_children FROM nodes WHERE pkey IS NOT NULL GROUP BY pkey),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (key)),
sums AS (
  SELECT p.key, count(*) FILTER (x.n_children = 0) AS n_leaves, sum(x.saved) AS saved_tokens
  FROM full_nodes x JOIN prefixes p ON p.conv_id = x.conv_id AND p.d <= x.d GROUP BY p.key
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums USING (key) LEFT JOIN nodes p ON p.key = n.pkey
"""

ORACLES["op11_web_archives"] = r"""
WITH hashed AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), ranked AS (
  SELECT *, row_number() OVER same AS k, first_value(page_id) OVER same AS first_id
  FROM hashed WINDOW same AS (PARTITION BY html ORDER BY page_id NULLS LAST, url NULLS LAST)
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform(range(0, 4), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST((CAST('0x' || substr(hex, 5 * g + 1, 5) AS BIGINT) // [32768, 1024, 32, 1][i + 1]) % 32 AS BIGINT) + 1, 1)), '')), '')
         AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN first_id END AS refers_to
FROM ranked
"""
