"""DuckDB SQL for the operators that SQL can express, each from its definition."""

from __future__ import annotations

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

# Repeated windows: of words, and of bytes as pairs of hexadecimal digits.
SUBSTRING_DEDUP = f"""
WITH parts AS (SELECT doc_id, {WORDS} AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM parts)),
firsts AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k HAVING min(doc_id) < max(doc_id)),
covered AS (SELECT doc_id, list(DISTINCT j) AS gone
            FROM (SELECT doc_id, unnest(range(i, i + 13)) AS j FROM windows JOIN firsts USING (k) WHERE first < doc_id)
            GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN ws
              ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda j: NOT list_contains(gone, j)), lambda j: ws[j]) END,
              ' ')) AS kept_sha256
FROM parts LEFT JOIN covered USING (doc_id)"""

SUFFIX_DEDUP = """
WITH parts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, md5_number(substr(h, (2 * i + 1)::BIGINT, 100)) AS k
            FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM parts)),
firsts AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE first < doc_id),
edges AS (SELECT doc_id, i, coalesce(i > 50 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true) AS opens FROM hits),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS z
          FROM (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges)
          GROUP BY doc_id, run),
cuts AS (SELECT doc_id, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed,
                list(a ORDER BY a) AS begins, list(z ORDER BY a) AS ends FROM spans GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN begins IS NULL THEN h ELSE array_to_string(list_transform(
              list_zip(list_prepend(0, ends), list_append(begins, len(h) // 2)),
              lambda s: substr(h, (2 * s[1] + 1)::BIGINT, (2 * (s[2] - s[1]))::BIGINT)), '') END)) AS kept_sha256
FROM parts LEFT JOIN cuts USING (doc_id)"""

COMPONENTS = f"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
parts AS (SELECT doc_id, {WORDS} AS ws FROM lowered),
sets AS (SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3),
                lambda i: array_to_string(ws[i:i + 4], ' '))) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS s
         FROM parts),
classes AS (SELECT min(doc_id) AS c, any_value(s) AS s, len(any_value(s)) AS n FROM sets WHERE len(s) > 0
            GROUP BY list_sort(s)),
shingles AS (SELECT c, n, unnest(s) AS g FROM classes),
links AS (SELECT a.c AS x, b.c AS y FROM shingles a JOIN shingles b ON a.g = b.g AND a.c < b.c
          GROUP BY a.c, b.c HAVING 100 * count(*) >= %d * (any_value(a.n) + any_value(b.n) - count(*))),
linked AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT c AS x, c AS y FROM classes UNION SELECT r.x, b.y FROM reach r JOIN linked b ON r.y = b.x),
roots AS (SELECT x, min(y) AS component FROM reach GROUP BY x)
SELECT sets.doc_id, len(sets.s) AS n_shingles, coalesce(component, sets.doc_id) AS component_id
FROM sets LEFT JOIN classes ON list_sort(sets.s) = list_sort(classes.s) AND len(sets.s) > 0
LEFT JOIN roots ON x = c"""
NEAR_DUPLICATES = f"SELECT *, component_id = doc_id AS kept FROM ({COMPONENTS % 75})"

# crc32, byte by byte over the hexadecimal digits of a text's UTF-8.
CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY b) AS crcs FROM (SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda y, z: xor(y >> 1, 3988292384 * (y & 1))) AS c FROM range(256) AS r(b)))"""


def crc32(hexed: str) -> str:
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
         range(len({hexed}) // 2), lambda i: ('0x' || substr({hexed}, (2 * i + 1)::BIGINT, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, crcs[1 + (xor(c, b) & 255)])))"""


SPELLING_VARIANTS = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, run, count(*) AS k
         FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
         WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, k, {crc32('x')} AS h
           FROM (SELECT run, k, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs), crc_table),
words AS (SELECT word, sum(k)::BIGINT AS n
          FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                            ELSE run END AS word, k FROM hashed)
          WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
masked AS (SELECT word, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask,
                  substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM places),
pairs AS (SELECT DISTINCT a.word AS a, b.word AS b FROM masked a JOIN masked b ON a.mask = b.mask AND a.word <> b.word
          UNION SELECT word, cut FROM masked WHERE cut IN (SELECT word FROM words)
          UNION SELECT cut, word FROM masked WHERE cut IN (SELECT word FROM words)),
near AS (SELECT a AS word, count(*) AS n_near, min({{'rank': -n, 'word': b}}) AS most
         FROM pairs JOIN words ON b = word GROUP BY a),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near,
                  CASE WHEN -most.rank >= 10 * n THEN most.word END AS form,
                  CASE WHEN -most.rank >= 10 * n THEN -most.rank END AS form_n
           FROM words LEFT JOIN near USING (word)),
chain AS (SELECT word, word AS tip FROM formed
          UNION ALL SELECT chain.word, form FROM chain JOIN formed ON tip = formed.word WHERE form IS NOT NULL)
SELECT word, n, n_near, form, form_n, tip AS root
FROM formed JOIN (SELECT chain.word, tip FROM chain JOIN formed f ON tip = f.word WHERE f.form IS NULL) USING (word)"""

# States: 0 nothing yet, 1 system, 2 user, 3 assistant. The recursion keeps, for each state, the least cost, then
# the least edits, and the text that they give.
CONVERSATION_REPAIR = f"""
WITH RECURSIVE {CRC_TABLE},
hashed AS (SELECT *, {crc32('x')} % 20 AS h
           FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                        hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS x
                 FROM conversations), crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
                   CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM hashed WHERE h <> 0),
marked AS (SELECT *, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i
           FROM damaged),
told AS (SELECT *, i > min(i) OVER (PARTITION BY conv_id, role, text) AS again FROM marked),
lines AS (SELECT *, left(role, 1) AS initial, final = '' AS blank, final <> '' AND again AS twice,
               NOT again AND final NOT IN ('', '.', '!', '?') AS truncated,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM told),
insertions(a, q, c, e, d) AS (VALUES
  (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 3, 'I', chr(10) || 'user:'), (1, 2, 3, 'I', chr(10) || 'user:'), (3, 2, 3, 'I', chr(10) || 'user:'),
  (2, 3, 3, 'I', chr(10) || 'assistant:'), (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
own(q, b, c, e, initial, role) AS (VALUES
  (0, 0, 4, 'D', NULL, NULL), (1, 1, 4, 'D', NULL, NULL), (2, 2, 4, 'D', NULL, NULL), (3, 3, 4, 'D', NULL, NULL),
  (0, 1, 0, 'K', 's', NULL), (0, 2, 0, 'K', 'u', NULL), (1, 2, 0, 'K', 'u', NULL), (3, 2, 0, 'K', 'u', NULL),
  (2, 3, 0, 'K', 'a', NULL),
  (0, 2, 3, 'R', NULL, 'user'), (1, 2, 3, 'R', NULL, 'user'), (3, 2, 3, 'R', NULL, 'user'), (2, 3, 3, 'R', NULL, 'assistant')),
best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, {{'c': 0::BIGINT, 'e': '', 'd': ''}} AS x FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT p.conv_id, r.i, o.b, min({{'c': p.x.c + j.c + o.c + CASE WHEN o.e <> 'D' AND truncated THEN 3 ELSE 0 END,
         'e': p.x.e || j.e || o.e,
         'd': p.x.d || j.d || CASE WHEN o.e = 'D' THEN '' ELSE chr(10) || coalesce(o.role, r.role) || ':' || r.text END}})
  FROM best p JOIN lines r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
  JOIN insertions j ON j.a = p.state
  JOIN own o ON o.q = j.q AND (o.e = 'D' OR NOT (blank OR twice)) AND (o.e <> 'K' OR o.initial = r.initial)
  GROUP BY p.conv_id, r.i, o.b),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                  sum(blank::INT) AS blank, sum(twice::INT) AS duplicate, sum(truncated::INT) AS truncated,
                  sum((i > 1 AND before || initial NOT IN ('su', 'ua', 'au'))::INT) AS illegal
           FROM lines GROUP BY conv_id),
ends AS (SELECT b.conv_id, min({{'c': x.c + j.c, 'e': x.e || j.e, 'd': x.d || j.d}}) AS x
         FROM best b LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM b.conv_id
         JOIN insertions j ON j.a = b.state AND (j.q = 3 OR j.q = 0)
         WHERE b.i = coalesce(n, 0) GROUP BY b.conv_id)
SELECT ends.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, x.c AS cost, x.e AS audit, sha256(substr(x.d, 2)) AS repaired_sha256
FROM ends LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ends.conv_id"""

ORACLE = {
    "op5_suffix_dedup": SUFFIX_DEDUP,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op8_near_duplicates": NEAR_DUPLICATES,
    "op11_spelling_variants": SPELLING_VARIANTS,
    "op12_conversation_repair": CONVERSATION_REPAIR,
    "op13_jaccard_join": COMPONENTS % 80,
}
