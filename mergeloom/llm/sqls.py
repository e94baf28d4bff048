"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_OP1 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AND chars = first_value(chars) OVER w AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP5 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM benchmark),
s AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM s)),
sizes AS (SELECT DISTINCT n FROM s),
doc_windows AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP10 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT x AS doc_id, x AS seen FROM both_ways
  UNION
  SELECT r.doc_id, y FROM reach r JOIN both_ways ON r.seen = x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(min(r.seen), d.doc_id), d.doc_id) AS component_id,
       coalesce(least(min(r.seen), d.doc_id), d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach r USING (doc_id)
GROUP BY d.doc_id, n.n
"""


_CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''), lambda c: ord(c)::UBIGINT)), "
    "lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"
)

# Parsing states by what a repaired conversation ends in: nothing yet, s, u, a. `ins` lists what insertions can do between rows.
_OP12 = rf"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS damage
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN damage = 1 THEN '' WHEN damage = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN damage = 3 THEN [0, 1] ELSE [0] END) AS twin
  FROM c WHERE damage <> 0),
o AS (
  SELECT *, row_number() OVER w AS i,
         lag(left(role, 1)) OVER w AS before, left(role, 1) AS own
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), text, twin)),
f AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, CASE WHEN NOT regexp_matches(text, '[^ 	

]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][ 	

]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
ins(st, after, n, lines) AS (
  VALUES ('0', '0', 0, []), ('s', 's', 0, []), ('u', 'u', 0, []), ('a', 'a', 0, []),
         ('0', 'u', 1, ['user:']), ('s', 'u', 1, ['user:']), ('a', 'u', 1, ['user:']), ('u', 'a', 1, ['assistant:']),
         ('0', 'a', 2, ['user:', 'assistant:']), ('s', 'a', 2, ['user:', 'assistant:'])),
does(st, after, edit, role) AS (
  VALUES ('0', '0', 'D', NULL), ('s', 's', 'D', NULL), ('u', 'u', 'D', NULL), ('a', 'a', 'D', NULL),
         ('0', 's', 'K', 's'), ('0', 'u', 'K', 'u'), ('s', 'u', 'K', 'u'), ('a', 'u', 'K', 'u'), ('u', 'a', 'K', 'a'),
         ('0', 'u', 'R', 'user'), ('s', 'u', 'R', 'user'), ('a', 'u', 'R', 'user'), ('u', 'a', 'R', 'assistant')),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '0' AS st, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM conversations
  UNION ALL
  SELECT conv_id, i, st, cost, audit, lines FROM (
    SELECT w.conv_id, f.i, e.after AS st, w.audit || repeat('I', ins.n) || e.edit AS audit,
           w.cost + 5 * ins.n + CASE e.edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
             + CASE WHEN f.fault = 'truncated' AND e.edit <> 'D' THEN 5 ELSE 0 END AS cost,
           list_concat(w.lines, list_concat(ins.lines,
             CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [e.role || ':' || f.text] END)) AS lines
    FROM walk w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    JOIN ins ON ins.st = w.st JOIN does e ON e.st = ins.after
    WHERE (e.edit <> 'K' OR f.own = e.role) AND (e.edit <> 'R' OR f.own <> left(e.role, 1))
      AND (e.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
    ) QUALIFY row_number() OVER (PARTITION BY conv_id, st ORDER BY cost, audit) = 1),
ends AS (
  SELECT * FROM (SELECT w.conv_id, w.cost + 5 * ins.n AS cost, w.audit || repeat('I', ins.n) AS audit, list_concat(w.lines, ins.lines) AS lines
  FROM walk w JOIN ins ON ins.st = w.st
  WHERE ins.after IN ('0', 'a') AND w.i = coalesce((SELECT max(i) FROM f WHERE f.conv_id IS NOT DISTINCT FROM w.conv_id), 0)
  ) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || own NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
       sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def sql() -> dict[str, str]:
    return {"op1_exact_dedup": _OP1, "op5_decontamination": _OP5, "op10_near_dedup": _OP10, "op12_conversation_repair": _OP12}
