"""DuckDB SQL for the queries that SQL can express.

op1 and op2 need the tokenizer, op3 draws at random, op4 and op6 find their
links by MinHash and join them by an iterated union-find, op7 cuts a graph
per page and op10 learns: these are tested against brute force instead.
"""

from .merkle_sql import MERKLE

EXACT_DEDUP = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""

_WORD = r"[^\x20\x09-\x0D]+"

QUALITY_RULES = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '{_WORD}') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM t),
windows AS (SELECT rid, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) >= 5),
keyed AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS k FROM windows),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM keyed) WHERE c > 1),
again AS (SELECT rid, count(DISTINCT i + j) AS n_repeat_words FROM twice, range(5) AS r(j) GROUP BY rid),
c AS (SELECT t.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM t JOIN w USING (rid) LEFT JOIN again USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
ratios AS (SELECT rid, lang, source, unnest([
    {{'rule': 'word_length', 'v': 100 * word_chars // n_words}}, {{'rule': 'symbols', 'v': 1000 * n_symbols // n_words}},
    {{'rule': 'dup_lines', 'v': 1000 * n_dup_lines // greatest(n_lines, 1)}}, {{'rule': 'repeats', 'v': 1000 * n_repeat_words // n_words}}]) AS x
    FROM b WHERE NOT base_failed),
v AS (SELECT rid, lang, source, x.rule AS rule, CAST(x.v AS BIGINT) AS v FROM ratios),
q AS (SELECT *, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS bucket FROM v),
levels AS (
  SELECT 'pair' AS level, lang, source, rule, bucket, count(*) AS n FROM q GROUP BY lang, source, rule, bucket
  UNION ALL SELECT 'lang', lang, NULL, rule, bucket, count(*) FROM q GROUP BY lang, rule, bucket
  UNION ALL SELECT 'all', NULL, NULL, rule, bucket, count(*) FROM q GROUP BY rule, bucket),
run AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rule ORDER BY bucket) AS up,
               sum(n) OVER (PARTITION BY level, lang, source, rule) AS total FROM levels),
quartiles AS (SELECT level, lang, source, rule, max(total) AS total, min(bucket) FILTER (WHERE 4 * up >= total) AS q1,
                     min(bucket) FILTER (WHERE 4 * up >= 3 * total) AS q3 FROM run GROUP BY level, lang, source, rule),
fences AS (SELECT level, lang, source, rule, total, CASE WHEN rule = 'word_length' THEN q1 - 3 * (q3 - q1) - 250 END AS lo,
                  q3 + 3 * (q3 - q1) + CASE rule WHEN 'word_length' THEN 250 WHEN 'symbols' THEN 100 WHEN 'dup_lines' THEN 600 ELSE 200 END AS hi
           FROM quartiles),
ranked AS (
  SELECT v.rid, v.v, f.lo, f.hi,
         row_number() OVER (PARTITION BY v.rid, v.rule ORDER BY CASE f.level WHEN 'pair' THEN 0 WHEN 'lang' THEN 1 ELSE 2 END) AS choice
  FROM v JOIN fences f ON f.rule = v.rule AND f.total >= 100
   AND (f.level = 'all' OR f.lang IS NOT DISTINCT FROM v.lang AND (f.level = 'lang' OR f.source IS NOT DISTINCT FROM v.source))),
outside AS (SELECT DISTINCT rid FROM ranked WHERE choice = 1 AND (v > hi OR v < lo))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM outside) AS kept
FROM b
"""

CHAT_FORMAT = """
WITH c AS (SELECT conv_id, turn, role, text, coalesce(text, '') AS t FROM conversations),
e AS (
  SELECT conv_id, turn, -1 AS level, 0 AS k, 'message' AS kind, NULL AS call_id, NULL AS linked, '' AS problems,
         '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":' || CAST(to_json(role) AS VARCHAR) || '}' AS json FROM c
  UNION ALL
  SELECT conv_id, turn, 0, 1, 'call', 'r' || turn, true, '',
         '{"arguments":{"query":' || CAST(to_json(t) AS VARCHAR) || ',"words":' || len(regexp_extract_all(t, '[^ \n]+'))
         || '},"id":"r' || turn || '","name":"retrieve","role":"assistant"}' FROM c WHERE role = 'user'
  UNION ALL
  SELECT conv_id, turn, 0, 2, 'result', 'r' || turn, true, '',
         '{"content":"' || len(regexp_extract_all(t, '[^ \n]+')) || ' words","role":"tool","tool_call_id":"r' || turn || '"}' FROM c WHERE role = 'user'
  UNION ALL
  SELECT conv_id, turn, 1, 1, 'call', 'a' || turn,
         EXISTS (SELECT 1 FROM c AS n WHERE n.conv_id = c.conv_id AND n.turn = c.turn + 1 AND n.role = 'assistant'), '',
         '{"arguments":{"source":{"$ref":"r' || turn || '"}},"id":"a' || turn || '","name":"answer","role":"assistant"}' FROM c WHERE role = 'user'
  UNION ALL
  SELECT conv_id, turn, CASE WHEN asked THEN 1 ELSE 0 END, 2, 'result', 'a' || (turn - 1), asked, '',
         '{"content":' || CAST(to_json(t) AS VARCHAR) || ',"role":"tool","tool_call_id":"a' || (turn - 1) || '"}'
  FROM (SELECT *, EXISTS (SELECT 1 FROM c AS n WHERE n.conv_id = c.conv_id AND n.turn = c.turn - 1 AND n.role = 'user') AS asked
        FROM c WHERE role = 'assistant')
  UNION ALL
  SELECT conv_id, turn, 0, 1, 'call', 's' || turn, false, 'missing mode',
         '{"arguments":{"prompt":' || CAST(to_json(t) AS VARCHAR) || '},"id":"s' || turn || '","name":"configure","role":"assistant"}'
  FROM c WHERE role = 'system')
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, level, k, call_id NULLS FIRST, json) - 1 AS seq,
       turn, kind, call_id, linked, problems, json
FROM e
"""

ORACLE = {
    "op5_exact_dedup": EXACT_DEDUP,
    "op8_chat_format": CHAT_FORMAT,
    "op9_quality_rules": QUALITY_RULES,
    "op13_merkle_manifest": MERKLE,
}
