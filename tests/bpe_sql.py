"""Byte-pair training and encoding as SQL, for a vocabulary small enough for it."""

from __future__ import annotations

from corpusloom.plans.common import sql_words

MERGES = 60

# Training as SQL: one recursion step per merge, all words as one list of
# (word, n, seg) where seg holds symbol ids between two marks.
SQL_BPE = f"""WITH RECURSIVE split_docs AS (SELECT doc_id, {sql_words('text')} AS ws FROM documents),
doc_words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM split_docs),
wf AS (SELECT word, count(*) AS n FROM doc_words GROUP BY word),
alphabet AS (SELECT c, row_number() OVER (ORDER BY c) + 3 AS id
  FROM (SELECT DISTINCT unnest(string_split(word, '')) AS c FROM wf)),
start AS (SELECT word, n, string_agg(',' || id || ';', '' ORDER BY i) AS seg
  FROM (SELECT word, n, unnest(string_split(word, '')) AS c, generate_subscripts(string_split(word, ''), 1) AS i FROM wf)
  JOIN alphabet USING (c) GROUP BY word, n),
g AS (
  SELECT 0 AS step, (SELECT list(struct_pack(word := word, n := n, seg := seg)) FROM start) AS ws,
    list_concat(['<unk>', '<s>', '</s>', '<pad>'], (SELECT list(c ORDER BY id) FROM alphabet)) AS tokens,
    NULL::BIGINT AS l, NULL::BIGINT AS r
  UNION ALL
  SELECT step + 1,
    list_transform(ws, lambda w: struct_pack(word := w.word, n := w.n,
      seg := replace(w.seg, ',' || t.l || ';,' || t.r || ';',
        ',' || (coalesce(list_position(tokens, tokens[t.l + 1] || tokens[t.r + 1]), len(tokens) + 1) - 1) || ';'))),
    CASE WHEN list_contains(tokens, tokens[t.l + 1] || tokens[t.r + 1]) THEN tokens
      ELSE list_append(tokens, tokens[t.l + 1] || tokens[t.r + 1]) END,
    t.l, t.r
  FROM g, (
    SELECT ids[i]::BIGINT AS l, ids[i + 1]::BIGINT AS r FROM (
      SELECT ids, n, unnest(range(1, len(ids))) AS i FROM (
        SELECT regexp_extract_all(w.seg, '[0-9]+') AS ids, w.n AS n FROM (SELECT unnest(ws) AS w FROM g)))
    GROUP BY ALL ORDER BY sum(n) DESC, l, r LIMIT 1) t
  WHERE step < {MERGES}),
done AS (SELECT ws, tokens FROM g ORDER BY step DESC LIMIT 1),
encoded AS (SELECT w.word AS word, regexp_extract_all(w.seg, '[0-9]+') AS ids FROM (SELECT unnest(ws) AS w FROM done)),
vocab AS (SELECT generate_subscripts(tokens, 1) - 1 AS id, unnest(tokens) AS token FROM done),
word_tokens AS (SELECT word, string_agg(token, ' ' ORDER BY i) AS text, list(token ORDER BY i) AS tokens
  FROM (SELECT word, unnest(ids)::BIGINT AS id, generate_subscripts(ids, 1) AS i FROM encoded) JOIN vocab USING (id) GROUP BY word)
"""

SQL_MERGES = SQL_BPE + """SELECT step - 1 AS rank, tokens[l + 1] AS "left", tokens[r + 1] AS "right",
  tokens[l + 1] || tokens[r + 1] AS merged FROM g WHERE step > 0"""
SQL_ENCODE = SQL_BPE + """SELECT doc_id, string_agg(array_to_string(ids, ' '), ' ' ORDER BY pos) AS ids
FROM doc_words JOIN encoded USING (word) GROUP BY doc_id"""
SQL_DECODE = SQL_BPE + """SELECT doc_id, string_agg(text, ' ' ORDER BY pos) AS text,
  string_agg(text, ' ' ORDER BY pos) || ' </s>' AS text_with_specials
FROM doc_words JOIN word_tokens USING (word) GROUP BY doc_id"""
SQL_TOKENS = SQL_BPE + """SELECT token, count(*) AS n, count(DISTINCT doc_id) AS n_docs
FROM (SELECT doc_id, unnest(tokens) AS token FROM doc_words JOIN word_tokens USING (word)) GROUP BY token"""
