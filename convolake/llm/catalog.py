"""Queries and oracles of the training-data operators."""

from . import (
    op1_pii, op2_cross_entropy, op3_toxicity, op4_token_file, op5_sentencepiece, op6_embedding, op7_html, op8_quality, op9_decontaminate, op10_simhash, op11_fim, op12_hnsw,
    op13_conversations,
)

QUERIES = {
    "op1_pii_skip_chain_crf": op1_pii.query,
    "op2_cross_entropy_difference": op2_cross_entropy.query,
    "op3_toxicity_cnn": op3_toxicity.query,
    "op4_token_file": op4_token_file.query,
    "op5_sentencepiece": op5_sentencepiece.query,
    "op6_embedding_lsh": op6_embedding.query,
    "op7_html_text_density": op7_html.query,
    "op8_quality_fourier_ridge": op8_quality.query,
    "op9_benchmark_decontamination": op9_decontaminate.query,
    "op10_simhash_near_dedup": op10_simhash.query,
    "op11_fill_in_middle_rope": op11_fim.query,
    "op12_hnsw_neighbours": op12_hnsw.query,
    "op13_conversation_repair": op13_conversations.query,
}

# A label learnt from data, a hash that SQL lacks, or a tokenizer stands between the other operators and SQL; tests hold
# them against brute force.
ORACLES = {
    "op6_embedding_lsh": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), fine AS (
  SELECT * FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x) * list_dot_product(b.x, b.x)) >= 0.9
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, (SELECT min(b) FROM reach WHERE a = vec_id) AS component_id,
  vec_id = (SELECT min(b) FROM reach WHERE a = vec_id) AS kept
FROM v""",
    "op9_benchmark_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, w[k:k + least(len(w), 10) - 1] AS words FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT len(words) AS n FROM windows
), places AS (
  SELECT doc_id, k, n, w[k:k + n - 1] AS words FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
), found AS (
  SELECT doc_id, k, n, item_id FROM places JOIN windows USING (words)
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM (SELECT DISTINCT doc_id, k, n FROM found)) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_fill_in_middle_rope": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents
), k AS (
  SELECT *, len(w) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d
), f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k
), p AS (
  SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:n], '') AS suffix FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p""",
    "op12_hnsw_neighbours": """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), fine AS (
  SELECT * FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0
), near AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.x, c.x) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.x, c.x), c.vec_id) AS place
  FROM fine q JOIN fine c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM near WHERE place <= 10""",
    "op13_conversation_repair": r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda c, b: list_reduce(CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[]), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 20 AS kind
  FROM conversations
), rows_ AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM raw
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut FROM rows_
), marked AS (
  SELECT conv_id, turn, role, text, k, left(role, 1) AS i, cut = '' AS blank, again, NOT (right(cut, 1) IN ('.', '!', '?')) AS open,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS was FROM numbered
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(again AND NOT blank) AS duplicate,
    count_if(open AND NOT blank AND NOT again) AS truncated, count_if(was IS NOT NULL AND NOT (was || i) IN ('su', 'ua', 'au')) AS illegal, max(k) AS n FROM marked GROUP BY conv_id
), ins(f, t, letters, lines) AS (
  VALUES (0, 0, '', ''), (1, 1, '', ''), (2, 2, '', ''), (3, 3, '', ''), (0, 2, 'I', chr(10) || 'user:'), (1, 2, 'I', chr(10) || 'user:'), (3, 2, 'I', chr(10) || 'user:'), (2, 3, 'I', chr(10) || 'assistant:'),
    (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), edits AS (
  SELECT m.*, s.f, s.t, s.e, s.e_cost + CASE WHEN s.e <> 'D' AND open THEN 3 ELSE 0 END AS e_cost, CASE s.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || s.named || ':' || text END AS line
  FROM marked m JOIN (VALUES (0, 0, 'D', 4, '', ''), (1, 1, 'D', 4, '', ''), (2, 2, 'D', 4, '', ''), (3, 3, 'D', 4, '', ''), (0, 2, 'R', 3, '', 'user'), (1, 2, 'R', 3, '', 'user'), (2, 3, 'R', 3, '', 'assistant'), (3, 2, 'R', 3, '', 'user'),
    (0, 1, 'K', 0, 's', ''), (0, 2, 'K', 0, 'u', ''), (1, 2, 'K', 0, 'u', ''), (2, 3, 'K', 0, 'a', ''), (3, 2, 'K', 0, 'u', ''), (0, 0, 'K', 0, '', ''), (1, 1, 'K', 0, '', ''), (2, 2, 'K', 0, '', ''), (3, 3, 'K', 0, '', '')) s(f, t, e, e_cost, initial, named)
    ON s.e = 'D' OR (NOT m.blank AND NOT m.again AND (s.e = 'R' OR s.initial = m.i))
), way(conv_id, k, t, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), ins.t, {'cost': 3 * length(letters), 'audit': letters, 'lines': lines} FROM counts, ins WHERE ins.f = 0
  UNION ALL
  SELECT w.conv_id, w.k + 1, ins.t, min({'cost': w.best.cost + e.e_cost + 3 * length(letters), 'audit': w.best.audit || e.e || letters, 'lines': w.best.lines || e.line || ins.lines})
  FROM way w JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.k = w.k + 1 AND e.f = w.t JOIN ins ON ins.f = e.t GROUP BY w.conv_id, w.k, ins.t
), done AS (
  SELECT c.conv_id, min(w.best) AS best FROM counts c JOIN way w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.k = c.n AND w.t IN (0, 3) GROUP BY c.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank, CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal,
  CAST(coalesce(d.best.cost, 0) AS BIGINT) AS cost, coalesce(d.best.audit, '') AS audit, sha256(coalesce(d.best.lines[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id""",
}
