"""SQL counterparts of the queries that SQL can express; the others are tested against brute force in tests/llm."""

LINES = r"""
WITH pieces AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos
  FROM documents),
units AS (
  SELECT doc_id, pos, line, trim(regexp_replace(lower(line), '[\t\x0B\f\r ]+', ' ', 'g'), ' ') AS unit,
    coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM pieces),
judged AS (
  SELECT *, unit <> '' AND row_number() OVER (PARTITION BY unit ORDER BY doc_id, pos) > 1 AS late FROM units)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_units, CAST(count(*) FILTER (late) AS BIGINT) AS units_removed,
  CAST(coalesce(sum(length(line)) FILTER (late), 0) AS BIGINT) AS n_removed,
  coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(start + length(line) AS BIGINT), ',' ORDER BY pos) FILTER (late), '') AS removed,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT late), '') AS kept_text
FROM judged GROUP BY doc_id
"""

TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

FILL_IN_MIDDLE = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
numbers AS (
  SELECT doc_id, text, n, list_transform([1, 9, 17, 25], lambda p: CAST('0x' || substr(hex, p, 8) AS BIGINT)) AS h FROM drawn),
cut AS (
  SELECT doc_id, text, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, substr(text, 1, low) AS prefix, substr(text, low + 1, high - low) AS middle, substr(text, high + 1) AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

EQUAL_TEXTS = r"""
WITH cleaned AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm, text FROM documents),
ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id FROM cleaned
  WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST, text))
SELECT doc_id, keep_id, count(*) OVER (PARTITION BY norm) AS group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM ranked
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
starts AS (SELECT lang, words, unnest(generate_series(1, len(words))) AS i FROM listed WHERE len(words) > 0),
grams AS MATERIALIZED (
  SELECT lang, 1 AS m, words[i] AS g FROM starts
  UNION ALL SELECT lang, 2, array_to_string(words[i:i + 1], ' ') FROM starts WHERE i + 1 <= len(words)
  UNION ALL SELECT lang, 3, array_to_string(words[i:i + 2], ' ') FROM starts WHERE i + 2 <= len(words)
  UNION ALL SELECT lang, 4, array_to_string(words[i:i + 3], ' ') FROM starts WHERE i + 3 <= len(words)),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang),
counted AS MATERIALIZED (SELECT lang, m, g, string_split(g, ' ') AS w, count(*) AS a FROM grams GROUP BY lang, m, g HAVING count(*) >= 30),
cuts AS (
  SELECT lang, g, a, k, array_to_string(w[1:k], ' ') AS first_part, array_to_string(w[k + 1:m], ' ') AS rest
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM counted WHERE m > 1)),
lowest AS (
  SELECT c.lang, c.g, c.a, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a::HUGEINT + y.a) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.g = c.first_part JOIN counted y ON y.lang = c.lang AND y.g = c.rest
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, k) = 1),
within AS (
  SELECT lang, array_to_string(w[1:m - 1], ' ') AS g, a FROM counted WHERE m > 2
  UNION ALL SELECT lang, array_to_string(w[2:m], ' '), a FROM counted WHERE m > 2
  UNION ALL SELECT lang, array_to_string(w[s:s + 1], ' '), a FROM counted, (VALUES (1), (2), (3)) AS places(s) WHERE m = 4),
largest AS (SELECT lang, g, max(a) AS longer FROM within GROUP BY lang, g),
kept AS (SELECT c.* FROM lowest c LEFT JOIN largest d ON d.lang = c.lang AND d.g = c.g WHERE 100::HUGEINT * coalesce(d.longer, 0) < 80::HUGEINT * c.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

ORACLES = {
    "op8_line_dedup": LINES, "op10_block_topk": TOP_K, "op11_chunk_fim": FILL_IN_MIDDLE, "op12_block_naming": EQUAL_TEXTS,
    "op13_stripes": COLLOCATIONS,
}
