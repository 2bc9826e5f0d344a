"""DuckDB SQL for the corpus operators that SQL can express."""

OP5 = """
WITH t AS (
  SELECT (conv_id - ((conv_id % 2) + 2) % 2) // 2 AS pair_id, ((conv_id % 2) + 2) % 2 AS side,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT pair_id, count(*) FILTER (side = 0) AS n_chosen, count(*) FILTER (side = 1) AS n_rejected FROM t GROUP BY 1),
d AS (SELECT c.pair_id, min(c.pos) AS pos FROM t c JOIN t r ON c.pair_id = r.pair_id AND c.pos = r.pos
      WHERE c.side = 0 AND r.side = 1 AND (c.role <> r.role OR c.text <> r.text) GROUP BY 1),
p AS (SELECT n.*, coalesce(d.pos - 1, least(n_chosen, n_rejected)) AS n_prompt FROM n LEFT JOIN d USING (pair_id)),
x AS (SELECT t.*, p.n_prompt, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown, length(role) + 5 AS head FROM t JOIN p USING (pair_id)),
y AS (SELECT *, sum(length(shown)) OVER (PARTITION BY pair_id, side ORDER BY pos) AS upto FROM x WHERE pos > n_prompt),
z AS (SELECT pair_id,
        string_agg(shown, '' ORDER BY pos) FILTER (side = 0) AS chosen,
        string_agg(shown, '' ORDER BY pos) FILTER (side = 1) AS rejected,
        string_agg((upto - length(shown) + head) || ':' || upto, ',' ORDER BY pos) FILTER (side = 0 AND role = 'assistant') AS chosen_mask,
        string_agg((upto - length(shown) + head) || ':' || upto, ',' ORDER BY pos) FILTER (side = 1 AND role = 'assistant') AS rejected_mask
      FROM y GROUP BY 1),
q AS (SELECT pair_id, string_agg(shown, '' ORDER BY pos) AS prompt FROM x WHERE side = 0 AND pos <= n_prompt GROUP BY 1)
SELECT p.pair_id, p.n_chosen, p.n_rejected, p.n_prompt, coalesce(q.prompt, '') AS prompt, coalesce(z.chosen, '') AS chosen,
       coalesce(z.chosen_mask, '') AS chosen_mask, coalesce(z.rejected, '') AS rejected, coalesce(z.rejected_mask, '') AS rejected_mask
FROM p LEFT JOIN q USING (pair_id) LEFT JOIN z USING (pair_id)
"""

OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END)) AS shingles FROM d),
c AS (SELECT min(doc_id) AS rep, shingles FROM s WHERE len(shingles) > 0 GROUP BY shingles),
x AS (SELECT rep, len(shingles) AS n, unnest(shingles) AS shingle FROM c),
e AS (SELECT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.rep < b.rep
      GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT rep AS a, rep AS b FROM c UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN c ON s.shingles = c.shingles LEFT JOIN m ON c.rep = m.a
"""

OP11 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, unnest(list_transform(range(1, CAST(len(w) - k + 2 AS BIGINT)), lambda i: w[i:i + k - 1])) AS g FROM p, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k),
f AS (SELECT lang, g, count(*) AS f FROM g GROUP BY lang, g HAVING count(*) >= 30),
c AS (SELECT lang, g, f AS a, unnest(range(1, CAST(len(g) AS BIGINT))) AS k FROM f WHERE len(g) > 1),
s AS (SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS BIGINT) AS score
      FROM c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.k] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
i AS (SELECT lang, a, g, unnest(range(2, CAST(len(g) AS BIGINT))) AS m FROM b WHERE len(g) > 2),
j AS (SELECT lang, a, unnest(list_transform(range(1, CAST(len(g) - m + 2 AS BIGINT)), lambda z: g[z:z + m - 1])) AS g FROM i),
o AS (SELECT lang, g, max(a) AS longer FROM j GROUP BY lang, g),
k AS (SELECT b.lang, array_to_string(b.g, ' ') AS phrase, b.a, b.l, b.r, b.score FROM b LEFT JOIN o ON o.lang = b.lang AND o.g = b.g WHERE o.longer IS NULL OR CAST(100 AS HUGEINT) * o.longer < CAST(80 AS HUGEINT) * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.phrase) AS rank, k.phrase, k.a, k.l, k.r, n.n, k.score
FROM k JOIN n ON n.lang = k.lang QUALIFY rank <= 2000
"""

ORACLE = {"op5_chat_formatting": OP5, "op8_ngram_jaccard": OP8, "op11_phrases": OP11}
