"""DuckDB SQL for the queries that SQL can express."""

_OP1 = r"""
WITH tok AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bench AS (
  SELECT item_id::VARCHAR AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
pat AS (
  SELECT DISTINCT item, least(10, len(w)) AS m, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM bench WHERE len(w) > 0)),
size AS (SELECT DISTINCT m FROM pat),
occ AS (
  SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS win
  FROM (SELECT r, w, m, unnest(range(1, (len(w) - m + 2)::BIGINT)) AS i FROM tok, size WHERE len(w) >= m)),
hit AS (SELECT occ.r, occ.i, occ.m, pat.item FROM occ JOIN pat ON occ.m = pat.m AND occ.win = pat.win),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT tok.doc_id, len(tok.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM tok LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

_OP3 = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(3, len(w)) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, (len(w) - least(3, len(w)) + 2)::BIGINT)) AS i FROM t WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM common JOIN size s ON s.doc_id = x JOIN size z ON z.doc_id = y
  WHERE 100 * c >= 90 * (s.n + z.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON r.other = b.x)
SELECT d.doc_id, coalesce(any_value(size.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id
GROUP BY d.doc_id
"""

_OP4 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, (len(h) // 2 - 199)::BIGINT)) AS i FROM d WHERE len(h) >= 400)),
again AS (SELECT k FROM p GROUP BY k HAVING count(*) > 1),
r AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh
  FROM p SEMI JOIN again ON p.k = again.k),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 200 AS b
  FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r) GROUP BY doc_id, run),
gaps AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
kept AS (
  SELECT g.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS rest
  FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

_OP6 = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id, vec_id AS other FROM v
  UNION
  SELECT r.vec_id, l.y FROM reach r JOIN links l ON r.other = l.x),
low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT low.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, low.vec_id = component_id AS kept
FROM low LEFT JOIN n ON n.x = low.vec_id
"""

#: The CRC-32 of a text: its UTF-8 bytes from ``hex``, through the table of one byte's steps.
_CRC = r"""
crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS steps
  FROM (SELECT unnest(range(256)) AS b)),
crc AS (
  SELECT t, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1])), 4294967295) AS crc
  FROM (SELECT t, steps, list_transform(range(1, len(h) + 1, 2), lambda i: (strpos('0123456789ABCDEF', substr(h, i, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(h, i + 1, 1)) - 1) AS bytes
        FROM (SELECT t, hex(encode(t)) AS h FROM texts), crc_table))
"""

_OP11 = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
aim AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
doc_words AS (SELECT doc_id, t, count(*) AS n FROM (SELECT doc_id, unnest(w) AS t FROM doc) GROUP BY doc_id, t),
aim_words AS (SELECT t, count(*) AS n FROM (SELECT unnest(w) AS t FROM aim) GROUP BY t),
texts AS (SELECT t FROM doc_words UNION SELECT t FROM aim_words),""" + _CRC + r""",
s AS (SELECT crc % 10000 AS b, sum(n) AS s FROM doc_words JOIN crc USING (t) GROUP BY b),
t AS (SELECT crc % 10000 AS b, sum(n) AS t FROM aim_words JOIN crc USING (t) GROUP BY b),
gain AS (
  SELECT b, floor(1000 * ln(((coalesce(t, 0) + 1) * (big_s + 10000))::DOUBLE / ((coalesce(s, 0) + 1) * (big_t + 10000))::DOUBLE))::BIGINT AS gain
  FROM (SELECT unnest(range(10000)) AS b) LEFT JOIN s USING (b) LEFT JOIN t USING (b),
       (SELECT coalesce(sum(s), 0) AS big_s FROM s), (SELECT coalesce(sum(t), 0) AS big_t FROM t)),
weight AS (SELECT doc_id, sum(n * gain)::BIGINT AS weight FROM doc_words JOIN crc USING (t) JOIN gain ON gain.b = crc.crc % 10000 GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((list_reduce(list_prepend(0, list_transform(string_split(substr(sha256('2024:' || doc_id), 1, 8), ''), lambda c: strpos('0123456789abcdef', c) - 1)), lambda a, x: a * 16 + x) + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM doc LEFT JOIN weight USING (doc_id)),
able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored LEFT JOIN able USING (doc_id)
"""

_OP12 = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY doc_id, run),
texts AS (SELECT DISTINCT doc_id || ':' || run AS t FROM runs),""" + _CRC + r""",
word AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN crc % 97 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word
        FROM runs JOIN crc ON crc.t = doc_id || ':' || run)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
near AS (
  SELECT a.word AS x, b.word AS y, b.n AS y_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN word b ON a.rest = b.word),
best AS (
  SELECT x, n_near, y, y_n
  FROM (SELECT x, y, y_n, count(*) OVER (PARTITION BY x) AS n_near, row_number() OVER (PARTITION BY x ORDER BY y_n DESC, encode(y)) AS k FROM near) WHERE k = 1),
found AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN y_n >= 2 * n THEN y END AS form, CASE WHEN y_n >= 2 * n THEN y_n END AS form_n
  FROM word LEFT JOIN best ON best.x = word.word),
walk AS (
  SELECT word, coalesce(form, word) AS stop FROM found
  UNION
  SELECT walk.word, form FROM walk JOIN found ON found.word = walk.stop WHERE form IS NOT NULL)
SELECT found.word, form, stop AS root, n, n_near, form_n::BIGINT AS form_n
FROM found JOIN walk ON walk.word = found.word JOIN (SELECT word AS last FROM found WHERE form IS NULL) ON last = stop
"""

#: The other queries hash, learn or tokenize in ways that SQL can't express; tests/llm compares them with direct versions.
ORACLE_SQL = {"op1_decontamination": _OP1, "op3_jaccard_join": _OP3, "op4_suffix_dedup": _OP4, "op6_embedding_dedup": _OP6, "op11_importance_resampling": _OP11, "op12_spelling_variants": _OP12}
