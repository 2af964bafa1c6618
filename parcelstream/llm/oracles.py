"""DuckDB SQL of the queries that SQL can express in full."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Integer vectors, all inner products, the best 20 of each query.
OP6 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM p)
SELECT query_id, CAST(k AS INTEGER) AS "rank", vec_id, score FROM r WHERE k <= 20
"""

# crc32 byte by byte over a table made by its own rule; near words meet at a
# word with one letter left open, or without it.
OP11 = f"""
WITH RECURSIVE bits AS (
  SELECT range AS byte, range AS c, 0 AS step FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1
  FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE step = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
                                           '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
  FROM documents WHERE text IS NOT NULL),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda ch: CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)]
               ELSE [CAST(192 + (unicode(ch) >> 6) AS BIGINT), CAST(128 + (unicode(ch) & 63) AS BIGINT)] END)) AS b
  FROM counted),
hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], b),
    lambda h, x: xor(h >> 8, t[(xor(h, x) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM bytes, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT))
                || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word,
         CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1),
v AS (SELECT word, n FROM words WHERE length(word) >= 5 AND n >= 3),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v),
open_at AS (SELECT word, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS pat,
                   substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM places),
near AS (
  SELECT a.word, b.word AS near FROM open_at a JOIN open_at b USING (pat) WHERE a.word <> b.word
  UNION SELECT a.word, v.word FROM open_at a JOIN v ON a.less = v.word
  UNION SELECT v.word, a.word FROM open_at a JOIN v ON a.less = v.word),
top AS (
  SELECT near.word, count(*) AS n_near, min((-v.n, v.word)) AS best
  FROM near JOIN v ON near.near = v.word GROUP BY near.word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -best[1] >= 2 * v.n THEN best[2] END AS form,
         CASE WHEN -best[1] >= 2 * v.n THEN -best[1] END AS form_n
  FROM v LEFT JOIN top USING (word)),
led AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL
  UNION ALL SELECT f.word, led.root FROM forms f JOIN led ON f.form = led.word)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN led USING (word)
"""

OP12 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          '{UPPER}', '{LOWER}') AS key FROM l),
shared AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, coalesce(doc_id <> top, false) AS dropped FROM k LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERMS = f"unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}'))"
OP13 = f"""
WITH t AS (SELECT doc_id, {TERMS} AS term FROM documents WHERE text IS NOT NULL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
stat AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM len),
m AS (SELECT doc_id, 25 + (75 * n * docs) // total AS m FROM len, stat),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, stat GROUP BY term, docs),
impact AS (
  SELECT tf.doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS s
  FROM tf JOIN m USING (doc_id) JOIN w USING (term)),
q AS (SELECT item_id, {TERMS} AS term FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * s) AS BIGINT) AS score
  FROM asked JOIN impact USING (term) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS k
      FROM scored WHERE score > 0)
SELECT item_id, CAST(k AS INTEGER) AS "rank", doc_id, score FROM r WHERE k <= 10
"""
