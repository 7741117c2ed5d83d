"""SQL forms of those queries that SQL can express, for DuckDB."""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) = 0 THEN []::VARCHAR[]
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.c AS component_id, r.c = d.doc_id AS kept
FROM documents d
LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

EMBEDDING_DUPLICATES = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), sound AS (
  SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM vectors
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(v, v) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, r.c AS component_id, r.c = e.vec_id AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = e.vec_id
"""

SPELLING_VARIANTS = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  GROUP BY ALL
), checked AS (
  -- CRC-32, bit by bit: each byte comes with the first of its eight steps
  SELECT run, n, xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(
      flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)),
      lambda b: [b::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384::BIGINT))) AS h
  FROM runs WHERE length(run) >= 5
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0
      THEN left(run, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word
    FROM checked)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), places AS (
  SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words
), gaps AS (
  SELECT word, n, left(word, i - 1) || '*' || substring(word, i + 1) AS gap FROM places
), shorter AS (
  SELECT DISTINCT word, n, left(word, i - 1) || substring(word, i + 1) AS short FROM places
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.word <> b.word
  UNION ALL
  SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON w.word = s.short
  UNION ALL
  SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON w.word = s.short
), counted AS (
  SELECT word, count(*) AS n_near, min({'less': -m, 'word': other}) AS best FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(c.n_near, 0) AS n_near,
    CASE WHEN -c.best.less >= 2 * w.n THEN c.best.word END AS form,
    CASE WHEN -c.best.less >= 2 * w.n THEN -c.best.less END AS form_n
  FROM words w LEFT JOIN counted c ON c.word = w.word
), way AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT way.word, f.form FROM way JOIN forms f ON f.word = way.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, r.at AS root
FROM forms f JOIN (SELECT way.word, way.at FROM way JOIN forms g ON g.word = way.at WHERE g.form IS NULL) r ON r.word = f.word
"""
