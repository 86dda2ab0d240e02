"""SQL of the queries that need more than a few lines of it."""

#: The CRC-32 of the text ``{}`` as a lambda over its UTF-8 bytes; ``crc.t`` holds the change by each byte.
CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
)"""
CRC = """xor(list_reduce(list_transform(range(strlen({0})), lambda i: CAST('0x' || substr(hex(encode({0})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"""

SPELLING_VARIANTS = f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), pairs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key, run, count(*) AS times FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, times, {CRC.format("key")} AS h FROM pairs, crc
), words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), cut AS MATERIALIZED (
  SELECT word, n, length(word) AS size, i, left(word, i - 1) AS head, substr(word, i + 1) AS tail
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), links AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (size, i, head, tail) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.head || a.tail = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.head || a.tail = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM links GROUP BY word
), forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), steps AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT s.word, f.form FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NOT NULL
), ends AS (
  SELECT s.word, s.root FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

PREFIX_TRIE = f"""
WITH {CRC_TABLE}, turns AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, left(sha256(strlen(role) || ':' || role || text), 45)) AS seq FROM turns GROUP BY c
), heads AS (
  SELECT c, CAST(c AS VARCHAR) AS key, seq FROM own
), hashed AS (
  SELECT c, seq, {CRC.format("key")} % 9 AS h FROM heads, crc
), built AS MATERIALIZED (
  SELECT a.c, list_concat(coalesce(list_slice(b.seq, 1, a.h), []), list_slice(a.seq, a.h + 1, len(a.seq))) AS seq
  FROM hashed a LEFT JOIN hashed b ON b.c = a.c - a.c % 5
), nodes AS MATERIALIZED (
  SELECT list_slice(seq, 1, d) AS p, d, count(*) AS n, min(c) AS conv_id, list(c ORDER BY c) FILTER (len(seq) = d) AS ends
  FROM (SELECT c, seq, unnest(range(len(seq) + 1)) AS d FROM built) GROUP BY ALL
), kids AS (
  SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), facts AS MATERIALIZED (
  SELECT a.p, d, a.n, conv_id, ends, coalesce(k.n, 0) AS n_children, (a.n - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(p[d].text) END AS saved
  FROM nodes a LEFT JOIN kids k USING (p)
), below AS (
  SELECT list_slice(p, 1, k) AS p, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
  FROM (SELECT p, n_children, saved, unnest(range(d + 1)) AS k FROM facts) GROUP BY ALL
)
SELECT a.conv_id, a.d AS depth, u.conv_id AS parent_conv_id, a.n AS n_convs, a.n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(array_to_string(a.ends, ','), '')) AS ends_sha256
FROM facts a JOIN below b USING (p) LEFT JOIN facts u ON a.d > 0 AND u.d = a.d - 1 AND u.p = list_slice(a.p, 1, a.d - 1)
"""
