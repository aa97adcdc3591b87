"""DuckDB SQL for the corpus queries that SQL can express, written from the contracts."""

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
normed AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS size FROM sound),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM normed a JOIN normed b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.size > 0 AND b.size > 0 AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98),
reach AS (SELECT u AS s, v AS t FROM links UNION SELECT r.s, l.v FROM reach r JOIN links l ON r.t = l.u),
lowest AS (SELECT s, min(t) AS t FROM reach GROUP BY s),
counted AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, coalesce(l.t, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(l.t, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted c ON c.u = e.vec_id LEFT JOIN lowest l ON l.s = e.vec_id
"""

OP2 = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, coalesce(regexp_extract_all({LOWERED.format('text')}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM split),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) + any_value(b.n) - count(*) AS joined, count(*) AS shared
  FROM each a JOIN each b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY 1, 2),
links AS (SELECT u, v FROM common WHERE 100 * shared >= 80 * joined),
reach AS (SELECT u AS s, v AS t FROM links UNION SELECT r.s, l.v FROM reach r JOIN links l ON r.t = l.u),
lowest AS (SELECT s, min(t) AS t FROM reach GROUP BY s)
SELECT d.doc_id, len(d.s) AS n_shingles, least(d.doc_id, coalesce(l.t, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(l.t, d.doc_id)) = d.doc_id AS kept
FROM sets d LEFT JOIN lowest l ON l.s = d.doc_id
"""

_WORDS4 = "coalesce(regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])".format(LOWERED.format("text"))

OP4 = f"""
WITH items AS (SELECT item_id, {_WORDS4} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS k FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
  FROM sized),
docs AS (SELECT doc_id, {_WORDS4} AS w FROM documents),
cuts AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM sized) WHERE len(w) >= k)),
hits AS (SELECT c.doc_id, c.i, c.k, x.item_id FROM cuts c JOIN windows x ON c.g = x.g AND c.k = x.k),
words AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items,
       sha256(coalesce(f.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words h ON h.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id
"""

OP5 = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (
  SELECT doc_id, k, substr(h, 1024 * k + 1, 1122) AS h
  FROM (SELECT doc_id, h, unnest(range(0, (len(h) + 1023) // 1024)) AS k FROM docs)),
cut AS (SELECT doc_id, k, h, unnest(range(0, least(512, len(h) // 2))) AS q FROM parts),
bytes AS (SELECT doc_id, 512 * k + q AS p, substr(h, 2 * q + 1, 100) AS s FROM cut),
strings AS (SELECT doc_id, p, s FROM bytes WHERE len(s) = 100),
first AS (SELECT s, min(doc_id) AS least FROM strings GROUP BY s),
gone AS (SELECT doc_id, p FROM strings JOIN first USING (s) WHERE least < doc_id),
marked AS (
  SELECT b.doc_id, b.p, substr(b.s, 1, 2) AS c,
         max(CASE WHEN g.p IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY b.doc_id ORDER BY b.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS r
  FROM bytes b LEFT JOIN gone g ON g.doc_id = b.doc_id AND g.p = b.p),
edged AS (SELECT *, lag(r, 1, 0) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM marked),
summed AS (
  SELECT doc_id, sum(r) AS removed, sum(CASE WHEN r = 1 AND before = 0 THEN 1 ELSE 0 END) AS spans,
         string_agg(c, '' ORDER BY p) FILTER (r = 0) AS kept
  FROM edged GROUP BY doc_id)
SELECT d.doc_id, (len(d.h) // 2)::BIGINT AS n_bytes, coalesce(s.removed, 0)::BIGINT AS n_removed,
       coalesce(s.spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(s.kept, ''))) AS kept_sha256
FROM docs d LEFT JOIN summed s ON s.doc_id = d.doc_id
"""

OP11 = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
lines AS (SELECT doc_id, unnest(w) AS line, unnest(range(0, len(w))) AS i FROM split),
keyed AS (
  SELECT *, {LOWERED.format("regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')")} AS k FROM lines),
repeated AS (SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT l.doc_id, l.i, l.line, r.k IS NOT NULL AND l.doc_id <> r.top AS gone FROM keyed l LEFT JOIN repeated r ON r.k = l.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

# unsigned crc32 of an id in decimal, bit by bit
_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295, list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda x, y: xor(x // 2, 3988292384 * (x % 2)))))"""

_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256({} || {} || {} || {{}} || {})".format(*[_FIELD.format(c) for c in ("doc_id", "source", "lang", "text")])

OP12 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('1' || lang, '') AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
         {_LEAF.format(_FIELD.format('n_chars'))} AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN {_LEAF.format(_FIELD.format('(n_chars + 1)'))} END AS altered
  FROM documents),
tree AS (
  SELECT t, 0 AS lvl, pos, leaf AS d, count(*) OVER (PARTITION BY t) AS n FROM leaves
  UNION ALL
  SELECT t, lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2 FROM tree WHERE n > 1 GROUP BY t, lvl, pos // 2, n),
groups AS (SELECT t, d AS subroot, row_number() OVER (ORDER BY encode(t)) - 1 AS pos FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, pos, subroot AS d, count(*) OVER () AS n FROM groups
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, pos // 2, n),
walk AS (
  SELECT doc_id, t, 0 AS lvl, pos, coalesce(altered, leaf) AS f, '' AS proof FROM leaves
  UNION ALL
  SELECT w.doc_id, w.t, w.lvl + 1, w.pos // 2,
         sha256(CASE WHEN w.pos % 2 = 1 THEN coalesce(s.d, '') ELSE '' END || w.f || CASE WHEN w.pos % 2 = 0 THEN coalesce(s.d, '') ELSE '' END),
         w.proof || coalesce(s.d, '')
  FROM walk w JOIN tree own ON own.t = w.t AND own.lvl = w.lvl AND own.pos = w.pos AND own.n > 1
  LEFT JOIN tree s ON s.t = w.t AND s.lvl = w.lvl AND s.pos = xor(w.pos, 1)),
below AS (SELECT w.* FROM walk w JOIN tree x ON x.t = w.t AND x.lvl = w.lvl AND x.pos = w.pos AND x.n = 1),
climb AS (
  SELECT b.doc_id, 0 AS lvl, g.pos, b.f, b.proof FROM below b JOIN groups g ON g.t = b.t
  UNION ALL
  SELECT w.doc_id, w.lvl + 1, w.pos // 2,
         sha256(CASE WHEN w.pos % 2 = 1 THEN coalesce(s.d, '') ELSE '' END || w.f || CASE WHEN w.pos % 2 = 0 THEN coalesce(s.d, '') ELSE '' END),
         w.proof || coalesce(s.d, '')
  FROM climb w JOIN top own ON own.lvl = w.lvl AND own.pos = w.pos AND own.n > 1
  LEFT JOIN top s ON s.lvl = w.lvl AND s.pos = xor(w.pos, 1)),
ended AS (SELECT c.*, x.d AS root FROM climb c JOIN top x ON x.lvl = c.lvl AND x.pos = c.pos AND x.n = 1)
SELECT l.doc_id, l.leaf, g.subroot, e.root, sha256(e.proof) AS proof_sha256, e.f AS folded_root, e.f = e.root AS verified
FROM leaves l JOIN groups g ON g.t = l.t JOIN ended e ON e.doc_id = l.doc_id
"""

OP13 = f"""
WITH cut AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w, {_CRC} AS h FROM documents),
planned AS (SELECT doc_id, w, len(w) AS n, h, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM cut),
words AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] END)
    ELSE w END AS w FROM planned),
each AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM words),
pairs AS (
  SELECT a.doc_id, b.i - a.i AS q, a.i FROM each a JOIN each b
  ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i AND 3 * (b.i - a.i) <= a.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (
    PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS text
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i WHERE g.i IS NULL GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
       sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM words d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

SQL = {"op1_embedding_dups": OP1, "op2_minhash_dups": OP2, "op4_benchmark_leaks": OP4, "op5_substring_dups": OP5,
       "op11_line_dedup": OP11, "op12_merkle_manifest": OP12, "op13_periodic_runs": OP13}
