"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRING = f"""
WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS first_doc FROM h GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT h.doc_id, unnest(range(h.i, h.i + 50)) AS j FROM h JOIN f ON h.h = f.h AND h.doc_id > f.first_doc),
u AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM w),
s AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.j) AS kept, count(*) AS n
      FROM u LEFT JOIN c ON u.doc_id = c.doc_id AND u.j = c.j WHERE c.j IS NULL GROUP BY u.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(s.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(s.kept, '')) AS kept_sha256
FROM w LEFT JOIN s ON w.doc_id = s.doc_id
"""

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g FROM (
    SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, s.b FROM reach r JOIN sym s ON r.other = s.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = w.doc_id
"""

HOST_RULES = f"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
t AS (SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS g FROM (
  SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
r AS (SELECT doc_id, g FROM t GROUP BY ALL HAVING count(*) > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
  SELECT t.doc_id, unnest(range(t.i, t.i + 3)) AS j FROM t JOIN r ON t.doc_id = r.doc_id AND t.g = r.g) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id LEFT JOIN l ON w.doc_id = l.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             10 * n_symbols > word_chars AS symbols_failed, n_dup_lines > 0 AS lines_failed FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT) AS f1, sum(symbols_failed::INT) AS f2,
             sum(lines_failed::INT) AS f3 FROM f GROUP BY source),
u AS (SELECT source, n, unnest([f1, f2, f3]) AS fails, unnest([1, 2, 3]) AS rule FROM h),
p AS (SELECT rule, sum(fails) / sum(n) AS mean FROM u GROUP BY rule),
v AS (SELECT u.rule, any_value(mean) AS mean, avg(pow(fails / n - mean, 2)) - avg(mean * (1 - mean) / n) AS spread
      FROM u JOIN p ON u.rule = p.rule GROUP BY u.rule),
k AS (SELECT rule, mean, least(greatest(CASE WHEN spread > 0 THEN mean * (1 - mean) / spread - 1 ELSE 1000.0 END, 1.0), 1000.0)
      AS strength FROM v),
ok AS (SELECT source, bool_and((fails + strength * mean) / (n + strength) <= 0.5) AS host_ok
       FROM u JOIN k ON u.rule = k.rule GROUP BY source)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_ok AS kept
FROM f JOIN ok ON f.source IS NOT DISTINCT FROM ok.source
"""

LINES = f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS p FROM documents),
w AS (SELECT doc_id, p, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS words FROM l),
e AS (SELECT doc_id, p, words, array_to_string(words, ' ') AS own,
             min({{'d': doc_id, 'p': p}}) OVER (PARTITION BY array_to_string(words, ' ')) AS first FROM w WHERE len(words) > 0),
n AS (SELECT first AS line, words, own FROM e WHERE first.d = doc_id AND first.p = p AND len(words) >= 8),
v AS (SELECT line, own AS v, 0 AS i FROM n
      UNION ALL
      SELECT line, array_to_string(list_concat(words[:i - 1], words[i + 1:]), ' ') AS v, i FROM (
        SELECT line, words, unnest(range(1, len(words) + 1)) AS i FROM n)),
near AS (SELECT DISTINCT a.line FROM v a JOIN v b ON a.v = b.v AND b.line < a.line AND (a.i = b.i OR a.i = 0 OR b.i = 0)),
gone AS (SELECT doc_id, p FROM e LEFT JOIN near ON e.first = near.line WHERE near.line IS NOT NULL OR first.d <> doc_id OR first.p <> p),
g AS (SELECT doc_id, count(*) AS n, string_agg(p, ',' ORDER BY p) AS removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines,
       coalesce(g.n, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed_lines
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""

PREFERENCES = """
WITH known AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
l AS (SELECT conv_id, max({'turn': turn, 'text': coalesce(text, '')}) AS last FROM known WHERE role = 'assistant' GROUP BY conv_id),
w AS (SELECT k.*, coalesce(k.turn = l.last.turn AND role = 'assistant', false) AS is_last, coalesce(n.last.text, p.last.text) AS other
      FROM known k LEFT JOIN l ON l.conv_id = k.conv_id LEFT JOIN l n ON n.conv_id = k.conv_id + 1 LEFT JOIN l p ON p.conv_id = k.conv_id - 1),
two AS (SELECT conv_id * 2 AS conv_id, turn, role, text FROM known
        UNION ALL SELECT conv_id * 2 + 1, turn, role, CASE WHEN is_last THEN other ELSE text END FROM w WHERE NOT is_last OR other IS NOT NULL),
t AS (SELECT conv_id, turn, min({'role': coalesce(role, ''), 'text': coalesce(text, '')}) AS c FROM two GROUP BY ALL),
a AS (SELECT coalesce(x.p, y.p) AS pair_id, coalesce(x.turn, y.turn) AS turn, x.c AS chosen, y.c AS rejected
      FROM (SELECT conv_id // 2 AS p, turn, c FROM t WHERE conv_id % 2 = 0) x
      FULL JOIN (SELECT conv_id // 2 AS p, turn, c FROM t WHERE conv_id % 2 = 1) y ON x.p = y.p AND x.turn = y.turn),
s AS (SELECT pair_id, min(turn) FILTER (WHERE chosen IS DISTINCT FROM rejected) AS split FROM a GROUP BY pair_id),
b AS (SELECT a.*, split IS NULL OR turn < split AS shared FROM a JOIN s ON a.pair_id = s.pair_id),
p AS (SELECT pair_id, turn, 'prompt' AS part, chosen AS c FROM b WHERE shared
      UNION ALL SELECT pair_id, turn, 'chosen', chosen FROM b WHERE NOT shared AND chosen IS NOT NULL
      UNION ALL SELECT pair_id, turn, 'rejected', rejected FROM b WHERE NOT shared AND rejected IS NOT NULL),
r AS (SELECT pair_id, part, turn, c.role AS role, '<|' || replace(replace(c.role, '<|', '< |'), '|>', '| >') || '|>' || chr(10) AS head,
             replace(c.text, '<|', '< |') || chr(10) AS body FROM p),
o AS (SELECT *, sum(length(head || body)) OVER (PARTITION BY pair_id, part ORDER BY turn) AS e FROM r)
SELECT pair_id, part, turn, role, sha256(head || body) AS segment_sha256, (e - length(head || body))::BIGINT AS "start",
       e::BIGINT AS "end",
       (CASE WHEN part <> 'prompt' AND role = 'assistant' THEN e - length(body) ELSE e - 1 END)::BIGINT AS loss_start,
       (e - 1)::BIGINT AS loss_end
FROM o
"""

SPELLING = """
WITH RECURSIVE u AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
c AS (SELECT doc_id, w, count(*) AS n FROM u WHERE length(w) >= 5 GROUP BY ALL),
-- The table of the reflected polynomial 0xEDB88320, eight shifts per byte.
t AS (SELECT list(list_reduce(list_concat([i], range(0, 8)), lambda r, j:
        CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) ORDER BY i) AS t
      FROM range(0, 256) AS r(i)),
x AS (SELECT c.*, hex(encode(doc_id || ':' || w)) AS hx FROM c WHERE doc_id IS NOT NULL),
h AS (SELECT x.*, xor(list_reduce(list_concat([4294967295::BIGINT], [('0x' || hx[2 * i - 1:2 * i])::BIGINT for i in range(1, length(hx) // 2 + 1)]),
        lambda r, b: xor(t[(xor(r, b) & 255) + 1], r >> 8)), 4294967295::BIGINT) AS h FROM x, t),
d AS (SELECT CASE WHEN h % 97 = 0 THEN w[:(h % length(w))::BIGINT] || w[(h % length(w))::BIGINT + 2:] ELSE w END AS word, n FROM h
      UNION ALL SELECT w, n FROM c WHERE doc_id IS NULL),
v AS (SELECT word, sum(n)::BIGINT AS n FROM d WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
e AS (SELECT word, word AS key, 0 AS i FROM v
      UNION ALL SELECT word, word[:i - 1] || word[i + 1:], i FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT DISTINCT a.word, b.word AS near FROM e a JOIN e b ON a.key = b.key AND a.word <> b.word
      WHERE a.i = b.i OR a.i = 0 OR b.i = 0),
f AS (SELECT p.word, count(*) AS n_near, min({'less': -v.n, 'near': near}) AS best FROM p JOIN v ON p.near = v.word GROUP BY p.word),
g AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.less >= 2 * v.n THEN best.near END AS form,
             CASE WHEN -best.less >= 2 * v.n THEN -best.less END AS form_n FROM v LEFT JOIN f ON v.word = f.word),
r(word, root) AS (SELECT word, form FROM g WHERE form IS NOT NULL
                  UNION SELECT r.word, g.form FROM r JOIN g ON r.root = g.word WHERE g.form IS NOT NULL),
z AS (SELECT r.word, r.root FROM r JOIN g ON r.root = g.word WHERE g.form IS NULL)
SELECT g.word, g.n, g.n_near, g.form, g.form_n, coalesce(z.root, g.word) AS root FROM g LEFT JOIN z ON g.word = z.word
"""
