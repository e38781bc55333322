"""Check SQL for the operators that SQL can express, over the tables of a directory."""

from __future__ import annotations

_WORDS = r"coalesce(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'), [])"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"coalesce(regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

NEAR_DUPLICATES = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
  FROM w, unnest(range(1, greatest(len(words) - 1, least(len(words) + 1, 2)))) t(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
e AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b USING (shingle)
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id WHERE a.doc_id <> b.doc_id
  GROUP BY 1, 2, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)"""

EARLIER_WORDS = f"""WITH w AS (SELECT doc_id, {_WORDS.format('text')} AS words FROM documents),
v AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS win
  FROM w, unnest(range(1, greatest(len(words) - 18, 1))) t(i)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS r FROM v),
g AS (SELECT DISTINCT doc_id, i + k AS p FROM f, unnest(range(0, 20)) t(k) WHERE r > 1),
p AS (SELECT doc_id, i AS p, words[i] AS word FROM w, unnest(range(1, len(words) + 1)) t(i)),
k AS (SELECT p.doc_id, count(g.p) AS n_removed,
  string_agg(word, ' ' ORDER BY p.p) FILTER (g.p IS NULL) AS kept
  FROM p LEFT JOIN g ON g.doc_id = p.doc_id AND g.p = p.p GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)"""

LEAKS = f"""WITH w AS (SELECT doc_id, {_ALNUM.format(_LOWER)} AS words FROM documents),
b AS (SELECT item_id, {_ALNUM.format(_LOWER)} AS words FROM benchmark),
q AS (SELECT DISTINCT item_id, least(10, len(words)) AS size, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(len(words) - 8, least(len(words) + 1, 2)))) t(i)),
z AS (SELECT DISTINCT size FROM q),
v AS (SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM w, z, unnest(range(1, greatest(len(words) - size + 2, 1))) t(i)),
m AS (SELECT DISTINCT doc_id, i, size, item_id FROM v JOIN q USING (size, win)),
h AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM m, unnest(range(0, size)) t(k) GROUP BY 1),
n AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM m GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)"""

COMMON_LINES = f"""WITH l AS (SELECT doc_id, line, pos, {_LOWER.replace('text', "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k
  FROM (SELECT doc_id, unnest(s) AS line, unnest(range(1, len(s) + 1)) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
r AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT l.*, r.k IS NOT NULL AND l.doc_id <> keeper AS gone FROM l LEFT JOIN r USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id"""

PREFIX_TREE = r"""WITH RECURSIVE step AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
  lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS tab),
o AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
  ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
h AS (SELECT c, s, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x))),
  lambda x, b: xor(x >> 8, tab[(xor(x, b) & 255) + 1])), 4294967295) % 4 AS h FROM o, step),
f AS (SELECT h.c, list_concat(coalesce(p.s, [])[1:h.h], h.s[h.h + 1:]) AS s FROM h LEFT JOIN o p ON p.c = h.c - h.c % 20),
n AS (SELECT s[1:d] AS p, d, min(c) AS conv_id, count(*) AS n,
  coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '') AS ends
  FROM f, unnest(range(0, len(s) + 1)) t(d) GROUP BY 1, 2),
k AS (SELECT p[1:d - 1] AS p, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(kids, 0) AS kids, CASE WHEN d = 0 THEN 0 ELSE
  (n - 1) * len(coalesce(regexp_extract_all(p[d].t, '[^\x20\x09-\x0D]+'), [])) END AS saved FROM n LEFT JOIN k USING (p)),
u AS (SELECT p[1:i] AS p, sum(CAST(kids = 0 AS BIGINT)) AS leaves, sum(saved) AS saved
  FROM m, unnest(range(0, d + 1)) t(i) GROUP BY 1)
SELECT m.conv_id, m.d AS depth, q.conv_id AS parent_conv_id, m.n AS n_convs, m.kids AS n_children,
  CAST(u.leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN u USING (p) LEFT JOIN n q ON m.d > 0 AND q.p = m.p[1:m.d - 1]"""

COLLOCATIONS = rf"""WITH w AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array({_LOWER.replace('text', "coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
g AS (SELECT lang, words[i:i + k - 1] AS p, count(*) AS f
  FROM w, unnest([1, 2, 3]) z(k), unnest(range(1, greatest(len(words) - k + 2, 1))) t(i) GROUP BY 1, 2),
n AS (SELECT lang, sum(len(words)) AS n FROM w GROUP BY 1),
c AS (SELECT lang, p, f AS a FROM g WHERE len(p) > 1 AND f >= 10),
s AS (SELECT c.lang, c.p, c.a, k, x.f AS l, y.f AS r,
  CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM c, unnest(range(1, len(c.p))) t(k) JOIN g x ON x.lang = c.lang AND x.p = c.p[1:k]
  JOIN g y ON y.lang = c.lang AND y.p = c.p[k + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
x AS (SELECT lang, q, max(a) AS most FROM (SELECT lang, p[1:2] AS q, a FROM c WHERE len(p) = 3
  UNION ALL SELECT lang, p[2:3], a FROM c WHERE len(p) = 3) GROUP BY 1, 2),
o AS (SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM b LEFT JOIN x ON x.lang = b.lang AND x.q = b.p
  WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM o JOIN n USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000"""
