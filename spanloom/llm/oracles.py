"""DuckDB SQL for operators that plain SQL can express over whole (small) tables."""

from __future__ import annotations

from .repeats import MODULUS, SPREAD, TRIGGER

#: Two-word shingles, exact similarities, reachability.
NEAR_DUPLICATES = r"""WITH RECURSIVE parts AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') AS ws FROM documents)),
w AS (SELECT doc_id, word, lead(word) OVER (PARTITION BY doc_id ORDER BY i) AS next, count(*) OVER (PARTITION BY doc_id) AS words FROM parts WHERE word <> ''),
s AS (SELECT DISTINCT doc_id, CASE WHEN words = 1 THEN word ELSE word || ' ' || next END AS shingle FROM w WHERE words = 1 OR next IS NOT NULL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM c JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach(x, m) AS (SELECT DISTINCT x, x FROM both_ways UNION SELECT b.y, r.m FROM reach r JOIN both_ways b ON r.x = b.x),
root AS (SELECT x AS doc_id, min(m) AS m FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(m, d.doc_id) AS component_id, coalesce(m, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN root USING (doc_id)"""

_PLACES = ", ".join(str(1.0 * pow(256, TRIGGER - 1 - i, MODULUS)) for i in range(TRIGGER))

#: Every window of 400 bytes by position, in hex so that substr counts bytes; then the phrases of the
#: distinct texts, and the longest run of those that occur twice.
REPEATS = rf"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
seg AS (SELECT doc_id, k, substr(h, 800 * k + 1, 1600) AS piece FROM (SELECT doc_id, h, unnest(range(0, len(h) // 800 + 1)) AS k FROM d WHERE len(h) >= 800)),
win AS (SELECT doc_id, 400 * k + j AS i, md5(substr(piece, 2 * j + 1, 800)) AS v
  FROM (SELECT doc_id, k, piece, unnest(range(0, least(400, len(piece) // 2 - 399))) AS j FROM seg WHERE len(piece) >= 800)),
hit AS (SELECT doc_id, i FROM win JOIN (SELECT v FROM win GROUP BY v HAVING count(*) > 1) USING (v)),
isle AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS g
  FROM (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new FROM hit)),
span AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM isle GROUP BY doc_id, g),
gap AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span),
cut AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM gap JOIN d USING (doc_id) GROUP BY doc_id),
u AS (SELECT row_number() OVER () AS t, h, count(*) AS copies FROM d WHERE len(h) > {2 * TRIGGER} GROUP BY h),
part AS (SELECT t, k, substr(h, 800 * k + 1, 800 + {2 * TRIGGER - 2}) AS piece FROM (SELECT t, h, unnest(range(0, len(h) // 800 + 1)) AS k FROM u)),
bytes AS (SELECT t, k, list_transform(range(0, len(piece) // 2), lambda x: CAST(1 + CAST('0x' || substr(piece, 2 * x + 1, 2) AS BIGINT) * {SPREAD} % {MODULUS - 1} AS DOUBLE)) AS b FROM part WHERE len(piece) >= {2 * TRIGGER}),
ends AS (SELECT t, 400 * k + j + {TRIGGER} AS i FROM (SELECT t, k, b, unnest(range(0, least(400, len(b) - {TRIGGER - 1}))) AS j FROM bytes)
  WHERE CAST(list_inner_product(b[j + 1 : j + {TRIGGER}], [{_PLACES}]) AS BIGINT) % {MODULUS} = 0),
phrase AS (SELECT t, i, a, substr(h, 2 * (a - {TRIGGER}) + 1, 2 * (i - a + {TRIGGER})) AS v
  FROM (SELECT t, i, lag(i) OVER (PARTITION BY t ORDER BY i) AS a FROM ends) JOIN u USING (t) WHERE a IS NOT NULL),
known AS (SELECT t, i, a, count(*) OVER (PARTITION BY v) > 1 AS twice FROM phrase),
shared AS (SELECT t, max(i) - min(a) + {TRIGGER} AS n
  FROM (SELECT *, sum(CASE WHEN twice THEN 0 ELSE 1 END) OVER (PARTITION BY t ORDER BY i ROWS UNBOUNDED PRECEDING) AS g FROM known) WHERE twice GROUP BY t, g),
longest AS (SELECT h, copies, max(n) AS n FROM u LEFT JOIN shared USING (t) GROUP BY h, copies)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN d.h ELSE kept || substr(d.h, 2 * last + 1) END)) AS kept_sha256,
  CAST(CASE WHEN copies > 1 THEN CASE WHEN len(d.h) >= 400 THEN len(d.h) // 2 ELSE 0 END WHEN n >= 200 THEN n ELSE 0 END AS BIGINT) AS longest_shared
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN longest ON d.h = longest.h"""

#: Every alignment of a document and a benchmark item (a diagonal of equal tokens), every window on it.
#: The best window starts at a match, or as far to the right as both texts allow.
LEAKS = r"""WITH t AS (SELECT doc_id, ws, len(ws) AS n FROM (SELECT doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS ws FROM documents)),
b AS (SELECT item_id, ws, len(ws) AS n, least(20, len(ws)) AS w FROM (SELECT item_id,
  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS ws FROM benchmark WHERE item_id IS NOT NULL)),
dt AS (SELECT doc_id, n, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS p FROM t),
bt AS (SELECT item_id, n, w, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS q FROM b),
m AS (SELECT doc_id, item_id, q - p AS d, q, w, greatest(0, q - p) AS low, least(bt.n, dt.n + q - p) - w AS high FROM dt JOIN bt USING (word)),
long AS (SELECT doc_id, item_id, d FROM m GROUP BY ALL HAVING count(*) >= ceil(0.8 * min(w) - 1e-9) AND min(high) >= min(low)),
c AS (SELECT m.*, count(*) OVER (PARTITION BY doc_id, item_id, d ORDER BY q RANGE BETWEEN CURRENT ROW AND w - 1 FOLLOWING) AS from_here,
    count(*) FILTER (WHERE q >= high) OVER (PARTITION BY doc_id, item_id, d) AS at_end FROM m JOIN long USING (doc_id, item_id, d)),
best AS (SELECT doc_id, item_id, max(CASE WHEN q <= high THEN greatest(from_here, at_end) ELSE at_end END) AS best, min(w) AS w FROM c GROUP BY ALL),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items, max(best) AS best
  FROM best WHERE best >= ceil(0.8 * w - 1e-9) GROUP BY doc_id)
SELECT doc_id, n_items IS NOT NULL AS leaked, coalesce(n_items, 0) AS n_items, coalesce(items, '') AS items, CAST(coalesce(best, 0) AS BIGINT) AS best
FROM documents LEFT JOIN found USING (doc_id)"""

#: Keys of lines, the documents that hold each, the lines that stay.
LINES = r"""WITH l AS (SELECT doc_id, line, i, translate(trim(line, E' \t\n\x0B\x0C\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), E'\n') AS ls FROM documents))),
k AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT l.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM l LEFT JOIN k USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, E'\n' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""

#: Every pair of sources and every kept term of their language.
DIVERGENCE = r"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(doc_id, -1) AS doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT lang, source, doc_id, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
z AS (SELECT g.lang, g.source, coalesce(sum(n), 0) + coalesce(max(v), 0) AS size FROM g LEFT JOIN c USING (lang, source) LEFT JOIN v ON g.lang = v.lang GROUP BY ALL),
p AS (SELECT z.lang, z.source, term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // size AS p,
    1 + (1000000000::HUGEINT * (kept.n + 1)) // (v + total) AS q FROM z JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM v)
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200"""

#: Turn by turn, the cheapest and then least edits that lead to each state.
TURNS = r"""WITH RECURSIVE bit(n, k, v) AS (SELECT range, 0, range FROM range(256) UNION ALL SELECT n, k + 1, xor(v >> 1, (v & 1) * 3988292384) FROM bit WHERE k < 8),
crc AS (SELECT list(v ORDER BY n) AS t FROM bit WHERE k = 8),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS b FROM conversations),
drawn AS (SELECT *, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS draw FROM src, crc),
dam AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role, CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, range(CASE draw WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
pos AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || ':' || text)) AS i FROM dam),
fault AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault, lead(role) OVER (PARTITION BY conv_id ORDER BY i) AS next FROM pos),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE next IS NOT NULL AND left(role, 1) || left(next, 1) NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM fault GROUP BY conv_id),
ins(st, sto, ia, ib) AS (VALUES (0, 0, '', []), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 1, '', []), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
  (2, 2, '', []), (2, 3, 'I', ['assistant:']), (3, 3, '', []), (3, 2, 'I', ['user:'])),
ways(sto, op, was, nst, role_to) AS (VALUES (0, 'K', 's', 1, ''), (0, 'K', 'u', 2, ''), (1, 'K', 'u', 2, ''), (2, 'K', 'a', 3, ''), (3, 'K', 'u', 2, ''),
  (0, 'R', '', 2, 'user'), (1, 'R', '', 2, 'user'), (2, 'R', '', 3, 'assistant'), (3, 'R', '', 2, 'user'), (0, 'D', '', 0, ''), (1, 'D', '', 1, ''), (2, 'D', '', 2, ''), (3, 'D', '', 3, '')),
dp(conv_id, i, st, best) AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {'c': CAST(0 AS BIGINT), 'a': '', 'b': CAST([] AS VARCHAR[])} FROM stats
  UNION ALL SELECT w.conv_id, w.i + 1, nst, min({'c': best.c + 5 * length(ia) + CASE op WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN op <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END, 'a': best.a || ia || op,
      'b': list_concat(best.b, CAST(ib AS VARCHAR[]), CASE op WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [role_to || ':' || text] END)})
    FROM dp w JOIN ins USING (st) JOIN fault f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1 JOIN ways USING (sto)
    WHERE (op = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (op <> 'K' OR left(role, 1) = was) GROUP BY w.conv_id, w.i, nst),
done AS (SELECT dp.conv_id, min({'c': best.c + 5 * length(ia), 'a': best.a || ia, 'b': list_concat(best.b, CAST(ib AS VARCHAR[]))}) AS best
  FROM dp JOIN stats ON dp.conv_id IS NOT DISTINCT FROM stats.conv_id AND i = n JOIN ins USING (st) WHERE sto IN (0, 3) GROUP BY dp.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.b, E'\n'), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN stats ON o.conv_id IS NOT DISTINCT FROM stats.conv_id LEFT JOIN done ON o.conv_id IS NOT DISTINCT FROM done.conv_id"""
