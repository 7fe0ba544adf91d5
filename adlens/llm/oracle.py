"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

import math

from adlens.llm.quality_rules import Risk

OP5 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM k
"""

OP9 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
s AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size,
         md5(concat_ws(':', '0', coalesce(CAST(doc_id AS VARCHAR), ''), md5(t))) AS key FROM d),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
w AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1 AS weight, source_size * 3 AS cap FROM per),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER b, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (
  SELECT level FROM l WHERE weight * level < cap ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN (SELECT level FROM water) IS NULL OR weight * (SELECT level FROM water) >= cap THEN CAST(cap AS DOUBLE)
              ELSE weight * (SELECT level FROM water) END AS target FROM l),
o AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY key, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size
                 + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) END AS BIGINT) AS taken
FROM o
"""

OP11 = r"""
WITH RECURSIVE crc AS (  -- the byte table of crc32
  SELECT list(list_reduce(list_concat([b], [0, 0, 0, 0, 0, 0, 0, 0]),
         lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS tbl FROM range(256) t(b)),
raw AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM raw WHERE length(run) >= 5 GROUP BY ALL),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
         lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END)) AS b FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(tbl[CAST(xor(c, x) & 255 AS INT) + 1], c >> 8)), 4294967295) AS h
  FROM bytes, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n
  FROM hashed),
vocab AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS (
  SELECT word, n, i, left(word, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocab)),
one AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT g.word, g.n, v.word, v.n FROM gaps g JOIN vocab v ON g.rest = v.word
  UNION SELECT v.word, v.n, g.word, g.n FROM gaps g JOIN vocab v ON g.rest = v.word),
best AS (
  SELECT word, count(*) AS n_near, min(ROW(-near_n, near)) AS top FROM one GROUP BY word),
judged AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top[1] >= 2 * v.n THEN top[2] END AS form,
         CASE WHEN -top[1] >= 2 * v.n THEN -top[1] END AS form_n FROM vocab v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS cur, 0 AS step FROM judged
  UNION ALL SELECT w.word, j.form, step + 1 FROM walk w JOIN judged j ON w.cur = j.word WHERE j.form IS NOT NULL),
root AS (
  SELECT word, arg_max(cur, step) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN root USING (word)
"""

OP13 = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, source, lang, n_chars, text, replace(text, chr(10), '') AS bare,
         CAST(doc_id AS VARCHAR) AS key FROM documents),
c AS (  -- crc32, bit by bit
  SELECT *, list_reduce(list_concat([4294967295], list_transform(range(0, 8 * length(key)),
         lambda j: (ascii(key[CAST(j // 8 + 1 AS INT)]) >> (j % 8)) & 1)),
         lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) & 1 = 1 AS even FROM t),
i AS (
  SELECT doc_id, source, even, concat_ws('',
           coalesce(strlen(key) || ':' || key, '-'),
           coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
           coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-')) AS head,
         coalesce(strlen(text) || ':' || text, '-') AS whole, coalesce(strlen(bare) || ':' || bare, '-') AS cut FROM c),
l AS (
  SELECT doc_id, source, sha256(head || whole) AS leaf,
         CASE WHEN even THEN sha256(head || cut) ELSE sha256(head || whole) END AS claim FROM i),
p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS i FROM l),
up AS (
  SELECT source, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM p
  UNION ALL
  SELECT source, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 2) // 3)
  FROM up WHERE n > 1 GROUP BY source, level, i // 3),
sub AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, i, h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 2) // 3)
  FROM top WHERE n > 1 GROUP BY level, i // 3),
run AS (  -- siblings before and after each node
  SELECT source, level, i, coalesce(string_agg(h, '' ) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM up WHERE n > 1 WINDOW r AS (PARTITION BY source, level, i // 3 ORDER BY i)),
top_run AS (
  SELECT level, i, coalesce(string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM top WHERE n > 1 WINDOW r AS (PARTITION BY level, i // 3 ORDER BY i)),
fold AS (
  SELECT row_number() OVER () AS row, source, doc_id, leaf, 0 AS level, i, claim AS node, '' AS proof FROM p
  UNION ALL
  SELECT f.row, f.source, f.doc_id, f.leaf, f.level + 1, f.i // 3, sha256(r.before || f.node || r.after), f.proof || r.before || r.after
  FROM fold f JOIN run r ON f.source IS NOT DISTINCT FROM r.source AND f.level = r.level AND f.i = r.i),
done AS (
  SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1),
topfold AS (
  SELECT d.row, d.doc_id, d.leaf, s.h AS subroot, 0 AS level, s.i, d.node, d.proof
  FROM done d JOIN sub s ON d.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT f.row, f.doc_id, f.leaf, f.subroot, f.level + 1, f.i // 3, sha256(r.before || f.node || r.after), f.proof || r.before || r.after
  FROM topfold f JOIN top_run r ON f.level = r.level AND f.i = r.i),
ends AS (
  SELECT * FROM topfold QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(proof) AS proof_sha256, node AS folded_root,
       node = (SELECT h FROM top WHERE n = 1) AS verified
FROM ends
"""


def _op3(risk: Risk = Risk()) -> str:
    rules, cuts = risk.rules, risk.cutoffs
    alpha = risk.alpha / len(rules)
    first, odds = math.log1p(-alpha), math.log(alpha) - math.log1p(-alpha)
    shares = " UNION ALL ".join(f"SELECT stratum, good, '{r}' AS rule, {r} AS share FROM known" for r in rules)
    grid = ", ".join(f"({i}, {c!r})" for i, c in enumerate(cuts))
    fails = " OR ".join(f"m.{r} > (SELECT cutoff FROM chosen c WHERE c.rule = '{r}' AND c.stratum = m.stratum)" for r in rules)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce('lang ' || lang, 'no lang') AS stratum, coalesce(text, '') AS t FROM documents),
a AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
b AS (
  SELECT *, len(w) AS n, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS g FROM a),
u AS (
  SELECT doc_id, t, unnest(g) AS window5, unnest(range(1, len(g) + 1)) AS i FROM b),
r AS (
  SELECT doc_id, t, i FROM u QUALIFY count(*) OVER (PARTITION BY doc_id, t, window5) > 1),
s AS (
  SELECT doc_id, t, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id, t ORDER BY i) - i, 5)) AS c FROM r),
rep AS (
  SELECT doc_id, t, sum(c) AS n_repeat_words FROM s GROUP BY doc_id, t),
c AS (
  SELECT b.doc_id, b.stratum, CAST(b.n AS BIGINT) AS n_words, CAST(length(regexp_replace(b.t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(b.t) - length(regexp_replace(b.t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(b.lines) - len(list_distinct(b.lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(b.lines) AS n_lines,
         length(b.t) - length(regexp_replace(b.t, '\p{{Lu}}+', '', 'g')) AS n_upper
  FROM b LEFT JOIN rep ON b.doc_id = rep.doc_id AND b.t = rep.t),
m AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CASE WHEN word_chars > 0 THEN CAST(n_symbols AS DOUBLE) / word_chars ELSE 0 END AS symbol_share,
         CASE WHEN word_chars > 0 THEN CAST(n_upper AS DOUBLE) / word_chars ELSE 0 END AS upper_share,
         CASE WHEN n_lines > 0 THEN CAST(n_dup_lines AS DOUBLE) / n_lines ELSE 0 END AS dup_line_share,
         CASE WHEN n_words > 0 THEN CAST(n_repeat_words AS DOUBLE) / n_words ELSE 0 END AS repeat_share FROM c),
known AS (
  SELECT m.*, l.quality AS good FROM m JOIN labels l ON m.doc_id = l.doc_id WHERE NOT base_failed AND l.quality IS NOT NULL),
shares AS ({shares}),
cuts(step, cutoff) AS (VALUES {grid}),
cells AS (
  SELECT stratum, rule, step, cutoff, sum(CASE WHEN good = 1 THEN 1 ELSE 0 END) AS n,
         CAST(sum(CASE WHEN good = 1 AND share > cutoff THEN 1 ELSE 0 END) AS BIGINT) AS good,
         CAST(sum(CASE WHEN good = 0 AND share > cutoff THEN 1 ELSE 0 END) AS BIGINT) AS bad
  FROM shares, cuts GROUP BY ALL),
tails AS (
  SELECT *, CASE WHEN good >= {alpha!r} * n THEN 1.0 ELSE list_sum(list_transform(range(0, good + 1),
         lambda k: exp(n * {first!r} + lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * {odds!r}))) END AS p FROM cells),
walk AS (
  SELECT *, max(p) OVER (PARTITION BY stratum, rule ORDER BY step) AS worst FROM tails),
chosen AS (
  SELECT stratum, rule, cutoff FROM walk
  WHERE worst <= {risk.delta!r} / ((SELECT count(DISTINCT stratum) FROM m) * {len(rules)}) AND bad > good
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY bad - good DESC, step) = 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce({fails.replace(" OR ", ", false) AND NOT coalesce(")}, false) AS kept
FROM m
"""


OP3 = _op3()
