"""DuckDB SQL of the queries that SQL can express.

op3 and op11 (trained models), op6, op7 and op9 (tokenizers) and op10 (offsets
of pattern matches) are tested against brute force instead.
"""

TOPK = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

IMATCH = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next_text,
         row_number() OVER w AS pos, count(*) OVER () AS n
  FROM documents WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, text ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), e AS (
  SELECT *, length(text) - length(text) // 3 AS kept,
         substr(text, 1, length(text) - length(text) // 3) || substr(next_text, 1, length(text) // 3) AS edited
  FROM d
), own AS (
  SELECT pos, 0 AS which, unnest(list_distinct(string_split_regex(lower(text), '[\x20\x09-\x0D]+'))) AS term FROM e
), words AS (
  SELECT * FROM own UNION ALL
  SELECT pos, 1, unnest(list_distinct(string_split_regex(lower(edited), '[\x20\x09-\x0D]+'))) FROM e
), copies AS (
  SELECT text, count(*) AS copies, min(doc_id) AS first FROM d GROUP BY text
), once AS (
  SELECT d.pos FROM d JOIN copies c USING (text)
  WHERE copies <= greatest(1, n * 1e-4::DOUBLE) OR d.doc_id IS NOT DISTINCT FROM first
), lex AS (
  SELECT term FROM own SEMI JOIN once USING (pos) WHERE term <> '' GROUP BY term
  HAVING count(*) BETWEEN greatest(2, ceil(0.001 * (SELECT count(*) FROM once))) AND greatest(2, floor(0.05 * (SELECT count(*) FROM once)))
), plain AS (
  SELECT pos, which, substr(md5(string_agg(term, ' ' ORDER BY term)), 1, 12) AS h FROM words WHERE term <> '' GROUP BY pos, which
), lev AS (
  SELECT term, j, 32 - length(bin(CAST('0x' || substr(md5((j // 4) || ':' || term), 8 * (j % 4) + 1, 8) AS BIGINT))) AS level
  FROM lex, range(16) t(j)
), f AS (
  SELECT pos, which, count(*) AS n, CAST(floor(log2(count(*))) AS INTEGER) AS level FROM words SEMI JOIN lex USING (term) GROUP BY ALL
), parts AS (
  SELECT f.pos, f.which, f.level, h.up, l.j,
         coalesce(substr(md5(string_agg(l.term, ' ' ORDER BY l.term) FILTER (l.level >= f.level + h.up)), 1, 6), '-') AS h
  FROM f JOIN words w USING (pos, which) JOIN lev l USING (term), range(2) h(up)
  GROUP BY ALL
), prints AS (
  SELECT pos, which, level, list(h ORDER BY j) FILTER (up = 0) AS low, list(h ORDER BY j) FILTER (up = 1) AS high,
         level || ':' || string_agg(h, '' ORDER BY j) FILTER (up = 0) || ':' || string_agg(h, '' ORDER BY j) FILTER (up = 1) AS print
  FROM parts GROUP BY pos, which, level
), pairs AS (
  SELECT e.pos, k.kind, a.pos IS NULL AS a_none, b.pos IS NULL AS b_none, a.level - b.level AS step,
         p.h IS NOT DISTINCT FROM q.h AS same_terms,
         a.low AS al, a.high AS ah, b.low AS bl, b.high AS bh
  FROM e, (VALUES ('edited'), ('next')) k(kind)
  LEFT JOIN prints a ON a.pos = e.pos AND a.which = 0
  LEFT JOIN prints b ON b.pos = CASE WHEN kind = 'edited' THEN e.pos ELSE e.pos % e.n + 1 END AND b.which = CASE WHEN kind = 'edited' THEN 1 ELSE 0 END
  LEFT JOIN plain p ON p.pos = e.pos AND p.which = 0
  LEFT JOIN plain q ON q.pos = CASE WHEN kind = 'edited' THEN e.pos ELSE e.pos % e.n + 1 END AND q.which = CASE WHEN kind = 'edited' THEN 1 ELSE 0 END
), sides AS (
  SELECT pos, kind, a_none, b_none, step, u.x, u.y
  FROM pairs, LATERAL (SELECT unnest([al, ah]) AS x, unnest([bl, bh]) AS y) u WHERE step = 0
  UNION ALL SELECT pos, kind, a_none, b_none, step, al, bh FROM pairs WHERE step = 1
  UNION ALL SELECT pos, kind, a_none, b_none, step, ah, bl FROM pairs WHERE step = -1
), near AS (
  SELECT pos, kind,
         avg(coalesce(len([i FOR i IN range(1, 17) IF x[i] = y[i] AND x[i] <> '-']) / nullif(len([i FOR i IN range(1, 17) IF x[i] <> '-' OR y[i] <> '-']), 0), 0.0)) AS v
  FROM sides GROUP BY pos, kind
), likeness AS (
  SELECT p.pos, p.kind, CASE WHEN a_none AND b_none THEN CAST(same_terms AS INTEGER) ELSE coalesce(v, 0.0) END AS v FROM pairs p LEFT JOIN near USING (pos, kind)
)
SELECT e.doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
       coalesce(a.print, '=' || p.h, '-') AS fingerprint, coalesce(b.print, '=' || q.h, '-') AS edited_fingerprint,
       CAST(x.v AS DOUBLE) AS near_edited, CAST(y.v AS DOUBLE) AS near_next
FROM e LEFT JOIN prints a ON a.pos = e.pos AND a.which = 0 LEFT JOIN prints b ON b.pos = e.pos AND b.which = 1
LEFT JOIN plain p ON p.pos = e.pos AND p.which = 0 LEFT JOIN plain q ON q.pos = e.pos AND q.which = 1
JOIN likeness x ON x.pos = e.pos AND x.kind = 'edited' JOIN likeness y ON y.pos = e.pos AND y.kind = 'next'
"""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w
  FROM d GROUP BY source
), levels AS (
  SELECT 3.0 * a.source_size / a.w AS stop,
         ((SELECT sum(source_size) FROM s) - coalesce(sum(3.0 * b.source_size) FILTER (3.0 * b.source_size / b.w < 3.0 * a.source_size / a.w), 0))
         / sum(b.w) FILTER (3.0 * b.source_size / b.w >= 3.0 * a.source_size / a.w) AS level
  FROM s a, s b GROUP BY a.source, a.source_size, a.w
), t AS (
  SELECT source, source_size, least(3.0 * source_size, coalesce((SELECT arg_min(level, stop) FROM levels WHERE stop >= level) * w, 3.0 * source_size)) AS target FROM s
), p AS (
  SELECT row_number() OVER () AS pid, doc_id, size, d.source, source_size, CAST(target AS DOUBLE) AS target, CAST(round(target) AS BIGINT) AS want,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size), doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), plan AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS LAST) AS sid, source_size, any_value(want) % source_size AS rest,
         CAST(ceil(source_size / 256) AS BIGINT) AS n_blocks,
         (any_value(want) // source_size) * CAST(ceil(source_size / 256) AS BIGINT) + CAST(ceil((any_value(want) % source_size) / 256) AS BIGINT) AS slots
  FROM p WHERE source_size > 0 GROUP BY source, source_size
), range_ AS (
  SELECT *, sum(slots) OVER () AS n, (sum(slots) OVER (ORDER BY sid) - slots) / sum(slots) OVER () AS lo, sum(slots) OVER (ORDER BY sid) / sum(slots) OVER () AS hi FROM plan
), point AS (
  SELECT k, ((k % 1048576 + 0.5::DOUBLE) * phi + (k // 1048576) * ((phi * 1048576) % 1.0)) % 1.0 AS x
  FROM (SELECT unnest(range(CAST((SELECT coalesce(max(n), 0) FROM range_) AS BIGINT))) AS k, (sqrt(5.0::DOUBLE) - 1) / 2 AS phi)
), drawn AS (
  SELECT r.sid, k, row_number() OVER (PARTITION BY r.sid ORDER BY k) - 1 AS r FROM point JOIN range_ r ON x >= lo AND x < hi
), late AS (
  SELECT sid, n + sum(slots - held) OVER (ORDER BY sid) - (slots - held) AS k, held, slots
  FROM (SELECT r.sid, r.n, r.slots, (SELECT count(*) FROM drawn d WHERE d.sid = r.sid) AS held FROM range_ r) WHERE held < slots
), ranked AS (
  SELECT sid, k, r FROM drawn UNION ALL SELECT sid, k + i, held + i FROM (SELECT *, unnest(range(CAST(slots - held AS BIGINT))) AS i FROM late)
), slot AS (
  SELECT l.source, k, r % n_blocks AS block, CASE WHEN r = slots - 1 AND rest % 256 > 0 THEN rest % 256 ELSE 256 END AS words
  FROM ranked JOIN plan l USING (sid) WHERE r < slots
), piece AS (
  SELECT pid, s.k, least(pos + size, block * 256 + words) - greatest(pos, block * 256) AS n
  FROM (SELECT *, unnest(range(pos // 256, (pos + size - 1) // 256 + 1)) AS b FROM p WHERE size > 0) q
  JOIN slot s ON s.source IS NOT DISTINCT FROM q.source AND s.block = q.b
)
SELECT doc_id, size, source_size, target, CAST(coalesce(sum(n) FILTER (n > 0), 0) AS BIGINT) AS taken, CAST(min(k) FILTER (n > 0) AS BIGINT) AS first_slot
FROM p LEFT JOIN piece USING (pid) GROUP BY pid, doc_id, size, source_size, target
"""

URLS = r"""
WITH u AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), hp AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), rules(rule, said) AS (
  VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')
), judged AS (
  SELECT h.*, r.rule, r.said, host || path AS s
  FROM hp h LEFT JOIN LATERAL (
    SELECT arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said FROM rules
    WHERE ('.' || h.host) LIKE '%.' || split_part(rule, '/', 1) AND starts_with(h.path, substr(rule, strpos(rule, '/')))
  ) r ON true
), texts AS (
  SELECT s, said, count(*) AS n FROM judged GROUP BY s, said
), grams AS (
  SELECT s, said, n, substr(repeat(chr(2), 4) || s || chr(3), CAST(i AS BIGINT), 5) AS gram FROM texts, LATERAL (SELECT unnest(range(1, length(s) + 2)) AS i) x
), counts AS (
  SELECT gram, coalesce(sum(n) FILTER (said = 'allow'), 0) AS a, coalesce(sum(n) FILTER (said = 'block'), 0) AS r FROM grams GROUP BY gram
), whole AS (
  SELECT sum(a) AS a, sum(r) AS r FROM counts
), suffix AS (
  SELECT k, right(gram, k) AS t, sum(a) AS a, sum(r) AS r FROM counts, range(1, 6) x(k) GROUP BY ALL
), context AS (
  SELECT k, substr(gram, 6 - k, k - 1) AS t, sum(a) AS a, sum(r) AS r FROM counts, range(2, 6) x(k) GROUP BY ALL
), p1 AS (
  SELECT gram, (t.a + 1.0 / 256) / (w.a + 1.0) AS a, (t.r + 1.0 / 256) / (w.r + 1.0) AS r FROM counts c JOIN suffix t ON t.k = 1 AND t.t = right(gram, 1), whole w
), p2 AS (
  SELECT gram, (t.a + p.a) / (c.a + 1.0) AS a, (t.r + p.r) / (c.r + 1.0) AS r FROM p1 p JOIN suffix t ON t.k = 2 AND t.t = right(gram, 2) JOIN context c ON c.k = 2 AND c.t = substr(gram, 4, 1)
), p3 AS (
  SELECT gram, (t.a + p.a) / (c.a + 1.0) AS a, (t.r + p.r) / (c.r + 1.0) AS r FROM p2 p JOIN suffix t ON t.k = 3 AND t.t = right(gram, 3) JOIN context c ON c.k = 3 AND c.t = substr(gram, 3, 2)
), p4 AS (
  SELECT gram, (t.a + p.a) / (c.a + 1.0) AS a, (t.r + p.r) / (c.r + 1.0) AS r FROM p3 p JOIN suffix t ON t.k = 4 AND t.t = right(gram, 4) JOIN context c ON c.k = 4 AND c.t = substr(gram, 2, 3)
), p5 AS (
  SELECT gram, CAST(round((ln((t.a + p.a) / (c.a + 1.0)) - ln((t.r + p.r) / (c.r + 1.0))) * 1e6) AS BIGINT) AS score
  FROM p4 p JOIN suffix t ON t.k = 5 AND t.t = gram JOIN context c ON c.k = 5 AND c.t = substr(gram, 1, 4)
), means AS (
  SELECT s, said, n, floor(sum(score) / count(*)) AS m FROM grams JOIN p5 USING (gram) GROUP BY s, said, n
), line AS (
  SELECT (sum(m * n) FILTER (said = 'allow') / sum(n) FILTER (said = 'allow') + sum(m * n) FILTER (said = 'block') / sum(n) FILTER (said = 'block')) / 2 AS x FROM means
)
SELECT page_id, host, path, rule,
       CASE WHEN j.said IS NOT NULL THEN j.said WHEN x IS NULL OR m > x THEN 'allow' ELSE 'block' END AS verdict
FROM judged j LEFT JOIN means ON means.s = j.s AND means.said IS NULL AND j.said IS NULL, line
"""

CLUSTERS_ROUND = """
, a{i} AS (
  SELECT v.pos, arg_min(c.cluster, (list_sum([(v.q[j] - c.q[j]) * (v.q[j] - c.q[j]) FOR j IN range(1, 65)]), c.cluster)) AS cluster
  FROM v, c{i} c GROUP BY v.pos
), s{i} AS (
  SELECT a.cluster, j, sum(v.q[j]) AS s, count(*) AS n
  FROM a{i} a JOIN v USING (pos), range(1, 65) r(j) GROUP BY a.cluster, j
), c{k} AS (
  SELECT c.cluster, coalesce((SELECT list(CAST((s.s - ((s.s % s.n) + s.n) % s.n) // s.n AS BIGINT) ORDER BY s.j) FROM s{i} s WHERE s.cluster = c.cluster), c.q) AS q
  FROM c{i} c
)"""

CLUSTERS = (
    """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS pos, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS (
  SELECT row_number() OVER w - 1 AS cluster, q FROM v WINDOW w AS (ORDER BY sha256('1:' || vec_id) NULLS LAST, q) QUALIFY row_number() OVER w <= 16
)"""
    + "".join(CLUSTERS_ROUND.format(i=i, k=i + 1) for i in range(3))
    + """
, d AS (
  SELECT v.pos, v.vec_id, c.cluster, c.q, list_sum([(v.q[j] - c.q[j]) * (v.q[j] - c.q[j]) FOR j IN range(1, 65)]) AS distance
  FROM v, c3 c QUALIFY row_number() OVER (PARTITION BY v.pos ORDER BY distance, c.cluster) = 1
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(q, ',')) AS centroid_sha256
FROM d
"""
)

LEXICAL = r"""
WITH d AS (
  SELECT row_number() OVER () AS pos, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), size AS (
  SELECT count(*) AS nn, sum(len(terms)) AS ll FROM d WHERE len(terms) > 0
), tf AS (
  SELECT pos, term, count(*) AS tf FROM (SELECT pos, unnest(terms) AS term FROM d) GROUP BY pos, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * CAST(nn AS DOUBLE) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, size GROUP BY term, nn
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT a.item_id, d.pos, d.doc_id,
         CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 90 + CAST((90 * len(d.terms) * nn) // ll AS BIGINT))))) AS BIGINT) AS score
  FROM asked a JOIN w USING (term) JOIN tf USING (term) JOIN d USING (pos), size
  GROUP BY a.item_id, d.pos, d.doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op1_topk": TOPK,
    "op2_imatch": IMATCH,
    "op5_source_mix": MIX,
    "op8_url_filter": URLS,
    "op12_simplex_clusters": CLUSTERS,
    "op13_lexical_nra": LEXICAL,
}
