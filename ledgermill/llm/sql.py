"""Oracle SQL (DuckDB) for the operators that SQL can express."""

WARC_RECORDS = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN f.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first < p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""

EMBEDDING_LINKS = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT v.vec_id, CAST(coalesce(counts.n, 0) AS BIGINT) AS n_links, roots.root AS component_id, roots.root = v.vec_id AS kept
FROM v JOIN roots ON roots.a = v.vec_id LEFT JOIN counts ON counts.a = v.vec_id
"""

# Targets 1 to 4 by source; rows of a source in order of (hash, id); earliest deadline first over one period of 1,000 slots; blocks of 32 rows.
MIXED = """
WITH RECURSIVE d AS (SELECT doc_id, source, substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS hash FROM documents),
s AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) AS k FROM documents GROUP BY source),
x AS (SELECT *, CAST(1 + (k - 1) % 4 AS DOUBLE) AS target FROM s),
e AS (SELECT *, target / (SELECT sum(target) FROM x) * (1000 - (SELECT count(*) FROM s)) AS exact FROM x),
q AS (SELECT *, 1 + CAST(floor(exact) AS BIGINT) AS least, row_number() OVER (ORDER BY floor(exact) - exact, k) AS turn FROM e),
w AS (SELECT source, n, k, least + CASE WHEN turn <= 1000 - (SELECT sum(least) FROM q) THEN 1 ELSE 0 END AS a FROM q),
l AS (SELECT list(a ORDER BY k) AS a, list(n ORDER BY k) AS n FROM w),
edf AS (
  SELECT 0 AS t, list_transform(a, lambda x: CAST(0 AS BIGINT)) AS done, CAST(NULL AS BIGINT) AS pick, a FROM l
  UNION ALL
  SELECT t + 1, list_transform(done, lambda x, i: x + CASE WHEN i = p THEN 1 ELSE 0 END), p, a
  FROM (
    SELECT t, done, a, list_min(list_filter(
      list_transform(done, lambda x, i: CASE WHEN x * 1000 // a[i] <= t THEN ((x + 1) * 1000 + a[i] - 1) // a[i] * 100000 + i END), lambda y: y IS NOT NULL)) % 100000 AS p
    FROM edf WHERE t < 1000)),
plan AS (
  SELECT e1.pick AS k, e0.done[e1.pick] AS nth, e0.t AS slot, e0.done AS before FROM edf e1 JOIN edf e0 ON e0.t = e1.t - 1),
r AS (
  SELECT d.doc_id, d.source, w.k, w.a, row_number() OVER (PARTITION BY d.source ORDER BY d.hash, d.doc_id) - 1 AS i
  FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source)
SELECT r.doc_id, r.source, CAST(i // 32 AS BIGINT) AS block, CAST(i % 32 AS BIGINT) AS block_row,
  CAST(i // 32 // r.a * 1000 + plan.slot AS BIGINT) AS slot,
  CAST(list_sum(list_transform(l.n, lambda n, j: least(n, (i // 32 // r.a * l.a[j] + plan.before[j]) * 32))) + i % 32 AS BIGINT) AS position
FROM r JOIN plan ON plan.k = r.k AND plan.nth = (i // 32) % r.a, l
"""


def licenses(phrases: list[tuple[list[str], str]], templates: list[tuple[list[str], str]], percent: int, block_words: int) -> str:
    """Places of phrases, and every template against every block."""
    listed = lambda rows: ", ".join(f"({k}, {words}, '{label}')" for k, (words, label) in enumerate(rows))
    return f"""
WITH t AS (
  SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')) AS s FROM documents),
w AS (SELECT row_number() OVER () AS r, doc_id, CASE WHEN s = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(s, ' ') END AS w FROM t),
p(k, words, label) AS (VALUES {listed(phrases)}),
c(k, words, label) AS (VALUES {listed(templates)}),
pos AS (SELECT r, unnest(range(len(w))) AS i, w FROM w),
places AS (SELECT pos.r, pos.i, p.label FROM pos JOIN p ON pos.w[pos.i + 1] = p.words[1] AND pos.w[pos.i + 1:pos.i + len(p.words)] = p.words),
base AS (SELECT r, count(*) AS n, min(i) AS first, max(i) AS last FROM places GROUP BY r),
starts AS (SELECT r, unnest(range(0, len(w), {block_words // 2})) AS i, w FROM w),
blocks AS (SELECT r, list_distinct(w[i + 1:i + {block_words}]) AS b FROM starts),
met AS (
  SELECT r, label, len(list_intersect(b, words)) / len(words) AS share FROM blocks, c
  WHERE 100 * len(list_intersect(b, words)) >= {percent} * len(words)),
best AS (SELECT r, max(share) AS share FROM met GROUP BY r),
base_names AS (SELECT r, string_agg(label, ',' ORDER BY label) AS s FROM (SELECT DISTINCT r, label FROM places) GROUP BY r),
names AS (SELECT r, string_agg(label, ',' ORDER BY label) AS s FROM (SELECT r, label FROM places UNION SELECT r, label FROM met) GROUP BY r)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base, CAST(base.first AS BIGINT) AS first_word,
  CAST(base.last AS BIGINT) AS last_word, coalesce(base_names.s, '') AS base_labels, coalesce(names.s, '') AS labels,
  CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(best.share, 0.0) END AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN best USING (r) LEFT JOIN base_names USING (r) LEFT JOIN names USING (r)
"""

PHRASES = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
pos AS MATERIALIZED (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT lang, w, i, unnest([1, 2, 3, 4]) AS k FROM pos) WHERE i + k - 1 <= len(w)),
f AS MATERIALIZED (SELECT lang, k, g, count(*) AS c FROM grams GROUP BY lang, k, g),
n AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, k, g, c, string_split(g, ' ') AS w FROM f WHERE k >= 2 AND c >= 30),
spans AS (SELECT lang, k, w, c, unnest([1, 2, 3]) AS i FROM cand WHERE k > 2),
inner_spans AS (SELECT lang, k, w, c, i, unnest([2, 3]) AS m FROM spans),
inner_of AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, max(c) AS most FROM inner_spans WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
split AS (SELECT lang, g, w, c, k, unnest([1, 2, 3]) AS cut FROM cand),
sides AS MATERIALIZED (
  SELECT lang, g, c, cut, array_to_string(w[1:cut], ' ') AS lg, array_to_string(w[cut + 1:], ' ') AS rg FROM split WHERE cut < k),
cuts AS (
  SELECT s.lang, s.g, s.c AS a, s.cut, fl.c AS l, fr.c AS r, CAST(CAST(2000000 AS HUGEINT) * s.c // (fl.c + fr.c) AS BIGINT) AS score
  FROM sides s JOIN f AS fl ON fl.lang = s.lang AND fl.g = s.lg JOIN f AS fr ON fr.lang = s.lang AND fr.g = s.rg),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
left_over AS (
  SELECT best.* FROM best LEFT JOIN inner_of ON best.lang = inner_of.lang AND best.g = inner_of.g
  WHERE most IS NULL OR CAST(100 AS HUGEINT) * most < CAST(80 AS HUGEINT) * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score
FROM left_over JOIN n USING (lang) QUALIFY rank <= 2000
"""
