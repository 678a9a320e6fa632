"""DuckDB SQL for the corpus queries that SQL can express.

The others (fingerprints by XXH64, iterated graphs, trained models) are tested
against brute-force versions in tests/llm.
"""

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, comp.component_id,
       e.vec_id = comp.component_id AS kept
FROM embeddings e LEFT JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""

OP2 = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS sha FROM p),
d AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first_id FROM h),
k AS (SELECT *, lower(regexp_replace(trim(url), '#.*$', '')) AS low FROM d),
x AS (SELECT *, regexp_matches(low, '^(?:[a-z][a-z0-9+.-]*:)?//') AS is_url,
    regexp_replace(regexp_extract(low, '^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?@]*@)?([^/?:]*)(:[0-9]*)?(.*)$', 1), '^www[0-9]*\.', '') AS host,
    regexp_replace(regexp_extract(low, '^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?@]*@)?([^/?:]*)(:[0-9]*)?(.*)$', 2), '^:(80|443)?$', '') AS port,
    regexp_extract(low, '^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?@]*@)?([^/?:]*)(:[0-9]*)?(.*)$', 3) AS rest FROM k)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(sha, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
  CASE WHEN url IS NULL THEN '' WHEN is_url THEN
    array_to_string(list_reverse(string_split(host, '.')), ',') || port || ')' ||
    CASE WHEN rest = '' THEN '/' ELSE rest END ELSE low END AS url_key,
  '1970-01-01T00:00:00Z' AS captured
FROM x
"""

OP9 = """
WITH c AS (
  SELECT source, count(*) AS n,
    CASE source WHEN 'src0' THEN 4.0::DOUBLE WHEN 'src1' THEN 2.0 WHEN 'src2' THEN 0.5 ELSE 1.0 END AS weight
  FROM documents GROUP BY source),
r AS (SELECT source, weight / (SELECT sum(weight) FROM c) * (SELECT sum(n) FROM c)::DOUBLE / n AS rate FROM c),
d AS (
  SELECT doc_id, documents.source, lang, n_chars, rate,
    greatest(1, ceil(rate / 16.0))::INT AS parts FROM documents JOIN r ON documents.source IS NOT DISTINCT FROM r.source),
u AS (
  SELECT *, rate / parts AS part_rate, unnest(range(1, parts + 1)) AS j FROM d),
v AS (
  SELECT *, ('0x' || substr(md5('13|' || CASE WHEN parts = 1 THEN 'n' ELSE 'p' || j END || '|' ||
      coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS x FROM u),
w AS (
  SELECT *, len(list_filter(list_transform(range(0, 84), lambda k:
      list_sum(list_transform(range(0, k + 1), lambda i: exp(-part_rate + i * ln(part_rate) - lgamma(i + 1))))),
      lambda cum: x >= cum)) AS k FROM v),
n AS (
  SELECT doc_id, source, lang, n_chars, sum(k)::BIGINT AS n FROM w GROUP BY ALL)
SELECT doc_id, source, lang, n_chars, unnest(range(1, n + 1))::INT AS replica FROM n
"""

OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, s.vec_id AS negative_id, positive_score,
  score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""

ORACLES = {"op1_embedding_near_dedup": OP1, "op2_warc_index_merge": OP2, "op9_poisson_mixing": OP9,
           "op12_hard_negatives": OP12}
