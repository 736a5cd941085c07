"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op3_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLES["op6_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight, 3 * source_size AS cap FROM s
), l AS (
  -- the level at which the sources before one (by cap per weight) are at their cap
  SELECT *, coalesce(sum(cap) OVER o, 0) AS full_caps, sum(weight) OVER p AS rest, sum(source_size) OVER () AS total
  FROM w
  WINDOW o AS (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         p AS (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), share AS (
  SELECT arg_min((total - full_caps) / rest, cap / weight) AS share FROM l WHERE weight * ((total - full_caps) / rest) < cap
), t AS (
  SELECT source, source_size,
         CASE WHEN share IS NULL OR weight * share >= cap THEN CAST(cap AS DOUBLE) ELSE weight * share END AS target
  FROM w CROSS JOIN share
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null:' || digest)), 1, 13) AS UBIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""

ORACLES["op7_url_filter"] = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
         regexp_extract(coalesce(url, ''), '^[^?#]*(\?[^#]*)', 1, 's') AS query, html, url
  FROM pages
), rules(verdict, rh, rp) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT u.page_id, rh || rp AS rule, verdict, row_number() OVER (PARTITION BY u.page_id ORDER BY len(rh || rp) DESC) AS k
  FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT u.page_id, host, path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM u LEFT JOIN fits f ON u.page_id = f.page_id AND f.k = 1
"""

ORACLES["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), w AS (
  SELECT k, lang, source, unnest(words) AS term FROM d
), vocab AS (
  SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 30
), g AS (
  SELECT DISTINCT lang, source FROM d
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL
), cell AS (
  SELECT g.lang, g.source, v.term, v.lang_n, coalesce(c.n, 0) AS n
  FROM g JOIN vocab v ON g.lang = v.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term
), sums AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(lang_n) OVER (PARTITION BY lang, source) AS lang_total,
         count(*) OVER (PARTITION BY lang, source) AS v
  FROM cell
), share AS (
  SELECT lang, source, term, n, CAST(1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (total + 5 * v) AS BIGINT) AS p,
         CAST(1 + (1000000000 * CAST(lang_n + 5 AS HUGEINT)) // (lang_total + 5 * v) AS BIGINT) AS q
  FROM sums
), pair AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN share x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN share y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
), every AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM share WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM every
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
