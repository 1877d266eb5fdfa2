"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

#: Inner products of all queries with all candidates.
TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
q AS (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(v.v AS DOUBLE[])) AS BIGINT) AS score
  FROM q JOIN v ON v.vec_id <> q.vec_id
),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

URLS = r"""
WITH p AS (
  SELECT page_id, url, coalesce(instr(url, '://') > 0, FALSE) AS has,
         substr(url, instr(url, '://') + 3) AS rest
  FROM pages
),
h AS (
  SELECT page_id,
         CASE WHEN has THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN has THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
         CASE WHEN has THEN coalesce(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '') ELSE '' END AS query
  FROM p
),
c AS (
  SELECT *,
         regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(www|m|blog)\.', '')
         || regexp_replace(regexp_replace(path, '(/index)?(\.html?)$', ''), '/+$', '')
         || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(query, '&'),
              lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)='))), '&'), ''), '') AS canonical,
         list_has_any(string_split(host, '.'), ['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) AS bad
  FROM h
),
listed AS (SELECT DISTINCT canonical FROM c WHERE bad AND canonical <> ''),
r AS (
  SELECT *,
         CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM c
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

#: Four characters of base32 for five hexadecimal digits; among equal pages with equal ids one alone is the response.
RECORDS = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
r AS (
  SELECT *, row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS place,
         max(page_id) OVER (PARTITION BY html) AS top
  FROM p
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((CAST('0x' || substr(hex, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN top END AS refers_to
FROM r
"""

EXPECTED: dict[str, str] = {"op6_exact_top_k": TOP_K, "op10_url_filter": URLS, "op12_warc_index": RECORDS}
