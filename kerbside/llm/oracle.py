"""The same results in SQL, where SQL can express them."""

ORACLE: dict[str, str] = {}

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE["op9_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY bare ORDER BY n DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY bare) AS group_size,
  row_number() OVER (PARTITION BY bare ORDER BY n DESC, doc_id) = 1 AS kept,
  sha256(bare) AS text_sha256
FROM t
"""

ORACLE["op10_line_dedup"] = f"""
WITH lines AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS line FROM documents),
each AS (SELECT doc_id, unnest(line) AS line, generate_subscripts(line, 1) AS pos FROM lines),
keyed AS (
  SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM each),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.*, coalesce(doc_id <> keeper, false) AS gone FROM keyed LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1))"

ORACLE["op1_warc_index"] = r"""
WITH t AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)(.*)$', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)(.*)$', 2) AS path
  FROM pages),
u AS (
  SELECT *, strlen(html) AS n,
    CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first
  FROM t)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to,
  CASE WHEN host <> '' THEN array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || path
    ELSE coalesce(url, '') END AS url_key,
  strftime(make_timestamp((1704067200 + page_id % 10000000 * 60) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured_at
FROM u
"""

ORACLE["op3_maxscore_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS cells FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.cells, v.cells)::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

ORACLE["op6_temporal_url_lists"] = f"""
WITH hosts AS (
  SELECT page_id, url, {_HOST} AS host, regexp_replace({_HOST}, '^[^.]+\\.', '') AS domain,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS first
  FROM pages),
names AS (
  SELECT host AS raw FROM hosts UNION SELECT domain FROM hosts
  UNION SELECT upper(domain) || '/' || first FROM hosts WHERE first <> ''),
digits AS (
  SELECT lower(split_part(raw, '/', 1)) || raw[length(split_part(raw, '/', 1)) + 1:] AS key,
    ('0x' || md5(raw)[1:2])::INTEGER AS d1, ('0x' || md5(raw)[3:4])::INTEGER AS since,
    ('0x' || md5(raw)[5:6])::INTEGER + 1 AS days, ('0x' || md5(raw)[7:8])::INTEGER AS turn
  FROM names WHERE raw <> ''),
entries AS (
  SELECT key, CASE WHEN turn % 5 = 0 THEN 'allow' ELSE 'block' END AS list, turn % 3 AS steps,
    DATE '2024-01-01' + since AS d0, DATE '2024-01-01' + (since + days) AS d1, DATE '2024-01-01' + (since + 2 * days) AS d2
  FROM digits WHERE d1 % 3 = 0),
active AS (
  SELECT list, key, d0 AS valid_from, CASE WHEN steps >= 1 THEN d1 END AS valid_until FROM entries
  UNION ALL SELECT list, key, d2, NULL FROM entries WHERE steps = 2),
fetched AS (
  SELECT *, make_timestamp((1704067200 + page_id * 600) * 1000000)::DATE AS day, string_split(host, '.') AS labels,
    string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]+)', 1), '/') AS parts
  FROM hosts WHERE host <> ''),
keyed AS (
  SELECT DISTINCT page_id, url, day, name || CASE WHEN i = 0 THEN '' ELSE '/' || array_to_string(parts[1:i], '/') END AS key
  FROM (SELECT *, unnest(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) AS name FROM fetched),
    LATERAL (SELECT unnest(range(0, len(parts) + 1)) AS i)
  WHERE i = 0 OR parts[i] <> ''),
found AS (
  SELECT page_id, url, string_agg(list || ':' || key, ' ' ORDER BY list || ':' || key) AS matches,
    bool_or(list = 'block') AND NOT bool_or(list = 'allow') AS blocked
  FROM keyed JOIN active USING (key)
  WHERE valid_from <= day AND (valid_until IS NULL OR day < valid_until) GROUP BY page_id, url)
SELECT pages.page_id, pages.url, coalesce(blocked, false) AS blocked, coalesce(matches, '') AS matches
FROM pages LEFT JOIN found USING (page_id, url)
"""

ORACLE["op12_block_max_search"] = r"""
WITH word AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents)
  GROUP BY ALL),
size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM word GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS words FROM size),
relative AS (SELECT doc_id, 75 + (25 * n * n_docs) // words AS m FROM size, total),
known AS (SELECT term, count(*) AS df FROM word GROUP BY term),
asked AS (
  SELECT item_id, term, count(*) AS repeats
  FROM (SELECT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
weighted AS (
  SELECT item_id, term, repeats * CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM asked JOIN known USING (term), total),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM weighted JOIN word USING (term) JOIN relative USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 20
"""
