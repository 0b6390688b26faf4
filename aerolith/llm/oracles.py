"""SQL with the same results, for DuckDB."""

MIXING = r"""
WITH rows_ AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents
), sources_ AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows_ GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place FROM sources_
), weighed AS (
  SELECT *, CAST([3, 1, 2][(place - 1) % 3 + 1] AS DOUBLE) AS weight FROM ranked
), dry AS (
  SELECT *, CAST(source_size * 2 AS DOUBLE) / weight AS dry FROM weighed
), levels AS (
  SELECT *,
    (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
      - CAST(coalesce(sum(source_size * 2) OVER (ORDER BY dry, place
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / sum(weight) OVER (ORDER BY dry, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM dry
), water AS (
  SELECT arg_min(level, (dry, place)) AS level FROM levels WHERE level <= dry
), targets AS (
  SELECT source, weight, source_size,
         coalesce(least(CAST(source_size * 2 AS DOUBLE), weight * water.level),
                  CAST(source_size * 2 AS DOUBLE)) AS target
  FROM levels, water
), placed AS (
  SELECT doc_id, size, weight, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows_ r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *,
         greatest(0, least(size, CAST(round(target) AS BIGINT) - before)) AS first_,
         greatest(0, least(size, CAST(round(target) AS BIGINT) - source_size - before)) AS second_
  FROM placed
)
SELECT doc_id, size, source_size, target, CAST(first_ + second_ AS BIGINT) AS taken,
       CASE WHEN first_ > 0 THEN CAST(before + size AS DOUBLE) / weight END AS virtual_finish
FROM taken
"""

CHAT = r"""
WITH messages AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
), turns AS (
  SELECT conv_id, turn, count(*) AS n,
         string_agg(turn || chr(1) || role || chr(1) || text, chr(2) ORDER BY role, text) AS said
  FROM messages GROUP BY conv_id, turn
), prefixes AS (
  SELECT conv_id, turn, sum(n) OVER w AS n, string_agg(said, chr(2)) OVER w AS said
  FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)
), wholes AS (
  SELECT conv_id, max(n) AS n, arg_max(said, n) AS said FROM prefixes GROUP BY conv_id
), groups_ AS (
  SELECT said, min(conv_id) AS conv_id, CAST(max(n) AS BIGINT) AS n_messages, count(*) AS n_copies
  FROM wholes GROUP BY said
), chosen AS (
  SELECT g.* FROM groups_ g
  WHERE NOT EXISTS (
    SELECT 1 FROM prefixes p JOIN wholes w USING (conv_id)
    WHERE p.said = g.said AND w.n > g.n_messages)
)
SELECT c.conv_id, m.segment, c.n_messages, c.n_copies,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                  ORDER BY turn, role, text) AS text
FROM chosen c JOIN (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1) // 1024 AS segment
  FROM messages) m USING (conv_id)
GROUP BY ALL
"""

URLS = r"""
WITH captures AS (
  SELECT page_id, DATE '2024-01-01' + CAST(((page_id % 730) + 730) % 730 AS INTEGER) AS fetch_date,
    nullif(rtrim(lower(regexp_extract(
      replace(regexp_replace(url, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'), chr(92), '/'),
      '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.'), '') AS host
  FROM pages
), hosts AS (
  SELECT DISTINCT host, string_split(host, '.') AS labels FROM captures WHERE host IS NOT NULL
), keyed AS (
  SELECT host, unnest([array_to_string(labels[i:], '.')
    FOR i IN range(greatest(len(labels) - 9, 1), greatest(len(labels), 2))]) AS key
  FROM hosts
), digits AS (
  SELECT key, [CAST('0x' || d AS INTEGER) FOR d IN string_split(md5(key), '')] AS x
  FROM (SELECT DISTINCT key FROM keyed)
), listed AS (
  SELECT key, ['malware', 'spam', 'adult'][(x[9] * 16 + x[10]) % 3 + 1] AS list,
         CASE WHEN x[11] < 6 THEN 'host' ELSE 'domain' END AS scope,
         (x[2] * 256 + x[3] * 16 + x[4]) % 600 AS first_,
         x[5] * 16 + x[6] AS stay, x[7] * 16 + x[8] AS back
  FROM digits WHERE x[1] < 8
), entries AS (
  SELECT list, scope, key, first_ AS o, TRUE AS active FROM listed
  UNION ALL SELECT list, scope, key, first_ + 20 + stay, FALSE FROM listed
  UNION ALL SELECT list, scope, key, first_ + 300 + back, TRUE FROM listed
), daily AS (
  SELECT list, scope, key, DATE '2024-01-01' + CAST(o AS INTEGER) AS valid_from, bool_or(active) AS active
  FROM entries GROUP BY ALL
), intervals AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY list, scope, key ORDER BY valid_from) AS valid_to
  FROM daily
), hits AS (
  SELECT c.host, c.fetch_date, i.list, i.scope, i.key, i.valid_from, i.valid_to,
    row_number() OVER (PARTITION BY c.host, c.fetch_date
      ORDER BY length(i.key) DESC, i.scope <> 'host', i.list) AS rank
  FROM (SELECT DISTINCT host, fetch_date FROM captures) c
  JOIN keyed k USING (host)
  JOIN intervals i ON i.key = k.key AND i.active AND c.fetch_date >= i.valid_from
    AND (i.valid_to IS NULL OR c.fetch_date < i.valid_to)
    AND (i.scope = 'domain' OR i.key = c.host)
)
SELECT c.page_id, c.host, c.fetch_date, h.host IS NOT NULL AS blocked,
       h.list, h.scope, h.key, h.valid_from, h.valid_to
FROM captures c LEFT JOIN hits h ON c.host = h.host AND c.fetch_date = h.fetch_date AND h.rank = 1
"""

# DuckDB has SHA-1 in hexadecimal only: each five bits of it are a base32 character.
WARC = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT *, [CAST('0x' || hex[i * 5 + 1 : i * 5 + 5] AS INTEGER) FOR i IN range(8)] AS twenty FROM payloads
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  array_to_string(flatten([
    ['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(x >> shift) % 32 + 1] FOR shift IN [15, 10, 5, 0]]
    FOR x IN twenty]), '') AS payload_digest,
  CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM bits
WINDOW same AS (PARTITION BY payload)
"""

# Whole components as doubles hold every sum exactly.
_WHOLE = r"""
  SELECT vec_id, label, [floor(x * CAST(256 AS DOUBLE)) FOR x IN CAST(embedding AS DOUBLE[])] AS whole
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN CAST(embedding AS DOUBLE[]) IF x IS NULL OR NOT isfinite(x)]) = 0
"""

_NEAREST = r"""near{i} AS (
  SELECT r, part, v, min(away) AS away, arg_min(entry, (away, entry)) AS entry
  FROM (
    SELECT r, p.part, v, entry,
           list_inner_product(v, v) - 2 * list_inner_product(v, e) + list_inner_product(e, e) AS away
    FROM pieces p JOIN books{i} b ON p.part = b.part)
  GROUP BY r, part, v
)"""

_AVERAGES = r"""means{i} AS (
  SELECT part, entry, list(floor(total / n) ORDER BY j) AS e
  FROM (
    SELECT part, entry, j, sum(v[j]) AS total, count(*) AS n
    FROM near{i}, range(1, 5) t(j) GROUP BY part, entry, j)
  GROUP BY part, entry
), books{next} AS (
  SELECT b.part, b.entry, coalesce(m.e, b.e) AS e
  FROM books{i} b LEFT JOIN means{i} m ON b.part = m.part AND b.entry = m.entry
)"""

CODES = f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, * FROM ({_WHOLE})
), pieces AS (
  SELECT r, part, whole[part * 4 + 1 : part * 4 + 4] AS v FROM kept, range(16) t(part)
), seeds AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS entry, whole
  FROM (SELECT vec_id, min(whole) AS whole FROM kept WHERE vec_id IS NOT NULL
        GROUP BY vec_id ORDER BY vec_id LIMIT 64)
), books0 AS (
  SELECT part, entry, whole[part * 4 + 1 : part * 4 + 4] AS e FROM seeds, range(16) t(part)
), {", ".join(_NEAREST.format(i=i) + ", " + _AVERAGES.format(i=i, next=i + 1) for i in (0, 1))},
{_NEAREST.format(i=2)}, coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(away) AS BIGINT) AS error
  FROM near2 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, label,
  (SELECT sha256(string_agg(array_to_string([CAST(x AS BIGINT) FOR x IN e], ','), ',' ORDER BY part, entry))
   FROM books2) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""

NEGATIVES = f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, whole
  FROM ({_WHOLE}) WHERE label IS NOT NULL AND vec_id IS NOT NULL
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.whole, c.whole) AS BIGINT) AS score
  FROM kept a JOIN kept c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score,
         n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS place
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE place <= 3
"""
