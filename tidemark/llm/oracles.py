"""DuckDB SQL for those queries of this subpackage that SQL can express."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# All pairs that share a shingle, and a closure over the links. The SQL names a text's set
# by its words themselves.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
rows_ AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM rows_ a JOIN rows_ b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * n >= 75 * (len(p.s) + len(q.s) - n)),
both_ AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS node, a AS seen FROM both_ UNION SELECT r.node, e.b FROM reach r JOIN both_ e ON e.a = r.seen),
labels AS (SELECT node, min(seen) AS c FROM reach GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept
FROM sets LEFT JOIN labels ON node = doc_id
"""

CONTAMINATION = rf"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
    array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
hits AS (
  SELECT doc_id, p, size, item_id
  FROM (SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS x
        FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
              FROM doc_words, (SELECT DISTINCT size FROM windows)))
  JOIN windows USING (size, x)),
hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

# The checksum goes over the bytes one by one, by the polynomial's 16 values for half a byte.
_CRC_TABLE = "([" + ", ".join(
    str(v)
    for v in (
        0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
        0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C,
    )
) + "]::UBIGINT[])"

SHARDS = rf"""
WITH sized AS (
  SELECT doc_id, source, strlen(coalesce(text, ''))::BIGINT + 1 AS size,
    hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (
  SELECT doc_id, source, size, CASE WHEN size = 1 THEN 0 ELSE xor(list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(range(0, 2 * (size - 1)),
        lambda i: (instr('0123456789ABCDEF', h[CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END]) - 1)::UBIGINT)),
      lambda c, d: xor(c >> 4, {_CRC_TABLE}[xor(c & 15::UBIGINT, d)::INT + 1])), 4294967295::UBIGINT) END::BIGINT AS text_crc32
  FROM sized),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, size, text_crc32) AS r,
    count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT *, ('0x' || sha256(concat_ws(':', 'interleave-1:' || coalesce(doc_id::VARCHAR, ''), size, text_crc32))[1:15])::BIGINT AS h
        FROM summed)),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (r - 0.5)::DOUBLE / n, source IS NULL, source) - 1 AS place,
    count(*) OVER () // 16 AS small, count(*) OVER () % 16 AS extra FROM ranked),
cut AS (
  SELECT *, CASE WHEN place < extra * (small + 1) THEN place // (small + 1)
    ELSE extra + (place - extra * (small + 1)) // greatest(small, 1) END AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard,
  (place - shard * small - least(shard, extra))::BIGINT AS slot, NULL::INT AS grown_shard, source
FROM cut
"""

CAPTURES = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
known AS (SELECT page_id, p, strlen(p)::BIGINT AS payload_bytes, sha1(p) AS h, max(page_id) OVER (PARTITION BY p) AS last FROM payloads)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(h, (10 * (i // 8) + 1)::INT, 10))::BIGINT >> (5 * (7 - i % 8))) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to, TRUE AS digest_holds
FROM known
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH = rf"""
WITH held AS (SELECT doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT doc_id, len(w)::BIGINT AS n FROM held WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM lengths),
tfs AS (SELECT doc_id, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS t FROM held) GROUP BY ALL),
asked AS (SELECT item_id, t, count(*)::BIGINT AS q FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
weights AS (SELECT t, floor(1000 * ln((2.0::DOUBLE * nn + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, totals GROUP BY t, nn),
scored AS (
  SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll))))::BIGINT AS score
  FROM asked JOIN tfs USING (t) JOIN weights USING (t) JOIN lengths USING (doc_id), totals GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scored WHERE score > 0)
SELECT item_id, r::INT AS rank, doc_id, score FROM ranked WHERE r <= 10
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = rf"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM split),
keyed AS (SELECT doc_id, line, place, {_LOWER.replace("text", f"trim(line, {_BLANKS})")} AS k FROM lines),
gone AS (SELECT k AS g FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(g) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE g IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN gone ON k = g GROUP BY doc_id
"""

# Every node is named by the list of its turns, and a subtree is what begins with it.
TRIE = rf"""
WITH RECURSIVE turns AS (
  SELECT conv_id AS c, row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
  FROM conversations WHERE conv_id IS NOT NULL),
bytes_ AS (SELECT c, hex(encode(c::VARCHAR)) AS x FROM (SELECT DISTINCT c FROM turns)),
convs AS (
  SELECT c, c - c % 5 AS base, xor(list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(0, len(x)),
      lambda i: (instr('0123456789ABCDEF', x[CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END]) - 1)::UBIGINT)),
    lambda s, d: xor(s >> 4, {_CRC_TABLE}[xor(s & 15::UBIGINT, d)::INT + 1])), 4294967295::UBIGINT) % 9 AS h FROM bytes_),
parts AS (
  SELECT convs.c, 0 AS part, p, t FROM convs JOIN turns ON turns.c = base WHERE p < h
  UNION ALL SELECT convs.c, 1, p, t FROM convs JOIN turns ON turns.c = convs.c WHERE p >= h),
seqs AS (
  SELECT c, coalesce(list(t ORDER BY part, p) FILTER (WHERE part IS NOT NULL), []) AS s FROM convs LEFT JOIN parts USING (c) GROUP BY c),
members AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seqs),
nodes AS (
  SELECT d, s[1:d] AS k, min(c) AS m, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(s) = d), '') AS ends
  FROM members GROUP BY d, s[1:d]),
full_ AS (
  SELECT v.*, u.m AS pm, (v.n - 1) * CASE WHEN v.d = 0 THEN 0 ELSE strlen(v.k[v.d].text) END AS saved
  FROM nodes v LEFT JOIN nodes u ON u.d = v.d - 1 AND u.k = v.k[1:v.d - 1]),
kids AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT f.*, coalesce(kids, 0) AS kids FROM full_ f LEFT JOIN kids ON kids.d = f.d AND kids.k = f.k),
below AS (
  SELECT a AS d, k[1:a] AS k, sum(saved) AS saved, count(*) FILTER (WHERE kids = 0) AS leaves
  FROM (SELECT k, saved, kids, unnest(range(0, d + 1)) AS a FROM counted) GROUP BY a, k[1:a])
SELECT m::BIGINT AS conv_id, c.d::BIGINT AS depth, pm::BIGINT AS parent_conv_id, n::BIGINT AS n_convs, kids::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM counted c JOIN below b ON b.d = c.d AND b.k = c.k
"""
