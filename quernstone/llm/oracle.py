"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), toks AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d
), windows AS (
  SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM toks
), grams AS (
  SELECT r, i, array_to_string(w[i:i+4], ' ') AS g FROM windows
), twice AS (
  SELECT r, unnest([i, i+1, i+2, i+3, i+4]) AS p
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1
), repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM twice GROUP BY r
), lines AS (
  SELECT r, l.line AS line, l.i AS i FROM (
    SELECT r, unnest(list_zip(string_split(text, chr(10)), range(1, len(string_split(text, chr(10))) + 1))) AS z FROM d
  ), LATERAL (SELECT z[1] AS line, z[2] AS i) l
), counted AS (
  SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w,
    row_number() OVER (PARTITION BY r, line ORDER BY i) AS copy
  FROM lines
), judged AS (
  SELECT r, line, copy, len(w) AS n,
    length(regexp_replace(line, '[^#*$%&<>]', '', 'g')) > len(w)
    OR (length(regexp_replace(line, '[^|]', '', 'g')) >= 2
        AND len(w) <= 5 * (length(regexp_replace(line, '[^|]', '', 'g')) + 1))
    OR (len(w) >= 8 AND 10 * len(list_filter(range(2, len(w) + 1), lambda k: w[k] = w[k - 1])) >= 4 * len(w))
    OR (len(w) >= 3 AND length(regexp_replace(line, '[^!]', '', 'g')) >= len(w))
    OR (len(w) >= 3 AND regexp_matches(line, '[A-Z]')
        AND length(regexp_replace(line, '[^A-Z]', '', 'g')) >= 2 * length(regexp_replace(line, '[^a-z]', '', 'g')))
    OR (len(w) <= 12 AND regexp_matches(line, '(?i)all rights reserved|click here|cookie policy|enable javascript|lorem ipsum|privacy policy|read more|sign in|skip to content|subscribe to|terms of service|terms of use'))
    OR NOT regexp_matches(line, '\pL')
    OR (len(w) < 3 AND NOT regexp_matches(line, '[.!?:;…"'')\]»”’][\x20\x09-\x0D]*$')) AS failed
  FROM counted WHERE len(w) > 0
), by_doc AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE copy > 1) AS n_dup_lines,
    count(*) FILTER (WHERE failed) AS n_failed_lines, sum(length(line)) AS line_chars,
    coalesce(sum(length(line)) FILTER (WHERE failed), 0) AS lost_chars
  FROM judged GROUP BY r
), base AS (
  SELECT d.doc_id, len(toks.w)::BIGINT AS n_words,
    length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_failed_lines, 0)::BIGINT AS n_failed_lines,
    coalesce(line_chars, 0)::BIGINT AS line_chars, coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM d JOIN toks USING (r) LEFT JOIN repeats USING (r) LEFT JOIN by_doc USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost_chars <= 0.3::DOUBLE * line_chars AS kept,
  n_lines, n_failed_lines, line_chars, lost_chars
FROM base
"""

OP2 = r"""
WITH h AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || chr(31) || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
), levels AS (
  SELECT h.*, d::INT AS depth, h >> (60 - d) AS bits FROM h, range(0, 61) t(d)
), sized AS (
  SELECT *, sum(bytes) OVER (PARTITION BY depth, bits) AS size, count(*) OVER (PARTITION BY depth, bits) AS n FROM levels
), shard AS (
  SELECT doc_id, bytes, h, min_by(struct_pack(depth, bits, size, n), depth) AS s
  FROM (SELECT *, row_number() OVER (PARTITION BY h, doc_id, bytes, depth) AS copy FROM sized)
  WHERE size <= 134217728 OR n = 1 OR depth = 60
  GROUP BY doc_id, bytes, h, copy
), paged AS (
  SELECT *, CASE WHEN s.size > 134217728 AND s.n > 1 THEN greatest(1, 134217728 // greatest(bytes, 1)) END AS per_page,
    row_number() OVER (PARTITION BY h) - 1 AS k
  FROM shard
)
SELECT doc_id, bytes, s.depth AS depth,
  CASE WHEN s.depth = 0 THEN '' ELSE right(lpad(bin(s.bits), 60, '0'), s.depth) END AS shard,
  coalesce(k // per_page, 0)::INT AS page,
  CASE WHEN per_page IS NULL THEN s.size
       ELSE bytes * least(per_page, s.n - (k // per_page) * per_page) END::BIGINT AS shard_bytes
FROM paged
"""

OP7 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text FROM documents
), split AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM d WHERE text <> ''
), lines AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h
  FROM split
), beside AS (
  SELECT *, lead(line) OVER o AS next_line, lead(w) OVER o AS next_w, coalesce(lag(h) OVER o, 0) AS previous
  FROM lines WINDOW o AS (PARTITION BY r ORDER BY i)
), met AS (
  SELECT *, next_line IS NOT NULL AND w < 50 AND next_w < 50 AS short,
    CASE WHEN next_line IS NOT NULL AND w < 50 AND next_w < 50 THEN
      count(*) OVER (PARTITION BY line, next_line, next_line IS NOT NULL AND w < 50 AND next_w < 50)
    WHEN next_line IS NOT NULL THEN 1 ELSE 0 END AS times
  FROM beside
), edges AS (
  SELECT *, NOT short OR 2 * times <= greatest(coalesce(lag(times) OVER o, 0), coalesce(lead(times) OVER o, 0)) AS fixed
  FROM met WINDOW o AS (PARTITION BY r ORDER BY i)
), hashed AS (
  SELECT *, NOT fixed AND NOT coalesce(lag(fixed) OVER o, TRUE) AND NOT coalesce(lead(fixed) OVER o, TRUE)
    AND line <> next_line AND ((previous % 2147483647) * 31 + h) % 2147483647 % 3 = 0 AS hashed
  FROM edges WINDOW o AS (PARTITION BY r ORDER BY i)
), ends AS (
  SELECT *, fixed OR (hashed AND NOT coalesce(lag(hashed) OVER o, FALSE)) AS ends
  FROM hashed WINDOW o AS (PARTITION BY r ORDER BY i)
), runs AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run
  FROM ends
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY r, run ORDER BY i) AS k, count(*) OVER (PARTITION BY r, run) AS size FROM runs
), placed AS (
  SELECT *, (k - 1 - (k = size AND size > 1 AND size % 16 = 1)::INT) // 16 AS part FROM numbered
), chunks AS (
  SELECT r, doc_id, run, part, count(*) AS n, sum(w) AS words, string_agg(line, chr(10) ORDER BY i) AS chunk, min(i) AS first_line
  FROM placed GROUP BY r, doc_id, run, part
), able AS (
  SELECT *, words >= 50 OR (n >= 2 AND words >= 10) AS able FROM chunks
), judged AS (
  SELECT *, able AND count(*) OVER (PARTITION BY able, chunk) > 1
    AND NOT (doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY able, chunk)
             AND row_number() OVER (PARTITION BY able, r, chunk ORDER BY first_line) = 1) AS gone
  FROM able
), by_doc AS (
  SELECT r, sum(n) AS n_lines, count(*) AS n_chunks, count(*) FILTER (WHERE gone) AS n_removed_chunks,
    coalesce(sum(n) FILTER (WHERE gone), 0) AS n_removed_lines,
    coalesce(string_agg(chunk, chr(10) ORDER BY first_line) FILTER (WHERE NOT gone), '') AS clean
  FROM judged GROUP BY r
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_chunks, 0)::BIGINT AS n_chunks,
  coalesce(n_removed_chunks, 0)::BIGINT AS n_removed_chunks, coalesce(n_removed_lines, 0)::BIGINT AS n_removed_lines,
  length(coalesce(clean, text))::BIGINT AS clean_chars, md5(coalesce(clean, text)) AS clean_md5
FROM d LEFT JOIN by_doc USING (r)
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT r, doc_id, i, array_to_string(w[i:i+12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
), hit AS (
  SELECT r, unnest(range(i, i + 13)) AS p FROM (
    SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first_doc FROM windows
  ) WHERE doc_id > first_doc
), gone AS (
  SELECT DISTINCT r, p FROM hit
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) ANTI JOIN gone USING (r, p)
  GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

ORACLE = {"op1_quality_rules": OP1, "op2_sharding": OP2, "op7_line_dedup": OP7, "op13_substring_dedup": OP13}
