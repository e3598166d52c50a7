"""What SQL can say of the training-data queries, from the tables alone."""

# Equal payloads of 100 bytes or more are revisits of the one with the smallest page_id.
WARC = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS d,
                      octet_length(encode(coalesce(html, ''))) AS n FROM pages),
    f AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d)
    SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
           CASE WHEN page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
    FROM p LEFT JOIN f ON p.d = f.d"""

# Repeated windows by counting them, the cascade's rules as plain conditions.
QUALITY_RULES = r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
    split AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
    w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM split),
    win AS (
      SELECT r, i, word, lead(word) OVER o AS word2, lead(word, 7) OVER o AS word8,
             concat_ws(' ', word, lead(word) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o,
                       lead(word, 5) OVER o, lead(word, 6) OVER o, lead(word, 7) OVER o) AS g
      FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
    again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win WHERE word8 IS NOT NULL) WHERE c > 1),
    covered AS (SELECT r, count(DISTINCT i + s) AS n_repeat_words FROM again, range(8) x(s) GROUP BY r),
    words AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars,
                     count(*) FILTER (WHERE NOT regexp_matches(word, '\p{L}')) AS letterless,
                     count(*) FILTER (WHERE word = word2) AS stutters FROM win GROUP BY r),
    top AS (SELECT r, max(c) AS top FROM (SELECT r, count(*) AS c FROM w GROUP BY r, word) GROUP BY r),
    parts AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
    lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
                     count(*) FILTER (WHERE regexp_matches(line, '(\.\.\.|…)\s*$')) AS ellipses,
                     count(*) FILTER (WHERE regexp_matches(line, '^\s*(- |\* |•)')) AS bullets
              FROM parts WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
    f AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                 letterless, stutters, top, n_lines, ellipses, bullets
          FROM d LEFT JOIN words USING (r) LEFT JOIN covered USING (r) LEFT JOIN top USING (r) LEFT JOIN lines USING (r)),
    b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
           CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
           CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
           NOT base_failed AND word_chars BETWEEN 2 * n_words AND 12 * n_words AND 10 * n_symbols <= n_words
             AND 2 * n_dup_lines <= n_lines AND 10 * top <= 3 * n_words AND 10 * letterless <= 3 * n_words
             AND 10 * ellipses <= 3 * n_lines AND 10 * bullets <= 9 * n_lines AND 10 * stutters <= 2 * n_words AS kept
    FROM b"""

# Every 400-byte window (800 hex digits) is hashed and counted; covered windows are islands.
SUFFIX_DEDUP = r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
    s AS (SELECT r, unnest(range(length(h) // 2 - 399)) AS i, h FROM d WHERE length(h) >= 800),
    k AS (SELECT r, i, hash(substr(h, 2 * i + 1, 800)) AS g FROM s),
    again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS c FROM k) WHERE c > 1),
    steps AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 400 THEN 0 ELSE 1 END AS opens FROM again),
    runs AS (SELECT r, n, min(i) AS a, max(i) + 400 AS z
             FROM (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS n FROM steps) GROUP BY r, n),
    gaps AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS b FROM runs),
    cut AS (SELECT r, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS z,
                   string_agg(substr(h, 2 * b + 1, 2 * (a - b)), '' ORDER BY a) AS front
            FROM gaps JOIN d USING (r) GROUP BY r)
    SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
           sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(z, 0) + 1))) AS kept_sha256
    FROM d LEFT JOIN cut USING (r)"""
