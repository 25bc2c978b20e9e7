"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {
    "op2_near_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
                 FROM words),
        classes AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY ALL),
        items AS (SELECT rep, len(s) AS n, unnest(s) AS item FROM classes),
        links AS (SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.item = b.item AND a.rep < b.rep
                  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (SELECT rep AS node, rep AS other FROM classes
                  UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
        component AS (SELECT node, min(other) AS c FROM reach GROUP BY node)
        SELECT t.doc_id, len(t.s)::BIGINT AS n_shingles, coalesce(c.c, t.doc_id) AS component_id,
               coalesce(c.c, t.doc_id) = t.doc_id AS kept
        FROM sets t LEFT JOIN classes k ON len(t.s) > 0 AND list_sort(t.s) = k.s
        LEFT JOIN component c ON c.node = k.rep""",
    "op4_exact_dedup": """
        WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                   'abcdefghijklmnopqrstuvwxyz')) AS text_sha256,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)""",
    # the crc32 is taken bit by bit; equal words at a distance of p are joined into stretches
    "op11_runs": r"""
        WITH coded AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, CASE WHEN doc_id IS NULL THEN 1 ELSE
                 xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || [ascii(c) + 4294967296 FOR c IN string_split(doc_id::VARCHAR, '')], lambda crc, c:
                     list_reduce([xor(crc, c - 4294967296)] || [0::BIGINT FOR _ IN range(8)], lambda x, y:
                         CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))) END AS h FROM documents),
        sized AS (SELECT row_number() OVER () AS row, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS turned, h // 10 AS g FROM coded),
        cut AS (SELECT *, CASE WHEN turned THEN g % n END AS a FROM sized),
        timed AS (SELECT *, CASE WHEN turned THEN 1 + (n - a) // (3 + g % 8) END AS q FROM cut),
        texts AS (SELECT row, doc_id, n, CASE WHEN turned THEN [w[CASE WHEN i >= a THEN a + (i - a) % q ELSE i END + 1] FOR i IN range(n)] ELSE w END AS w
                  FROM timed),
        words AS (SELECT row, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
        equal AS (SELECT row, x.i, y.i - x.i AS p FROM words x JOIN words y USING (row, word) WHERE x.i < y.i AND 2 * (y.i - x.i) <= x.n),
        stretches AS (SELECT row, p, min(i) AS start, count(*) + p AS length
                      FROM (SELECT *, i - row_number() OVER (PARTITION BY row, p ORDER BY i) AS island FROM equal)
                      GROUP BY row, p, island HAVING count(*) >= p AND count(*) + p >= 12),
        runs AS (SELECT row, start, length, min(p) AS period FROM stretches GROUP BY row, start, length),
        gone AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
        listed AS (SELECT row, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
                          max((length, -start, -period)) AS best FROM runs GROUP BY row),
        stay AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS body FROM words ANTI JOIN gone USING (row, i) GROUP BY row)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best[2] AS start, best[1] AS length, -best[3] AS period,
               1000 * best[1] // -best[3] AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
        FROM texts LEFT JOIN listed USING (row) LEFT JOIN stay USING (row)""",
    # codebooks hold one row for each (part, entry); parts are 0-15, entries 0-63
    "op12_vector_codes": """
        WITH kept AS (SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
                      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (SELECT vec_id, label, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x FROM kept, range(16) AS r(p)),
        seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64),
        book0 AS (SELECT p, e, x FROM parts JOIN seeds USING (vec_id)),
        near1 AS (SELECT vec_id, p, any_value(t.x) AS x, arg_min(e, (list_sum([(a[1] - a[2]) ** 2 FOR a IN list_zip(t.x, b.x)]), e)) AS e
                  FROM parts t JOIN book0 b USING (p) GROUP BY vec_id, p),
        mean1 AS (SELECT p, e, list(m ORDER BY i) AS x FROM (
                      SELECT p, e, i, floor(sum(x[i]) / count(*))::BIGINT AS m FROM near1, range(1, len(x) + 1) AS r(i) GROUP BY p, e, i)
                  GROUP BY p, e),
        book1 AS (SELECT p, e, coalesce(m.x, b.x) AS x FROM book0 b LEFT JOIN mean1 m USING (p, e)),
        near2 AS (SELECT vec_id, p, any_value(t.x) AS x, arg_min(e, (list_sum([(a[1] - a[2]) ** 2 FOR a IN list_zip(t.x, b.x)]), e)) AS e
                  FROM parts t JOIN book1 b USING (p) GROUP BY vec_id, p),
        mean2 AS (SELECT p, e, list(m ORDER BY i) AS x FROM (
                      SELECT p, e, i, floor(sum(x[i]) / count(*))::BIGINT AS m FROM near2, range(1, len(x) + 1) AS r(i) GROUP BY p, e, i)
                  GROUP BY p, e),
        book2 AS (SELECT p, e, coalesce(m.x, b.x) AS x FROM book1 b LEFT JOIN mean2 m USING (p, e)),
        last AS (SELECT vec_id, any_value(label) AS label, p, min((list_sum([(a[1] - a[2]) ** 2 FOR a IN list_zip(t.x, b.x)]), e)) AS best
                 FROM parts t JOIN book2 b USING (p) GROUP BY vec_id, p),
        coded AS (SELECT vec_id, any_value(label) AS label, string_agg(lower(lpad(hex(best[2]), 2, '0')), '' ORDER BY p) AS code,
                         sum(best[1])::BIGINT AS error FROM last GROUP BY vec_id)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
        FROM coded""",
    "op13_warc": """
        WITH t AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        u AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
                     max(page_id) OVER (PARTITION BY payload) AS first FROM t),
        v AS (SELECT *, payload_bytes >= 1000 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM u)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first END AS refers_to, NULL::VARCHAR AS error FROM v""",
}
