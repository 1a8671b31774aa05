"""SQL texts that give the rows of the queries that SQL can express."""

# Each group of five bytes of the digest is a number below 2 ** 40, written as eight base32 digits.
WARC = r"""
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h
    FROM pages
), r AS (
    SELECT *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((('0x' || substr(h, 10 * (i // 8) + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1)
            FOR i IN range(32)], '') AS payload_digest,
        max(page_id) OVER (PARTITION BY h) AS top
    FROM p
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> top THEN top END AS refers_to
FROM r
"""

# Targets by the closed form of the capped shares, then every quotient of every block listed and the
# highest taken, then the blocks laid over the documents in their seeded order.
MIX_SOURCES = r"""
WITH d AS (
    SELECT doc_id, coalesce('=' || source, '~') AS k,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS o
    FROM documents
), s0 AS (
    SELECT k, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY k) - 1 AS place FROM d GROUP BY k
), s1 AS (
    SELECT *, 3 * s AS cap, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s0
), s2 AS (
    SELECT *, (sum(s) OVER () - coalesce(sum(cap) OVER before, 0))::BIGINT AS l,
        (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::BIGINT AS ws,
        row_number() OVER (ORDER BY cap::DOUBLE / w, k) AS r
    FROM s1
    WINDOW before AS (ORDER BY cap::DOUBLE / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), lev AS (
    SELECT min_by(l::DOUBLE / ws, r) AS lev FROM s2 WHERE l * w <= cap * ws
), t AS (
    SELECT k, s, least(cap::DOUBLE, lev * w) AS target FROM s2, lev
), b AS (
    SELECT greatest(1, least(2048, floor(min(target) FILTER (target > 0) / 100)))::BIGINT AS block,
        sum(s)::BIGINT AS total FROM t
), quotients AS (
    SELECT k, target / (2 * seat + 1) AS q
    FROM t, b, unnest(generate_series(0, (2 + target / block)::BIGINT + 50)) AS u(seat) WHERE s > 0
), won AS (
    SELECT k, count(*) AS seats FROM (
        SELECT k, row_number() OVER (ORDER BY q DESC, k) AS r FROM quotients
    ), b WHERE r <= round(total::DOUBLE / block)::BIGINT GROUP BY k
), blocks AS (
    SELECT t.k, s, target, coalesce(seats, 0) AS seats, greatest(1, round(s::DOUBLE / block)::BIGINT) AS n
    FROM t CROSS JOIN b LEFT JOIN won ON won.k = t.k
), got AS (
    SELECT k, s, target,
        least(3 * s, (seats // n) * s + floor(((seats % n) * s)::DOUBLE / n)::BIGINT) AS taken FROM blocks
), placed AS (
    SELECT doc_id, k, size, coalesce(sum(size) OVER (PARTITION BY k ORDER BY o, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d
)
SELECT doc_id, size, s AS source_size, target,
    CASE WHEN s = 0 THEN 0
        ELSE (taken // s) * size + greatest(0, least(size, taken % s - start)) END::BIGINT AS taken
FROM placed JOIN got USING (k)
"""

EMBEDDING_DEDUP = r"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.vec_id AS u, b.vec_id AS v
    FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93
), reach AS (
    SELECT vec_id AS u, vec_id AS v FROM embeddings
    UNION
    SELECT reach.u, link.v FROM reach JOIN link ON link.u = reach.v
), least AS (
    SELECT u, min(v) AS component_id FROM reach GROUP BY u
), degree AS (
    SELECT u, count(*) AS n FROM link GROUP BY u
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.u = vec_id LEFT JOIN degree ON degree.u = vec_id
"""

# Every phrase of one to five words is listed and counted.
COLLOCATIONS = r"""
WITH w AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), f AS (
    SELECT lang, len, array_to_string(w[i : i + len - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, len, unnest(generate_series(1, len(w) - len + 1)) AS i
        FROM w, (SELECT unnest(generate_series(1, 5)) AS len) WHERE len(w) >= len)
    GROUP BY ALL
), total AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len = 1 GROUP BY lang
), c AS (
    SELECT lang, len, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE len > 1 AND f >= 100
), cut AS (
    SELECT c.lang, c.len, c.phrase, a, n, k, x.f AS l, y.f AS r,
        ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM (SELECT *, unnest(generate_series(1, len - 1)) AS k FROM c) c
        JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
        JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 : c.len], ' ')
        JOIN total ON total.lang = c.lang
), low AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, max(a) AS whole
    FROM (SELECT *, unnest(generate_series(1, len - size + 1)) AS i
        FROM (SELECT *, unnest(generate_series(2, len - 1)) AS size FROM c WHERE len > 2)) GROUP BY ALL
), kept AS (
    SELECT low.* FROM low LEFT JOIN inside USING (lang, phrase) WHERE whole IS NULL OR 100 * whole < 100 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
) WHERE rank <= 2000
"""
