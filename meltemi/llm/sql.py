"""DuckDB SQL for the queries that SQL can express, over whole tables.

The SimHash, classifier, tokenizer and packing queries have none: DuckDB lacks XXH64 and tokenizers,
and a trained model or a local search is no relation. Suffix dedup would need a 400-byte string for
every byte of the corpus, and the personal-data field is a trained model. They are tested against brute force, an exact round trip or held-out rows.
"""

WARC = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), g AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.d AS payload_digest,
    CASE WHEN g.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN g.first <> p.page_id THEN g.first END AS refers_to
FROM p LEFT JOIN g ON p.d = g.d AND p.n >= 100
"""

# A word lies in a maximal repeat of m words or more exactly if it lies in an m-word window that occurs twice.
QUALITY = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), w AS (
    SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d
), win AS (
    SELECT r, i, word,
        string_agg(word, ' ') OVER s3 AS g3, string_agg(word, ' ') OVER s8 AS g8, string_agg(word, ' ') OVER s51 AS g51,
        lead(i, 2) OVER o IS NOT NULL AS h3, lead(i, 7) OVER o IS NOT NULL AS h8, lead(i, 50) OVER o IS NOT NULL AS h51
    FROM w WINDOW o AS (PARTITION BY r ORDER BY i), s3 AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING),
        s8 AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING),
        s51 AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 50 FOLLOWING)
), twice AS (
    SELECT r, i, word,
        (h3 AND count(*) OVER (PARTITION BY r, h3, g3) > 1)::INT AS t3,
        (h8 AND count(*) OVER (PARTITION BY r, h8, g8) > 1)::INT AS t8,
        (h51 AND count(*) OVER (PARTITION BY r, h51, g51) > 1)::INT AS t51
    FROM win
), inside AS (
    SELECT r, length(word) AS n, t51,
        max(t3) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3,
        max(t8) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c8
    FROM twice
), per AS (
    SELECT r, count(*) AS n_words, sum(n) AS word_chars, sum(c3) AS n_repeat_words, sum(n * c8) AS covered_chars, max(t51) AS too_long
    FROM inside GROUP BY r
), lines AS (
    SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
    SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(covered_chars, 0) AS covered_chars, coalesce(too_long, 0) AS too_long
    FROM d LEFT JOIN per USING (r) LEFT JOIN lines USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 10 * covered_chars <= 4 * word_chars AND too_long = 0 AS kept
FROM m
"""

EMBEDDING = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND (SELECT bool_and(isfinite(x)) AND count(x) = count(*) FROM unnest(embedding) AS t(x))
        AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0
), l AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), c(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a
), s AS (SELECT a, min(b) AS component_id FROM c GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, s.component_id, e.vec_id = s.component_id AS kept
FROM embeddings e JOIN s ON s.a = e.vec_id
"""

LINES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents), l AS (
    SELECT r, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM d)
), common AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT d.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
    sha256(coalesce(string_agg(CASE WHEN c.key IS NULL THEN l.line END, chr(10) ORDER BY l.i), '')) AS kept_sha256
FROM d JOIN l USING (r) LEFT JOIN common c ON c.key = l.key GROUP BY d.r, d.doc_id
"""

LEXICAL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
    FROM documents
), docs AS (SELECT * FROM d WHERE len(ts) > 0), c AS (
    SELECT count(*)::HUGEINT AS n_docs, sum(len(ts))::HUGEINT AS n_terms FROM docs
), items AS (
    SELECT row_number() OVER () AS q, item_id,
        list_distinct([translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FOR t IN
            regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')]) AS ts FROM benchmark
), asked AS (SELECT q, unnest(ts) AS term FROM items), tf AS (
    SELECT r, term, count(*) AS tf FROM (
        SELECT r, translate(unnest(ts), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY r, term
), w AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c
), impact AS (
    SELECT tf.r, tf.term, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * len(docs.ts) * c.n_docs) // c.n_terms)))::BIGINT AS v
    FROM tf JOIN w USING (term) JOIN docs USING (r), c
), scored AS (SELECT q, r, sum(v)::BIGINT AS score FROM asked JOIN impact USING (term) GROUP BY q, r HAVING sum(v) > 0), ranked AS (
    SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
    FROM scored JOIN docs USING (r)
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (q) WHERE rank <= 10
"""

NEGATIVES = """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND (SELECT coalesce(bool_and(isfinite(x)), true) AND count(x) = count(*) FROM unnest(embedding) AS t(x))
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
    FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
    s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""

ORACLE: dict[str, str] = {
    "op3_warc": WARC, "op5_quality": QUALITY, "op7_embedding_neardup": EMBEDDING, "op9_line_dedup": LINES,
    "op12_lexical_search": LEXICAL, "op13_hard_negatives": NEGATIVES,
}
