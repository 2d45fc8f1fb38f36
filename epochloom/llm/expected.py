"""SQL twins of the queries that SQL can express."""

OP1 = """
WITH RECURSIVE link AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM embeddings a JOIN embeddings b
      ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.95
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings
  UNION
    SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON least.a = e.vec_id LEFT JOIN degree ON degree.a = e.vec_id
"""

OP2 = r"""
WITH plain AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), ranked AS (
    SELECT *, row_number() OVER best AS place, first_value(doc_id) OVER best AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM plain WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

OP4 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingle AS MATERIALIZED (
    SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM words WHERE len(w) > 0)
), size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS MATERIALIZED (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
    ) JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
    WHERE 100 * common >= 80 * (p.n + q.n - common)
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents
  UNION
    SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id, d.doc_id = min(b) AS kept
FROM documents d JOIN reach ON reach.a = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP11 = """
WITH whole AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""

OP8 = r"""
WITH d AS MATERIALIZED (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), starts AS MATERIALIZED (
    SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT doc_id, h, unnest(range(n - 199)) AS i FROM d)
), often AS (SELECT m FROM starts GROUP BY m HAVING count(*) > 1),
hit AS (
    SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -201) + 200 AS opens
    FROM starts JOIN often USING (m)
), run AS (
    SELECT doc_id, min(i) AS a, max(i) + 200 AS b
    FROM (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM hit) GROUP BY doc_id, r
), kept AS (
    SELECT d.doc_id, x.a, substr(h, 2 * x.a + 1, 2 * (x.b - x.a)) AS piece
    FROM d JOIN (
        SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM run
        UNION ALL SELECT doc_id, 0, min(a) FROM run GROUP BY doc_id
    ) x0 USING (doc_id), LATERAL (SELECT x0.a AS a, coalesce(x0.b, d.n) AS b) x
), rest AS (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS h FROM kept GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM run GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(rest.h, d.h))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN rest USING (doc_id)
"""

OP12 = r"""
WITH RECURSIVE bits(code, step, c) AS (
    SELECT code, 0, code::BIGINT FROM range(256) AS t(code)
  UNION ALL
    SELECT code, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8
), crc AS MATERIALIZED (SELECT list(c ORDER BY code) AS t FROM bits WHERE step = 8),
words AS MATERIALIZED (
    SELECT target, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT false AS target, doc_id, text FROM documents UNION ALL SELECT true, item_id, text FROM benchmark)
), grams AS MATERIALIZED (
    SELECT target, doc_id, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g, count(*) AS k
    FROM (SELECT target, doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, range(1, 4) AS t(n))
    GROUP BY ALL
), named AS MATERIALIZED (
    SELECT g, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(g)), '..'), lambda x: ('0x' || x)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])
    )) % 10000 AS bucket
    FROM (SELECT DISTINCT g FROM grams), crc
), sums AS MATERIALIZED (
    SELECT bucket, coalesce(sum(k) FILTER (WHERE NOT target), 0)::DOUBLE AS s, coalesce(sum(k) FILTER (WHERE target), 0)::DOUBLE AS t
    FROM grams JOIN named USING (g) GROUP BY bucket
), gains AS MATERIALIZED (
    SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM sums
), weights AS (
    SELECT doc_id, sum(k) AS n_features, sum(k * gain) AS weight
    FROM grams JOIN named USING (g) JOIN gains USING (bucket) WHERE NOT target GROUP BY doc_id
), scored AS (
    SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, len(w) >= 20 AS able,
           coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
               (('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (doc_id) WHERE NOT target
), placed AS (
    SELECT *, row_number() OVER (ORDER BY able DESC, score DESC, doc_id) AS place, count(*) FILTER (WHERE able) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * n // 100 THEN place END AS rank FROM placed
"""

EXPECTED = {
    "op1_lattice_dedup": OP1,
    "op2_exact_dedup": OP2,
    "op4_superminhash": OP4,
    "op8_suffix_dedup": OP8,
    "op11_bit_sliced_top_k": OP11,
    "op12_importance_resampling": OP12,
}
