"""DuckDB SQL with the rows of the queries, where SQL can express them."""

from __future__ import annotations

from stepweave.llm.mixing import mix_parameters_sql

_EDGES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = f"regexp_extract_all(coalesce(text, ''), '[^' || {_EDGES} || ']+')"

OP2 = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
windows AS (
    SELECT doc_id, unnest(range(1, len(words) - 33)) AS start, words FROM docs WHERE len(words) >= 35
), hashed AS (
    SELECT doc_id, start, md5(array_to_string(list_slice(words, start, start + 34), ' ')) AS hash
    FROM windows
), twice AS (SELECT hash FROM hashed GROUP BY hash HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(start, start + 35)) AS position
    FROM hashed JOIN twice USING (hash)
), out AS (SELECT doc_id, list(position) AS positions FROM gone GROUP BY doc_id),
told AS (SELECT doc_id, words, coalesce(positions, []) AS positions FROM docs LEFT JOIN out USING (doc_id)),
kept AS (
    SELECT doc_id, len(words) AS n, len(positions) AS removed, words, map_from_entries(
        list_transform(positions, lambda p: struct_pack(k := p, v := true))) AS gone FROM told
)
SELECT doc_id, n::BIGINT AS n_words, removed::BIGINT AS n_removed,
    sha256(array_to_string(
        list_transform(list_filter(range(1, n + 1), lambda i: NOT map_contains(gone, i)), lambda i: words[i]),
        ' ')) AS kept_sha256
FROM kept
"""

OP5 = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), ok AS (
    SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
    SELECT vec_id AS start, vec_id AS node FROM v
    UNION SELECT start, b FROM reach JOIN links ON node = a
), least AS (SELECT start, min(node) AS component_id FROM reach GROUP BY start),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON vec_id = start LEFT JOIN counts ON a = vec_id
"""

OP6 = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^' || {_EDGES} || ']+') AS words FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, md5(array_to_string(list_slice(words, start, start + 4), ' ')) AS s
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS start FROM docs
          WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach AS (
    SELECT doc_id AS start, doc_id AS node FROM docs
    UNION SELECT start, b FROM reach JOIN links ON node = a
), least AS (SELECT start, min(node) AS component_id FROM reach GROUP BY start)
SELECT docs.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id,
    docs.doc_id = component_id AS kept
FROM docs JOIN least ON start = docs.doc_id LEFT JOIN sizes ON sizes.doc_id = docs.doc_id
"""

OP7 = f"""
WITH named AS (
    SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(text) AS digest,
        coalesce(doc_id::VARCHAR, md5(text), '') AS name FROM documents
), docs AS (
    SELECT doc_id, source, size, name || CASE WHEN number > 0 THEN chr(31) || number ELSE '' END AS name
    FROM (SELECT *, row_number() OVER (PARTITION BY source, name ORDER BY size, digest NULLS FIRST) - 1
        AS number FROM named)
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, 3.0 * sum(size)::DOUBLE AS most,
        [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
    FROM docs GROUP BY source
), levels AS (
    SELECT *, (sum(source_size) OVER ()
            - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources WINDOW o AS (ORDER BY most / weight, source NULLS LAST)
), plan AS (
    SELECT source, source_size,
        least(most, weight * max(level) FILTER (WHERE level * weight <= most) OVER ()) AS target
    FROM levels
), copies AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS c FROM plan
), ranked AS (
    SELECT d.*, source_size, target, floor(c) AS whole, c - floor(c) AS fraction,
        target - floor(c) * source_size AS missing, {mix_parameters_sql("mix")} AS u
    FROM docs d JOIN copies p ON d.source IS NOT DISTINCT FROM p.source
), placed AS (
    SELECT *, (u / (1 - u)) / nullif(fraction / (1 - fraction), 0) AS rank FROM ranked
), running AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, name, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS taken_so_far FROM placed
), firsts AS (
    SELECT *, fraction > 0 AND taken_so_far <= missing AS first,
        missing - coalesce(max(taken_so_far) FILTER (WHERE taken_so_far <= missing)
            OVER (PARTITION BY source), 0) AS gap FROM running
), fills AS (
    SELECT *, row_number() OVER (PARTITION BY source, fits ORDER BY size DESC, rank, name DESC) AS place
    FROM (SELECT *, NOT first AND fraction > 0 AND size > 0 AND size <= gap AS fits FROM firsts)
)
SELECT doc_id, size, source_size, target,
    ((whole + CASE WHEN first OR (fits AND place = 1) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM fills
"""

OP8 = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
    SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex FROM p
), bits AS (
    SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: 
        lpad(bin(strpos('0123456789abcdef', hex[i]) - 1), 4, '0')), 'string_agg', '') AS b FROM d
), named AS (
    SELECT page_id, n, list_aggregate(list_transform(range(0, 32), lambda i: 
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(0, 5), lambda j: 
            CASE WHEN b[i * 5 + j + 1] = '1' THEN 1 << (4 - j) ELSE 0 END))::INT]),
        'string_agg', '') AS digest FROM bits
), last AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS response FROM named)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
    nullif(response, page_id) AS refers_to
FROM last
"""

OP9 = f"""
WITH lines AS (
    SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS position
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, {_EDGES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), common AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(common.key)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE common.key IS NULL),
        '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id
"""



_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP11 = f"""
WITH docs AS (
    SELECT doc_id, {_TERMS} AS terms FROM documents
), words AS (
    SELECT doc_id, term, count(*) AS tf
    FROM (SELECT doc_id, unnest(terms) AS term FROM docs) GROUP BY ALL
), totals AS (
    SELECT count(*) AS n_docs, sum(len(terms)) AS n_terms FROM docs WHERE len(terms) > 0
), lengths AS (
    SELECT doc_id, (10 + (90 * len(terms) * n_docs) // n_terms)::BIGINT AS m
    FROM docs, totals WHERE len(terms) > 0
), asked AS (
    SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM words, totals GROUP BY term, n_docs
), scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN words USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id)
    GROUP BY item_id, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank,
    doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


def _op12_round(number: int) -> str:
    """Assignments ``a<number>`` to book ``number``, and the book after it."""
    return f"""
a{number} AS MATERIALIZED (
    SELECT vec_id, p, x, min(list_sum(list_transform(range(1, len(x) + 1),
        lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT * 64 + entry) AS best
    FROM parts JOIN book{number} USING (p) GROUP BY vec_id, p, x
), s{number} AS (
    SELECT p, entry, list(m ORDER BY i) AS c FROM (
        SELECT p, best % 64 AS entry, i, floor_mean(sum(x[i])::BIGINT, count(*)) AS m
        FROM a{number}, range(1, (SELECT max(len(x)) FROM parts) + 1) t(i) GROUP BY ALL) GROUP BY p, entry
), book{number + 1} AS MATERIALIZED (
    SELECT p, entry, coalesce(s{number}.c, book{number}.c) AS c
    FROM book{number} LEFT JOIN s{number} USING (p, entry)
)""".replace("floor_mean(sum(x[i])::BIGINT, count(*))",
             "((sum(x[i])::BIGINT - ((sum(x[i])::BIGINT % count(*)) + count(*)) % count(*)) // count(*))")


OP12 = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) AS x
    FROM kept, range(16) t(p)
), book0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS entry, x AS c
    FROM parts QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 64
),{_op12_round(0)},{_op12_round(1)},{_op12_round(2)},
codes AS (
    SELECT vec_id, string_agg(format('{{:02x}}', best % 64), '' ORDER BY p) AS code,
        sum(best // 64)::BIGINT AS error FROM a2 GROUP BY vec_id
), books AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, entry)) AS codebooks_sha256
    FROM book2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    codebooks_sha256
FROM kept JOIN codes USING (vec_id), books
"""

ORACLES = {
    "op2_substring_dedup": OP2,
    "op5_embedding_dedup": OP5,
    "op6_minhash_dedup": OP6,
    "op7_mixing": OP7,
    "op8_warc": OP8,
    "op9_line_dedup": OP9,
    "op11_lexical_search": OP11,
    "op12_vector_codes": OP12,
}
