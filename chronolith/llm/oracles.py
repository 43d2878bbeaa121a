"""DuckDB statements for the queries that SQL can express, each by brute force over its whole table."""

from __future__ import annotations

from . import licences

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Smallest node reached over links (a > b): rows (node, component), from a CTE ``links``.
COMPONENTS = """both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, other) AS (SELECT a, a FROM both_ways UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
component AS (SELECT node, min(other) AS component FROM reach GROUP BY node)"""

#: All pairs of usable vectors.
NN_DESCENT = f"""
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.vec_id > y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.95),
{COMPONENTS},
degree AS (SELECT a AS node, count(*) AS n FROM both_ways GROUP BY a)
SELECT t.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, coalesce(c.component, t.vec_id) AS component_id,
       coalesce(c.component, t.vec_id) = t.vec_id AS kept, 1.0::DOUBLE AS audit_recall
FROM embeddings t LEFT JOIN component c ON c.node = t.vec_id LEFT JOIN degree d ON d.node = t.vec_id"""

#: All pairs of documents that share a shingle, by their shingles' counts.
DART_MINHASH = f"""
WITH RECURSIVE t AS (SELECT doc_id, {WORDS} AS w FROM documents),
shingle AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM t),
counted AS (SELECT doc_id, g, count(*) AS c FROM shingle GROUP BY doc_id, g),
size AS (SELECT doc_id, sum(c) AS n FROM counted GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.c, y.c)) AS common FROM counted x JOIN counted y ON x.g = y.g AND x.doc_id > y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN size m ON m.doc_id = a JOIN size n ON n.doc_id = b WHERE common >= 0.8 * (m.n + n.n - common)),
{COMPONENTS},
same AS (SELECT array_to_string(w, ' ') AS s, min(doc_id) AS first_id FROM t WHERE len(w) > 0 GROUP BY 1)
SELECT t.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, coalesce(s.first_id, t.doc_id) AS copy_of, coalesce(c.component, t.doc_id) AS component_id,
       coalesce(c.component, t.doc_id) = t.doc_id AS kept
FROM t LEFT JOIN size z ON z.doc_id = t.doc_id LEFT JOIN component c ON c.node = t.doc_id
LEFT JOIN same s ON len(t.w) > 0 AND s.s = array_to_string(t.w, ' ')"""

#: Every window of every document, by its words.
REPEATED_PASSAGES = f"""
WITH t AS (SELECT doc_id, {WORDS} AS w FROM documents),
spots AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM spots),
firsts AS (SELECT s, min(doc_id) AS lo FROM windows GROUP BY s),
gone AS (SELECT DISTINCT x.doc_id, unnest(range(x.i, x.i + 13)) AS k FROM windows x JOIN firsts f ON f.s = x.s AND f.lo < x.doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM t),
rest AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.k) AS kept, count(*) AS n FROM words x
    LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.k = x.k WHERE g.k IS NULL GROUP BY x.doc_id)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, (len(t.w) - coalesce(r.n, 0))::BIGINT AS n_removed, sha256(coalesce(r.kept, '')) AS kept_sha256
FROM t LEFT JOIN rest r ON r.doc_id = t.doc_id"""

ORACLE: dict[str, str] = {
    "op2_nn_descent": NN_DESCENT,
    "op4_dart_minhash": DART_MINHASH,
    "op8_repeated_passages": REPEATED_PASSAGES,
    "op9_licences": licences.oracle(),
}
