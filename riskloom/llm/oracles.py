"""SQL that the queries on training text are checked against, where SQL can express them. The others
hold trained models, a tokenizer or a hash that SQL engines do not share; tests compare them with
plain versions."""

from __future__ import annotations

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{_CAPITALS}', '{_CAPITALS.lower()}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


#: Rows that take part, with their components as whole numbers.
_VECTORS = """
        v AS (SELECT *, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
              FROM embeddings
              WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""
_SCORE = "CAST(list_inner_product(a.parts, c.parts) AS BIGINT)"

ORACLES: dict[str, str] = {
    "op12_pivot_topk": f"""
        WITH {_VECTORS},
        scored AS (
            SELECT a.vec_id AS query_id, c.vec_id, {_SCORE} AS score
            FROM v AS a JOIN v AS c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
        SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5""",
    "op13_hard_negatives": f"""
        WITH {_VECTORS},
        l AS (SELECT vec_id, parts, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS class
              FROM v WHERE label IS NOT NULL),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.class = c.class AS same, {_SCORE} AS score
            FROM l AS a JOIN l AS c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        ranked AS (
            SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
            FROM positives JOIN scored USING (anchor_id)
            WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
        SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM ranked WHERE place <= 3""",
    "op3_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
        b AS (SELECT item_id, w, least(10, len(w)) AS n
              FROM (SELECT item_id, {_words("text")} AS w FROM benchmark) WHERE len(w) > 0),
        windows AS (
            SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS words
            FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS k FROM b)),
        places AS (
            SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS words
            FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS k
                  FROM d CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
        found AS (SELECT doc_id, k, n, item_id FROM places JOIN windows USING (n, words)),
        hit AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS place FROM found)
            GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
            GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
