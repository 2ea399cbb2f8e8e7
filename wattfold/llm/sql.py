"""SQL texts for DuckDB of the queries that SQL can state over whole tables.

Words are runs of anything but blanks (``[^\\x20\\x09-\\x0D]+``). The texts compare all pairs where an operator must not, so they
are for tables of test size.
"""

_WORD = r"'[^\x20\x09-\x0D]+'"

#: Usable vectors of the embeddings: not null, not zero, nothing null or non-finite in them.
_USABLE = """
    usable AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    )"""

#: Smallest id that links reach from each id, by walking the links of ``links(a, b)``, which hold both directions.
_REACH = """
    reach(id, root) AS (
        SELECT a, a FROM links UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id
    ),
    roots AS (SELECT id, MIN(root) AS root FROM reach GROUP BY id)"""

WINDOW_DEDUP = f"""
    WITH d AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), {_WORD}) AS w FROM documents),
    windows AS (
        SELECT doc_id, s, list_aggregate(w[s:s + 19], 'string_agg', ' ') AS k FROM (SELECT doc_id, w, UNNEST(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20) x
    ),
    later AS (SELECT doc_id, s FROM (SELECT doc_id, s, ROW_NUMBER() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM windows) x WHERE r > 1),
    gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, UNNEST(range(s, s + 20)) AS p FROM later) x GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(len(ps), 0) AS BIGINT) AS n_removed,
           sha256(COALESCE(list_aggregate(CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, 'string_agg', ' '), '')) AS kept_sha256
    FROM d LEFT JOIN gone USING (doc_id)"""

PQ_DEDUP = f"""
    WITH RECURSIVE {_USABLE},
    links(a, b) AS (
        SELECT x.vec_id, y.vec_id FROM usable x JOIN usable y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
        WHERE list_cosine_similarity(x.v, y.v) >= 0.9
    ), {_REACH},
    counts AS (SELECT a AS id, COUNT(DISTINCT b) AS n FROM links GROUP BY a)
    SELECT e.vec_id, CAST(COALESCE(c.n, 0) AS BIGINT) AS n_links, COALESCE(r.root, e.vec_id) AS component_id, COALESCE(r.root, e.vec_id) = e.vec_id AS kept
    FROM embeddings e LEFT JOIN counts c ON c.id = e.vec_id LEFT JOIN roots r ON r.id = e.vec_id"""

JACCARD_JOIN = f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS w FROM documents
    ),
    sets AS (
        SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [list_aggregate(w, 'string_agg', ' ')]
               ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM d
    ),
    parts AS (SELECT doc_id, len(s) AS n, UNNEST(s) AS g FROM sets),
    met AS (
        SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, COUNT(*) AS shared FROM parts x JOIN parts y ON x.g = y.g AND x.doc_id <> y.doc_id
        WHERE 10 * x.n >= 9 * y.n AND 10 * y.n >= 9 * x.n GROUP BY 1, 2, 3, 4
    ),
    links(a, b) AS (SELECT a, b FROM met WHERE 100 * shared >= 90 * (na + nb - shared)), {_REACH}
    SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, COALESCE(root, sets.doc_id) AS component_id FROM sets LEFT JOIN roots ON roots.id = sets.doc_id"""

VANTAGE_SEARCH = f"""
    WITH {_USABLE},
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
        FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
    )
    SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
    ) x WHERE r <= 5"""

HARD_NEGATIVES = """
    WITH usable AS (
        SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
               list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    ),
    scored AS (
        SELECT a.vec_id AS anchor, c.vec_id AS other, a.label = c.label AS same, CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
        FROM usable a JOIN usable c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
    ),
    positives AS (
        SELECT anchor, other, score FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY anchor ORDER BY score DESC, other) AS r FROM scored WHERE same
        ) x WHERE r <= 5
    ),
    mined AS (
        SELECT p.anchor, p.other AS positive, n.other AS negative, p.score AS ps, n.score AS ns,
               ROW_NUMBER() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) AS r
        FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
    )
    SELECT anchor AS anchor_id, positive AS positive_id, CAST(r AS INTEGER) AS rank, negative AS negative_id, ps AS positive_score, ns AS negative_score FROM mined WHERE r <= 10"""

ORACLE: dict[str, str] = {
    "op3_window_dedup": WINDOW_DEDUP,
    "op9_pq_dedup": PQ_DEDUP,
    "op10_jaccard_join": JACCARD_JOIN,
    "op13_hard_negatives": HARD_NEGATIVES,
}
#: Equal but for the last bits of the score, which depend on the order in which a cosine's terms are added; for tests, to nine digits.
CLOSE: dict[str, str] = {"op11_vantage_search": VANTAGE_SEARCH}
