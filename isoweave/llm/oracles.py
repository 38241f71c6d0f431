"""SQL (DuckDB) of the training-data queries that SQL can express, over the same tables."""

#: Every 100-byte string (as hex digits) with its places; all but the first place of each are removed with what they cover.
SUFFIXES = """
WITH texts AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h
    FROM (SELECT DISTINCT doc_id, text FROM documents)
), starts AS (
    SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM texts WHERE n >= 100)
), firsts AS (
    SELECT s, min((doc_id, p)) AS first, count(*) AS c FROM starts GROUP BY s HAVING count(*) > 1
), gone AS (
    SELECT doc_id, p FROM starts JOIN firsts USING (s) WHERE (doc_id, p) <> first
), bytes AS (
    SELECT t.doc_id, b.p, substr(t.h, 2 * b.p + 1, 2) AS x, b.p - max(g.p) OVER (PARTITION BY t.doc_id ORDER BY b.p) < 100 AS cut
    FROM texts t, LATERAL (SELECT unnest(range(0, t.n)) AS p) b LEFT JOIN gone g ON g.doc_id = t.doc_id AND g.p = b.p
    WHERE t.doc_id IN (SELECT doc_id FROM gone)
), marked AS (
    SELECT *, coalesce(cut, false) AS c, lag(coalesce(cut, false), 1, false) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM bytes
), cuts AS (
    SELECT doc_id, count(*) FILTER (c) AS n_removed, count(*) FILTER (c AND NOT before) AS n_spans, coalesce(string_agg(x, '' ORDER BY p) FILTER (NOT c), '') AS kept
    FROM marked GROUP BY doc_id
)
SELECT t.doc_id, t.n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, t.h))) AS kept_sha256
FROM texts t LEFT JOIN cuts USING (doc_id)
"""

_VECTORS = """
vectors AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v,
        vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fit
    FROM embeddings
)
"""

#: Links of all pairs, and what can be reached by them.
GRAPH = f"""
WITH RECURSIVE {_VECTORS}, links AS (
    SELECT a.r AS a, b.r AS b FROM vectors a JOIN vectors b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.fit AND b.fit AND list_cosine_similarity(a.v, b.v) >= 0.95
), reached(a, b) AS (
    SELECT r, r FROM vectors UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), counts AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
), lowest AS (
    SELECT reached.a, min(v.vec_id) AS low FROM reached JOIN vectors v ON v.r = reached.b GROUP BY reached.a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, low::BIGINT AS component_id, vec_id = low AS kept
FROM vectors LEFT JOIN counts ON counts.a = r JOIN lowest ON lowest.a = r
"""

#: Every candidate's cosine, ranked.
ADDITIVE = f"""
WITH {_VECTORS}, scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
    FROM vectors q JOIN vectors c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.fit AND c.fit AND q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY round(score, 12) DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

#: Every document's failures, every order's first failing step, counted by step; the Shapley column sums what a filter removes over all rows.
AUDIT = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents
), words AS (
    SELECT *, list_filter(string_split_regex(t, '[ \t-\r]+'), lambda w: w <> '') AS w FROM docs
), lowest AS (
    SELECT t, min(doc_id) AS low FROM docs GROUP BY t
), said AS (
    SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), fails AS (
    SELECT part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > low, false)::INT AS mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM words JOIN lowest USING (t) LEFT JOIN said USING (doc_id)
), masks AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY ALL
), letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)), orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
    SELECT filter_order, s::INT AS step, f, bit, coalesce((SELECT sum(l2.bit) FROM letters l2 WHERE contains(substr(filter_order, 1, s - 1), l2.f)), 0)::INT AS earlier
    FROM orders, range(1, 6) r(s), letters WHERE f = substr(filter_order, s, 1)
), counted AS (
    SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (mask & (earlier + bit) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (mask & earlier <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
    FROM masks, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM counted
"""
