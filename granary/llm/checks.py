"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

import string

#: ASCII letters in lower case, all other characters as they are.
LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

DECONTAMINATE = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), i AS (
    SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_starts AS (
    SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
    FROM i WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS phrase FROM item_starts
), starts AS (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s
    FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
), found AS (
    SELECT r, s, n, item_id FROM (SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS phrase FROM starts)
    JOIN windows USING (n, phrase)
), hit AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM found) GROUP BY r
), listed AS (
    SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""

DIVERGENCE = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), tokens AS (
    SELECT r, lang, source, unnest(w) AS term FROM d
), kept AS (
    SELECT lang, term, count(*) AS n FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), sizes AS (
    SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), held AS (
    SELECT t.lang, t.source, t.term, count(*) AS n FROM tokens t JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
    SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN held USING (lang, source) LEFT JOIN sizes USING (lang) GROUP BY lang, source
), p AS (
    SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n, k.n AS n_lang,
           1 + (CAST(1000000000 AS HUGEINT) * (coalesce(h.n, 0) + 1)) // (g.total + g.v) AS p
    FROM groups g JOIN kept k USING (lang) LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
), summed AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), term AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM (
        SELECT p.*, 1 + (CAST(1000000000 AS HUGEINT) * (n_lang + 1)) // (s.total + s.v) AS q FROM p JOIN sizes s USING (lang)
    ) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
) WHERE part = 'pair' OR rank <= 200
"""

_ROUND = """
{t}a AS (
    SELECT v.r, v.k, v.x, c.e, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d,
           row_number() OVER (PARTITION BY v.r, v.k ORDER BY d, c.e) AS nth
    FROM cut v JOIN {s} c ON c.k = v.k QUALIFY nth = 1
)"""
_MOVED = """
{t} AS (
    SELECT c.k, c.e, coalesce(m.x, c.x) AS x FROM {s} c LEFT JOIN (
        SELECT k, e, list(CAST(floor(t::HUGEINT::DECIMAL(38,0) / n) AS BIGINT) ORDER BY i) AS x FROM (
            SELECT k, e, i, sum(x[i]) AS t, count(*) AS n FROM (SELECT k, e, x, unnest(range(1, len(x) + 1)) AS i FROM {t}a) GROUP BY k, e, i
        ) GROUP BY k, e
    ) m ON m.k = c.k AND m.e = c.e
)"""
#: Nearest entries and means of two rounds, and a last assignment.
CODES = f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS (
    SELECT r, k, v[k * w + 1:k * w + w] AS x FROM (SELECT r, v, len(v) // 16 AS w, unnest(range(16)) AS k FROM kept)
), c0 AS (
    SELECT k, r - 1 AS e, x FROM cut WHERE r <= 64
), {_ROUND.format(t="c1", s="c0")}, {_MOVED.format(t="c1", s="c0")}, {_ROUND.format(t="c2", s="c1")}, {_MOVED.format(t="c2", s="c1")},
{_ROUND.format(t="last_", s="c2")}, coded AS (
    SELECT r, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY k) AS code, CAST(sum(d) AS BIGINT) AS error FROM last_a GROUP BY r
), digest AS (
    SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY k, e)) AS codebooks_sha256 FROM c2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""
