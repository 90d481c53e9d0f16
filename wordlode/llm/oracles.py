"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# Groups at sf0.01 are small enough for the sketches to hold every value.
QUALITY_RULES = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), cut AS (
    SELECT *, list_filter(regexp_split_to_array(t, '[ \t-\r]+'), lambda x: x <> '') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines
    FROM docs
), win AS (
    SELECT rid, i, w[i:i + 7] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM cut)
), twin AS (
    SELECT rid, g FROM win GROUP BY rid, g HAVING count(*) > 1
), covered AS (
    SELECT rid, count(DISTINCT p) AS n FROM (
        SELECT rid, unnest(range(i, i + 8)) AS p FROM win JOIN twin USING (rid, g)
    ) GROUP BY rid
), counted AS (
    SELECT cut.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(t, '[ \t-\r]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) AS BIGINT) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
    FROM cut LEFT JOIN covered ON cut.rid = covered.rid
), measured AS (
    SELECT *, n_symbols / nullif(n_words, 0)::DOUBLE AS m1, n_dup_lines / nullif(n_lines, 0)::DOUBLE AS m2,
           n_repeat_words / nullif(n_words, 0)::DOUBLE AS m3, word_chars / nullif(n_words, 0)::DOUBLE AS m4
    FROM counted
), levels AS (
    SELECT a.lang, a.source, a.n AS ng, b.n AS nl, a.v AS vg, b.v AS vl, c.v AS va FROM
    (SELECT lang, source, count(m1) AS n, [list_sort(list(m1) FILTER (m1 IS NOT NULL)),
        list_sort(list(m2) FILTER (m2 IS NOT NULL)), list_sort(list(m3) FILTER (m3 IS NOT NULL)),
        list_sort(list(m4) FILTER (m4 IS NOT NULL))] AS v FROM measured GROUP BY lang, source) a
    JOIN (SELECT lang, count(m1) AS n, [list_sort(list(m1) FILTER (m1 IS NOT NULL)),
        list_sort(list(m2) FILTER (m2 IS NOT NULL)), list_sort(list(m3) FILTER (m3 IS NOT NULL)),
        list_sort(list(m4) FILTER (m4 IS NOT NULL))] AS v FROM measured GROUP BY lang) b
      ON a.lang IS NOT DISTINCT FROM b.lang
    CROSS JOIN (SELECT [list_sort(list(m1) FILTER (m1 IS NOT NULL)),
        list_sort(list(m2) FILTER (m2 IS NOT NULL)), list_sort(list(m3) FILTER (m3 IS NOT NULL)),
        list_sort(list(m4) FILTER (m4 IS NOT NULL))] AS v FROM measured) c
), quartiles AS (
    SELECT lang, source, list_transform(v, lambda x: x[greatest(1, ceil(0.25 * len(x)))::INT]) AS q1,
           list_transform(v, lambda x: x[greatest(1, ceil(0.75 * len(x)))::INT]) AS q3
    FROM (SELECT lang, source, CASE WHEN ng >= 50 THEN vg WHEN nl >= 50 THEN vl ELSE va END AS v FROM levels)
), judged AS (
    SELECT m.*, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
           coalesce(m1 > q3[1] + 3.0 * greatest(q3[1] - q1[1], 0.1)
             OR m2 > q3[2] + 3.0 * greatest(q3[2] - q1[2], 0.1)
             OR m3 > q3[3] + 3.0 * greatest(q3[3] - q1[3], 0.1)
             OR m4 > q3[4] + 3.0 * greatest(q3[4] - q1[4], 1.5)
             OR m4 < q1[4] - 3.0 * greatest(q3[4] - q1[4], 1.5), false) AS beyond
    FROM measured m LEFT JOIN quartiles q
      ON m.lang IS NOT DISTINCT FROM q.lang AND m.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT beyond AS kept
FROM judged
"""

# Shares of hosts rest when both kinds together move by less than 1e-9 in a step.
URL_FILTERS = r"""
WITH RECURSIVE urls AS (
    SELECT page_id, html, CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), hosts AS (
    SELECT page_id, html, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM urls
), split AS MATERIALIZED (
    SELECT page_id, html, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substring(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM hosts
), rules(rhost, rpath, action) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), places AS MATERIALIZED (SELECT DISTINCT host, path FROM split
), fits AS MATERIALIZED (
    SELECT host, path, rhost || rpath AS rule, action FROM places JOIN rules
      ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
    QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rhost || rpath) DESC) = 1
), ruled AS MATERIALIZED (
    SELECT page_id, html, s.host, s.path, rule, action FROM split s LEFT JOIN fits f ON s.host = f.host AND s.path = f.path
), seeds AS MATERIALIZED (
    SELECT host, kind, avg(coalesce(action = want, false)::INTEGER) AS seed
    FROM ruled, (VALUES ('trust', 'allow'), ('distrust', 'block')) AS k(kind, want)
    WHERE host <> '' GROUP BY host, kind
), links AS MATERIALIZED (
    SELECT src, dst, count(*) AS links FROM (
        SELECT host AS src, translate(unnest(regexp_extract_all(html,
          '(?i)<a(?:rea)?\s(?:[^>]*?\s)?href\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"''\s>]+)', 1)),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM split WHERE host <> '')
    WHERE src <> dst GROUP BY src, dst
), edges AS (
    SELECT 'trust' AS kind, src, dst, links FROM links UNION ALL SELECT 'distrust', dst, src, links FROM links
), shares AS MATERIALIZED (
    SELECT kind, src, dst, links / sum(links) OVER (PARTITION BY kind, src)::DOUBLE AS share FROM edges
), nodes AS MATERIALIZED (
    SELECT kind, node, sum(seed) / nullif(sum(sum(seed)) OVER (PARTITION BY kind), 0) AS seed FROM (
        SELECT kind, host AS node, seed FROM seeds
        UNION ALL SELECT kind, src, 0 FROM edges UNION ALL SELECT kind, dst, 0 FROM edges)
    GROUP BY kind, node
), flow AS MATERIALIZED (
    SELECT kind, src, dst, share, 0.0::DOUBLE AS own FROM shares UNION ALL SELECT kind, node, node, 0, 1 FROM nodes
), steps AS (
    SELECT kind, node, coalesce(seed, 0) AS seed, coalesce(seed, 0) AS rank, true AS moving, 0 AS step FROM nodes
    UNION ALL
    SELECT kind, node, seed, rank, sum(abs(rank - old)) OVER () >= 1e-9, step FROM (
        SELECT r.kind, f.dst AS node, sum(r.seed * own) AS seed, any_value(step) + 1 AS step,
               0.85 * sum(r.rank * share) + 0.15 * sum(r.seed * own) AS rank, sum(r.rank * own) AS old
        FROM steps r JOIN flow f ON r.kind = f.kind AND r.node = f.src
        WHERE moving AND step < 1000 GROUP BY r.kind, f.dst)
), final AS (
    SELECT kind, node, coalesce(rank / nullif(sum(rank) OVER (PARTITION BY kind), 0), 0) AS share
    FROM steps WHERE NOT moving
), judged AS (
    SELECT node, coalesce(max(share) FILTER (kind = 'trust'), 0) AS trust,
           coalesce(max(share) FILTER (kind = 'distrust'), 0) AS distrust, count(*) OVER () AS n
    FROM final GROUP BY node
), bad AS (
    SELECT node FROM judged WHERE distrust > trust * (1 + 1e-9) AND distrust * n > 1 + 1e-9
)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN host IN (SELECT node FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""

PHRASES = r"""
WITH pieces AS (
    SELECT row_number() OVER () AS pid, lang, piece FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), cut AS MATERIALIZED (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM (
        SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM cut, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)
), counts AS MATERIALIZED (
    SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 30
), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang
), cuts AS (
    SELECT lang, size, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
    FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counts WHERE size >= 2)
), best AS MATERIALIZED (
    SELECT c.lang, c.size, c.phrase, a, h.f AS l, t.f AS r,
           ((2000000 * a::HUGEINT) // (h.f::HUGEINT + t.f::HUGEINT))::BIGINT AS score
    FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = head JOIN counts t ON t.lang = c.lang AND t.phrase = tail
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase
      ORDER BY (2000000 * a::HUGEINT) // (h.f::HUGEINT + t.f::HUGEINT), k) = 1
), inner_phrases AS (
    SELECT lang, a AS outer_a, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (
        SELECT lang, a, w, n, unnest(range(1, size - n + 2)) AS i FROM (
            SELECT lang, a, size, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS n FROM best WHERE size > 2))
), most AS (SELECT lang, phrase, max(outer_a) AS outer_a FROM inner_phrases GROUP BY lang, phrase
), kept AS (
    SELECT b.* FROM best b LEFT JOIN most m ON b.lang = m.lang AND b.phrase = m.phrase
    WHERE NOT coalesce(100 * outer_a::HUGEINT >= 80 * a::HUGEINT, false)
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept k JOIN totals USING (lang) QUALIFY rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op7_quality_rules": QUALITY_RULES,
    "op11_url_filters": URL_FILTERS,
    "op12_phrase_mining": PHRASES,
}
