"""DuckDB SQL for the document queries that SQL can express."""

SQL = {}

SQL["op5_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

_QUALITY = """
texts AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
listed AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
                  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM texts),
word AS (SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM listed),
gram AS (SELECT rid, i, CASE WHEN lead(x, 4) OVER o IS NOT NULL THEN
                x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o END AS g
         FROM word WINDOW o AS (PARTITION BY rid ORDER BY i)),
again AS (SELECT rid, i FROM gram WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, range(5) r(k) GROUP BY rid),
measured AS (
    SELECT rid, doc_id, lang, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM listed LEFT JOIN covered USING (rid)),
ratio AS (
    SELECT rid, lang, source, 'word_length' AS ratio, word_chars::DOUBLE / n_words AS x FROM measured WHERE n_words > 0 UNION ALL
    SELECT rid, lang, source, 'symbols', n_symbols::DOUBLE / word_chars FROM measured WHERE n_words > 0 UNION ALL
    SELECT rid, lang, source, 'dup_lines', n_dup_lines::DOUBLE / n_lines FROM measured WHERE n_words > 0 UNION ALL
    SELECT rid, lang, source, 'repeats', n_repeat_words::DOUBLE / n_words FROM measured WHERE n_words > 0),
sketch AS (SELECT *, CASE WHEN x > 0 THEN ceil(ln(x) / ln(1.02::DOUBLE)) END AS bin FROM ratio),
-- the 25 % and 75 % quantiles of the bins, by group, language and over all
own AS (SELECT lang, source, ratio, count(*) AS size, quantile_disc(coalesce(bin, -1e9), [0.25, 0.75]) AS q FROM sketch GROUP BY ALL),
by_lang AS (SELECT lang, ratio, count(*) AS size, quantile_disc(coalesce(bin, -1e9), [0.25, 0.75]) AS q FROM sketch GROUP BY ALL),
overall AS (SELECT ratio, quantile_disc(coalesce(bin, -1e9), [0.25, 0.75]) AS q FROM sketch GROUP BY ALL),
chosen AS (
    SELECT o.lang, o.source, o.ratio, CASE WHEN o.size >= 200 THEN o.q WHEN g.size >= 200 THEN g.q ELSE e.q END AS q
    FROM own o JOIN by_lang g ON o.ratio = g.ratio AND o.lang IS NOT DISTINCT FROM g.lang JOIN overall e ON o.ratio = e.ratio),
quartile AS (
    SELECT lang, source, ratio, CASE WHEN q[1] > -1e8 THEN pow(1.02::DOUBLE, q[1]) * (2 / 2.02::DOUBLE) ELSE 0 END AS q25,
           CASE WHEN q[2] > -1e8 THEN pow(1.02::DOUBLE, q[2]) * (2 / 2.02::DOUBLE) ELSE 0 END AS q75 FROM chosen),
fence AS (
    SELECT lang, source, ratio, q25 - 6 * s AS lo, q75 + 6 * s AS hi FROM (SELECT *, greatest(q75 - q25,
        CASE ratio WHEN 'word_length' THEN 0.25 WHEN 'symbols' THEN 0.01 WHEN 'dup_lines' THEN 0.1 ELSE 0.03 END) AS s FROM quartile)),
outside AS (
    SELECT DISTINCT r.rid FROM ratio r JOIN fence f ON r.ratio = f.ratio AND r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source
    JOIN measured m ON m.rid = r.rid
    WHERE r.x > f.hi + CASE WHEN r.ratio = 'word_length' THEN 6 / sqrt(m.n_words) ELSE 0 END
       OR r.ratio = 'word_length' AND r.x < f.lo - 6 / sqrt(m.n_words)),
judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
           NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND rid NOT IN (SELECT rid FROM outside) AS kept FROM measured)
"""

SQL["op10_quality_rules"] = f"""
WITH {_QUALITY}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
"""

# all pairs that share a shingle, then the smallest id reachable
SQL["op3_near_dup"] = """
WITH RECURSIVE texts AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM texts WHERE len(w) >= 5)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM texts WHERE len(w) BETWEEN 1 AND 4),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
same AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM same JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * same.n >= 75 * (x.n + y.n - same.n)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.r = link.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN size USING (doc_id)
"""
