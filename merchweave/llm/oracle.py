"""SQL counterparts, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

from merchweave.llm.queries import SHARD_BYTES

STATEMENTS: dict[str, str] = {}

STATEMENTS["op7_exact_dedup"] = """
WITH k AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents),
g AS (
    SELECT doc_id, h, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
           row_number() OVER (PARTITION BY h, doc_id) AS copy
    FROM k
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND copy = 1 AS kept, h AS text_sha256 FROM g
"""

STATEMENTS["op2_sharding"] = f"""
WITH b AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
           lpad(bin(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT)), 60, '0') AS bits
    FROM documents
),
cut AS (SELECT b.*, d.depth, substr(bits, 1, d.depth) AS shard FROM b, (SELECT unnest(range(0, 61)) AS depth) d),
s AS (
    SELECT depth, shard, sum(n_bytes) AS shard_bytes, count(*) AS shard_rows FROM cut GROUP BY depth, shard
    HAVING sum(n_bytes) <= {SHARD_BYTES} OR count(*) = 1
),
r AS (
    SELECT cut.doc_id, cut.n_bytes, s.shard, s.depth, s.shard_bytes, s.shard_rows,
           row_number() OVER (PARTITION BY cut.doc_id ORDER BY s.depth) AS place
    FROM cut JOIN s ON cut.depth = s.depth AND cut.shard = s.shard
)
SELECT doc_id, n_bytes, shard, CAST(depth AS INTEGER) AS shard_depth, CAST(shard_bytes AS BIGINT) AS shard_bytes,
       shard_rows
FROM r WHERE place = 1
"""

STATEMENTS["op8_mixing"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, lang, lower(coalesce(text, '')) AS low,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
    FROM documents
),
m AS (
    SELECT doc_id, source, lang, words + 1 AS tokens,
           CASE WHEN regexp_matches(low, 'licen[cs]e|copyright') THEN 'legal'
                WHEN regexp_matches(low, '[a-z0-9.]@[a-z0-9]') THEN 'contact'
                WHEN words < 100 THEN 'note' WHEN words < 1000 THEN 'article' ELSE 'book' END AS topic
    FROM d
),
c AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM m GROUP BY ALL),
t AS (SELECT sum(tokens) AS total FROM c),
vs AS (SELECT source, pow(sum(tokens) / any_value(total), 0.5) AS s FROM c, t GROUP BY source),
vl AS (SELECT lang, pow(sum(tokens) / any_value(total), 0.7) AS s FROM c, t GROUP BY lang),
vt AS (SELECT topic, pow(sum(tokens) / any_value(total), 0.8) AS s FROM c, t GROUP BY topic),
start AS (
    SELECT c.source, c.lang, c.topic, c.tokens, total,
           vs.s * total / (SELECT sum(s) FROM vs) AS ts, vl.s * total / (SELECT sum(s) FROM vl) AS tl,
           vt.s * total / (SELECT sum(s) FROM vt) AS tt
    FROM c, t, vs, vl, vt
    WHERE vs.source IS NOT DISTINCT FROM c.source AND vl.lang IS NOT DISTINCT FROM c.lang
      AND vt.topic IS NOT DISTINCT FROM c.topic
),
rake AS (
    SELECT 0 AS i, source, lang, topic, tokens, ts, tl, tt, tokens AS w FROM start
    UNION ALL
    SELECT i + 1, source, lang, topic, tokens, ts, tl, tt,
           CASE i % 3 WHEN 0 THEN w * ts / sum(w) OVER (PARTITION BY source)
                      WHEN 1 THEN w * tl / sum(w) OVER (PARTITION BY lang)
                      ELSE w * tt / sum(w) OVER (PARTITION BY topic) END
    FROM rake WHERE i < 144
),
raked AS (SELECT source, lang, topic, tokens, w, w / tokens AS ratio FROM rake WHERE i = 144),
steps AS (
    SELECT ratio,
           (0.7 * (SELECT total FROM t) - coalesce(sum(tokens) OVER fuller, 0))
               / ((SELECT sum(w) FROM raked) - coalesce(sum(w) OVER fuller, 0)) AS factor
    FROM raked
    WINDOW fuller AS (ORDER BY ratio DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP)
),
chosen AS (SELECT factor FROM steps WHERE factor * ratio < 1 ORDER BY ratio DESC LIMIT 1),
p AS (
    SELECT source, lang, topic, least(1.0, ratio * coalesce((SELECT factor FROM chosen), 1e300)) AS p FROM raked
)
SELECT m.doc_id, m.source, m.lang, m.topic, m.tokens, round(p.p, 6) AS probability,
       CAST('0x' || substr(md5('mix:' || CAST(m.doc_id AS VARCHAR)), 1, 13) AS BIGINT) / pow(16, 13) < p.p AS kept
FROM m, p
WHERE p.source IS NOT DISTINCT FROM m.source AND p.lang IS NOT DISTINCT FROM m.lang
  AND p.topic IS NOT DISTINCT FROM m.topic
"""

STATEMENTS["op5_line_dedup"] = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
),
k AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM l
),
f AS (
    SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
m AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.owner AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

STATEMENTS["op11_quality_cascade"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
),
windows AS (
    SELECT row, i, array_to_string(list_slice(w, i, i + 7), ' ') AS phrase
    FROM (SELECT row, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
),
twice AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, phrase) >= 2),
covered AS (SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY row),
m AS (
    SELECT d.*, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
           len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS lettered,
           len(regexp_extract_all(text, '[A-Z]')) AS capitals, len(regexp_extract_all(text, '[A-Za-z]')) AS latin,
           len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS stutters,
           len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•‣▪●○]'))) AS bullets,
           len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS ellipses
    FROM d LEFT JOIN covered ON covered.row = d.row
),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 3 * n_words AND 10 * n_words AND 10 * n_symbols <= n_words
       AND 10 * lettered >= 8 * n_words AND 2 * capitals <= latin AND 10 * stutters <= 3 * n_words
       AND 2 * n_dup_lines <= len(lines) AND 10 * bullets <= 9 * len(lines) AND 10 * ellipses <= 3 * len(lines) AS kept
FROM b
"""

STATEMENTS["op12_phrases"] = r"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
t AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
occurrences AS (
    SELECT lang, list_slice(words, i, i + k - 1) AS phrase
    FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
          FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(words) >= k)
),
f AS (SELECT lang, phrase, count(*) AS a FROM occurrences GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, phrase, a, unnest(range(1, len(phrase))) AS k FROM f WHERE len(phrase) > 1),
s AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, t.n,
           CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
    FROM cuts c JOIN t ON t.lang = c.lang
    JOIN f x ON x.lang = c.lang AND x.phrase = list_slice(c.phrase, 1, c.k)
    JOIN f y ON y.lang = c.lang AND y.phrase = list_slice(c.phrase, c.k + 1, len(c.phrase))
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1
),
inner_parts AS (
    SELECT lang, a, list_slice(phrase, i, i + k - 1) AS phrase
    FROM (SELECT lang, a, phrase, k, unnest(range(1, len(phrase) - k + 2)) AS i
          FROM (SELECT lang, a, phrase, unnest(range(2, len(phrase))) AS k FROM f WHERE len(phrase) > 2))
),
within AS (SELECT lang, phrase, max(a) AS a FROM inner_parts GROUP BY ALL),
kept AS (
    SELECT s.*, array_to_string(s.phrase, ' ') AS text
    FROM s LEFT JOIN within i ON i.lang = s.lang AND i.phrase = s.phrase WHERE i.a IS NULL OR 100 * i.a < 100 * s.a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, text) AS rank FROM kept)
SELECT lang, rank, text AS phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

STATEMENTS["op13_hard_negatives"] = """
WITH r AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM r a JOIN r b ON a.id % 100 = 0 AND a.id <> b.id
),
p AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
),
n AS (
    SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
     AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
