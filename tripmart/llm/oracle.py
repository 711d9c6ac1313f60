"""DuckDB SQL of those queries of this package that SQL can express."""

from __future__ import annotations

_OP8 = r"""
WITH item AS (
  SELECT DISTINCT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), spans AS (
  SELECT DISTINCT item_id, w[i:i + least(10, len(w)) - 1] AS span
  FROM item, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i)
  WHERE len(w) > 0
), doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), sizes AS (SELECT DISTINCT len(span) AS n FROM spans), found AS (
  SELECT doc_id, i, n, item_id
  FROM (SELECT doc_id, i, n, w[i:i + n - 1] AS span
        FROM doc, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)) AS windows
  JOIN spans USING (span)
), hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM found, unnest(range(0, n)) AS t(k) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

_OP9 = r"""
WITH item AS (
  SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR)) AS lot
  FROM (SELECT doc_id, source,
          CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
        FROM documents)
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind,
    CAST(CASE kind WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight
  FROM item GROUP BY source
), filled AS (
  SELECT *, coalesce(sum(2 * source_size) OVER w, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open,
    1.5 * sum(source_size) OVER () AS owed
  FROM src WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min((CAST(owed AS DOUBLE) - CAST(capped AS DOUBLE)) / open, 2 * source_size / weight) AS level FROM filled
  WHERE 2 * source_size >= weight * ((CAST(owed AS DOUBLE) - CAST(capped AS DOUBLE)) / open)
), goal AS (
  SELECT source, source_size, kind, least(CAST(2 * source_size AS DOUBLE), weight * level) AS target FROM src, level
), laid AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY lot, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM item
), taking AS (
  SELECT doc_id, size, source_size, target, kind, greatest(CAST(round(target) AS BIGINT), 1) AS whole,
    greatest(0, least(size, CAST(round(target) AS BIGINT) - start)) AS one,
    greatest(0, least(size, CAST(round(target) AS BIGINT) - source_size - start)) AS two,
    (start + one / 2) / whole AS a, (start + source_size + two / 2) / whole AS b
  FROM laid JOIN goal ON laid.source IS NOT DISTINCT FROM goal.source
), placed AS (
  -- The share a of the demand is met at the time t at which the schedule's integral is a.
  SELECT *, list_transform([a, b], lambda d: CASE
    WHEN d >= 1 THEN 1.0 WHEN kind = 1 THEN d
    WHEN kind = 0 AND d < 0.625 THEN 2 * d / (1.5 + sqrt(2.25 - 2 * d))
    WHEN kind = 0 THEN 0.5 + 2 * (d - 0.625) / (1 + sqrt(1 - 2 * (d - 0.625)))
    WHEN d < 0.375 THEN 2 * d / (0.5 + sqrt(0.25 + 2 * d))
    ELSE 0.5 + 2 * (d - 0.375) / (1 + sqrt(1 + 2 * (d - 0.375))) END) AS spots
  FROM taking
)
SELECT doc_id, size, source_size, target, CAST(one + two AS BIGINT) AS taken,
  concat_ws(',', CASE WHEN one > 0 THEN CAST(CAST(floor(spots[1] * 1000000) AS BIGINT) AS VARCHAR) END,
    CASE WHEN two > 0 THEN CAST(CAST(floor(spots[2] * 1000000) AS BIGINT) AS VARCHAR) END) AS positions
FROM placed
"""

_OP5 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), spans AS (
  SELECT id, i, array_to_string(w[i:i + 4], ' ') AS span FROM doc, unnest(range(1, len(w) - 3)) AS x(i)
), again AS (
  SELECT id, count(DISTINCT i + k) AS n FROM (
    SELECT id, i FROM spans QUALIFY count(*) OVER (PARTITION BY id, span) > 1), unnest(range(0, 5)) AS x(k) GROUP BY id
), counted AS (
  SELECT id, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
    length(t) - length(regexp_replace(t, '[A-Z!]', '', 'g')) AS n_loud
  FROM doc LEFT JOIN again USING (id)
), pairs AS (
  SELECT id, lang, source, m[1] AS measure, m[2] AS value, m[3] AS floor, m[4] AS two, m[5] AS reach FROM (
    SELECT id, lang, source, unnest([
      [0, n_symbols * 1000 // n_words, 100, 0, 3], [1, n_loud * 1000 // n_words, 25, 0, 24],
      [2, n_dup_lines * 1000 // greatest(n_lines, 1), 134, 0, 3],
      [3, word_chars * 1000 // n_words, 100, 1, 12]]) AS m
    FROM counted WHERE n_words > 0)
), hist AS (
  SELECT lang, source, measure, floor, two, reach, u * (value // u) AS bucket, count(*) AS n,
    grouping(source) AS no_source, grouping(lang) AS no_lang
  FROM (SELECT *, CAST(rpad('1', CAST(greatest(length(CAST(value AS VARCHAR)) - 2, 1) AS INTEGER), '0') AS BIGINT) AS u FROM pairs)
  GROUP BY GROUPING SETS ((lang, source, measure, floor, two, reach, u * (value // u)),
    (lang, measure, floor, two, reach, u * (value // u)), (measure, floor, two, reach, u * (value // u)))
), ranked AS (
  SELECT *, sum(n) OVER (g ORDER BY bucket) AS upto, sum(n) OVER g AS total
  FROM hist WINDOW g AS (PARTITION BY no_source, no_lang, lang, source, measure)
), bounds AS (
  SELECT no_source, no_lang, lang, source, measure, total, CASE WHEN two = 1 THEN q1 - width END AS low, q3 + width AS high
  FROM (SELECT *, reach * greatest(q3 - q1, floor) AS width FROM (
    SELECT no_source, no_lang, lang, source, measure, floor, two, reach, max(total) AS total,
      min(bucket) FILTER (upto * 4 >= total) AS q1, min(bucket) FILTER (upto * 4 >= total * 3) AS q3
    FROM ranked GROUP BY ALL))
), outside AS (
  SELECT DISTINCT id FROM pairs p
  JOIN bounds a ON a.no_source = 0 AND a.no_lang = 0 AND a.lang IS NOT DISTINCT FROM p.lang
    AND a.source IS NOT DISTINCT FROM p.source AND a.measure = p.measure
  JOIN bounds b ON b.no_source = 1 AND b.no_lang = 0 AND b.lang IS NOT DISTINCT FROM p.lang AND b.measure = p.measure
  JOIN bounds c ON c.no_source = 1 AND c.no_lang = 1 AND c.measure = p.measure
  WHERE value > CASE WHEN a.total >= 100 THEN a.high WHEN b.total >= 100 THEN b.high ELSE c.high END
    OR value < CASE WHEN a.total >= 100 THEN a.low WHEN b.total >= 100 THEN b.low ELSE c.low END
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND id NOT IN (SELECT id FROM outside) AS kept
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
"""

# One block of these for each level of the path tree.  SQL needs their number: enough for tables
# in which no path is shared by five pages beyond it; what is deeper is rare and so wildcards.
_OP3_LEVELS = 12
_OP3_LEVEL = r"""
, going{d} AS (
  SELECT *, segments[{d} + 1] AS segment FROM level{d}
), child{d} AS (
  SELECT host, template, segment, sum(pages) AS pages, sum(blocked) AS blocked, sum(allowed) AS allowed
  FROM going{d} WHERE segment IS NOT NULL GROUP BY ALL
), node{d} AS (
  SELECT host, template, sum(pages) AS n, sum(blocked) AS b, sum(allowed) AS a
  FROM child{d} WHERE pages >= 5 GROUP BY ALL
), name{d} AS (
  SELECT host, template, segment, CASE
    WHEN pages < 5 AND regexp_replace(segment, '[0-9]+', '#', 'g') = segment THEN '~'
    WHEN pages < 5 THEN regexp_replace(segment, '[0-9]+', '#', 'g')
    WHEN pow(blocked / pages - b / n, 2) > 2.58 * 2.58 * ((b + 1.0) / (n + 2.0)) * (1 - (b + 1.0) / (n + 2.0)) / pages
      OR pow(allowed / pages - a / n, 2) > 2.58 * 2.58 * ((a + 1.0) / (n + 2.0)) * (1 - (a + 1.0) / (n + 2.0)) / pages
      THEN segment
    ELSE '*' END AS name
  FROM child{d} LEFT JOIN node{d} USING (host, template)
), level{next} AS (
  SELECT host, path, pages, rule, blocked, allowed, segments,
    CASE WHEN name IS NULL THEN template ELSE template || '/' || name END AS template
  FROM going{d} LEFT JOIN name{d} USING (host, template, segment)
)"""
_OP3 = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), page AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), ruled AS (
  SELECT host, path, count(*) AS pages, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
  FROM page GROUP BY host, path
), level0 AS (
  SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN pages ELSE 0 END AS blocked,
    CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN pages ELSE 0 END AS allowed,
    list_filter(string_split(path, '/'), lambda x: x <> '') AS segments, '' AS template
  FROM ruled
)""" + "".join(_OP3_LEVEL.format(d=d, next=d + 1) for d in range(_OP3_LEVELS)) + rf"""
, deep AS (
  SELECT * REPLACE (template || array_to_string(list_transform(segments[{_OP3_LEVELS + 1}:], lambda x: '/' ||
    CASE WHEN regexp_replace(x, '[0-9]+', '#', 'g') = x THEN '~' ELSE regexp_replace(x, '[0-9]+', '#', 'g') END), '') AS template)
  FROM level{_OP3_LEVELS}
), known AS (
  SELECT host, template, sum(blocked) / (sum(blocked) + sum(allowed) + 4) >= 0.5 AS rejected FROM deep GROUP BY ALL
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
  WHEN rejected THEN 'block' ELSE 'allow' END AS verdict, template
FROM page JOIN deep USING (host, path) JOIN known USING (host, template)
"""

_OP10 = r"""
SELECT source, lang, tokenizer, count(*) AS documents, CAST(sum(tokens) AS BIGINT) AS tokens FROM (
  SELECT source, lang, CASE WHEN lang <> 'en' THEN 'words-2' ELSE 'words-1' END AS tokenizer, CASE WHEN lang <> 'en'
    THEN len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]'))
    ELSE len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) END AS tokens
  FROM documents WHERE NOT EXISTS (
    SELECT 1 FROM labels WHERE quality = 0 AND labels.doc_id IS NOT DISTINCT FROM documents.doc_id))
GROUP BY ALL
"""

_OP12 = r"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), eldest AS (SELECT t, min(doc_id) AS eldest FROM doc GROUP BY t), known AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, concat(
      CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > eldest THEN 'E' END) AS fails,
    count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM doc JOIN eldest USING (t) LEFT JOIN known USING (doc_id) GROUP BY ALL
), f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), step AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, CAST(s.step AS INTEGER) AS step
  FROM f a, f b, f c, f d, f e, range(1, 6) AS s(step) WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), placed AS (
  SELECT *, filter_order[step] AS x, translate(fails, filter_order[:step - 1], '') <> fails AS gone FROM failing, step
), total AS (
  SELECT part, filter_order, step, x,
    coalesce(sum(n) FILTER (translate(fails, filter_order[:step], '') = fails), 0) AS kept,
    coalesce(sum(n) FILTER (contains(fails, x) AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (contains(fails, x) AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (fails = x), 0) AS unique_fails,
    coalesce(sum(good) FILTER (contains(fails, x) AND NOT gone), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (contains(fails, x) AND NOT gone), 0) AS toxic_lost
  FROM placed GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM total
"""

_OP13 = r"""
WITH known AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, q) = 1
), pair AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike,
    CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM known a JOIN known r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positive AS (
  SELECT * FROM pair WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), mined AS (
  SELECT n.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY n.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positive p JOIN pair n ON n.anchor_id = p.anchor_id AND NOT n.alike
    AND 80 * p.score <= 100 * n.score AND n.score <= p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM mined WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_url_templates": _OP3, "op5_adaptive_quality": _OP5, "op8_suffix_decontam": _OP8, "op9_curriculum": _OP9,
            "op10_token_rollup": _OP10, "op12_filter_audit": _OP12, "op13_hard_negatives": _OP13}
