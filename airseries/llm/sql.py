"""DuckDB SQL for the operators that SQL can express."""

LINE_DEDUP = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.first_doc AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

URL_FILTERS = r"""
WITH rules(verdict, rule) AS (
  VALUES ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'),
    ('block', 'net/es/'), ('block', 'net/fr/')
), parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), cut AS (
  SELECT page_id, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw_host FROM parts
), split AS (
  SELECT page_id,
    translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
  FROM cut
), fits AS (
  SELECT s.page_id, r.rule, r.verdict,
    row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rule) DESC) AS rank
  FROM split s JOIN rules r
    ON (s.host = split_part(r.rule, '/', 1) OR ends_with(s.host, '.' || split_part(r.rule, '/', 1)))
    AND starts_with(s.path, substr(r.rule, strpos(r.rule, '/')))
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON s.page_id = f.page_id AND f.rank = 1
"""

DECONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS win
  FROM (
    SELECT item_id, words, least(10, len(words)) AS size,
      unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos
    FROM item_words WHERE len(words) > 0
  )
), sizes AS (SELECT DISTINCT size FROM windows),
spots AS (
  SELECT doc_id, size, pos, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS win
  FROM (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
    FROM doc_words, sizes WHERE len(words) >= size
  )
), hits AS (
  SELECT s.doc_id, s.size, s.pos, w.item_id FROM spots s JOIN windows w ON s.size = w.size AND s.win = w.win
), hit_words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
  coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, pos, array_to_string(list_slice(words, pos, pos + 12), ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM doc_words)
), firsts AS (
  SELECT win, min(doc_id) AS first_doc FROM windows GROUP BY win HAVING count(DISTINCT doc_id) > 1
), hit AS (
  SELECT DISTINCT w.doc_id, unnest(range(w.pos, w.pos + 13)) AS word
  FROM windows w JOIN firsts f ON w.win = f.win AND f.first_doc < w.doc_id
), removed AS (SELECT doc_id, list(word) AS gone FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(coalesce(gone, [])) AS BIGINT) AS n_removed,
  sha256(array_to_string(
    list_filter(words, lambda w, i: NOT list_contains(coalesce(gone, []), i)), ' ')) AS kept_sha256
FROM doc_words d LEFT JOIN removed r ON d.doc_id = r.doc_id
"""

HARD_NEGATIVES = r"""
WITH whole AS (
  SELECT row_number() OVER () AS n, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.n AS a_n, a.vec_id AS anchor_id, r.n AS r_n, r.vec_id AS other_id, a.label = r.label AS same,
    list_inner_product(a.v, r.v)::BIGINT AS score
  FROM whole a JOIN whole r ON a.n <> r.n WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY a_n ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
  row_number() OVER (PARTITION BY p.a_n, p.r_n ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
  s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON p.a_n = s.a_n AND NOT s.same
WHERE 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""
