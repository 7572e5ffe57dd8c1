"""DuckDB SQL for the operators whose results SQL can state."""

LEXICAL_SEARCH = r"""
WITH term_rule AS (SELECT '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS re),
posting AS (
  SELECT uid, doc_id, lower_term AS term, count(*) AS tf FROM (
    SELECT uid, doc_id, translate(unnest(regexp_extract_all(text, (SELECT re FROM term_rule))),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_term
    FROM (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents))
  GROUP BY ALL),
doc AS (SELECT uid, doc_id, sum(tf)::BIGINT AS n FROM posting GROUP BY ALL),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM doc),
query AS (
  SELECT DISTINCT q, item_id, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM (
    SELECT q, item_id, unnest(regexp_extract_all(text, (SELECT re FROM term_rule))) AS term
    FROM (SELECT row_number() OVER () AS q, item_id, coalesce(text, '') AS text FROM benchmark))),
weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM posting WHERE term IN (SELECT term FROM query) GROUP BY term), total),
norm AS (SELECT uid, doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM doc, total),
scored AS (
  SELECT q, item_id, doc_id, uid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM query JOIN posting USING (term) JOIN weight USING (term) JOIN norm USING (uid, doc_id)
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, uid)::INT AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

FILTER_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
least AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
mark AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
cell AS (
  SELECT part,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM d JOIN least USING (t) LEFT JOIN mark USING (doc_id) GROUP BY ALL),
state AS (
  SELECT part, s, sum(CASE WHEN mask & s = 0 THEN n ELSE 0 END) AS n, sum(CASE WHEN mask & s = 0 THEN good ELSE 0 END) AS good,
         sum(CASE WHEN mask & s = 0 THEN toxic ELSE 0 END) AS toxic
  FROM cell, (SELECT unnest(range(32)) AS s) GROUP BY part, s),
filter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
ordered AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM filter a, filter b, filter c, filter d, filter e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, f, bit,
    (SELECT coalesce(sum(x.bit), 0) FROM filter x WHERE strpos(filter_order, x.f) < step) AS before
  FROM ordered, (SELECT unnest(range(1, 6)) AS step), filter WHERE substr(filter_order, step, 1) = f),
failing AS (
  SELECT part, f, sum(CASE WHEN mask & bit > 0 THEN n ELSE 0 END) AS fails, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS alone
  FROM cell, filter GROUP BY part, f),
walked AS (
  SELECT x.part, filter_order, step, f, y.n AS kept, x.n - y.n AS removed, x.good - y.good AS good_lost, x.toxic - y.toxic AS toxic_lost
  FROM steps JOIN state x ON x.s = before JOIN state y ON y.s = before + bit AND y.part = x.part)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       (fails - removed)::BIGINT AS redundant, alone::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM walked JOIN failing USING (part, f)
"""

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY n_chars DESC, doc_id NULLS LAST) AS place,
         first_value(doc_id) OVER (PARTITION BY t ORDER BY n_chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM ranked
"""
