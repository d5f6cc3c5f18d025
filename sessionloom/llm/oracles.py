"""DuckDB SQL of the training-text queries that SQL can express."""

from .licenses import NOTICES, THRESHOLD

ORACLES: dict[str, str] = {}

# ten-word windows compared as text, without hashes
ORACLES["op6_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win
       FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bl)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i
             FROM d, (SELECT DISTINCT k FROM bl))),
hits AS (SELECT DISTINCT doc_id, item_id, dw.k, i FROM dw JOIN bw ON bw.k = dw.k AND bw.win = dw.win),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# the same places on the hash line, taken in their order
ORACLES["op1_mixing"] = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS place
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
             2.0 * CAST(source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, (1.5 * CAST(sum(source_size) OVER () AS DOUBLE)
                 - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
             / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT source, source_size, least(cap, weight * (SELECT level FROM l WHERE level * weight <= cap
                                                       ORDER BY cap / weight LIMIT 1)) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds FROM t),
v AS (SELECT source, place, sum(size) AS size FROM d GROUP BY source, place),
c AS (SELECT v.source, v.place, v.size, sum(v.size) OVER (PARTITION BY v.source ORDER BY v.place) AS upto,
             p.target - p.rounds * p.source_size AS budget
      FROM v JOIN p ON v.source IS NOT DISTINCT FROM p.source),
k AS (SELECT source, place, upto <= budget
             OR (upto - size <= budget AND upto - budget <= budget - (upto - size)) AS more FROM c)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST(d.size * (p.rounds + CASE WHEN k.more THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
JOIN k ON k.source IS NOT DISTINCT FROM d.source AND k.place = d.place
"""

_NOTICE_ROWS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''"))
                         for name in NOTICES for text in NOTICES[name])
# every line and notice within the size bounds, without the look-up that drops lines before
ORACLES["op9_licenses"] = rf"""
WITH t AS (SELECT license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS tb
           FROM (SELECT license, regexp_extract_all(lower(line), '[\p{{L}}\p{{N}}]+') AS w
                 FROM (VALUES {_NOTICE_ROWS}) v(license, line))),
l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, coalesce(text, '') AS text FROM documents),
u AS (SELECT doc_id, u, regexp_extract_all(lower(line), '[\p{{L}}\p{{N}}]+') AS w
      FROM (SELECT doc_id, unnest(range(len(units))) AS u, unnest(units) AS line
            FROM (SELECT doc_id, CASE WHEN len(lines) > 1 THEN list_append(lines, text) ELSE lines END AS units FROM l))),
g AS (SELECT doc_id, u, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS ub FROM u),
m AS (SELECT doc_id, u, license, 2.0 * len(list_intersect(ub, tb)) / (len(ub) + len(tb)) AS dice
      FROM g JOIN t ON {THRESHOLD} * len(tb) <= {2 - THRESHOLD} * len(ub) AND {THRESHOLD} * len(ub) <= {2 - THRESHOLD} * len(tb)),
b AS (SELECT doc_id, u, license, dice FROM m WHERE dice >= {THRESHOLD}
      QUALIFY row_number() OVER (PARTITION BY doc_id, u ORDER BY dice DESC, license) = 1),
d AS (SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
             max(dice) AS best_dice, arg_min(license, (-dice, license)) AS best_license FROM b GROUP BY doc_id)
SELECT l.doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses, best_license,
       CAST(best_dice AS DOUBLE) AS best_dice
FROM l LEFT JOIN d USING (doc_id)
"""

_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ORACLES["op4_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
o AS (SELECT hex, max(page_id) AS owner FROM p GROUP BY hex)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('{_DIGITS}',
           1 + ((CAST('0x' || substr(hex, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31), 1)), '')
           AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM owner THEN owner END AS refers_to, true AS intact
FROM p JOIN o USING (hex)
"""

# integers throughout; every anchor meets every row
ORACLES["op12_hard_negatives"] = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

# every run of one to five words of every piece, counted as text
ORACLES["op13_collocations"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
t AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
inner_parts AS (SELECT lang, a, unnest(list_distinct(flatten(list_transform(range(1, k), lambda m:
                  list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' ')))))) AS phrase FROM c),
covered AS (SELECT lang, phrase, max(a) AS around FROM inner_parts GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN covered USING (lang, phrase) WHERE around IS NULL OR 100 * around < 100 * a),
cuts AS (SELECT lang, phrase, a, w, unnest(range(1, k)) AS j FROM kept),
sized AS (SELECT cuts.lang, cuts.phrase, a, j, l.f AS l, r.f AS r, n,
                 CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
          FROM cuts JOIN t USING (lang)
          JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(cuts.w[1:j], ' ')
          JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(cuts.w[j + 1:], ' ')),
best AS (SELECT * FROM sized QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""
