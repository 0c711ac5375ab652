"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, coalesce({WORDS.format("text")}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS.format("text")} AS w FROM benchmark),
c AS (SELECT item, w, least(13, len(w)) AS width FROM b WHERE len(w) > 0),
wins AS (
  SELECT DISTINCT item, width, array_to_string(list_slice(w, i, i + width - 1), ' ') AS win
  FROM (SELECT item, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM c)
),
dw AS (
  SELECT doc_id, width, i, array_to_string(list_slice(w, i, i + width - 1), ' ') AS win
  FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
        FROM d, (SELECT DISTINCT width FROM wins) WHERE len(w) >= width)
),
hits AS (SELECT doc_id, item, i, width FROM dw JOIN wins USING (width, win)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM hits) GROUP BY 1
),
met AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN met USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
l AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS leader
      FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> leader THEN leader END AS refers_to
FROM l
"""

MIXING = """
WITH s AS (SELECT source, CAST(sum(strlen(coalesce(text, '')) + 1) AS DOUBLE) AS held FROM documents GROUP BY 1),
r AS (SELECT source, pow(held, 0.5) / (SELECT sum(pow(held, 0.5)) FROM s) * (SELECT sum(held) FROM s) / held AS rate FROM s),
pmf AS (SELECT source, rate, k, exp(-rate + k * ln(rate) - CASE WHEN k = 0 THEN 0 ELSE lgamma(k + 1) END) AS p
        FROM r, (SELECT unnest(range(0, 400)) AS k)),
cdf AS (SELECT source, rate, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM pmf),
u AS (SELECT *, CAST(CAST('0x' || substr(md5('7:1:' || doc_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
      FROM documents),
n AS (SELECT doc_id, any_value(rate) AS rate, sum(CASE WHEN c <= u THEN 1 ELSE 0 END) AS n FROM u JOIN cdf USING (source)
      GROUP BY 1)
SELECT d.*, round(rate, 6) AS mix_rate, CAST(unnest(range(1, CAST(n AS BIGINT) + 1)) AS INTEGER) AS mix_copy
FROM documents d JOIN n USING (doc_id) WHERE n > 0
"""

URLS = """
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
b AS (SELECT page_id, {lower} AS host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT *, '.' || host AS dotted FROM b),
d AS (SELECT *, CASE
        WHEN ends_with(dotted, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN ends_with(dotted, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN ends_with(dotted, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN ends_with(dotted, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN ends_with(dotted, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM c)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM d
""".format(lower=LOWER.format("regexp_extract(rest, '(?s)^[^/?#]*', 0)"))

# crc32 by its table of 256 entries, over the UTF-8 bytes of an id and a run. Near words share a text with one
# code point less (insertions, deletions) or with one code point left open (replacements).
VARIANTS = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
),
runs AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all({lower}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL
),
bytes AS (
  SELECT *, flatten(list_transform(string_split(id || ':' || run, ''), lambda ch:
    CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)]
         ELSE [192 + unicode(ch) // 64, 128 + unicode(ch) % 64] END)) AS b FROM runs
),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b),
    lambda c, x: xor(c // 256, t[CAST(xor(c % 256, x) AS INT) + 1])), 4294967295) AS h FROM bytes, crc
),
kept AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
              ELSE run END AS word, n FROM hashed
),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM kept WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3
),
open AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (
    SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
),
less AS (SELECT DISTINCT o.word AS long, w.word AS short FROM open o JOIN words w ON w.word = o.a || o.b),
near AS (
  SELECT long AS word, short AS other FROM less UNION ALL SELECT short, long FROM less
  UNION ALL SELECT DISTINCT x.word, y.word FROM open x JOIN open y USING (i, a, b) WHERE x.word <> y.word
),
best AS (
  SELECT near.word, count(*) AS n_near, max(o.n) AS form_n,
         first(other ORDER BY o.n DESC, other) AS form
  FROM near JOIN words o ON o.word = other GROUP BY 1
),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form,
         CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)
),
walk AS (
  SELECT word, word AS at, form AS onward FROM formed
  UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN formed f ON f.word = walk.onward
)
SELECT f.word, f.form, walk.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN walk ON walk.word = f.word AND walk.onward IS NULL
""".format(lower=LOWER.format("text"))

ORACLES = {
    "op3_decontamination": DECONTAMINATION,
    "op4_warc": WARC,
    "op7_mixing": MIXING,
    "op10_urls": URLS,
    "op11_variants": VARIANTS,
}
