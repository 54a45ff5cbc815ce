"""SQL statements of the rules that SQL can express: the same results by brute force, without index or pruning."""

from __future__ import annotations

from .licenses import NEAR, TEMPLATES

_WORDS = "regexp_extract_all(lower({}), '[a-z0-9]+')".format
_TEMPLATES = ",\n ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))

LICENSE_SCAN = rf"""
WITH top AS (
 SELECT doc_id, text, row_number() OVER () AS rid, coalesce(source, 'unknown') || '/' || coalesce(lang, 'unknown') AS top FROM documents),
files AS (
 SELECT doc_id, rid, text, CASE WHEN doc_id % 4096 = 0 THEN top || '/LICENSE.' || doc_id
  WHEN doc_id % 64 = 0 THEN top || '/shelf-' || (doc_id // 64) || '/LICENSE'
  ELSE top || '/shelf-' || (doc_id // 64) || '/' || doc_id || '.txt' END AS path FROM top),
template(template, license, text) AS (VALUES
 {_TEMPLATES}),
tt AS (SELECT template, license, term, count(*) AS n FROM (SELECT template, license, unnest({_WORDS("text")}) AS term FROM template) GROUP BY ALL),
held AS (SELECT term, count(*) AS files FROM (SELECT DISTINCT rid, unnest({_WORDS("text")}) AS term FROM files) GROUP BY term),
idf AS (
 SELECT v.term, ln((1 + (SELECT count(*) FROM files)) / (1 + coalesce(h.files, 0))) + 1e-9 AS w
 FROM (SELECT DISTINCT term FROM tt) AS v LEFT JOIN held AS h USING (term)),
tv AS (SELECT template, license, term, n * w / sqrt(sum(n * w * n * w) OVER (PARTITION BY template)) AS part FROM tt JOIN idf USING (term)),
lines AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS line FROM files),
lt AS (SELECT line, term, count(*) * any_value(w) AS w FROM (SELECT line, unnest({_WORDS("line")}) AS term FROM lines) JOIN idf USING (term) GROUP BY line, term),
size AS (SELECT line, sqrt(sum(w * w)) AS size FROM lt GROUP BY line),
dot AS (SELECT line, template, license, sum(w * part) AS dot FROM lt JOIN tv USING (term) GROUP BY line, template, license),
best AS (
 SELECT line, max({{'score': round(dot / size, 6), 'license': license}}) AS b FROM dot JOIN size USING (line)
 WHERE round(dot / size, 6) >= {NEAR} GROUP BY line),
own AS (SELECT rid, max(b) AS own FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM files) JOIN best USING (line) GROUP BY rid),
known AS (SELECT f.doc_id, f.rid, f.path, regexp_replace(f.path, '/?[^/]*$', '') AS folder, o.own FROM files AS f LEFT JOIN own AS o USING (rid)),
marked AS (
 SELECT folder AS up, max(own) AS of_up FROM known
 WHERE own IS NOT NULL AND regexp_matches(path, '(?i)(^|/)(licen[cs]e|copying|notice)([._-][^/]*)?$') GROUP BY folder),
near AS (
 SELECT k.rid, max({{'n': length(m.up), 'up': m.up, 'of_up': m.of_up}}) AS near
 FROM known AS k JOIN marked AS m ON m.up = '' OR k.folder = m.up OR starts_with(k.folder, m.up || '/') WHERE k.own IS NULL GROUP BY k.rid)
SELECT k.doc_id, k.path, k.own.license AS own_license, coalesce(k.own.score, n.near.of_up.score) AS score,
 coalesce(k.own.license, n.near.of_up.license) AS license, n.near.up AS inherited_from
FROM known AS k LEFT JOIN near AS n USING (rid)
"""

TOP_K_SEARCH = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id,
 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents WHERE doc_id IS NOT NULL),
size AS (SELECT count(*) AS docs, sum(len(words)) / count(*) AS mean FROM docs),
tf AS (SELECT rid, doc_id, len, term, count(*) AS n FROM (SELECT rid, doc_id, len(words) AS len, unnest(words) AS term FROM docs) GROUP BY ALL),
idf AS (SELECT term, ln(1 + ((SELECT docs FROM size) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf GROUP BY term),
asked AS (SELECT doc_id AS query_id, term, n AS times FROM tf WHERE doc_id % 50 = 0),
scored AS (
 SELECT query_id, rid, doc_id, round(sum(times * idf * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score
 FROM asked JOIN idf USING (term) JOIN tf USING (term), size WHERE doc_id <> query_id GROUP BY query_id, rid, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT query_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

URL_FILTER = r"""
WITH rest AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
parts AS (
 SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM rest),
named AS (
 SELECT *, '//' || host || path AS place, CASE
  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE
 WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
 WHEN regexp_matches(place, '^//([^/]*[.-])?(spam-farm[.]|casino[.-]|adult[.-])') OR regexp_matches(place, '/(login|cart)(/|$)|/cgi-bin/|/wp-admin/')
 THEN 'block' ELSE 'allow' END AS verdict
FROM named
"""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format

RANKED_SEARCH = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id,
 regexp_extract_all({_LOWER("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
size AS (SELECT count(*) AS n, CAST(sum(len(words)) AS BIGINT) AS l FROM docs WHERE len(words) > 0),
tf AS (SELECT rid, doc_id, len, term, count(*) AS tf FROM (SELECT rid, doc_id, len(words) AS len, unnest(words) AS term FROM docs) GROUP BY ALL),
items AS (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (
 SELECT item, item_id, term, count(*) AS times FROM (
  SELECT item, item_id, unnest(regexp_extract_all({_LOWER("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * (SELECT n FROM size) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf GROUP BY term),
scored AS (
 SELECT item, item_id, rid, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len * n) // l)))) AS BIGINT) AS score
 FROM asked JOIN w USING (term) JOIN tf USING (term), size GROUP BY item, item_id, rid, doc_id),
best AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM best WHERE rank <= 10
"""

#: The checksum bit by bit over the bytes of each distinct word; the Gumbel value from the digest's first 8 digits.
IMPORTANCE_RESAMPLING = rf"""
WITH table_ AS (
 SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
dw AS (SELECT rid, word, count(*) AS n FROM (SELECT rid, unnest(words) AS word FROM docs) GROUP BY ALL),
bw AS (
 SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all({_LOWER("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark) GROUP BY word),
hexed AS (SELECT word, hex(word) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
crc AS (
 SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
  lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM hexed, table_),
s AS (SELECT bucket, sum(n) AS s FROM dw JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM bw JOIN crc USING (word) GROUP BY bucket),
total AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS s, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS t),
gain AS (
 SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.t, 0)::DOUBLE + 1) * (total.s + 10000) / ((s.s::DOUBLE + 1) * (total.t + 10000)))) AS BIGINT) AS gain
 FROM s LEFT JOIN t ON s.bucket = t.bucket, total),
weight AS (SELECT rid, sum(n * gain) AS weight FROM dw JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY rid),
scored AS (
 SELECT doc_id, rid, len(words) AS n, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln(
  (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
 FROM docs LEFT JOIN weight USING (rid)),
placed AS (SELECT *, CASE WHEN n >= 20 THEN row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS place FROM scored)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, weight, score, CASE WHEN place <= 10 * (SELECT count(*) FROM scored WHERE n >= 20) // 100 THEN place END AS rank FROM placed
"""

STATEMENTS: dict[str, str] = {
    "op2_license_scan": LICENSE_SCAN, "op3_top_k_search": TOP_K_SEARCH, "op5_url_filter": URL_FILTER,
    "op11_ranked_search": RANKED_SEARCH, "op13_importance_resampling": IMPORTANCE_RESAMPLING,
}
