"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

#: All pairs that share a rare shingle, compared in full; components by transitive closure.
NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END AS items FROM words
), members AS (
  SELECT doc_id, len(items) AS n, CASE WHEN len(items) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY items) END AS rep FROM sets
), items AS (
  SELECT doc_id AS id, len(items) AS n, unnest(items) AS item FROM sets WHERE doc_id IN (SELECT rep FROM members)
), ranked AS (
  SELECT id, n, item, row_number() OVER (PARTITION BY id ORDER BY often, item) AS nth FROM (SELECT *, count(*) OVER (PARTITION BY item) AS often FROM items)
), rare AS (
  -- Of two sets at 0.8 or more, the rarest fifth of each and one more share an item.
  SELECT id, n, item FROM ranked WHERE nth <= n - (80 * n + 99) // 100 + 1
), pairs AS (
  SELECT DISTINCT x.id AS a, y.id AS b, x.n AS na, y.n AS nb
  FROM rare x JOIN rare y ON x.item = y.item AND x.id < y.id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
), links AS (
  SELECT a, b FROM pairs JOIN items x ON x.id = a JOIN items y ON y.id = b AND y.item = x.item GROUP BY a, b, na, nb HAVING 100 * count(*) >= 80 * (na + nb - count(*))
), sides AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT a AS id, a AS other FROM sides UNION SELECT r.id, s.b FROM reached r JOIN sides s ON s.a = r.other
), labels AS (
  SELECT id, min(other) AS component FROM reached GROUP BY id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(component, rep) AS component_id, coalesce(component, rep) = doc_id AS kept
FROM members LEFT JOIN labels ON id = rep
"""

#: Tokens that the same labelled pages have are one class; of the classes that stand under both labels every set that a page has is listed.
URL_RULES = r"""
WITH parts AS (
  SELECT row_number() OVER () AS row, page_id, url, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host
  FROM pages
), pieces AS (
  SELECT *, CASE WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/' WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule,
    string_split(host, '.') AS labels, string_split(regexp_replace(regexp_extract(url, '(?s)\?([^#]*)', 1), '[0-9]{3,}', '#', 'g'), '&') AS query
  FROM parts
), tagged AS (
  SELECT row, page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS said,
    CASE WHEN host = '' THEN [] ELSE
      list_transform(list_filter(labels, lambda x: x <> ''), lambda x: 'host=' || x)
      || list_transform(list_filter(string_split(array_to_string(list_filter(labels, lambda x: contains(x, '-')), '-'), '-'), lambda x: x <> ''), lambda x: 'word=' || x)
      || list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'path=' || regexp_replace(lower(x), '[0-9]+', '#', 'g'))
      || list_transform(list_filter(query, lambda x: x <> ''), lambda x: 'query=' || x)
      || list_transform(list_filter(query, lambda x: split_part(x, '=', 1) <> ''), lambda x: 'key=' || split_part(x, '=', 1))
      || list_transform(list_filter([regexp_extract(url, '(?s)#(.*)$', 1)], lambda x: x <> ''), lambda x: 'fragment=' || x)
      || list_transform(list_filter([lower(regexp_extract(url, '(?s)^(.*?)://', 1))], lambda x: x <> ''), lambda x: 'scheme=' || x) END AS tokens
  FROM pieces
), judged AS (
  SELECT * EXCLUDE tokens, list_sort(list_distinct(tokens)) AS tokens FROM tagged
), labelled AS (
  SELECT count(*) AS n, ceil(CAST(0.002 AS DOUBLE) * count(*)) AS least, CASE WHEN count(*) FILTER (said = 'block') > count(*) FILTER (said = 'allow') THEN 'block' ELSE 'allow' END AS common
  FROM judged WHERE said IS NOT NULL
), places AS (
  SELECT token, list(row ORDER BY row) AS places, count(*) FILTER (said = 'allow') AS allow, count(*) FILTER (said = 'block') AS block
  FROM (SELECT row, said, unnest(tokens) AS token FROM judged WHERE said IS NOT NULL) GROUP BY token
), classes AS (
  SELECT min(token) AS class, list(token) AS members, min(allow) AS allow, min(block) AS block FROM places, labelled WHERE greatest(allow, block) >= least GROUP BY places
), of AS (
  SELECT row, said, class, max(token) AS shown, allow > 0 AND block > 0 AS mixed
  FROM (SELECT row, said, unnest(tokens) AS token FROM judged) JOIN (SELECT class, unnest(members) AS token, allow, block FROM classes) USING (token) GROUP BY row, said, class, mixed
), baskets AS (
  SELECT row, said, list(class ORDER BY class) AS items FROM of WHERE mixed AND said IS NOT NULL GROUP BY row, said
), subsets AS (
  SELECT said, list_where(items, list_transform(range(1, len(items) + 1), lambda i: (mask >> (i - 1)) & 1 = 1)) AS antecedent
  FROM (SELECT said, items, unnest(range(1, CAST(2 ** len(items) AS BIGINT))) AS mask FROM baskets)
), frequent AS (
  SELECT antecedent, said, count(*) AS often, sum(count(*)) OVER (PARTITION BY antecedent) AS freq FROM subsets GROUP BY antecedent, said
), rules AS (
  SELECT antecedent, said AS says, CAST(often AS DOUBLE) / CAST(freq AS DOUBLE) AS sure, CAST(often AS DOUBLE) / CAST(n AS DOUBLE) AS support
  FROM frequent, labelled WHERE often >= least AND CAST(often AS DOUBLE) / CAST(freq AS DOUBLE) >= CAST(0.8 AS DOUBLE)
), shorter AS (
  SELECT antecedent AS longer, says, sure, list_where(antecedent, list_transform(range(1, len(antecedent) + 1), lambda i: i <> gone)) AS antecedent
  FROM (SELECT *, unnest(range(1, len(antecedent) + 1)) AS gone FROM rules)
), needless AS (
  SELECT DISTINCT s.longer, s.says FROM shorter s JOIN rules r ON r.antecedent = s.antecedent AND r.says = s.says AND r.sure >= s.sure
), index AS (
  SELECT row_number() OVER () AS id, antecedent, says, sure, support FROM (
    SELECT * FROM rules r WHERE NOT EXISTS (SELECT 1 FROM needless WHERE longer = r.antecedent AND needless.says = r.says)
    UNION ALL SELECT [class], CASE WHEN block = 0 THEN 'allow' ELSE 'block' END, CAST(1 AS DOUBLE), CAST(allow + block AS DOUBLE) / CAST(n AS DOUBLE) FROM classes, labelled WHERE allow = 0 OR block = 0)
), parts_of AS (
  SELECT id, len(antecedent) AS size, unnest(antecedent) AS class FROM index
), hits AS (
  SELECT row, id, array_to_string(list(shown ORDER BY shown), ' ') AS mined_rule FROM of JOIN parts_of USING (class) WHERE said IS NULL GROUP BY row, id, size HAVING count(*) = size
), best AS (
  SELECT row, says, sure, mined_rule FROM hits JOIN index USING (id)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY sure DESC, support DESC, len(antecedent) DESC, mined_rule DESC, says DESC) = 1
)
SELECT page_id, host, path, rule, coalesce(said, says, common) AS verdict, mined_rule, sure AS confidence FROM judged LEFT JOIN best USING (row), labelled
"""

ORACLE_SQL = {"op6_setsketch": NEAR_DUPLICATES, "op8_url_rules": URL_RULES}
