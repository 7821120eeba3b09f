"""DuckDB SQL of the longer queries."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CONTAMINATION_SQL = rf"""
WITH dw AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS id,
    regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), items AS (
  SELECT row_number() OVER () AS item, id, w, least(10, len(w)) AS n FROM iw WHERE len(w) > 0
), win AS (
  SELECT item, id, n, s, list_slice(w, s, s + n - 1) AS k
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM items)
), dwin AS (
  SELECT rid, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS k
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM dw JOIN (SELECT DISTINCT n FROM win) AS lens ON len(w) >= n)
), hits AS (
  SELECT DISTINCT d.rid, d.s, d.n, win.item, win.id
  FROM dwin AS d JOIN win ON d.k = array_to_string(win.k, ' ')
), covered AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hits) GROUP BY rid
), found AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id, item) AS ids
  FROM (SELECT DISTINCT rid, item, id FROM hits) GROUP BY rid
), places AS (
  SELECT rid, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM dw
), tf AS (
  SELECT t, count(*) AS c FROM places GROUP BY t
), ranked AS (
  SELECT item, s, t, row_number() OVER (PARTITION BY item, s ORDER BY coalesce(c, 0), t) AS r,
    min(coalesce(c, 0)) OVER (PARTITION BY item, s) AS least_c
  FROM (SELECT DISTINCT item, s, unnest(k) AS t FROM win) LEFT JOIN tf USING (t)
), probes AS (
  SELECT DISTINCT item, t1, coalesce(t2, t1) AS t2, coalesce(t3, t1) AS t3 FROM (
    SELECT item, s, max(t) FILTER (r = 1) AS t1, max(t) FILTER (r = 2) AS t2, max(t) FILTER (r = 3) AS t3
    FROM ranked WHERE least_c > 0 GROUP BY item, s)
), lists AS MATERIALIZED (
  SELECT rid, t, list(p) AS ps FROM places
  WHERE t IN (SELECT t1 FROM probes UNION SELECT t2 FROM probes UNION SELECT t3 FROM probes) GROUP BY rid, t
), met AS MATERIALIZED (
  SELECT item, a.rid, a.ps AS p1, b.ps AS p2, c.ps AS p3 FROM probes JOIN lists AS a ON a.t = t1
  JOIN lists AS b ON b.t = t2 AND b.rid = a.rid JOIN lists AS c ON c.t = t3 AND c.rid = a.rid
), near AS (
  SELECT rid, count(DISTINCT item) AS n_near FROM met
  WHERE len(list_filter(list_concat(p1, p2, p3), lambda x: len(list_filter(p1, lambda y: y BETWEEN x AND x + 19)) > 0
    AND len(list_filter(p2, lambda y: y BETWEEN x AND x + 19)) > 0
    AND len(list_filter(p3, lambda y: y BETWEEN x AND x + 19)) > 0)) > 0 GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM dw LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid) LEFT JOIN near USING (rid)
"""

DIVERGENCE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), groups AS (SELECT DISTINCT lang, source FROM d
), words AS (SELECT rid, lang, source, unnest(w) AS t FROM d
), kept AS (SELECT lang, t FROM words GROUP BY lang, t HAVING count(DISTINCT rid) >= 3
), v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), n AS (SELECT lang, source, t, count(*) AS n FROM words SEMI JOIN kept USING (lang, t) GROUP BY ALL
), every AS (
  SELECT lang, source, t, v, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total
  FROM groups JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source, t)
), p AS (
  SELECT lang, source, t, n, 1 + 1000000000::HUGEINT * (n + 1) // (total + v)::HUGEINT AS p FROM every
), q AS (
  SELECT lang, t, 1 + 1000000000::HUGEINT * (n + 1) // (total + v)::HUGEINT AS q FROM (
    SELECT lang, t, v, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM every GROUP BY lang, t, v)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', t, (p - q) * (p - q) // q FROM p JOIN q USING (lang, t) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 200
"""


def _centroid_rounds(rounds: int) -> str:
    out = []
    for i in range(rounds + 1):
        out.append(f"""a{i} AS (
  SELECT rid, min(d) // 64 AS distance, min(d) % 64 AS c
  FROM (SELECT rid, c, sum((x - y) * (x - y)) * 64 + c AS d FROM x JOIN c{i} USING (j) GROUP BY rid, c) GROUP BY rid
)""")
        if i < rounds:
            out.append(f"""c{i + 1} AS (
  SELECT c, j, coalesce(m, y) AS y FROM c{i} LEFT JOIN (
    SELECT c, j, (s - ((s % n + n) % n)) // n AS m
    FROM (SELECT c, j, sum(x) AS s, count(*) AS n FROM a{i} JOIN x USING (rid) GROUP BY c, j)) USING (c, j)
)""")
    return ", ".join(out)


CENTROIDS_SQL = f"""
WITH e AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS (
  SELECT rid, unnest(range(1, 65)) AS j, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM e
), first AS (
  SELECT rid, row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), ''))) - 1 AS c FROM e
), c0 AS (SELECT c, j, x AS y FROM first JOIN x USING (rid) WHERE c < 40
), {_centroid_rounds(5)}, named AS (
  SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c5 GROUP BY c
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a5 JOIN e USING (rid) JOIN named USING (c)
"""
