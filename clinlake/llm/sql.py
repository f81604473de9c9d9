"""DuckDB SQL of the contract queries that SQL can express."""

# words of documents with their places, lower-cased A-Z where the contract says so
OP8 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE doc_id IS NOT NULL),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS key
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS key
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, n, item FROM occ JOIN win USING (n, key)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP1 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
win AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
repeated AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY key ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM repeated) GROUP BY doc_id),
place AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT place.doc_id, string_agg(x, ' ' ORDER BY place.p) AS t
  FROM place LEFT JOIN (SELECT doc_id, unnest(ps) AS p, true AS out FROM gone) g ON g.doc_id = place.doc_id AND g.p = place.p
  WHERE out IS NULL GROUP BY place.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP7 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE doc_id IS NOT NULL),
sh AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[s:s + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""

OP9 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP5 = r"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(rule, h, q, v) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
judged AS (
  SELECT p.*, (SELECT arg_max(rule, length(rule)) FROM rules WHERE (p.host = h OR suffix(p.host, '.' || h)) AND starts_with(p.path, q)) AS rule
  FROM p),
r AS (SELECT judged.*, v FROM judged LEFT JOIN rules USING (rule)),
paths AS (
  SELECT host, path, count(*) AS n, count(v) AS labelled, count(*) FILTER (v = 'block') AS blocked FROM r GROUP BY host, path),
parts AS (
  SELECT host, path, n, labelled, blocked, string_split(regexp_replace(path, '^/', ''), '/') AS a FROM paths),
shaped AS (
  SELECT *, list_transform(a, lambda x: regexp_replace(regexp_replace(x, '[0-9A-Za-z]*[0-9][0-9A-Za-z]*', '#', 'g'), '[A-Za-z]+', 'a', 'g')) AS sh FROM parts),
segs AS (
  SELECT host, path, n, labelled, blocked, i AS depth, a[i + 1] AS literal, array_to_string(sh[1:i], '/') AS above, sh[i + 1] AS shape
  FROM (SELECT *, unnest(range(len(a))) AS i FROM shaped)),
child AS (
  SELECT host, depth, above, shape, literal, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked
  FROM segs GROUP BY host, depth, above, shape, literal),
node AS (
  SELECT host, depth, above, shape, sum(n) AS nn, (sum(blocked) + 1)::DOUBLE / (sum(labelled) + 2) AS rate
  FROM child GROUP BY host, depth, above, shape),
kept AS (
  SELECT host, depth, above, shape, literal, true AS keep FROM child JOIN node USING (host, depth, above, shape)
  WHERE n >= 5 AND n >= 0.01::DOUBLE * nn AND labelled > 0
    AND (blocked - labelled * rate) * (blocked - labelled * rate) > 3.84::DOUBLE * labelled * rate * (1 - rate)),
ways AS (
  SELECT host, path, any_value(segs.n) AS n, any_value(segs.labelled) AS labelled, any_value(segs.blocked) AS blocked,
         '/' || string_agg(CASE WHEN keep THEN literal ELSE '*' END, '/' ORDER BY depth) AS template
  FROM segs LEFT JOIN kept USING (host, depth, above, shape, literal) GROUP BY host, path),
base AS (SELECT (coalesce(sum(blocked), 0) + 1)::DOUBLE / (coalesce(sum(labelled), 0) + 2) AS g FROM paths),
hosts AS (SELECT host, (sum(blocked) + 2 * any_value(g)) / (sum(labelled) + 2) AS prior FROM paths, base GROUP BY host),
bad AS (
  SELECT host, template, true AS bad
  FROM (SELECT host, template, sum(n) AS n, sum(labelled) AS l, sum(blocked) AS b FROM ways GROUP BY host, template) JOIN hosts USING (host)
  WHERE l >= 3 AND l >= 0.1::DOUBLE * n AND (b + 4 * prior) / (l + 4) >= 0.8)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict, template
FROM r JOIN ways USING (host, path) LEFT JOIN bad USING (host, template)
"""

OP11 = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256('1:' || CAST(doc_id AS VARCHAR)) AS h
  FROM documents),
draw AS (
  SELECT doc_id, t, w, CAST(len(w) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS b,
         CASE WHEN h IS NULL OR t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(w[1:least(a, b)], '') AS p,
         array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(w[greatest(a, b) + 1:], '') AS s
  FROM draw)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                        ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


def _op13(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """The rounds written out: vectors and centroids are lists, distances sums over the places of a list."""
    parts = [f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = {dim} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dim}),
vals AS (SELECT r, unnest(v) AS x, unnest(range(1, {dim + 1})) AS d FROM kept),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), v) - 1 AS INTEGER) AS c, v
       FROM (SELECT vec_id, v FROM kept ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), v LIMIT {k}))"""]
    for i in range(rounds + 1):
        parts.append(f"""
x{i} AS (SELECT c, unnest(v) AS x, unnest(range(1, {dim + 1})) AS d FROM c{i}),
d{i} AS (SELECT r, c, sum((vals.x - x{i}.x) * (vals.x - x{i}.x)) AS dist FROM vals JOIN x{i} USING (d) GROUP BY r, c),
a{i} AS (SELECT r, min(struct_pack(dist := dist, c := c)) AS b FROM d{i} GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
m{i} AS (SELECT b.c AS c, d, sum(x) AS s, count(*) AS n FROM a{i} JOIN vals USING (r) GROUP BY b.c, d),
n{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY d) AS v FROM m{i} GROUP BY c),
c{i + 1} AS (SELECT c, CAST(coalesce(n{i}.v, c{i}.v) AS BIGINT[]) AS v FROM c{i} LEFT JOIN n{i} USING (c))""")
    return ",".join(parts) + f"""
SELECT vec_id, b.c AS cluster, CAST(b.dist AS BIGINT) AS distance, CAST(sum(b.dist) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(b.dist) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} ON c{rounds}.c = b.c
"""


OP13 = _op13()

# For pages whose main text is one <article> of headings, paragraphs, line breaks and inline elements, and the references
# that the given tables hold.  Other pages are tested by hand-made ones.
OP12 = r"""
WITH a AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '') AS t FROM pages),
plain AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '</?(h1|p|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS t FROM a),
decoded AS (
  SELECT page_id, url, regexp_replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS t FROM plain),
spaced AS (
  SELECT page_id, url, trim(regexp_replace(t, '[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+',
                                           ' ', 'g')) AS t FROM decoded)
SELECT page_id, url, t AS text, CAST(length(t) AS BIGINT) AS n_chars FROM spaced
"""
