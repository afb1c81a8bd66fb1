"""DuckDB SQL that must give the rows of the registered queries."""

LEAKS_SQL = r"""
WITH fold AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n,
         array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i
        FROM item WHERE len(w) > 0)),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM fold, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (
  SELECT p.doc_id, p.i, p.n, w.item FROM places p JOIN win w ON p.n = w.n AND p.s = w.s),
covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT f.doc_id, CAST(len(f.w) AS BIGINT) AS n_words,
       CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(n.names, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM fold f LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

MIX_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS seeded
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS k FROM doc GROUP BY source),
weighed AS (
  SELECT *, CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM src),
ranked AS (
  SELECT *, 3 * source_size / weight AS full_at,
         row_number() OVER (ORDER BY 3 * source_size / weight, k) AS nth,
         coalesce(sum(3 * source_size) OVER before, 0) AS gone,
         coalesce(sum(weight) OVER before, 0) AS gone_weight
  FROM weighed
  WINDOW before AS (ORDER BY 3 * source_size / weight, k
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM src) - gone)
            / ((SELECT sum(weight) FROM weighed) - gone_weight) AS level FROM ranked),
level AS (
  SELECT coalesce(arg_min(level, nth) FILTER (WHERE full_at >= level),
                  arg_max(level, nth)) AS level FROM levels),
plan AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS passes,
         words - CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END * source_size AS rest
  FROM (SELECT source, source_size, target,
               least(CAST(floor(target + 0.5) AS BIGINT), 3 * source_size) AS words
        FROM (SELECT source, source_size,
                     least(CAST(3 * source_size AS DOUBLE), level * weight) AS target
              FROM weighed, level))),
placed AS (
  SELECT d.doc_id, d.source, d.size, d.seeded, p.source_size, p.target, p.passes, p.rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.seeded) AS after
  FROM doc d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
owing AS (
  SELECT source, any_value(rest) - coalesce(max(after) FILTER (WHERE after <= rest), 0) AS owed
  FROM placed GROUP BY source),
behind AS (
  SELECT p.source, size, seeded FROM placed p JOIN owing o ON p.source IS NOT DISTINCT FROM o.source
  WHERE after > rest AND size > 0 AND size < 2 * owed),
sizes AS (
  SELECT source, list({'size': size, 'n': n} ORDER BY size DESC) AS sizes
  FROM (SELECT source, size, count(*) AS n FROM behind GROUP BY source, size) GROUP BY source),
step AS (
  SELECT s.source, sizes, 0 AS i, CAST(owed AS BIGINT) AS owed, CAST(0 AS BIGINT) AS n
  FROM sizes s JOIN owing o ON s.source IS NOT DISTINCT FROM o.source
  UNION ALL
  SELECT source, sizes, i + 1, owed - sizes[i + 1].size * least(sizes[i + 1].n,
           owed // sizes[i + 1].size), CAST(least(sizes[i + 1].n, owed // sizes[i + 1].size) AS BIGINT)
  FROM step WHERE i < len(sizes)),
longer AS (
  SELECT e.source, min(t.sizes[t.i].size) AS size, any_value(e.owed) AS owed
  FROM step e JOIN step t ON e.source IS NOT DISTINCT FROM t.source AND t.i > 0
    AND e.i = len(e.sizes) AND t.sizes[t.i].size > e.owed AND t.n < t.sizes[t.i].n
  GROUP BY e.source),
picked AS (
  SELECT t.source, t.sizes[t.i].size AS size,
         t.n + CASE WHEN l.size = t.sizes[t.i].size AND l.size - l.owed < l.owed THEN 1 ELSE 0 END AS n
  FROM step t LEFT JOIN longer l ON t.source IS NOT DISTINCT FROM l.source WHERE t.i > 0),
filling AS (
  SELECT DISTINCT b.source, b.seeded
  FROM (SELECT *, count(*) OVER (PARTITION BY source, size ORDER BY seeded) AS nth FROM behind) b
  JOIN picked p ON b.source IS NOT DISTINCT FROM p.source AND b.size = p.size AND nth <= p.n)
SELECT p.doc_id, p.size, p.source_size, p.target,
       CAST(p.size * least(passes + CASE WHEN after <= rest OR f.seeded IS NOT NULL
                                         THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM placed p LEFT JOIN filling f
  ON p.source IS NOT DISTINCT FROM f.source AND p.seeded = f.seeded
"""

TOPK_SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(
           embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(
                list_zip(q.w, c.w), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)
              AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""


def license_sql(templates: list[tuple[str, str]], similarity: float, share: float) -> str:
    """The licence scan, with the templates as values; relational where Spark maps over arrays."""
    values = ",\n    ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''"))
                            for k, (name, text) in enumerate(sorted(templates)))
    return rf"""
WITH fold AS (
  SELECT row_number() OVER () AS r, doc_id,
         '/' || coalesce(source, '_') || '/' || coalesce(lang, '_')
             || regexp_replace(coalesce(CAST(doc_id AS VARCHAR), '_'), '(.)', '/\1', 'g') AS path,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
template AS (SELECT * FROM (VALUES
    {values}) v(k, name, body)),
tword AS (SELECT k, w, count(*) AS n
          FROM (SELECT k, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS w FROM template)
          GROUP BY k, w),
total AS (SELECT count(*) AS n FROM fold),
held AS (SELECT w, count(*) AS n
         FROM (SELECT DISTINCT r, unnest(regexp_extract_all(t, '[a-z0-9]+')) AS w FROM fold)
         WHERE w IN (SELECT w FROM tword) GROUP BY w),
idf AS (SELECT v.w, ln((1 + total.n) / (1 + coalesce(held.n, 0))) + 1 AS idf
        FROM (SELECT DISTINCT w FROM tword) v LEFT JOIN held USING (w), total),
tvec AS (SELECT k, w, tword.n * idf AS x,
                sqrt(sum(tword.n * idf * tword.n * idf) OVER (PARTITION BY k)) AS length
         FROM tword JOIN idf USING (w)),
line AS (
  SELECT r, unnest(range(len(parts))) AS l, unnest(parts) AS line
  FROM (SELECT r, string_split(regexp_replace(regexp_replace(t, '([.!?;])[ \t\r\n\f]+',
                 '\1' || chr(10), 'g'), '[\r\n]+', chr(10), 'g'), chr(10)) AS parts FROM fold)),
lword AS (SELECT r, l, w, count(*) AS n
          FROM (SELECT r, l, unnest(regexp_extract_all(line, '[a-z0-9]+')) AS w FROM line)
          GROUP BY r, l, w),
lvec AS (SELECT r, l, w, n, n * coalesce(idf, ln(1 + (SELECT n FROM total)) + 1) AS x
         FROM lword LEFT JOIN idf USING (w)),
llen AS (SELECT r, l, sqrt(sum(x * x)) AS length, sum(n) AS words FROM lvec GROUP BY r, l),
near AS (SELECT r, l, k, sum(lvec.x * tvec.x) / any_value(tvec.length) AS dot
         FROM lvec JOIN tvec USING (w) GROUP BY r, l, k),
scored AS (SELECT near.r, near.l, near.k, words, round(dot / length, 6) AS similarity
           FROM near JOIN llen USING (r, l)),
notice AS (SELECT s.*, name FROM scored s JOIN template USING (k)
           WHERE similarity >= {similarity}
           QUALIFY row_number() OVER (PARTITION BY r, l ORDER BY similarity DESC, k) = 1),
best AS (SELECT r, arg_min(name, nth) AS own_license, arg_min(similarity, nth) AS similarity,
                sum(words) AS said
         FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY similarity DESC, l) AS nth
               FROM notice) GROUP BY r),
words AS (SELECT r, sum(words) AS words FROM llen GROUP BY r),
own AS (SELECT f.r, f.doc_id, f.path, regexp_replace(f.path, '/?[^/]*$', '') AS dir,
               own_license, similarity,
               own_license IS NOT NULL AND coalesce(said >= words * {share}, FALSE) AS license_file
        FROM fold f LEFT JOIN best USING (r) LEFT JOIN words USING (r)),
of_dir AS (SELECT dir AS above, arg_min(own_license, nth) AS held
           FROM (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY similarity DESC,
                        own_license) AS nth FROM own WHERE license_file) GROUP BY dir),
ups AS (SELECT dir, unnest(list_transform(range(1, len(string_split(dir, '/')) + 1),
               lambda k: array_to_string(string_split(dir, '/')[1:k], '/'))) AS above
        FROM (SELECT DISTINCT dir FROM own)),
nearest AS (SELECT dir, arg_max(above, length(above)) AS from_dir,
                   arg_max(held, length(above)) AS held
            FROM ups JOIN of_dir USING (above) GROUP BY dir)
SELECT doc_id, path, own_license, similarity, license_file,
       coalesce(own_license, held) AS license,
       CASE WHEN own_license IS NULL THEN from_dir END AS inherited_from
FROM own LEFT JOIN nearest USING (dir)
"""

MANIFEST_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('+' || source, '') AS tree,
         ['' || doc_id, source, lang, '' || n_chars, text] AS fields,
         CASE WHEN xor(list_reduce(string_split('' || doc_id, ''), lambda crc, digit:
                list_reduce(range(8), lambda x, k:
                  CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
                  xor(crc, CAST(ascii(digit) AS BIGINT))),
                CAST(4294967295 AS BIGINT)), 4294967295) % 2 = 0
              THEN replace(text, chr(10), '') ELSE text END AS presented
  FROM documents),
digest AS (
  SELECT r, doc_id, tree,
         sha256(array_to_string(list_transform(fields, lambda f:
           coalesce(strlen(f) || ':' || f, '-')), '')) AS leaf,
         sha256(array_to_string(list_transform(fields[1:4] || [presented], lambda f:
           coalesce(strlen(f) || ':' || f, '-')), '')) AS shown
  FROM doc),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM digest),
level AS (
  SELECT tree, 0 AS up, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY tree
  UNION ALL
  SELECT tree, up + 1, list_transform(range((len(nodes) + 2) // 3), lambda k:
           sha256(array_to_string(nodes[3 * k + 1:3 * k + 3], '')))
  FROM level WHERE len(nodes) > 1),
subroot AS (
  SELECT tree, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place
  FROM level WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS up, list(subroot ORDER BY place) AS nodes FROM subroot HAVING count(*) > 0
  UNION ALL
  SELECT up + 1, list_transform(range((len(nodes) + 2) // 3), lambda k:
           sha256(array_to_string(nodes[3 * k + 1:3 * k + 3], '')))
  FROM top WHERE len(nodes) > 1),
run AS (
  SELECT tree, up, k, nodes[3 * k + 1:3 * k + 3] AS nodes
  FROM (SELECT *, unnest(range((len(nodes) + 2) // 3)) AS k FROM level WHERE len(nodes) > 1)),
upper_run AS (
  SELECT up, k, nodes[3 * k + 1:3 * k + 3] AS nodes
  FROM (SELECT *, unnest(range((len(nodes) + 2) // 3)) AS k FROM top WHERE len(nodes) > 1)),
climb AS (
  SELECT r, tree, 0 AS up, pos, shown AS node, '' AS siblings FROM placed
  UNION ALL
  SELECT c.r, c.tree, c.up + 1, c.pos // 3,
         sha256(array_to_string(list_transform(range(len(nodes)), lambda k:
           CASE WHEN k = c.pos % 3 THEN c.node ELSE nodes[k + 1] END), '')),
         c.siblings || array_to_string(list_transform(range(len(nodes)), lambda k:
           CASE WHEN k = c.pos % 3 THEN '' ELSE nodes[k + 1] END), '')
  FROM climb c JOIN run ON run.tree = c.tree AND run.up = c.up AND run.k = c.pos // 3),
arrived AS (
  SELECT c.* FROM climb c JOIN level l ON l.tree = c.tree AND l.up = c.up AND len(l.nodes) = 1),
upper_climb AS (
  SELECT r, 0 AS up, s.place AS pos, node, siblings FROM arrived JOIN subroot s USING (tree)
  UNION ALL
  SELECT c.r, c.up + 1, c.pos // 3,
         sha256(array_to_string(list_transform(range(len(nodes)), lambda k:
           CASE WHEN k = c.pos % 3 THEN c.node ELSE nodes[k + 1] END), '')),
         c.siblings || array_to_string(list_transform(range(len(nodes)), lambda k:
           CASE WHEN k = c.pos % 3 THEN '' ELSE nodes[k + 1] END), '')
  FROM upper_climb c JOIN upper_run u ON u.up = c.up AND u.k = c.pos // 3),
root AS (SELECT up, nodes[1] AS root FROM top WHERE len(nodes) = 1)
SELECT p.doc_id, p.leaf, s.subroot, root.root, sha256(c.siblings) AS proof_sha256,
       c.node AS folded_root, c.node = root.root AS verified
FROM placed p JOIN subroot s USING (tree) JOIN upper_climb c USING (r) JOIN root ON root.up = c.up
"""

COLLOCATIONS_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')),
         '[^\x20\x09]+') AS w
  FROM documents),
gram AS (
  SELECT lang, size, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS f
  FROM (SELECT lang, size, w[i:i + size - 1] AS g
        FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
              FROM piece, (SELECT unnest(range(1, 5)) AS size)))
  GROUP BY lang, size, phrase),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM gram WHERE size = 1 GROUP BY lang),
candidate AS (SELECT lang, size, phrase, g, f AS a FROM gram WHERE size > 1 AND f >= 30),
cut AS (
  SELECT c.lang, c.phrase, c.size, c.a, k, lf.f AS l, rf.f AS r,
         CAST(CAST(2000000 AS HUGEINT) * c.a // (lf.f + rf.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate) c
  JOIN gram lf ON lf.lang = c.lang AND lf.phrase = array_to_string(c.g[1:k], ' ')
  JOIN gram rf ON rf.lang = c.lang AND rf.phrase = array_to_string(c.g[k + 1:c.size], ' ')),
scored AS (SELECT * FROM cut
           QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
holding AS (
  SELECT lang, part, max(a) AS longer
  FROM (SELECT lang, a, array_to_string(g[i:i + m - 1], ' ') AS part
        FROM (SELECT *, unnest(range(1, size - m + 2)) AS i
              FROM (SELECT *, unnest(range(2, size)) AS m FROM candidate)))
  GROUP BY lang, part)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang
                                  ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score
FROM scored s JOIN total USING (lang)
LEFT JOIN holding h ON h.lang = s.lang AND h.part = s.phrase
WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)
QUALIFY rank <= 2000
"""


def url_sql(rules: list[tuple[str, str, str]], default: str) -> str:
    """URLs against every rule, with the rules as values."""
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in rules)
    return rf"""
WITH page AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
place AS (
  SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM page),
rules AS (SELECT * FROM (VALUES {values}) v(rule_host, rule_path, verdict)),
fitting AS (
  SELECT place.*, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC,
                            length(rule_host) DESC, verdict DESC) AS nth
  FROM place LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict
FROM fitting WHERE nth = 1
"""
