"""DuckDB SQL for those registered queries that SQL can express."""

from __future__ import annotations

from wardflow.llm.licenses import CONTAINMENT, LONG, PHRASES, TEMPLATES


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in row) + ")"
                     for row in rows)


OP9 = r"""
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         [5.0::DOUBLE, 2.0, 1.0][
           ((row_number() OVER (ORDER BY encode(source) NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM totals),
ordered AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS held,
         (SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0) AS free,
         (SELECT 1.5::DOUBLE * sum(source_size) FROM weighed) AS total,
         row_number() OVER (ORDER BY cap / weight, source) AS place
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT arg_min((total - held) / free, place) AS level FROM ordered
           WHERE (total - held) / free <= cap / weight),
plan AS (
  SELECT source, source_size, least(cap, weight * level) AS target,
         CASE WHEN source_size > 0 THEN least(cap, weight * level) / source_size ELSE 0 END AS rate
  FROM weighed, levels)
SELECT s.doc_id, s.size, p.source_size, p.target,
       s.size * (floor(p.rate)::BIGINT
         + (('0x' || substr(md5('0:' || coalesce(s.doc_id::VARCHAR, '')), 1, 13))::BIGINT
            / 4503599627370496.0::DOUBLE < p.rate - floor(p.rate))::BIGINT) AS taken
FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
"""

OP10 = r"""
WITH rests AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
                       ELSE '' END AS rest FROM pages),
cut AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM rests),
named AS (
  SELECT *, regexp_replace(regexp_replace(query, '(^|&)(utm_[^=&]*|ref)=[^&]*', '', 'g'), '^&', '')
            AS params FROM cut),
canonical AS (
  SELECT page_id, host, path,
         regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
         || CASE WHEN params <> '' THEN '?' || params ELSE '' END AS name FROM named),
listed AS (SELECT DISTINCT name FROM canonical
           WHERE regexp_matches(host, 'casino|pills|bets|spam|ads-') AND name <> ''),
judged AS (
  SELECT *, '.' || host AS dotted, name IN (SELECT name FROM listed) AS is_listed FROM canonical),
ruled AS (
  SELECT *, CASE
    WHEN dotted LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN dotted LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN dotted LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN dotted LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN dotted LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule FROM judged)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN is_listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

OP4 = r'''
WITH cut AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 33, 1))) AS i FROM cut WHERE len(w) >= 35),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM starts),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows WHERE h IN (SELECT h FROM twice)),
lost AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT c.doc_id, len(c.w)::BIGINT AS n_words, coalesce(l.n, 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN l.n IS NULL THEN c.w ELSE
         list_transform(list_filter(range(1, len(c.w) + 1), lambda p: NOT list_contains(l.ps, p)),
                        lambda p: c.w[p]) END, ' ')) AS kept_sha256
FROM cut c LEFT JOIN lost l USING (doc_id)
'''

OP5 = r'''
WITH RECURSIVE cut AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
  FROM cut),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingles x JOIN shingles y ON x.s = y.s
  AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM met JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT DISTINCT a AS node, a AS seen FROM edges
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen),
least AS (SELECT node, min(seen) AS c FROM reach GROUP BY node)
SELECT c.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(l.c, c.doc_id) AS component_id,
       coalesce(l.c, c.doc_id) = c.doc_id AS kept
FROM cut c LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.node = c.doc_id
'''

OP7 = r'''
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
usable AS (
  SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM vectors
  WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
edges AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
  ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.v, y.v) / (x.norm * y.norm) >= 0.93),
reach AS (
  SELECT DISTINCT a AS node, a AS seen FROM edges
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen),
least AS (SELECT node, min(seen) AS c FROM reach GROUP BY node),
degrees AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id,
       coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN degrees ON a = vec_id LEFT JOIN least ON node = vec_id
'''

OP11 = r'''
WITH RECURSIVE rows AS (
  SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text FROM documents),
crc AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
           string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) ELSE
           xor(a >> 1, 3988292384::BIGINT * (a & 1)) END), 4294967295::BIGINT) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(text) || ':' || CASE WHEN crc % 5 = 0 THEN
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           ELSE text END, '-')) AS seen
  FROM rows LEFT JOIN crc USING (doc_id)),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
         count(*) OVER (PARTITION BY source) AS n FROM hashed),
nodes AS (
  SELECT source, 0 AS level, rank, leaf AS h, n FROM leaves
  UNION ALL
  SELECT source, level + 1, rank // 16, sha256(string_agg(h, '' ORDER BY rank)), (n + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY source, level, rank // 16, n),
subroots AS (
  SELECT source, level AS depth, h AS subroot,
         row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, place AS rank, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, rank // 16, sha256(string_agg(h, '' ORDER BY rank)), (n + 15) // 16
  FROM tops WHERE n > 1 GROUP BY level, rank // 16, n),
runs AS (
  SELECT source, level, rank // 16 AS parent, string_agg(h, '' ORDER BY rank) AS run
  FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (
  SELECT level, rank // 16 AS parent, string_agg(h, '' ORDER BY rank) AS run
  FROM tops WHERE n > 1 GROUP BY ALL),
climbs AS (
  SELECT l.doc_id, l.source, l.leaf, l.rank AS own, 0 AS level, l.rank, l.seen AS node, '' AS proof
  FROM leaves l
  UNION ALL
  SELECT c.doc_id, c.source, c.leaf, c.own, c.level + 1, c.rank // 16,
         sha256(substr(r.run, 1, 64 * (c.rank % 16)) || c.node || substr(r.run, 64 * (c.rank % 16) + 65)),
         c.proof || substr(r.run, 1, 64 * (c.rank % 16)) || substr(r.run, 64 * (c.rank % 16) + 65)
  FROM climbs c JOIN runs r ON c.source IS NOT DISTINCT FROM r.source AND c.level = r.level
       AND c.rank // 16 = r.parent),
over AS (
  SELECT c.doc_id, c.source, c.leaf, c.own, s.subroot, 0 AS level, s.place AS rank, c.node, c.proof
  FROM climbs c JOIN subroots s ON c.source IS NOT DISTINCT FROM s.source AND c.level = s.depth
  UNION ALL
  SELECT c.doc_id, c.source, c.leaf, c.own, c.subroot, c.level + 1, c.rank // 16,
         sha256(substr(r.run, 1, 64 * (c.rank % 16)) || c.node || substr(r.run, 64 * (c.rank % 16) + 65)),
         c.proof || substr(r.run, 1, 64 * (c.rank % 16)) || substr(r.run, 64 * (c.rank % 16) + 65)
  FROM over c JOIN top_runs r ON c.level = r.level AND c.rank // 16 = r.parent)
SELECT o.doc_id, o.leaf, o.subroot, t.h AS root, sha256(o.proof) AS proof_sha256,
       o.node AS folded_root, o.node = t.h AS verified
FROM over o JOIN tops t ON t.n = 1 AND o.level = t.level
'''

OP12 = rf'''
WITH phrases(phrase, name) AS (VALUES {_values(PHRASES.items())}),
templates(family, label, text) AS (VALUES {_values(TEMPLATES)}),
lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
cut AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM lowered),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM cut),
places AS (
  SELECT doc_id, i - 1 AS place, name FROM starts JOIN phrases
  ON w[i:i + len(string_split(phrase, ' ')) - 1] = string_split(phrase, ' ')),
base AS (
  SELECT doc_id, count(*) AS n, min(place) AS a, max(place) AS z, list(DISTINCT name) AS names
  FROM places GROUP BY doc_id),
sentences AS (
  SELECT doc_id, regexp_extract_all(
    unnest(string_split_regex(text, '[.!?;:]+[\x20\x09-\x0D]+|\n[\x20\x09\x0D]*\n')),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
blocks AS (
  SELECT doc_id, list_distinct(unnest(CASE WHEN len(w) <= {LONG} THEN [w] ELSE
    list_transform(range(1, len(w) + 1, {LONG // 2}), lambda i: w[i:i + {LONG - 1}]) END)) AS b
  FROM sentences),
numbered AS (SELECT doc_id, b, row_number() OVER () AS block FROM blocks),
sets AS (
  SELECT family, label, list_distinct(regexp_extract_all(translate(
    text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM templates),
pairs AS (
  SELECT doc_id, block, family, label, len(list_intersect(b, t)) AS shared, len(t) AS size
  FROM numbered JOIN sets ON len(list_intersect(b, t)) >= {CONTAINMENT} * len(t)),
ordered AS (
  SELECT *, rank() OVER (PARTITION BY block, family ORDER BY shared / size DESC, shared DESC) AS r
  FROM pairs),
found AS (SELECT doc_id, list(DISTINCT label) AS names, max(shared / size) AS most
          FROM ordered WHERE r = 1 GROUP BY doc_id)
SELECT c.doc_id, len(c.w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base,
       b.a::BIGINT AS first_word, b.z::BIGINT AS last_word,
       array_to_string(list_sort(coalesce(b.names, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(coalesce(b.names, []) || coalesce(f.names, []))), ',')
         AS labels,
       CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(f.most, 0)::DOUBLE END AS score
FROM cut c LEFT JOIN base b USING (doc_id) LEFT JOIN found f USING (doc_id)
'''

ORACLES = {"op7_embedding_near_dedup": OP7, "op4_substring_dedup": OP4, "op5_minhash_near_dedup": OP5, "op9_source_mixture": OP9, "op10_url_filter": OP10,
           "op11_merkle_manifest": OP11, "op12_license_scan": OP12}
