"""DuckDB SQL for the operators that it can express, on the same tables.

The Merkle manifest: the checksum of an id bit by bit, leaves, the trees of the sources and
the tree over them level by level, then each leaf's climb along its siblings.
"""

MERKLE_MANIFEST = """
WITH RECURSIVE crc AS (
    SELECT id, 0 AS k, 4294967295::BIGINT AS c
    FROM (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), '') AS id FROM documents)
    UNION ALL
    SELECT id, k + 1, list_reduce(
        [xor(c, ascii(substr(id, k + 1, 1))::BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))
    FROM crc WHERE k < length(id)
), even AS (
    SELECT id FROM crc WHERE k = length(id) AND xor(c, 4294967295) % 2 = 0
), fields AS (
    SELECT doc_id, coalesce('=' || source, '') AS key, text,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
           || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
           CASE WHEN coalesce(CAST(doc_id AS VARCHAR), '') IN (SELECT id FROM even)
                THEN replace(text, chr(10), '') ELSE text END AS tampered
    FROM documents
), leaves AS (
    SELECT doc_id, key, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(strlen(tampered) || ':' || tampered, '-')) AS changed
    FROM fields
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY key) AS n
    FROM leaves
), tree AS (
    SELECT 0 AS level, key, pos, n, leaf AS node FROM placed
    UNION ALL
    SELECT level + 1, key, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
    FROM tree WHERE n > 1 GROUP BY level, key, pos // 3
), subroots AS (
    SELECT key, node, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n
    FROM tree WHERE n = 1
), forest AS (
    SELECT 0 AS level, pos, n, node FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
    FROM forest WHERE n > 1 GROUP BY level, pos // 3
), nodes AS (
    SELECT level, key, pos, node FROM tree WHERE n > 1
    UNION ALL
    SELECT level, 'forest', pos, node FROM forest WHERE n > 1
), siblings AS (
    SELECT a.level, a.key, a.pos,
           coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS ahead,
           coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS behind
    FROM nodes AS a JOIN nodes AS b ON a.level = b.level AND a.key = b.key AND a.pos // 3 = b.pos // 3
    GROUP BY a.level, a.key, a.pos
), climb AS (
    SELECT key AS owner, pos AS place, key, 0 AS level, pos, changed AS folded, '' AS proof FROM placed
    UNION ALL
    SELECT owner, place, s.key, s.level + 1, s.pos // 3,
           sha256(s.ahead || folded || s.behind), proof || s.ahead || s.behind
    FROM climb JOIN siblings AS s ON s.level = climb.level AND s.key = climb.key AND s.pos = climb.pos
), halfway AS (
    SELECT owner, place, folded, proof FROM climb
    QUALIFY row_number() OVER (PARTITION BY owner, place ORDER BY level DESC) = 1
), upper AS (
    SELECT owner, place, 0 AS level, r.pos, folded, proof FROM halfway JOIN subroots AS r ON r.key = owner
    UNION ALL
    SELECT owner, place, s.level + 1, s.pos // 3,
           sha256(s.ahead || folded || s.behind), proof || s.ahead || s.behind
    FROM upper JOIN siblings AS s ON s.level = upper.level AND s.key = 'forest' AND s.pos = upper.pos
), top AS (
    SELECT owner, place, folded, proof FROM upper
    QUALIFY row_number() OVER (PARTITION BY owner, place ORDER BY level DESC) = 1
)
SELECT p.doc_id, p.leaf, r.node AS subroot, f.node AS root, sha256(t.proof) AS proof_sha256,
       t.folded AS folded_root, t.folded = f.node AS verified
FROM placed AS p
JOIN subroots AS r ON r.key = p.key
JOIN top AS t ON t.owner = p.key AND t.place = p.pos
CROSS JOIN (SELECT node FROM forest WHERE n = 1) AS f
"""

ORACLE = {"op12_merkle_manifest": MERKLE_MANIFEST}
