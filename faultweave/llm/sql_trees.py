"""DuckDB SQL for the hash tree of the documents and the prefix tree of the conversations."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned crc32 of a short ASCII string, bit by bit: a byte is added, then eight shifts."""
    steps = f"flatten(list_transform(range(1, len({text}) + 1), lambda i: [ascii({text}[i]), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}::BIGINT[]), lambda a, b: {step}), 4294967295)"


def _fields(text: str) -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"

    return " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text)))


MERKLE = rf"""
WITH RECURSIVE docs AS MATERIALIZED (
    SELECT *, row_number() OVER () AS r, coalesce(doc_id::VARCHAR, '') AS name FROM documents
), received AS (
    SELECT *, CASE WHEN {crc32("name")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS got FROM docs
), leaves AS MATERIALIZED (
    SELECT r, doc_id, source, sha256({_fields("text")}) AS leaf, sha256({_fields("got")}) AS claimed FROM received
), placed AS MATERIALIZED (
    SELECT *, count(*) OVER (PARTITION BY source) AS n,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM leaves
), nodes AS (
    SELECT source, 0 AS level, pos, leaf AS node, n FROM placed
    UNION ALL
    SELECT source, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
    FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3, n
), kept AS MATERIALIZED (
    SELECT * FROM nodes
), sources AS MATERIALIZED (
    SELECT source, node AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
        count(*) OVER () AS n
    FROM kept WHERE n = 1
), tops AS (
    SELECT 0 AS level, pos, subroot AS node, n FROM sources
    UNION ALL
    SELECT level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
    FROM tops WHERE n > 1 GROUP BY level, pos // 3, n
), top AS MATERIALIZED (
    SELECT * FROM tops
), siblings AS MATERIALIZED (
    SELECT p.r, k.level, k.pos, k.node, k.pos < p.pos // (3 ** k.level)::BIGINT AS is_left
    FROM placed AS p JOIN kept AS k ON k.source IS NOT DISTINCT FROM p.source
        AND k.pos // 3 = p.pos // (3 ** (k.level + 1))::BIGINT AND k.pos <> p.pos // (3 ** k.level)::BIGINT AND k.n > 1
    UNION ALL
    SELECT p.r, s.height + t.level, t.pos, t.node, t.pos < s.pos // (3 ** t.level)::BIGINT
    FROM placed AS p JOIN sources AS s ON s.source IS NOT DISTINCT FROM p.source
    JOIN top AS t ON t.pos // 3 = s.pos // (3 ** (t.level + 1))::BIGINT AND t.pos <> s.pos // (3 ** t.level)::BIGINT AND t.n > 1
), proofs AS (
    SELECT r, sha256(string_agg(node, '' ORDER BY level, pos)) AS proof FROM siblings GROUP BY r
), sides AS MATERIALIZED (
    SELECT r, level, coalesce(string_agg(node, '' ORDER BY pos) FILTER (is_left), '') AS l,
        coalesce(string_agg(node, '' ORDER BY pos) FILTER (NOT is_left), '') AS g
    FROM siblings GROUP BY r, level
), heights AS MATERIALIZED (
    SELECT p.r, p.claimed, s.height + (SELECT max(level) FROM top) AS height
    FROM placed AS p JOIN sources AS s ON s.source IS NOT DISTINCT FROM p.source
), folds AS (
    SELECT r, 0 AS level, claimed AS node, height FROM heights
    UNION ALL
    SELECT f.r, f.level + 1, sha256(coalesce(s.l, '') || f.node || coalesce(s.g, '')), f.height
    FROM folds AS f LEFT JOIN sides AS s ON s.r = f.r AND s.level = f.level WHERE f.level < f.height
), folded AS (
    SELECT r, node FROM folds WHERE level = height
)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, f.node AS folded_root,
    f.node = root AS verified
FROM placed AS p JOIN sources AS s ON s.source IS NOT DISTINCT FROM p.source
JOIN (SELECT node AS root FROM top WHERE n = 1) ON true JOIN folded AS f USING (r) LEFT JOIN proofs USING (r)
"""


PREFIX_TRIE = rf"""
WITH turns AS MATERIALIZED (
    SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS place
    FROM (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
            len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words
        FROM conversations WHERE conv_id IS NOT NULL)
), convs AS MATERIALIZED (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {crc32("name")} % 4 AS h
    FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS name FROM turns)
), rebuilt AS (
    SELECT c.conv_id, place, digest, words FROM convs AS c JOIN turns AS t USING (conv_id)
    WHERE place >= h OR c.conv_id = base
    UNION ALL
    SELECT c.conv_id, place, digest, words FROM convs AS c JOIN turns AS t ON t.conv_id = base AND place < h
    WHERE c.conv_id <> base
), paths AS MATERIALIZED (
    SELECT conv_id, words, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS key
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place)
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), nodes AS MATERIALIZED (
    SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = n), '') AS ends
    FROM paths JOIN (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id) USING (conv_id) GROUP BY key, depth
), linked AS MATERIALIZED (
    SELECT n.*, (SELECT count(*) FROM nodes AS c WHERE c.depth = n.depth + 1 AND left(c.key, 64 * n.depth) = n.key) AS n_children
    FROM nodes AS n
), below AS (
    SELECT a.key, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens
    FROM linked AS a JOIN linked AS b ON starts_with(b.key, a.key) GROUP BY a.key
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
    saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM linked AS n JOIN below USING (key)
LEFT JOIN nodes AS p ON p.depth = n.depth - 1 AND p.key = left(n.key, 64 * p.depth)
"""
