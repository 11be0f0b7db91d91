"""SQL for another engine that gives the rows of the queries which SQL can express."""

from __future__ import annotations


def _crc32(value: str) -> str:
    """The unsigned crc32 of ASCII text, bit by bit; 3988292384 is its polynomial (fixed value)."""
    octets = f"list_transform(string_split({value}, ''), lambda c: CAST(ord(c) AS BIGINT))"
    shift = "list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda a, b: {shift}), 4294967295)"


def _leaf(n_chars: str) -> str:
    entries = [f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(entries)})"


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees of ``leaves(tree, pos, n, h)`` by level."""
    return f"""{name}(tree, level, idx, n, h) AS (
      SELECT tree, 0, pos, n, h FROM {leaves}
      UNION ALL
      SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(h || coalesce(after, ''))
      FROM (SELECT *, lead(h) OVER (PARTITION BY tree ORDER BY idx) AS after FROM {name} WHERE n > 1) WHERE idx % 2 = 0)"""


def _siblings(leaves: str, nodes: str, first_step: int) -> str:
    """For each leaf and level with several nodes, what stands left and right of the leaf's node in its run."""
    return f"""SELECT l.id, {first_step} + k.level AS step,
        CASE WHEN (l.pos >> k.level) % 2 = 1 THEN s.h ELSE '' END AS before,
        CASE WHEN (l.pos >> k.level) % 2 = 0 THEN coalesce(s.h, '') ELSE '' END AS after
      FROM {leaves} l JOIN (SELECT DISTINCT tree, level FROM {nodes} WHERE n > 1) k USING (tree)
      LEFT JOIN {nodes} s ON s.tree = l.tree AND s.level = k.level AND s.idx = xor(l.pos >> k.level, 1)"""


MANIFEST = f"""WITH RECURSIVE leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h, id) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
    FROM (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS h, {_leaf("n_chars + 1")} AS tampered,
      row_number() OVER () AS id FROM documents)),
  {_tree("nodes", "leaves")},
  subroots AS (SELECT '' AS tree, tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
  {_tree("over", "subroots")},
  above AS (SELECT l.id, o.pos, '' AS tree, o.h AS subroot FROM leaves l JOIN subroots o ON o.name = l.tree),
  ways AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step) AS k
    FROM ({_siblings("leaves", "nodes", 0)} UNION ALL {_siblings("above", "over", 1000)})),
  proofs AS (SELECT id, sha256(string_agg(before || after, '' ORDER BY k)) AS proof_sha256 FROM ways GROUP BY id),
  folds(id, k, h) AS (
    SELECT id, 0, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN tampered ELSE h END FROM leaves
    UNION ALL
    SELECT f.id, w.k, sha256(w.before || f.h || w.after) FROM folds f JOIN ways w ON w.id = f.id AND w.k = f.k + 1),
  ends AS (SELECT id, arg_max(h, k) AS folded_root FROM folds GROUP BY id)
SELECT l.doc_id, l.h AS leaf, a.subroot, r.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = r.h AS verified
FROM leaves l JOIN above a USING (id) JOIN ends e USING (id) LEFT JOIN proofs p USING (id) CROSS JOIN (SELECT h FROM over WHERE n = 1) r"""

_TURN = "sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"

PREFIX_TRIE = f"""WITH turns AS (
    SELECT conv_id, {_TURN} AS key, strlen(coalesce(text, '')) AS size,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_TURN}) AS pos FROM conversations WHERE conv_id IS NOT NULL),
  convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
  rebuilt AS (
    SELECT c.conv_id, 0 AS own, pos, key, size FROM convs c JOIN turns t ON t.conv_id = c.base WHERE pos <= h
    UNION ALL SELECT c.conv_id, 1, pos, key, size FROM convs c JOIN turns t ON t.conv_id = c.conv_id WHERE pos > h),
  steps AS (
    SELECT conv_id, size, row_number() OVER w AS depth, sha256(string_agg(key, '') OVER w) AS node FROM rebuilt
      WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
  nodes AS (SELECT node, any_value(depth) AS depth, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs FROM steps GROUP BY node),
  pairs AS (SELECT DISTINCT a.node AS above, b.node AS node, b.depth - a.depth AS apart FROM steps a JOIN steps b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
  families AS (SELECT above AS node, count(*) AS n_children FROM pairs WHERE apart = 1 GROUP BY above),
  sums AS (
    SELECT p.above AS node, count(*) FILTER (f.node IS NULL) AS n_leaves, CAST(sum((n.n_convs - 1) * n.size) AS BIGINT) AS saved_tokens
    FROM pairs p JOIN nodes n ON n.node = p.node LEFT JOIN families f ON f.node = p.node GROUP BY p.above),
  ends AS (
    SELECT node, string_agg(conv_id, ',' ORDER BY conv_id) AS ids FROM steps
    JOIN (SELECT conv_id, max(depth) AS depth FROM steps GROUP BY conv_id) USING (conv_id, depth) GROUP BY node)
SELECT n.conv_id, n.depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(f.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN families f USING (node) LEFT JOIN ends e USING (node)
LEFT JOIN pairs p ON p.node = n.node AND p.apart = 1 LEFT JOIN nodes o ON o.node = p.above"""
