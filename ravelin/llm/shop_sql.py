"""DuckDB SQL for the band join, the conversation trie and the removal of repeats."""

from __future__ import annotations

#: crc32 of ASCII text, from its polynomial (a fixed value): one table of 256 entries, one step a character.
CRC = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t)"""


def crc32(text: str, table: str = "t") -> str:
    """SQL for the unsigned crc32 of an ASCII text, where ``table`` is in scope."""
    step = f"lambda c, b: xor(c // 256, {table}[xor(c % 256, b) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), {step}), 4294967295)"


OP11 = f"""
WITH {CRC},
l AS (
  SELECT CAST(sale_id AS BIGINT) AS sale_id, CAST(line_no AS BIGINT) AS line_no, CAST(item_id AS BIGINT) AS line_item_id,
    sign(quantity) * (2 * CAST(floor(100 * amount + 0.5) AS BIGINT) + quantity) AS n, 2 * abs(CAST(quantity AS BIGINT)) AS d
  FROM sale_lines WHERE sale_id IS NOT NULL AND item_id IS NOT NULL AND quantity <> 0 AND isfinite(amount)),
u AS (
  SELECT sale_id, line_no, line_item_id, (n - (n % d + d) % d) // d AS u,
    {crc32("(sale_id || ',' || coalesce(CAST(line_no AS VARCHAR), '') || ',' || line_item_id)")} AS crc
  FROM l, crc_table),
i AS MATERIALIZED (SELECT row_number() OVER () AS r, CAST(item_id AS BIGINT) AS item_id, CAST(floor(100 * price + 0.5) AS BIGINT) AS p FROM items),
pairs AS (
  SELECT r, item_id, abs(u - p) AS gap, u, sale_id, line_no, line_item_id, crc
  FROM i JOIN u ON line_item_id <> item_id AND (abs(u - p) <= 100 OR 1000 * abs(u - p) <= greatest(u, p))),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY gap, u, sale_id, line_no NULLS FIRST, line_item_id) AS rank,
    count(*) OVER (PARTITION BY r) AS n_pairs, sum(gap) OVER (PARTITION BY r) AS gap_sum, sum(crc) OVER (PARTITION BY r) AS lines_crc
  FROM pairs)
SELECT i.item_id, CAST(coalesce(rank, 0) AS INTEGER) AS rank, gap, u, sale_id, line_no, line_item_id,
  coalesce(n_pairs, 0) AS n_pairs, CAST(coalesce(gap_sum, 0) AS BIGINT) AS gap_sum, CAST(coalesce(lines_crc, 0) AS BIGINT) AS lines_crc
FROM i LEFT JOIN (SELECT * FROM ranked WHERE rank <= 2) k ON k.r = i.r
"""

OP12 = f"""
WITH {CRC},
t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || x)) AS k, r, x
  FROM (SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t), crc_table),
b AS (
  SELECT c.conv_id, k, r, x FROM c JOIN t ON t.conv_id = base AND k <= h
  UNION ALL SELECT c.conv_id, k, r, x FROM c JOIN t ON t.conv_id = c.conv_id AND k > h),
path AS (
  SELECT conv_id, row_number() OVER w AS depth, list({{'r': r, 'x': x}}) OVER w AS prefix, strlen(x) AS bytes
  FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, [], 0 FROM c),
size AS (SELECT conv_id, max(depth) AS n FROM path GROUP BY conv_id),
node AS (SELECT depth, prefix, min(conv_id) AS owner, count(*) AS n_convs, max(bytes) AS bytes FROM path GROUP BY depth, prefix),
member AS (SELECT path.conv_id, path.depth, owner FROM path JOIN node USING (depth, prefix)),
linked AS (
  SELECT node.depth, node.owner, n_convs, (n_convs - 1) * bytes AS saved, m.owner AS parent
  FROM node LEFT JOIN member m ON m.conv_id = node.owner AND m.depth = node.depth - 1),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL),
own AS (
  SELECT linked.*, coalesce(n, 0) AS n_children, CAST(n IS NULL AS BIGINT) AS leaf
  FROM linked LEFT JOIN kids ON kids.parent = owner AND kids.depth = linked.depth),
below AS (
  SELECT m.owner, m.depth, sum(saved) AS saved, sum(leaf) AS leaves
  FROM own JOIN member m ON m.conv_id = own.owner AND m.depth <= own.depth GROUP BY ALL),
ends AS (
  SELECT owner, depth, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS hash
  FROM member JOIN size USING (conv_id) WHERE depth = n GROUP BY ALL)
SELECT own.owner AS conv_id, own.depth, parent AS parent_conv_id, n_convs, n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(below.saved AS BIGINT) AS saved_tokens, coalesce(hash, sha256('')) AS ends_sha256
FROM own JOIN below USING (owner, depth) LEFT JOIN ends USING (owner, depth)
"""

OP13 = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (SELECT r, k, substr(h, 512 * k + 1, 910) AS h, least(256, strlen(h) // 2 - 256 * k) AS n FROM (SELECT *, unnest(range((strlen(h) + 511) // 512)) AS k FROM d)),
bytes AS (SELECT r, k, h, unnest(range(n)) AS j FROM blocks),
strings AS (
  SELECT r, 256 * k + j AS j, substr(h, 2 * j + 1, 2) AS byte, CASE WHEN 2 * j + 400 <= strlen(h) THEN md5(substr(h, 2 * j + 1, 400)) END AS s
  FROM bytes),
twice AS (SELECT s FROM strings WHERE s IS NOT NULL GROUP BY s HAVING count(*) > 1),
gone AS (
  SELECT r, j, byte, max(CAST(twice.s IS NOT NULL AS INTEGER)) OVER (PARTITION BY r ORDER BY j ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone
  FROM strings LEFT JOIN twice ON twice.s = strings.s),
edges AS (SELECT *, gone - lag(gone, 1, 0) OVER (PARTITION BY r ORDER BY j) AS edge FROM gone),
sums AS (
  SELECT r, count(*) AS n_bytes, sum(gone) AS n_removed, count(*) FILTER (WHERE edge = 1) AS n_spans,
    string_agg(byte, '' ORDER BY j) FILTER (WHERE gone = 0) AS kept
  FROM edges GROUP BY r)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN sums ON sums.r = d.r
"""
