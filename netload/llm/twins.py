"""The operators' results in plain SQL, by definition instead of by method, for the given tables."""

from __future__ import annotations

#: Fixed value: what counts as a word.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: CRC-32 by its table of 256 entries, which the reflected polynomial gives.
_CRC_TABLE = """
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, _: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END)) AS crc_t
)"""


def _crc(number: str) -> str:
    codes = f"list_transform(string_split({number}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)"
    steps = "lambda c, b: xor(crc_t[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {codes}), {steps}))"


OP4_SQL = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM texts
),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, COUNT(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE 100 * k >= 85 * (a.n + b.n - k)
),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT v, other FROM reached JOIN links ON u = doc_id
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, MIN(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""

OP6_SQL = f"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM texts),
windows AS (SELECT doc_id, i, array_to_string(w[i:i+34], ' ') AS s FROM starts),
repeated AS (SELECT s FROM windows GROUP BY s HAVING COUNT(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN repeated USING (s)),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, COUNT(*) AS n FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

OP12_SQL = f"""
WITH {_CRC_TABLE},
own AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
sizes AS (SELECT c, COUNT(*) AS n FROM own GROUP BY c),
convs AS (SELECT c, {_crc("c")} % 4 AS h, c - c % 20 AS base FROM sizes, crc_table),
lent AS (SELECT v.c, h, base, least(h, coalesce(n, 0)) AS k FROM convs v LEFT JOIN sizes s ON s.c = base),
rebuilt AS (
  SELECT v.c, place + 1 AS d, r, x FROM lent v JOIN own o ON o.c = base AND place < h
  UNION ALL SELECT v.c, place - h + k + 1, r, x FROM lent v JOIN own o ON o.c = v.c AND place >= h
),
digests AS (
  SELECT c, d, x, string_agg(sha256(strlen(r) || ':' || r || x), '') OVER (PARTITION BY c ORDER BY d) AS node FROM rebuilt
),
path AS (
  SELECT c, d, sha256(node) AS node, CASE WHEN d = 1 THEN '' ELSE sha256(lag(node) OVER (PARTITION BY c ORDER BY d)) END AS parent,
         len(regexp_extract_all(x, '{WORD}')) AS w
  FROM digests
  UNION ALL SELECT c, 0, '', NULL, 0 FROM sizes
),
nodes AS (
  SELECT node, MIN(parent) AS parent, MIN(d) AS depth, MIN(c) AS conv_id, COUNT(*) AS n_convs, MIN(w) AS w FROM path GROUP BY node
),
children AS (SELECT parent AS node, COUNT(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
sums AS (
  SELECT a.node, SUM((y.n_convs - 1) * y.w) AS saved, COUNT(*) FILTER (WHERE n IS NULL) AS leaves
  FROM nodes y LEFT JOIN children USING (node) JOIN path a ON a.c = y.conv_id AND a.d <= y.depth GROUP BY a.node
),
ends AS (
  SELECT node, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
  FROM (SELECT c, MAX(d) AS d FROM path GROUP BY c) JOIN path USING (c, d) GROUP BY node
)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(n, 0)::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes v LEFT JOIN nodes p ON p.node = v.parent LEFT JOIN children c ON c.node = v.node
JOIN sums s ON s.node = v.node LEFT JOIN ends e ON e.node = v.node
"""


def _fields(text: str) -> str:
    columns = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in columns) + ")"


def _levels(name: str, first: str) -> str:
    """All levels of some trees; the last has n = 1."""
    return f"""{name}(tree, level, idx, node, n) AS (
  {first}
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(node, '' ORDER BY idx)), (n + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY tree, level, n, idx // 3
)"""


def _runs(name: str, levels: str) -> str:
    """Each node's siblings, left and right."""
    return f"""{name} AS (
  SELECT a.tree, a.level, a.idx, coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS r
  FROM {levels} a JOIN {levels} b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.idx
)"""


OP13_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {_fields("text")} AS leaf,
         CASE WHEN {_crc("doc_id")} % 2 = 0 THEN {_fields("replace(text, chr(10), '')")} END AS tampered
  FROM documents, crc_table
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, COUNT(*) OVER (PARTITION BY tree) AS n FROM leaves
),
{_levels("low", "SELECT tree, 0, idx, leaf, n FROM placed")},
{_runs("low_runs", "low")},
subroots AS (SELECT tree, node FROM low WHERE n = 1),
{_levels("high", "SELECT 0::BIGINT, 0, tree, node, (SELECT COUNT(*) FROM subroots) FROM subroots")},
{_runs("high_runs", "high")},
steps AS (
  SELECT p.doc_id, p.tree, p.idx, 0 AS stage, s.level, s.l, s.r
  FROM placed p JOIN low_runs s ON s.tree = p.tree AND s.idx = p.idx // (3 ** s.level)::BIGINT
  UNION ALL SELECT p.doc_id, p.tree, p.idx, 1, s.level, s.l, s.r FROM placed p JOIN high_runs s ON s.idx = p.tree // (3 ** s.level)::BIGINT
),
ways AS (
  SELECT tree, idx, string_agg(l || r, '' ORDER BY stage, level) AS proof, list({{'l': l, 'r': r}} ORDER BY stage, level) AS way
  FROM steps GROUP BY tree, idx
),
folded AS (
  SELECT p.doc_id, p.leaf, s.node AS subroot, (SELECT node FROM high WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_prepend({{'l': coalesce(tampered, leaf), 'r': ''}}, coalesce(way, [])),
                     lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded_root
  FROM placed p JOIN subroots s USING (tree) LEFT JOIN ways w ON w.tree = p.tree AND w.idx = p.idx
)
SELECT *, folded_root = root AS verified FROM folded
"""
