"""SQL for the operators that SQL can express."""

from __future__ import annotations

from changetide.llm import chat


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, a bit at a time."""
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({text}, ''),
      lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295)"""


def field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def leaf(n_chars: str = "n_chars") -> str:
    return "sha256(" + " || ".join(map(field, ["doc_id", "source", "lang", n_chars, "text"])) + ")"


#: A level from the one below; `name` has tree, l, place, node, n (nodes of the tree on the level).
_UP = """SELECT tree, l + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (n + 1) // 2
  FROM {0} WHERE n > 1 GROUP BY tree, l, place // 2, n"""
#: A proof from node to root, a step a round: siblings and the folded digest.
_FOLD = """SELECT f.row, f.tree, f.place // 2, f.l + 1, f.n, f.siblings || coalesce(s.node, ''),
    sha256(CASE WHEN s.node IS NULL THEN f.acc WHEN f.place % 2 = 1 THEN s.node || f.acc ELSE f.acc || s.node END)
  FROM {0} f LEFT JOIN {1} s ON s.tree = f.tree AND s.l = f.l AND s.place = xor(f.place, 1)
  WHERE f.l < (SELECT max(l) FROM {1} h WHERE h.tree = f.tree)"""

MERKLE = rf"""
WITH RECURSIVE named AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '') AS tree, {leaf()} AS leaf,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 7 = 0 THEN {leaf("(n_chars + 1)")} ELSE {leaf()} END AS told
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n
  FROM named),
levels(tree, l, place, node, n) AS (
  SELECT tree, 0, place, leaf, n FROM placed UNION ALL {_UP.format("levels")}),
roots AS (
  SELECT tree AS part, node AS subroot, row_number() OVER (ORDER BY tree::BLOB) - 1 AS place, count(*) OVER () AS n FROM levels WHERE n = 1),
crown(tree, l, place, node, n) AS (
  SELECT '', 0, place, subroot, n FROM roots UNION ALL {_UP.format("crown")}),
folded(row, tree, place, l, n, siblings, acc) AS (
  SELECT row, tree, place, 0, n, '', told FROM placed UNION ALL {_FOLD.format("folded", "levels")}),
at_subroot AS (
  SELECT * FROM folded f WHERE l = (SELECT max(l) FROM levels h WHERE h.tree = f.tree)),
topped(row, tree, place, l, n, siblings, acc) AS (
  SELECT a.row, '', r.place, 0, r.n, a.siblings, a.acc FROM at_subroot a JOIN roots r ON r.part = a.tree
  UNION ALL {_FOLD.format("topped", "crown")}),
top AS (SELECT max(l) AS height, max(node) FILTER (WHERE n = 1) AS root FROM crown)
SELECT p.doc_id, p.leaf, r.subroot, top.root, sha256(t.siblings) AS proof_sha256, t.acc AS folded_root, t.acc = top.root AS verified
FROM placed p JOIN roots r ON r.part = p.tree JOIN topped t ON t.row = p.row JOIN top ON t.l = top.height
"""

TRIE = rf"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, r, x, md5(strlen(r) || ':' || r || x) AS tid,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, md5(strlen(r) || ':' || r || x)) AS place
  FROM t),
convs AS (SELECT c, {crc32("c::VARCHAR")} % 4 AS h, c - c % 20 AS origin FROM (SELECT DISTINCT c FROM own)),
turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, place) AS d, tid, x FROM (
    SELECT convs.c, 0 AS part, place, tid, x FROM convs JOIN own ON own.c = origin AND place <= h
    UNION ALL SELECT convs.c, 1, place, tid, x FROM convs JOIN own ON own.c = convs.c AND place > h)),
paths AS (
  SELECT c, d, string_agg(tid, '') OVER (PARTITION BY c ORDER BY d) AS path, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words
  FROM turns UNION ALL SELECT c, 0, '', 0 FROM convs),
ended AS (SELECT *, d = max(d) OVER (PARTITION BY c) AS last FROM paths),
nodes AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last), '') AS ends
  FROM ended GROUP BY path, d),
children AS (SELECT left(path, (d - 1) * 32) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
  SELECT up.path, sum(q.saved) AS saved, count(*) FILTER (WHERE children.n IS NULL) AS leaves
  FROM nodes q JOIN paths up ON up.c = q.conv_id AND up.d <= q.d LEFT JOIN children ON children.path = q.path GROUP BY up.path)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(children.n, 0) AS n_children,
  below.leaves AS n_leaves, below.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below USING (path) LEFT JOIN children USING (path) LEFT JOIN nodes p ON n.d > 0 AND p.path = left(n.path, (n.d - 1) * 32)
"""


def oracle_sql() -> dict[str, str]:
    return {"op10_chat_formatting": chat.SQL, "op11_merkle_manifest": MERKLE, "op13_prefix_trie": TRIE}
