"""DuckDB twins of those text operators that SQL can express."""

from __future__ import annotations

#: unsigned crc32 of the decimal id: bytes one by one, eight shifts each
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: ord(c)::BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                            lambda x, z: xor(x >> 1, (x & 1) * 3988292384))))"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text))) + ")"


def _levels(name: str, base: str) -> str:
    """Nodes of all levels over base (tree, pos, h), with those before and after them under the same parent."""
    return f"""
{name}(tree, lvl, pos, h, n) AS (
    SELECT tree, 0, pos, h, count(*) OVER (PARTITION BY tree) FROM ({base})
    UNION ALL
    SELECT tree, lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 7) // 8)
    FROM {name} WHERE n > 1 GROUP BY tree, lvl, pos // 8),
{name}_flanks AS (
    SELECT tree, lvl, pos,
           coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {name} WHERE n > 1 WINDOW w AS (PARTITION BY tree, lvl, pos // 8 ORDER BY pos))"""


def _climb(name: str, over: str, start: str) -> str:
    """Proof and folded digest of start (id, tree, pos, h, proof) up to the root of its tree."""
    return f"""
{name}(id, tree, lvl, pos, h, proof) AS (
    SELECT id, tree, 0, pos, h, proof FROM ({start})
    UNION ALL
    SELECT c.id, c.tree, c.lvl + 1, c.pos // 8, sha256(f.before || c.h || f.after), c.proof || f.before || f.after
    FROM {name} c JOIN {over}_flanks f USING (tree, lvl, pos)),
{name}_top AS (SELECT id, tree, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM {name} GROUP BY id, tree)"""


_TAMPERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MERKLE_MANIFEST = f"""WITH RECURSIVE
leaves AS (
    SELECT doc_id, {_leaf('text')} AS leaf,
           {_leaf(f"CASE WHEN ({_CRC}) % 3 = 0 THEN {_TAMPERED} ELSE text END")} AS tried,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, lang FROM documents),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS id FROM leaves),
{_levels('low', 'SELECT tree, pos, leaf AS h FROM numbered')},
subroots AS (SELECT tree, h FROM low WHERE n = 1),
{_levels('high', 'SELECT 0 AS tree, tree AS pos, h FROM subroots')},
{_climb('inner_', 'low', "SELECT id, tree, pos, tried AS h, '' AS proof FROM numbered")},
{_climb('outer_', 'high', 'SELECT id, 0 AS tree, tree AS pos, h, proof FROM inner__top')}
SELECT d.doc_id, d.leaf, s.h AS subroot, r.h AS root, sha256(o.proof) AS proof_sha256,
       o.h AS folded_root, o.h = r.h AS verified
FROM numbered d JOIN subroots s USING (tree) JOIN outer__top o USING (id) CROSS JOIN (SELECT h FROM high WHERE n = 1) r"""

EMBEDDING_NEAR_DEDUP = """WITH RECURSIVE
usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.95 END),
reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
roots AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN roots r ON r.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id"""
