"""DuckDB SQL of operator 13, one CTE per level of the trees."""

DEPTH = 13  # levels: 3**13 (1.6 million) documents a source, and as many sources

_TOLD = "coalesce(CAST(octet_length(encode(CAST({0} AS VARCHAR))) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_TOLD.format(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# the reflected CRC-32, bit by bit (polynomial 0xEDB88320), of the id's decimal digits
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(k AS BIGINT) for k in range(8)]), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)), CAST(4294967295 AS BIGINT))"""


def _tree(name: str, base: str) -> str:
    """CTEs name0 .. nameDEPTH (k, i, total, h, l, r) over ``base`` (k, i, total, h)."""
    run = "(PARTITION BY k, i // 3 ORDER BY i ROWS BETWEEN {})"
    sides = ", ".join(
        f"coalesce(string_agg(h, '') OVER {run.format(rows)}, '') AS {side}"
        for side, rows in (("l", "UNBOUNDED PRECEDING AND 1 PRECEDING"), ("r", "1 FOLLOWING AND UNBOUNDED FOLLOWING"))
    )
    out = [f"{name}0 AS (SELECT *, {sides} FROM {base})"]
    for level in range(DEPTH):
        node = f"CASE WHEN total > {3**level} THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END"
        out.append(f"{name}{level + 1} AS (SELECT *, {sides} FROM (SELECT k, i // 3 AS i, total, {node} AS h FROM {name}{level} GROUP BY k, i // 3, total))")
    return ",\n".join(out)


def _walk(name: str, row: str, key: str, place: str, total: str) -> tuple[str, str]:
    """Joins to the levels above ``row`` and the list of (l, r, hashed) on its way up."""
    joins = "".join(
        f"\nJOIN {name}{level} AS {name}_{level} ON {name}_{level}.k IS NOT DISTINCT FROM {key} AND {name}_{level}.i = {place} // {3**level}" for level in range(DEPTH)
    )
    steps = ", ".join(f"{{'l': {name}_{level}.l, 'r': {name}_{level}.r, 'on': {total} > {3**level}}}" for level in range(DEPTH))
    return joins, f"[{steps}]"


_doc_joins, _doc_steps = _walk("t", "ranked", "ranked.k", "ranked.i", "ranked.total")
_top_joins, _top_steps = _walk("s", "subs", "0", "subs.i", "subs.total")

MERKLE = f"""
WITH leaves AS (SELECT doc_id, source, {_leaf("text")} AS leaf,
                       CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS other FROM documents),
ranked AS (SELECT *, source AS k, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS total, leaf AS h FROM leaves),
{_tree("t", "(SELECT k, i, total, h FROM ranked)")},
subs AS (SELECT k AS source, h AS subroot, 0 AS k, row_number() OVER (ORDER BY encode(k) NULLS FIRST) - 1 AS i, count(*) OVER () AS total, h FROM t{DEPTH}),
{_tree("s", "(SELECT k, i, total, h FROM subs)")},
low AS (SELECT doc_id, ranked.source, leaf, other, list_filter({_doc_steps}, lambda x: x."on") AS path FROM ranked{_doc_joins}),
top AS (SELECT source, subroot, list_filter({_top_steps}, lambda x: x."on") AS path FROM subs{_top_joins}),
whole AS (SELECT doc_id, leaf, subroot, s{DEPTH}.h AS root, other, low.path || top.path AS path
          FROM low JOIN top ON low.source IS NOT DISTINCT FROM top.source, s{DEPTH}),
done AS (SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256,
                list_reduce(list_prepend(other, list_transform(path, lambda x: x.l || '|' || x.r)),
                            lambda a, p: sha256(split_part(p, '|', 1) || a || split_part(p, '|', 2))) AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done
"""
