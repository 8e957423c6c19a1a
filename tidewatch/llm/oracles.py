"""DuckDB SQL for the rows of the manifest and of the vector codes."""

from __future__ import annotations

#: Levels that the SQL spells out: groups of up to 8 ** 8 rows, and up to 8 ** 3 groups.
GROUP_LEVELS, TOP_LEVELS = 8, 3

_ENCODED = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(_ENCODED.format(f"({v})") for v in values) + ")"


def _levels(prefix: str, count: int) -> list[str]:
    """CTEs of the runs of each level and of the level above, from ``<prefix>0 (g, pos, n, h)``."""
    found = []
    for k in range(count):
        found.append(f"""{prefix}run{k} AS (
  SELECT g, pos // 8 AS up, any_value(n) AS n, list(h ORDER BY pos) AS run FROM {prefix}{k} GROUP BY ALL)""")
        found.append(f"""{prefix}{k + 1} AS (
  SELECT g, up AS pos, (n + 7) // 8 AS n,
    CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS h FROM {prefix}run{k})""")
    return found


def _folds(prefix: str, count: int, source: str) -> list[str]:
    """CTEs that carry ``folded`` and ``proof`` of ``source`` (g, pos, ...) up the levels."""
    found = []
    for k in range(count):
        left = f"array_to_string(r.run[1:pos // {8 ** k} % 8], '')"
        right = f"array_to_string(r.run[pos // {8 ** k} % 8 + 2:], '')"
        found.append(f"""{prefix}up{k} AS (
  SELECT s.* REPLACE (CASE WHEN r.n > 1 THEN sha256({left} || folded || {right}) ELSE folded END AS folded,
    CASE WHEN r.n > 1 THEN proof || {left} || {right} ELSE proof END AS proof)
  FROM {source} s JOIN {prefix}run{k} r ON s.g IS NOT DISTINCT FROM r.g AND s.pos // {8 ** (k + 1)} = r.up)""")
        source = f"{prefix}up{k}"
    return found


def merkle_sql() -> str:
    crc = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))))"""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""docs AS (SELECT doc_id, lang AS g, {_leaf('text')} AS h,
    CASE WHEN {crc} % 3 = 0 THEN {_leaf(lower)} ELSE {_leaf('text')} END AS claimed FROM documents)""",
             """leaf0 AS (SELECT *, count(*) OVER (PARTITION BY g) AS n, row_number() OVER (
    PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM docs)""",
             *_levels("leaf", GROUP_LEVELS),
             f"""top0 AS (SELECT 0 AS g, g AS name, h, count(*) OVER () AS n,
    row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM leaf{GROUP_LEVELS})""",
             *_levels("top", TOP_LEVELS),
             "start AS (SELECT doc_id, g, pos, h, claimed AS folded, '' AS proof FROM leaf0)",
             *_folds("leaf", GROUP_LEVELS, "start"),
             f"""turn AS (SELECT d.doc_id, d.h AS leaf, t.h AS subroot, 0 AS g, t.pos, d.folded, d.proof
    FROM leafup{GROUP_LEVELS - 1} d JOIN top0 t ON d.g IS NOT DISTINCT FROM t.name)""",
             *_folds("top", TOP_LEVELS, "turn")]
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = r.h AS verified FROM topup{TOP_LEVELS - 1}, top{TOP_LEVELS} r"""


def codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    def nearest(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (SELECT id, any_value(vec_id) AS vec_id, any_value(label) AS label, k, any_value(p) AS p,
    min({{'d': list_sum(list_transform(list_zip(p, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e}}) AS best
  FROM parts JOIN b{k} USING (k) GROUP BY id, k)"""

    steps = [f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v,
    row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS id FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""parts AS MATERIALIZED (SELECT id, vec_id, label, k, v[k * len(v) // {parts} + 1:(k + 1) * len(v) // {parts}] AS p
  FROM kept, range({parts}) r(k))""",
             f"b0 AS (SELECT k, id AS e, p AS c FROM parts WHERE id < {entries})"]
    for i in range(rounds):
        steps += [nearest(i), f"""s{i} AS (SELECT k, best.e AS e, unnest(p) AS x, generate_subscripts(p, 1) AS j FROM a{i}),
m{i} AS (SELECT k, e, j, sum(x)::BIGINT AS s, count(*) AS n FROM s{i} GROUP BY ALL),
u{i} AS (SELECT k, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM m{i} GROUP BY ALL),
b{i + 1} AS MATERIALIZED (SELECT k, e, coalesce(u{i}.c, b{i}.c) AS c FROM b{i} LEFT JOIN u{i} USING (k, e))"""]
    steps += [nearest(rounds), f"""coded AS (SELECT any_value(vec_id) AS vec_id, any_value(label) AS label,
    string_agg(printf('%02x', best.e::INTEGER), '' ORDER BY k) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY id)""",
              f"""flat AS (SELECT k, e, unnest(c) AS x, generate_subscripts(c, 1) AS j FROM b{rounds})""",
              "book AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY k, e, j)) AS digest FROM flat)"]
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  digest AS codebooks_sha256 FROM coded, book"""
