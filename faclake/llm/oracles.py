"""DuckDB SQL, generated, for queries whose SQL repeats a step many times."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# CRC-32 of a text's bytes: the table by the polynomial's rule, then byte by byte
_CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list(list_reduce(range(8),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) AS r(i))"""
_CRC = ("xor(list_reduce(list_transform(range(0, length(hex({0})) // 2), lambda i: CAST('0x' || substr(hex({0}), 2 * i + 1, 2) AS BIGINT)), "
        "lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295), 4294967295)")


def _up(a: str, b: str) -> str:
    """Level ``b``: every 8 nodes of ``a`` hashed into one; a lone node stays."""
    return (f"{b} AS MATERIALIZED (SELECT g, i // 8 AS i, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h, "
            f"(n + 7) // 8 AS n FROM {a} GROUP BY g, i // 8, n)")


def _siblings(a: str, s: str) -> str:
    """The siblings before and after each node of ``a``, concatenated."""
    return (f"{s} AS MATERIALIZED (SELECT x.g, x.i, x.n, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS a, "
            f"coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS z FROM {a} x "
            f"JOIN {a} y ON x.g = y.g AND x.i // 8 = y.i // 8 GROUP BY x.g, x.i, x.n)")


def _fold(before: str, after: str, s: str, k: int, g: str, i: str) -> str:
    """One level up the path of every row: value ``f`` and proof ``p`` so far."""
    return (f"{after} AS MATERIALIZED (SELECT r.* EXCLUDE (f, p), CASE WHEN s.n > 1 THEN sha256(s.a || r.f || s.z) ELSE r.f END AS f, "
            f"r.p || s.a || s.z AS p FROM {before} r JOIN {s} s ON s.g = {g} AND s.i = {i} // {8 ** k})")


def manifest_sql(levels: int = 8, group_levels: int = 2) -> str:
    """The levels are unrolled: 8 ** ``levels`` rows a language."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda t: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", t))) + ")"
    crc = _CRC.format("CAST(doc_id AS VARCHAR)")
    parts = [_CRC_TABLE,
             f"x AS (SELECT doc_id, source, lang, n_chars, text, CASE WHEN {crc} % 3 = 0 THEN {_LOWER.format('text')} ELSE text END AS low "
             "FROM documents, crc_table)",
             f"d AS (SELECT coalesce('=' || lang, '') AS g, doc_id, {leaf('text')} AS h, {leaf('low')} AS f FROM x)",
             "n0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, "
             "count(*) OVER (PARTITION BY g) AS n FROM d)"]
    for k in range(levels):
        parts += [_siblings(f"n{k}", f"s{k}"), _up(f"n{k}", f"n{k + 1}")]
    parts.append(f"m0 AS MATERIALIZED (SELECT '' AS g, g AS grp, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM n{levels})")
    for k in range(group_levels):
        parts += [_siblings(f"m{k}", f"t{k}"), _up(f"m{k}", f"m{k + 1}")]
    parts.append("f0 AS (SELECT n0.doc_id, n0.h AS leaf, n0.g, n0.i, m0.i AS gi, m0.h AS subroot, n0.f, '' AS p FROM n0 JOIN m0 ON m0.grp = n0.g)")
    for k in range(levels):
        parts.append(_fold(f"f{k}", f"f{k + 1}", f"s{k}", k, "r.g", "r.i"))
    for k in range(group_levels):
        parts.append(_fold(f"f{levels + k}", f"f{levels + k + 1}", f"t{k}", k, "''", "r.gi"))
    return ("WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, m.h AS root, sha256(p) AS proof_sha256, f AS folded_root, "
            f"f = m.h AS verified FROM f{levels + group_levels} CROSS JOIN m{group_levels} m")


def resample_sql() -> str:
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    words = f"regexp_extract_all({_LOWER.format('''coalesce(text, '')''')}, {word})"
    return f"""WITH {_CRC_TABLE},
dw AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents),
bw AS (SELECT {words} AS w FROM benchmark),
occ AS MATERIALIZED (SELECT doc_id, unnest(w) AS x FROM dw),
bocc AS MATERIALIZED (SELECT unnest(w) AS x FROM bw),
vocabulary AS (SELECT x FROM occ UNION SELECT x FROM bocc),
bucket AS MATERIALIZED (SELECT x, {_CRC.format('x')} % 10000 AS b FROM vocabulary, crc_table),
s AS (SELECT b, count(*) AS s FROM occ JOIN bucket USING (x) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM bocc JOIN bucket USING (x) GROUP BY b),
totals AS (SELECT (SELECT count(*) FROM occ) AS big_s, (SELECT count(*) FROM bocc) AS big_t),
gain AS MATERIALIZED (SELECT b, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (big_s + 10000)
  / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * (big_t + 10000)))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT b FROM bucket) LEFT JOIN s USING (b) LEFT JOIN t USING (b), totals),
weights AS (SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM occ JOIN bucket USING (x) JOIN gain USING (b) GROUP BY doc_id),
scored AS (SELECT dw.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
  (CAST('0x' || substr(sha256('2024:' || dw.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM dw LEFT JOIN weights ON weights.doc_id = dw.doc_id),
ranked AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS r,
  count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= n * 10 // 100 THEN r END AS rank FROM ranked"""
