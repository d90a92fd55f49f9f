"""DuckDB SQL text for the oracle side of the query registry.

The oracle is an independent formulation: tokens become rows and a shingle
is a windowed ``string_agg`` over ``w`` consecutive token rows (no arrays of
windows).  It covers tokens shorter than 128 bytes, which holds for the
driver tables (longest token: 45 bytes at sf0.01); the byte-length prefix is
built from ``chr`` so ``md5`` runs on the raw bytes.
"""

from __future__ import annotations

# Python ``str.split()`` whitespace, RE2 spelling (same set as
# revdrift.functions.text.WHITESPACE_RUN).
WS = (r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")


def tokens_expr(text: str = "text") -> str:
    return f"list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '{WS}'), lambda x: x <> '')"


def shingle_ctes(src: str, keys: list[str], ws: list[int], prefix: str = "sh") -> str:
    """CTEs ``{prefix}_tok``, ``{prefix}_pos``, ``{prefix}_win`` (one row per window:
    keys, w, i, h) and ``{prefix}_list`` (keys, w, n_tokens, shingles sorted)."""
    k = ", ".join(keys)
    wins = "\n  UNION ALL\n".join(
        f"""  SELECT {k}, {w} AS w, i, md5(string_agg(e, '' ORDER BY i) OVER (
            PARTITION BY {k} ORDER BY i ROWS BETWEEN CURRENT ROW AND {w - 1} FOLLOWING)) AS h,
          i <= n - {w} + 1 AS full_window
    FROM {prefix}_pos"""
        for w in ws)
    wlist = ", ".join(str(w) for w in ws)
    join_on = " AND ".join(f"t.{c} = l.{c}" for c in keys)
    return f"""{prefix}_tok AS (
  SELECT {k}, {tokens_expr()} AS t FROM {src}),
{prefix}_pos AS (
  SELECT {k}, i, n, chr(0) || chr(0) || chr(0) || chr(strlen(tk)::INTEGER) || tk AS e
  FROM (SELECT {k}, unnest(t) AS tk, generate_subscripts(t, 1) AS i, len(t) AS n FROM {prefix}_tok)),
{prefix}_win0 AS (
{wins}),
{prefix}_win AS (SELECT {k}, w, i, h FROM {prefix}_win0 WHERE full_window),
{prefix}_agg AS (
  SELECT {k}, w, list(h ORDER BY h) AS s FROM {prefix}_win GROUP BY {k}, w),
{prefix}_list AS (
  SELECT {", ".join("t." + c for c in keys)}, ws.w, len(t.t) AS n_tokens,
         coalesce(l.s, []::VARCHAR[]) AS shingles
  FROM {prefix}_tok t CROSS JOIN (SELECT unnest([{wlist}]) AS w) ws
  LEFT JOIN {prefix}_agg l ON {join_on} AND l.w = ws.w)"""


def grid_values(lambdas: list[tuple[str, int]]) -> str:
    return ", ".join(f"('{lab}', {k})" for lab, k in lambdas)


def jaccard_select(base: str, cur: str, k: str = "k") -> str:
    a = f"{base}[1:{k}]"
    b = f"{cur}[1:{k}]"
    return (f"len(list_intersect({a}, {b})) AS intersection, "
            f"len(list_distinct(list_concat({a}, {b}))) AS union_size")
