"""DuckDB statements of the fuzzy ratios (oracles only)."""

from __future__ import annotations


def proc(x: str) -> str:
    return (f"trim(lower(regexp_replace(regexp_replace({x}, '[^\\x00-\\x7F]', '', 'g'), "
            f"'[^A-Za-z0-9_]', ' ', 'g')))")


def toks(p: str) -> str:
    return f"list_filter(string_split_regex({p}, '\\s+'), lambda t: t <> '')"


def lcs(a: str, b: str) -> str:
    """LCS length by a row fold: each step is the next DP row, written as a
    prefix maximum so no inner sequential loop is needed."""
    return (f"list_reduce(string_split({a}, ''), lambda rw, ca: [0] || list_transform(range(1, length({b}) + 1), "
            f"lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(rw[k + 1], "
            f"CASE WHEN substr({b}, k, 1) = ca THEN rw[k] + 1 ELSE 0 END)))), "
            f"list_transform(range(0, length({b}) + 1), lambda z: 0))[-1]")


SCORE_CTE = """
p0 AS (SELECT *, {pa} AS pa, {pb} AS pb FROM {src}),
p1 AS (SELECT *, array_to_string(list_sort({ta}), ' ') AS sa, array_to_string(list_sort({tb}), ' ') AS sb,
              list_distinct({ta}) AS da, list_distinct({tb}) AS db FROM p0),
p2 AS (SELECT *, list_intersect(da, db) AS inter,
              array_to_string(list_sort(list_filter(da, lambda x: NOT list_contains(db, x))), ' ') AS ab,
              array_to_string(list_sort(list_filter(db, lambda x: NOT list_contains(da, x))), ' ') AS ba,
              len(list_filter(da, lambda x: NOT list_contains(db, x))) AS n_ab,
              len(list_filter(db, lambda x: NOT list_contains(da, x))) AS n_ba FROM p1),
p3 AS (SELECT *, length(array_to_string(list_sort(inter), ' ')) AS sect_len,
              {lcs_sort} AS lcs_sort, {lcs_set} AS lcs_set FROM p2),
p4 AS (SELECT *,
  CAST(round_even(CASE WHEN length(sa) + length(sb) = 0 THEN 100.0
       ELSE (1.0 - (length(sa) + length(sb) - 2 * lcs_sort) / (length(sa) + length(sb))) * 100 END, 0) AS INTEGER) AS token_sort,
  CAST(CASE WHEN len(da) = 0 OR len(db) = 0 THEN 0
       WHEN len(inter) > 0 AND (n_ab = 0 OR n_ba = 0) THEN 100
       ELSE round_even(greatest(
         100 - 100 * (length(ab) + length(ba) - 2 * lcs_set)
               / (2 * sect_len + 2 * (CASE WHEN sect_len > 0 THEN 1 ELSE 0 END) + length(ab) + length(ba)),
         CASE WHEN sect_len > 0 THEN 100 - 100 * (1 + length(ab)) / (2 * sect_len + 1 + length(ab)) ELSE 0 END,
         CASE WHEN sect_len > 0 THEN 100 - 100 * (1 + length(ba)) / (2 * sect_len + 1 + length(ba)) ELSE 0 END), 0)
       END AS INTEGER) AS token_set
  FROM p3),
scored AS (SELECT *, CAST((token_sort + token_set) // 2 AS INTEGER) AS score FROM p4)"""


def score_ctes(src: str, a: str, b: str) -> str:
    return SCORE_CTE.format(src=src, pa=proc(a), pb=proc(b), ta=toks("pa"), tb=toks("pb"),
                            lcs_sort=lcs("sa", "sb"), lcs_set=lcs("ab", "ba"))
