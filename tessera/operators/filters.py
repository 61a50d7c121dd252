"""Projections and predicates (F*, P*).

All predicates are plain column expressions so Catalyst pushes the
pushable parts into the parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_TEXT_CHARS = 10      # usable text: LENGTH(text) > 10
MIN_TESTIMONY_SESSION = 126


def active_testimony(df: DataFrame, inactive: str = "Inactive", last_name: str = "LastName") -> DataFrame:
    """Keep rows that are not flagged inactive and whose last name does not
    start with '@'.  A null flag or a null name keeps the row (OData 'ne'
    semantics), hence the null-safe forms."""
    not_inactive = ~F.col(inactive).eqNullSafe(F.lit(True))
    not_at = ~F.coalesce(F.col(last_name).startswith("@"), F.lit(False))
    return df.filter(not_inactive & not_at)


def usable_text(df: DataFrame, text: str = "doc_text", min_chars: int = MIN_TEXT_CHARS) -> DataFrame:
    """Text worth embedding: not null, not the JSON literal 'null', longer
    than ``min_chars`` characters.  'Error: ...' rows pass on purpose."""
    c = F.col(text)
    return df.filter(c.isNotNull() & (c != F.lit("null")) & (F.length(c) > min_chars))


def like_any_lower(df: DataFrame, col: str, fragments: Iterable[str]) -> DataFrame:
    """OR of case-folded substring tests (evaluated on the rows, not pushed:
    the scan cannot apply a predicate to ``lower(col)``)."""
    low = F.lower(F.col(col))
    cond: Column | None = None
    for frag in fragments:
        term = low.contains(frag.lower())
        cond = term if cond is None else (cond | term)
    return df.filter(cond if cond is not None else F.lit(False))


def session_gate(df: DataFrame, col: str = "session", first: int = MIN_TESTIMONY_SESSION) -> DataFrame:
    return df.filter(F.col(col) >= F.lit(first))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def in_set_or_other(col: str, groups: dict[str, list[str]], other: str = "Other") -> Column:
    """Map a value to the first group whose list contains it, else ``other``.
    A null value falls to ``other`` (isin on null is null -> not matched)."""
    expr = None
    for name, members in groups.items():
        cond = F.coalesce(F.col(col).isin(members), F.lit(False))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(other)) if expr is not None else F.lit(other)


def query_urls(df: DataFrame, base: str, params: dict[str, str], out: str = "query_url") -> DataFrame:
    """Build ``base?k1=v1&k2=v2`` with url-encoded values, one per row."""
    parts = [F.concat(F.lit(k + "="), F.url_encode(F.col(c).cast("string"))) for k, c in params.items()]
    return df.withColumn(out, F.concat(F.lit(base + "?"), F.concat_ws("&", *parts)))
