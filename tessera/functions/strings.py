"""String predicates and helpers that stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _is_plain(piece: str) -> bool:
    return "_" not in piece and "\\" not in piece


def like(col: Column, pattern: str) -> Column:
    """SQL ``LIKE`` with a linear-time plan for ``%a%b%...%`` patterns.

    Spark evaluates a LIKE with several ``%`` as a backtracking regex,
    which is quadratic on long texts.  For patterns made of literal pieces
    separated by ``%`` (no ``_`` or escapes) the match is equivalent to
    finding each piece left to right, each starting after the end of the
    previous one; earliest matches are always optimal, so a chain of
    ``locate`` calls decides it in one scan.  Anchored ends use
    ``startswith`` / ``endswith``.  Anything else falls back to ``like``.
    """
    pieces = pattern.split("%")
    if not all(_is_plain(p) for p in pieces) or len(pieces) < 2:
        return col.like(pattern)
    head, middle, tail = pieces[0], [p for p in pieces[1:-1] if p], pieces[-1]
    cond = F.lit(True)
    # position (1-based) where the next piece may start
    pos: Column = F.lit(1)
    if head:
        cond = cond & col.startswith(head)
        pos = F.lit(len(head) + 1)
    for piece in middle:
        loc = _locate_from(piece, col, pos)
        cond = cond & (loc > 0)
        pos = loc + F.lit(len(piece))
    if tail:
        # the tail must end the string and not overlap what was matched
        cond = cond & col.endswith(tail) & (F.length(col) - F.lit(len(tail)) + 1 >= pos)
    return F.when(col.isNull(), F.lit(None).cast("boolean")).otherwise(cond)


def _locate_from(piece: str, col: Column, pos: Column) -> Column:
    """1-based position of ``piece`` in ``col`` at or after ``pos``; 0 if
    absent.  ``pos`` may be a column, which ``F.locate`` does not accept."""
    return F.call_function("locate", F.lit(piece), col, pos)
