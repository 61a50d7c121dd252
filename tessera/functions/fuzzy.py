"""Fuzzy token ratios of two names (small per-pair helpers).

The ratios are the public definitions of the indel-based string ratio
and its token-sort / token-set variants:

  ratio(a, b)      = 100 * (1 - d / (|a| + |b|)),  d = |a| + |b| - 2 * LCS(a, b)
  token_sort(a, b) = ratio of the sorted, space-joined tokens
  token_set(a, b)  = best of the ratios between the sorted intersection
                     and intersection + each sorted difference; 100 when
                     one token set contains the other

Each ratio is rounded half-to-even to an integer; the combined score is
the mean of both, truncated to an integer.  LCS uses the bit-parallel
method of Allison & Dix / Hyyrö (one pass over the second string).
"""

from __future__ import annotations

import re

_NON_ASCII = re.compile(r"[^\x00-\x7f]")
_NON_WORD = re.compile(r"[^A-Za-z0-9_]")


def process(s: str | None) -> str:
    """Drop non-ASCII characters, turn non-word characters into spaces,
    lower-case, strip."""
    if s is None:
        return ""
    return _NON_WORD.sub(" ", _NON_ASCII.sub("", s)).lower().strip()


def lcs_len(a: str, b: str) -> int:
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def indel(a: str, b: str) -> int:
    """Insertions and deletions that turn a into b."""
    return len(a) + len(b) - 2 * lcs_len(a, b)


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return (1.0 - indel(a, b) / total) * 100 if total else 100.0


def _in_order(words) -> str:
    return " ".join(sorted(words))


def token_sort_ratio(pa: str, pb: str) -> int:
    """Ratio of the names with their words in order; on processed strings."""
    return round(ratio(_in_order(pa.split()), _in_order(pb.split())))


def token_set_ratio(pa: str, pb: str) -> int:
    """Best ratio among the shared words, the words of a and the words of b,
    each written as the shared words followed by the others."""
    left, right = set(pa.split()), set(pb.split())
    if not left or not right:
        return 0
    if left <= right or right <= left:
        return 100
    shared = _in_order(left & right)
    of_left, of_right = (f"{shared} {_in_order(own)}".strip() for own in (left - right, right - left))
    choices = [(of_left, of_right)]
    if shared:
        choices += [(shared, of_left), (shared, of_right)]
    return round(max(100 - 100 * indel(x, y) / (len(x) + len(y)) for x, y in choices))


def combined_score(a: str | None, b: str | None) -> tuple[int, int, int]:
    """(token_sort, token_set, combined) of two raw names."""
    pa, pb = process(a), process(b)
    s1, s2 = token_sort_ratio(pa, pb), token_set_ratio(pa, pb)
    return s1, s2, (s1 + s2) // 2
