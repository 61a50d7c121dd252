"""DuckDB (RE2) statements of the text operators, for the oracles only.

RE2 has no look-around: an isolated letter or digit run is removed with
``(^|[^w])X([^w]|$) -> \\1\\2`` applied twice (adjacent matches share a
separator, so one pass can miss every second one).
"""

from __future__ import annotations

from tessera.functions.text import KEPT_PUNCT, QUOTE_MAP, SPACE, WORD


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def re(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(repl)}, 'g')"


def _post(t: str) -> str:
    t = re(t, r"\n+|\\n|\r\n|\r", " ")
    t = re(t, f"[{SPACE}]+", " ")
    t = re(t, f"[^{WORD} {KEPT_PUNCT}]", "")
    t = re(t, r" +([.,!?;:])", r"\1")
    t = re(t, r"([.,!?;:]) *([.,!?;:])", r"\1")
    for _ in range(2):
        t = re(t, f"(^|[^{WORD}])[a-zA-Z]([^{WORD}]|$)", r"\1\2")
    for _ in range(2):
        t = re(t, f"(^|[^{WORD}])\\p{{Nd}}+([^{WORD}]|$)", r"\1\2")
    return f"trim({t})"


def clean_function_sql(col: str) -> str:
    """Mode 'function' without NFKC (the identity on the test corpus)."""
    t = re(col, "u[0-9a-fA-F]{4}", "")
    t = re(t, r"\\x[0-9a-fA-F]{2}", "")
    t = re(t, r"\p{C}", "")
    singles = [(a, b) for a, b in QUOTE_MAP if len(b) == 1]
    t = f"translate({t}, {q(''.join(a for a, _ in singles))}, {q(''.join(b for _, b in singles))})"
    for a, b in QUOTE_MAP:
        if len(b) != 1:
            t = f"replace({t}, {q(a)}, {q(b)})"
    return _post(t)


def clean_pipeline_sql(col: str) -> str:
    t = col
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"),
                 ("\b", "\\b"), ("\f", "\\f")):
        t = f"replace({t}, {q(a)}, {q(b)})"
    t = f"('\"' || {t} || '\"')"
    t = re(t, "u[0-9a-fA-F]{4}", "")
    t = re(t, r"[\x{10000}-\x{10FFFF}]", "\\\\\\\\")
    t = re(t, r"[^\x20-\x7E]", "\\\\")
    t = re(t, r"\\x[0-9a-fA-F]{2}", "")
    return _post(t)


def sentences_sql(cleaned_view: str, key: str = "doc_id", text: str = "cleaned") -> str:
    """Rows (key, sentence_index, sentence) of kept sentences."""
    return f"""
SELECT {key}, CAST(idx - 1 AS BIGINT) AS sentence_index, trim(piece) AS sentence FROM (
  SELECT {key}, unnest(parts) AS piece, generate_subscripts(parts, 1) AS idx FROM (
    SELECT {key}, string_split(regexp_replace({text}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS parts
    FROM {cleaned_view}) a) b
WHERE length(trim(piece)) > 10"""
