"""Text cleaning and sentence splitting as native column expressions.

``clean_text`` reproduces the reference cleaner step by step (T1-T14).
The order of the steps matters and the reference's quirks are kept on
purpose (see the step comments).  Everything except Unicode NFKC runs
inside whole-stage codegen; NFKC has no built-in, so it is a small Arrow
UDF that only sees the rows whose characters NFKC could change.

Two modes:
  * ``function``  - the cleaner applied to raw text;
  * ``pipeline``  - what the reference's pipeline really fed the cleaner:
    the JSON-encoded, ASCII-escaped text.  Its net effect (every non-ASCII
    character becomes a backslash and then vanishes, a non-ASCII character
    followed by 'n' turns into a space, ...) is reproduced natively.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The cleaner's character replacements, in the reference's
# order (entries that map a character to itself are no-ops and omitted:
# bullet, degree, registered, section, guillemets).
QUOTE_MAP = [
    ("\u2018", "'"),
    ("\u2019", "'"),
    ("\u201c", '"'),
    ("\u201d", '"'),
    ("\u2013", "-"),
    ("\u2014", "--"),
    ("\u00a0", " "),
]
# Fixed value: characters the cleaner keeps besides word characters and
# whitespace.
KEPT_PUNCT = ".,!?;:()'\"\\-–—•°®§»«"

# The patterns of steps T2, T4, T8, T10 and T11 below are fixed values too.

WORD = r"\p{L}\p{N}_"            # Python's Unicode \w
# Python's Unicode \s (Java's \s is ASCII-only).
SPACE = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"

# Characters for which NFKC is the identity and that are common in text:
# ASCII, Latin-1 letters, Latin Extended-A except the few compatibility
# letters (U+0132-0133, U+013F-0140, U+0149, U+017F).
NFKC_STABLE = r"\x00-\x7F\x{C0}-\x{FF}\x{100}-\x{131}\x{134}-\x{13E}\x{141}-\x{148}\x{14A}-\x{17E}"


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda v: unicodedata.normalize("NFKC", v) if isinstance(v, str) else None)


def nfkc(col: Column) -> Column:
    """NFKC normalisation; the UDF is handed a null for rows made only of
    NFKC-stable characters, so Python touches only the rare rows."""
    # pure-ASCII rows (byte length == character length) skip the regex
    needs = (F.octet_length(col) != F.length(col)) & col.rlike(f"[^{NFKC_STABLE}]")
    return F.coalesce(_nfkc(F.when(needs, col)), col)


def _post_whitespace(t: Column) -> Column:
    """Steps T8-T14, shared by both modes."""
    # Line breaks (only the literal backslash-n survives T5), tabs, runs of space
    t = F.regexp_replace(t, r"\n+|\\n|\r\n|\r", " ")
    t = F.regexp_replace(t, f"[{SPACE}]+", " ")
    # Drop everything but word chars, space and the kept punctuation
    t = F.regexp_replace(t, f"[^{WORD} {KEPT_PUNCT}]", "")
    # No space before punctuation
    t = F.regexp_replace(t, r" +([.,!?;:])", "$1")
    # Of two adjacent punctuation marks keep the first (one pass)
    t = F.regexp_replace(t, r"([.,!?;:]) *([.,!?;:])", "$1")
    # Isolated ASCII letters; T13: isolated digit runs (no re-collapse)
    t = F.regexp_replace(t, f"(?<![{WORD}])[a-zA-Z](?![{WORD}])", "")
    t = F.regexp_replace(t, f"(?<![{WORD}])\\p{{Nd}}+(?![{WORD}])", "")
    # T14
    return F.trim(t)


def _post_whitespace_ascii(t: Column) -> Column:
    """Steps T8-T14 of a text in which only x20-x7E are left: the same result
    from character classes that need no Unicode tables and fewer matches."""
    t = F.replace(t, F.lit("\\n"), F.lit(" "))
    t = F.regexp_replace(t, "  +", " ")  # a single space stays as it is
    t = F.regexp_replace(t, r"[#$%&*+/<=>@\[\\\]^`{|}~]", "")  # all that T9 drops
    t = F.regexp_replace(t, " +(?=[.,!?;:])", "")
    t = F.regexp_replace(t, r"([.,!?;:]) *+[.,!?;:]", "$1")
    # T12 and T13 at once: neither makes or ends an isolated run of the other
    t = F.regexp_replace(t, r"\b(?:[a-zA-Z]|[0-9]++)\b", "")
    return F.trim(t)


def clean_text(col: Column, mode: str = "function", normalize: bool = True) -> Column:
    if mode == "pipeline":
        return clean_text_pipeline(col)
    t = col.cast("string")
    # T2: 'u' + 4 hex digits, no word boundary (also eats e.g. 'ueded')
    t = F.regexp_replace(t, "u[0-9a-fA-F]{4}", "")
    # T3 is dead code after T2.  T4: literal backslash-x + 2 hex digits
    t = F.regexp_replace(t, r"\\x[0-9a-fA-F]{2}", "")
    # T5: every Unicode 'C' character, including real newlines and tabs
    t = F.regexp_replace(t, r"\p{C}", "")
    # T6
    if normalize:
        t = nfkc(t)
    # T7
    t = F.translate(t, "".join(a for a, b in QUOTE_MAP if len(b) == 1),
                    "".join(b for a, b in QUOTE_MAP if len(b) == 1))
    for a, b in QUOTE_MAP:
        if len(b) != 1:
            t = F.replace(t, F.lit(a), F.lit(b))
    return _post_whitespace(t)


def clean_text_pipeline(col: Column) -> Column:
    """The cleaner applied to ``json.dumps(text)`` (ASCII-escaped, quoted)."""
    t = col.cast("string")
    # JSON escapes that leave ASCII letters behind
    t = F.replace(t, F.lit("\\"), F.lit("\\\\"))
    t = F.replace(t, F.lit('"'), F.lit('\\"'))
    for ch, esc in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        t = F.replace(t, F.lit(ch), F.lit(esc))
    t = F.concat(F.lit('"'), t, F.lit('"'))
    # T2 on the escaped text: 'u' + 4 hex digits go, a \uXXXX escape leaves '\'
    t = F.regexp_replace(t, "u[0-9a-fA-F]{4}", "")
    # characters json.dumps writes as \uXXXX: astral ones as two escapes
    t = F.regexp_replace(t, r"[\x{10000}-\x{10FFFF}]", "\\\\\\\\")
    t = F.regexp_replace(t, r"[^\x20-\x7E]", "\\\\")
    # T4 (T5-T7 have nothing left to do on ASCII)
    t = F.regexp_replace(t, r"\\x[0-9a-fA-F]{2}", "")
    return _post_whitespace_ascii(t)


# Sentence boundary: whitespace after ., ! or ?
SENTENCE_BREAK = r"(?<=[.!?])\s+"
MIN_SENTENCE_CHARS = 10


def sentence_array(cleaned: Column) -> Column:
    """All sentence pieces with their index, before the length filter:
    array<struct<pos:int, col:string>>.  Indexes count every piece, so the
    kept sentences have gaps (as in the reference)."""
    return F.split(cleaned, SENTENCE_BREAK)


def kept_sentences(cleaned: Column) -> Column:
    """array<struct<sentence_index, sentence>> of sentences longer than 10
    characters after trimming, computed row-locally (no shuffle)."""
    pieces = sentence_array(cleaned)
    indexed = F.transform(pieces, lambda s, i: F.struct(i.alias("sentence_index"), F.trim(s).alias("sentence")))
    return F.filter(indexed, lambda x: F.length(x["sentence"]) > MIN_SENTENCE_CHARS)


def fix_scanned(text: Column, digits: list[tuple[str, str]]) -> Column:
    """Digit / letter confusions of a scan, by their neighbours: a digit between
    two lower-case letters is the letter, between capitals the capital (an I
    for a 1), and such a letter between two digits is the digit."""
    for digit, letter in digits:
        capital = "I" if letter == "l" else letter.upper()
        text = F.regexp_replace(text, f"(?<=[a-z]){digit}(?=[a-z])", letter)
        text = F.regexp_replace(text, f"(?<=[A-Z]){digit}(?=[A-Z])", capital)
        text = F.regexp_replace(text, f"(?<=[0-9])[{letter}{capital}](?=[0-9])", digit)
    return text
