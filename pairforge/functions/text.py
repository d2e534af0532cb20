"""Column expressions for text handling with Python string semantics.

Everything here is a plain ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen and works the same on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace set (``str.isspace``), which ``str.strip()`` and
# ``str.split()`` use. Derived from Python's own rule rather than written out:
# U+0009-000D, U+001C-001F, U+0020, U+0085, U+00A0, U+1680, U+2000-200A,
# U+2028, U+2029, U+202F, U+205F, U+3000 (29 code points, all below U+3001).
WS_CODEPOINTS: tuple[int, ...] = tuple(c for c in range(0x3001) if chr(c).isspace())
WS: str = "".join(chr(c) for c in WS_CODEPOINTS)


def _ranges(codes: tuple[int, ...]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1] = (out[-1][0], c)
        else:
            out.append((c, c))
    return out


def _class_body(codes: tuple[int, ...]) -> str:
    parts = []
    for lo, hi in _ranges(codes):
        parts.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
    return "".join(parts)


# A run of non-whitespace as a regex; ``\x{..}`` is understood by Java regex and
# RE2 alike (the SQL oracle uses this pattern text).
NON_WS_RUN = f"[^{_class_body(WS_CODEPOINTS)}]+"


# Python whitespace outside Java's ASCII ``\s`` ([ \t\n\x0B\f\r]). Folding these to a
# space with ``translate`` (a per-character map) lets the hot regexes use the
# plain ``\s``/``\S`` classes, several times faster than a 29-point class.
RARE_WS = "".join(ch for ch in WS if ch not in " \t\n\x0b\x0c\r")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stringify(c: Column | str) -> Column:
    """``str(value)`` for scalar columns; NULL stays NULL (it fails the length filter)."""
    return _c(c).cast("string")


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace at both ends."""
    return F.btrim(_c(c), F.lit(WS))


def truncate(c: Column | str, n: int | None) -> Column:
    """First ``n`` code points; a falsy ``n`` leaves the text unchanged."""
    if not n:
        return _c(c)
    return F.left(_c(c), F.lit(int(n)))


def char_length(c: Column | str) -> Column:
    """``len(str)`` in code points."""
    return F.char_length(_c(c))


def fold_ws(c: Column | str) -> Column:
    """Every Python whitespace character mapped into Java's ASCII ``\\s`` set."""
    return F.translate(_c(c), RARE_WS, " " * len(RARE_WS))


def word_count(c: Column | str) -> Column:
    """``len(text.split())``; 0 for an empty or blank text, NULL for NULL."""
    return F.regexp_count(fold_ws(c), F.lit(r"\S+"))


def non_ws_chars(c: Column | str) -> Column:
    """Characters that are not whitespace."""
    return F.char_length(F.translate(_c(c), WS, ""))


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty or whitespace-only text."""
    return F.coalesce(py_strip(c), F.lit("")) == F.lit("")


def squeeze_ws(c: Column | str) -> Column:
    """``" ".join(text.split())``."""
    return F.btrim(F.regexp_replace(fold_ws(c), r"\s+", " "), F.lit(" "))


def py_str_repr(c: Column | str) -> Column:
    """Python ``repr`` of a str for the common cases: single quotes, or double
    quotes when the text holds a single quote and no double quote; backslashes
    doubled."""
    s = F.replace(_c(c), F.lit("\\"), F.lit("\\\\"))
    has_sq = F.contains(s, F.lit("'"))
    has_dq = F.contains(s, F.lit('"'))
    return (
        F.when(has_sq & ~has_dq, F.concat(F.lit('"'), s, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def preview(c: Column | str, n: int = 200) -> Column:
    """First ``n`` code points followed by ``...``."""
    return F.concat(F.left(_c(c), F.lit(n)), F.lit("..."))
