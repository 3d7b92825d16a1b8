"""Shared column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set as one character class; Java's and RE2's \s are
# ASCII-only, so patterns that must behave like Python's \s use this instead.
WS_CHARS = r"\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WS = f"[{WS_CHARS}]"
# Python's \w for str patterns (letters, numbers, underscore); Java's \w is ASCII-only.
WORD_CHARS = r"\p{L}\p{N}_"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """str.strip(): remove leading/trailing Python whitespace."""
    return F.regexp_replace(col(c), f"^{WS}+|{WS}+$", "")


def blank_to_null(c) -> Column:
    c = col(c)
    return F.when(F.length(py_strip(c)) > 0, c)


def empty_to_null(c) -> Column:
    c = col(c)
    return F.when(F.length(c) > 0, c)


def select_where(df, exprs, cond):
    """``df.select(*exprs).where(cond)`` evaluating each projected expression once.

    With a plain select + where, Catalyst pushes the condition below the projection and inlines the
    projected expressions into it, so an expensive column (an HTML regex chain) runs twice. Filtering
    inside a generator keeps one evaluation: each row becomes an array of one struct, the array is
    filtered with ``cond`` (given the struct) and ``inline`` emits the surviving row."""
    from pyspark.sql import functions as F

    return df.select(F.inline(F.filter(F.array(F.struct(*exprs)), cond)))
