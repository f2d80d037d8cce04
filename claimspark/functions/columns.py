"""Column expressions used across the core."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A token is a run of letters, digits and underscores or any other single non-space character.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_count(text: Column | str) -> Column:
    """Number of tokens; null for null."""
    return F.size(F.regexp_extract_all(col(text), F.lit(TOKEN_PATTERN), F.lit(0)))


def normalize_label(label: Column | str) -> Column:
    """Lower case, every run of other characters than letters, digits and underscores one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(col(label)), r"[^\p{L}\p{N}_]+", " "))


#: Full-width forms stand in the order of the code table; letters that fold to one other letter.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "\u3000ſς"
_PLAIN = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " sσ"
#: Letters and ligatures that fold to several.
_SEVERAL = (("ß", "ss"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl"))


def fold_label(label: Column | str) -> Column:
    """normalize_label after compatibility folding: widths, ligatures, sharp s, final sigma and long s.

    Spark has no normal forms; what occurs in labels is folded by translate, so
    keys stay in the JVM.  functions.text.fold() is the whole form in Python.
    """
    c = F.translate(col(label), _WIDE, _PLAIN)
    for joined, letters in _SEVERAL:
        c = F.replace(c, F.lit(joined), F.lit(letters))
    return F.trim(F.regexp_replace(F.translate(F.lower(c), "ς", "σ"), r"[^\p{L}\p{N}_]+", " "))


def collapse(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(text), r"\s+", " "))


def is_blank(text: Column | str) -> Column:
    return col(text).isNull() | ~F.regexp_like(col(text), F.lit(r"\S"))


def strip(text: Column | str) -> Column:
    return F.regexp_replace(col(text), r"^\s+|\s+$", "")
