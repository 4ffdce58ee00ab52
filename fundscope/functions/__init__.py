"""Scalar functions: Column in, Column out."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# The white space of Unicode, the ideographic space among it, as regular expressions list it.
BLANKS = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, rf"^[{BLANKS}]+|[{BLANKS}]+$", "")


def is_blank(c: Column, trimmed: bool = False) -> Column:
    """NULL and the empty string both mean "missing"."""
    return c.isNull() | ((F.trim(c) if trimmed else c) == "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def any_of(c: Column, words: list[str]) -> Column:
    """True if the text holds one of the words; NULL for a NULL text."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out if words else F.when(c.isNotNull(), False)
