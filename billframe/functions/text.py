"""Whitespace, nullish and label normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billframe.config import LEADING_DECORATION_REGEX, NULLISH

# (?U): Unicode-aware \s (the characters of _WS), matching Python's str.strip()/re semantics.
_WS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_ANY_WS_RUN = r"(?U)\s+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Strip leading/trailing Unicode whitespace (Spark's trim strips spaces only)."""
    return F.btrim(_c(col), F.lit(_WS))


def clean_ws(col) -> Column:
    """Collapse every whitespace run to one space and strip."""
    return strip_ws(F.regexp_replace(_c(col), _ANY_WS_RUN, " "))


def is_nullish(stripped: Column) -> Column:
    """True for NULL or a placeholder literal (input already stripped)."""
    return stripped.isNull() | F.lower(stripped).isin(*NULLISH)


def optional_text(col) -> Column:
    """D3: stripped text, nullish placeholders become 'N/A'."""
    s = strip_ws(_c(col))
    return F.when(is_nullish(s), F.lit("N/A")).otherwise(s)


def mandatory_text(col) -> Column:
    """D4 value: stripped text (NULL when it is a placeholder)."""
    s = strip_ws(_c(col))
    return F.when(is_nullish(s), F.lit(None).cast("string")).otherwise(s)


def mandatory_text_error(col) -> Column:
    """D4 rule: a mandatory text field holding nothing or a placeholder."""
    return is_nullish(strip_ws(_c(col)))


def normalize_currency(col) -> Column:
    """Upper-cased, stripped currency code ('' for NULL)."""
    return F.upper(F.coalesce(strip_ws(_c(col)), F.lit("")))


def normalize_label(col) -> Column:
    """B1: collapse whitespace, strip, drop a leading '-', '*', '•' run, strip."""
    collapsed = clean_ws(F.coalesce(_c(col), F.lit("")))
    return strip_ws(F.regexp_replace(collapsed, LEADING_DECORATION_REGEX, ""))
