"""Money text -> fixed-point decimal, with a failure flag.

Steps (all JVM regex / cast):
  strip -> '(x)' means negative -> drop currency symbols/codes -> re-join digit
  runs split by whitespace (glyph kerning) -> drop commas -> placeholder => 0
  -> try_cast to decimal(28,8); a NULL cast of a non-placeholder is a failure.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billframe.config import (
    CURRENCY_NOISE_REGEX,
    DEFAULT_SETTINGS,
    DIGIT_UNDERSCORE_REGEX,
    KERNING_REGEX,
    PARENTHESISED_REGEX,
)
from billframe.functions.text import is_nullish, strip_ws

MONEY_TYPE = f"decimal({DEFAULT_SETTINGS.money_precision},{DEFAULT_SETTINGS.money_scale})"
RATE_TYPE = f"decimal({DEFAULT_SETTINGS.rate_precision},{DEFAULT_SETTINGS.rate_scale})"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_money(col) -> Column:
    """Struct<value decimal(28,8), error boolean> for a raw money string.

    value is 0 for NULL/blank/placeholder input and NULL when the text cannot
    be read as a number (error = true). Accounting parentheses negate.
    Amounts beyond decimal(28,8) are reported as unparseable (declared bound).
    """
    raw = _c(col).cast("string")
    s = strip_ws(raw)
    negative = s.rlike(PARENTHESISED_REGEX)
    body = F.when(negative, F.regexp_extract(s, PARENTHESISED_REGEX, 1)).otherwise(s)
    body = F.regexp_replace(body, CURRENCY_NOISE_REGEX, "")
    body = F.regexp_replace(body, KERNING_REGEX, "")
    body = strip_ws(F.regexp_replace(body, ",", ""))
    placeholder = raw.isNull() | is_nullish(body)
    number = F.regexp_replace(body, DIGIT_UNDERSCORE_REGEX, "").try_cast(MONEY_TYPE)
    signed = F.when(negative, -number).otherwise(number)
    value = F.when(placeholder, F.lit(0).cast(MONEY_TYPE)).otherwise(signed).cast(MONEY_TYPE)
    error = ~placeholder & signed.isNull()
    return F.struct(value.alias("value"), error.alias("error"))


def money_value(col) -> Column:
    return parse_money(col)["value"]


def money_error(col) -> Column:
    return parse_money(col)["error"]
