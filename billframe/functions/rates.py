"""does a printed tax-rate label denote a non-zero rate ('9%+9%' -> true)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billframe.config import NUMBER_REGEX
from billframe.functions.text import strip_ws


def rate_is_nonzero(col) -> Column:
    s = strip_ws(F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit("")))
    numbers = F.regexp_extract_all(s, F.lit(NUMBER_REGEX), 1)
    # A decimal numeral is > 0 exactly when it has a non-zero digit (no overflow).
    any_positive = F.exists(numbers, lambda x: x.rlike("[1-9]"))
    return F.when((s == "") | (F.upper(s) == "N/A"), F.lit(False)).otherwise(F.coalesce(any_positive, F.lit(False)))
