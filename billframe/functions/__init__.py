"""Scalar column expressions (all JVM-side, whole-stage-codegen friendly)."""

from billframe.functions.money import money_error, money_value, parse_money
from billframe.functions.dates import date_error, date_is_ambiguous, parse_date
from billframe.functions.text import (
    clean_ws,
    is_nullish,
    mandatory_text,
    mandatory_text_error,
    normalize_currency,
    normalize_label,
    optional_text,
    strip_ws,
)
from billframe.functions.keys import dedup_key, fold_key, invoice_sk, month_key, vendor_pk
from billframe.functions.rates import rate_is_nonzero

__all__ = [
    "money_error", "money_value", "parse_money",
    "date_error", "date_is_ambiguous", "parse_date",
    "clean_ws", "is_nullish", "mandatory_text", "mandatory_text_error",
    "normalize_currency", "normalize_label", "optional_text", "strip_ws",
    "dedup_key", "fold_key", "invoice_sk", "month_key", "vendor_pk",
    "rate_is_nonzero",
]
