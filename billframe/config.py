"""Fixed values and tunable defaults.

Everything under "FIXED VALUES" must equal the behaviour users rely on (rule
names, field catalogue, nullish literals, date formats, currency noise,
thresholds); do not edit them to make a result change.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from decimal import Decimal

# ---------------------------------------------------------------------------
# FIXED VALUES
# ---------------------------------------------------------------------------

# The thirteen canonical invoice fields, in record (validation) order, with
# whether they are required and the default an optional field takes.
CANONICAL_FIELDS: tuple[tuple[str, bool, str | None], ...] = (
    ("date", True, None),
    ("company_name", True, None),
    ("buyer_name", True, None),
    ("invoice_reference_number", True, None),
    ("product_name", False, "N/A"),
    ("product_amount", False, "0"),
    ("total_amount", False, "0"),
    ("vat_tax_label", False, "N/A"),
    ("vat_tax_percentage", False, "N/A"),
    ("vat_tax_amount", False, "0"),
    ("coupon_discount_amount", False, "0"),
    ("mode_of_payment", False, "N/A"),
    ("currency", True, None),
)

# Literal strings vendors print where a value should be (compared lower-cased,
# after trimming).
NULLISH = ("null", "none", "nan", "n/a", "na", "-", "--", "")

# Optional text fields that fold nullish values to "N/A", and mandatory text
# fields that reject them (record order).
OPTIONAL_TEXT_FIELDS = ("product_name", "vat_tax_label", "vat_tax_percentage", "mode_of_payment")
MANDATORY_TEXT_FIELDS = ("company_name", "buyer_name", "invoice_reference_number")

# Canonical money fields in record order.
MONEY_FIELDS = ("product_amount", "total_amount", "vat_tax_amount", "coupon_discount_amount")

# Accepted date layouts, tried in this order (day-first before month-first),
# written as Python strptime directives:
#   %d-%m-%Y, %d/%m/%Y, %Y-%m-%d, %d %b %Y, %d %B %Y, %b %d, %Y, %B %d, %Y,
#   %d-%b-%Y, %d.%m.%Y, %m/%d/%Y
# The same list in Spark datetime-pattern letters (single letters accept one
# or two digits, like strptime):
DATE_PATTERNS = (
    "d-M-yyyy",
    "d/M/yyyy",
    "yyyy-M-d",
    "d MMM yyyy",
    "d MMMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d-MMM-yyyy",
    "d.M.yyyy",
    "M/d/yyyy",
)

# Currency noise removed from money text: the symbols ₹ ` £ $ € and,
# case-insensitively, the codes Rs / Rs. / INR / GBP / USD / EUR.
CURRENCY_NOISE_REGEX = r"[₹`£$€]|(?i:Rs\.?|INR|GBP|USD|EUR)"

# Shapes of printed values: digits that print a gap or an underscore apart, an
# amount in parentheses, decoration before a label, a rate, a numeric date.
KERNING_REGEX = r"(?U)(?<=\d)\s+(?=\d)"
DIGIT_UNDERSCORE_REGEX = r"(?<=\d)_(?=\d)"
PARENTHESISED_REGEX = r"(?s)^\((.*)\)$"
LEADING_DECORATION_REGEX = r"(?U)^[\-\*•\s]+"
NUMBER_REGEX = r"(\d+(?:\.\d+)?)"
NUMERIC_DATE_REGEX = r"(?U)^\s*(\d{1,2})\s*[/\-.]\s*(\d{1,2})\s*[/\-.]\s*(\d{2,4})\s*$"

# Error types of failed documents, by stage.
EXTRACTION_ERROR = "TextractExtractionError"
MAPPING_ERROR = "BedrockMappingError"

# Reporting currency.
TARGET_CURRENCY = "GBP"

# Rule catalogue: (name, severity, stage).
DQ_RULES: tuple[tuple[str, str, str], ...] = (
    ("MISSING_MANDATORY_FIELD", "hard_fail", "pydantic_validation"),
    ("NEGATIVE_MONEY_VALUE", "hard_fail", "pydantic_validation"),
    ("UNPARSEABLE_DATE", "hard_fail", "pydantic_validation"),
    ("UNPARSEABLE_DECIMAL", "hard_fail", "pydantic_validation"),
    ("EXTRACTION_FAILED", "hard_fail", "extraction_or_mapping"),
    ("ZERO_TOTAL_AMOUNT", "soft_warn", "pydantic_validation"),
    ("ZERO_PRODUCT_AMOUNT", "soft_warn", "pydantic_validation"),
    ("ZERO_TAX_WITH_NONZERO_RATE", "soft_warn", "pydantic_validation"),
    ("LOW_FIELD_CONFIDENCE", "soft_warn", "post_validation"),
    ("AMBIGUOUS_DATE_FORMAT", "soft_warn", "post_validation"),
    ("MULTIPLE_TOTAL_CANDIDATES", "soft_warn", "post_validation"),
    ("DUPLICATE_SKIPPED", "special", "storage"),
)
SOFT_RULES = tuple(n for n, sev, _ in DQ_RULES if sev == "soft_warn")

# Outcomes.
LOADED = "LOADED"
LOADED_WITH_WARNINGS = "LOADED_WITH_WARNINGS"
DUPLICATE_SKIPPED = "DUPLICATE_SKIPPED"
QUARANTINED = "QUARANTINED"

# Textract expense types that identify the seller, best first, and label hints
# used when none of them is present.
VENDOR_TYPES = ("VENDOR_NAME", "SUPPLIER_NAME", "RECEIVER_NAME")
VENDOR_LABEL_HINTS = ("vendor", "company", "supplier", "merchant", "seller", "from")
# Fields whose value (not only label) an alias entry may carry over.
ALIAS_CONSTANT_FIELDS = ("currency",)
# Line-item columns that describe the row, best first.
DESCRIPTION_COLUMNS = ("ITEM", "DESCRIPTION", "PRODUCT_CODE", "NAME")

# Display fields of a query answer sample.
DISPLAY_FIELDS = ("company_name", "invoice_reference_number", "total_amount", "currency", "status", "date")

MAX_DOCUMENT_SIZE_BYTES = 500 * 1024 * 1024
MIGRATION_ITEM_THRESHOLD = 1_000_000
SCHEMA_VERSION = 1
ANSWER_SAMPLE_SIZE = 5

# Production FX table: units of source currency per 1 GBP.
DEFAULT_FX_RATES = {"INR": "125", "USD": "1.27", "EUR": "1.17", "GBP": "1"}
DEFAULT_FX_AS_OF = "2026-09-09"


# ---------------------------------------------------------------------------
# Tunables
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Settings:
    low_confidence_threshold: float = 60.0
    fallback_confidence_threshold: float = 50.0
    alias_min_coverage: float = 0.6
    max_mapping_attempts: int = 2  # 1 + max_retries
    fx_rates: dict = field(default_factory=lambda: dict(DEFAULT_FX_RATES))
    fx_as_of: str = DEFAULT_FX_AS_OF
    # Money is fixed-point: 28 digits, 8 after the point; rates 18/8.
    money_precision: int = 28
    money_scale: int = 8
    rate_precision: int = 18
    rate_scale: int = 8

    def fx_as_of_date(self) -> _dt.date:
        return _dt.date.fromisoformat(self.fx_as_of)

    def rate_items(self) -> list[tuple[str, Decimal]]:
        return [(k.upper(), Decimal(str(v))) for k, v in self.fx_rates.items()]


DEFAULT_SETTINGS = Settings()


def canonical_names() -> tuple[str, ...]:
    return tuple(n for n, _, _ in CANONICAL_FIELDS)


def required_names() -> tuple[str, ...]:
    return tuple(n for n, req, _ in CANONICAL_FIELDS if req)


def defaults() -> dict[str, str]:
    return {n: d for n, _, d in CANONICAL_FIELDS if d is not None}
