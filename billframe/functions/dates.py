"""D2 date coercion and F10 ambiguity test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billframe.config import DATE_PATTERNS, NUMERIC_DATE_REGEX
from billframe.functions.text import clean_ws

# A digit run of exactly three or of five or more digits can match none of the
# accepted layouts (days/months take 1-2 digits, years exactly 4), although
# Spark's lenient numeric parsing would otherwise accept some of them.
_BAD_DIGIT_RUN = r"(^|[^0-9])([0-9]{3}|[0-9]{5,})([^0-9]|$)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Shape of the text each layout can accept (after whitespace collapsing). The
# shapes are disjoint except where two layouts share one, and there the
# layouts stay in catalogue order, so "first layout that parses" is kept
# while a row pays for one or two parse attempts instead of ten (a failed
# attempt costs a thrown exception inside the formatter).
_SHAPES = (
    (r"^\d{1,2}-\d{1,2}-\d{4}$", ("d-M-yyyy",)),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", ("d/M/yyyy", "M/d/yyyy")),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", ("yyyy-M-d",)),
    (r"^\d{1,2} [A-Za-z]+ \d{4}$", ("d MMM yyyy", "d MMMM yyyy")),
    (r"^[A-Za-z]+ \d{1,2}, \d{4}$", ("MMM d, yyyy", "MMMM d, yyyy")),
    (r"^\d{1,2}-[A-Za-z]+-\d{4}$", ("d-MMM-yyyy",)),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", ("d.M.yyyy",)),
)
assert sorted(p for _, ps in _SHAPES for p in ps) == sorted(DATE_PATTERNS)


def parse_date(col) -> Column:
    """First accepted layout that parses, as a DateType; NULL when none does.

    NULL input is read as the text 'None' (so it is unparseable, not missing).
    Whitespace runs are collapsed first: a space in a layout matches any run.
    """
    s = clean_ws(F.coalesce(_c(col).cast("string"), F.lit("None")))
    out = None
    for shape, patterns in _SHAPES:
        attempt = F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in patterns]) if len(patterns) > 1 \
            else F.try_to_timestamp(s, F.lit(patterns[0]))
        out = F.when(s.rlike(shape), attempt) if out is None else out.when(s.rlike(shape), attempt)
    return out.cast("date")


def date_error(col) -> Column:
    return parse_date(col).isNull()


def date_is_ambiguous(col) -> Column:
    """numeric d/m/y text whose first two parts are both within 1..12."""
    raw = _c(col).cast("string")
    first = F.regexp_extract(raw, NUMERIC_DATE_REGEX, 1)
    second = F.regexp_extract(raw, NUMERIC_DATE_REGEX, 2)
    matched = raw.rlike(NUMERIC_DATE_REGEX)
    a = first.try_cast("int")
    b = second.try_cast("int")
    return F.coalesce(matched & a.between(1, 12) & b.between(1, 12), F.lit(False))
