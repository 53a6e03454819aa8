"""Date parsing and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The day comes from the text, so no zone or offset behind it can move it.
_ISO = (
    r"^(\d{4}-\d{1,2}(?:-\d{1,2})?)"
    r"(?:[T ]+\d{1,2}(?::\d{1,2}(?::\d{1,2}(?:[.,]\d+)?)?)?\s*(?:Z|UTC|GMT|[+-]\d{1,2}:?\d{0,2})?)?$"
)

# Tried in this order after ISO; month-first wins where both readings are possible.
_FORMATS = (
    "yyyy/M/d",
    "yyyyMMdd",
    "M/d/yyyy",
    "d/M/yyyy",
    "M-d-yyyy",
    "d-M-yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "MMM d yyyy",
    "MMMM d yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
)
_TIME_TAIL = r"[ T]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?[AaPp][Mm])?$"


WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


def parse_day(value: Column) -> Column:
    """Day of a mixed-format date string; NULL when it is not a date.

    A time of day is dropped. Bare numbers such as ``5`` are not dates.
    """
    s = F.trim(value.cast("string"))
    day_text = F.regexp_extract(s, _ISO, 1)
    iso = F.when(day_text != "", day_text.try_cast("date"))
    day_part = F.trim(F.regexp_replace(s, _TIME_TAIL, ""))
    tried = [F.try_to_timestamp(day_part, F.lit(f)).cast("date") for f in _FORMATS]
    return F.coalesce(iso, *tried)


def as_day(value: Column, data_type: str) -> Column:
    """Floor to the day; typed dates and timestamps skip the text parser.

    Whole numbers are read like the same digits as text, so ``20240102`` is a day and ``5`` is none.
    """
    if data_type == "date":
        return value
    if data_type.startswith("timestamp"):
        return F.to_date(value)
    if data_type == "string" or data_type in WHOLE_NUMBERS:
        return parse_day(value)
    return F.lit(None).cast("date")


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def day_span(first: Column, last: Column, *, empty: str = "—") -> Column:
    """``Jun 3, 2024 to Oct 4, 2024``; a single date when both are the same day."""
    a, b = (F.date_format(c, "MMM d, yyyy") for c in (first, last))
    return F.coalesce(
        F.when(first == last, a).otherwise(F.concat(a, F.lit(" to "), b)),
        F.lit(empty),
    )
