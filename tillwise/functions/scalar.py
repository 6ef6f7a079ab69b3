"""Column helpers: casts, dates, numbers, text.  All stay inside Catalyst."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Col = Column | str


def _c(col: Col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- casts and defaults ------------------------------------------------------

def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = True) -> DataFrame:
    """Cast the named columns in one projection.

    ``safe`` turns a value that does not convert into NULL; otherwise the ANSI
    cast raises.
    """
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.withColumns(
        {c: F.col(c).try_cast(t) if safe else F.col(c).cast(t) for c, t in types.items()}
    )


def default_if_blank(col: Col, default: str) -> Column:
    """``default`` where the value is NULL or the empty string."""
    c = _c(col)
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def parse_bool(col: Col) -> Column:
    """Text to boolean, any letter case; text that is no boolean gives NULL."""
    return F.lower(_c(col)).try_cast("boolean")


def null_to_zero(col: Col) -> Column:
    return F.coalesce(_c(col), F.lit(0))


# --- dates -------------------------------------------------------------------

def to_date_safe(col: Col) -> Column:
    """Text or timestamp to date; NULL when it does not convert."""
    return _c(col).try_cast("date")


def to_timestamp_safe(col: Col) -> Column:
    return _c(col).try_cast("timestamp")


def in_year(col: Col, year: int) -> Column:
    """Year filter as a half-open range, so that the scan can use it."""
    c = _c(col)
    return (c >= F.lit(dt.date(year, 1, 1))) & (c < F.lit(dt.date(year + 1, 1, 1)))


def month_start(col: Col) -> Column:
    return F.trunc(_c(col), "month")


def week_start(col: Col) -> Column:
    """Monday of the week."""
    return F.trunc(_c(col), "week")


def fiscal_year(col: Col, start_month: int = 3) -> Column:
    return F.year(F.add_months(_c(col), -(start_month - 1)))


def fiscal_year_bounds(col: Col, start_month: int = 3) -> tuple[Column, Column]:
    """First and last calendar day of the fiscal year the date falls in."""
    start = F.make_date(fiscal_year(col, start_month), F.lit(start_month), F.lit(1))
    return start, F.last_day(F.add_months(start, 11))


#: fixed values: Spark numbers days 1 = Sunday … 7 = Saturday
WEEKEND_DAYS = (1, 7)
EVENING_HOURS = (16, 18)
NIGHT_FROM_HOUR = 19


def is_weekend(ts: Col) -> Column:
    return F.dayofweek(_c(ts)).isin(*WEEKEND_DAYS)


def is_weekday_evening(ts: Col, hours: tuple[int, int] = EVENING_HOURS) -> Column:
    return ~is_weekend(ts) & F.hour(_c(ts)).between(*hours)


def is_night(ts: Col, from_hour: int = NIGHT_FROM_HOUR) -> Column:
    return F.hour(_c(ts)) >= from_hour


# --- numbers -----------------------------------------------------------------

def rate(part: Col, whole: Col) -> Column:
    """Quotient as double; NULL for a zero or NULL denominator."""
    return F.try_divide(_c(part).cast("double"), _c(whole).cast("double"))


def scaled(col: Col, unit: float, digits: int = 0) -> Column:
    """Value in units of ``unit`` (10_000, 100_000_000 …), rounded half up."""
    return F.round(_c(col).cast("double") / F.lit(float(unit)), digits)


def percent(col: Col, digits: int = 2) -> Column:
    return F.round(_c(col).cast("double") * F.lit(100.0), digits)


def percent_exact(col: Col, digits: int = 2) -> Column:
    """Percentage rounded half up in the type of ``col``, so that a decimal 0.33995 is 34.00 %."""
    return F.round(_c(col) * F.lit(100), digits).cast("double")


def money(col: Col, scale: int = 2) -> Column:
    """Exact type for summing amounts: the result does not depend on row order."""
    return _c(col).cast(f"decimal(18,{scale})")


# --- text --------------------------------------------------------------------

def preview(col: Col, n: int) -> Column:
    return F.substring(_c(col), 1, n)


def split_list(col: Col, sep: str = ",") -> Column:
    """Delimited text to array; an empty array for NULL or empty text."""
    c = F.nullif(_c(col), F.lit(""))
    return F.coalesce(F.split(c, sep), F.array().cast("array<string>"))


#: fixed pattern: area code, exchange, last four digits
PHONE = r"(\d{2,4})[- ](\d{3,4})-(\d{4})"


def mask_phone(col: Col) -> Column:
    """Hide the middle group of a phone number wherever one occurs in the text."""
    return F.regexp_replace(_c(col), PHONE, "$1-XXXX-$3")


def map_labels(col: Col, mapping: Mapping[str, str], default: str) -> Column:
    """Look a code up in a small fixed mapping."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _c(col)), F.lit(default))


def conjunction(preds: Sequence[Column]) -> Column:
    """AND of the predicates; true for an empty list."""
    out = F.lit(True)
    for i, p in enumerate(preds):
        out = p if i == 0 else out & p
    return out
