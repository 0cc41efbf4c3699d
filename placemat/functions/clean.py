"""Cleaning expressions, Column to Column."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Street, city and two-letter state inside a formatted address.
ADDRESS_PATTERN = r"([^,]+),\s*([^,]+),\s*([A-Z]{2})"
STATE_GROUP = 3
UNKNOWN = "Unknown"


def moment(at: Column | datetime | None = None) -> Column:
    """``at`` as a column, or the time of the query."""
    if at is None:
        return F.current_timestamp()
    return at if isinstance(at, Column) else F.lit(at)


def day(as_of: Column | date | str | None = None) -> Column:
    """``as_of`` as a date column, or the date of the query."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.to_date(F.lit(as_of))


def clamp_rating(c: Column, lo: float = 0, hi: float = 5) -> Column:
    """Rating forced into [lo, hi]. Null stays null; NaN and unreadable text count as null."""
    number = c.try_cast("double")
    return F.when(number <= float("inf"), F.least(F.greatest(number, F.lit(float(lo))), F.lit(float(hi))))


def clamp_rating_filled(c: Column, lo: float = 0, hi: float = 5) -> Column:
    """Variant that fills a missing rating with zero before clamping."""
    return F.coalesce(clamp_rating(c, lo, hi), clamp_rating(F.lit(0.0), lo, hi))


def standardize_source(c: Column) -> Column:
    return F.lower(c.cast("string"))


def address_part(address: Column, group: int) -> Column:
    """One group of the address pattern, 'Unknown' without a match."""
    part = F.regexp_extract(address, ADDRESS_PATTERN, group)
    return F.coalesce(F.nullif(part, F.lit("")), F.lit(UNKNOWN))


def city_of(address: Column, group: int = 1) -> Column:
    """City of an address.

    Group 1 is what the published models call the city (the text before the first matching
    comma); group 2 is the town of a 'street, town, ST' address and comes trimmed.
    """
    part = address_part(address, group)
    return part if group == 1 else F.trim(part)


def state_of(address: Column) -> Column:
    return address_part(address, STATE_GROUP)


def whole_number(c: Column) -> Column:
    """Number or numeric text truncated to an int, 0 for anything unreadable."""
    return F.coalesce(c.try_cast("double").try_cast("int"), F.lit(0))


def clean_price_level(c: Column) -> Column:
    return whole_number(c)


def clean_review_count(c: Column) -> Column:
    return whole_number(c)


def clean_coordinate(c: Column, default: float | None = None) -> Column:
    """Coordinate as double; unreadable text becomes ``default`` (null unless given)."""
    number = c.try_cast("double")
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def default_categories(c: Column) -> Column:
    return F.coalesce(c, F.lit("[]"))


def event_time(c: Column) -> Column:
    """Timestamp from epoch seconds (whole or fractional, as text) or ISO text, else null."""
    return F.coalesce(F.timestamp_seconds(c.try_cast("double")), c.try_cast("timestamp"))
