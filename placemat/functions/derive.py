"""Classifying and formatting expressions, Column to Column.

A null input fails every comparison, so it falls through to the last label unless noted.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from placemat.functions.clean import UNKNOWN, day

# The least rating of each label, and the label below them all.
RATING_FLOORS = ((4.5, "Excellent"), (4.0, "Very Good"), (3.5, "Good"), (3.0, "Average"))
LOWEST_RATING = "Below Average"

# The highest rating of each label of the binned variant, which starts above 0.
RATING_CEILINGS = ((3.0, "Below Average"), (3.5, "Average"), (4.0, "Good"), (4.5, "Very Good"), (5.0, "Excellent"))

# Least rating, least reviews and name of each tier, and the tier below them all.
TIERS = ((4.5, 100, "Premium"), (4.0, 50, "High Quality"), (3.5, None, "Good Quality"), (3.0, None, "Standard"))
LOWEST_TIER = "Needs Improvement"

# The least number of reviews of each volume, and the volume below them all.
VOLUME_FLOORS = ((100, "High Volume"), (50, "Medium Volume"), (10, "Low Volume"))
LOWEST_VOLUME = "Very Low Volume"

# The highest number of reviews of each volume of the serving variant, starting above 0.
VOLUME_CEILINGS = (
    (10, "Very Low Volume"), (50, "Low Volume"), (200, "Medium Volume"), (float("inf"), "High Volume")
)

# The greatest age in days of each freshness, and the freshness beyond them all.
AGES = ((1, "Very Fresh"), (7, "Fresh"), (30, "Recent"))
OLDEST = "Stale"

# The characters that draw a rating.
FULL_STAR = "⭐"
EMPTY_STAR = "☆"


def _first(cases: Sequence[tuple[Column, str]], otherwise: str | None) -> Column:
    """The label of the first condition that holds."""
    chosen = F
    for condition, label in cases:
        chosen = chosen.when(condition, F.lit(label))
    return chosen.otherwise(F.lit(otherwise))


def _by_floor(c: Column, floors: Sequence[tuple[float, str]], lowest: str) -> Column:
    return _first([(c >= floor, label) for floor, label in floors], lowest)


def _by_bin(c: Column, ceilings: Sequence[tuple[float, str]]) -> Column:
    """Bins that include their upper bound, the first one starting above zero; null outside."""
    return F.when(c > 0, _first([(c <= ceiling, label) for ceiling, label in ceilings], None))


def rating_category(rating: Column) -> Column:
    return _by_floor(rating, RATING_FLOORS, LOWEST_RATING)


def rating_category_binned(rating: Column) -> Column:
    return _by_bin(rating, RATING_CEILINGS)


def price_category(level: Column, unmapped: str | None = UNKNOWN) -> Column:
    """1..4 as dollar signs; pass ``unmapped=None`` to leave other levels null."""
    return F.when(level.between(1, 4), F.repeat(F.lit("$"), level)).otherwise(F.lit(unmapped))


def business_tier(rating: Column, reviews: Column) -> Column:
    def reached(stars: float, count: int | None) -> Column:
        return rating >= stars if count is None else (rating >= stars) & (reviews >= count)

    return _first([(reached(stars, count), name) for stars, count, name in TIERS], LOWEST_TIER)


def business_tier_sequential(rating: Column, reviews: Column) -> Column:
    """Compatibility variant in which a later rule overrides an earlier one.

    The rules with a review count come first there, so those two tiers never survive, and a
    null rating, which no rule catches, keeps the initial tier.
    """
    return F.when(rating >= 3.5, "Good Quality").when(rating < 3.0, LOWEST_TIER).otherwise("Standard")


def review_volume(reviews: Column) -> Column:
    return _by_floor(reviews, VOLUME_FLOORS, LOWEST_VOLUME)


def review_volume_binned(reviews: Column) -> Column:
    return _by_bin(reviews, VOLUME_CEILINGS)


def full_location(city: Column, state: Column) -> Column:
    return F.concat(F.coalesce(city, F.lit(UNKNOWN)), F.lit(", "), F.coalesce(state, F.lit(UNKNOWN)))


def data_freshness(ts: Column, as_of: Column | date | str | None = None) -> Column:
    age = F.datediff(day(as_of), F.to_date(ts))
    return _first([(age <= most, label) for most, label in AGES], OLDEST)


def _whole_and_half(rating: Column) -> tuple[Column, Column]:
    whole = rating.cast("int")
    return whole, F.when(rating - whole >= 0.5, 1).otherwise(0)


def star_rating_compact(rating: Column) -> Column:
    """One star per whole point and one more for half a point."""
    whole, half = _whole_and_half(rating)
    return F.repeat(F.lit(FULL_STAR), whole + half)


def star_rating(rating: Column) -> Column:
    """Five stars, full then empty, and the number; 'No rating' for null or NaN."""
    whole, half = _whole_and_half(rating)
    stars = F.concat(
        star_rating_compact(rating),
        F.repeat(F.lit(EMPTY_STAR), 5 - whole - half),
        F.lit(" ("),
        F.format_number(rating, 1),
        F.lit(")"),
    )
    return F.when(rating.isNull() | F.isnan(rating), "No rating").otherwise(stars)
