"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_name(df: DataFrame) -> DataFrame:
    return df.where(F.col("name").isNotNull())


def valid_listings(df: DataFrame) -> DataFrame:
    """Rows with a name and a rating in [0, 5]; a null or NaN rating is not valid."""
    return df.where(F.col("name").isNotNull() & F.col("rating").between(0, 5))


def _chosen(column: str, choices: Sequence[str | None]) -> Column:
    """Membership in which a None among the choices stands for null rows."""
    member = F.coalesce(F.col(column).isin([c for c in choices if c is not None]), F.lit(False))
    return member | F.col(column).isNull() if None in choices else member


def listing_predicate(
    cities: Sequence[str | None] | None = None,
    min_rating: float | None = 3.0,
    prices: Sequence[str | None] | None = None,
    sources: Sequence[str | None] | None = None,
) -> Column:
    """The serving filter as one predicate; an argument left None restricts nothing."""
    predicate = F.lit(True)
    for column, choices in (("city", cities), ("price_category", prices), ("data_source", sources)):
        if choices is not None:
            predicate = predicate & _chosen(column, choices)
    if min_rating is not None:
        predicate = predicate & F.coalesce(F.col("rating") >= min_rating, F.lit(False))
    return predicate


def filter_listings(df: DataFrame, **choices) -> DataFrame:
    """Rows that pass ``listing_predicate(**choices)``."""
    return df.where(listing_predicate(**choices))


def search_name(df: DataFrame, term: str = "") -> DataFrame:
    """Rows whose name contains the regular expression ``term`` in any case."""
    return df.where(F.col("name").rlike(f"(?iu){term}")) if term else df
