"""The staging, dimension and serving models as composed frames."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.functions import clean, derive
from placemat.operators.filters import require_name
from placemat.operators.ranking import surrogate_id
from placemat.operators.shape import audit_columns, standardize_name
from placemat.schema import DIMENSION_COLUMNS, SERVING_COLUMNS, STAGING_COLUMNS


def clean_listings(df: DataFrame, at: Column | datetime | None = None, city_group: int = 1) -> DataFrame:
    """Staging columns next to the input's own, before a missing id is replaced.

    A plain projection over the scan. Reports that do not show the id start here, as numbering
    the rows is the only part of staging that moves data.
    """
    address = F.col("formatted_address")
    cleaned = standardize_name(require_name(df)).withColumns(
        {
            "rating": clean.clamp_rating(F.col("rating")),
            "data_source": clean.standardize_source(F.col("data_source")),
            "city": clean.city_of(address, city_group),
            "state": clean.state_of(address),
            "price_level": clean.clean_price_level(F.col("price_level")),
            "review_count": clean.clean_review_count(F.col("user_ratings_total")),
            "categories": clean.default_categories(F.col("categories")),
            "latitude": clean.clean_coordinate(F.col("latitude")),
            "longitude": clean.clean_coordinate(F.col("longitude")),
            "processed_at": clean.moment(at),
        }
    )
    return cleaned.withColumns(
        {
            "rating_category": derive.rating_category(F.col("rating")),
            "price_category": derive.price_category(F.col("price_level")),
        }
    )


def staging_listings(
    df: DataFrame,
    at: Column | datetime | None = None,
    key: str | None = None,
    city_group: int = 1,
    parts: int | None = None,
) -> DataFrame:
    """The staging model. Name a unique column as ``key`` to number rows without an id cheaply."""
    named = surrogate_id(require_name(df), key, parts=parts)
    return clean_listings(named, at, city_group).select(*STAGING_COLUMNS)


def rate_listings(df: DataFrame, as_of: Column | date | str | None = None) -> DataFrame:
    """Add the business metrics of the dimension to staging columns."""
    return df.withColumns(
        {
            "review_volume_category": derive.review_volume(F.col("review_count")),
            "full_location": derive.full_location(F.col("city"), F.col("state")),
            "business_tier": derive.business_tier(F.col("rating"), F.col("review_count")),
            "data_freshness": derive.data_freshness(F.col("ingestion_timestamp"), as_of),
        }
    )


def dim_listings(
    staging: DataFrame,
    run_id: str,
    as_of: Column | date | str | None = None,
    at: Column | datetime | None = None,
) -> DataFrame:
    """The dimension model over the staging model."""
    return audit_columns(rate_listings(staging, as_of), run_id, at).select(*DIMENSION_COLUMNS)


def enrich_listings(df: DataFrame, at: Column | datetime | None = None, city_group: int = 1) -> DataFrame:
    """One-shot batch enrichment that keeps every input column and every row."""
    address = F.col("formatted_address")
    cleaned = df.withColumns(
        {
            "restaurant_name": F.col("name"),
            "rating": clean.clamp_rating(F.col("rating")),
            "data_source": clean.standardize_source(F.col("data_source")),
            "city": clean.city_of(address, city_group),
            "state": clean.state_of(address),
            "price_level": clean.clean_price_level(F.col("price_level")),
            "review_count": clean.clean_review_count(F.col("user_ratings_total")),
            "latitude": clean.clean_coordinate(F.col("latitude")),
            "longitude": clean.clean_coordinate(F.col("longitude")),
            "processed_at": clean.moment(at),
        }
    )
    return classify(cleaned)


def classify(df: DataFrame) -> DataFrame:
    """Rating, price and tier labels of cleaned columns."""
    return df.withColumns(
        {
            "rating_category": derive.rating_category(F.col("rating")),
            "price_category": derive.price_category(F.col("price_level")),
            "business_tier": derive.business_tier(F.col("rating"), F.col("review_count")),
        }
    )


def serving_projection(df: DataFrame, place_id: str = "id") -> DataFrame:
    """The columns the serving reports read; the first is ``place_id`` under its input name."""
    renamed = {"place_id": place_id, "name": "restaurant_name"}
    return df.select(*[F.col(renamed.get(c, c)).alias(c) for c in SERVING_COLUMNS])


def detail_projection(df: DataFrame) -> DataFrame:
    """The detail table of the serving reports, with the rating drawn as stars."""
    stars = derive.star_rating(F.col("rating")).alias("star_rating")
    return df.select("name", stars, "city", "price_category", "review_count", "business_tier", "data_source")
