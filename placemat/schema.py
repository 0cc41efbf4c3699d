"""Schemas and fixed values shared by the batch, SQL-model and streaming paths."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical raw listing, all fields nullable.
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("data_source", T.StringType()),
        T.StructField("formatted_address", T.StringType()),
        T.StructField("price_level", T.IntegerType()),
        T.StructField("user_ratings_total", T.IntegerType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("categories", T.StringType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
    ]
)

# The same record as it travels in a message: the event time is text there,
# because producers send epoch numbers as well as ISO text.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "ingestion_timestamp" else f.dataType)
        for f in LISTING_SCHEMA
    ]
)

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

PLACE_V1 = (
    "id string, displayName struct<text:string>, rating double, userRatingCount int, "
    "priceLevel string, types array<string>, formattedAddress string, "
    "location struct<latitude:double,longitude:double>"
)

PLACE_LEGACY = (
    "place_id string, name string, rating double, user_ratings_total int, price_level string, "
    "types array<string>, formatted_address string, "
    "geometry struct<location:struct<lat:double,lng:double>>"
)

LOCATION = (
    "name string, country string, priority string, enabled boolean, "
    "coordinates struct<lat:double,lng:double>, last_updated string"
)

SEED = "id string, name string, rating float, data_source string"

# Columns of the staging model, in order.
STAGING_COLUMNS = (
    "restaurant_id", "restaurant_name", "rating", "data_source", "city", "state",
    "price_level", "review_count", "categories", "latitude", "longitude",
    "ingestion_timestamp", "processed_at", "rating_category", "price_category",
)

# Columns of the dimension model, in order.
DIMENSION_COLUMNS = (
    "restaurant_id", "restaurant_name", "rating", "rating_category", "data_source",
    "city", "state", "full_location", "price_level", "price_category", "review_count",
    "review_volume_category", "categories", "latitude", "longitude", "business_tier",
    "data_freshness", "ingestion_timestamp", "processed_at", "dbt_updated_at", "dbt_run_id",
)

# Columns of the serving table, in order.
SERVING_COLUMNS = (
    "place_id", "name", "rating", "review_count", "price_level", "price_category",
    "business_tier", "rating_category", "city", "state", "formatted_address",
    "latitude", "longitude", "data_source", "ingestion_timestamp", "processed_at",
)

# Columns every listing frame must have.
REQUIRED_COLUMNS = ("name", "rating", "data_source")

# Accepted feeds.
FEEDS = ("yelp", "google_places")

# Per-feed renames from flattened records to the canonical schema.
PLACES_MAPPING = {
    "id": "place_id",
    "categories": "types",
    "latitude": "geometry_location_lat",
    "longitude": "geometry_location_lng",
}
