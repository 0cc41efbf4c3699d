"""Flattening, renaming and cleaning of whole frames."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemat.functions import clean
from placemat.functions.jsontext import json_text


def flatten_json(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct fields become ``parent<sep>child`` columns and arrays become JSON text.

    When two paths give the same name the later one wins. Only the schema is looked at, so a
    key absent from one record is a null there.
    """
    columns: dict[str, Column] = {}

    def walk(fields: list[T.StructField], parent: Column | None, prefix: str) -> None:
        for field in fields:
            value = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
            name = f"{prefix}{sep}{field.name}" if prefix else field.name
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType.fields, value, name)
            elif isinstance(field.dataType, T.ArrayType):
                columns[name] = json_text(value, field.dataType)
            else:
                columns[name] = value

    walk(df.schema.fields, None, "")
    return df.select(*[c.alias(name) for name, c in columns.items()])


def places_v1_to_legacy(df: DataFrame) -> DataFrame:
    """New-style place records in the legacy shape, with the defaults that shape uses."""

    def filled(path: str, default: Column) -> Column:
        return F.coalesce(F.col(path), default)

    location = F.struct(
        filled("location.latitude", F.lit(0.0)).alias("lat"),
        filled("location.longitude", F.lit(0.0)).alias("lng"),
    )
    return df.select(
        filled("id", F.lit("")).alias("place_id"),
        filled("displayName.text", F.lit("Unknown")).alias("name"),
        filled("rating", F.lit(0.0)).alias("rating"),
        filled("userRatingCount", F.lit(0)).alias("user_ratings_total"),
        filled("priceLevel", F.lit("0")).alias("price_level"),
        filled("types", F.array().cast("array<string>")).alias("types"),
        filled("formattedAddress", F.lit("")).alias("formatted_address"),
        F.struct(location.alias("location")).alias("geometry"),
    )


def stamp_source(df: DataFrame, source: str, at: Column | datetime | None = None) -> DataFrame:
    return df.withColumns({"ingestion_timestamp": clean.moment(at), "data_source": F.lit(source)})


def flatten_listings(df: DataFrame, source: str, at: Column | datetime | None = None) -> DataFrame:
    return stamp_source(flatten_json(df), source, at)


#: One flat row per review; the parent key is already on each row.
flatten_reviews = flatten_listings


def standardize_name(df: DataFrame) -> DataFrame:
    """``restaurant_name`` from the trimmed name or the next best column that exists."""
    if "name" in df.columns:
        return df.withColumn("restaurant_name", F.trim("name"))
    if "restaurant_name" in df.columns:
        return df
    if "business_name" in df.columns:
        return df.withColumn("restaurant_name", F.col("business_name"))
    return df.withColumn("restaurant_name", F.lit("Unknown Restaurant"))


def extract_address(df: DataFrame, city_group: int = 1) -> DataFrame:
    address = F.col("formatted_address")
    return df.withColumns({"city": clean.city_of(address, city_group), "state": clean.state_of(address)})


def clean_coordinates(df: DataFrame, default: float | None = None) -> DataFrame:
    return df.withColumns(
        {name: clean.clean_coordinate(F.col(name), default) for name in ("latitude", "longitude")}
    )


def audit_columns(df: DataFrame, run_id: str, at: Column | datetime | None = None) -> DataFrame:
    now = clean.moment(at)
    columns = {"dbt_updated_at": now, "dbt_run_id": F.lit(run_id)}
    if "processed_at" not in df.columns:
        columns = {"processed_at": now} | columns
    return df.withColumns(columns)


def canonicalize(
    df: DataFrame,
    mapping: Mapping[str, str] | None = None,
    extra: tuple[str, ...] = (),
    defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Any flattened feed in the cleaned canonical columns.

    ``mapping`` names the input column behind a canonical one. An absent column gets its
    default instead of failing, and so does an unreadable value; ``defaults`` replaces the value
    an absent column gets. ``extra`` columns pass through.
    """
    mapping, own = mapping or {}, defaults or {}

    def given(name: str) -> Column | None:
        source = mapping.get(name, name)
        return F.col(f"`{source}`") if source in df.columns else None

    def pick(name: str, expression, default: Column) -> Column:
        value = given(name)
        if value is None:
            return F.lit(own[name]) if name in own else default
        return expression(value)

    named = standardize_name(df.withColumnRenamed(mapping["name"], "name") if "name" in mapping else df)
    text = F.lit(None).cast("string")
    unknown = F.lit(clean.UNKNOWN)
    return named.select(
        pick("id", lambda c: c.cast("string"), text).alias("id"),
        "restaurant_name",
        pick("rating", clean.clamp_rating_filled, F.lit(0.0)).alias("rating"),
        pick("data_source", clean.standardize_source, F.lit("unknown")).alias("data_source"),
        pick("formatted_address", clean.city_of, unknown).alias("city"),
        pick("formatted_address", clean.state_of, unknown).alias("state"),
        pick("formatted_address", lambda c: c, text).alias("formatted_address"),
        pick("price_level", clean.clean_price_level, F.lit(0)).alias("price_level"),
        pick("user_ratings_total", clean.clean_review_count, F.lit(0)).alias("review_count"),
        pick("latitude", lambda c: clean.clean_coordinate(c, 0.0), F.lit(0.0)).alias("latitude"),
        pick("longitude", lambda c: clean.clean_coordinate(c, 0.0), F.lit(0.0)).alias("longitude"),
        clean.default_categories(pick("categories", lambda c: c.cast("string"), text)).alias("categories"),
        pick("ingestion_timestamp", lambda c: c, F.lit(None).cast("timestamp")).alias("ingestion_timestamp"),
        *extra,
    )
