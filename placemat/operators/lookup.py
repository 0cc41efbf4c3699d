"""Lookups by key.

No side carries a broadcast hint: Spark broadcasts a side when its size is below the configured
threshold and otherwise sorts and merges. Adaptive execution splits a skewed key at run time, and so
also null keys, which match nothing and stay. The joins use the key alone, so a projection that
comes later still reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def attach_coordinates(df: DataFrame, locations: DataFrame, on: str = "search_location") -> DataFrame:
    """``lat`` and ``lng`` of each row's location, null where the location has none."""
    known = locations.select(
        F.col("name").alias(on), F.col("coordinates.lat").alias("lat"), F.col("coordinates.lng").alias("lng")
    )
    return df.join(known, on, "left")


def attach_details(df: DataFrame, details: DataFrame, key: str = "id") -> DataFrame:
    return df.join(details, key, "left")


def prefer_source(primary: DataFrame, fallback: DataFrame, key: str = "search_location") -> DataFrame:
    """Rows of ``primary``, and of ``fallback`` only where ``primary`` has none for the key."""
    served = primary.select(key).distinct()
    return primary.unionByName(fallback.join(served, key, "left_anti"))


def attach_parent_key(parents: DataFrame, parent_id: str, children: str = "reviews") -> DataFrame:
    """One row per child with the parent's id next to its fields."""
    return parents.select(
        F.coalesce(F.col(parent_id), F.lit("")).alias(parent_id), F.explode(children).alias("_child")
    ).select(parent_id, "_child.*")


def validate_locations(df: DataFrame, locations: DataFrame, on: str = "name") -> DataFrame:
    """Add ``is_valid``: the name exists and is enabled."""
    enabled = locations.where("enabled").select(F.col("name").alias(on)).distinct()
    flagged = df.join(enabled.withColumn("_found", F.lit(True)), on, "left")
    return flagged.withColumn("is_valid", F.col("_found").isNotNull()).drop("_found")

