"""Frames made from driver-side records, and demonstration rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def from_records(spark: SparkSession, rows: Sequence[dict] | pd.DataFrame, schema=None) -> DataFrame:
    """A small driver-side list of dicts or pandas frame as a table."""
    return spark.createDataFrame(rows, schema) if schema else spark.createDataFrame(rows)


def _pick(seed: int, choices: Sequence, weights: Sequence[float] | None = None) -> Column:
    """A weighted random choice per row."""
    weights = weights or [1 / len(choices)] * len(choices)
    draw = F.rand(seed)
    bounds = [sum(weights[: i + 1]) for i in range(len(choices))]
    # The draw is made once per row, inside the array, and compared with every bound.
    position = F.aggregate(
        F.array(*[F.lit(b) for b in bounds[:-1]]),
        F.struct(draw.alias("u"), F.lit(1).alias("n")),
        lambda acc, b: F.struct(acc["u"].alias("u"), (acc["n"] + (acc["u"] >= b).cast("int")).alias("n")),
        lambda acc: acc["n"],
    )
    return F.element_at(F.array(*[F.lit(c) for c in choices]), position)


def _poisson(seed: int, mean: int) -> Column:
    """Poisson draw by comparing one uniform number with the cumulative probabilities."""
    top = int(mean + 12 * math.sqrt(mean))
    cumulative, term, total = [], math.exp(-mean), 0.0
    for k in range(top):
        total += term
        cumulative.append(total)
        term *= mean / (k + 1)
    return F.aggregate(
        F.array(*[F.lit(p) for p in cumulative]),
        F.struct(F.rand(seed).alias("u"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(acc["u"].alias("u"), (acc["n"] + (acc["u"] >= p).cast("int")).alias("n")),
        lambda acc: acc["n"],
    )


def demo_listings(spark: SparkSession, n: int = 50, seed: int = 42) -> DataFrame:
    """Random listings for demonstrations, the same for the same ``n``, ``seed`` and partitioning."""
    i = F.col("id") + 1
    rating = F.greatest(F.lit(1.0), F.least(F.lit(5.0), 3.8 + 0.8 * F.randn(seed)))
    # Choices and their weights.
    return spark.range(0, n).select(
        F.format_string("DEMO_%03d", i).alias("restaurant_id"),
        F.concat(F.lit("Demo Restaurant "), i.cast("string")).alias("restaurant_name"),
        rating.alias("rating"),
        _pick(
            seed + 1, ["Excellent", "Very Good", "Good", "Average", "Below Average"], [0.1, 0.2, 0.4, 0.2, 0.1]
        ).alias("rating_category"),
        F.lit("demo_data").alias("data_source"),
        _pick(seed + 2, ["San Francisco", "New York", "Los Angeles"]).alias("city"),
        _pick(seed + 3, ["CA", "NY", "CA"]).alias("state"),
        _pick(seed + 4, [1, 2, 3, 4], [0.3, 0.4, 0.2, 0.1]).alias("price_level"),
        _pick(seed + 5, ["$", "$$", "$$$", "$$$$"], [0.3, 0.4, 0.2, 0.1]).alias("price_category"),
        _poisson(seed + 6, 50).alias("review_count"),
        _pick(
            seed + 7, ["High Volume", "Medium Volume", "Low Volume", "Very Low Volume"], [0.2, 0.3, 0.3, 0.2]
        ).alias("review_volume_category"),
        _pick(
            seed + 8,
            ["Premium", "High Quality", "Good Quality", "Standard", "Needs Improvement"],
            [0.1, 0.2, 0.3, 0.3, 0.1],
        ).alias("business_tier"),
        (37.7 + 0.1 * F.rand(seed + 9)).alias("latitude"),
        (-122.5 + 0.1 * F.rand(seed + 10)).alias("longitude"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp").alias(
            "ingestion_timestamp"
        ),
        F.current_timestamp().alias("processed_at"),
    )
