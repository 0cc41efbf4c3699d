"""Aggregates behind the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.schema import FEEDS


def avg_rating_by(df: DataFrame, by: str) -> DataFrame:
    """Mean rating per group, best first; a null group is left out."""
    means = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.avg("rating").alias("avg_rating"))
    return means.orderBy(F.desc_nulls_last("avg_rating"), by)


def value_counts(df: DataFrame, by: str) -> DataFrame:
    """Rows per value, most frequent first; null is left out."""
    counts = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), by)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def histogram(
    df: DataFrame, column: str = "rating", bins: int = 20, lo: float | None = None, hi: float | None = None
) -> DataFrame:
    """Rows in each of ``bins`` equal-width bins of [lo, hi], empty ones too; the last includes ``hi``.

    A bound that is not given is the column's own least or largest value, which takes one pass more.
    A value belongs to the last bin whose ``bin_start`` it reaches. Values outside the bounds, null
    and NaN count nowhere.
    """
    value = F.col(column)
    if lo is None or hi is None:
        found = df.where(~F.isnan(value.cast("double"))).agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
        lo = found["lo"] if lo is None else lo
        hi = found["hi"] if hi is None else hi
        lo, hi = float(lo or 0.0), float(hi if hi is not None else lo or 0.0)
    starts = [lo + (hi - lo) * i / bins for i in range(bins)]
    edges = F.array(*[F.lit(float(e)) for e in starts])
    position = (F.size(F.filter(edges, lambda e: e <= value)) - 1).cast("int")
    counts = df.where(value.between(lo, hi)).groupBy(position.alias("bin")).agg(F.count("*").alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    filled = every.join(counts, "bin", "left").fillna(0, ["count"])
    return filled.select("bin", F.element_at(edges, F.col("bin") + 1).alias("bin_start"), "count").orderBy("bin")


def kpis(df: DataFrame, predicate: Column) -> DataFrame:
    """Headline numbers of the rows that pass, each with its difference from all rows, in one pass."""

    flagged = df.select(predicate.alias("_in"), "rating", F.col("review_count").cast("bigint").alias("reviews"))
    rating, reviews = F.col("rating"), F.col("reviews")

    def chosen(value: Column) -> Column:
        return F.when(F.col("_in"), value)

    sums = flagged.agg(
        F.count_if("_in").alias("total"),
        F.count("*").alias("_all"),
        F.avg(chosen(rating)).alias("avg_rating"),
        F.avg(rating).alias("_avg"),
        F.coalesce(F.sum(chosen(reviews)), F.lit(0)).alias("total_reviews"),
        F.coalesce(F.sum(reviews), F.lit(0)).alias("_reviews"),
        F.max(chosen(rating)).alias("max_rating"),
        F.max(rating).alias("_max"),
    )
    return sums.select(
        "total",
        (F.col("total") - F.col("_all")).alias("total_delta"),
        "avg_rating",
        (F.col("avg_rating") - F.col("_avg")).alias("avg_rating_delta"),
        "total_reviews",
        (F.col("total_reviews") - F.col("_reviews")).alias("total_reviews_delta"),
        "max_rating",
        (F.col("max_rating") - F.col("_max")).alias("max_rating_delta"),
    )


def city_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("city").agg(
        F.avg("rating").alias("avg_rating"), F.sum("user_ratings_total").alias("sum_user_ratings_total")
    )


def price_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("price_level").agg(
        F.avg("rating").alias("avg_rating"), F.count("user_ratings_total").alias("count_user_ratings_total")
    )


def ingest_stats(df: DataFrame, locations: DataFrame, feeds: Sequence[str] = FEEDS) -> DataFrame:
    """Rows per location and feed, all rows of a location, the feeds it has rows of, and its status.

    Every row counts somewhere: locations that are not listed, and null, have rows of their own
    (``listed`` is false there). Status is 'success', or 'no records' for a listed location without rows.
    """
    source = F.lower("data_source")
    counts = df.groupBy("search_location").agg(
        *[F.count_if(source == f).alias(f"{f}_records") for f in feeds], F.count("*").alias("records")
    )
    listed = locations.select(F.col("name").alias("_name")).distinct()
    both = counts.join(listed, F.col("search_location").eqNullSafe(F.col("_name")), "full_outer")
    filled = both.fillna(0, [*[f"{f}_records" for f in feeds], "records"])
    used = [F.when(F.col(f"{f}_records") > 0, F.lit(f)) for f in sorted(feeds)]
    return filled.select(
        F.coalesce("search_location", "_name").alias("search_location"),
        *[f"{f}_records" for f in feeds],
        "records",
        F.array_compact(F.array(*used)).alias("sources_used"),
        F.col("_name").isNotNull().alias("listed"),
        F.when(F.col("records") > 0, "success").otherwise("no records").alias("status"),
    )


def run_summary(df: DataFrame, feeds: Sequence[str] = FEEDS) -> DataFrame:
    """Records, locations and the feeds that delivered rows, as one row."""
    source = F.lower("data_source")
    seen = [F.when(F.count_if(source == f) > 0, F.lit(f)) for f in sorted(feeds)]
    return df.agg(
        F.count("*").alias("records_processed"),
        F.count_distinct("search_location").alias("locations_processed"),
        F.array_compact(F.array(*seen)).alias("sources_used"),
    ).withColumn("total_sources", F.size("sources_used"))
