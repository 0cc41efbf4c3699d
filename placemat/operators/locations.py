"""The location dimension: selection, policy and maintenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemat.operators.ranking import global_row_number, top_per_location

# Records per request and search radius in metres by priority, in processing order.
PRIORITY_POLICY = {"high": (50, 5000), "medium": (30, 3000), "low": (20, 2000)}

# What a new location gets when it does not say otherwise.
LOCATION_DEFAULTS = {"country": "US", "priority": "medium", "enabled": True}


def enabled_locations(locations: DataFrame) -> DataFrame:
    return locations.where("enabled")


def enabled_location_names(locations: DataFrame) -> DataFrame:
    return enabled_locations(locations).select("name")


def locations_by_priority(locations: DataFrame, priority: str, enabled_only: bool = True) -> DataFrame:
    chosen = locations.where(F.col("priority") == priority)
    return enabled_locations(chosen) if enabled_only else chosen


def explode_categories(categories: DataFrame, column: str = "categories") -> DataFrame:
    """A map of category to names as (category, name) rows."""
    return categories.select(F.explode(column).alias("category", "names")).select(
        "category", F.explode("names").alias("name")
    )


def locations_by_category(locations: DataFrame, members: DataFrame, category: str) -> DataFrame:
    """Enabled locations among the (category, name) rows; an unknown category has none."""
    wanted = members.where(F.col("category") == category).select("name")
    return enabled_locations(locations).join(wanted, "name", "left_semi")


def priority_rank(priority: Column) -> Column:
    rank = F.lit(len(PRIORITY_POLICY))
    for position, name in enumerate(PRIORITY_POLICY):
        rank = F.when(priority == name, position).otherwise(rank)
    return rank


def apply_priority_policy(locations: DataFrame) -> DataFrame:
    """Add the request limit and search radius of each location's priority."""
    limits = [F.when(F.col("priority") == p, limit) for p, (limit, _) in PRIORITY_POLICY.items()]
    radii = [F.when(F.col("priority") == p, radius) for p, (_, radius) in PRIORITY_POLICY.items()]
    return locations.withColumns({"request_limit": F.coalesce(*limits), "radius_m": F.coalesce(*radii)})


def top_by_policy(
    listings: DataFrame, locations: DataFrame, by: str = "search_location", unlisted_limit: int = 20
) -> DataFrame:
    """The best-rated listings of each location, as many as the location's priority allows.

    A location that is not in ``locations``, or whose priority the policy does not list, gets
    ``unlisted_limit``. The largest limit prunes first, so the join sees few rows per location.
    """
    most = max(unlisted_limit, *[limit for limit, _ in PRIORITY_POLICY.values()])
    limits = apply_priority_policy(locations).select(F.col("name").alias(by), "request_limit")
    limited = top_per_location(listings, most, by).join(limits, by, "left")
    limited = limited.withColumn("request_limit", F.coalesce("request_limit", F.lit(unlisted_limit)))
    return limited.where(F.col("rank") <= F.col("request_limit"))


def order_by_priority(locations: DataFrame, tie: str = "ordinal") -> DataFrame:
    return locations.orderBy(priority_rank(F.col("priority")), tie)


def assign_batches(
    locations: DataFrame, size: int = 5, tie: str = "ordinal", parts: int | None = None
) -> DataFrame:
    """Batch number in priority order, ``size`` locations to a batch, counted from 0."""
    ranked = locations.withColumn("_rank", priority_rank(F.col("priority")))
    numbered = global_row_number(ranked, ["_rank", tie], "_number", parts)
    batch = F.floor((F.col("_number") - 1) / size).cast("bigint")
    return numbered.withColumn("batch", batch).drop("_rank", "_number")


def location_status(locations: DataFrame, members: DataFrame) -> DataFrame:
    """Totals, enabled locations and category sizes as (metric, name, value) rows."""
    none = F.lit(None).cast("string")
    totals = locations.agg(F.count("*").alias("total"), F.count_if("enabled").alias("enabled")).select(
        F.explode(F.create_map(F.lit("total"), "total", F.lit("enabled"), "enabled")).alias("metric", "value")
    )
    sizes = members.groupBy("category").agg(F.count("*").alias("value"))
    return totals.select("metric", none.alias("name"), "value").unionByName(
        sizes.select(F.lit("category").alias("metric"), F.col("category").alias("name"), "value")
    )


def add_locations(locations: DataFrame, new: DataFrame, order: Sequence[str] = ("ordinal",)) -> DataFrame:
    """Insert the locations whose name is not taken; among equal new names the first is taken.

    A location needs a name: new ones without are left out.
    """
    filled = new.where(F.col("name").isNotNull())
    for name, value in LOCATION_DEFAULTS.items():
        default = F.lit(value)
        filled = filled.withColumn(name, F.coalesce(F.col(name), default) if name in new.columns else default)
    first = F.row_number().over(Window.partitionBy("name").orderBy(*order))
    novel = filled.join(locations.select("name"), "name", "left_anti").withColumn("_first", first)
    return locations.unionByName(novel.where("_first = 1").drop("_first"), allowMissingColumns=True)


def remove_locations(locations: DataFrame, names: DataFrame) -> DataFrame:
    return locations.join(names.select("name"), "name", "left_anti")


def set_enabled(locations: DataFrame, names: DataFrame, enabled: bool) -> DataFrame:
    """Switch the named locations on or off; names that do not exist change nothing."""
    named = names.select("name").distinct().withColumn("_named", F.lit(True))
    switched = F.when(F.col("_named"), F.lit(enabled)).otherwise(F.col("enabled"))
    columns = locations.columns
    return locations.join(named, "name", "left").withColumn("enabled", switched).select(*columns)
