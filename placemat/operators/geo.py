"""Search for places in a circle around a location."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.operators.ranking import top_per_location

EARTH_RADIUS_M = 6371000.0
DEFAULT_RADIUS_M = 5000
DEFAULT_LIMIT = 20


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lng = F.radians(lng2 - lng1) / 2
    h = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lng), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def _band(lat: Column, height: float) -> Column:
    return F.floor((lat + 90) / height).cast("int")


def _cells_in(band: Column, height: float) -> Column:
    """Cells around the globe in a latitude band, none narrower than the band is high."""
    edge = F.greatest(F.abs(band * height - 90), F.abs((band + 1) * height - 90))
    shrink = F.cos(F.radians(F.least(edge, F.lit(90.0))))
    return F.greatest(F.lit(1), F.floor(360 * shrink / height)).cast("int")


def _cell(lng: Column, cells: Column) -> Column:
    return F.floor((lng + 180) / 360 * cells).cast("int")


def _covering(centres: DataFrame, height: float) -> DataFrame:
    """Each centre once per grid cell that its circle, of its own ``_radius``, may reach."""
    reach = F.degrees(F.col("_radius") / EARTH_RADIUS_M) * 1.000001  # a hair wider than the circle
    lat, lng = F.col("_clat"), F.col("_clng")
    spread = F.when(F.abs(lat) + reach >= 90, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(reach)) / F.cos(F.radians(lat)))))
    )
    bands = F.sequence(_band(F.greatest(lat - reach, F.lit(-90.0)), height), _band(F.least(lat + reach, F.lit(90.0)), height))
    banded = centres.withColumns({"_reach": spread, "_band": F.explode(bands)}).withColumn(
        "_cells", _cells_in(F.col("_band"), height)
    )
    west, east = (_cell(lng - F.col("_reach"), F.col("_cells")), _cell(lng + F.col("_reach"), F.col("_cells")))
    all_round = F.sequence(F.lit(0), F.col("_cells") - 1)
    some = F.transform(F.sequence(west, east), lambda c: F.pmod(c, F.col("_cells")))
    cells = F.when(east - west + 1 >= F.col("_cells"), all_round).otherwise(some)
    return banded.withColumn("_cell", F.explode(cells)).drop("_reach", "_cells")


def places_around(
    places: DataFrame,
    centres: DataFrame,
    radius_m: float = DEFAULT_RADIUS_M,
    place_type: str | None = "restaurant",
    carried: Sequence[str] = (),
) -> DataFrame:
    """Every place of a type within reach of a centre, with its distance and the centre's ``carried`` columns.

    ``centres`` has ``name``, ``latitude`` and ``longitude``. Its own ``radius_m``, where the column is
    there and not null, counts in full; else the argument does. A grid of cells about as wide as the
    argument turns the search into an equality join, so places are compared with the centres nearby
    only, and the join follows Spark's own size check. A centre takes a row per cell its circle
    touches, so pass a ``radius_m`` about as large as most circles.
    """
    height = math.degrees(radius_m / EARTH_RADIUS_M) * 1.01
    located = places.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if place_type is not None:
        located = located.where(F.array_contains("types", place_type))
    band = _band(F.col("latitude"), height)
    located = located.withColumns({"_band": band, "_cell_count": _cells_in(band, height)}).withColumn(
        "_cell", F.pmod(_cell(F.col("longitude"), F.col("_cell_count")), F.col("_cell_count"))
    )
    own = F.coalesce(F.col("radius_m"), F.lit(radius_m)) if "radius_m" in centres.columns else F.lit(radius_m)
    placed = centres.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        F.col("name").alias("search_location"),
        F.col("latitude").alias("_clat"),
        F.col("longitude").alias("_clng"),
        own.cast("double").alias("_radius"),
        *carried,
    )
    around = _covering(placed, height)
    distance = haversine_m(F.col("_clat"), F.col("_clng"), F.col("latitude"), F.col("longitude"))
    return (
        located.join(around, ["_band", "_cell"])
        .withColumn("distance_m", distance)
        .where(F.col("distance_m") <= F.col("_radius"))
        .drop("_band", "_cell", "_cell_count", "_clat", "_clng", "_radius")
    )


def radius_filter(
    places: DataFrame,
    centres: DataFrame,
    radius_m: float = DEFAULT_RADIUS_M,
    place_type: str | None = "restaurant",
    limit: int = DEFAULT_LIMIT,
    tie: str = "row_key",
    search: Callable[..., DataFrame] = places_around,
) -> DataFrame:
    """The most reviewed places of a type in the circle around each centre.

    As many as the centre's own ``request_limit``, where the column is there and not null, else ``limit``. ``search`` is
    ``places_around``, or that of ``quadtree`` where places crowd or radii differ widely.
    """
    own = ["request_limit"] if "request_limit" in centres.columns else []
    found = search(places, centres, radius_m, place_type, own)
    order = [F.desc_nulls_last("review_count"), F.asc(tie)]
    most = F.coalesce(*[F.col(c) for c in own], F.lit(limit))
    # No centre keeps more than the largest limit, a number by which rows are dropped before they are shuffled.
    largest = centres.agg(F.max(most)).first()[0] if own else limit
    ranked = top_per_location(found, largest if largest is not None else limit, "search_location", order)
    return ranked.where(F.col("rank") <= most).drop(*own)
