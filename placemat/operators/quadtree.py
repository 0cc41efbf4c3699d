"""Radius search over cells that follow the density of the places.

A uniform grid puts a dense city into one cell. Here the world is a quadtree over latitude and longitude: a cell with
more places than a bound is split into four, down to ``DEPTH`` levels; a cell of that depth which is still too full
(many places at one address) is dealt into shares. So no (cell, share) holds more than about the bound, whatever
the skew, and the join on it has no hot key.

A cell's places have codes (bits of both axes interleaved) in one interval, and the leaves of the tree are such
intervals side by side. They are found from counts per finest cell in one shuffle; only cells that are split come
to the driver, at most ``DEPTH * rows / bound`` of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.operators.geo import DEFAULT_RADIUS_M, EARTH_RADIUS_M, haversine_m

DEPTH = 20  # finest cells are about 20 by 40 metres
SIDE = 1 << DEPTH


class Leaves(NamedTuple):
    """First code of every leaf in ascending order, and in how many shares its places are dealt."""

    starts: list[int]
    shares: list[int]


def _axis(value: Column, low: float, span: float) -> Column:
    """Finest cell along one axis; the upper end belongs to the last cell."""
    return F.greatest(F.lit(0), F.least(F.lit(SIDE - 1), F.floor((value - low) / span * SIDE))).cast("bigint")


def _spread_bits(n: Column) -> Column:
    """The bits of a number with a zero before each: its binary digits, read to base 4."""
    return F.conv(F.bin(n), 4, 10).cast("bigint")


def _interleave(row: Column, column: Column) -> Column:
    return F.shiftleft(_spread_bits(row), 1).bitwiseOR(_spread_bits(column))


def _longitude(lng: Column) -> Column:
    """The same meridian from -180 up to, not including, 180."""
    return F.pmod(lng + 180, F.lit(360.0)) - 180


def code(lat: Column, lng: Column) -> Column:
    """Number of the finest cell of a point, near ones mostly near each other."""
    return _interleave(_axis(lat, -90, 180), _axis(_longitude(lng), -180, 360))


def find_leaves(located: DataFrame, most: int) -> Leaves:
    """Leaves of the tree over ``located`` (column ``_code``) in which no cell above the finest has over ``most`` rows."""
    counts = located.groupBy("_code").agg(F.count("*").alias("n"))
    level = F.explode(F.sequence(F.lit(0), F.lit(DEPTH))).alias("level")
    cells = counts.select("n", "_code", level).select(
        "level", F.expr(f"shiftright(_code, 2 * ({DEPTH} - level))").alias("cell"), "n"
    )
    full = cells.groupBy("level", "cell").agg(F.sum("n").alias("n")).where(F.col("n") > most).collect()
    split = {(r["level"], r["cell"]): r["n"] for r in full}
    leaves = []
    for depth, cell in [(-1, 0), *split]:
        children = [(0, 0)] if depth < 0 else [(depth + 1, 4 * cell + i) for i in range(4)]
        for child in children if depth < DEPTH else []:
            n = split.get(child)
            if n is None or child[0] == DEPTH:
                leaves.append((child[1] << 2 * (DEPTH - child[0]), -(-(n or 1) // most)))
    leaves.sort()
    return Leaves([start for start, _ in leaves], [shares for _, shares in leaves])


def _constants(values: Sequence[int]) -> Column:
    """An array of constants; as text, it is one expression however many there are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def with_leaf(df: DataFrame, leaves: Leaves, position: Column, name: str = "_leaf") -> DataFrame:
    """``df`` with the index of the leaf whose interval holds the code ``position``, from 0.

    Spark's ``Bucketizer`` halves a sorted array in the JVM; codes are far below 2**53, so they are whole as doubles.
    """
    if len(leaves.starts) == 1:  # fewer than the two buckets that it asks for
        return df.withColumn(name, F.lit(0))
    cut = Bucketizer(splits=[*map(float, leaves.starts), float("inf")], inputCol="_position", outputCol=name)
    found = cut.transform(df.withColumn("_position", position.cast("double"))).drop("_position")
    return found.withColumn(name, F.col(name).cast("int"))


def _shares_of(leaf: Column, leaves: Leaves) -> Column:
    return F.element_at(_constants(leaves.shares), leaf + 1)


def with_cells(located: DataFrame, leaves: Leaves) -> DataFrame:
    """Places with ``_leaf`` and ``_share``; rows of a leaf are dealt over its shares by a hash of what they hold."""
    held = [c for c, kind in located.dtypes if "map<" not in kind and "variant" not in kind]
    leaf = with_leaf(located, leaves, F.col("_code"))
    shares = _shares_of(F.col("_leaf"), leaves)
    share = F.when(shares == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64(*held), shares)).cast("bigint")
    # Never null, and plainly so: else the join would compute it once more in a filter before.
    return leaf.withColumn("_share", F.coalesce(share, F.lit(0).cast("bigint")))


def _covering(centres: DataFrame, leaves: Leaves) -> DataFrame:
    """Each centre once per leaf and share that the box around its circle may reach."""
    reach = F.degrees(F.col("_radius") / EARTH_RADIUS_M) * 1.000001 + 1e-9  # a hair wider than the circle
    lat, lng = F.col("_clat"), F.col("_clng")
    over_pole = F.abs(lat) + reach >= 90
    ratio = F.least(F.lit(1.0), F.sin(F.radians(reach)) / F.cos(F.radians(lat)))
    spread = F.when(over_pole, F.lit(180.0)).otherwise(F.degrees(F.asin(ratio)) + 1e-9)
    boxed = centres.withColumns({"_reach": reach, "_spread": spread})
    # The finest level whose cells are no smaller than the box, which then touches two of them along each axis at most.
    fits = F.least(F.log2(F.lit(90.0) / F.col("_reach")), F.log2(F.lit(180.0) / F.col("_spread")), F.lit(float(DEPTH)))
    boxed = boxed.withColumn("_down", F.lit(DEPTH) - F.greatest(F.lit(0), F.floor(fits)).cast("int"))

    def coarse(finest: Column) -> Column:
        return F.call_function("shiftright", finest, F.col("_down"))

    def row(value: Column) -> Column:
        return coarse(_axis(value, -90, 180))

    west, east = _longitude(lng - F.col("_spread")), _longitude(lng + F.col("_spread"))
    rows = F.sequence(row(lat - F.col("_reach")), row(lat + F.col("_reach")))
    # At level 0 there is one column; else the box is no wider than a cell, so its ends stand in all it touches.
    ends = F.array_distinct(F.array(coarse(_axis(west, -180, 360)), coarse(_axis(east, -180, 360))))
    cell = boxed.withColumn("_row", F.explode(rows)).withColumn("_column", F.explode(ends))
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), 2 * F.col("_down"))
    cell = cell.withColumn("_from", _interleave(F.col("_row"), F.col("_column")) * size).withColumn("_to", F.col("_from") + size - 1)
    ends_at = with_leaf(with_leaf(cell, leaves, F.col("_from"), "_first"), leaves, F.col("_to"), "_last")
    spans = ends_at.select(*centres.columns, F.sequence("_first", "_last").alias("_reached"))
    # Cells smaller than a leaf meet in it: each centre lists a leaf once.
    own = [F.col(c) for c in centres.columns]
    leaf = spans.groupBy(*own).agg(F.array_distinct(F.flatten(F.collect_list("_reached"))).alias("_reached"))
    leaf = leaf.withColumn("_leaf", F.explode("_reached")).drop("_reached")
    shares = _shares_of(F.col("_leaf"), leaves)
    return leaf.withColumn("_share", F.explode(F.sequence(F.lit(0).cast("bigint"), shares - 1)))


def places_around(
    places: DataFrame,
    centres: DataFrame,
    radius_m: float = DEFAULT_RADIUS_M,
    place_type: str | None = "restaurant",
    carried: Sequence[str] = (),
    most: int | None = None,
) -> DataFrame:
    """Rows of ``geo.places_around``, found in cells of at most about ``most`` places.

    Centres may have circles of very different size, as no width is fixed. ``most`` defaults to a quarter of the
    average shuffle partition. Places are counted in one pass before they are joined; where they are spread evenly,
    the uniform grid saves that pass. Places or centres without coordinates are in no result.
    """
    located = places.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if place_type is not None:
        located = located.where(F.array_contains("types", place_type))
    located = located.withColumn("_code", code(F.col("latitude"), F.col("longitude")))
    if most is None:
        parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        most = max(1000, located.count() // (4 * parts))
    leaves = find_leaves(located, most)
    own = F.coalesce(F.col("radius_m"), F.lit(radius_m)) if "radius_m" in centres.columns else F.lit(radius_m)
    placed = centres.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        F.monotonically_increasing_id().alias("_centre"),
        F.col("name").alias("search_location"),
        F.col("latitude").cast("double").alias("_clat"),
        F.col("longitude").cast("double").alias("_clng"),
        own.cast("double").alias("_radius"),
        *carried,
    )
    distance = haversine_m(F.col("_clat"), F.col("_clng"), F.col("latitude"), F.col("longitude"))
    return (
        with_cells(located, leaves)
        .join(_covering(placed, leaves), ["_leaf", "_share"])
        .withColumn("distance_m", distance)
        .where(F.col("distance_m") <= F.col("_radius"))
        .drop("_leaf", "_share", "_code", "_clat", "_clng", "_radius", "_centre")
    )
