"""Ranges of an integer key, cut at values the key has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.llm.core import shuffle_partitions

NO_KEY = -(1 << 63)
COARSE = 64
RANGES_PER_PARTITION = 4


def order_key(key: str) -> Column:
    """The key as bigint; null is less than any other."""
    return F.coalesce(F.col(key).cast("bigint"), F.lit(NO_KEY))


def range_bounds(df: DataFrame, key: str) -> list[int]:
    """Largest key of each range, ascending: four ranges per shuffle partition, about equally many rows each.

    Only the key is read. The driver holds one bound per range. Rows of one key share a range.
    """
    ranges = RANGES_PER_PARTITION * shuffle_partitions(df.sparkSession)
    found = df.select(order_key(key).alias("k")).agg(
        F.max("k"), F.percentile_approx("k", [i / ranges for i in range(1, ranges)], 20 * ranges)
    ).first()
    return sorted({*(found[1] or ()), found[0]}) if found[0] is not None else [0]


def bound_array(bounds: list[int]) -> Column:
    return F.array(*[F.lit(b).cast("bigint") for b in bounds]).cast("array<bigint>")


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of the range: how many bounds are less, first among every 64th of them, then among the next 64."""
    below = F.size(F.filter(bound_array(bounds[COARSE - 1 :: COARSE]), lambda b: b < key)) * COARSE
    near = F.slice(bound_array(bounds), below + 1, F.lit(COARSE))
    return below + F.size(F.filter(near, lambda b: b < key))
