"""Unions of feeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from placemat.schema import LISTING_SCHEMA


def union_positional(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by position, refused unless all frames have the same names and types in order."""
    first = frames[0]
    for frame in frames[1:]:
        if frame.dtypes != first.dtypes:
            raise ValueError(f"columns differ: {frame.dtypes} and {first.dtypes}")
    return reduce(DataFrame.union, frames)


def combine_sources(spark: SparkSession, frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name with absent columns null; without frames, an empty canonical frame."""
    if not frames:
        return spark.createDataFrame([], LISTING_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
