"""The batch run: feeds to one enriched table with its quality and run reports."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession

from placemat.functions.clean import moment
from placemat.operators.combine import combine_sources
from placemat.operators.quality import quality_metrics
from placemat.operators.shape import canonicalize, flatten_listings
from placemat.operators.stats import ingest_stats, run_summary
from placemat.plans.models import classify
from placemat.sinks.tables import write_overwrite


class Feed(NamedTuple):
    """Nested records of one source with the names behind the canonical columns."""

    records: DataFrame
    source: str
    mapping: Mapping[str, str]


class Reports(NamedTuple):
    quality: DataFrame
    per_location: DataFrame
    summary: DataFrame


def build_listings(
    spark: SparkSession, feeds: list[Feed], at: Column | datetime | None = None, extra: tuple[str, ...] = ()
) -> DataFrame:
    """All feeds flattened, cleaned, classified and combined: one projection per feed, no shuffle."""
    frames = [
        classify(canonicalize(flatten_listings(f.records, f.source, at), f.mapping, extra)).withColumn(
            "processed_at", moment(at)
        )
        for f in feeds
    ]
    return combine_sources(spark, frames)


def run_batch(
    spark: SparkSession,
    feeds: list[Feed],
    table: str,
    path: str | None = None,
    at: Column | datetime | None = None,
) -> DataFrame:
    """Write the combined listings and return the written table.

    Feed records carry ``search_location``, the location they were fetched for.
    """
    return write_overwrite(build_listings(spark, feeds, at, ("search_location",)), table, path)


def run_reports(table: DataFrame, locations: DataFrame) -> Reports:
    """Reports of a run, from the written table rather than from the feeds again."""
    named = table.withColumnRenamed("restaurant_name", "name").drop("search_location")
    return Reports(quality_metrics(named), ingest_stats(table, locations), run_summary(table))
