"""Listing messages on a stream. Every function also takes a batch frame, except the sinks."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from placemat.functions import clean, derive
from placemat.schema import MESSAGE_SCHEMA

WINDOW = "5 minutes"
WATERMARK = "10 minutes"
TRIGGER = "30 seconds"


def parse_listing_stream(df: DataFrame) -> DataFrame:
    """Message key, fields of the JSON value and message time; a bad message has null fields."""
    data = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA)
    parsed = df.select(F.col("key").cast("string").alias("key"), data.alias("data"), "timestamp")
    time = clean.event_time(F.col("ingestion_timestamp"))
    return parsed.select("key", "data.*", "timestamp").withColumn("ingestion_timestamp", time)


def enrich_listing_stream(df: DataFrame, at: Column | datetime | None = None, city_group: int = 1) -> DataFrame:
    """Clean and classify; a null id stays null, as a stream has no row numbers."""
    address = F.col("formatted_address")
    cleaned = df.withColumns(
        {
            "restaurant_name": F.col("name"),
            "rating": clean.clamp_rating(F.col("rating")),
            "city": clean.city_of(address, city_group),
            "state": clean.state_of(address),
            "processed_at": clean.moment(at),
        }
    )
    return cleaned.withColumns(
        {
            "rating_category": derive.rating_category(F.col("rating")),
            "business_tier": derive.business_tier(F.col("rating"), F.col("user_ratings_total")),
        }
    )


def _timed(df: DataFrame, time: str, watermark: str) -> DataFrame:
    return df.withWatermark(time, watermark) if df.isStreaming else df


def windowed_listing_stats(
    df: DataFrame, time: str = "timestamp", window: str = WINDOW, watermark: str = WATERMARK
) -> DataFrame:
    """Listings and mean rating per tumbling window, city and source.

    ``time`` is the event time. Events behind the watermark are dropped, and in append mode a
    window comes out once its end has passed the watermark.
    """
    grouped = _timed(df, time, watermark).groupBy(F.window(time, window).alias("window"), "city", "data_source")
    return grouped.agg(F.count("*").alias("restaurant_count"), F.avg("rating").alias("avg_rating")).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "city",
        "data_source",
        "restaurant_count",
        "avg_rating",
    )


def _first_and_last(df: DataFrame, value: str, time: str, tie: str, window: str, watermark: str) -> DataFrame:
    """First and last ``value`` of each listing in each window."""
    order = F.struct(time, tie)
    grouped = _timed(df, time, watermark).groupBy(F.window(time, window).alias("window"), "id")
    return grouped.agg(F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "id", "first", "last"
    )


def rating_drop_alerts(
    df: DataFrame,
    threshold: float,
    time: str = "timestamp",
    tie: str = "key",
    window: str = "1 day",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Listings that lost at least ``threshold`` between their first and last rating in a window."""
    rated = df.where(F.col("rating").isNotNull())
    ends = _first_and_last(rated, "rating", time, tie, window, watermark)
    return ends.withColumn("drop", F.col("first") - F.col("last")).where(F.col("drop") >= threshold)


def availability_alerts(
    df: DataFrame,
    available: Column,
    time: str = "timestamp",
    tie: str = "key",
    window: str = "1 day",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Listings whose availability at the end of a window differs from that at its start."""
    ends = _first_and_last(df.withColumn("available", available), "available", time, tie, window, watermark)
    return ends.where(~F.col("first").eqNullSafe(F.col("last")))


def reporting_sessions(
    df: DataFrame,
    gap: str = "1 day",
    available: Column | None = None,
    time: str = "timestamp",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Stretches in which a listing keeps being reported, with no silence of ``gap`` or longer inside.

    ``stopped_at`` is ``gap`` after the last report. On a stream a stretch comes out once the watermark has passed that
    moment, so its row is the alert that the listing has stopped being reported; a late report that is not behind the
    watermark still joins two stretches. A batch frame also has the stretches that go on at its end. With
    ``available`` only reports for which it holds count, so a listing reported as closed stops as well.
    State is one row per listing and open stretch.
    """
    counted = df if available is None else df.where(available)
    session = F.session_window(time, gap).alias("session")
    grouped = _timed(counted.where(F.col("id").isNotNull()), time, watermark).groupBy(session, "id")
    return grouped.agg(F.count("*").alias("reports"), F.max(time).alias("last_report")).select(
        "id", F.col("session.start").alias("appeared_at"), "last_report", F.col("session.end").alias("stopped_at"), "reports"
    )


def availability_events(sessions: DataFrame) -> DataFrame:
    """``id, change, at``: when a listing appeared and when it stopped being reported, from its stretches."""
    changes = [
        F.struct(F.lit(name).alias("change"), F.col(at).alias("at"))
        for name, at in (("appeared", "appeared_at"), ("stopped", "stopped_at"))
    ]
    return sessions.select("id", F.explode(F.array(*changes)).alias("e")).select("id", "e.change", "e.at")


def consecutive_readings(
    df: DataFrame, horizon: str = "7 days", time: str = "timestamp", tie: str = "key", watermark: str = WATERMARK
) -> DataFrame:
    """Each rating with the one before it of the same listing, at most ``horizon`` earlier, else null.

    The stream is joined with itself on the listing and an interval of time, so pairs are found across any window
    border and micro-batch; of the earlier ratings the last one counts, ``tie`` deciding between equal times. A
    rating comes out once the watermark has passed it by ``horizon``, as long as the join keeps ratings for later
    ones. State is bounded by that time, and a listing with n ratings within it makes n pairs per rating, so choose
    ``horizon`` to suit the rate of reports; ``rating_drop_alerts`` is quicker, but blind to window borders.
    """
    rated = df.where(F.col("rating").isNotNull() & F.col("id").isNotNull()).select("id", time, tie, "rating")
    now = _timed(rated, time, watermark)
    earlier = rated.select(*[F.col(c).alias(f"_{c}") for c in ("id", time, tie, "rating")])
    before = _timed(earlier, f"_{time}", watermark)
    within = (F.col(f"_{time}") <= F.col(time)) & (F.col(f"_{time}") >= F.col(time) - F.expr(f"interval {horizon}"))
    first = (F.col(f"_{time}") < F.col(time)) | (F.col(f"_{tie}") < F.col(tie))
    pairs = now.join(before, (F.col("id") == F.col("_id")) & within & first, "left_outer")
    last = F.max_by("_rating", F.struct(f"_{time}", f"_{tie}"))
    return pairs.groupBy(time, "id", tie, "rating").agg(last.alias("previous_rating"))


def rating_drop_pairs(
    df: DataFrame,
    threshold: float,
    horizon: str = "7 days",
    time: str = "timestamp",
    tie: str = "key",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Ratings at least ``threshold`` below the one before, wherever windows begin."""
    compared = consecutive_readings(df, horizon, time, tie, watermark)
    return compared.withColumn("drop", F.col("previous_rating") - F.col("rating")).where(F.col("drop") >= threshold)


def write_stream_append(
    df: DataFrame,
    table: str,
    checkpoint: str,
    trigger: str = TRIGGER,
    path: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append the stream to a table. Each table needs a checkpoint folder of its own.

    ``available_now`` works through what is there and stops, instead of running on a timer.
    """
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    timed = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    if path:
        return timed.queryName(table).start(path)
    return timed.queryName(table).toTable(table)


class ListingStreams(NamedTuple):
    raw: StreamingQuery
    analytics: StreamingQuery


def start_listing_streams(
    messages: DataFrame,
    table: str,
    checkpoints: str,
    time: str = "timestamp",
    path: str | None = None,
    trigger: str = TRIGGER,
    available_now: bool = False,
    at: Column | datetime | None = None,
) -> ListingStreams:
    """Two queries over one message stream: enriched rows to ``table``, window statistics beside it."""
    enriched = enrich_listing_stream(parse_listing_stream(messages), at)
    outputs = {table: enriched, f"{table}_analytics": windowed_listing_stats(enriched, time)}
    return ListingStreams(
        *[
            write_stream_append(
                frame, name, f"{checkpoints}/{name}", trigger, f"{path}/{name}" if path else None, available_now
            )
            for name, frame in outputs.items()
        ]
    )
