"""Message streams, their batch twins and event histories.

Streams read landed messages with the available-now trigger and a checkpoint of their own; the
result is read back from the sink.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from placemat.operators import history
from placemat.operators.quality import row_tests
from placemat.scratch import fresh_path
from placemat.sources.files import read_listing_stream
from placemat.streaming import batches
from placemat.streaming import listings as st
from registry import sql as S
from registry.core import query
from registry.inputs import at, event_listings, land, messages

UTC = "timestamp_ntz"
GOOD = "cast(key as bigint) % 101 <> 0"


def message_stream(spark, sf):
    """The landed messages as a stream."""
    return read_listing_stream(spark, {}, "parquet", land(messages(spark, sf), "parquet", "messages"))


def drain(df, name: str):
    """Run the stream over everything that is there and read its sink back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    st.write_stream_append(
        df, name, fresh_path(spark, f"{name}-checkpoint"), path=path, available_now=True
    ).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def plain_times(df, *columns: str):
    return df.withColumns({c: F.col(c).cast(UTC) for c in columns})


@query(
    "s8_read_listing_stream",
    S.over_events(f"SELECT key, {GOOD} AS is_json, ingestion_timestamp AS timestamp FROM sent"),
)
def s8(spark, sf):
    received = drain(message_stream(spark, sf), "s8_messages")
    is_json = F.get_json_object("value", "$.id").isNotNull()
    return plain_times(received.select("key", is_json.alias("is_json"), "timestamp"), "timestamp")


FIELDS = "id, name, rating, data_source, formatted_address, price_level, user_ratings_total, latitude, longitude"
PARSED_SQL = "SELECT key, " + ", ".join(
    f"case when {GOOD} then {c} end AS {c}" for c in FIELDS.split(", ")
) + f""", cast(null as varchar) AS categories, ingestion_timestamp AS timestamp,
  case when {GOOD} then case when cast(key as bigint) % 2 = 0 then ingestion_timestamp
    else date_trunc('second', ingestion_timestamp) end end AS ingestion_timestamp FROM sent"""


@query("t1_parse_listing_stream", S.over_events(PARSED_SQL))
def t1(spark, sf):
    parsed = drain(st.parse_listing_stream(message_stream(spark, sf)), "t1_parsed")
    return plain_times(parsed, "timestamp", "ingestion_timestamp")


@query("t1_parse_listing_batch", S.over_events(PARSED_SQL))
def t1_batch(spark, sf):
    return plain_times(st.parse_listing_stream(messages(spark, sf)), "timestamp", "ingestion_timestamp")


ENRICHED_SQL = f"""parsed AS ({PARSED_SQL}), enriched AS (
  SELECT * REPLACE ({S.CLAMP} AS rating), {S.CITY} AS city, {S.STATE} AS state FROM parsed)"""
LABELS = f"{S.RATING_CATEGORY} AS rating_category, {S.tier('user_ratings_total')} AS business_tier"


@query(
    "t2_enrich_listing_stream",
    S.over_events(
        f""", {ENRICHED_SQL} SELECT key, id, name AS restaurant_name, rating, city, state, {LABELS},
              {S.AT} AS processed_at FROM enriched"""
    ),
)
def t2(spark, sf):
    enriched = st.enrich_listing_stream(st.parse_listing_stream(message_stream(spark, sf)), at())
    kept = ["key", "id", "restaurant_name", "rating", "city", "state", "rating_category", "business_tier"]
    return drain(enriched.select(*kept, "processed_at"), "t2_enriched")


LATE = "(SELECT max(timestamp) - interval 10 minutes FROM enriched)"
WINDOWS_SQL = f"""{ENRICHED_SQL}, windows AS (
  SELECT time_bucket(interval 5 minutes, timestamp) AS window_start,
    time_bucket(interval 5 minutes, timestamp) + interval 5 minutes AS window_end, city, data_source,
    count(*) AS restaurant_count, round(avg(rating), 6) AS avg_rating
  FROM enriched GROUP BY ALL)"""


def enriched_stream(spark, sf):
    return st.enrich_listing_stream(st.parse_listing_stream(message_stream(spark, sf)), at())


def rounded_windows(df):
    return plain_times(df.withColumn("avg_rating", F.round("avg_rating", 6)), "window_start", "window_end")


@query(
    "t3_windowed_listing_stats",
    S.over_events(f", {WINDOWS_SQL} SELECT * FROM windows"),
)
def t3(spark, sf):
    """Batch twin: no watermark, every window."""
    enriched = st.enrich_listing_stream(st.parse_listing_stream(messages(spark, sf)), at())
    return rounded_windows(st.windowed_listing_stats(enriched))


@query(
    "t4_windowed_listing_stats_stream",
    S.over_events(f", {WINDOWS_SQL} SELECT * FROM windows WHERE window_end <= {LATE}"),
)
def t4(spark, sf):
    """On the stream: a window comes out once the watermark has passed its end."""
    return rounded_windows(drain(st.windowed_listing_stats(enriched_stream(spark, sf)), "t4_windows"))


@query(
    "t5_listing_streams",
    S.over_events(
        f""", {WINDOWS_SQL} SELECT 'raw' AS output, key, id, city, data_source, rating,
              cast(null as timestamp) AS window_start, cast(1 as bigint) AS listings FROM enriched
            UNION ALL SELECT 'analytics', null, null, city, data_source, avg_rating, window_start, restaurant_count
            FROM windows WHERE window_end <= {LATE}"""
    ),
)
def t5(spark, sf):
    path, checkpoints = fresh_path(spark, "t5"), fresh_path(spark, "t5-checkpoints")
    table = "t5_listings"
    for started in st.start_listing_streams(
        message_stream(spark, sf), table, checkpoints, path=path, available_now=True, at=at()
    ):
        started.awaitTermination()
    raw = spark.read.schema("key string, id string, city string, data_source string, rating double").parquet(f"{path}/{table}")
    schema = "window_start timestamp, city string, data_source string, restaurant_count bigint, avg_rating double"
    windows = spark.read.schema(schema).parquet(f"{path}/{table}_analytics")
    each = raw.select(F.lit("raw").alias("output"), "*", F.lit(1).cast("bigint").alias("listings"))
    counted = windows.select(
        F.lit("analytics").alias("output"), "city", "data_source", F.round("avg_rating", 6).alias("rating"),
        "window_start", F.col("restaurant_count").alias("listings"),
    )
    return plain_times(each.unionByName(counted, allowMissingColumns=True), "window_start")


@query("k2_write_stream_append", S.over_events(f"SELECT key, case when {GOOD} then id end AS id FROM sent"))
def k2(spark, sf):
    return drain(st.parse_listing_stream(message_stream(spark, sf)).select("key", "id"), "k2_appended")


DAY_ENDS = """days AS (
  SELECT time_bucket(interval 1 day, timestamp) AS window_start,
    time_bucket(interval 1 day, timestamp) + interval 1 day AS window_end, id, {value} AS value,
    row_number() OVER (PARTITION BY id, time_bucket(interval 1 day, timestamp) ORDER BY timestamp, key) AS up,
    row_number() OVER (PARTITION BY id, time_bucket(interval 1 day, timestamp) ORDER BY timestamp DESC, key DESC) AS down
  FROM enriched WHERE {keep}
), ends AS (
  SELECT f.window_start, f.window_end, f.id, f.value AS first, l.value AS last FROM days f
  JOIN days l ON f.id IS NOT DISTINCT FROM l.id AND f.window_start = l.window_start WHERE f.up = 1 AND l.down = 1)"""
RATING_ENDS = DAY_ENDS.format(value="rating", keep="rating IS NOT NULL")
OPEN_ENDS = DAY_ENDS.format(value="data_source <> 'error'", keep="id IS NOT NULL")


@query(
    "t6_rating_drop_alerts_stream",
    S.over_events(
        f""", {ENRICHED_SQL}, {RATING_ENDS} SELECT window_start, window_end, id, first, last, first - last AS drop
            FROM ends WHERE first - last >= 1.0
              AND window_end <= (SELECT max(timestamp) - interval 10 minutes FROM enriched WHERE rating IS NOT NULL)"""
    ),
)
def t6_stream(spark, sf):
    alerts = st.rating_drop_alerts(enriched_stream(spark, sf), 1.0)
    return plain_times(drain(alerts, "t6_alerts"), "window_start", "window_end")


@query(
    "t7_availability_changes_stream",
    S.over_events(
        f""", {ENRICHED_SQL}, {OPEN_ENDS} SELECT window_start, window_end, id, first, last FROM ends
            WHERE first <> last
              AND window_end <= (SELECT max(timestamp) - interval 10 minutes FROM enriched WHERE id IS NOT NULL)"""
    ),
)
def t7_stream(spark, sf):
    known = enriched_stream(spark, sf).where("id is not null")
    alerts = st.availability_alerts(known, F.col("data_source") != "error")
    return plain_times(drain(alerts, "t7_alerts"), "window_start", "window_end")


SESSIONS_SQL = f"""{ENRICHED_SQL}, reports AS (
  SELECT id, timestamp, lag(timestamp) OVER (PARTITION BY id ORDER BY timestamp) AS before
  FROM enriched WHERE id IS NOT NULL AND data_source <> 'error'
), islands AS (
  SELECT id, timestamp, sum(case when timestamp <= before + interval 12 hours then 0 else 1 end)
    OVER (PARTITION BY id ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS island FROM reports
), sessions AS (
  SELECT id, min(timestamp) AS appeared_at, max(timestamp) AS last_report, max(timestamp) + interval 12 hours AS stopped_at,
    count(*) AS reports FROM islands GROUP BY id, island)"""
SESSION_TIMES = ("appeared_at", "last_report", "stopped_at")


def open_sessions(df):
    return st.reporting_sessions(df, "12 hours", F.col("data_source") != "error")


@query("t7_reporting_sessions", S.over_events(f", {SESSIONS_SQL} SELECT * FROM sessions"))
def t7_sessions(spark, sf):
    """Batch twin: all stretches, also those that go on."""
    enriched = st.enrich_listing_stream(st.parse_listing_stream(messages(spark, sf)), at())
    return plain_times(open_sessions(enriched), *SESSION_TIMES)


@query(
    "t7_availability_events_stream",
    S.over_events(
        f""", {SESSIONS_SQL}, closed AS (
              SELECT * FROM sessions WHERE stopped_at <= (SELECT max(timestamp) - interval 10 minutes FROM reports))
            SELECT id, 'appeared' AS change, appeared_at AS at FROM closed
            UNION ALL SELECT id, 'stopped', stopped_at FROM closed"""
    ),
)
def t7_events(spark, sf):
    """A stretch of reports ends by silence, which no window of its own would show."""
    return plain_times(drain(st.availability_events(open_sessions(enriched_stream(spark, sf))), "t7_events"), "at")


@query(
    "t6_rating_drop_pairs_stream",
    S.over_events(
        f""", {ENRICHED_SQL}, pairs AS (
              SELECT timestamp, id, key, rating, lag(rating) OVER w AS previous_rating, lag(timestamp) OVER w AS before
              FROM enriched WHERE rating IS NOT NULL AND id IS NOT NULL WINDOW w AS (PARTITION BY id ORDER BY timestamp, key)
            )
            SELECT timestamp, id, key, rating, previous_rating, previous_rating - rating AS drop FROM pairs
            WHERE previous_rating - rating >= 1.0 AND before >= timestamp - interval 3 days
              AND timestamp <= (SELECT max(timestamp) - interval 10 minutes - interval 3 days FROM pairs)"""
    ),
)
def t6_pairs(spark, sf):
    """The batch answer of consecutive ratings, less those that later ratings may still be compared with."""
    drops = st.rating_drop_pairs(enriched_stream(spark, sf), 1.0, "3 days")
    return plain_times(drain(drops, "t6_pairs"), "timestamp")


def tested_stream(spark, sf) -> str:
    """Folder of the outputs of one query over all messages: listings, failing rows, metrics."""
    path, checkpoint = fresh_path(spark, "tested"), fresh_path(spark, "tested-checkpoint")
    batches.start_tested_stream(
        message_stream(spark, sf), row_tests(), path, checkpoint, available_now=True, at=at()
    ).awaitTermination()
    return path


FAILED = {
    **{f"not_null_{c}": f"{c} IS NULL" for c in ("id", "name", "rating", "data_source", "ingestion_timestamp")},
    "accepted_range_rating": "rating NOT BETWEEN 0 AND 5",
}


@query(
    "k2_stream_failing_rows",
    S.over_events(
        f", {ENRICHED_SQL} " + " UNION ALL ".join(f"SELECT key, id, '{t}' AS test FROM enriched WHERE {w}" for t, w in FAILED.items())
    ),
)
def k2_failures(spark, sf):
    """Rows that fail a test, written by the query that writes all rows, from one reading of the messages."""
    kept = StructType().add("key", StringType()).add("id", StringType()).add("test", StringType())
    return batches.read_batches(spark, tested_stream(spark, sf), "failures", kept).select("key", "id", "test")


@query(
    "k2_stream_metrics",
    S.over_events(
        f", {ENRICHED_SQL} SELECT 'rows' AS metric, count(*) AS value FROM enriched UNION ALL "
        + " UNION ALL ".join(f"SELECT '{t}', count(*) FROM enriched WHERE {w}" for t, w in FAILED.items())
    ),
)
def k2_metrics(spark, sf):
    """Counts observed while the batches were written."""
    metrics = batches.read_metrics(spark, tested_stream(spark, sf))
    return metrics.groupBy("metric").agg(F.sum("value").alias("value"))


# Histories over all events

HISTORY = ("key", "id", "rating", "data_source", "ingestion_timestamp")


def past(spark, sf):
    return event_listings(spark, sf).select(*HISTORY)


OVER = "OVER (PARTITION BY id ORDER BY ingestion_timestamp, key)"


@query(
    "t6_rating_drops",
    S.over_events(
        f"""SELECT key, id, rating, previous_rating, previous_rating - rating AS drop FROM (
              SELECT *, lag(rating) {OVER} AS previous_rating FROM sent) AS s
            WHERE previous_rating - rating >= 1.0"""
    ),
)
def t6(spark, sf):
    drops = history.rating_drops(past(spark, sf), 1.0, order=["ingestion_timestamp", "key"])
    return drops.select("key", "id", "rating", "previous_rating", "drop")


@query(
    "t7_availability_changes",
    S.over_events(
        f"""SELECT key, id, available, was_available FROM (
              SELECT *, lag(available) {OVER} AS was_available
              FROM (SELECT *, data_source <> 'error' AS available FROM sent) AS f) AS s
            WHERE was_available IS NOT NULL AND available <> was_available"""
    ),
)
def t7(spark, sf):
    changes = history.availability_changes(
        past(spark, sf), F.col("data_source") != "error", order=["ingestion_timestamp", "key"]
    )
    return changes.select("key", "id", "available", "was_available")


@query(
    "m4_scd2_history",
    S.over_events(
        f"""SELECT key, id, ingestion_timestamp AS valid_from, lead(ingestion_timestamp) {OVER} AS valid_to FROM sent"""
    ),
)
def m4(spark, sf):
    versions = past(spark, sf).select("key", "id", "ingestion_timestamp")
    return history.scd2_history(versions, "id", "ingestion_timestamp", ["key"]).drop("ingestion_timestamp")


CUT = "timestamp '2024-01-21 00:00:00'"


MERGED_SQL = S.over_events(
    f""", past AS (
          SELECT key, id, ingestion_timestamp, ingestion_timestamp AS valid_from,
            lead(ingestion_timestamp) {OVER} AS valid_to FROM sent WHERE ingestion_timestamp < {CUT}
        ), newest AS (
          SELECT key, id, ingestion_timestamp FROM sent
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingestion_timestamp DESC, key DESC) = 1
        )
        SELECT p.key, p.id, p.valid_from,
          coalesce(p.valid_to, case when n.ingestion_timestamp > p.ingestion_timestamp then n.ingestion_timestamp end)
            AS valid_to
        FROM past p LEFT JOIN newest n ON p.id = n.id
        UNION ALL SELECT n.key, n.id, n.ingestion_timestamp, null FROM newest n
        LEFT JOIN past p ON p.id = n.id AND p.valid_to IS NULL
        WHERE p.id IS NULL OR n.ingestion_timestamp > p.ingestion_timestamp"""
)


@query("m4_snapshot_merge", MERGED_SQL)
def m4_merge(spark, sf):
    """History up to a day, brought up to date with the newest version of each listing."""
    versions = past(spark, sf).select("key", "id", "ingestion_timestamp")
    before = versions.where(F.expr(f"ingestion_timestamp < timestamp_ntz {CUT.removeprefix('timestamp ')}"))
    known = history.scd2_history(before, "id", "ingestion_timestamp", ["key"])
    newest = versions.groupBy("id").agg(F.max(F.struct("ingestion_timestamp", "key")).alias("last"))
    current = newest.select("id", "last.key", "last.ingestion_timestamp")
    return history.snapshot_merge(known, current, "id", "ingestion_timestamp").drop("ingestion_timestamp")


@query("m4_incremental_merge", MERGED_SQL)
def m4_incremental(spark, sf):
    """The same on a stored history, of which only the partitions of changed keys are written again."""
    versions = past(spark, sf).select("key", "id", "ingestion_timestamp")
    before = versions.where(F.expr(f"ingestion_timestamp < timestamp_ntz {CUT.removeprefix('timestamp ')}"))
    known = history.scd2_history(before, "id", "ingestion_timestamp", ["key"])
    path = fresh_path(spark, "m4-history")
    history.write_history(known, path, "id")
    newest = versions.groupBy("id").agg(F.max(F.struct("ingestion_timestamp", "key")).alias("last"))
    history.merge_history(path, newest.select("id", "last.key", "last.ingestion_timestamp"), "id", "ingestion_timestamp")
    return history.read_history(spark, path, known.schema).drop("ingestion_timestamp")
