"""Late data, broken messages and the two-query stream."""

import datetime
import json

import pytest

from placemat.scratch import fresh_path
from placemat.schema import ENVELOPE_SCHEMA
from placemat.sources import files, records
from placemat.sinks import tables
from placemat.streaming import listings as st

DAY = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)


def message(key, minute, rating=4.0, **fields):
    record = {
        "id": f"rest_{key}", "name": "Mario's Italian", "rating": rating, "data_source": "yelp",
        "formatted_address": "456 Oak Ave, San Francisco, CA", "price_level": 3, "user_ratings_total": 89,
        "latitude": 37.7749, "longitude": -122.4194, "ingestion_timestamp": 1704067200.5,
    } | fields
    return (str(key), json.dumps(record), DAY + datetime.timedelta(minutes=minute))


def land(spark, path, rows):
    spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_late_events_are_dropped(spark):
    source, target, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "check"))

    def drain():
        stream = files.read_listing_stream(spark, {}, "parquet", source)
        windows = st.windowed_listing_stats(st.enrich_listing_stream(st.parse_listing_stream(stream)))
        st.write_stream_append(windows, "late", checkpoint, path=target, available_now=True).awaitTermination()
        read = spark.read.parquet(target).orderBy("window_start")
        return [(r.window_start.minute, r.restaurant_count, r.avg_rating) for r in read.collect()]

    land(spark, source, [message(1, 1, 4.0), message(2, 2, 3.0), message(3, 20)])
    assert drain() == [(0, 2, 3.5)]
    # Minute 3 lies behind the watermark (20 - 10) and is lost; minute 12 does not.
    land(spark, source, [message(4, 3), message(5, 12), message(6, 40)])
    assert drain() == [(0, 2, 3.5), (10, 1, 4.0), (20, 1, 4.0)]


def test_messages(spark):
    rows = [message(1, 0), ("2", "{broken", DAY), ("3", None, DAY), message(4, 0, ingestion_timestamp="2024-01-01 00:00:09")]
    parsed = st.parse_listing_stream(spark.createDataFrame(rows, ENVELOPE_SCHEMA)).orderBy("key").collect()
    assert parsed[0].name == "Mario's Italian" and parsed[0].ingestion_timestamp.microsecond == 500000
    assert parsed[1].id is None and parsed[1].key == "2" and parsed[2].name is None
    assert parsed[3].ingestion_timestamp.second == 9
    row = st.enrich_listing_stream(st.parse_listing_stream(spark.createDataFrame(rows[:1], ENVELOPE_SCHEMA))).first()
    assert (row.city, row.state, row.rating_category, row.business_tier) == ("456 Oak Ave", "CA", "Very Good", "High Quality")


def test_two_queries_into_tables(spark):
    source, checkpoints = fresh_path(spark, "in"), fresh_path(spark, "checks")
    land(spark, source, [message(i, i) for i in range(30)])
    stream = files.read_listing_stream(spark, {"maxFilesPerTrigger": "1"}, "parquet", source)
    for query in st.start_listing_streams(stream, "streamed", checkpoints, available_now=True):
        query.awaitTermination()
    assert spark.table("streamed").count() == 30
    assert spark.table("streamed_analytics").agg({"restaurant_count": "sum"}).first()[0] == 15


def test_payload_round_trip(spark):
    rows = spark.sql("select 'rest_001' id, 'Mario''s Italian' name, 4.2D rating")
    encoded = tables.encode_payload(rows)
    assert encoded.columns == ["value"]
    assert json.loads(encoded.first().value) == {"id": "rest_001", "name": "Mario's Italian", "rating": 4.2}


def test_kafka_needs_its_connector(spark):
    options = {"kafka.bootstrap.servers": "nowhere:9092", "subscribe": "listings"}
    with pytest.raises(Exception, match="(?i)kafka"):
        files.read_listing_stream(spark, options)


def test_records(spark):
    rows = [{"restaurant_id": "REST_001", "restaurant_name": "Test 1", "rating": 4.5, "data_source": "yelp"}] * 2
    frame = records.from_records(spark, rows)
    assert frame.count() == 2 and len(frame.columns) == 4


def test_demo_listings(spark):
    demo = records.demo_listings(spark, 50)
    rows = demo.collect()
    assert len(rows) == 50 and len(demo.columns) == 16
    assert rows[0].restaurant_id == "DEMO_001" and rows[49].ingestion_timestamp == datetime.datetime(2024, 2, 19)
    assert all(1 <= r.rating <= 5 and 1 <= r.price_level <= 4 for r in rows)
    many = records.demo_listings(spark, 20000).agg({"review_count": "avg", "rating": "avg"}).first()
    assert abs(many["avg(review_count)"] - 50) < 0.5 and abs(many["avg(rating)"] - 3.75) < 0.1
    assert {r[0] for r in records.demo_listings(spark, 2000).select("business_tier").distinct().collect()} == {
        "Premium", "High Quality", "Good Quality", "Standard", "Needs Improvement",
    }


def test_read_table_by_name(spark):
    tables.write_overwrite(spark.range(3).withColumnRenamed("id", "a").selectExpr("a", "a + 1 b"), "by_name")
    tables.write_overwrite(spark.range(5).withColumnRenamed("id", "a").selectExpr("a", "a + 1 b"), "by_name")
    read = files.read_table(spark, "by_name", ["b"])
    assert read.columns == ["b"] and read.count() == 5


def test_empty_failures_are_stored(spark):
    stored = tables.store_failures(spark.range(3).where("id > 5"), "none_found")
    assert stored.count() == 0 and spark.table("test_failures_none_found").columns == ["id"]


def drained(spark, source, name, build):
    """Run ``build`` over what has landed since the last call and return all rows of its sink."""
    target, checkpoint = fresh_path(spark, name), fresh_path(spark, f"{name}-check")

    def drain():
        stream = build(st.enrich_listing_stream(st.parse_listing_stream(files.read_listing_stream(spark, {}, "parquet", source))))
        st.write_stream_append(stream, name, checkpoint, path=target, available_now=True).awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(stream.schema).parquet(target).collect())

    return drain


def minutes(rows, *columns):
    return [tuple(int((v.astimezone(datetime.UTC) - DAY).total_seconds() // 60) if i in columns else v for i, v in enumerate(r)) for r in rows]


def reading(key, minute, rating, listing="a", source="yelp"):
    return message(key, minute, rating, id=listing, data_source=source)


def test_a_listing_that_stops_being_reported_alerts(spark):
    """Silence closes a stretch; it spans micro-batches, and a report at the very end of the gap still belongs to it."""
    source = fresh_path(spark, "in")
    drain = drained(spark, source, "stopped", lambda df: st.reporting_sessions(df, "30 minutes", df["data_source"] != "error"))
    land(spark, source, [reading(1, 0, 4.0), reading(2, 20, 4.0), reading(3, 5, 4.0, "b"), reading(4, 34, 4.0, "b", "error")])
    assert drain() == []
    # The report of minute 36 moves the watermark to 26, behind the end of b's stretch at 35; a goes on.
    land(spark, source, [reading(5, 36, 4.0)])
    assert drain() == []
    land(spark, source, [reading(6, 46, 4.0)])
    assert minutes(drain(), 1, 2, 3) == [("b", 5, 5, 35, 1)]
    land(spark, source, [reading(7, 120, 4.0, "c")])
    assert minutes(drain(), 1, 2, 3) == [("a", 0, 46, 76, 4), ("b", 5, 5, 35, 1)]


def test_gap_ends(spark):
    """A silence as long as the gap parts two stretches or not alike in batch and stream, and as the SQL says."""
    rows = [reading(1, 0, 4.0), reading(2, 30, 4.0), reading(3, 61, 4.0), message(4, 0, id=None)]
    batch = st.parse_listing_stream(spark.createDataFrame(rows, ENVELOPE_SCHEMA))
    found = sorted(tuple(r) for r in st.reporting_sessions(batch, "30 minutes").collect())
    assert minutes(found, 1, 2, 3) == [("a", 0, 30, 60, 2), ("a", 61, 61, 91, 1)]
    events = sorted(tuple(r) for r in st.availability_events(st.reporting_sessions(batch, "30 minutes")).collect())
    assert minutes(events, 2) == [("a", "appeared", 0), ("a", "appeared", 61), ("a", "stopped", 60), ("a", "stopped", 91)]


def test_a_drop_over_any_border_alerts(spark):
    """The ratings lie in different micro-batches and on both sides of midnight; equal times go by key."""
    source = fresh_path(spark, "in")
    drain = drained(spark, source, "drops", lambda df: st.rating_drop_pairs(df, 1.0, "2 days").select("key", "previous_rating", "drop"))
    land(spark, source, [reading(1, 1430, 5.0), reading(2, 1430, 4.5, "b"), reading(3, 1430, 3.0, "b"), reading(8, 1431, 5.0, "late")])
    drain()
    land(spark, source, [reading(4, 1450, 4.0), reading(5, 1455, 2.0), reading(6, 1460, 2.0)])
    drain()
    # Key 7 is late but not behind the watermark (1450): it comes between 4 and 5, which drops from it now.
    land(spark, source, [reading(7, 1452, 3.5), reading(9, 6000, 1.0), reading(10, 7000, 1.0, "z")])
    assert drain() == [("3", 4.5, 1.5), ("4", 5.0, 1.0), ("5", 3.5, 1.5)]


def test_stateful_plans_have_no_python(spark):
    source = fresh_path(spark, "in")
    land(spark, source, [reading(1, 0, 4.0)])
    stream = st.enrich_listing_stream(st.parse_listing_stream(files.read_listing_stream(spark, {}, "parquet", source)))
    wanted = {"SessionWindowStateStoreSave": st.reporting_sessions(stream), "StreamingSymmetricHashJoin": st.rating_drop_pairs(stream, 1.0)}
    for node, frame in wanted.items():
        started = st.write_stream_append(frame, node, fresh_path(spark, "check"), path=fresh_path(spark, "out"), available_now=True)
        started.awaitTermination()
        plan = started._jsq.explainInternal(False)
        assert node in plan and "Python" not in plan
