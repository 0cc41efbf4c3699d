"""Outputs of one stream from one reading: replays, restarts, failures between outputs, and counts taken while writing."""

import pytest
from pyspark.sql import functions as F

from placemat.operators import quality
from placemat.plans import warehouse
from placemat.scratch import fresh_path
from placemat.sinks import tables
from placemat.sources import files
from placemat.streaming import batches
from test_streams import land, message

TESTS = ("not_null_id", "not_null_name", "not_null_rating", "not_null_data_source", "not_null_ingestion_timestamp", "accepted_range_rating")


def start(spark, source, path, checkpoint):
    stream = files.read_listing_stream(spark, {"maxFilesPerTrigger": "1"}, "parquet", source)
    query = batches.start_tested_stream(stream, quality.row_tests(), path, checkpoint, available_now=True)
    query.awaitTermination()
    return query


def outcome(spark, path, schema="key string"):
    wanted = spark.createDataFrame([], schema).schema
    keys = sorted(r.key for r in batches.read_batches(spark, path, "listings", wanted).collect())
    failing = spark.createDataFrame([], "key string, test string").schema
    failures = sorted((r.key, r.test) for r in batches.read_batches(spark, path, "failures", failing).collect())
    metrics = batches.read_metrics(spark, path).groupBy("metric").agg(F.sum("value").alias("n"))
    return keys, failures, {r.metric: r.n for r in metrics.collect()}


def test_stop_and_restart(spark):
    """What comes after a stop is added; what was there is not read again."""
    source, path, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "check"))
    land(spark, source, [message(i, i) for i in range(4)])
    land(spark, source, [message(4, 4, name=None), message(5, 5, rating=None, data_source=None)])
    start(spark, source, path, checkpoint)
    assert start(spark, source, path, checkpoint).lastProgress is None or outcome(spark, path)[2]["rows"] == 6
    land(spark, source, [message(6, 6, id=None)])
    start(spark, source, path, checkpoint)
    keys, failures, metrics = outcome(spark, path)
    assert keys == [str(i) for i in range(7)]
    assert failures == [("4", "not_null_name"), ("5", "not_null_data_source"), ("5", "not_null_rating"), ("6", "not_null_id")]
    assert metrics == {"rows": 7} | {t: sum(x == t for _, x in failures) for t in TESTS}


def test_failure_between_two_outputs(spark):
    """The batch that failed after its first output runs again under its number: no row is lost, none is twice."""
    source, path, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "check"))
    land(spark, source, [message(i, i) for i in range(3)])
    broken = {"on": True}

    def second(rows):
        if broken["on"]:
            raise RuntimeError("no second output")
        return rows.select("key", "rating")

    def run():
        stream = files.read_listing_stream(spark, {}, "parquet", source)
        outputs = {"listings": lambda rows: rows.select("key"), "ratings": second}
        query = batches.write_batches(stream.select("key", F.lit(1).alias("rating")), outputs, path, "s", checkpoint, available_now=True)
        query.awaitTermination()

    with pytest.raises(Exception, match="no second output"):
        run()
    assert spark.read.parquet(f"{path}/listings").count() == 3
    broken["on"] = False
    run()
    assert sorted(r.key for r in spark.read.parquet(f"{path}/listings").collect()) == ["0", "1", "2"]
    assert spark.read.parquet(f"{path}/ratings").count() == 3
    assert [r.value for r in batches.read_metrics(spark, path).collect()] == [3]


def test_replayed_batch_replaces_itself(spark):
    path = fresh_path(spark, "out")
    write = batches.batch_writer({"a": lambda rows: rows, "b": lambda rows: rows.where("id > 2")}, path, "s")
    for number, n in ((0, 5), (1, 4), (0, 5), (1, 4)):
        write(spark.range(n), number)
    batches.batch_writer({"a": lambda rows: rows}, path, "other")(spark.range(2), 0)
    read = batches.read_batches(spark, path, "a", spark.range(1).schema)
    found = sorted((r.stream, r.batch, r.n) for r in read.groupBy("stream", "batch").agg(F.count("*").alias("n")).collect())
    assert found == [("other", 0, 2), ("s", 0, 5), ("s", 1, 4)]
    assert spark.read.parquet(f"{path}/b").count() == 3
    write(spark.range(0), 2)
    assert batches.read_metrics(spark, path).where("batch = 2").first().value == 0


def test_source_is_read_once(spark):
    """Rows are counted where they are parsed; both outputs come from the kept batch."""
    seen = spark.sparkContext.accumulator(0)

    def count(part):
        for batch in part:
            seen.add(batch.num_rows)
            yield batch

    path = fresh_path(spark, "out")
    rows = spark.range(100).mapInArrow(count, "id long")
    outputs = {"all": lambda r: r, "few": lambda r: r.where("id < 10"), "none": lambda r: r.where("id < 0")}
    batches.batch_writer(outputs, path, "s", {"high": F.count_if(F.col("id") >= 90)})(rows, 0)
    assert seen.value == 100
    assert {(r.metric, r.value) for r in batches.read_metrics(spark, path).collect()} == {("rows", 100), ("high", 10)}


def test_load_is_measured_while_it_is_written(spark):
    rows = [(1, "a", 4.0, "yelp", None), (None, None, 7.0, "yelp", None), (3, "c", None, None, None)]
    raw = spark.createDataFrame(rows, "id int, name string, rating double, data_source string, ingestion_timestamp timestamp")
    report = {r.measure: r.value for r in warehouse.load_tested(raw, "measured_load").collect()}
    assert report["rows"] == 3 and report["missing_rating"] == 1 and report["accepted_range_rating"] == 1
    for name, failed in quality.row_tests().items():
        assert report[name] == raw.where(failed).count()
    assert tables.measured(spark, "measured_load") == {k: v for k, v in report.items() if k != "rows"}
    # The next load has measures of its own; one without any leaves none behind.
    tables.write_measured(raw.limit(1), "measured_load", {"one": F.count_if(F.col("id") == 1)})
    assert tables.measured(spark, "measured_load") == {"one": 1} and tables.rows_written(spark, "measured_load") == 1
    tables.write_overwrite(raw, "measured_load")
    assert tables.measured(spark, "measured_load") == {} and tables.rows_written(spark, "measured_load") == 3
    tables.write_measured(raw.where("false"), "measured_load", {"one": F.count_if(F.col("id") == 1)})
    assert tables.measured(spark, "measured_load") == {"one": 0}
