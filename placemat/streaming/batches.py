"""Several outputs of one stream, from one reading of its source.

Outputs without event-time state need no query each: every micro-batch is read and parsed once, kept while its outputs
are written, and each output gets a folder named for the stream and the batch. A batch that runs again after a failure has
the same number and replaces its own folders, so nothing is lost and nothing is there twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructType

from placemat.operators.quality import counted, failing_rows
from placemat.streaming.listings import TRIGGER, enrich_listing_stream, parse_listing_stream

#: Partition columns of every output.
STREAM, BATCH = "stream", "batch"
METRICS = "metrics"


def batch_writer(
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
    path: str,
    stream: str,
    measures: Mapping[str, Column] | None = None,
) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` calls: writes each output of a batch to ``path/<output>/stream=<stream>/batch=<number>``.

    ``measures`` (aggregates over the batch's rows) are observed while the first output is written, and stored beside the
    outputs as ``path/metrics`` with columns ``metric, value``; they take no pass of their own.
    """
    measures = {"rows": F.count(F.lit(1)), **(measures or {})}

    def write(batch: DataFrame, number: int) -> None:
        def folder(name: str) -> str:
            return f"{path}/{name}/{STREAM}={stream}/{BATCH}={number}"

        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = Observation()
            rows = batch.observe(seen, *[m.alias(name) for name, m in measures.items()])
            for i, (name, output) in enumerate(outputs.items()):
                output(rows if i == 0 else batch).write.mode("overwrite").parquet(folder(name))
            values = [(name, int(value)) for name, value in seen.get.items()]
            metrics = batch.sparkSession.createDataFrame(values, "metric string, value long")
            metrics.coalesce(1).write.mode("overwrite").parquet(folder(METRICS))
        finally:
            batch.unpersist()

    return write


def write_batches(
    df: DataFrame,
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
    path: str,
    stream: str,
    checkpoint: str,
    measures: Mapping[str, Column] | None = None,
    trigger: str = TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the query that writes all ``outputs``; each takes the batch's rows and keeps no state.

    Batches are numbered within a checkpoint: a stream that starts again from an empty checkpoint needs another ``stream``
    name, else its first batches replace the old ones.
    """
    writer = df.writeStream.foreachBatch(batch_writer(outputs, path, stream, measures))
    writer = writer.queryName(stream).option("checkpointLocation", checkpoint)
    timed = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return timed.start()


def read_batches(spark: SparkSession, path: str, output: str, schema: StructType) -> DataFrame:
    """All rows of an output, with the stream and number of the batch they came in."""
    whole = StructType(schema.fields).add(STREAM, StringType()).add(BATCH, LongType())
    return spark.read.schema(whole).parquet(f"{path}/{output}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``stream, batch, metric, value`` of every batch."""
    schema = StructType().add("metric", StringType()).add("value", LongType())
    return read_batches(spark, path, METRICS, schema).select(STREAM, BATCH, "metric", "value")


def start_tested_stream(
    messages: DataFrame,
    tests: Mapping[str, Column],
    path: str,
    checkpoint: str,
    stream: str = "listings",
    trigger: str = TRIGGER,
    available_now: bool = False,
    at: Column | None = None,
) -> StreamingQuery:
    """Enriched listings, the rows that fail row tests, and the number of both, from one reading of the messages.

    Outputs are ``listings``, ``failures`` (each row once per test it fails, named in ``test``) and ``metrics``. Window
    statistics need state of their own and run as their own query (``listings.start_listing_streams``).
    """
    listings = enrich_listing_stream(parse_listing_stream(messages), at)
    outputs = {"listings": lambda rows: rows, "failures": lambda rows: failing_rows(rows, tests)}
    return write_batches(listings, outputs, path, stream, checkpoint, counted(tests), trigger, available_now)
