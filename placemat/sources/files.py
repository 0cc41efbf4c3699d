"""Readers. Schemas are always given, so no pass over the data is spent on inference.

Landed responses are JSON, one per line unless the option ``multiLine`` is set; reader options pass
through. A response that cannot be read gives no record; ``unreadable_responses`` gives it instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placemat.operators.shape import places_v1_to_legacy
from placemat.schema import ENVELOPE_SCHEMA, LOCATION, PLACE_LEGACY, PLACE_V1, SEED


UNREADABLE = "_unreadable"


def _responses(spark: SparkSession, path: str, schema: str, options: Mapping[str, str]) -> DataFrame:
    return spark.read.schema(schema).options(**options).json(path)


def unreadable_responses(
    spark: SparkSession, path: str, schema: str = "status string", multi_line: bool = False
) -> DataFrame:
    """``path`` and ``text`` of the landed responses that are not JSON of the schema (DDL)."""
    texts = spark.read.option("wholetext", multi_line).text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", f"{schema}, {UNREADABLE} string", {"columnNameOfCorruptRecord": UNREADABLE})
    broken = texts.where(parsed.getField(UNREADABLE).isNotNull())
    return broken.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _rows(responses: DataFrame, array: str) -> DataFrame:
    """One row per element of the array; a missing or empty array gives none."""
    return responses.select(F.explode(array).alias("_row")).select("_row.*")


def read_business_json(spark: SparkSession, path: str, business: str, **options: str) -> DataFrame:
    """Businesses of landed search responses; ``business`` is the DDL of one record."""
    schema = f"businesses array<struct<{_fields(business)}>>"
    return _rows(_responses(spark, path, schema, options), "businesses")


def read_places_legacy_json(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Results of the landed legacy responses whose status is OK."""
    schema = f"status string, results array<struct<{_fields(PLACE_LEGACY)}>>"
    return _rows(_responses(spark, path, schema, options).where("status = 'OK'"), "results")


def read_places_v1_json(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Places of landed new-style responses, in the legacy shape."""
    schema = f"places array<struct<{_fields(PLACE_V1)}>>"
    return places_v1_to_legacy(_rows(_responses(spark, path, schema, options), "places"))


def read_business_details_json(spark: SparkSession, path: str, detail: str, **options: str) -> DataFrame:
    """Landed details of single businesses, one record per response without an envelope.

    Records without an id, which is what an error response looks like, are left out.
    """
    return _responses(spark, path, detail, options).where(F.col("id").isNotNull())


def read_reviews_json(spark: SparkSession, path: str, review: str, **options: str) -> DataFrame:
    """Reviews of landed responses, each with the id of its business."""
    schema = f"business_id string, reviews array<struct<{_fields(review)}>>"
    responses = _responses(spark, path, schema, options)
    return responses.select("business_id", F.explode("reviews").alias("_row")).select("_row.*", "business_id")


def read_details_json(spark: SparkSession, path: str, detail: str, **options: str) -> DataFrame:
    """Detail records of the landed responses whose status is OK, with the id asked for."""
    schema = f"place_id string, status string, result struct<{_fields(detail)}>"
    responses = _responses(spark, path, schema, options)
    return responses.where("status = 'OK'").select("place_id", "result.*")


def _fields(ddl: str) -> str:
    """DDL of columns (`a int, b string`) as DDL of struct fields (`a: int, b: string`)."""
    return StructType.fromDDL(ddl).simpleString()[len("struct<") : -1]


def read_table(spark: SparkSession, name_or_path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table, or parquet files when the name contains a slash."""
    table = spark.read.parquet(name_or_path) if "/" in name_or_path else spark.read.table(name_or_path)
    return table.select(*columns) if columns else table


def read_locations(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    """The location dimension, with defaults where a field is absent."""
    raw = spark.read.schema(LOCATION).format(format).load(path)
    return raw.withColumns(
        {
            "country": F.coalesce("country", F.lit("US")),
            "priority": F.coalesce("priority", F.lit("medium")),
            "enabled": F.coalesce("enabled", F.lit(True)),
        }
    )


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEED).option("header", True).csv(path)


def read_listing_stream(
    spark: SparkSession, options: Mapping[str, str], format: str = "kafka", path: str | None = None
) -> DataFrame:
    """The message stream: key, value and timestamp.

    Kafka needs its connector on the class path and at least the options
    ``kafka.bootstrap.servers`` and ``subscribe``. A file format reads the same envelope from
    ``path``; ``maxFilesPerTrigger`` and ``maxBytesPerTrigger`` bound a batch.
    """
    reader = spark.readStream.format(format)
    if format == "kafka":
        return reader.options(**{"startingOffsets": "latest", **options}).load().select("key", "value", "timestamp")
    return reader.schema(ENVELOPE_SCHEMA).options(**options).load(path)
