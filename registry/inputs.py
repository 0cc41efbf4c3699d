"""Listing-shaped inputs derived from the given tables.

The expressions are plain SQL that Spark and the checking engine both read. Listings come from
`orders` alone: the customer's key already identifies the location, so no join is needed to
build them. Null, unreadable and out-of-range values are present on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemat.scratch import fresh_path


def _sql(columns: dict[str, str], table: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM {table}"


def _frame(spark: SparkSession, sf: str, columns: dict[str, str], table: str) -> DataFrame:
    return table_of(spark, sf, table).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def table_of(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


STATE = (
    "case o_custkey % 5 when 0 then 'CA' when 1 then 'NY' when 2 then 'IL' when 3 then 'TX' else 'WA' end"
)

LISTING = {
    "row_key": "o_orderkey",
    "id": "case when o_orderkey % 97 = 0 then null else concat('rest_', cast(o_orderkey as string)) end",
    "name": (
        "case when o_orderkey % 89 = 0 then null else concat('  Place ', cast(o_custkey as string), ' ') end"
    ),
    "rating": (
        "case when o_orderkey % 101 = 0 then null else round(o_totalprice / 80000.0 - 0.5, 1) + 0.0 end"
    ),
    "data_source": "case when o_orderkey % 3 = 0 then 'Yelp' else 'GOOGLE_PLACES' end",
    "formatted_address": (
        "case when o_orderkey % 11 = 0 then 'no address' when o_orderkey % 13 = 0 then null else "
        "concat(cast(o_custkey as string), ' Main St, Area ', cast(o_custkey % 25 as string), ', ', "
        f"{STATE}, ' 94105, USA') end"
    ),
    "price_level": "cast(case when o_orderkey % 7 = 6 then null else o_orderkey % 7 end as int)",
    "user_ratings_total": "cast(case when o_custkey % 17 = 0 then null else o_custkey % 300 end as int)",
    "latitude": "cast(cast(o_custkey % 180 - 90 as double) as string)",
    "longitude": (
        "case when o_orderkey % 19 = 0 then 'bad' else cast(cast(o_orderkey % 360 - 180 as double) as string) end"
    ),
    "categories": "case when o_orderkey % 4 = 0 then '[\"cafe\"]' else cast(null as string) end",
    "ingestion_timestamp": "o_orderdate",
    "search_location": "concat('Location ', cast(o_custkey as string))",
    "area": "concat('Area ', cast(o_custkey % 25 as string))",
}

LOCATION = {
    "ordinal": "c_custkey",
    "name": "concat('Location ', cast(c_custkey as string))",
    "country": "case when c_nationkey % 2 = 0 then 'US' else 'CA' end",
    "priority": "case c_custkey % 3 when 0 then 'high' when 1 then 'medium' else 'low' end",
    "enabled": "c_custkey % 5 <> 0",
    "lat": "case when c_custkey % 13 = 0 then null else cast(c_custkey % 180 - 90 as double) end",
    "lng": "case when c_custkey % 13 = 0 then null else cast(c_custkey * 7 % 360 - 180 as double) end",
    "segment": "c_mktsegment",
}

# Places scattered around 25 centres, most within a few kilometres of one.
PLACE = {
    "row_key": "o_orderkey",
    "review_count": "cast(o_custkey % 300 as int)",
    "latitude": "cast(-60 + 5 * (o_custkey % 25) as double) + cast(o_orderkey % 101 - 50 as double) / 1000",
    "longitude": "cast(-120 + 10 * (o_custkey % 25) as double) + cast(o_orderkey % 73 - 36 as double) / 1000",
}

CENTRE = {
    "name": "n_name",
    "latitude": "cast(-60 + 5 * n_nationkey as double)",
    "longitude": "cast(-120 + 10 * n_nationkey as double)",
    "priority": "case n_nationkey % 3 when 0 then 'high' when 1 then 'medium' else 'low' end",
}

# Listings as messages report them: one per event, the user being the listing.
EVENT = {
    "key": "cast(event_id as string)",
    "id": "concat('rest_', cast(user_id as string))",
    "name": "concat('Place ', cast(user_id as string))",
    "rating": "cast(floor(value / 2e0) as double) / 10e0 - 5e-1",
    "data_source": "event_type",
    "formatted_address": (
        "case when event_id % 11 = 0 then null else concat(cast(user_id as string), ' Oak Ave, Town ', "
        "cast(user_id % 7 as string), ', CA 94105') end"
    ),
    "price_level": "cast(user_id % 5 as int)",
    "user_ratings_total": "cast(user_id % 200 as int)",
    "latitude": "cast(user_id % 180 - 90 as double)",
    "longitude": "cast(event_id % 360 - 180 as double)",
    "categories": "cast(null as string)",
    "ingestion_timestamp": "ts",
}

AT = "timestamp_ntz '2001-08-02 03:04:05'"

RAW_SQL = _sql(LISTING, "orders")
LOCATION_SQL = _sql(LOCATION, "customer")
PLACE_SQL = _sql(PLACE, "orders")
CENTRE_SQL = _sql(CENTRE, "nation")
EVENT_SQL = _sql(EVENT, "events")

BAD_MESSAGE = "event_id % 101 = 0"


def at() -> Column:
    """The fixed clock of the checks."""
    return F.expr(AT)


def raw_listings(spark: SparkSession, sf: str) -> DataFrame:
    return _frame(spark, sf, LISTING, "orders")


def canonical_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Raw listings without the columns that only other inputs need."""
    return raw_listings(spark, sf).drop("search_location", "area")


def locations(spark: SparkSession, sf: str) -> DataFrame:
    flat = _frame(spark, sf, LOCATION, "customer")
    coordinates = F.when(F.col("lat").isNotNull(), F.struct("lat", "lng"))
    return flat.withColumns(
        {"coordinates": coordinates, "last_updated": F.lit(None).cast("string")}
    ).drop("lat", "lng", "segment")


def category_members(spark: SparkSession, sf: str) -> DataFrame:
    return _frame(spark, sf, LOCATION, "customer").select(F.col("segment").alias("category"), "name")


def places(spark: SparkSession, sf: str) -> DataFrame:
    types = F.when(F.col("row_key") % 4 == 0, F.array(F.lit("cafe"))).otherwise(
        F.array(F.lit("food"), F.lit("restaurant"))
    )
    return _frame(spark, sf, PLACE, "orders").withColumn("types", types)


def centres(spark: SparkSession, sf: str) -> DataFrame:
    return _frame(spark, sf, CENTRE, "nation")


def event_listings(spark: SparkSession, sf: str) -> DataFrame:
    return _frame(spark, sf, EVENT, "events")


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Event listings in message envelopes.

    The event time inside the message alternates between ISO text and epoch seconds, and some
    messages are broken off in the middle.
    """
    columns = EVENT | {"sent": "cast(ts as timestamp)", "broken": BAD_MESSAGE}
    events = _frame(spark, sf, columns, "events")
    seconds = F.unix_timestamp("sent").cast("decimal(20,1)").cast("string")
    even = F.col("key").cast("bigint") % 2 == 0
    timed = events.withColumn("ingestion_timestamp", F.when(even, F.col("sent").cast("string")).otherwise(seconds))
    body = F.to_json(F.struct(*[c for c in EVENT if c != "key"]))
    value = F.when(F.col("broken"), F.lit("{broken")).otherwise(body)
    return timed.select("key", value.alias("value"), F.col("sent").alias("timestamp"))


TEXT_FORMATS = ("json", "csv", "text")
RECORDS_PER_FILE = 200_000

_landed: list[tuple[str, str, DataFrame, str]] = []


def land(df: DataFrame, format: str, label: str, **options) -> str:
    """Write ``df`` where a reader or a stream can pick it up and return the folder.

    A session lands the same rows of the same tables once, so that repeated runs time the reader. Text repeats its
    keys in every record, so it is landed compressed, in files of bounded length, as one such file is read by one task.
    """
    if format in TEXT_FORMATS:
        options = {"compression": "gzip", "maxRecordsPerFile": RECORDS_PER_FILE} | options
    run = df.sparkSession.sparkContext.applicationId
    for other, name, frame, path in _landed:
        if (other, name) == (run, label) and frame.sameSemantics(df):
            return path
    path = fresh_path(df.sparkSession, label)
    df.write.format(format).options(**options).save(path)
    _landed.append((run, label, df, path))
    return path
