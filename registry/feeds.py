"""Landed feed responses, lookups between feeds, unions and the batch run.

Responses are landed from the given tables first, then read by the library's readers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from placemat.operators import combine, lookup, shape, stats, varying
from placemat.plans import batch
from placemat.scratch import fresh_path
from placemat.schema import PLACES_MAPPING
from placemat.sources import files
from registry import sql as S
from registry.cleaning import LEGACY_SQL, PLACE_V1_EXPR, places_v1
from registry.core import query
from registry.inputs import at, land, locations, raw_listings, table_of

BUSINESS = (
    "id string, name string, rating double, review_count int, "
    "location struct<address1:string,city:string,state:string>, "
    "categories array<struct<alias:string,title:string>>, "
    "coordinates struct<latitude:double,longitude:double>, search_location string"
)

BUSINESS_MAPPING = {
    "user_ratings_total": "review_count",
    "formatted_address": "location_address1",
    "latitude": "coordinates_latitude",
    "longitude": "coordinates_longitude",
}

# A response per order: absent for every tenth, empty for the next, else one or two records.
COPIES = "(VALUES ('a'), ('b')) AS s(copy)"
KEEP = "o_orderkey % 10 NOT IN (0, 1) AND (copy = 'a' OR o_orderkey % 4 = 0)"


def _responses(spark, sf, record, array: str):
    """Each order's records in one response; a record is built for a copy letter."""
    one, two = F.array(record("a")), F.array(record("a"), record("b"))
    key = F.col("o_orderkey")
    filled = F.when(key % 4 == 0, two).otherwise(one)
    absent = F.when(key % 10 > 1, filled).when(key % 10 == 1, F.filter(one, lambda _: F.lit(False)))
    return table_of(spark, sf, "orders").withColumn(array, absent)


def business(copy: str):
    """A nested business record of an order."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    address = F.concat(customer.cast("string"), F.lit(" Oak Ave, Town, CA"))
    return F.struct(
        F.concat(F.lit("b_"), key.cast("string"), F.lit(copy)).alias("id"),
        F.when(key % 89 != 0, F.concat(F.lit("Place "), customer.cast("string"))).alias("name"),
        (F.expr("round(o_totalprice / 80000.0 - 0.5, 1) + 0.0")).alias("rating"),
        (customer % 300).cast("int").alias("review_count"),
        F.struct(
            F.when(key % 11 != 0, address).alias("address1"), F.lit("Town").alias("city"), F.lit("CA").alias("state")
        ).alias("location"),
        F.array(F.struct(F.lower("o_orderstatus").alias("alias"), F.col("o_orderstatus").alias("title"))).alias(
            "categories"
        ),
        F.struct(
            (customer % 90).cast("double").alias("latitude"), (key % 180).cast("double").alias("longitude")
        ).alias("coordinates"),
        F.concat(F.lit("Location "), customer.cast("string")).alias("search_location"),
    )


def businesses(spark, sf):
    responses = _responses(spark, sf, business, "businesses").select("businesses")
    return files.read_business_json(spark, land(responses, "json", "business"), BUSINESS)


@query(
    "s1_unreadable_responses",
    """SELECT concat('{"businesses": [{"id": "b_', cast(o_orderkey as varchar)) AS text FROM orders
       WHERE o_orderkey % 50 = 7""",
)
def s1_unreadable(spark, sf):
    """Every fiftieth response breaks off in the middle."""
    broken = F.concat(F.lit('{"businesses": [{"id": "b_'), F.col("o_orderkey").cast("string"))
    whole = F.concat(broken, F.lit('"}]}'))
    lines = table_of(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 50 == 7, broken).otherwise(whole).alias("value"))
    found = files.unreadable_responses(spark, land(lines, "text", "broken"), "businesses array<struct<id: string>>")
    return found.select("text")


def varying_records(spark, sf):
    """Records that have a key only where an order says so, at three depths and in the elements of an array."""
    key = F.col("o_orderkey")
    note = F.concat(F.lit('say "a, b: c" \\ \u00e9\U0001f600 '), F.col("o_orderstatus"))
    geo = F.when(key % 6 == 0, F.struct((key % 90).alias("lat"), F.when(key % 12 == 0, F.lit(1.5)).alias("lng")))
    tag = F.struct(F.when(key % 8 == 0, note).alias("a"), F.col("o_custkey").alias("b"))
    record = F.struct(
        F.concat(F.lit("b_"), key.cast("string")).alias("id"),
        F.when(key % 5 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 3 == 0, F.struct(F.col("o_orderstatus").alias("city"), geo.alias("geo"))).alias("location"),
        F.when(key % 4 == 0, F.array(tag, tag)).alias("tags"),
        F.when(key % 7 == 0, F.col("o_orderpriority")).alias("order priority"),
    )
    return table_of(spark, sf, "orders").select(F.struct(F.when(key % 10 > 0, F.array(record)).alias("businesses")).alias("r"))


NOTE = """'say \\"a, b: c\\" ' || chr(92) || chr(92) || ' ' || chr(92) || 'u00e9' || chr(92) || 'ud83d' || chr(92) || 'ude00 ' || o_orderstatus"""
TAG = f"""'{{' || case when o_orderkey % 8 = 0 then '"a": "' || {NOTE} || '", ' else '' end || '"b": ' || o_custkey::varchar || '}}'"""


@query(
    "p31_flatten_varying_feed",
    f"""SELECT 'b_' || o_orderkey::varchar AS id, case when o_orderkey % 5 <> 0 then o_totalprice::double end AS price,
          case when o_orderkey % 3 = 0 then o_orderstatus end AS location_city,
          case when o_orderkey % 6 = 0 then o_orderkey % 90 end AS location_geo_lat,
          case when o_orderkey % 12 = 0 then 1.5::double end AS location_geo_lng,
          case when o_orderkey % 4 = 0 then '[' || {TAG} || ', ' || {TAG} || ']' end AS tags,
          case when o_orderkey % 7 = 0 then o_orderpriority end AS "order priority"
        FROM orders WHERE o_orderkey % 10 > 0""",
)
def p31_varying(spark, sf):
    """No schema is given: the keys are found in the landed responses."""
    lines = varying_records(spark, sf).select(F.to_json("r").alias("value"))
    responses = varying.read_varying_json(spark, land(lines, "text", "varying"))
    return varying.flatten_varying(varying.explode_records(responses, "businesses"))


@query(
    "s5_read_business_details_json",
    """SELECT concat('b_', cast(o_orderkey as varchar)) AS id, o_orderstatus AS name, o_totalprice AS price
       FROM orders WHERE o_orderkey % 6 <> 0""",
)
def s5_business(spark, sf):
    """Records without an envelope; every sixth is an error without an id."""
    key = F.concat(F.lit("b_"), F.col("o_orderkey").cast("string"))
    records = table_of(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 6 != 0, key).alias("id"),
        F.col("o_orderstatus").alias("name"),
        F.col("o_totalprice").alias("price"),
    )
    return files.read_business_details_json(spark, land(records, "json", "business-details"), "id string, name string, price double")


BUSINESS_SQL = f"""SELECT concat('b_', cast(o_orderkey as varchar), copy) AS id,
  case when o_orderkey % 89 <> 0 then concat('Place ', cast(o_custkey as varchar)) end AS name,
  round(o_totalprice / 80000.0 - 0.5, 1) + 0.0 AS rating, cast(o_custkey % 300 as int) AS review_count,
  case when o_orderkey % 11 <> 0 then concat(cast(o_custkey as varchar), ' Oak Ave, Town, CA') end AS location_address1,
  'Town' AS location_city, 'CA' AS location_state,
  concat('[{{"alias": "', lower(o_orderstatus), '", "title": "', o_orderstatus, '"}}]') AS categories,
  cast(o_custkey % 90 as double) AS coordinates_latitude, cast(o_orderkey % 180 as double) AS coordinates_longitude,
  concat('Location ', cast(o_custkey as varchar)) AS search_location
FROM orders, {COPIES} WHERE {KEEP}"""


@query("s1_read_business_json", BUSINESS_SQL)
def s1(spark, sf):
    return shape.flatten_json(businesses(spark, sf))


@query("p31_flatten_listings", f"SELECT *, {S.AT} AS ingestion_timestamp, 'yelp' AS data_source FROM ({BUSINESS_SQL}) AS b")
def p31(spark, sf):
    return shape.flatten_listings(businesses(spark, sf), "yelp", at())


@query(
    "s2_read_places_legacy_json",
    f"""SELECT l.* FROM ({LEGACY_SQL}) AS l
        WHERE coalesce(try_cast(substr(place_id, 3) as bigint), 1) % 6 <> 0""",
)
def s2(spark, sf):
    legacy = shape.places_v1_to_legacy(places_v1(spark, sf))
    number = F.coalesce(F.substring("place_id", 3, 20).try_cast("bigint"), F.lit(1))
    status = F.when(number % 6 == 0, "ZERO_RESULTS").otherwise("OK")
    responses = legacy.select(status.alias("status"), F.array(F.struct(*legacy.columns)).alias("results"))
    return shape.flatten_json(files.read_places_legacy_json(spark, land(responses, "json", "legacy")))


@query("s3_read_places_v1_json", f"{LEGACY_SQL} WHERE o_orderkey % 10 NOT IN (0, 1)")
def s3(spark, sf):
    fields = table_of(spark, sf, "orders").selectExpr("o_orderkey", *[f"{e} AS {n}" for n, e in PLACE_V1_EXPR.items()])
    record = F.array(F.struct(*PLACE_V1_EXPR))
    part = F.col("o_orderkey") % 10
    found = F.when(part > 1, record).when(part == 1, F.filter(record, lambda _: F.lit(False)))
    return shape.flatten_json(
        files.read_places_v1_json(spark, land(fields.select(found.alias("places")), "json", "v1"))
    )


REVIEW = "turn bigint, author struct<role:string>, text string"


def reviews(spark, sf):
    turns = table_of(spark, sf, "conversations")
    review = F.struct("turn", F.struct("role").alias("author"), "text")
    listed = F.when((F.col("conv_id") + F.col("turn")) % 7 != 0, F.array(review))
    responses = turns.select(F.concat(F.lit("rest_"), F.col("conv_id").cast("string")).alias("business_id"), listed.alias("reviews"))
    return files.read_reviews_json(spark, land(responses, "json", "reviews"), REVIEW)


REVIEW_SQL = """SELECT concat('rest_', cast(conv_id as varchar)) AS business_id, turn, role AS author_role, text
  FROM conversations WHERE (conv_id + turn) % 7 <> 0"""


@query("s4_read_reviews_json", REVIEW_SQL)
def s4(spark, sf):
    return shape.flatten_json(reviews(spark, sf))


@query("p32_flatten_reviews", f"SELECT *, {S.AT} AS ingestion_timestamp, 'yelp' AS data_source FROM ({REVIEW_SQL}) AS r")
def p32(spark, sf):
    return shape.flatten_reviews(reviews(spark, sf), "yelp", at())


@query(
    "s5_read_details_json",
    """SELECT concat('d_', cast(doc_id as varchar)) AS place_id, lang, source, n_chars, text
       FROM documents WHERE doc_id % 6 <> 0""",
)
def s5(spark, sf):
    documents = table_of(spark, sf, "documents")
    responses = documents.select(
        F.concat(F.lit("d_"), F.col("doc_id").cast("string")).alias("place_id"),
        F.when(F.col("doc_id") % 6 == 0, "NOT_FOUND").otherwise("OK").alias("status"),
        F.struct("lang", "source", "n_chars", "text").alias("result"),
    )
    path = land(responses, "json", "details")
    return files.read_details_json(spark, path, "lang string, source string, n_chars bigint, text string")


@query("s7_read_table", "SELECT o_orderkey, o_totalprice FROM orders")
def s7(spark, sf):
    return files.read_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_totalprice"])


@query(
    "s9_read_locations",
    S.over_locations(
        """SELECT name, coalesce(country, 'US') AS country, case when ordinal % 4 = 0 then 'medium' else priority end
             AS priority, enabled, lat, lng, cast(null as varchar) AS last_updated FROM locations"""
    ),
)
def s9(spark, sf):
    # Every fourth location is landed without a priority.
    partial = locations(spark, sf).withColumn("priority", F.when(F.col("ordinal") % 4 != 0, F.col("priority")))
    read = files.read_locations(spark, land(partial.drop("ordinal"), "json", "locations"))
    return read.select("*", "coordinates.lat", "coordinates.lng").drop("coordinates")


@query(
    "s10_read_seed_csv",
    S.over_raw("SELECT id, name, cast(cast(rating as float) as double) AS rating, data_source FROM raw"),
)
def s10(spark, sf):
    seed = raw_listings(spark, sf).select("id", "name", "rating", "data_source")
    path = land(seed, "csv", "seed", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return files.read_seed_csv(spark, path).withColumn("rating", F.col("rating").cast("double"))


@query(
    "p32_flatten_place_reviews",
    f"""SELECT concat('d_', cast(doc_id as varchar)) AS place_id, doc_id AS review, lang AS author_lang, text,
          {S.AT} AS ingestion_timestamp, 'google_places' AS data_source FROM documents WHERE doc_id % 6 <> 0""",
)
def p32_places(spark, sf):
    documents = table_of(spark, sf, "documents")
    review = F.struct(F.col("doc_id").alias("review"), F.struct("lang").alias("author"), "text")
    responses = documents.select(
        F.concat(F.lit("d_"), F.col("doc_id").cast("string")).alias("place_id"),
        F.when(F.col("doc_id") % 6 == 0, "NOT_FOUND").otherwise("OK").alias("status"),
        F.struct(F.array(review).alias("reviews")).alias("result"),
    )
    detail = "reviews array<struct<review:bigint,author:struct<lang:string>,text:string>>"
    details = files.read_details_json(spark, land(responses, "json", "place-reviews"), detail)
    return shape.flatten_reviews(lookup.attach_parent_key(details, "place_id"), "google_places", at())


# Lookups

@query(
    "j1_attach_coordinates",
    f"""WITH {S.RAW}, {S.LOCATIONS} SELECT row_key, search_location, lat, lng
        FROM raw LEFT JOIN locations ON raw.search_location = locations.name""",
)
def j1(spark, sf):
    placed = lookup.attach_coordinates(raw_listings(spark, sf), locations(spark, sf))
    return placed.select("row_key", "search_location", "lat", "lng")


@query(
    "j2_attach_details",
    S.over_raw(
        """, details AS (SELECT concat('rest_', cast(d.doc_id as varchar)) AS did, lang, n_chars, quality, toxic
             FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
           SELECT row_key, id, lang, n_chars, quality, toxic FROM raw LEFT JOIN details ON id = did"""
    ),
)
def j2(spark, sf):
    documents = table_of(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    details = documents.join(table_of(spark, sf, "labels"), "doc_id", "left").withColumn(
        "id", F.concat(F.lit("rest_"), F.col("doc_id").cast("string"))
    )
    detailed = lookup.attach_details(raw_listings(spark, sf), details.drop("doc_id"))
    return detailed.select("row_key", "id", "lang", "n_chars", "quality", "toxic")


@query(
    "j3_prefer_source",
    S.over_raw(
        """, first_choice AS (SELECT * FROM raw WHERE rating >= 4.5),
           second_choice AS (SELECT * FROM raw WHERE rating < 4.5 OR rating IS NULL)
           SELECT row_key, search_location, rating FROM first_choice
           UNION ALL SELECT row_key, search_location, rating FROM second_choice
           WHERE search_location NOT IN (SELECT search_location FROM first_choice)"""
    ),
)
def j3(spark, sf):
    listings = raw_listings(spark, sf).select("row_key", "search_location", "rating")
    return lookup.prefer_source(listings.where("rating >= 4.5"), listings.where("rating < 4.5 or rating is null"))


@query(
    "j6_attach_parent_key",
    """SELECT concat('c_', cast(conv_id as varchar)) AS place_id, turn, role, part FROM conversations,
         (VALUES (0), (1)) AS v(part) WHERE (conv_id + turn) % 5 <> 0""",
)
def j6(spark, sf):
    child = [F.struct("turn", "role", F.lit(part).alias("part")) for part in (0, 1)]
    parents = table_of(spark, sf, "conversations").select(
        F.concat(F.lit("c_"), F.col("conv_id").cast("string")).alias("place_id"),
        F.when((F.col("conv_id") + F.col("turn")) % 5 != 0, F.array(*child)).alias("reviews"),
    )
    return lookup.attach_parent_key(parents, "place_id")


# Unions

@query(
    "u1_union_positional",
    S.over_raw(
        """SELECT row_key, name, rating FROM raw WHERE data_source = 'Yelp'
           UNION ALL SELECT row_key, name, rating FROM raw WHERE data_source <> 'Yelp'"""
    ),
)
def u1(spark, sf):
    listings = raw_listings(spark, sf)
    kept = ["row_key", "name", "rating"]
    feeds = [listings.where(p).select(*kept) for p in ("data_source = 'Yelp'", "data_source <> 'Yelp'")]
    return combine.union_positional(feeds)


@query(
    "u2_combine_sources",
    S.over_raw(
        """SELECT row_key, name, rating, cast(null as int) AS price_level FROM raw WHERE data_source = 'Yelp'
           UNION ALL BY NAME SELECT price_level, row_key, name FROM raw WHERE data_source <> 'Yelp'"""
    ),
)
def u2(spark, sf):
    listings = raw_listings(spark, sf)
    return combine.combine_sources(
        spark,
        [
            listings.where("data_source = 'Yelp'").select("row_key", "name", "rating"),
            listings.where("data_source <> 'Yelp'").select("price_level", "row_key", "name"),
        ],
    )


# Reports of a run

INGEST_SQL = """SELECT coalesce(search_location, name) AS search_location,
    coalesce(yelp, 0) AS yelp_records, coalesce(google, 0) AS google_places_records, coalesce(n, 0) AS records,
    concat_ws(',', case when google > 0 then 'google_places' end, case when yelp > 0 then 'yelp' end) AS sources_used,
    name IS NOT NULL AS listed, case when n > 0 then 'success' else 'no records' end AS status
  FROM (SELECT search_location, count(*) AS n, count(*) FILTER (lower(data_source) = 'yelp') AS yelp,
          count(*) FILTER (lower(data_source) = 'google_places') AS google FROM raw GROUP BY search_location) AS c
  FULL JOIN (SELECT DISTINCT name FROM listed) AS l ON search_location IS NOT DISTINCT FROM name"""


@query("a3_ingest_stats", f"WITH {S.RAW}, {S.LOCATIONS}, listed AS (SELECT * FROM locations WHERE ordinal % 7 <> 0) {INGEST_SQL}")
def a3(spark, sf):
    """Every seventh location is not listed."""
    per_location = stats.ingest_stats(raw_listings(spark, sf), locations(spark, sf).where("ordinal % 7 <> 0"))
    return per_location.withColumn("sources_used", F.concat_ws(",", "sources_used"))


SOURCES_SQL = "string_agg(DISTINCT lower(data_source), ',' ORDER BY lower(data_source))"


@query(
    "a4_run_summary",
    S.over_raw(
        f"""SELECT count(*) AS records_processed, count(DISTINCT search_location) AS locations_processed,
             {SOURCES_SQL} AS sources_used, cast(count(DISTINCT lower(data_source)) as int) AS total_sources FROM raw"""
    ),
)
def a4(spark, sf):
    summary = stats.run_summary(raw_listings(spark, sf))
    return summary.withColumn("sources_used", F.concat_ws(",", "sources_used"))


# The batch run over two feeds

def feed_list(spark, sf):
    legacy = shape.places_v1_to_legacy(places_v1(spark, sf))
    return [
        batch.Feed(businesses(spark, sf), "yelp", BUSINESS_MAPPING),
        batch.Feed(legacy.withColumn("search_location", F.lit("everywhere")), "google_places", PLACES_MAPPING),
    ]


COMBINED_SQL = f"""SELECT id, trim(name) AS restaurant_name, least(greatest(rating, 0), 5) AS rating, 'yelp' AS data_source,
    location_address1 AS formatted_address, 0 AS price_level, review_count, coordinates_latitude AS latitude,
    coordinates_longitude AS longitude, categories, search_location
  FROM ({BUSINESS_SQL}) AS b
  UNION ALL SELECT place_id, trim(name), least(greatest(rating, 0), 5), 'google_places', formatted_address,
    cast(price_level as int), user_ratings_total, geometry_location_lat, geometry_location_lng, types, 'everywhere'
  FROM ({LEGACY_SQL}) AS l"""


@query(
    "e1_batch_table",
    f"""SELECT *, {S.CITY} AS city, {S.STATE} AS state, {S.AT} AS ingestion_timestamp, {S.AT} AS processed_at,
          {S.RATING_CATEGORY} AS rating_category, {S.PRICE_CATEGORY} AS price_category,
          {S.tier('review_count')} AS business_tier
        FROM ({COMBINED_SQL}) AS c""",
)
def e1(spark, sf):
    return batch.run_batch(spark, feed_list(spark, sf), "e1_listings", fresh_path(spark, "e1"), at())


REPORTS_SQL = f"""WITH raw AS ({COMBINED_SQL}), {S.LOCATIONS}, listed AS (SELECT * FROM locations),
    per_location AS ({INGEST_SQL}),
    copies AS (SELECT * EXCLUDE (search_location), count(*) AS n FROM raw GROUP BY ALL)
  SELECT 'records' AS metric, cast(null as varchar) AS name, count(*) AS value FROM raw
  UNION ALL SELECT 'locations', null, count(DISTINCT search_location) FROM raw
  UNION ALL SELECT 'sources', {SOURCES_SQL}, count(DISTINCT lower(data_source)) FROM raw
  UNION ALL SELECT 'yelp_records', search_location, yelp_records FROM per_location
  UNION ALL SELECT 'google_places_records', search_location, google_places_records FROM per_location
  UNION ALL SELECT 'all_records', null, cast(sum(records) as bigint) FROM per_location
  UNION ALL SELECT 'missing_values', 'name', count(*) FILTER (restaurant_name IS NULL) FROM raw
  UNION ALL SELECT 'missing_values', 'rating', count(*) FILTER (rating IS NULL) FROM raw
  UNION ALL SELECT 'duplicate_records', null, cast(sum(n - 1) as bigint) FROM copies"""


@query("e1_batch_reports", REPORTS_SQL)
def e1_reports(spark, sf):
    table = batch.run_batch(spark, feed_list(spark, sf), "e1_listings_reported", fresh_path(spark, "e1"), at())
    reports = batch.run_reports(table, locations(spark, sf))
    wanted = "metric = 'duplicate_records' or (metric = 'missing_values' and `column` in ('name', 'rating'))"
    quality = reports.quality.where(wanted).selectExpr("metric", "`column` AS name", "cast(value as bigint) AS value")
    summary = reports.summary.selectExpr(
        "stack(3, 'records', cast(null as string), records_processed, "
        "'locations', cast(null as string), locations_processed, "
        "'sources', concat_ws(',', sources_used), cast(total_sources as bigint)) AS (metric, name, value)"
    )
    located = reports.per_location.selectExpr(
        "stack(2, 'yelp_records', search_location, yelp_records, "
        "'google_places_records', search_location, google_places_records) AS (metric, name, value)"
    )
    whole = reports.per_location.selectExpr("'all_records' AS metric", "cast(null as string) AS name", "records")
    whole = whole.groupBy("metric", "name").agg(F.sum("records").alias("value"))
    return quality.unionByName(summary).unionByName(located).unionByName(whole)
