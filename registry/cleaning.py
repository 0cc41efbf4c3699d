"""Projections, cleaning and models."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemat.functions import clean, derive
from placemat.operators import ranking, shape
from placemat.plans import models
from placemat.schema import PLACE_V1, PLACES_MAPPING, STAGING_COLUMNS, DIMENSION_COLUMNS, SERVING_COLUMNS
from registry import sql as S
from registry.core import query
from registry.inputs import at, canonical_listings, raw_listings, table_of

def rated(spark, sf):
    """Cleaned listings with the dimension's metrics, before ids are completed."""
    return models.rate_listings(models.clean_listings(raw_listings(spark, sf), at()), S.AS_OF)


@query(
    "p1_flatten_json",
    """SELECT event_id, cast(json_extract(props, '$.k') as int) AS props_k, event_type AS info_type,
         user_id AS info_who_user, value AS info_who_value,
         concat('["', event_type, '", "u', cast(user_id as varchar), '"]') AS tags,
         concat('[{"n": ', cast(user_id as varchar), ', "t": "', event_type, '"}]') AS parts
       FROM events""",
)
def p1(spark, sf):
    events = table_of(spark, sf, "events")
    who = F.struct(F.col("user_id").alias("user"), "value")
    nested = events.select(
        "event_id",
        F.from_json("props", "k int").alias("props"),
        F.struct(F.col("event_type").alias("type"), who.alias("who")).alias("info"),
        F.array("event_type", F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("tags"),
        F.array(F.struct(F.col("user_id").alias("n"), F.col("event_type").alias("t"))).alias("parts"),
    )
    return shape.flatten_json(nested)


PLACE_V1_EXPR = {
    "id": "case when o_orderkey % 97 = 0 then null else concat('p_', cast(o_orderkey as string)) end",
    "displayName": (
        "case when o_orderkey % 89 = 0 then null else named_struct('text', concat('Place ', cast(o_custkey as string))) end"
    ),
    "rating": "case when o_orderkey % 5 = 0 then null else round(o_totalprice / 100000.0, 1) + 0.0 end",
    "userRatingCount": "case when o_orderkey % 6 = 0 then null else cast(o_custkey % 300 as int) end",
    "priceLevel": "case when o_orderkey % 3 = 0 then null else cast(o_orderkey % 5 as string) end",
    "types": "case when o_orderkey % 4 = 0 then null else array('food', lower(o_orderstatus)) end",
    "formattedAddress": (
        "case when o_orderkey % 7 = 0 then null else concat(cast(o_custkey as string), ' Main St, Town, CA') end"
    ),
    "location": (
        "case when o_orderkey % 9 = 0 then null else named_struct('latitude', cast(o_custkey % 90 as double), "
        "'longitude', cast(o_orderkey % 180 as double)) end"
    ),
}

LEGACY_SQL = """SELECT coalesce(case when o_orderkey % 97 = 0 then null else concat('p_', cast(o_orderkey as varchar)) end, '') AS place_id,
  case when o_orderkey % 89 = 0 then 'Unknown' else concat('Place ', cast(o_custkey as varchar)) end AS name,
  case when o_orderkey % 5 = 0 then 0 else round(o_totalprice / 100000.0, 1) + 0.0 end AS rating,
  case when o_orderkey % 6 = 0 then 0 else cast(o_custkey % 300 as int) end AS user_ratings_total,
  case when o_orderkey % 3 = 0 then '0' else cast(o_orderkey % 5 as varchar) end AS price_level,
  case when o_orderkey % 4 = 0 then '[]' else concat('["food", "', lower(o_orderstatus), '"]') end AS types,
  case when o_orderkey % 7 = 0 then '' else concat(cast(o_custkey as varchar), ' Main St, Town, CA') end AS formatted_address,
  case when o_orderkey % 9 = 0 then 0.0 else cast(o_custkey % 90 as double) end AS geometry_location_lat,
  case when o_orderkey % 9 = 0 then 0.0 else cast(o_orderkey % 180 as double) end AS geometry_location_lng
FROM orders"""


def places_v1(spark, sf):
    fields = table_of(spark, sf, "orders").selectExpr(*[f"{e} AS {n}" for n, e in PLACE_V1_EXPR.items()])
    return fields.to(T.StructType.fromDDL(PLACE_V1))


@query("p2_places_v1_to_legacy", LEGACY_SQL)
def p2(spark, sf):
    return shape.flatten_json(shape.places_v1_to_legacy(places_v1(spark, sf)))


@query(
    "p3_stamp_source",
    S.over_raw(f"SELECT row_key, name, 'yelp' AS data_source, {S.AT} AS ingestion_timestamp FROM raw"),
)
def p3(spark, sf):
    return shape.stamp_source(raw_listings(spark, sf).select("row_key", "name"), "yelp", at())


@query("p4_standardize_name", S.over_raw("SELECT row_key, trim(name) AS restaurant_name FROM raw"))
def p4(spark, sf):
    return shape.standardize_name(raw_listings(spark, sf)).select("row_key", "restaurant_name")


@query(
    "p5_clamp_rating",
    S.over_raw(
        f"SELECT row_key, {S.CLAMP} AS rating, least(greatest(coalesce(rating, 0), 0), 5) AS rating_filled FROM raw"
    ),
)
def p5(spark, sf):
    rating = F.col("rating")
    return raw_listings(spark, sf).select(
        "row_key", clean.clamp_rating(rating).alias("rating"), clean.clamp_rating_filled(rating).alias("rating_filled")
    )


@query("p6_standardize_source", S.over_raw("SELECT row_key, lower(data_source) AS data_source FROM raw"))
def p6(spark, sf):
    source = clean.standardize_source(F.col("data_source")).alias("data_source")
    return raw_listings(spark, sf).select("row_key", source)


@query(
    "p7_extract_address",
    S.over_raw(f"SELECT row_key, {S.CITY} AS city, {S.STATE} AS state, {S.TOWN} AS town FROM raw"),
)
def p7(spark, sf):
    town = clean.city_of(F.col("formatted_address"), 2).alias("town")
    return shape.extract_address(raw_listings(spark, sf)).select("row_key", "city", "state", town)


@query(
    "p8_clean_price_level",
    S.over_raw("SELECT row_key, coalesce(price_level, 0) AS price_level, coalesce(try_cast(trunc(try_cast(longitude as double)) as int), 0) AS from_text FROM raw"),
)
def p8(spark, sf):
    return raw_listings(spark, sf).select(
        "row_key",
        clean.clean_price_level(F.col("price_level")).alias("price_level"),
        clean.clean_price_level(F.col("longitude")).alias("from_text"),
    )


@query("p9_clean_review_count", S.over_raw("SELECT row_key, coalesce(user_ratings_total, 0) AS review_count FROM raw"))
def p9(spark, sf):
    count = clean.clean_review_count(F.col("user_ratings_total")).alias("review_count")
    return raw_listings(spark, sf).select("row_key", count)


@query(
    "p10_clean_coordinates",
    S.over_raw(
        "SELECT row_key, try_cast(latitude as double) AS latitude, try_cast(longitude as double) AS longitude, "
        "coalesce(try_cast(longitude as double), 0.0) AS longitude_filled FROM raw"
    ),
)
def p10(spark, sf):
    filled = clean.clean_coordinate(F.col("longitude"), 0.0)
    listings = raw_listings(spark, sf).withColumn("longitude_filled", filled)
    return shape.clean_coordinates(listings).select("row_key", "latitude", "longitude", "longitude_filled")


@query("p11_default_categories", S.over_raw("SELECT row_key, coalesce(categories, '[]') AS categories FROM raw"))
def p11(spark, sf):
    categories = clean.default_categories(F.col("categories")).alias("categories")
    return raw_listings(spark, sf).select("row_key", categories)


@query("p12_surrogate_id", S.over_cleaned("SELECT row_key, restaurant_id FROM cleaned"))
def p12(spark, sf):
    named = raw_listings(spark, sf).where("name is not null")
    return ranking.surrogate_id(named, "row_key").select("row_key", "restaurant_id")


@query("p13_rating_category", S.over_raw(f"SELECT row_key, {S.RATING_CATEGORY} AS rating_category FROM raw"))
def p13(spark, sf):
    return raw_listings(spark, sf).select("row_key", derive.rating_category(F.col("rating")).alias("rating_category"))


@query(
    "p14_rating_category_binned",
    S.over_raw(
        """SELECT row_key, case when rating > 0 and rating <= 3 then 'Below Average'
             when rating > 3 and rating <= 3.5 then 'Average' when rating > 3.5 and rating <= 4 then 'Good'
             when rating > 4 and rating <= 4.5 then 'Very Good' when rating > 4.5 and rating <= 5 then 'Excellent'
           end AS rating_category FROM raw"""
    ),
)
def p14(spark, sf):
    binned = derive.rating_category_binned(F.col("rating")).alias("rating_category")
    return raw_listings(spark, sf).select("row_key", binned)


@query(
    "p15_price_category",
    S.over_raw(
        f"SELECT row_key, {S.PRICE_CATEGORY} AS price_category, "
        "case when price_level between 1 and 4 then repeat('$', price_level) end AS price_category_mapped FROM raw"
    ),
)
def p15(spark, sf):
    level = F.col("price_level")
    return raw_listings(spark, sf).select(
        "row_key",
        derive.price_category(level).alias("price_category"),
        derive.price_category(level, None).alias("price_category_mapped"),
    )


@query(
    "p16_business_tier", S.over_raw(f"SELECT row_key, {S.tier('user_ratings_total')} AS business_tier FROM raw")
)
def p16(spark, sf):
    tier = derive.business_tier(F.col("rating"), F.col("user_ratings_total")).alias("business_tier")
    return raw_listings(spark, sf).select("row_key", tier)


@query(
    "p17_business_tier_sequential",
    S.over_raw(
        """SELECT row_key, case when rating < 3.0 then 'Needs Improvement' when rating >= 3.5 then 'Good Quality'
             when rating >= 4.0 and user_ratings_total >= 50 then 'High Quality' else 'Standard' end AS business_tier
           FROM raw"""
    ),
)
def p17(spark, sf):
    tier = derive.business_tier_sequential(F.col("rating"), F.col("user_ratings_total")).alias("business_tier")
    return raw_listings(spark, sf).select("row_key", tier)


@query("p18_review_volume", S.over_cleaned("SELECT row_key, review_volume_category FROM cleaned"))
def p18(spark, sf):
    return rated(spark, sf).select("row_key", "review_volume_category")


@query(
    "p19_review_volume_binned",
    S.over_raw(
        """SELECT row_key, case when user_ratings_total > 200 then 'High Volume'
             when user_ratings_total > 50 then 'Medium Volume' when user_ratings_total > 10 then 'Low Volume'
             when user_ratings_total > 0 then 'Very Low Volume' end AS review_volume_category FROM raw"""
    ),
)
def p19(spark, sf):
    volume = derive.review_volume_binned(F.col("user_ratings_total")).alias("review_volume_category")
    return raw_listings(spark, sf).select("row_key", volume)


@query(
    "p20_full_location",
    S.over_raw(
        """SELECT row_key, coalesce(name, 'Unknown') || ', ' || coalesce(categories, 'Unknown') AS full_location
           FROM raw"""
    ),
)
def p20(spark, sf):
    location = derive.full_location(F.col("name"), F.col("categories")).alias("full_location")
    return raw_listings(spark, sf).select("row_key", location)


@query(
    "p21_data_freshness",
    S.over_raw(f"SELECT row_key, {S.freshness('ingestion_timestamp', S.AS_OF)} AS data_freshness FROM raw"),
)
def p21(spark, sf):
    freshness = derive.data_freshness(F.col("ingestion_timestamp"), S.AS_OF).alias("data_freshness")
    return raw_listings(spark, sf).select("row_key", freshness)


@query(
    "p22_audit_columns",
    S.over_raw(
        f"SELECT row_key, {S.AT} AS processed_at, {S.AT} AS dbt_updated_at, '{S.RUN_ID}' AS dbt_run_id FROM raw"
    ),
)
def p22(spark, sf):
    return shape.audit_columns(raw_listings(spark, sf).select("row_key"), S.RUN_ID, at())


@query("p23_staging_listings", S.over_cleaned(f"SELECT {', '.join(STAGING_COLUMNS)} FROM cleaned"))
def p23(spark, sf):
    return models.staging_listings(canonical_listings(spark, sf), at(), "row_key")


@query("p24_dim_listings", S.over_cleaned(f"SELECT {', '.join(DIMENSION_COLUMNS)} FROM cleaned"))
def p24(spark, sf):
    return models.dim_listings(models.staging_listings(canonical_listings(spark, sf), at(), "row_key"), S.RUN_ID, S.AS_OF, at())


@query(
    "p25_enrich_listings",
    S.over_raw(
        f"""SELECT *, {S.RATING_CATEGORY} AS rating_category, {S.PRICE_CATEGORY} AS price_category,
              {S.tier('review_count')} AS business_tier
            FROM (SELECT row_key, id, name, {S.CLAMP} AS rating, lower(data_source) AS data_source,
                    formatted_address, coalesce(price_level, 0) AS price_level, user_ratings_total,
                    try_cast(latitude as double) AS latitude, try_cast(longitude as double) AS longitude,
                    categories, ingestion_timestamp, name AS restaurant_name, {S.CITY} AS city,
                    {S.STATE} AS state, coalesce(user_ratings_total, 0) AS review_count, {S.AT} AS processed_at
                  FROM raw) AS r"""
    ),
)
def p25(spark, sf):
    return models.enrich_listings(canonical_listings(spark, sf), at())


@query(
    "p26_canonicalize",
    f"""SELECT place_id AS id, trim(name) AS restaurant_name, least(greatest(rating, 0), 5) AS rating,
          'unknown' AS data_source, {S.CITY} AS city, {S.STATE} AS state, formatted_address,
          cast(price_level as int) AS price_level, user_ratings_total AS review_count,
          geometry_location_lat AS latitude, geometry_location_lng AS longitude, types AS categories
        FROM ({LEGACY_SQL}) AS l""",
)
def p26(spark, sf):
    flat = shape.flatten_json(shape.places_v1_to_legacy(places_v1(spark, sf)))
    return shape.canonicalize(flat, PLACES_MAPPING).drop("ingestion_timestamp")


SERVED = ", ".join({"place_id": "id AS place_id", "name": "restaurant_name AS name"}.get(c, c) for c in SERVING_COLUMNS)


@query("p27_serving_projection", S.over_cleaned(f"SELECT {SERVED} FROM cleaned"))
def p27(spark, sf):
    return models.serving_projection(rated(spark, sf))


STARS = (
    "repeat('⭐', cast(floor(rating) as int) + case when rating - floor(rating) >= 0.5 then 1 else 0 end)"
)
EMPTY = "repeat('☆', 5 - cast(floor(rating) as int) - case when rating - floor(rating) >= 0.5 then 1 else 0 end)"
STAR_RATING = (
    f"case when rating is null then 'No rating' else {STARS} || {EMPTY} || ' (' || printf('%.1f', rating) || ')' end"
)


@query("p28_star_rating", S.over_cleaned(f"SELECT row_key, {STAR_RATING} AS star_rating FROM cleaned"))
def p28(spark, sf):
    return rated(spark, sf).select("row_key", derive.star_rating(F.col("rating")).alias("star_rating"))


@query("p29_star_rating_compact", S.over_cleaned(f"SELECT row_key, {STARS} AS stars FROM cleaned"))
def p29(spark, sf):
    return rated(spark, sf).select("row_key", derive.star_rating_compact(F.col("rating")).alias("stars"))


@query(
    "p30_detail_projection",
    S.over_cleaned(
        f"""SELECT restaurant_name AS name, {STAR_RATING} AS star_rating, city, price_category, review_count,
              business_tier, data_source FROM cleaned"""
    ),
)
def p30(spark, sf):
    return models.detail_projection(models.serving_projection(rated(spark, sf)))
