"""SQL text shared by the checks: the same models written for the checking engine."""

from __future__ import annotations

from registry.inputs import CENTRE_SQL, EVENT_SQL, LOCATION_SQL, PLACE_SQL, RAW_SQL

ADDRESS = r"([^,]+),\s*([^,]+),\s*([A-Z]{2})"
CITY = f"coalesce(nullif(regexp_extract(formatted_address, '{ADDRESS}', 1), ''), 'Unknown')"
TOWN = f"trim(coalesce(nullif(regexp_extract(formatted_address, '{ADDRESS}', 2), ''), 'Unknown'))"
STATE = f"coalesce(nullif(regexp_extract(formatted_address, '{ADDRESS}', 3), ''), 'Unknown')"
CLAMP = "case when rating < 0 then 0 when rating > 5 then 5 else rating end"
RATING_CATEGORY = (
    "case when rating >= 4.5 then 'Excellent' when rating >= 4.0 then 'Very Good' "
    "when rating >= 3.5 then 'Good' when rating >= 3.0 then 'Average' else 'Below Average' end"
)
PRICE_CATEGORY = (
    "case price_level when 1 then '$' when 2 then '$$' when 3 then '$$$' when 4 then '$$$$' else 'Unknown' end"
)


def tier(reviews: str) -> str:
    return (
        f"case when rating >= 4.5 and {reviews} >= 100 then 'Premium' "
        f"when rating >= 4.0 and {reviews} >= 50 then 'High Quality' "
        "when rating >= 3.5 then 'Good Quality' when rating >= 3.0 then 'Standard' "
        "else 'Needs Improvement' end"
    )


VOLUME = (
    "case when review_count >= 100 then 'High Volume' when review_count >= 50 then 'Medium Volume' "
    "when review_count >= 10 then 'Low Volume' else 'Very Low Volume' end"
)


def freshness(ts: str, as_of: str) -> str:
    age = f"date_diff('day', cast({ts} as date), date '{as_of}')"
    return (
        f"case when {age} <= 1 then 'Very Fresh' when {age} <= 7 then 'Fresh' "
        f"when {age} <= 30 then 'Recent' else 'Stale' end"
    )


AS_OF = "2001-08-01"
AT = "timestamp '2001-08-02 03:04:05'"
RUN_ID = "run-1"

RAW = f"raw AS ({RAW_SQL})"

CLEANED = f"""{RAW}, base AS (
  SELECT row_key, id, search_location, area, formatted_address, user_ratings_total,
    coalesce(id, concat('unknown_', cast(row_number() over (order by ingestion_timestamp, row_key) as varchar)))
      AS restaurant_id,
    trim(name) AS restaurant_name, {CLAMP} AS rating, lower(data_source) AS data_source,
    {CITY} AS city, {STATE} AS state, coalesce(price_level, 0) AS price_level,
    coalesce(user_ratings_total, 0) AS review_count, coalesce(categories, '[]') AS categories,
    try_cast(latitude as double) AS latitude, try_cast(longitude as double) AS longitude,
    ingestion_timestamp, {AT} AS processed_at
  FROM raw WHERE name IS NOT NULL
), cleaned AS (
  SELECT *, {RATING_CATEGORY} AS rating_category, {PRICE_CATEGORY} AS price_category,
    {tier('review_count')} AS business_tier, {VOLUME} AS review_volume_category,
    concat(city, ', ', state) AS full_location,
    {freshness('ingestion_timestamp', AS_OF)} AS data_freshness,
    {AT} AS dbt_updated_at, '{RUN_ID}' AS dbt_run_id
  FROM base
)"""

LOCATIONS = f"""flat AS ({LOCATION_SQL}), locations AS (
  SELECT ordinal, name, country, priority, enabled, lat, lng FROM flat
), members AS (SELECT segment AS category, name FROM flat)"""

PLACES = f"""scattered AS ({PLACE_SQL}), places AS (
  SELECT *, case when row_key % 4 = 0 then ['cafe'] else ['food', 'restaurant'] end AS types FROM scattered
), centres AS ({CENTRE_SQL})"""

EVENTS = f"""sent AS ({EVENT_SQL})"""


def over_raw(select: str) -> str:
    return f"WITH {RAW} {select}"


def over_cleaned(select: str) -> str:
    return f"WITH {CLEANED} {select}"


def over_locations(select: str) -> str:
    return f"WITH {LOCATIONS} {select}"


def over_places(select: str) -> str:
    return f"WITH {PLACES} {select}"


def over_events(select: str) -> str:
    return f"WITH {EVENTS} {select}"
