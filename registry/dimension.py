"""The location dimension: one location per customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from placemat.operators import locations as loc
from placemat.operators import lookup, ranking
from registry import sql as S
from registry.core import query
from registry.inputs import category_members, locations, raw_listings, table_of

SHOWN = ("ordinal", "name", "priority", "enabled")
SHOWN_SQL = ", ".join(SHOWN)
RANK = "case priority when 'high' then 0 when 'medium' then 1 else 2 end"


def shown(spark, sf):
    return locations(spark, sf).select(*SHOWN)


@query("f5_enabled_locations", S.over_locations(f"SELECT {SHOWN_SQL} FROM locations WHERE enabled"))
def f5(spark, sf):
    return loc.enabled_locations(shown(spark, sf))


@query("f5_enabled_location_names", S.over_locations("SELECT name FROM locations WHERE enabled"))
def f5_names(spark, sf):
    return loc.enabled_location_names(shown(spark, sf))


@query(
    "f6_locations_by_priority",
    S.over_locations(f"SELECT {SHOWN_SQL} FROM locations WHERE priority = 'high' AND enabled"),
)
def f6(spark, sf):
    return loc.locations_by_priority(shown(spark, sf), "high")


@query(
    "f6_locations_by_priority_any",
    S.over_locations(f"SELECT {SHOWN_SQL} FROM locations WHERE priority = 'high'"),
)
def f6_any(spark, sf):
    return loc.locations_by_priority(shown(spark, sf), "high", enabled_only=False)


@query(
    "f7_validate_locations",
    f"""WITH {S.RAW}, {S.LOCATIONS}, asked AS (
          SELECT row_key, case when row_key % 10 = 0 then 'nowhere' when row_key % 10 > 1 then search_location end
            AS name FROM raw)
        SELECT row_key, a.name, coalesce(l.enabled, false) AS is_valid
        FROM asked a LEFT JOIN locations l ON a.name = l.name""",
)
def f7(spark, sf):
    part = F.col("row_key") % 10
    name = F.when(part == 0, F.lit("nowhere")).when(part > 1, F.col("search_location"))
    asked = raw_listings(spark, sf).select("row_key", name.alias("name"))
    return lookup.validate_locations(asked, locations(spark, sf))


@query(
    "j4_locations_by_category",
    S.over_locations(
        f"""SELECT {SHOWN_SQL} FROM locations
            WHERE enabled AND name IN (SELECT name FROM members WHERE category = 'BUILDING')"""
    ),
)
def j4(spark, sf):
    return loc.locations_by_category(shown(spark, sf), category_members(spark, sf), "BUILDING").select(*SHOWN)


@query(
    "j5_apply_priority_policy",
    S.over_locations(
        """SELECT ordinal, priority, case priority when 'high' then 50 when 'medium' then 30 else 20 end AS request_limit,
             case priority when 'high' then 5000 when 'medium' then 3000 else 2000 end AS radius_m FROM locations"""
    ),
)
def j5(spark, sf):
    return loc.apply_priority_policy(locations(spark, sf).select("ordinal", "priority"))


@query(
    "j5_top_by_policy",
    f"""WITH {S.RAW}, {S.LOCATIONS}, listed AS (
          SELECT name, case when ordinal % 11 = 0 then 'other' else priority end AS priority
          FROM locations WHERE ordinal % 7 <> 0
        ), ranked AS (
          SELECT row_key, search_location, rating, cast(row_number() OVER (
            PARTITION BY search_location ORDER BY rating DESC NULLS LAST, row_key) as int) AS rank FROM raw)
        SELECT row_key, search_location, rating, rank,
          case priority when 'high' then 50 when 'medium' then 30 when 'low' then 20 else 5 end AS request_limit
        FROM ranked r LEFT JOIN listed l ON r.search_location = l.name
        WHERE rank <= case priority when 'high' then 50 when 'medium' then 30 when 'low' then 20 else 5 end""",
)
def j5_top(spark, sf):
    """Every seventh location is not listed, and every eleventh has a priority the policy does not know."""
    listings = raw_listings(spark, sf).select("row_key", "search_location", "rating")
    other = F.when(F.col("ordinal") % 11 == 0, "other").otherwise(F.col("priority"))
    listed = locations(spark, sf).where("ordinal % 7 <> 0").withColumn("priority", other)
    return loc.top_by_policy(listings, listed, unlisted_limit=5)


@query(
    "o3_order_by_priority",
    S.over_locations(f"SELECT {SHOWN_SQL} FROM locations ORDER BY {RANK}, ordinal"),
)
def o3(spark, sf):
    return loc.order_by_priority(shown(spark, sf))


@query(
    "o4_assign_batches",
    S.over_locations(
        f"""SELECT ordinal, priority, (row_number() OVER (ORDER BY {RANK}, ordinal) - 1) // 5 AS batch
            FROM locations"""
    ),
)
def o4(spark, sf):
    return loc.assign_batches(locations(spark, sf).select("ordinal", "priority"))


@query(
    "o5_preview",
    S.over_locations(
        """SELECT name, cast(null as bigint) AS more FROM (SELECT * FROM locations ORDER BY ordinal LIMIT 5) AS f
           UNION ALL SELECT null, count(*) - 5 FROM locations HAVING count(*) > 5"""
    ),
)
def o5(spark, sf):
    return ranking.preview(locations(spark, sf))


@query(
    "a16_location_status",
    S.over_locations(
        """SELECT 'total' AS metric, cast(null as varchar) AS name, count(*) AS value FROM locations
           UNION ALL SELECT 'enabled', null, count(*) FILTER (enabled) FROM locations
           UNION ALL SELECT 'category', category, count(*) FROM members GROUP BY category"""
    ),
)
def a16(spark, sf):
    return loc.location_status(locations(spark, sf), category_members(spark, sf))


# Maintenance: the new names come from suppliers and overlap with the existing ones.

NEW_SQL = """fresh AS (SELECT s_suppkey AS ordinal, concat('Location ', cast(s_suppkey // 2 + 1450 as varchar)) AS name,
  case when s_suppkey % 3 = 0 then 'low' end AS priority FROM supplier)"""


def new_locations(spark, sf):
    return table_of(spark, sf, "supplier").selectExpr(
        "s_suppkey AS ordinal",
        "concat('Location ', cast(s_suppkey div 2 + 1450 as string)) AS name",
        "case when s_suppkey % 3 = 0 then 'low' end AS priority",
    )


@query(
    "m1_add_locations",
    S.over_locations(
        f""", {NEW_SQL}, firsts AS (
              SELECT *, row_number() OVER (PARTITION BY name ORDER BY ordinal) AS n FROM fresh
              WHERE name NOT IN (SELECT name FROM locations))
            SELECT ordinal, name, country, priority, enabled FROM locations
            UNION ALL SELECT ordinal, name, 'US', coalesce(priority, 'medium'), true FROM firsts WHERE n = 1"""
    ),
)
def m1(spark, sf):
    existing = locations(spark, sf).select("ordinal", "name", "country", "priority", "enabled")
    return loc.add_locations(existing, new_locations(spark, sf))


@query(
    "m2_remove_locations",
    S.over_locations(f", {NEW_SQL} SELECT {SHOWN_SQL} FROM locations WHERE name NOT IN (SELECT name FROM fresh)"),
)
def m2(spark, sf):
    return loc.remove_locations(shown(spark, sf), new_locations(spark, sf)).select(*SHOWN)


@query(
    "m3_set_enabled",
    S.over_locations(
        f""", {NEW_SQL} SELECT ordinal, name, priority,
              case when name IN (SELECT name FROM fresh) then false else enabled end AS enabled FROM locations"""
    ),
)
def m3(spark, sf):
    return loc.set_enabled(shown(spark, sf), new_locations(spark, sf), False)
