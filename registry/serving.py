"""Filters, reports, data tests, ranking, sinks and features over listings."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemat.operators import features, filters, geo, quadtree, quality, ranking, search, stats
from placemat.operators.locations import apply_priority_policy
from placemat.plans import models, warehouse
from placemat.schema import DIMENSION_COLUMNS
from placemat.scratch import fresh_path
from placemat.sinks import tables
from registry import sql as S
from registry.cleaning import STAR_RATING, rated
from registry.core import query
from registry.inputs import LISTING, at, canonical_listings, centres, places, raw_listings, table_of


def cleaned_raw(spark, sf):
    """Cleaned listings that also keep the raw review count."""
    return models.clean_listings(raw_listings(spark, sf), at())


CHOICE = {
    "cities": ["Unknown", *[f"{i} Main St" for i in range(0, 2000, 3)]],
    "min_rating": 3.0,
    "prices": ["$", "$$", "Unknown"],
    "sources": ["yelp"],
}
CHOICE_SQL = (
    f"(city in ({', '.join(repr(c) for c in CHOICE['cities'])}) and rating >= 3.0 "
    "and price_category in ('$', '$$', 'Unknown') and data_source in ('yelp'))"
)


@query("f1_require_name", S.over_raw("SELECT row_key, name FROM raw WHERE name IS NOT NULL"))
def f1(spark, sf):
    return filters.require_name(raw_listings(spark, sf)).select("row_key", "name")


@query(
    "f2_valid_listings",
    S.over_raw("SELECT row_key, name, rating FROM raw WHERE name IS NOT NULL AND rating BETWEEN 0 AND 5"),
)
def f2(spark, sf):
    return filters.valid_listings(raw_listings(spark, sf)).select("row_key", "name", "rating")


@query(
    "f3_filter_listings",
    S.over_cleaned(f"SELECT row_key, city, rating, price_category, data_source FROM cleaned WHERE {CHOICE_SQL}"),
)
def f3(spark, sf):
    chosen = filters.filter_listings(rated(spark, sf), **CHOICE)
    return chosen.select("row_key", "city", "rating", "price_category", "data_source")


@query(
    "f3_filter_listings_null_choice",
    S.over_raw(
        """SELECT row_key, categories AS city FROM raw
           WHERE (categories IS NULL OR categories = 'x') AND rating >= 4.0"""
    ),
)
def f3_null(spark, sf):
    listings = raw_listings(spark, sf).select("row_key", "rating", F.col("categories").alias("city"))
    return filters.filter_listings(listings, cities=[None, "x"], min_rating=4.0).select("row_key", "city")


@query(
    "f4_search_name",
    S.over_raw("SELECT row_key, name FROM raw WHERE regexp_matches(name, 'pLACE 1[0-4]+ ', 'i')"),
)
def f4(spark, sf):
    return filters.search_name(raw_listings(spark, sf), "pLACE 1[0-4]+ ").select("row_key", "name")


@query(
    "f4_search_name_indexed",
    S.over_raw("SELECT row_key, name FROM raw WHERE regexp_matches(name, 'ace 1[0-4]+7 ', 'i')"),
)
def f4_indexed(spark, sf):
    """The pattern is applied to the rows that have its rarest trigrams."""
    listings = raw_listings(spark, sf).select("row_key", "name")
    index = search.write_index(listings, fresh_path(spark, "f4-index"))
    return search.search_indexed(listings, index, "ace 1[0-4]+7 ")


def _radius_sql(radius: str, limit: str = "20") -> str:
    return S.over_places(
        f""", pairs AS (
             SELECT c.name AS search_location, p.row_key, p.review_count, {radius} AS radius_m, {limit} AS request_limit,
               2 * 6371000.0 * asin(least(1.0, sqrt(
                 pow(sin(radians(p.latitude - c.latitude) / 2), 2)
                 + cos(radians(c.latitude)) * cos(radians(p.latitude))
                 * pow(sin(radians(p.longitude - c.longitude) / 2), 2)))) AS d
             FROM centres c JOIN places p ON abs(p.latitude - c.latitude) < 0.1
             WHERE list_contains(p.types, 'restaurant')
           ), ranked AS (
             SELECT *, row_number() OVER (PARTITION BY search_location ORDER BY review_count DESC, row_key) AS rank
             FROM pairs WHERE d <= radius_m
           )
           SELECT search_location, row_key, review_count, round(d, 3) AS distance_m, cast(rank as int) AS rank
           FROM ranked WHERE rank <= request_limit"""
    )


def _found(places_frame, centres_frame, **how):
    found = geo.radius_filter(places_frame, centres_frame, **how)
    distance = F.round("distance_m", 3).alias("distance_m")
    return found.select("search_location", "row_key", "review_count", distance, "rank")


@query("f8_radius_filter", _radius_sql("5000"))
def f8(spark, sf):
    return _found(places(spark, sf), centres(spark, sf).drop("priority"))


@query(
    "f8_radius_filter_by_policy",
    _radius_sql(
        "case c.priority when 'high' then 8000 when 'medium' then 3000 else 2000 end",
        "case c.priority when 'high' then 50 when 'medium' then 30 else 20 end",
    ),
)
def f8_policy(spark, sf):
    """Policy limits and radii, the high one widened beyond the default radius."""
    policy = apply_priority_policy(centres(spark, sf))
    wide = F.when(F.col("priority") == "high", 8000).otherwise(F.col("radius_m"))
    return _found(places(spark, sf), policy.withColumn("radius_m", wide))


@query("f8_radius_filter_quadtree", _radius_sql("case c.priority when 'high' then 8000 when 'medium' then 3000 else 900 end"))
def f8_quadtree(spark, sf):
    """Circles of very different size over cells that follow the density of the places."""
    radius = F.when(F.col("priority") == "high", 8000).when(F.col("priority") == "medium", 3000).otherwise(900)
    wide = centres(spark, sf).withColumn("radius_m", radius).drop("priority")
    return _found(places(spark, sf), wide, search=quadtree.places_around)


# Reports

@query(
    "a1_quality_metrics",
    S.over_raw(
        """, listed AS (SELECT name, rating, price_level, categories, data_source FROM raw),
           copies AS (SELECT *, count(*) AS n FROM listed GROUP BY ALL)
           SELECT 'total_records' AS metric, cast(null as varchar) AS "column", cast(count(*) as varchar) AS value FROM listed
           UNION ALL SELECT 'total_columns', null, '5'
           UNION ALL SELECT 'duplicate_records', null, cast(sum(n - 1) as varchar) FROM copies
           UNION ALL SELECT 'missing_values', 'data_source', cast(count(*) FILTER (data_source IS NULL) as varchar) FROM listed
           UNION ALL SELECT 'missing_values', 'name', cast(count(*) FILTER (name IS NULL) as varchar) FROM listed
           UNION ALL SELECT 'missing_values', 'rating', cast(count(*) FILTER (rating IS NULL) as varchar) FROM listed
           UNION ALL SELECT 'missing_values', 'price_level', cast(count(*) FILTER (price_level IS NULL) as varchar) FROM listed
           UNION ALL SELECT 'missing_values', 'categories', cast(count(*) FILTER (categories IS NULL) as varchar) FROM listed
           UNION ALL SELECT * FROM (VALUES ('data_type', 'data_source', 'string'), ('data_type', 'name', 'string'),
             ('data_type', 'rating', 'double'), ('data_type', 'price_level', 'int'),
             ('data_type', 'categories', 'string')) AS v"""
    ),
)
def a1(spark, sf):
    return quality.quality_metrics(
        raw_listings(spark, sf).select("name", "rating", "price_level", "categories", "data_source")
    )


@query(
    "a1_quality_metrics_all_columns",
    S.over_raw(
        ", twice AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE row_key % 10 = 0), "
        "copies AS (SELECT *, count(*) AS n FROM twice GROUP BY ALL) "
        "SELECT 'total_records' AS metric, cast(null as varchar) AS \"column\", cast(count(*) as varchar) AS value FROM twice "
        f"UNION ALL SELECT 'total_columns', null, '{len(LISTING)}' "
        "UNION ALL SELECT 'duplicate_records', null, cast(sum(n - 1) as varchar) FROM copies "
        + " ".join(
            f"UNION ALL SELECT 'missing_values', '{c}', cast(count(*) FILTER ({c} IS NULL) as varchar) FROM twice"
            for c in LISTING
        )
    ),
)
def a1_all(spark, sf):
    """All columns, with every tenth listing twice; the types are checked by the smaller query."""
    listings = raw_listings(spark, sf)
    return quality.quality_metrics(listings.unionByName(listings.where("row_key % 10 = 0"))).where("metric <> 'data_type'")


@query(
    "a2_duplicate_count",
    S.over_raw(
        """SELECT cast(coalesce(sum(n - 1), 0) as bigint) AS duplicate_records FROM (
             SELECT count(*) AS n FROM raw GROUP BY data_source, price_level, rating, categories) AS c"""
    ),
)
def a2(spark, sf):
    return quality.duplicate_count(raw_listings(spark, sf).select("data_source", "price_level", "rating", "categories"))


@query(
    "a5_kpis",
    S.over_cleaned(
        f"""SELECT count(*) FILTER ({CHOICE_SQL}) AS total,
              count(*) FILTER ({CHOICE_SQL}) - count(*) AS total_delta,
              round(avg(rating) FILTER ({CHOICE_SQL}), 6) AS avg_rating,
              round(avg(rating) FILTER ({CHOICE_SQL}) - avg(rating), 6) AS avg_rating_delta,
              cast(coalesce(sum(review_count) FILTER ({CHOICE_SQL}), 0) as bigint) AS total_reviews,
              cast(coalesce(sum(review_count) FILTER ({CHOICE_SQL}), 0) - sum(review_count) as bigint) AS total_reviews_delta,
              max(rating) FILTER ({CHOICE_SQL}) AS max_rating,
              max(rating) FILTER ({CHOICE_SQL}) - max(rating) AS max_rating_delta
            FROM cleaned"""
    ),
)
def a5(spark, sf):
    numbers = stats.kpis(rated(spark, sf), filters.listing_predicate(**CHOICE))
    return numbers.withColumns({c: F.round(c, 6) for c in ("avg_rating", "avg_rating_delta")})


def _mean_sql(by: str) -> str:
    return S.over_cleaned(f"SELECT {by}, round(avg(rating), 6) AS avg_rating FROM cleaned GROUP BY {by}")


def _means(by: str):
    def build(spark, sf):
        return stats.avg_rating_by(rated(spark, sf), by).withColumn("avg_rating", F.round("avg_rating", 6))

    return build


def _count_sql(by: str) -> str:
    return S.over_cleaned(f'SELECT {by}, count(*) AS "count" FROM cleaned GROUP BY {by}')


def _counts(by: str):
    def build(spark, sf):
        return stats.value_counts(rated(spark, sf), by)

    return build


for number, column in ((6, "city"), (7, "price_category"), (8, "data_source")):
    query(f"a{number}_avg_rating_by_{column}", _mean_sql(column))(_means(column))
for number, column in ((9, "price_category"), (10, "data_source"), (11, "business_tier")):
    query(f"a{number}_value_counts_{column}", _count_sql(column))(_counts(column))


@query(
    "a12_histogram",
    S.over_cleaned(
        """SELECT cast(i as int) AS bin, 5e0 * i / 20 AS bin_start, count(rating) AS "count"
           FROM range(20) AS r(i) LEFT JOIN cleaned
             ON rating >= 5e0 * i / 20 AND (rating < 5e0 * (i + 1) / 20 OR (i = 19 AND rating <= 5)) GROUP BY i"""
    ),
)
def a12(spark, sf):
    return stats.histogram(rated(spark, sf), lo=0.0, hi=5.0)


@query(
    "a12_histogram_tenths",
    """SELECT cast(i as int) AS bin, 1e0 * i / 10 AS bin_start, count(v) AS "count"
       FROM range(10) AS r(i) LEFT JOIN (SELECT (o_orderkey % 13) / 10e0 AS v FROM orders WHERE o_orderkey % 13 <> 4) AS o
         ON v >= 1e0 * i / 10 AND (v < 1e0 * (i + 1) / 10 OR (i = 9 AND v <= 1)) GROUP BY i""",
)
def a12_tenths(spark, sf):
    """Edges that have no exact binary form, an empty bin and values beyond the last."""
    tenths = table_of(spark, sf, "orders").where("o_orderkey % 13 <> 4").selectExpr("(o_orderkey % 13) / 10e0 AS v")
    return stats.histogram(tenths, "v", 10, 0.0, 1.0)


@query(
    "a12_histogram_own_range",
    S.over_raw(
        """, edges AS (SELECT min(rating) AS lo, max(rating) AS hi FROM raw)
           SELECT cast(i as int) AS bin, lo + (hi - lo) * i / 4 AS bin_start, count(rating) AS "count"
           FROM range(4) AS r(i) CROSS JOIN edges LEFT JOIN raw
             ON rating >= lo + (hi - lo) * i / 4 AND (i = 3 OR rating < lo + (hi - lo) * (i + 1) / 4) GROUP BY i, lo, hi"""
    ),
)
def a12_own(spark, sf):
    return stats.histogram(raw_listings(spark, sf), "rating", 4)


@query(
    "a13_city_stats",
    S.over_cleaned(
        """SELECT city, round(avg(rating), 6) AS avg_rating,
             cast(sum(user_ratings_total) as bigint) AS sum_user_ratings_total FROM cleaned GROUP BY city"""
    ),
)
def a13(spark, sf):
    return stats.city_stats(cleaned_raw(spark, sf)).withColumn("avg_rating", F.round("avg_rating", 6))


@query(
    "a14_price_stats",
    S.over_cleaned(
        """SELECT price_level, round(avg(rating), 6) AS avg_rating,
             count(user_ratings_total) AS count_user_ratings_total FROM cleaned GROUP BY price_level"""
    ),
)
def a14(spark, sf):
    return stats.price_stats(cleaned_raw(spark, sf)).withColumn("avg_rating", F.round("avg_rating", 6))


@query("a15_distinct_values", S.over_raw("SELECT DISTINCT formatted_address FROM raw"))
def a15(spark, sf):
    return stats.distinct_values(raw_listings(spark, sf), "formatted_address")


# Data tests

LISTED = ("row_key", "id", "name", "rating", "data_source", "ingestion_timestamp")


def tested(spark, sf):
    return raw_listings(spark, sf).select(*LISTED)


def _not_null(column: str):
    def build(spark, sf):
        return quality.test_not_null(tested(spark, sf), column)

    return build


for column in ("id", "name", "rating", "data_source", "ingestion_timestamp"):
    query(
        f"d_nn_test_not_null_{column}", S.over_raw(f"SELECT {', '.join(LISTED)} FROM raw WHERE {column} IS NULL")
    )(_not_null(column))


@query(
    "d_uq_test_unique",
    S.over_raw('SELECT name, count(*) AS "count" FROM raw WHERE name IS NOT NULL GROUP BY name HAVING count(*) > 1'),
)
def d_uq(spark, sf):
    return quality.test_unique(tested(spark, sf), "name")


@query("d_uq_test_unique_id", S.over_raw('SELECT id, count(*) AS "count" FROM raw WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1'))
def d_uq_id(spark, sf):
    return quality.test_unique(tested(spark, sf), "id")


@query(
    "d_rg_test_accepted_range",
    S.over_raw(f"SELECT {', '.join(LISTED)} FROM raw WHERE rating NOT BETWEEN 0 AND 5"),
)
def d_rg(spark, sf):
    return quality.test_accepted_range(tested(spark, sf), "rating", 0, 5)


@query(
    "d_av_test_accepted_values",
    S.over_raw(
        """SELECT data_source, count(*) AS "count" FROM raw
           WHERE data_source NOT IN ('yelp', 'google_places') GROUP BY data_source"""
    ),
)
def d_av(spark, sf):
    return quality.test_accepted_values(tested(spark, sf), "data_source", ["yelp", "google_places"])


@query(
    "d_test_summary",
    S.over_raw(
        """SELECT 'not_null' AS test, 'id' AS "column", count(*) FILTER (id IS NULL) AS failures FROM raw
           UNION ALL SELECT 'not_null', 'name', count(*) FILTER (name IS NULL) FROM raw
           UNION ALL SELECT 'accepted_range', 'rating', count(*) FILTER (rating NOT BETWEEN 0 AND 5) FROM raw"""
    ),
)
def d_summary(spark, sf):
    return quality.test_summary(tested(spark, sf), ["id", "name"], {"rating": (0, 5)})


FAILING = {
    **{f"not_null_{c}": f"raw WHERE {c} IS NULL" for c in LISTED if c != "row_key"},
    "accepted_range_rating": "raw WHERE rating NOT BETWEEN 0 AND 5",
    "unique_id": "(SELECT id FROM raw WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1) AS u",
    "accepted_values_data_source": (
        "(SELECT DISTINCT data_source FROM raw WHERE data_source NOT IN ('yelp', 'google_places')) AS v"
    ),
}


@query(
    "e3_stored_test_failures",
    S.over_raw(" UNION ALL ".join(f"SELECT '{t}' AS test, count(*) AS failures FROM {rows}" for t, rows in FAILING.items())),
)
def e3_tests(spark, sf):
    stored = warehouse.run_tests(tested(spark, sf), fresh_path(spark, "e3-tests"))
    counts = [t.agg(F.count("*").alias("failures")).select(F.lit(n).alias("test"), "failures") for n, t in stored.items()]
    return reduce(DataFrame.unionByName, counts)


MEASURES = {
    "rows": "count(*)",
    **{f"missing_{c}": f"count(*) FILTER ({c} IS NULL)" for c in LISTED},
    **{f"not_null_{c}": f"count(*) FILTER ({c} IS NULL)" for c in LISTED if c != "row_key"},
    "accepted_range_rating": "count(*) FILTER (rating NOT BETWEEN 0 AND 5)",
}


@query(
    "a1_load_measures",
    S.over_raw(" UNION ALL ".join(f"SELECT '{m}' AS measure, {n} AS value FROM raw" for m, n in MEASURES.items())),
)
def a1_load(spark, sf):
    """Counted by the job that writes the table; nothing is read again."""
    return warehouse.load_tested(tested(spark, sf), "a1_loaded", fresh_path(spark, "a1-load"))


# Ranking

@query(
    "w1_global_row_number",
    S.over_raw("SELECT row_key, row_number() OVER (ORDER BY ingestion_timestamp, row_key) AS row_number FROM raw"),
)
def w1(spark, sf):
    narrow = raw_listings(spark, sf).select("ingestion_timestamp", "row_key")
    return ranking.global_row_number(narrow, ["ingestion_timestamp", "row_key"]).select("row_key", "row_number")


@query(
    "w2_top_per_location",
    S.over_raw(
        """SELECT area, row_key, rating, cast(rank as int) AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY area ORDER BY rating DESC NULLS LAST, row_key) AS rank FROM raw
           ) AS r WHERE rank <= 50"""
    ),
)
def w2(spark, sf):
    return ranking.top_per_location(raw_listings(spark, sf), 50, "area").select("area", "row_key", "rating", "rank")


@query(
    "o1_serving_top",
    S.over_cleaned(
        """SELECT row_key AS place_id, restaurant_name AS name, rating, review_count FROM cleaned
           ORDER BY rating DESC NULLS LAST, review_count DESC, row_key LIMIT 500"""
    ),
)
def o1(spark, sf):
    keyed = models.serving_projection(rated(spark, sf), "row_key")
    return ranking.serving_top(keyed, 500).select("place_id", "name", "rating", "review_count")


@query(
    "o2_top_rated",
    S.over_cleaned(
        """SELECT restaurant_name AS name, rating, city, review_count FROM cleaned
           ORDER BY rating DESC NULLS LAST, row_key LIMIT 10"""
    ),
)
def o2(spark, sf):
    return ranking.top_rated(models.serving_projection(rated(spark, sf), "row_key"), 10)


# Sinks: each writes and reads back

KEPT = ("row_key", "name", "rating", "data_source")


@query("k1_write_overwrite", S.over_raw(f"SELECT {', '.join(KEPT)} FROM raw"))
def k1(spark, sf):
    listings = raw_listings(spark, sf).select(*KEPT)
    return tables.write_overwrite(listings, "k1_listings", fresh_path(spark, "k1"))


@query("k3_save_stats", S.over_cleaned("SELECT price_category, count(*) AS \"count\" FROM cleaned GROUP BY 1"))
def k3(spark, sf):
    counts = stats.value_counts(rated(spark, sf), "price_category")
    return tables.save_stats(counts, "k3_price_statistics", fresh_path(spark, "k3"))


@query("k4_materialize_view", S.over_cleaned("SELECT row_key, restaurant_name, rating_category FROM cleaned"))
def k4(spark, sf):
    tables.materialize_view(models.clean_listings(raw_listings(spark, sf), at()), "k4_staging")
    return spark.sql("SELECT row_key, restaurant_name, rating_category FROM k4_staging")


@query(
    "k5_materialize_clustered",
    S.over_cleaned("SELECT row_key, city, state, rating, business_tier FROM cleaned"),
)
def k5(spark, sf):
    listings = rated(spark, sf).select("row_key", "city", "state", "rating", "business_tier")
    return tables.materialize_clustered(listings, "k5_dimension", spread="row_key", path=fresh_path(spark, "k5"))


def bucketed(spark, sf):
    listings = rated(spark, sf).select("row_key", "city", "state", "rating", "price_level", "review_count")
    return tables.materialize_bucketed(listings, "k5_bucketed", spread="row_key", path=fresh_path(spark, "k5-bucketed"))


@query(
    "k5_materialize_bucketed",
    S.over_cleaned("SELECT row_key, city, state, rating, price_level, review_count FROM cleaned"),
)
def k5_bucketed(spark, sf):
    return bucketed(spark, sf)


@query(
    "a6_avg_rating_by_city_bucketed",
    S.over_cleaned("SELECT city, round(avg(rating), 6) AS avg_rating FROM cleaned WHERE city IS NOT NULL GROUP BY city"),
)
def a6_bucketed(spark, sf):
    """Grouped where the rows lie: the table's buckets are the groups' tasks."""
    return stats.avg_rating_by(bucketed(spark, sf), "city").withColumn("avg_rating", F.round("avg_rating", 6))


@query("k6_store_failures", S.over_raw(f"SELECT {', '.join(LISTED)} FROM raw WHERE rating NOT BETWEEN 0 AND 5"))
def k6(spark, sf):
    failing = quality.test_accepted_range(tested(spark, sf), "rating", 0, 5)
    return tables.store_failures(failing, "rating_range", fresh_path(spark, "k6"))


@query(
    "k7_encode_payload",
    S.over_raw(
        """SELECT cast(row_key as varchar) AS key, concat('{"name":"', coalesce(name, 'none'), '","rating":',
             cast(coalesce(rating, 0.0) as varchar), ',"data_source":"', data_source, '"}') AS value FROM raw"""
    ),
)
def k7(spark, sf):
    listings = raw_listings(spark, sf).select(*KEPT).fillna({"name": "none", "rating": 0.0})
    return tables.encode_payload(listings, key="row_key")


# Features

@query(
    "l1_assemble_features",
    S.over_raw(
        """SELECT row_key, rating AS f0, cast(price_level as double) AS f1, cast(user_ratings_total as double) AS f2,
             try_cast(latitude as double) AS f3, try_cast(longitude as double) AS f4
           FROM raw WHERE rating IS NOT NULL AND price_level IS NOT NULL AND user_ratings_total IS NOT NULL
             AND try_cast(latitude as double) IS NOT NULL AND try_cast(longitude as double) IS NOT NULL"""
    ),
)
def l1(spark, sf):
    assembled = features.assemble_features(numeric(spark, sf)).withColumn("f", vector_to_array("features"))
    return assembled.select("row_key", *[F.col("f")[i].alias(f"f{i}") for i in range(len(features.FEATURES))])


def numeric(spark, sf):
    listings = raw_listings(spark, sf)
    return listings.withColumns({c: F.col(c).try_cast("double") for c in ("latitude", "longitude")})


@query(
    "l2_train_rating_model",
    S.over_raw(
        """SELECT row_key, rating, true AS in_range FROM raw
           WHERE price_level IS NOT NULL AND user_ratings_total IS NOT NULL
             AND try_cast(latitude as double) IS NOT NULL AND try_cast(longitude as double) IS NOT NULL"""
    ),
)
def l2(spark, sf):
    """Rows the model scores: those with every input; a forest's answers lie between the labels it saw."""
    listings = numeric(spark, sf)
    model = features.train_rating_model(listings)
    seen = listings.agg(F.min("rating").alias("lo"), F.max("rating").alias("hi")).first()
    in_range = F.col("prediction").between(seen["lo"], seen["hi"]).alias("in_range")
    return model.transform(listings).select("row_key", "rating", in_range)


@query("l2_holdout_predictions")
def l2_holdout(spark, sf):
    """Predictions for the rated rows that the model was not fitted on."""
    return features.holdout_predictions(numeric(spark, sf))


@query(
    "h1_partition_and_cache",
    S.over_cleaned(
        """SELECT 'city' AS report, city AS "group", count(*) AS "count" FROM cleaned GROUP BY city
           UNION ALL SELECT 'state', state, count(*) FROM cleaned GROUP BY state"""
    ),
)
def h1(spark, sf):
    cached = features.partition_and_cache(cleaned_raw(spark, sf).select("row_key", "city", "state"))

    def count(by):
        return cached.groupBy(F.lit(by).alias("report"), F.col(by).alias("group")).agg(F.count("*").alias("count"))

    return count("city").unionByName(count("state"))


@query(
    "e4_serving_detail_of_top",
    S.over_cleaned(
        f"""SELECT name, {STAR_RATING} AS star_rating, city, price_category, review_count, business_tier, data_source
            FROM (SELECT *, restaurant_name AS name FROM cleaned
                  ORDER BY rating DESC NULLS LAST, review_count DESC, row_key LIMIT 500) AS t"""
    ),
)
def serving_limit(spark, sf):
    """The detail view over the 500 rows the serving reports fetch."""
    return models.detail_projection(ranking.serving_top(models.serving_projection(rated(spark, sf), "row_key"), 500))


@query(
    "e4_kpis_of_top",
    S.over_cleaned(
        f""", top AS (SELECT * FROM cleaned ORDER BY rating DESC NULLS LAST, review_count DESC, row_key LIMIT 500)
            SELECT count(*) FILTER ({CHOICE_SQL}) AS total, count(*) FILTER ({CHOICE_SQL}) - count(*) AS total_delta,
              round(avg(rating) FILTER ({CHOICE_SQL}), 6) AS avg_rating,
              cast(coalesce(sum(review_count) FILTER ({CHOICE_SQL}), 0) as bigint) AS total_reviews,
              max(rating) FILTER ({CHOICE_SQL}) AS max_rating
            FROM top"""
    ),
)
def kpis_of_top(spark, sf):
    """Headline numbers over the 500 rows the serving reports fetch."""
    top = ranking.serving_top(models.serving_projection(rated(spark, sf), "row_key"), 500)
    numbers = stats.kpis(top, filters.listing_predicate(**CHOICE))
    mean = F.round("avg_rating", 6).alias("avg_rating")
    return numbers.select("total", "total_delta", mean, "total_reviews", "max_rating")


@query("e3_build_models", S.over_cleaned(f"SELECT {', '.join(DIMENSION_COLUMNS)} FROM cleaned"))
def e3(spark, sf):
    return warehouse.build_models(
        canonical_listings(spark, sf), S.RUN_ID, "e3_staging", "e3_dimension", fresh_path(spark, "e3"), S.AS_OF, at(),
        "row_key",
    )
