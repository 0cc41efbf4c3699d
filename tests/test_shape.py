"""Flattening and canonical columns."""

import json

import pytest
from pyspark.sql import functions as F

from placemat.operators import combine, filters, quality, ranking, shape, stats
from placemat.plans import models
from placemat.schema import DIMENSION_COLUMNS, LISTING_SCHEMA, STAGING_COLUMNS
from registry.inputs import at, canonical_listings, table_of


def test_nested_fields_are_joined_with_the_separator(spark):
    frame = spark.sql(
        "select 'Test Restaurant' name, 4.5D rating, named_struct('city', 'San Francisco', 'state', 'CA') location"
    )
    assert shape.flatten_json(frame).columns == ["name", "rating", "location_city", "location_state"]
    assert "location.city" in shape.flatten_json(frame, ".").columns


def test_arrays_become_text(spark):
    frame = spark.sql("select 'x' name, array('Italian', 'Pizza', 'Dinner') categories")
    assert shape.flatten_json(frame).first()["categories"] == '["Italian", "Pizza", "Dinner"]'


def test_four_levels(spark):
    frame = spark.sql("select named_struct('info', named_struct('basic', named_struct('name', 'Deep'))) restaurant")
    flat = shape.flatten_json(frame)
    assert flat.columns == ["restaurant_info_basic_name"] and flat.first()[0] == "Deep"


def test_later_path_wins(spark):
    frame = spark.sql("select 1 a_b, named_struct('b', 2) a")
    assert [tuple(r) for r in shape.flatten_json(frame).collect()] == [(2,)]
    swapped = spark.sql("select named_struct('b', 2) a, 1 a_b")
    assert [tuple(r) for r in shape.flatten_json(swapped).collect()] == [(1,)]


def test_whole_texts_survive_flattening(spark, small):
    turns = table_of(spark, small, "conversations").select(F.array("text").alias("texts"), "text")
    for row in shape.flatten_json(turns).collect():
        assert row.texts == json.dumps([row.text])


@pytest.mark.parametrize(
    ("columns", "expected"),
    [
        ("'  a ' name, 'b' restaurant_name", "a"),
        ("'b' restaurant_name, 'c' business_name", "b"),
        ("'c' business_name", "c"),
        ("1 other", "Unknown Restaurant"),
    ],
)
def test_name_fallbacks(spark, columns, expected):
    assert shape.standardize_name(spark.sql(f"select {columns}")).first()["restaurant_name"] == expected


def test_canonicalize_fills_absent_columns(spark):
    row = shape.canonicalize(spark.sql("select 'x' name")).first().asDict()
    assert row == {
        "id": None, "restaurant_name": "x", "rating": 0.0, "data_source": "unknown", "city": "Unknown",
        "state": "Unknown", "formatted_address": None, "price_level": 0, "review_count": 0, "latitude": 0.0,
        "longitude": 0.0, "categories": "[]", "ingestion_timestamp": None,
    }


def test_models_have_the_fixed_columns(spark, small):
    staging = models.staging_listings(canonical_listings(spark, small), at(), "row_key")
    assert tuple(staging.columns) == STAGING_COLUMNS
    assert tuple(models.dim_listings(staging, "r", "2001-08-01", at()).columns) == DIMENSION_COLUMNS


def test_ids_without_a_key(spark):
    rows = [(None, "b", 2), ("x", "a", 1), (None, "c", 2), (None, "c", 2), (None, "d", 3)]
    frame = spark.createDataFrame(rows, "id string, name string, ingestion_timestamp int")
    found = sorted((r.name, r.restaurant_id) for r in ranking.surrogate_id(frame).collect())
    assert found == [("a", "x"), ("b", "unknown_2"), ("c", "unknown_3"), ("c", "unknown_4"), ("d", "unknown_5")]
    given = frame.where("id is not null")
    assert ranking.surrogate_id(given).first().restaurant_id == "x"


def test_sample_record(spark):
    sample = spark.sql(
        """select 'Joe''s Pizza' name, 4.5D rating, '123 Main St, New York, NY' formatted_address, 2 price_level,
             150 user_ratings_total, 40.7128D latitude, -74.0060D longitude, 'yelp' data_source"""
    )
    row = models.enrich_listings(sample).first()
    assert (row.rating_category, row.price_category, row.business_tier) == ("Excellent", "$$", "Premium")
    assert (row.city, row.state) == ("123 Main St", "NY")


def test_valid_listings(spark):
    rows = [("Restaurant 1", 4.5), ("Restaurant 2", 3.8), (None, 4.0), ("Restaurant 4", 6.0)]
    frame = spark.createDataFrame([*rows, ("nan", float("nan")), ("null", None)], "name string, rating double")
    assert filters.valid_listings(frame).count() == 2


def test_kpis_of_an_empty_choice(spark):
    frame = spark.createDataFrame([(4.0, 10), (None, None), (5.0, 1)], "rating double, review_count int")
    assert tuple(stats.kpis(frame, F.lit(False)).first()) == (0, -3, None, None, 0, -11, None, None)
    assert tuple(stats.kpis(frame, F.col("rating") > 4).first()) == (1, -2, 5.0, 0.5, 1, -10, 5.0, 0.0)


def test_histogram_bounds(spark):
    frame = spark.createDataFrame([(r,) for r in (0.0, 0.24, 0.25, 4.75, 5.0, 5.1, None)], "rating double")
    counted = {r.bin: r["count"] for r in stats.histogram(frame, lo=0.0, hi=5.0).collect()}
    assert len(counted) == 20 and {b: n for b, n in counted.items() if n} == {0: 2, 1: 1, 19: 2}


def test_run_summary_lists_feeds_that_delivered(spark):
    frame = spark.createDataFrame([("Yelp", "a"), ("yelp", "b"), ("other", "b")], "data_source string, search_location string")
    assert tuple(stats.run_summary(frame).first()) == (3, 2, ["yelp"], 1)


def test_empty_term_keeps_all(spark):
    frame = spark.createDataFrame([("Zoë",), (None,)], "name string")
    assert filters.search_name(frame).count() == 2
    assert filters.search_name(frame, "ZOË").count() == 1
    assert filters.search_name(frame, "^z..$").count() == 1


def test_unions(spark):
    a, b = spark.sql("select 1 x, 'a' y"), spark.sql("select 'a' y, 1 x")
    with pytest.raises(ValueError):
        combine.union_positional([a, b])
    assert combine.combine_sources(spark, [a, b.drop("x")]).count() == 2
    empty = combine.combine_sources(spark, [])
    assert empty.schema == LISTING_SCHEMA and empty.count() == 0


def test_quality_of_nothing(spark):
    empty = spark.createDataFrame([], "name string, rating double, data_source string")
    assert [tuple(r) for r in quality.quality_metrics(empty).collect()] == [("status", None, "error")]


def test_quality_counts(spark):
    rows = [("a", 1.0), ("a", 1.0), ("a", 1.0), (None, None), (None, None), ("b", None)]
    frame = spark.createDataFrame(rows, "name string, rating double")
    report = {(r.metric, r.column): r.value for r in quality.quality_metrics(frame).collect()}
    assert report["total_records", None] == "6" and report["total_columns", None] == "2"
    assert report["duplicate_records", None] == "3"
    assert report["missing_values", "name"] == "2" and report["missing_values", "rating"] == "3"
    assert ("missing_required_column", "data_source") in report


def test_required_columns(spark):
    frame = spark.sql("select 1 name")
    assert [r[0] for r in quality.test_required_columns(frame).collect()] == ["rating", "data_source"]
