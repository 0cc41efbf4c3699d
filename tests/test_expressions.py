"""Boundary rows of the cleaning and classifying expressions, worked out by hand."""

import datetime
import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemat.functions import clean, derive
from placemat.functions.jsontext import json_text

RATINGS = [-0.5, 0.0, 2.9, 3.0, 3.4, 3.5, 3.9, 4.0, 4.4, 4.5, 5.0, 5.7, None, float("nan")]


def column(spark, values, dtype, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[1] for r in frame.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


def test_clamp_rating(spark):
    got = column(spark, RATINGS, "double", clean.clamp_rating)
    assert got == [0.0, 0.0, 2.9, 3.0, 3.4, 3.5, 3.9, 4.0, 4.4, 4.5, 5.0, 5.0, None, None]


def test_clamp_rating_filled(spark):
    got = column(spark, ["4.2", "x", None, "9", "-1", "NaN"], "string", clean.clamp_rating_filled)
    assert got == [4.2, 0.0, 0.0, 5.0, 0.0, 0.0]


def test_rating_category(spark):
    got = column(spark, RATINGS[:-1], "double", derive.rating_category)
    low, avg, good, very, top = "Below Average", "Average", "Good", "Very Good", "Excellent"
    assert got == [low, low, low, avg, avg, good, good, very, very, top, top, top, low]


def test_rating_category_binned(spark):
    got = column(spark, [0.0, 0.1, 3.0, 3.5, 4.0, 4.5, 5.0, 5.1, None], "double", derive.rating_category_binned)
    assert got == [None, "Below Average", "Below Average", "Average", "Good", "Very Good", "Excellent", None, None]


def test_price_category(spark):
    levels = [0, 1, 2, 3, 4, 5, None]
    assert column(spark, levels, "int", derive.price_category) == ["Unknown", "$", "$$", "$$$", "$$$$", "Unknown", "Unknown"]
    mapped = column(spark, levels, "int", lambda c: derive.price_category(c, None))
    assert mapped == [None, "$", "$$", "$$$", "$$$$", None, None]


@pytest.mark.parametrize(
    ("rating", "reviews", "tier", "sequential"),
    [
        (4.5, 100, "Premium", "Good Quality"),
        (4.5, 99, "High Quality", "Good Quality"),
        (4.0, 50, "High Quality", "Good Quality"),
        (4.0, 49, "Good Quality", "Good Quality"),
        (3.5, 0, "Good Quality", "Good Quality"),
        (3.4, 500, "Standard", "Standard"),
        (3.0, 0, "Standard", "Standard"),
        (2.9, 500, "Needs Improvement", "Needs Improvement"),
        (None, 500, "Needs Improvement", "Standard"),
        (4.6, None, "Good Quality", "Good Quality"),
    ],
)
def test_business_tier(spark, rating, reviews, tier, sequential):
    frame = spark.createDataFrame([(rating, reviews)], "r double, n int")
    row = frame.select(
        derive.business_tier(F.col("r"), F.col("n")), derive.business_tier_sequential(F.col("r"), F.col("n"))
    ).first()
    assert tuple(row) == (tier, sequential)


def test_review_volume(spark):
    counts = [0, 9, 10, 49, 50, 99, 100, None]
    got = [v.removesuffix(" Volume") for v in column(spark, counts, "int", derive.review_volume)]
    assert got == ["Very Low", "Very Low", "Low", "Low", "Medium", "Medium", "High", "Very Low"]


def test_review_volume_binned(spark):
    counts = [-1, 0, 1, 10, 11, 50, 51, 200, 201, None]
    got = [v and v.removesuffix(" Volume") for v in column(spark, counts, "int", derive.review_volume_binned)]
    assert got == [None, None, "Very Low", "Very Low", "Low", "Low", "Medium", "Medium", "High", None]


def test_address(spark):
    addresses = [
        "123 Main St, New York, NY",
        "1 A St, Suite 4, Chicago, IL 60601, USA",
        "no address",
        "",
        None,
        "5 B St, Paris, France",
    ]
    assert column(spark, addresses, "string", clean.city_of) == ["123 Main St", " Suite 4", *["Unknown"] * 4]
    towns = column(spark, addresses, "string", lambda c: clean.city_of(c, 2))
    assert towns == ["New York", "Chicago", *["Unknown"] * 4]
    assert column(spark, addresses, "string", clean.state_of) == ["NY", "IL", *["Unknown"] * 4]


def test_whole_number(spark):
    got = column(spark, ["3", "4.7", "-2.9", "x", "", None, "PRICE_LEVEL_MODERATE", "NaN"], "string", clean.whole_number)
    assert got == [3, 4, -2, 0, 0, 0, 0, 0]


def test_coordinate(spark):
    texts = ["1.5", "bad", None]
    assert column(spark, texts, "string", clean.clean_coordinate) == [1.5, None, None]
    assert column(spark, texts, "string", lambda c: clean.clean_coordinate(c, 0)) == [1.5, 0.0, 0.0]


def test_event_time(spark):
    texts = ["1704067200", "1704067200.5", "2024-01-01T00:00:00", "2024-01-01 00:00:01", "junk", None]
    got = column(spark, texts, "string", lambda c: clean.event_time(c).cast("string"))
    day = "2024-01-01 00:00:0"
    assert got == [f"{day}0", f"{day}0.5", f"{day}0", f"{day}1", None, None]


def test_freshness(spark):
    days = [datetime.date(2024, 2, 1) - datetime.timedelta(n) for n in (-3, 0, 1, 2, 7, 8, 30, 31)] + [None]
    got = column(spark, days, "date", lambda c: derive.data_freshness(c, "2024-02-01"))
    assert got == ["Very Fresh"] * 3 + ["Fresh"] * 2 + ["Recent"] * 2 + ["Stale"] * 2


def test_full_location(spark):
    frame = spark.createDataFrame([("A", None), (None, "B")], "c string, s string")
    rows = frame.select(derive.full_location(F.col("c"), F.col("s"))).collect()
    assert [r[0] for r in rows] == ["A, Unknown", "Unknown, B"]


def stars(rating):
    if rating is None or math.isnan(rating):
        return "No rating"
    whole = int(rating)
    half = int(rating - whole >= 0.5)
    return "⭐" * (whole + half) + "☆" * (5 - whole - half) + f" ({rating:.1f})"


def test_star_rating(spark):
    ratings = [0.0, 0.25, 0.49, 0.5, 1.0, 2.5, 3.75, 4.4, 4.5, 4.95, 5.0, None, float("nan")]
    assert column(spark, ratings, "double", derive.star_rating) == [stars(r) for r in ratings]
    assert column(spark, [3.4, 3.5], "double", derive.star_rating_compact) == ["⭐" * 3, "⭐" * 4]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    some.lists(
        some.none() | some.text(some.characters(min_codepoint=32, exclude_categories=["Cs"], exclude_characters="\x7f")),
        max_size=6,
    )
)
def test_json_text_of_any_strings(spark, texts):
    got = column(spark, [texts], "array<string>", lambda c: json_text(c, T.ArrayType(T.StringType())))
    assert got == [json.dumps(texts)]


def test_json_text_of_control_characters(spark):
    texts = ["a\n", "\n", "tab\tend\r\n", "\b\f", "back\\slash", '"', "é\n", "😀", ""]
    got = column(spark, [texts], "array<string>", lambda c: json_text(c, T.ArrayType(T.StringType())))
    assert got == [json.dumps(texts)]


def test_json_text_of_structs(spark):
    dtype = T.ArrayType(T.StructType.fromDDL("alias string, n int, ok boolean, in_ struct<x:double>"))
    value = [{"alias": 'a"b\n', "n": 1, "ok": True, "in_": {"x": 1.5}}, {"alias": None, "n": None, "ok": False, "in_": None}, None]
    frame = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", dtype)]))
    assert frame.select(json_text(F.col("v"), dtype)).first()[0] == json.dumps(value)
