"""Skewed input, plans and brute-force comparisons."""

import bisect
import math
import random
from functools import partial

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from placemat import scratch
from placemat.operators import geo, history, lookup, quadtree, quality, ranking
from placemat.operators import locations as loc
from placemat.plans import models, warehouse
from __spark_entry__ import QUERIES


def skewed(spark, n=3000):
    """A third of all rows share one key, and a third of those one instant."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40 + 1)
    ts = F.when(F.col("id") % 9 == 0, 7).otherwise((F.col("id") * 7919) % 1000)
    return spark.range(n).select(
        F.col("id").alias("row_key"), key.alias("k"), ts.alias("ts"), (F.col("id") % 11).cast("double").alias("rating")
    )


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_row_number_equals_window(spark, parts):
    frame = skewed(spark)
    got = ranking.global_row_number(frame, ["ts", "row_key"], "n", parts)
    want = frame.withColumn("n", F.row_number().over(Window.orderBy("ts", "row_key")))
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == frame.count()


@pytest.mark.parametrize("parts", [1, 5, 64])
@pytest.mark.parametrize("ahead", [False, True])
def test_neighbour_equals_window(spark, parts, ahead):
    frame = skewed(spark)
    got = history.with_neighbour(frame, "k", ["ts", "row_key"], ["rating"], "near", ahead, parts)
    step = F.lead if ahead else F.lag
    want = frame.withColumn("near", step(F.struct("rating")).over(Window.partitionBy("k").orderBy("ts", "row_key")))
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == frame.count()


def test_hot_key_spreads_over_parts(spark):
    laid_out = ranking.range_parts(skewed(spark), ["k", "ts", "row_key"], 16)
    largest = laid_out.groupBy(ranking.PART).count().agg(F.max("count")).first()[0]
    assert largest < 3000 / 16 * 3


def test_duplicates_with_a_hot_group(spark):
    copies = spark.range(1000).select(F.lit("same").alias("a"), F.lit(None).cast("int").alias("b"))
    others = spark.range(500).select(F.col("id").cast("string").alias("a"), F.lit(1).alias("b"))
    frame = copies.unionByName(others).unionByName(others.limit(10))
    assert quality.duplicate_count(frame).first()[0] == 999 + 10


def test_equal_hash_is_not_equal_row(spark):
    # Nulls leave the hash as it is, so these rows share one without being equal.
    frame = spark.createDataFrame([("x", None), (None, "x"), ("x", None)], "a string, b string")
    assert quality.duplicate_count(frame).first()[0] == 1


def test_null_keys_are_kept(spark):
    frame = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("search_location"))
    table = spark.range(900).select(
        F.col("id").alias("name"), F.struct(F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng")).alias("coordinates")
    )
    joined = lookup.attach_coordinates(frame, table)
    assert joined.count() == 900 and joined.where("lat is null").count() == 600


def test_lookups_read_only_what_is_shown(spark, small):
    wide = spark.read.parquet(f"{small}/orders.parquet").withColumnRenamed("o_orderstatus", "search_location")
    table = spark.createDataFrame([("x", (1.0, 2.0))], "name string, coordinates struct<lat:double,lng:double>")
    plan = plan_of(lookup.attach_coordinates(wide, table).select("o_orderkey", "lat"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


@pytest.mark.parametrize("hot", [0, None])
def test_hot_key_is_split_in_a_merge_join(spark, hot):
    key = F.when(F.col("id") % 3 == 0, F.lit(hot).cast("bigint")).otherwise(F.col("id"))
    frame = spark.range(60000).select("id", key.alias("k"))
    table = spark.range(60000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = lookup.attach_details(frame.repartition(8), table, "k")
        rows = joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(rows) == 60000 and all(r.v == ("x" if r.k is not None else None) for r in rows)


def test_scd2_merge(spark):
    history_rows = [(1, "a", 10, 10, 20), (1, "b", 20, 20, None), (2, "x", 5, 5, None), (3, "q", 7, 7, None)]
    past = spark.createDataFrame(history_rows, "k int, v string, u int, valid_from int, valid_to int")
    now = spark.createDataFrame([(1, "c", 30), (2, "x", 5), (4, "n", 9)], "k int, v string, u int")
    merged = history.snapshot_merge(past, now, "k", "u").orderBy("k", "valid_from")
    assert [tuple(r) for r in merged.select("k", "v", "valid_from", "valid_to").collect()] == [
        (1, "a", 10, 20), (1, "b", 20, 30), (1, "c", 30, None), (2, "x", 5, None), (3, "q", 7, None), (4, "n", 9, None),
    ]


def metres(a, b):
    (la, lo), (lb, lp) = [tuple(map(math.radians, p)) for p in (a, b)]
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("search", [geo.places_around, quadtree.places_around, partial(quadtree.places_around, most=7)])
@pytest.mark.parametrize("own", [False, True])
@pytest.mark.parametrize("radius", [5000, 300_000])
def test_radius_equals_brute_force(spark, radius, own, search):
    rng = random.Random(7)
    spots = [(0, 0), (89.99, 10), (-90, 0), (45, 180), (45, -180), (60.5, 179.99), (-33, 151)]
    width = math.degrees(radius / geo.EARTH_RADIUS_M)

    def near(lat, lng):
        lat = max(-90.0, min(90.0, lat + rng.uniform(-1.5, 1.5) * width))
        lng = lng + rng.uniform(-1.5, 1.5) * width / max(0.02, math.cos(math.radians(lat)))
        return lat, (lng + 180) % 360 - 180

    places = [near(*rng.choice(spots)) for _ in range(600)]
    centres = spots + [near(*s) for s in spots]
    frame = spark.createDataFrame([(i, *p, ["restaurant"]) for i, p in enumerate(places)], "row_key int, latitude double, longitude double, types array<string>")
    # Smaller and larger than the argument, and none.
    radii = [rng.choice([None, radius // 3, radius * 2]) if own else None for _ in centres]
    middle = spark.createDataFrame([(str(i), float(a), float(b), r) for i, ((a, b), r) in enumerate(zip(centres, radii))], "name string, latitude double, longitude double, radius_m int")
    got = {(r.search_location, r.row_key) for r in search(frame, middle, radius).collect()}
    want = {(str(i), j) for i, c in enumerate(centres) for j, p in enumerate(places) if metres(c, p) <= (radii[i] or radius)}
    assert got == want and want


def test_quadtree_leaves_are_found_without_a_row_by_row_search(spark):
    """The leaf is looked up once per row, not by an interpreted loop that repeats the code of the place at each step."""
    rng = random.Random(5)
    starts = [0, *sorted(rng.sample(range(1, quadtree.SIDE**2), 999))]
    leaves = quadtree.Leaves(starts, [1] * len(starts))
    codes = [0, quadtree.SIDE**2 - 1, *starts, *[s - 1 for s in starts[1:]], *[s + 1 for s in starts]]
    coded = spark.createDataFrame([(c,) for c in codes], "_code bigint")
    found = {r["_code"]: (r["_leaf"], r["_share"]) for r in quadtree.with_cells(coded, leaves).collect()}
    assert found == {c: (bisect.bisect_right(starts, c) - 1, 0) for c in codes}
    spots = [(rng.uniform(40, 41), rng.uniform(10, 11)) for _ in range(500)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], "row_key int, latitude double, longitude double")
    centres = spark.createDataFrame([("a", 40.5, 10.5)], "name string, latitude double, longitude double")
    around = quadtree.places_around(frame, centres, 9000, None, most=20)
    plan = around._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and len(plan) < 50_000
    assert quadtree.SIDE <= 1 << 26  # codes are whole numbers as doubles


def test_quadtree_cells_are_bounded(spark):
    """A third of the places stand in one street, a third at one address; the rest anywhere."""
    rng = random.Random(3)
    street = [(48.2 + rng.uniform(0, 0.002), 16.37 + rng.uniform(0, 0.002)) for _ in range(1500)]
    spots = street + [(-33.5, 151.2)] * 1500 + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(1500)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], "row_key int, latitude double, longitude double")
    coded = frame.withColumn("_code", quadtree.code(F.col("latitude"), F.col("longitude")))
    leaves = quadtree.find_leaves(coded, 50)
    assert leaves.starts[0] == 0 and leaves.starts == sorted(set(leaves.starts)) and max(leaves.shares) == 30
    cells = quadtree.with_cells(coded, leaves).groupBy("_leaf", "_share").count()
    sizes = [r["count"] for r in cells.collect()]
    assert sum(sizes) == len(spots) and max(sizes) <= 90  # shares of one address are equal on average
    centres = spark.createDataFrame([("a", -33.5, 151.2), ("b", 48.201, 16.371)], "name string, latitude double, longitude double")
    for radius in (30, 4000):
        got = quadtree.places_around(frame, centres, radius, None, most=50)
        want = {(n, i) for n, c in (("a", (-33.5, 151.2)), ("b", (48.201, 16.371))) for i, p in enumerate(spots) if metres(c, p) <= radius}
        rows = [(r.search_location, r.row_key) for r in got.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want
    nothing = frame.where("row_key < 0")
    assert quadtree.places_around(nothing, centres, 4000, None).count() == 0
    assert quadtree.places_around(frame, centres.where("name = 'c'"), 4000, None).count() == 0


def test_rows_that_come_after_the_models_were_made(spark, tmp_path):
    def rows(keys):
        made = [(k, None if k % 2 else f"r{k}", f"Place {k}", 4.0, "yelp", k) for k in keys]
        frame = spark.createDataFrame(made, "row_key long, id string, name string, rating double, data_source string, n int")
        return frame.withColumn("ingestion_timestamp", F.timestamp_seconds("n")).drop("n").withColumns(
            {c: F.lit(None).cast(t) for c, t in (("formatted_address", "string"), ("price_level", "int"),
             ("user_ratings_total", "int"), ("latitude", "string"), ("longitude", "string"), ("categories", "string"))}
        )

    path = str(tmp_path / "raw")
    rows(range(6)).write.parquet(path)
    raw = spark.read.parquet(path)
    warehouse.build_models(raw, "r1", "late_view", "late_dim", str(tmp_path / "first"), key="row_key")
    numbered = models.staging_listings(raw, key="row_key")
    rows(range(6, 12)).write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    assert spark.table("late_view").count() == 6  # the table it reads
    assert numbered.count() in (6, 12) and numbered.where("restaurant_id is null").count() == 0
    grown = spark.read.parquet(path)
    warehouse.build_models(grown, "r2", "late_view", "late_dim", str(tmp_path / "second"), key="row_key")
    fresh = models.staging_listings(grown, key="row_key").drop("processed_at")
    assert spark.table("late_view").drop("processed_at").exceptAll(fresh).count() == 0
    assert spark.table("late_view").count() == fresh.count() == 12


def test_shared_folder_is_the_configured_one(spark):
    assert scratch.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_per_location_prunes_before_the_shuffle(spark, small):
    plan = plan_of(QUERIES["w2_top_per_location"].build(spark, small))
    assert "WindowGroupLimit" in plan[plan.index("Exchange") :]


@pytest.mark.parametrize("k", [3, 999, 1000, 1500])
def test_any_k_and_any_columns(spark, k):
    frame = spark.range(6000).select(
        F.col("id").alias("row_key"), F.lit("hot").alias("search_location"), (F.col("id") * 31 % 977).alias("rating"),
        F.create_map(F.lit("a"), F.col("id")).alias("extra"),
    )
    top = ranking.top_per_location(frame, k)
    want = [r.row_key for r in frame.orderBy(F.desc("rating"), "row_key").limit(k).collect()]
    assert [r.row_key for r in top.orderBy("rank").collect()] == want


def test_top_k_does_not_sort_everything(spark, small):
    for name in ("o1_serving_top", "o2_top_rated"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name].build(spark, small))


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = plan_of(QUERIES["s7_read_table"].build(spark, small))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    for name in ("a8_avg_rating_by_data_source", "a11_value_counts_business_tier"):
        plan = plan_of(QUERIES[name].build(spark, small))
        assert "o_orderstatus" not in plan and "o_orderdate" not in plan


def test_single_partition_only_for_part_counts(spark, small):
    plan = plan_of(QUERIES["w1_global_row_number"].build(spark, small))
    single = plan.index("SinglePartition")
    assert "HashAggregate(keys=[_part" in plan[single:]


LOCATIONS = [
    ("San Francisco, CA", "high"), ("New York, NY", "high"), ("Los Angeles, CA", "high"), ("Chicago, IL", "high"),
    ("Miami, FL", "medium"), ("Seattle, WA", "medium"), ("Austin, TX", "medium"), ("Denver, CO", "medium"),
    ("Boston, MA", "medium"), ("Portland, OR", "low"), ("Phoenix, AZ", "high"),
]


@pytest.fixture(scope="module")
def dimension(spark):
    rows = [(i, n, "US", p, True) for i, (n, p) in enumerate(LOCATIONS)]
    return spark.createDataFrame(rows, "ordinal int, name string, country string, priority string, enabled boolean")


def test_location_dimension(spark, dimension):
    categories = spark.sql(
        """select map('major_cities', array('San Francisco, CA', 'New York, NY', 'Los Angeles, CA', 'Chicago, IL'),
             'tech_hubs', array('San Francisco, CA', 'Seattle, WA', 'Austin, TX', 'Denver, CO')) categories"""
    )
    members = loc.explode_categories(categories)
    status = {(r.metric, r.name): r.value for r in loc.location_status(dimension, members).collect()}
    assert status == {("total", None): 11, ("enabled", None): 11, ("category", "major_cities"): 4, ("category", "tech_hubs"): 4}
    assert loc.locations_by_category(dimension, members, "tech_hubs").count() == 4
    assert loc.locations_by_category(dimension, members, "nothing").count() == 0
    assert loc.locations_by_priority(dimension, "high").count() == 5
    ordered = [r.priority for r in loc.order_by_priority(dimension).collect()]
    assert ordered == ["high"] * 5 + ["medium"] * 5 + ["low"]
    batches = {r.name: r.batch for r in loc.assign_batches(dimension).collect()}
    assert [batches[n] for n in ("Phoenix, AZ", "Miami, FL", "Boston, MA", "Portland, OR")] == [0, 1, 1, 2]


def test_location_maintenance(spark, dimension):
    new = spark.createDataFrame([(1, "Boston, MA", None), (2, "Las Vegas, NV", "high"), (3, "Las Vegas, NV", "low"), (4, "Reno, NV", None)], "ordinal int, name string, priority string")
    added = {r.name: (r.country, r.priority, r.enabled) for r in loc.add_locations(dimension, new).collect()}
    assert len(added) == 13 and added["Las Vegas, NV"] == ("US", "high", True)
    assert added["Reno, NV"] == ("US", "medium", True) and added["Boston, MA"][1] == "medium"
    names = spark.createDataFrame([("Boston, MA",), ("Nowhere",)], "name string")
    assert loc.remove_locations(dimension, names).count() == 10
    off = loc.set_enabled(dimension, names, False)
    assert off.where("not enabled").count() == 1 and off.columns == dimension.columns
    flagged = {r.name: r.is_valid for r in lookup.validate_locations(names, off).collect()}
    assert flagged == {"Boston, MA": False, "Nowhere": False}


def test_policy_limits(spark, dimension):
    listings = dimension.crossJoin(spark.range(60).withColumnRenamed("id", "row_key")).select(
        F.col("name").alias("search_location"), "row_key", (F.col("row_key") % 5).alias("rating")
    )
    counts = {r.search_location: r["count"] for r in loc.top_by_policy(listings, dimension).groupBy("search_location").count().collect()}
    assert [counts[n] for n in ("Phoenix, AZ", "Miami, FL", "Portland, OR")] == [50, 30, 20]
    known = dimension.where("name <> 'Miami, FL'").withColumn("priority", F.when(F.col("name") != "Austin, TX", F.col("priority")).otherwise("other"))
    counts = {r.search_location: r["count"] for r in loc.top_by_policy(listings, known).groupBy("search_location").count().collect()}
    assert len(counts) == 11 and counts["Miami, FL"] == counts["Austin, TX"] == 20


def test_preview(spark, dimension):
    rows = [tuple(r) for r in ranking.preview(dimension).collect()]
    assert (None, 6) in rows and len(rows) == 6
    assert ranking.preview(dimension, 11).count() == 11


def test_a_large_k_on_one_hot_location_is_ranked_in_shares(spark):
    """Beyond the size up to which Spark prunes by itself; three quarters of the rows are in one location."""
    rows = spark.range(40000).select(
        F.col("id").alias("row_key"),
        F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("l"), F.col("id") % 40)).alias("search_location"),
        ((F.col("id") * 7919) % 50).cast("double").alias("rating"),
    )
    found = ranking.top_per_location(rows, 5000)
    order = Window.partitionBy("search_location").orderBy(F.desc_nulls_last("rating"), "row_key")
    want = rows.withColumn("rank", F.row_number().over(order)).where("rank <= 5000")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert found.columns == want.columns and found.where("search_location = 'hot'").count() == 5000
    # The first ranking is by share too, so a task sorts a part of the hot location.
    assert "_share" in plan_of(found)


def test_own_limits_of_centres_prune_before_the_shuffle(spark):
    places = spark.range(3000).selectExpr("id AS row_key", "cast(id % 97 as int) AS review_count", "id / 1e6 AS latitude", "0.0 AS longitude")
    centres = spark.createDataFrame([("a", 0.0, 0.0, 3), ("b", 0.001, 0.0, None), ("c", 50.0, 0.0, 9)], "name string, latitude double, longitude double, request_limit int")
    found = geo.radius_filter(places, centres, place_type=None, limit=5)
    assert "WindowGroupLimit" in plan_of(found)
    assert {r[0]: r[1] for r in found.groupBy("search_location").count().collect()} == {"a": 3, "b": 5}
