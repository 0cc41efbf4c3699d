"""Tables are replaced as a whole or not at all."""

import pytest
from pyspark.sql import functions as F

from placemat.operators import stats
from placemat.scratch import fresh_path
from placemat.sinks import tables


def frame(spark, n, **columns):
    return spark.range(n).withColumns({"city": F.concat(F.lit("c"), F.col("id") % 7), "rating": F.col("id") * 1.0} | columns)


def files_of(df):
    return sorted(r[0] for r in df.select("_metadata.file_path").distinct().collect())


def test_a_failed_load_changes_nothing(spark):
    path = fresh_path(spark, "loads")
    table = tables.write_overwrite(frame(spark, 10), "replace_me", path)
    before = files_of(table)
    broken = frame(spark, 1000, rating=F.when(F.col("id") == 990, F.raise_error("no")).otherwise(1.0)).repartition(4)
    with pytest.raises(Exception, match="no"):
        tables.write_overwrite(broken, "replace_me", path)
    assert files_of(spark.table("replace_me")) == before and spark.table("replace_me").count() == 10
    assert tables.rows_written(spark, "replace_me") == 10


def test_a_load_may_read_its_own_table(spark):
    path = fresh_path(spark, "loads")
    tables.write_overwrite(frame(spark, 10), "grow", path)
    old = spark.table("grow")
    tables.write_overwrite(old.unionAll(old), "grow", path)
    assert spark.table("grow").count() == 20 and tables.rows_written(spark, "grow") == 20
    # A frame made before the swap still has its files.
    assert spark.read.parquet(*files_of(spark.table("grow"))).count() == 20
    previous = spark.sql(f"SHOW TBLPROPERTIES grow ('{tables.PREVIOUS}')").first()["value"]
    assert spark.read.parquet(previous).count() == 10


def test_columns_and_layout_may_change(spark):
    path = fresh_path(spark, "loads")
    tables.write_overwrite(frame(spark, 10), "change", path)
    assert tables.write_overwrite(frame(spark, 5, more=F.lit("x")), "change", path).columns == ["id", "city", "rating", "more"]
    assert tables.materialize_bucketed(frame(spark, 8), "change", spread="id", path=path, buckets=4).count() == 8
    assert tables.materialize_bucketed(frame(spark, 9), "change", spread="id", path=path, buckets=4).count() == 9
    assert tables.materialize_clustered(frame(spark, 6), "change", ["city"], "id", path).count() == 6
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("change_load")]


def test_failures_by_test_are_replaced(spark):
    rows = frame(spark, 10).withColumn("test", F.col("city"))
    path = fresh_path(spark, "loads")
    assert tables.store_failures(rows, "swap", path, by="test").count() == 10
    assert tables.store_failures(rows.where("id < 3"), "swap", path, by="test").count() == 3
    assert tables.store_failures(rows.where("id < 0"), "swap", path, by="test").count() == 0


def exchanges(df):
    """How often rows are dealt out by hash, of which a plan under adaptive execution may speak twice."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning")


def test_grouping_and_joining_buckets_needs_no_exchange(spark):
    hot = frame(spark, 20000, city=F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)))
    table = tables.materialize_bucketed(hot, "bucketed", spread="id", path=fresh_path(spark, "b"), buckets=8)
    assert exchanges(hot.groupBy("city").count()) > 0 and exchanges(stats.avg_rating_by(table, "city")) == 0
    assert exchanges(table.groupBy("city").agg(F.avg("rating"))) == 0
    assert len(files_of(table.where("city = 'hot'"))) == 4
    details = hot.groupBy("city").agg(F.max("rating").alias("best"))
    other = tables.materialize_bucketed(details, "bucketed_details", spread="best", path=fresh_path(spark, "b"), buckets=8)
    joined = table.hint("merge").join(other, "city")
    assert exchanges(joined) == 0 and joined.count() == 20000
    assert table.count() == hot.count()


def test_landed_text_is_compressed_in_files_of_bounded_length(spark, monkeypatch):
    """Keys that repeat in every record do not fill the disk, and no task gets all rows of one that wrote many."""
    from pathlib import Path

    from registry import inputs

    monkeypatch.setattr(inputs, "RECORDS_PER_FILE", 1500)
    rows = spark.range(4000).coalesce(1).selectExpr("id AS a_rather_long_name", "cast(id % 7 AS string) AS another_rather_long_name")
    files = [*Path(inputs.land(rows, "json", "landed-test")).glob("part-*")]
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 4000 * 20
    assert spark.read.schema(rows.schema).json([str(f) for f in files]).exceptAll(rows).count() == 0
    assert spark.read.schema(rows.schema).json([str(f) for f in files]).count() == 4000


def bytes_of(df):
    return df.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0]


def test_tables_are_written_small_unless_the_session_names_a_codec(spark):
    codec = "spark.sql.parquet.compression.codec"
    assert spark.conf.get(codec, None) is None
    rows = frame(spark, 20000, address=F.concat(F.col("id") * 7919, F.lit(" Main St")), location=F.concat(F.lit("Location "), F.col("id")))
    sizes = {}
    for name in (None, "snappy"):
        if name:
            spark.conf.set(codec, name)
        try:
            table = tables.write_overwrite(rows, f"codec_{name or 'unset'}", fresh_path(spark, "codec"))
        finally:
            spark.conf.unset(codec)
        assert table.exceptAll(rows).count() == 0 and table.count() == 20000
        sizes[name] = bytes_of(table)
    assert sizes[None] < 0.7 * sizes["snappy"]


def test_the_batch_run_writes_few_bytes_for_an_order(spark, small):
    """Landed responses and the table together, at a size where no dictionary holds the texts."""
    from pathlib import Path

    from __spark_entry__ import QUERIES
    from registry import inputs

    folder, orders = fresh_path(spark, "orders"), inputs.table_of(spark, small, "orders")
    shifted = {"o_orderkey": F.col("o_orderkey") + F.col("id") * 1500, "o_custkey": F.col("o_custkey") + F.col("id") * 150}
    copies = orders.crossJoin(spark.range(200)).withColumns(shifted).drop("id")
    copies.coalesce(1).write.parquet(f"{folder}/orders.parquet")
    table = QUERIES["e1_batch_table"].build(spark, folder)
    label, path = inputs._landed[-1][1::2]
    landed = sum(f.stat().st_size for f in Path(path).glob("part-*"))
    assert label == "business" and landed > 0 and table.count() == 600_000
    assert landed + bytes_of(table) < 33 * 300_000
