"""Data-quality report and data tests. A data test returns the failing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.schema import FEEDS, REQUIRED_COLUMNS
from placemat.scratch import stage


def _repeated_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that occur more than once, with the number of copies; null equals null.

    Only an eight-byte hash per row is shuffled at first. The hashes seen more than once are
    written out, so Spark knows their size when it looks them up and broadcasts them only if
    they are few, and the whole rows behind them are then compared exactly.
    """
    row = [F.col(f"`{c}`") for c in columns]
    hashed = df.select(*row).withColumn("_hash", F.xxhash64(*row))
    seen = hashed.groupBy("_hash").agg(F.count("*").alias("_rows")).where("_rows > 1").select("_hash")
    suspects = hashed.join(stage(seen, "hashes"), "_hash", "left_semi")
    return suspects.groupBy(*row).agg(F.count("*").alias("_copies")).where("_copies > 1")


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    copies = _repeated_rows(df, columns or df.columns)
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_records"))


def _entry(metric: str, column: str | None, value: Column) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"),
        F.lit(column).cast("string").alias("column"),
        value.cast("string").alias("value"),
    )


def quality_metrics(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """The quality report as (metric, column, value) rows of text.

    A frame without rows yields the single row (status, null, error).
    """
    names = df.columns
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}") for i, c in enumerate(names)]
    report = [
        _entry("total_records", None, F.col("_rows")),
        _entry("total_columns", None, F.lit(len(names))),
        _entry("duplicate_records", None, F.col("duplicate_records")),
        *[_entry("missing_values", c, F.col(f"_null_{i}")) for i, c in enumerate(names)],
        *[_entry("data_type", c, F.lit(t)) for c, t in df.dtypes],
        *[_entry("missing_required_column", c, F.lit("missing")) for c in required if c not in names],
    ]
    empty = F.array(_entry("status", None, F.lit("error")))
    counted = df.agg(F.count("*").alias("_rows"), *nulls)
    # Two rows, one from each measurement, folded into one.
    measured = counted.unionByName(duplicate_count(df), allowMissingColumns=True)
    folded = measured.agg(*[F.max(c).alias(c) for c in measured.columns])
    return folded.select(F.inline(F.when(F.col("_rows") == 0, empty).otherwise(F.array(*report))))


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def test_unique(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    return counts.where("count > 1")


def test_accepted_range(df: DataFrame, column: str, lo: float, hi: float) -> DataFrame:
    return df.where(~F.col(column).between(lo, hi))


def test_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    outside = df.where(~F.col(column).isin(list(values)))
    return outside.groupBy(column).agg(F.count("*").alias("count"))


def test_required_columns(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Names absent from the schema; no data is read."""
    missing = [(c,) for c in columns if c not in df.columns]
    return df.sparkSession.createDataFrame(missing, "column string")


def test_summary(df: DataFrame, not_null: Sequence[str], ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Failing rows of the not-null and range tests, counted in one pass, as (test, column, failures)."""
    checks = [("not_null", c, F.col(c).isNull()) for c in not_null]
    checks += [("accepted_range", c, ~F.col(c).between(lo, hi)) for c, (lo, hi) in ranges.items()]
    sums = df.agg(*[F.count_if(failed).alias(f"_{i}") for i, (_, _, failed) in enumerate(checks)])
    rows = [
        F.struct(F.lit(test).alias("test"), F.lit(c).alias("column"), F.col(f"_{i}").alias("failures"))
        for i, (test, c, _) in enumerate(checks)
    ]
    return sums.select(F.inline(F.array(*rows)))


def row_tests() -> dict[str, Column]:
    """The data tests of the raw listing table that look at one row, true where it fails.

    Every column below must be filled and ratings must lie in [0, 5].
    """
    filled = ("id", "name", "rating", "data_source", "ingestion_timestamp")
    return {
        **{f"not_null_{c}": F.col(c).isNull() for c in filled},
        "accepted_range_rating": ~F.col("rating").between(0, 5),
    }


def counted(tests: Mapping[str, Column]) -> dict[str, Column]:
    """The number of rows that fail each test, as aggregates: to observe while rows are written, or for one ``agg``."""
    return {name: F.count_if(failed) for name, failed in tests.items()}


def missing_values(columns: Sequence[str]) -> dict[str, Column]:
    """The number of nulls of each column, named ``missing_<column>``, as aggregates."""
    return {f"missing_{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in columns}


def failing_rows(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Each row once per test it fails, with the test's name in ``test``, in one pass."""
    names = F.array_compact(F.array(*[F.when(failed, F.lit(name)) for name, failed in tests.items()]))
    return df.withColumn("test", F.explode(names))


def group_tests(df: DataFrame) -> dict[str, DataFrame]:
    """The data tests that compare rows: ids must be unique and the source must be a known feed."""
    return {
        "unique_id": test_unique(df, "id"),
        "accepted_values_data_source": test_accepted_values(df, "data_source", FEEDS),
    }
