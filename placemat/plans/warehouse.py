"""The SQL-model run: staging view, clustered dimension table, stored test failures."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemat.operators.quality import counted, failing_rows, group_tests, missing_values, row_tests
from placemat.plans.models import dim_listings, staging_listings
from placemat.sinks.tables import (
    materialize_clustered,
    materialize_view,
    measured,
    rows_written,
    store_failures,
    write_measured,
    write_overwrite,
)


def build_models(
    raw: DataFrame,
    run_id: str,
    view: str = "staging_listings",
    table: str = "dim_listings",
    path: str | None = None,
    as_of: Column | date | str | None = None,
    at: Column | datetime | None = None,
    key: str | None = None,
) -> DataFrame:
    """Write the staging table, a view over it and the dimension table; returns the dimension.

    Ids made up from row numbers are fixed when the table is written, so the view gives every row of the
    table it reads whenever it is read. Rows that come into ``raw`` later appear with the next run.
    """
    staging = write_overwrite(
        staging_listings(raw, at, key), f"{view}_table", f"{path}/staging" if path else None
    )
    viewed = materialize_view(staging, view)
    return materialize_clustered(
        dim_listings(viewed, run_id, as_of, at), table, path=f"{path}/dimension" if path else None
    )


def run_tests(raw: DataFrame, path: str | None = None) -> dict[str, DataFrame]:
    """Store the failing rows of each data test; a failure is a finding, not an error.

    Tests of single rows share one pass and one table, apart by test; the others have a table each.
    """
    tests = row_tests()
    rows = store_failures(failing_rows(raw, tests), "rows", f"{path}/rows" if path else None, "test")
    stored = {name: rows.where(F.col("test") == name).drop("test") for name in tests}
    for name, failing in group_tests(raw).items():
        stored[name] = store_failures(failing, name, f"{path}/{name}" if path else None)
    return stored


def load_tested(raw: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Write the raw listings and return the report on them as ``measure, value`` rows, from the writing job alone.

    The report has the rows, the nulls of each column and the failures of each test of single rows. Nothing is read
    again for it; the failing rows themselves and the tests that compare rows are ``run_tests`` over the table.
    """
    spark = raw.sparkSession
    write_measured(raw, table, {**missing_values(raw.columns), **counted(row_tests())}, path)
    report = {"rows": rows_written(spark, table), **measured(spark, table)}
    return spark.createDataFrame(list(report.items()), "measure string, value long")
