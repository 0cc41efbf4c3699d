"""Writers for batch results. Each returns the frame that reads the written table back."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

#: Table property with the number of rows the last complete load wrote.
ROWS = "placemat.rows"
#: Table property with the folder of the load before, which nothing reads that was planned since.
PREVIOUS = "placemat.previous"
#: Prefix of the properties with what was measured while the last complete load was written.
MEASURE = "placemat.measure."
#: Codec of tables where the session names none. Large tables hold texts that no dictionary takes in; snappy barely shortens those.
CODEC = "zstd"


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()
    return described["data_type"]


def _shape(spark: SparkSession, table: str) -> tuple:
    """What a table's new files must share with its old ones for the location alone to change."""
    columns = spark.catalog.listColumns(table)
    kinds = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields]
    return kinds, [c.name for c in columns if c.isPartition], [c.name for c in columns if c.isBucket], _buckets(spark, table)


def _buckets(spark: SparkSession, table: str) -> str:
    found = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    return found["data_type"] if found else ""


def _swap(spark: SparkSession, staged: str, table: str, folder: str) -> None:
    """Point ``table`` at the folder that ``staged`` has been written to."""
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        return
    previous = _location(spark, table)
    shape = _shape(spark, staged)
    if shape == _shape(spark, table) and not shape[1]:
        spark.sql(f"DROP TABLE {staged}")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    else:
        # Columns or layout are others: the old table steps aside and goes only when the new one stands.
        aside = f"{staged}_old"
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        try:
            spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        except Exception:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
            raise
        spark.sql(f"DROP TABLE {aside}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}' = '{previous}')")
    spark.catalog.refreshTable(table)


def _codec(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.parquet.compression.codec", None) or CODEC


def _save(
    df: DataFrame,
    table: str,
    path: str | None,
    by: str | None = None,
    buckets: tuple[int, str] | None = None,
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Write the rows to a folder of their own, then let the table point there.

    Until the last step, which moves no data, the table is what it was: a load that fails changes nothing, readers never
    see part of a load, and ``df`` may read the table it replaces. The rows are counted while they are written, and
    ``measures`` (aggregates that give whole numbers) taken.
    Folders of earlier loads stay, as a frame may still read them; the property ``PREVIOUS`` names the last one, and
    who owns the folder removes it.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex
    base = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}_loads"
    folder, staged = f"{base.rstrip('/')}/load-{run}", f"{table}_load_{run}"
    counted = Observation(staged)
    taken = [m.alias(f"m_{name}") for name, m in (measures or {}).items()]
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"), *taken)
    writer: DataFrameWriter = observed.write.format("parquet").options(path=folder, compression=_codec(spark))
    writer = writer.partitionBy(by) if by else writer
    writer = writer.bucketBy(*buckets).sortBy(buckets[1]) if buckets else writer
    writer.saveAsTable(staged)
    _swap(spark, staged, table, folder)
    found = counted.get
    stale = [name for name in _properties(spark, table) if name.startswith(MEASURE)]
    if stale:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({', '.join(repr(n) for n in stale)})")
    values = {ROWS: found["rows"], **{f"{MEASURE}{name}": found[f"m_{name}"] for name in measures or {}}}
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({', '.join(f'{n!r} = {str(v)!r}' for n, v in values.items())})")
    return spark.read.table(table)


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def rows_written(spark: SparkSession, table: str) -> int:
    """How many rows the last complete load of the table wrote; nothing is read."""
    return int(spark.sql(f"SHOW TBLPROPERTIES {table} ('{ROWS}')").first()["value"])


def measured(spark: SparkSession, table: str) -> dict[str, int]:
    """What was measured while the last complete load of the table was written; nothing is read."""
    found = _properties(spark, table)
    return {name.removeprefix(MEASURE): int(v) for name, v in found.items() if name.startswith(MEASURE)}


def write_measured(df: DataFrame, table: str, measures: Mapping[str, Column], path: str | None = None) -> DataFrame:
    """``write_overwrite`` that takes ``measures``, such as counts of failing rows, in the job that writes.

    They are kept with the table (``measured``), so a report on the load reads nothing. Names are letters, digits
    and underscores. If a task is tried again, only its successful try counts.
    """
    return _save(df, table, path, measures=measures)


def write_overwrite(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Replace the table, as a whole or not at all; a failed write raises. ``path`` is the folder of its loads."""
    return _save(df, table, path)


#: An aggregate table is replaced in the same way.
save_stats = write_overwrite


def store_failures(df: DataFrame, test_name: str, path: str | None = None, by: str | None = None) -> DataFrame:
    """Keep the failing rows of a data test in a table of that name; failures do not raise.

    With ``by``, rows of several tests are kept apart by that column.
    """
    return _save(df, f"test_failures_{test_name}", path, by)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """A view that reads ``df`` anew each time; numbers that ``df`` has fixed stay fixed."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_clustered(
    df: DataFrame,
    table: str,
    by: Sequence[str] = ("city", "state"),
    spread: str = "restaurant_id",
    path: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Replace the table with its rows laid out by the clustering columns.

    Files hold narrow ranges of ``by``, so a filter on it skips most of them. The trailing
    ``spread`` column lets a value with very many rows fill several files.
    """
    keys = [*by, spread]
    laid_out = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    return _save(laid_out.sortWithinPartitions(*keys), table, path)


def materialize_bucketed(
    df: DataFrame,
    table: str,
    by: str = "city",
    spread: str = "restaurant_id",
    path: str | None = None,
    buckets: int | None = None,
    files: int = 4,
) -> DataFrame:
    """Replace the table with its rows in buckets of ``by``: grouping or joining by it then needs no exchange.

    A bucket has up to ``files`` files, dealt by ``spread``, so a value with very many rows is written by several tasks.
    Tables joined with each other need the same number of buckets (default: the shuffle partitions).
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.hash(by), F.lit(buckets))  # the bucket Spark's writer puts the row in
    dealt = df.repartition(buckets * files, bucket, F.pmod(F.xxhash64(spread), F.lit(files)))
    return _save(dealt, table, path, buckets=(buckets, by))


def encode_payload(df: DataFrame, key: str | None = None, timestamp: str | None = None) -> DataFrame:
    """Rows as JSON messages, with the message key and time when columns are named for them."""
    body = [c for c in df.columns if c not in (key, timestamp)]
    columns = [F.to_json(F.struct(*body)).alias("value")]
    if key:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    if timestamp:
        columns.append(F.col(timestamp).cast("timestamp").alias("timestamp"))
    return df.select(*columns)
