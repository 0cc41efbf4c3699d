"""Comparisons of a row with the previous or next row of the same key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemat.operators.ranking import PART, POSITION, range_parts
from placemat.scratch import stage


def with_neighbour(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    columns: Sequence[str],
    name: str,
    ahead: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Add ``name``: a struct of ``columns`` of the previous (or next) row of the same key.

    It equals ``lag``/``lead`` over (partition by key order by order), null at the ends, but a
    key may span any number of tasks. Rows are laid out so that the wanted neighbour comes next;
    the window runs inside (part, key), and the first row of each part, at most ``parts`` in
    all, is handed to the part before it. Whole rows are written, so select what is needed first.
    """
    laid_out = range_parts(df, [key, *order], parts, descending=not ahead)
    values = F.struct(*columns)
    inside = Window.partitionBy(PART, key).orderBy(POSITION)
    first = F.struct(F.col(key).alias("key"), values.alias("values")).alias("_first")
    firsts = laid_out.where(F.col(POSITION) == 0).select(PART, first)
    edges = firsts.select(PART, F.lead("_first").over(Window.orderBy(PART)).alias("_edge"))
    across = F.when(F.col("_edge").isNotNull() & F.col("_edge.key").eqNullSafe(F.col(key)), F.col("_edge.values"))
    return (
        laid_out.withColumn("_inside", F.lead(values).over(inside))
        .join(F.broadcast(edges), PART)
        .withColumn(name, F.coalesce("_inside", across))
        .drop(PART, POSITION, "_edge", "_inside")
    )


def scd2_history(
    df: DataFrame, key: str, updated_at: str, tie: Sequence[str], parts: int | None = None
) -> DataFrame:
    """Validity interval of each version: from its own update to the next one of the same key.

    ``tie`` orders versions of one key and time; with it the order must be unique.
    """
    following = with_neighbour(df, key, [updated_at, *tie], [updated_at], "_next", ahead=True, parts=parts)
    return following.withColumns(
        {"valid_from": F.col(updated_at), "valid_to": F.col(f"_next.{updated_at}")}
    ).drop("_next")


def snapshot_merge(history: DataFrame, current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Incremental form: close the open version of each key that has a newer row and append that row.

    ``history`` carries ``valid_from`` and ``valid_to`` and has one open version per key;
    ``current`` has one row per key.
    """
    incoming = current.select(F.col(key), F.col(updated_at).alias("_incoming"))
    newer = F.col("valid_to").isNull() & (F.col("_incoming") > F.col(updated_at))
    closed = history.join(incoming, key, "left").withColumn(
        "valid_to", F.when(newer, F.col("_incoming")).otherwise(F.col("valid_to"))
    )
    open_now = history.where("valid_to is null").select(F.col(key), F.col(updated_at).alias("_open"))
    fresh = (
        current.join(open_now, key, "left")
        .where(F.col("_open").isNull() | (F.col(updated_at) > F.col("_open")))
        .withColumns(
            {"valid_from": F.col(updated_at), "valid_to": F.lit(None).cast(current.schema[updated_at].dataType)}
        )
    )
    return closed.drop("_incoming").unionByName(fresh.drop("_open"))


OPEN = "open"
LAYOUT = ("period", "slot")


def _laid_out(history: DataFrame, key: str, slots: int) -> DataFrame:
    """``period`` is the month in which a version was closed, or OPEN; ``slot`` a hash class of the key."""
    period = F.coalesce(F.date_format("valid_to", "yyyy-MM"), F.lit(OPEN))
    return history.withColumns({"period": period, "slot": F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")})


def write_history(history: DataFrame, path: str, key: str, slots: int = 64) -> None:
    """Store a history in partitions of open and closed versions, which ``merge_history`` can replace one by one."""
    laid_out = _laid_out(history, key, slots)
    laid_out.repartition(*LAYOUT).write.partitionBy(*LAYOUT).parquet(path)


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _stored(spark, path, schema).drop(*LAYOUT)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, *T.StructType.fromDDL("period string, slot int").fields])).parquet(path)


def merge_history(path: str, current: DataFrame, key: str, updated_at: str, slots: int = 64) -> int:
    """Bring a stored history up to date with ``current`` (one row per key) and say how many versions are new.

    The result is that of ``snapshot_merge``. Of the stored rows only two columns of the open versions in the slots
    of the incoming keys are read to find what is new; after that only the partitions that a new or closed version belongs to
    are read and written again, by dynamic partition overwrite: the open slots of changed keys and, for closed versions, the
    month and slot they move to. The driver gets the list of these partitions. What is written is staged first, so a lost executor
    never leaves a partition half read and half replaced. ``slots`` is that of ``write_history``.
    """
    spark = current.sparkSession
    versions = current.withColumns({"valid_from": F.col(updated_at), "valid_to": F.lit(None).cast(current.schema[updated_at].dataType)})
    fields = versions.schema
    incoming = versions.withColumn("slot", F.pmod(F.xxhash64(key), F.lit(slots)).cast("int"))
    hit = [r["slot"] for r in incoming.select("slot").distinct().collect()]
    if not hit:
        return 0
    standing = _stored(spark, path, fields).where((F.col("period") == OPEN) & F.col("slot").isin(hit))
    standing = standing.select("slot", F.col(key).alias("_key"), F.col(updated_at).alias("_open"))
    same = (incoming["slot"] == standing["slot"]) & (incoming[key] == F.col("_key"))
    found = incoming.join(standing, same, "left").where(F.col("_open").isNull() | (F.col(updated_at) > F.col("_open")))
    fresh = stage(found.select(*fields.names, incoming["slot"], F.col("_open")), "fresh")
    moved = F.when(F.col("_open").isNotNull(), F.date_format(updated_at, "yyyy-MM"))
    touched = fresh.select("slot", F.explode(F.array_compact(F.array(F.lit(OPEN), moved))).alias("period")).distinct().collect()
    if not touched:
        return 0
    by_period: dict[str, list[int]] = {}
    for r in touched:
        by_period.setdefault(r["period"], []).append(r["slot"])
    chosen = F.lit(False)
    for period, some in by_period.items():
        chosen = chosen | ((F.col("period") == period) & F.col("slot").isin(some))
    old = _stored(spark, path, fields).where(chosen).drop(*LAYOUT)
    merged = snapshot_merge(old, fresh.select(*[c for c in current.columns]), key, updated_at)
    staged = stage(_laid_out(merged.select(*fields.names), key, slots), "merged")
    writer = staged.repartition(*LAYOUT).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*LAYOUT).parquet(path)
    return fresh.count()


def rating_drops(
    df: DataFrame, threshold: float, order: Sequence[str], key: str = "id", parts: int | None = None
) -> DataFrame:
    """Rows whose rating is at least ``threshold`` below the previous rating of the same listing.

    ``order`` must be unique within a listing.
    """
    compared = with_neighbour(df, key, order, ["rating"], "_previous", parts=parts)
    drop = F.col("_previous.rating") - F.col("rating")
    return (
        compared.withColumns({"previous_rating": F.col("_previous.rating"), "drop": drop})
        .where(F.col("drop") >= threshold)
        .drop("_previous")
    )


def availability_changes(
    df: DataFrame,
    available: Column,
    order: Sequence[str],
    key: str = "id",
    parts: int | None = None,
) -> DataFrame:
    """Rows whose availability differs from the previous row of the same listing.

    ``order`` must be unique within a listing.
    """
    flagged = df.withColumn("available", available)
    compared = with_neighbour(flagged, key, order, ["available"], "_previous", parts=parts)
    return (
        compared.withColumn("was_available", F.col("_previous.available"))
        .where(F.col("_previous").isNotNull() & ~F.col("available").eqNullSafe(F.col("was_available")))
        .drop("_previous")
    )
