"""Row numbers, top-k and ordered reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placemat.scratch import stage

PART = "_part"
POSITION = "_position"
ROWS_PER_PART_BITS = 33  # layout of monotonically_increasing_id: partition id above, position below


def range_parts(
    df: DataFrame, order: Sequence[str], parts: int | None = None, descending: bool = False
) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, with part number and position in the part.

    The range bounds are sampled, so the layout is written out once and read back: every later
    use sees the same parts, also after executors were lost. ``order`` should end in a unique
    column; then even rows sharing one key or one instant spread over many parts. Without
    ``parts`` there are at most ``spark.sql.shuffle.partitions``, merged where they are small.
    """
    keys = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]
    row = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    laid_out = ranged.sortWithinPartitions(*keys).withColumn("_row", row)
    return stage(
        laid_out.withColumns(
            {
                PART: F.shiftright("_row", ROWS_PER_PART_BITS).cast("int"),
                POSITION: F.col("_row").bitwiseAND((1 << ROWS_PER_PART_BITS) - 1),
            }
        ).drop("_row"),
        "ranges",
    )


def global_row_number(
    df: DataFrame, order: Sequence[str], name: str = "row_number", parts: int | None = None
) -> DataFrame:
    """``row_number() over (order by ...)`` without gathering the rows in one task.

    Only one row count per part is summed up in one place; that frame has at most ``parts``
    rows, which is also what bounds the broadcast. Keep ``df`` narrow, it is written out.
    """
    laid_out = range_parts(df, order, parts)
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = laid_out.groupBy(PART).agg(F.count("*").alias("_rows")).select(
        PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    return (
        laid_out.join(F.broadcast(offsets), PART)
        .withColumn(name, F.col("_offset") + F.col(POSITION) + 1)
        .drop(PART, POSITION, "_offset")
    )


def surrogate_id(
    df: DataFrame,
    key: str | None = None,
    order: Sequence[str] = ("ingestion_timestamp",),
    name: str = "restaurant_id",
    parts: int | None = None,
) -> DataFrame:
    """``id``, or ``unknown_<row number over all rows>`` where the id is null.

    Rows are numbered by ``order`` and then ``key``, a unique column. With it only those columns
    are moved for the numbering, and only the rows without an id take part in the join that
    brings the number back. Without a key the other columns break ties and whole rows are moved.
    Numbers are those of the rows at the time of the call. A row without an id that comes in
    later, before the frame is read, is kept and named after its key.
    """
    made_up = F.concat(F.lit("unknown_"), F.col("_number").cast("string"))
    if key is None:
        ordered = [*order, *[c for c in df.columns if c not in order]]
        numbered = global_row_number(df, ordered, "_number", parts)
        return numbered.withColumn(name, F.coalesce("id", made_up)).drop("_number")
    ordered = [*order, key]
    narrow = df.select(*ordered, F.col("id").isNull().alias("_unnamed"))
    numbered = global_row_number(narrow, ordered, "_number", parts).where("_unnamed")
    kept = df.where(F.col("id").isNotNull()).withColumn(name, F.col("id"))
    late = F.concat(F.lit("unknown_key_"), F.col(key).cast("string"))
    named = df.where(F.col("id").isNull()).join(numbered.select(key, made_up.alias(name)), key, "left")
    return kept.unionByName(named.withColumn(name, F.coalesce(name, late)))


def top_per_location(
    df: DataFrame,
    k: int = 50,
    by: str = "search_location",
    order: Sequence[Column] | None = None,
    name: str = "rank",
    shares: int = 64,
) -> DataFrame:
    """The best-rated ``k`` rows of each location.

    The rank filter lets Spark keep ``k`` rows per location in each task before the shuffle,
    so a location holding a large share of the rows does not travel whole. Spark does so for ``k``
    below ``spark.sql.optimizer.windowGroupLimitThreshold``. For a larger ``k`` a location is first ranked in
    ``shares`` shares, dealt by the hash of the row, so that no task sorts more than a share of it, or ``k`` rows of each.
    """
    order = order or [F.desc_nulls_last("rating"), F.asc("row_key")]

    def best(rows: DataFrame, *keys: str) -> DataFrame:
        ranked = rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        return ranked.where(F.col(name) <= k)

    if k < int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return best(df, by)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    hashable = [c for c, kind in kinds.items() if "map<" not in kind and "variant" not in kind]
    shared = df.withColumn("_share", F.pmod(F.xxhash64(*hashable), F.lit(shares)))
    return best(best(shared, by, "_share").drop("_share", name), by)


def serving_top(df: DataFrame, n: int = 500, tie: str = "place_id") -> DataFrame:
    return df.orderBy(F.desc_nulls_last("rating"), F.desc_nulls_last("review_count"), F.asc_nulls_last(tie)).limit(n)


def top_rated(df: DataFrame, n: int = 10, tie: str = "place_id") -> DataFrame:
    """The ``n`` best ratings; ``tie`` says which row counts as the first among equals."""
    ranked = df.orderBy(F.desc_nulls_last("rating"), F.asc_nulls_last(tie)).limit(n)
    return ranked.select("name", "rating", "city", "review_count")


def preview(df: DataFrame, n: int = 5, order: str = "ordinal") -> DataFrame:
    """The first ``n`` names, then one row with the number of names left over, if any are."""
    first = df.orderBy(order).limit(n).select("name", F.lit(None).cast("bigint").alias("more"))
    left = df.agg((F.count("*") - n).alias("more")).where("more > 0")
    return first.unionByName(left.select(F.lit(None).cast("string").alias("name"), "more"))
