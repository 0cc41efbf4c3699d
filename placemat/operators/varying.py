"""Records whose keys vary from row to row, flattened without a schema given beforehand.

A record is held as a variant. One aggregate over the records gives the keys they have, at every depth, with the type
each key's values have in common; then one projection takes every leaf out. So no key is lost and no row is parsed by
Python. The only thing that reaches the driver is that schema, whose size follows the number of distinct keys and is
checked. Keep the schema and pass it on, and later runs over the same feed need no first pass.

Rules: objects become ``parent_child`` columns, arrays JSON text, an empty object no column; numbers with
a fraction are doubles; a key that is an object in one record and something else in another is text in all of them. Keys come in
alphabetical order, also within the JSON text of arrays, as variants do not keep the order of the source. Of paths that
give the same column name a record has the value of the last one that it has. A null record gives nulls.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemat.functions.jsontext import ascii_text

MAX_COLUMNS = 5000


def read_varying_json(spark: SparkSession, path: str, multi_line: bool = False, name: str = "record") -> DataFrame:
    """Landed JSON records, one per line (or file), as variants; what is not JSON gives no record."""
    texts = spark.read.option("wholetext", multi_line).text(path)
    return texts.select(F.try_parse_json("value").alias(name)).where(F.col(name).isNotNull())


def explode_records(df: DataFrame, array: str, column: str = "record", name: str = "record") -> DataFrame:
    """One row per element of each response's array; a missing or empty one gives none."""
    elements = F.try_variant_get(F.col(column), _path("$", array), "array<variant>")
    return df.select(F.explode(elements).alias(name)).where(~F.is_variant_null(F.col(name)))


def _path(parent: str, key: str) -> str:
    quote = '"' if "'" in key else "'"
    if quote in key:
        raise ValueError(f"a key with both kinds of quotes cannot be addressed: {key}")
    return f"{parent}[{quote}{key}{quote}]"


def varying_schema(df: DataFrame, column: str = "record") -> T.StructType:
    """All keys of the records, at every depth. Records that are not objects count as having none."""
    objects = df.where(F.schema_of_variant(F.col(column)).startswith("OBJECT<"))
    found = objects.agg(F.schema_of_variant_agg(column)).first()[0]
    if not found.startswith("OBJECT<"):
        return T.StructType()
    # In DDL an object is a struct; a key in backquotes may say anything.
    ddl = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    return T.StructType.fromDDL(f"record {ddl}")["record"].dataType


def spaced_json(compact: Column) -> Column:
    """Compact JSON text with ', ' and ': ' between its parts and non-ASCII characters escaped."""
    # No control character stands in JSON text, so two of them can stand for escaped signs in the meantime.
    held = F.replace(F.replace(compact, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    spaced = F.regexp_replace(held, r'((?:"[^"]*+"|[^",:]++)*+)([,:])', "$1$2 ")
    return ascii_text(F.replace(F.replace(spaced, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\")))


def _leaf(record: Column, path: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType):
        return spaced_json(F.nullif(F.to_json(F.try_variant_get(record, path, "variant")), F.lit("null")))
    plain = kind if isinstance(kind, T.LongType | T.BooleanType) else T.DoubleType() if isinstance(kind, T.NumericType) else T.StringType()
    return F.try_variant_get(record, path, plain.simpleString())


def flatten_varying(
    df: DataFrame, column: str = "record", schema: T.StructType | None = None, sep: str = "_", max_columns: int = MAX_COLUMNS
) -> DataFrame:
    """One column per leaf of the records of ``column``; the frame's other columns are left out.

    More than ``max_columns`` leaves raise an error, as then keys are likely to be data.
    """
    schema = varying_schema(df, column) if schema is None else schema
    record, leaves = F.col(column), {}

    def walk(fields: list[T.StructField], path: str, prefix: str) -> None:
        for field in fields:
            name, own = f"{prefix}{sep}{field.name}" if prefix else field.name, _path(path, field.name)
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType.fields, own, name)
            else:
                kind = field.dataType
                leaves.setdefault(name, []).append((T.DoubleType() if isinstance(kind, T.DecimalType) else kind, _leaf(record, own, kind)))

    walk(schema.fields, "$", "")
    if len(leaves) > max_columns:
        raise ValueError(f"{len(leaves)} columns, more than {max_columns}")

    def column_of(found: list[tuple[T.DataType, Column]]) -> Column:
        same = len({kind.simpleString() for kind, _ in found}) == 1
        values = [value if same else value.cast("string") for _, value in reversed(found)]
        return F.coalesce(*values)

    return df.select(*[column_of(found).alias(name) for name, found in leaves.items()])
