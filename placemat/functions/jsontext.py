"""JSON text of nested columns with ', ' and ': ' separators and escaped non-ASCII characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _escape_char(c: Column) -> Column:
    """``\\uXXXX`` for a character beyond ASCII, as a surrogate pair above the basic plane."""
    code = F.ascii(c)

    def unit(value: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(value), 4, "0")))

    high = (F.shiftright(code - 0x10000, 10) + 0xD800).cast("int")
    low = (F.pmod(code - 0x10000, F.lit(0x400)) + 0xDC00).cast("int")
    return F.when(code < 128, c).when(code < 0x10000, unit(code)).otherwise(F.concat(unit(high), unit(low)))


# Printable ASCII without the quote and the backslash needs no escaping.
PLAIN = r"\A[ !#-\[\]-~]*\z"


def _string(c: Column) -> Column:
    def escaped(wrapped: Column) -> Column:
        quoted = wrapped.substr(F.lit(2), F.length(wrapped) - 2)
        return F.array_join(F.transform(F.split(quoted, ""), _escape_char), "")

    # The array of one binds the encoded text, so it is made once.
    slow = F.element_at(F.transform(F.array(F.to_json(F.array(c))), escaped), 1)
    return F.when(c.rlike(PLAIN), F.concat(F.lit('"'), c, F.lit('"'))).when(c.isNotNull(), slow)


def ascii_text(c: Column) -> Column:
    """``c`` with every character beyond ASCII escaped."""
    return F.when(c.rlike(r"\A\p{ASCII}*\z"), c).otherwise(F.array_join(F.transform(F.split(c, ""), _escape_char), ""))


def json_text(c: Column, dtype: T.DataType) -> Column:
    """JSON text of ``c``; SQL null inside a struct or array is written as ``null``."""
    null = F.lit("null")
    if isinstance(dtype, T.ArrayType):
        items = F.transform(c, lambda x: F.coalesce(json_text(x, dtype.elementType), null))
        return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    if isinstance(dtype, T.StructType):
        fields = [
            F.concat(F.lit(f'"{f.name}": '), F.coalesce(json_text(c.getField(f.name), f.dataType), null))
            for f in dtype.fields
        ]
        body = F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
        return F.when(c.isNotNull(), body)
    if isinstance(dtype, T.StringType):
        return _string(c)
    if isinstance(dtype, T.NumericType | T.BooleanType):
        return c.cast("string")
    return _string(c.cast("string"))
