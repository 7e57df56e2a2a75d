"""A row as one JSON object, and single columns as the text that keys and headers carry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.schema import NESTED_TYPES, TIME_TYPES

# Fixed value: microseconds, UTC.
TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def named(column: str) -> Column:
    """A top-level column by its exact name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def timestamp_text(moment: Column) -> Column:
    """Needs a UTC session (session.use_utc)."""
    return F.date_format(moment, TIMESTAMP_PATTERN)


def flat_text(col: Column, dtype: T.DataType) -> Column:
    """A flat value as text: what record keys and headers hold, and JSON strings too."""
    if isinstance(dtype, TIME_TYPES):
        return timestamp_text(col)
    return col.cast("string")


def _as_is(dtype: T.DataType) -> bool:
    """Whether to_json already spells this type the way a record value needs it."""
    if isinstance(dtype, T.StructType):
        return all(_as_is(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _as_is(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return isinstance(dtype.keyType, T.StringType) and _as_is(dtype.valueType)
    return not isinstance(dtype, (T.DoubleType, T.DecimalType, T.DateType, *TIME_TYPES))


def json_ready(col: Column, dtype: T.DataType) -> Column:
    """Cast so that to_json writes non-finite doubles as null, decimals as digit strings, and times in full.

    The same rules hold at every depth of structs, arrays and maps.
    """
    if _as_is(dtype):
        return col
    if isinstance(dtype, T.DoubleType):
        finite = ~F.isnan(col) & (F.abs(col) != float("inf"))
        return F.when(finite, col)
    if isinstance(dtype, T.StructType):
        parts = [json_ready(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: json_ready(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        if not isinstance(dtype.keyType, T.StringType):
            col = F.transform_keys(col, lambda k, _: flat_text(k, dtype.keyType))
        return F.transform_values(col, lambda _, v: json_ready(v, dtype.valueType))
    return flat_text(col, dtype)


def row_json(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The row as a JSON object: columns in the given (or schema) order, nulls kept."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [json_ready(named(c), types[c]).alias(c) for c in (df.columns if columns is None else columns)]
    if not parts:
        return F.lit("{}")
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, NESTED_TYPES)
