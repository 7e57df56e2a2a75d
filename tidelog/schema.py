"""Record, envelope and token-level schemas."""

from __future__ import annotations

from pyspark.sql import types as T

HEADERS_TYPE = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
)

# A log row: what Spark's Kafka source delivers with includeHeaders, less timestampType.
LOG_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", HEADERS_TYPE),
])

# A landed row. Fixed for every topic, never inferred.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("headers", T.StringType(), False),
])

WATERMARKS_DDL = "partition int, low bigint, high bigint"
BOUNDS_DDL = "partition int, resume bigint, bound bigint"
TOKEN_DDL = "partition int, next_offset bigint"

# What each role of an output column may hold.
TIME_TYPES = (T.TimestampType, T.TimestampNTZType)
KEY_TYPES = (T.StringType, T.IntegerType, T.LongType)
VALUE_TYPES = (T.StringType,)
HEADER_TYPES = (
    T.StringType, T.IntegerType, T.LongType, T.BooleanType, T.DateType, *TIME_TYPES,
)
NESTED_TYPES = (T.StructType, T.ArrayType, T.MapType)
JSON_SCALAR_TYPES = (
    T.StringType, T.IntegerType, T.LongType, T.DoubleType, T.DecimalType,
    T.BooleanType, T.DateType, *TIME_TYPES,
)
