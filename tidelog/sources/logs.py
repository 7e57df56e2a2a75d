"""Log-shaped DataFrames: from any table, from a stored log table, and their partition catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.errors import FeedRefused
from tidelog.schema import HEADERS_TYPE, LOG_SCHEMA


def as_log(
    df: DataFrame,
    topic: str,
    partition: Column,
    offset: Column,
    timestamp: Column,
    key: Column | None = None,
    value: Column | None = None,
    headers: Column | None = None,
) -> DataFrame:
    """View any table as a topic.

    ``offset`` must rise along each partition and be unique in it, but may leave gaps, as it does on
    a compacted topic: feed progress is by offset, never by row count. So a table's own sequence
    number serves, no row needs numbering, and a range of offsets reaches the table's scan as a
    range of that column. Key and value are payload bytes; text columns are encoded as UTF-8.
    """
    none = F.lit(None)
    return df.select(
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
        (none if key is None else key).cast("binary").alias("key"),
        (none if value is None else value).cast("binary").alias("value"),
        (none if headers is None else headers).cast(HEADERS_TYPE).alias("headers"),
    )


def header(name: str | Column, value: Column) -> Column:
    """One header of a record; put several in ``F.array``."""
    return F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))


def load_log(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """A log table stored as Parquet, best laid out by topic and partition (see sinks.append)."""
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    return log if topic is None else log.where(F.col("topic") == topic)


def discover_partitions(log: DataFrame, topic: str) -> DataFrame:
    """The topic's partitions; a topic without any is refused by name."""
    found = log.where(F.col("topic") == topic).select("topic", "partition")
    if not found.head(1):
        raise FeedRefused(f"no topic '{topic}' here; check the 'topic' option")
    return found.distinct()


def watermarks(log: DataFrame, partitions: DataFrame | None = None) -> DataFrame:
    """Low offset and next offset to be written, per partition of a log of one topic.

    Grouping by topic too lets a session with spark.sql.parquet.aggregatePushdown answer from file
    footers, as a stored log is laid out by (topic, partition). ``partitions`` adds partitions that hold no record yet, at (0, 0). Data alone shows neither
    retention nor trailing gaps; where a broker or a catalogue states watermarks, use those.
    """
    seen = log.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")
    ).drop("topic")
    if partitions is None:
        return seen
    zero = F.lit(0).cast("bigint")
    return (
        partitions.select("partition").distinct().join(seen, "partition", "left")
        .select("partition", F.coalesce("low", zero).alias("low"), F.coalesce("high", zero).alias("high"))
    )


def offsets_at(log: DataFrame, moment) -> DataFrame:
    """Per partition, the earliest offset whose record time is at or after ``moment``."""
    return (
        log.where(F.col("timestamp") >= F.lit(moment).cast("timestamp"))
        .groupBy("partition").agg(F.min("offset").alias("at"))
    )
