"""Append records to a log table, giving each the next offset of its partition, as a broker does."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.prefix import BLOCK_BITS, dense_rank_in_order
from tidelog.options import WriteOptions
from tidelog.schema import LOG_SCHEMA
from tidelog.session import stage
from tidelog.sources.logs import load_log, watermarks

# Write option to Parquet codec.
PARQUET_CODECS = {"none": "none", "gzip": "gzip", "snappy": "snappy", "lz4": "lz4_raw", "zstd": "zstd"}


@dataclass(frozen=True)
class WriteResult:
    rows: int
    batches: int = 1


def key_partition(partitions: int) -> Column:
    """The default partitioner; records without a key go to partition 0."""
    return F.coalesce(F.pmod(F.crc32("key"), F.lit(partitions)), F.lit(0)).cast("int")


def append_offsets(records: DataFrame, highs: DataFrame | None, order: str, bits: int = BLOCK_BITS) -> DataFrame:
    """Add ``offset``: high watermark + position of the record in its partition's ``order``.

    ``records`` has a partition column and ``order``, a bigint unique within each partition, such
    as ``source_offset * partitions + source_partition``. ``highs`` is (partition, high); a
    partition without one starts at 0. A hot partition is numbered by many tasks.
    """
    starts = None if highs is None else highs.select("partition", F.col("high").alias("start"))
    return dense_rank_in_order(records, ["partition"], order, "offset", bits, starts)


def append_to_log(
    records: DataFrame,
    path: str,
    write: WriteOptions,
    partition: Column,
    order: str | None = None,
    highs: DataFrame | None = None,
    timestamp: Column | None = None,
) -> WriteResult:
    """Append ``records`` (of to_records) to the log table at ``path``. One writer at a time.

    Numbers go on from ``highs``, by default from those of the log at ``path``. A record without a
    partition fails the job. Without ``order`` the rows are staged once with a running id, so numbering cannot see two
    different orders. Files hold one offset range each, which lets slices skip them. A job that
    fails commits no file, and the caller stores its state only after this returns.
    """
    spark = records.sparkSession
    highs = log_highs(spark, path, write.topic) if highs is None else highs
    nowhere = F.raise_error(F.lit("a record has no partition: the partition column gave null")).cast("int")
    rows = records.withColumn("partition", F.coalesce(partition.cast("int"), nowhere)).withColumn(
        "timestamp", F.current_timestamp() if timestamp is None else timestamp.cast("timestamp"))
    if order is None:
        rows, order = stage(rows.withColumn("_order", F.monotonically_increasing_id()), "append"), "_order"
    numbered = append_offsets(rows, highs, order)
    seen = Observation()
    shaped = numbered.select(*LOG_SCHEMA.fieldNames()).observe(seen, F.count(F.lit(1)).alias("rows"))
    (
        shaped.sortWithinPartitions("topic", "partition", "offset")
        .write.mode("append").option("compression", PARQUET_CODECS[write.compression])
        .partitionBy("topic", "partition").parquet(path)
    )
    return WriteResult(rows=seen.get["rows"])


def log_highs(spark: SparkSession, path: str, topic: str) -> DataFrame | None:
    """High watermarks of a stored topic, from its offset column alone; None before the first append."""
    try:
        return watermarks(load_log(spark, path, topic)).select("partition", "high")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
