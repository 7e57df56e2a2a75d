"""Option maps for Spark's own Kafka source and sink, which need the Kafka package on the cluster.

Users pass their connection as ``kafka.*`` options; what a feed depends on is set here and refused
when the user sets it too.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidelog.errors import FeedRefused
from tidelog.options import ReadOptions, WriteOptions

# What makes a read exact and a write durable.
READ_FIXED = {
    "kafka.isolation.level": "read_committed",
    "failOnDataLoss": "true",
    "includeHeaders": "true",
}
WRITE_FIXED = {
    "kafka.enable.idempotence": "true",
    "kafka.acks": "all",
    "kafka.linger.ms": "5",
}
SECRET_WORDS = ("password", "secret", "token", "jaas")


def _merge(connection: Mapping[str, str], fixed: Mapping[str, str]) -> dict[str, str]:
    clash = sorted(set(connection) & set(fixed))
    if clash:
        raise FeedRefused("; ".join(f"'{k}' is set by the feed; remove it from the connection" for k in clash))
    if not connection.get("kafka.bootstrap.servers"):
        raise FeedRefused("'kafka.bootstrap.servers' is required")
    return {**connection, **fixed}


def connection_secrets(connection: Mapping[str, str]) -> list[str]:
    """Option values that must not appear in any message; hand them to functions.redact."""
    return [v for k, v in connection.items() if any(w in k.lower() for w in SECRET_WORDS)]


def offsets_json(topic: str, offsets: Iterable[tuple[int, int]]) -> str:
    per_partition = {str(p): o for p, o in sorted(offsets)}
    return json.dumps({topic: per_partition}, separators=(",", ":"))


def slice_options(connection: Mapping[str, str], topic: str, bounds: Iterable) -> dict[str, str]:
    """Batch read of exactly ``[resume, bound)`` of every partition in ``bounds``."""
    bounds = list(bounds)
    return _merge(connection, {
        **READ_FIXED,
        "subscribe": topic,
        "startingOffsets": offsets_json(topic, ((b["partition"], b["resume"]) for b in bounds)),
        "endingOffsets": offsets_json(topic, ((b["partition"], b["bound"]) for b in bounds)),
    })


def stream_options(
    connection: Mapping[str, str], read: ReadOptions, max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    """Streaming read; the checkpoint holds the offsets, so the start applies to the first run only."""
    fixed = {**READ_FIXED, "subscribe": read.topic}
    if isinstance(read.start, str):
        fixed["startingOffsets"] = read.start
    else:
        fixed["startingTimestamp"] = str(int(read.start.timestamp() * 1000))
        fixed["startingOffsetsByTimestampStrategy"] = "latest"
    if max_offsets_per_trigger is not None:
        fixed["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return _merge(connection, fixed)


def sink_options(connection: Mapping[str, str], write: WriteOptions) -> dict[str, str]:
    return _merge(connection, {
        **WRITE_FIXED,
        "topic": write.topic,
        "kafka.compression.type": write.compression,
    })


def load_slice(spark: SparkSession, connection: Mapping[str, str], topic: str, bounds: Iterable) -> DataFrame:
    return spark.read.format("kafka").options(**slice_options(connection, topic, bounds)).load()


def load_stream(spark: SparkSession, connection: Mapping[str, str], read: ReadOptions, **limits) -> DataFrame:
    return spark.readStream.format("kafka").options(**stream_options(connection, read, **limits)).load()


def write_records(records: DataFrame, connection: Mapping[str, str], write: WriteOptions) -> None:
    records.write.format("kafka").options(**sink_options(connection, write)).mode("append").save()
