"""Bounded slices of a log and the fixed envelope they land in."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidelog.functions.payload import base64_text, headers_json, is_text, strict_text
from tidelog.operators.bounds import unfinished
from tidelog.schema import BOUNDS_DDL
from tidelog.session import SMALL_ROWS, local_table, small_rows

# Up to this many partitions the ranges become literals, which reach the Parquet scan as filters.
LITERAL_RANGES = 64

RECORD_ID = ["topic", "partition", "offset"]


def read_slice(log: DataFrame, bounds: DataFrame | Sequence[Row]) -> DataFrame:
    """Records with ``resume <= offset < bound`` of every unfinished partition.

    ``bounds`` are rows, or a table that is evaluated now: a slice must not move while it is read.
    The overall offset range is always a scan filter. Per-partition ranges are literals for few
    partitions, else a broadcast join; past the broadcast limit a plain join, whose hot partitions
    AQE splits.
    """
    if isinstance(bounds, DataFrame):
        todo = unfinished(bounds).select("partition", "resume", "bound")
        rows = small_rows(todo, SMALL_ROWS)
    else:
        rows = [r for r in bounds if r["resume"] < r["bound"]]
    offset = F.col("offset")
    if rows is None:
        low, high = todo.agg(F.min("resume"), F.max("bound")).head()
    elif not rows:
        return log.where(F.lit(False))
    else:
        low, high = min(r["resume"] for r in rows), max(r["bound"] for r in rows)
    near = log.where((offset >= low) & (offset < high))
    if rows is not None and len(rows) <= LITERAL_RANGES:
        ranges = [
            (F.col("partition") == r["partition"]) & (offset >= r["resume"]) & (offset < r["bound"])
            for r in rows
        ]
        return near.where(F.col("partition").isin([r["partition"] for r in rows])).where(reduce(or_, ranges))
    if rows is not None:
        ranges = [(r["partition"], r["resume"], r["bound"]) for r in rows]
        todo = F.broadcast(local_table(log.sparkSession, ranges, BOUNDS_DDL))
    inside = (offset >= F.col("resume")) & (offset < F.col("bound"))
    return near.join(todo, "partition").where(inside).select(*log.columns)


def envelope(log: DataFrame, encoding: str = "utf8") -> DataFrame:
    """The seven landed columns.

    With utf8, a payload that is not valid UTF-8 stops the job that lands it, naming the record. A
    job that never reads key or value cannot notice; ``utf8_rejects`` is the check that always does.
    """
    if encoding == "base64":
        payload = {name: base64_text(F.col(name)) for name in ("key", "value")}
    else:
        payload = {name: strict_text(F.col(name), name) for name in ("key", "value")}
    return log.select(
        "topic", "partition", "offset", "timestamp",
        payload["key"].alias("key"), payload["value"].alias("value"),
        headers_json(F.col("headers")).alias("headers"),
    )


def utf8_rejects(log: DataFrame) -> DataFrame:
    """One row per key or value that utf8 landing would refuse."""
    fields = [
        F.when(~is_text(F.col(name)), F.lit(name)) for name in ("key", "value")
    ]
    bad = ~is_text(F.col("key")) | ~is_text(F.col("value"))
    return log.where(bad).select(
        "topic", "partition", "offset", F.explode(F.array_compact(F.array(*fields))).alias("field")
    )


def offset_gaps(log: DataFrame) -> DataFrame:
    """Offsets missing between the first and the last record of each partition."""
    return log.groupBy("partition").agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count(F.lit(1)).alias("records"),
        (F.max("offset") - F.min("offset") + 1 - F.count(F.lit(1))).alias("missing"),
    )


def landed_counts(landed: DataFrame) -> DataFrame:
    return landed.groupBy("partition").agg(F.count(F.lit(1)).alias("messages"))


def dedupe_redelivered(landed: DataFrame) -> DataFrame:
    """One row per (topic, partition, offset).

    Ids alone are counted first. A record delivered once passes by a join with the repeated ids, which
    AQE broadcasts while they are few, so its payload is neither sorted nor grouped. Copies collapse on the map
    side, before their shuffle, so one id may hold any share of the rows. Ids are never null in a landed table.
    """
    repeated = landed.groupBy(*RECORD_ID).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").select(*RECORD_ID)
    once = landed.join(repeated, RECORD_ID, "left_anti").select(*landed.columns)
    copies = landed.join(repeated, RECORD_ID, "left_semi").select(*landed.columns)
    return once.unionByName(copies.dropDuplicates(RECORD_ID))


def compacted_view(log: DataFrame) -> DataFrame:
    """The last record of each key of a partition, without keys whose last record is a tombstone.

    A compacted topic holds keyed records only. The last offset of each key is found from key and offset alone, merged
    on the map side, so even a key with a third of all rows sends one row per map task; payloads are read by a semi-join
    with the winning offsets, which AQE broadcasts while they are few. A log holds each offset of a partition once; a landed
    table that may hold copies goes through dedupe_redelivered first.
    """
    keyed = log.where(F.col("key").isNotNull())
    last = keyed.groupBy("topic", "partition", "key").agg(F.max("offset").alias("offset")).select(*RECORD_ID)
    won = log.join(last, RECORD_ID, "left_semi")
    return won.where(F.col("value").isNotNull()).select(
        "topic", "partition", "offset", "timestamp", "key", "value", "headers")
