"""One run of a feed: plan bounds, read the slice, land it, and only then advance the token."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime
from urllib.parse import quote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidelog.errors import FeedRefused
from tidelog.operators.bounds import (
    NAMED_PROBLEMS, check_after_read, effective_bounds, landed_problems, refuse_problems, resume_plan,
)
from tidelog.operators.reading import LITERAL_RANGES, envelope, read_slice
from tidelog.operators.token import advance_token, parse_token
from tidelog.options import ReadOptions
from tidelog.plans.state import load_token, store_token
from tidelog.schema import BOUNDS_DDL, ENVELOPE_SCHEMA
from tidelog.session import local_table, path_exists, small_rows, snapshot, stage, use_utc
from tidelog.sources.catalogue import (
    catalogue_marks, expected_records, limited_bounds, load_committed, log_files, offsets_at_indexed,
)
from tidelog.sources.logs import offsets_at, watermarks

BOUND_COLUMNS = ("partition", "resume", "bound")


@dataclass(frozen=True)
class FeedRun:
    """A planned run. ``bounds`` are fixed; the envelope is lazy; the token holds once it has landed.

    ``proof`` is what the landed rows have to show, (partition, first, last, records) with null for what is not known.
    """

    topic: str
    bounds: DataFrame
    envelope: DataFrame
    token: DataFrame
    proof: DataFrame | None = None

    def token_text(self) -> str:
        return self.token.head()["token"]


def with_emptied(marks: DataFrame, token: DataFrame | None) -> DataFrame:
    """Watermarks seen in data, and for stored partitions that hold no record now, low and high at the stored offset.

    The first record that data shows is no low watermark where the token lies before it: offsets may have gaps, so that
    nothing need be lost. Such a partition is low at its stored offset.
    """
    if token is None:
        return marks
    stored = token.select("partition", "next_offset")
    return marks.join(stored, "partition", "full").select(
        "partition", F.least("low", "next_offset").alias("low"), F.coalesce("high", "next_offset").alias("high"))


def _proof(plan: DataFrame, bounds: DataFrame, seen: DataFrame) -> DataFrame:
    """What watermarks seen in the data let the slice be held to: records they were taken from lie at both ends."""
    ends = plan.select("partition", "high").join(seen.select("partition", F.col("low").alias("first_seen")), "partition", "left")
    return bounds.where(F.col("resume") < F.col("bound")).join(ends, "partition").select(
        "partition", F.when(F.col("first_seen").between(F.col("resume"), F.col("bound") - 1), F.col("first_seen")).alias("first"),
        F.when((F.col("bound") == F.col("high")) & F.col("first_seen").isNotNull(), F.col("bound") - 1).alias("last"),
        F.lit(None).cast("bigint").alias("records"))


def _start_lookup(log: DataFrame, start, marks: DataFrame, token: DataFrame | None) -> DataFrame | None:
    """Offsets by time, for a start at an instant and only for partitions without a stored offset."""
    if not isinstance(start, datetime):
        return None
    if token is None:
        return offsets_at(log, start)
    new = small_rows(marks.join(token, "partition", "left_anti").select("partition"))
    if new is None:
        return offsets_at(log, start)
    return offsets_at(log.where(F.col("partition").isin([r["partition"] for r in new])), start) if new else None


def feed_run(
    log: DataFrame,
    read: ReadOptions,
    token: str | DataFrame | None = None,
    marks: DataFrame | None = None,
    stops: DataFrame | None = None,
    at: DataFrame | None = None,
    limit: Callable[[DataFrame], DataFrame] | None = None,
) -> FeedRun:
    """Plan a run over ``log`` (one topic) from ``token``, or from ``read.start`` where it has no entry.

    ``marks`` are watermarks when a catalogue knows them better than the data does; ``stops`` are
    (partition, stop_offset) where reading must end early. Without ``marks``, a partition that the
    token knows and the data no longer shows keeps its place. ``at`` are offsets by time where an index knows them, and
    ``limit`` makes the bounds smaller than all there is to read. The bounds are fixed before the slice
    and the token are made of them; the envelope then scans one slice, split by Spark over as many tasks as the data needs.
    """
    spark = use_utc(log.sparkSession)
    if isinstance(token, str) or token is None:
        token = parse_token(spark, token, read.topic)
    seen = None
    if marks is None:
        seen = snapshot(watermarks(log), "marks")
        marks = with_emptied(seen, token)
    plan = resume_plan(marks, token, read.start, _start_lookup(log, read.start, marks, token) if at is None else at)
    rows = small_rows(plan)
    if rows is None:
        plan = stage(plan, "plan")
        named = plan.where(F.col("problem").isNotNull()).orderBy("partition").limit(NAMED_PROBLEMS)
        refuse_problems(read.topic, named.collect())
        bounds = effective_bounds(plan.select("partition", "resume", "bound"), stops)
        bounds = to_read = stage(limit(bounds) if limit else bounds, "bounds")
    else:
        refuse_problems(read.topic, rows)
        if not rows:
            raise FeedRefused(f"no topic '{read.topic}' here; check the 'topic' option")
        to_read = sorted((Row(**{c: r[c] for c in BOUND_COLUMNS}) for r in rows), key=lambda r: r["partition"])
        bounds = local_table(spark, to_read, BOUNDS_DDL)
        if stops is not None or limit is not None:
            bounds = effective_bounds(bounds, stops)
            bounds = to_read = snapshot(limit(bounds) if limit else bounds, "bounds")
    return FeedRun(
        read.topic, bounds,
        envelope(read_slice(log, to_read), read.encoding),
        advance_token(read.topic, bounds),
        _proof(plan, bounds, seen) if seen is not None else None,
    )


def feed_topic(
    spark: SparkSession,
    path: str,
    read: ReadOptions,
    token: str | None = None,
    stops: DataFrame | None = None,
    max_records: int | None = None,
    max_bytes: int | None = None,
) -> FeedRun:
    """Plan a run over a topic of a catalogue (sources.catalogue), with exact watermarks and no look at the records.

    A start at an instant reads one file of each partition that has no stored offset. ``max_records`` and ``max_bytes`` bound the
    run, shared fairly by the partitions. The run is held to the number of records that the catalogue counts in its bounds.
    """
    stored, at = parse_token(use_utc(spark), token, read.topic), None
    marks = catalogue_marks(spark, path, read.topic)
    if isinstance(read.start, datetime):
        new = marks if stored is None else marks.join(stored, "partition", "left_anti")
        at = offsets_at_indexed(spark, path, read.topic, read.start, new)
    files = log_files(spark, path, read.topic)
    run = feed_run(
        load_committed(spark, path, read.topic), read, stored, marks, stops, at,
        lambda bounds: limited_bounds(bounds, files, max_records, max_bytes))
    nothing = F.lit(None).cast("bigint")
    proof = expected_records(files, run.bounds).select("partition", nothing.alias("first"), nothing.alias("last"), "records")
    return replace(run, proof=proof)


def _naming_the_record(error: PySparkException) -> FeedRefused | None:
    """A strict-text refusal raised inside a task, as the one exception callers know."""
    message = str(error)
    if "bytes that are no UTF-8 text" not in message or "topic '" not in message:
        return None
    start = message.index("topic '")
    return FeedRefused(message[start:].splitlines()[0])


def run_folder(landed_path: str, topic: str, run: int) -> str:
    return f"{landed_path}/feed={quote(topic, safe='')}/run={run}"


def write_run(plan: FeedRun, landed_path: str, run: int) -> int:
    """Land the slice as run number ``run``, in place of what an attempt of that number left, and hold it to its proof.

    Returns the number of records. How many records of each partition were written, and the first and last of them, come with the
    write itself for up to LITERAL_RANGES partitions, else from the two columns of what was written.
    """
    spark, folder = plan.envelope.sparkSession, run_folder(landed_path, plan.topic, run)
    lanes = small_rows(plan.bounds.where(F.col("resume") < F.col("bound")).select("partition"), LITERAL_RANGES)
    offset, seen = F.col("offset"), Observation()
    metrics = [F.count(F.lit(1)).alias("messages")]
    for p in (r["partition"] for r in lanes or ()):
        own = F.when(F.col("partition") == p, offset)
        metrics += [F.count(own).alias(f"n{p}"), F.min(own).alias(f"first{p}"), F.max(own).alias(f"last{p}")]
    try:
        plan.envelope.observe(seen, *metrics).write.mode("overwrite").parquet(folder)
    except PySparkException as failed:
        refusal = _naming_the_record(failed)
        if refusal is None:
            raise
        raise refusal from failed
    if plan.proof is not None:
        if lanes is None:
            shown = spark.read.schema("partition int, offset bigint").parquet(folder).groupBy("partition").agg(
                F.count(F.lit(1)).alias("n"), F.min(offset).alias("head"), F.max(offset).alias("tail"))
        else:
            got = seen.get
            shown = local_table(spark, [(p, got[f"n{p}"], got[f"first{p}"], got[f"last{p}"]) for p in (r["partition"] for r in lanes)],
                                "partition int, n bigint, head bigint, tail bigint")
        refuse_problems(plan.topic, landed_problems(plan.proof, shown).limit(NAMED_PROBLEMS).collect())
    return seen.get["messages"]


def land(
    log: DataFrame,
    read: ReadOptions,
    landed_path: str,
    state_path: str,
    full_refresh: bool = False,
    marks: DataFrame | None = None,
    stops: DataFrame | None = None,
    fresh_marks=None,
) -> int:
    """Run from the stored token, land the envelope as this run's folder under ``landed_path``, store the new token.

    Returns the number of landed records. The token is stored after the write committed and the slice proved whole: records
    that the plan saw at the ends of a partition were read, and ``fresh_marks``, if given, still hold every resume
    offset. A failed run changes no state; the next one has the same number and replaces its folder, so each record lands
    once. ``landed_rows`` leaves a folder out whose run was never committed. ``full_refresh`` ignores the stored token.
    """
    text, run = load_token(log.sparkSession, state_path, read.topic)
    plan = feed_run(log, read, None if full_refresh else text, marks, stops)
    messages = write_run(plan, landed_path, run + 1)
    if fresh_marks is not None:
        check_after_read(read.topic, plan.bounds, fresh_marks())
    store_token(plan.token, state_path, run + 1)
    return messages


def land_topic(
    spark: SparkSession,
    path: str,
    read: ReadOptions,
    landed_path: str,
    state_path: str,
    full_refresh: bool = False,
    stops: DataFrame | None = None,
    max_records: int | None = None,
    max_bytes: int | None = None,
) -> int:
    """As ``land``, for a topic of a catalogue: planned by its marks, counted by its index, and checked after the read
    against the marks of that moment."""
    text, run = load_token(use_utc(spark), state_path, read.topic)
    plan = feed_topic(spark, path, read, None if full_refresh else text, stops, max_records, max_bytes)
    messages = write_run(plan, landed_path, run + 1)
    check_after_read(read.topic, plan.bounds, catalogue_marks(spark, path, read.topic))
    store_token(plan.token, state_path, run + 1)
    return messages


def landed_rows(spark: SparkSession, landed_path: str, state_path: str, topic: str) -> DataFrame:
    """The envelope rows of a topic's committed runs, with ``run``."""
    _, last = load_token(spark, state_path, topic)
    folder = f"{landed_path}/feed={quote(topic, safe='')}"
    if not last or not path_exists(spark, folder):
        return local_table(spark, [], StructType([*ENVELOPE_SCHEMA, StructField("run", LongType())]))
    rows = spark.read.schema(StructType([*ENVELOPE_SCHEMA, StructField("run", LongType())])).parquet(folder)
    return rows.where(F.col("run") <= last)
