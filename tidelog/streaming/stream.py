"""The same feed as a stream: Spark's checkpoint holds the offsets in place of a token."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.errors import FeedRefused
from tidelog.operators.bounds import resume_plan
from tidelog.operators.reading import RECORD_ID, dedupe_redelivered, envelope, read_slice
from tidelog.operators.token import advance_token, parse_token
from tidelog.options import ReadOptions, WriteOptions
from tidelog.plans.state import load_token, store_token
from tidelog.schema import ENVELOPE_SCHEMA
from tidelog.session import snapshot, use_utc
from tidelog.sinks.append import append_to_log, log_highs
from tidelog.sinks.records import to_records
from tidelog.sources.logs import offsets_at, watermarks

LANDED_SCHEMA = T.StructType([*ENVELOPE_SCHEMA.fields, T.StructField("batch_id", T.LongType())])


def stream_feed(log: DataFrame, landed_path: str, checkpoint: str, encoding: str = "utf8") -> StreamingQuery:
    """Land what exists when the run starts, then stop; the next run lands only what came since.

    The file sink commits each batch once, and a batch that fails is read again. Bound the size of
    a batch at the source (maxFilesPerTrigger, maxOffsetsPerTrigger). A new checkpoint starts over.
    """
    use_utc(log.sparkSession)
    return (
        envelope(log, encoding).writeStream.format("parquet")
        .option("path", landed_path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def _unseen(batch: DataFrame, stored: DataFrame | None, landed_path: str, batch_id: int) -> DataFrame:
    """The batch's records that no earlier batch landed, each once.

    Records at or past the stored offsets are new. Older ones are copies or came late; only they are
    looked up in the landed table, each partition's in its own range of offsets.
    """
    once = dedupe_redelivered(batch)
    if stored is None:
        return once
    marked = once.join(stored, "partition", "left").withColumn(
        "_old", F.coalesce(F.col("offset") < F.col("next_offset"), F.lit(False)))
    old = marked.where("_old").select(*batch.columns)
    ranges = snapshot(
        old.groupBy("partition").agg(F.min("offset").alias("resume"), (F.max("offset") + 1).alias("bound")), "late")
    new = marked.where("not _old").select(*batch.columns)
    if ranges.isEmpty():
        return new
    landed = batch.sparkSession.read.schema(LANDED_SCHEMA).parquet(landed_path).where(F.col("batch_id") < batch_id)
    earlier = read_slice(landed, ranges).select(*RECORD_ID)
    return new.unionByName(old.join(earlier, RECORD_ID, "left_anti").select(*batch.columns))


def _begin_name(topic: str) -> str:
    return f"{topic}#begin"  # no topic name holds '#'


def _fixed_begin(
    spark: SparkSession, read: ReadOptions, state_path: str, known: DataFrame | None, marks: DataFrame | None
) -> str | None:
    """The token of where the stream began, found on its first start and stored; None for the earliest record."""
    text, _ = load_token(spark, state_path, _begin_name(read.topic))
    if text is not None:
        return text
    if read.start == "earliest" or load_token(spark, state_path, read.topic)[0] is not None:
        return None
    if known is None:
        raise FeedRefused(f"topic '{read.topic}': to begin at 'start' a stream needs the log as a table too")
    marks = snapshot(watermarks(known) if marks is None else marks, "marks")
    at = offsets_at(known, read.start) if isinstance(read.start, datetime) else None
    plan = resume_plan(marks, None, read.start, at).select("partition", F.col("resume").alias("bound"))
    token = advance_token(read.topic, plan).withColumn("topic", F.lit(_begin_name(read.topic)))
    store_token(token, state_path, 0)
    return load_token(spark, state_path, _begin_name(read.topic))[0]


def _from_begin(batch: DataFrame, begin: DataFrame | None) -> DataFrame:
    """The batch without records from before the stream's begin; a partition that came later is read from its first record."""
    if begin is None:
        return batch
    first = begin.select("partition", F.col("next_offset").alias("_begin"))
    kept = F.coalesce(F.col("offset") >= F.col("_begin"), F.lit(True))
    return batch.join(first, "partition", "left").where(kept).select(*batch.columns)


def stream_land(
    log: DataFrame, read: ReadOptions, landed_path: str, state_path: str, checkpoint: str,
    known: DataFrame | None = None, marks: DataFrame | None = None,
) -> StreamingQuery:
    """Land each record once, however often it is delivered, and keep the offset token of each batch.

    The state is one token per batch, not one entry per record, and no record is dropped for being
    late. A batch lands in its own folder, replaced when the batch runs again, and is judged by the
    token stored before it, so a retry gives the same rows. The three paths belong together.

    A ``start`` at the latest record or at an instant needs the log as a table, ``known``, when the stream starts for the
    first time, and ``marks`` where a catalogue knows them better. The offsets where it begins are stored before the first
    batch and hold for all later ones and for restarts, whatever ``start`` says then: a copy from before them never lands.
    """
    begin_text = _fixed_begin(use_utc(log.sparkSession), read, state_path, known, marks)

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        begin = parse_token(spark, begin_text, read.topic)
        batch = _from_begin(batch, begin)
        _, last_run = load_token(spark, state_path, read.topic)
        if last_run > batch_id + 1:
            raise FeedRefused(f"topic '{read.topic}': the stored state is ahead of the checkpoint; use new paths")
        text, _ = load_token(spark, state_path, read.topic, up_to=batch_id)
        stored = parse_token(spark, text, read.topic)
        landed = envelope(_unseen(batch, stored, landed_path, batch_id), read.encoding)
        landed.write.mode("overwrite").parquet(f"{landed_path}/batch_id={batch_id}")
        reached = batch.groupBy("partition").agg((F.max("offset") + 1).alias("bound"))
        earlier = begin if stored is None else stored
        if earlier is not None:
            reached = reached.unionByName(earlier.withColumnRenamed("next_offset", "bound"))
            reached = reached.groupBy("partition").agg(F.max("bound").alias("bound"))
        store_token(advance_token(read.topic, reached), state_path, batch_id + 1)

    return (
        log.writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_append(
    rows: DataFrame, path: str, checkpoint: str, write: WriteOptions, partition: Column, order: str | None = None,
    keep: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append each batch of a stream to a log table, at least once, numbering on from its high watermarks.

    ``partition`` may use the record's key and the columns of ``rows`` named in ``keep``.
    """
    def append_batch(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        kept = tuple(dict.fromkeys((*keep, *(() if order is None else (order,)))))
        append_to_log(to_records(batch, write, kept), path, write, partition, order, log_highs(spark, path, write.topic))

    return (
        rows.writeStream.foreachBatch(append_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
