"""A stored log with a catalogue beside it: committed appends, watermarks that data cannot show, and an index of files.

Under the log's path lie, for each topic and commit number,

* ``topic=../commit=../partition=..``: the records, in files sorted by offset;
* ``_catalogue/files/topic=../commit=..``: a row for each of these files, with its offsets, record count, bytes and times;
* ``_catalogue/marks/topic=../slot=..``: low and high of every partition, as of the newest two commits in turns.

Marks are written last and are the commit. What an append left behind that stopped before is in no mark and is replaced
by the next one, which has the same number. One writer per topic at a time.
"""

from __future__ import annotations

from datetime import datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.errors import FeedRefused
from tidelog.operators.prefix import BLOCK_BITS
from tidelog.options import WriteOptions
from tidelog.schema import HEADERS_TYPE, LOG_SCHEMA
from tidelog.session import local_table, path_exists, small_rows, snapshot, stage
from tidelog.sinks.append import PARQUET_CODECS, WriteResult, append_offsets

MARKS_DDL = "partition int, low bigint, high bigint, commit bigint"
FILES_DDL = ("partition int, file string, first bigint, next bigint, records bigint, bytes bigint, "
             "least_time timestamp, greatest_time timestamp")
STORED_DDL = f"offset bigint, timestamp timestamp, key binary, value binary, headers {HEADERS_TYPE.simpleString()}, commit bigint, partition int"
LISTED_FILES = 10_000  # read by name; more are found by their offsets


def _topic_path(path: str, topic: str, kind: str = "") -> str:
    return f"{path}/{kind}topic={quote(topic, safe='')}"


def _marks_path(path: str, topic: str) -> str:
    return _topic_path(path, topic, "_catalogue/marks/")


def newest_commit(spark: SparkSession, path: str, topic: str) -> tuple[DataFrame, int]:
    """(marks, commit number) of a topic; one that was never created is refused by name."""
    folder = _marks_path(path, topic)
    found = spark.read.schema(f"{MARKS_DDL}, slot int").parquet(folder) if path_exists(spark, folder) else None
    newest = found.agg(F.max("commit")).head()[0] if found is not None else None
    if newest is None:
        raise FeedRefused(f"no topic '{topic}' here; create it before it is written or read")
    return snapshot(found.where(F.col("commit") == newest).select("partition", "low", "high"), "marks"), newest


def _store_marks(marks: DataFrame, path: str, topic: str, commit: int) -> None:
    rows = marks.select("partition", "low", "high", F.lit(commit).cast("bigint").alias("commit"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{_marks_path(path, topic)}/slot={commit % 2}")


def create_topic(spark: SparkSession, path: str, topic: str, partitions: int) -> None:
    """Make a topic with partitions 0 to ``partitions`` - 1, or give one that exists more of them."""
    if partitions < 1:
        raise ValueError("a topic has one partition at least")
    fresh = spark.range(partitions).select(
        F.col("id").cast("int").alias("partition"), F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high"))
    if not path_exists(spark, _marks_path(path, topic)):
        _store_marks(fresh, path, topic, 0)
        return
    marks, commit = newest_commit(spark, path, topic)
    if marks.agg(F.max("partition")).head()[0] >= partitions:
        raise ValueError(f"topic '{topic}' has these partitions already; they cannot become fewer")
    _store_marks(marks.unionByName(fresh.join(marks, "partition", "left_anti")), path, topic, commit + 1)


def catalogue_marks(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """(partition, low, high) of every partition, also of one that holds no record; no record is read for it."""
    return newest_commit(spark, path, topic)[0]


def commit_append(
    records: DataFrame,
    path: str,
    write: WriteOptions,
    partition: Column,
    order: str | None = None,
    timestamp: Column | None = None,
    bits: int = BLOCK_BITS,
) -> WriteResult:
    """Append ``records`` (of to_records) to a topic of the catalogue, all of them or none.

    As append_to_log, but numbers go on from the catalogue, an unknown topic or partition is refused, and an append that was
    interrupted leaves nothing behind: the next one takes its number and replaces its files.
    """
    spark = records.sparkSession
    marks, last = newest_commit(spark, path, write.topic)
    commit = last + 1
    known = marks.agg(F.max("partition")).head()[0]
    lane = partition.cast("int")
    unknown = F.raise_error(F.concat(
        F.lit(f"topic '{write.topic}' has no partition "), F.coalesce(lane.cast("string"), F.lit("null")))).cast("int")
    rows = records.withColumn("partition", F.when(lane.between(0, known), lane).otherwise(unknown)).withColumn(
        "timestamp", F.current_timestamp() if timestamp is None else timestamp.cast("timestamp"))
    if order is None:
        rows, order = stage(rows.withColumn("_order", F.monotonically_increasing_id()), "append"), "_order"
    seen = Observation()
    numbered = append_offsets(rows, marks, order, bits).select(*[n for n in LOG_SCHEMA.fieldNames() if n != "topic"])
    folder = f"{_topic_path(path, write.topic)}/commit={commit}"
    (
        numbered.observe(seen, F.count(F.lit(1)).alias("rows"))
        .sortWithinPartitions("partition", "offset")
        .write.mode("overwrite").option("compression", PARQUET_CODECS[write.compression])
        .partitionBy("partition").parquet(folder)
    )
    index = f"{_topic_path(path, write.topic, '_catalogue/files/')}/commit={commit}"
    _file_rows(spark, folder).coalesce(1).write.mode("overwrite").parquet(index)
    files = spark.read.schema(FILES_DDL).parquet(index)
    ends = files.groupBy("partition").agg(F.max("next").alias("end"))
    moved = marks.join(ends, "partition", "left").select("partition", "low", F.coalesce("end", "high").alias("high"))
    _store_marks(moved, path, write.topic, commit)
    return WriteResult(rows=seen.get["rows"], batches=files.count())


def _file_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What the index says of the files of a commit: two narrow columns of these files alone are read."""
    kept = spark.read.schema("offset bigint, timestamp timestamp, partition int").parquet(folder)
    return kept.groupBy("partition", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.min("offset").alias("first"), (F.max("offset") + 1).alias("next"), F.count(F.lit(1)).alias("records"),
        F.min("timestamp").alias("least_time"), F.max("timestamp").alias("greatest_time"),
    ).select("partition", "file", "first", "next", "records", "bytes", "least_time", "greatest_time")


def raise_low(spark: SparkSession, path: str, topic: str, lows: DataFrame) -> None:
    """Retention: records before ``lows`` (partition, low) count as gone. A low never falls and never passes the high.

    The files themselves are the owner's to delete, see ``files_gone``.
    """
    marks, commit = newest_commit(spark, path, topic)
    wanted = lows.select("partition", F.col("low").alias("wanted"))
    moved = marks.join(wanted, "partition", "left").select(
        "partition", F.least(F.greatest("low", F.coalesce("wanted", "low")), F.col("high")).alias("low"), "high")
    _store_marks(snapshot(moved, "marks"), path, topic, commit + 1)


def log_files(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """The index of a topic: committed files that hold a retained record, a row each."""
    marks, last = newest_commit(spark, path, topic)
    folder = _topic_path(path, topic, "_catalogue/files/")
    if not path_exists(spark, folder):
        return local_table(spark, [], FILES_DDL)
    files = spark.read.schema(f"{FILES_DDL}, commit bigint").parquet(folder).where(F.col("commit") <= last)
    return files.join(marks.select("partition", "low"), "partition").where(F.col("next") > F.col("low")).drop("low", "commit")


def files_gone(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """(partition, file) of committed files that retention has passed whole."""
    marks, last = newest_commit(spark, path, topic)
    folder = _topic_path(path, topic, "_catalogue/files/")
    if not path_exists(spark, folder):
        return local_table(spark, [], "partition int, file string")
    files = spark.read.schema(f"{FILES_DDL}, commit bigint").parquet(folder).where(F.col("commit") <= last)
    return files.join(marks.select("partition", "low"), "partition").where(F.col("next") <= F.col("low")).select("partition", "file")


def _as_topic(stored: DataFrame, topic: str) -> DataFrame:
    return stored.select(F.lit(topic).alias("topic"), *LOG_SCHEMA.fieldNames()[1:])


def load_committed(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """The committed records of a topic, with partition and commit as folders that a slice prunes."""
    _, last = newest_commit(spark, path, topic)
    folder = _topic_path(path, topic)
    if not path_exists(spark, folder):
        return local_table(spark, [], LOG_SCHEMA)
    stored = spark.read.schema(STORED_DDL).parquet(folder)
    return _as_topic(stored.where(F.col("commit") <= last), topic)


def offsets_at_indexed(spark: SparkSession, path: str, topic: str, moment: datetime, partitions: DataFrame | None = None) -> DataFrame:
    """(partition, at): the earliest retained offset whose record time is at or after ``moment``.

    In offset order the first file whose greatest time reaches the moment holds it, so one file of each partition is
    read; ``partitions`` says which ones are asked for. Partitions without such a file are left out.
    """
    files = log_files(spark, path, topic)
    if partitions is not None:
        files = files.join(partitions.select("partition").distinct(), "partition", "left_semi")
    later = F.col("timestamp") >= F.lit(moment).cast("timestamp")
    # A file that reaches back before the low mark may meet the moment with an expired record only, so the file after is asked too.
    marks = catalogue_marks(spark, path, topic).select("partition", "low")
    reached = files.where(F.col("greatest_time") >= F.lit(moment).cast("timestamp")).join(marks, "partition")
    first_whole = F.min(F.when(F.col("first") >= F.col("low"), F.col("first")))
    held = reached.groupBy("partition").agg(first_whole.alias("whole"))
    asked = reached.join(held, "partition").where((F.col("first") < F.col("low")) | (F.col("first") == F.col("whole")))
    rows = small_rows(asked.select("file"), LISTED_FILES)
    if rows == []:
        return local_table(spark, [], "partition int, at bigint")
    if rows is not None:
        stored = spark.read.schema(STORED_DDL).option("basePath", _topic_path(path, topic)).parquet(*sorted(r["file"] for r in rows))
        records = stored.join(marks, "partition").where(F.col("offset") >= F.col("low"))
    else:
        ranges = asked.select("partition", "first", "next", "low")
        records = load_committed(spark, path, topic).join(ranges, "partition").where(
            (F.col("offset") >= F.greatest("first", "low")) & (F.col("offset") < F.col("next")))
    return records.where(later).groupBy("partition").agg(F.min("offset").alias("at"))


def expected_records(files: DataFrame, bounds: DataFrame) -> DataFrame:
    """(partition, records) that a slice has to hold, for the partitions whose bounds cut no file with gaps.

    A file without gaps holds a record for each of its offsets, so a part of it is counted too.
    """
    inside = files.join(bounds, "partition").where(
        (F.col("next") > F.col("resume")) & (F.col("first") < F.col("bound")) & (F.col("resume") < F.col("bound")))
    whole = (F.col("first") >= F.col("resume")) & (F.col("next") <= F.col("bound"))
    dense = F.col("records") == F.col("next") - F.col("first")
    part = F.least("next", "bound") - F.greatest("first", "resume")
    return inside.groupBy("partition").agg(
        F.sum(F.when(whole, F.col("records")).when(dense, part)).alias("records"),
        F.bool_and(whole | dense).alias("known")).where("known").select("partition", "records")


def limited_bounds(bounds: DataFrame, files: DataFrame, max_records: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """(partition, resume, bound) of one run with ``max_records`` and ``max_bytes`` at most, shared fairly.

    Every partition gets the same share; what a short one leaves goes to the others. A file without gaps is cut at the record, another
    one is taken whole, and the first of a partition always, so that each run moves. Only the index is read.
    """
    if max_records is None and max_bytes is None:
        return bounds
    if (max_records is not None and max_records < 1) or (max_bytes is not None and max_bytes < 1):
        raise ValueError("a limit is 1 at least")
    inside = files.join(bounds, "partition").where((F.col("next") > F.col("resume")) & (F.col("first") < F.col("bound")))
    begin, end = F.greatest("first", "resume"), F.least("next", "bound")
    dense = F.col("records") == F.col("next") - F.col("first")
    n = F.when(dense, end - begin).otherwise(F.col("records"))
    costs = [] if max_records is None else [F.lit(1.0 / max_records)]
    costs += [] if max_bytes is None else [F.col("bytes") / F.col("records") / F.lit(float(max_bytes))]
    one = costs[0] if len(costs) == 1 else F.greatest(*costs)  # a record's part of what a run may read
    walk = Window.partitionBy("partition").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    entries = inside.select("partition", begin.alias("begin"), end.alias("end"), dense.alias("dense"), one.alias("one"), n.alias("n"))
    entries = entries.withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("one")).over(walk), F.lit(0.0)))
    totals = entries.groupBy("partition").agg(F.sum(F.col("n") * F.col("one")).alias("cost"))
    rows = small_rows(totals)
    share = _fair_share([r["cost"] for r in rows]) if rows is not None else 1.0 / totals.count()
    room = F.floor((F.lit(share) - F.col("before")) / F.col("one") + 1e-6)
    cut = F.when(F.col("before") + F.col("n") * F.col("one") <= share + 1e-12, F.col("end")).when(
        F.col("dense"), F.col("begin") + F.greatest(room, F.when(F.col("before") == 0, 1).otherwise(0))).when(F.col("before") == 0, F.col("end"))
    taken = entries.select("partition", F.when(F.col("before") <= share, cut).alias("upto")).groupBy("partition").agg(F.max("upto").alias("upto"))
    # Without files in the way, as in an expired stretch, the bound stays.
    return bounds.join(taken, "partition", "left").select(
        "partition", "resume", F.least("bound", F.greatest(F.coalesce("upto", "bound"), "resume")).cast("bigint").alias("bound"))


def _fair_share(costs: list[float]) -> float:
    """The level up to which everyone may go so that all together cost 1."""
    left, share = 1.0, 0.0
    for k, cost in enumerate(sorted(costs)):
        share = left / (len(costs) - k)
        if cost > share:
            return share
        left -= cost
    return max(costs, default=1.0)

