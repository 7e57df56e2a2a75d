import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rows import pairs
from tidelog.errors import FeedRefused
from tidelog.operators.reading import envelope
from tidelog.options import ReadOptions, WriteOptions
from tidelog.plans.state import load_token, stored_tokens
from tidelog.schema import LOG_SCHEMA
from tidelog.sinks.append import key_partition
from tidelog.sources.logs import load_log
from tidelog.streaming.stream import LANDED_SCHEMA, stream_append, stream_feed, stream_land


@pytest.fixture
def topic(spark, make_log, tmp_path):
    """A directory of log files, and runs of a stream over it."""
    class Topic:
        files, landed_path = str(tmp_path / "topic"), str(tmp_path / "landed")
        checkpoint = str(tmp_path / "checkpoint")

        def add(self, *rows):
            make_log(list(rows)).coalesce(1).write.mode("append").parquet(self.files)

        def stream(self, **options):
            return spark.readStream.schema(LOG_SCHEMA).options(**options).parquet(self.files)

        def run(self, stream=None):
            query = stream_feed(self.stream() if stream is None else stream, self.landed_path, self.checkpoint)
            query.awaitTermination()
            return sum(p["numInputRows"] for p in query.recentProgress)

        def landed(self):
            return pairs(spark.read.parquet(self.landed_path), "partition", "offset", "value")
    return Topic()


def test_each_run_lands_what_came_since(topic):
    topic.add((0, 0, None, "a"), (1, 0, None, "b"))
    assert topic.run() == 2
    assert topic.run() == 0
    topic.add((0, 1, None, "c"))
    assert topic.run() == 1
    assert topic.landed() == [(0, 0, "a"), (0, 1, "c"), (1, 0, "b")]


def test_batches_can_be_bounded_at_the_source(topic):
    for i in range(3):
        topic.add((0, i, None, str(i)))
    query = stream_feed(topic.stream(maxFilesPerTrigger="1"), topic.landed_path, topic.checkpoint)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]
    assert len(topic.landed()) == 3


def test_bad_bytes_stop_the_stream_and_land_nothing_of_their_batch(topic):
    topic.add((0, 0, None, "a"))
    topic.run()
    topic.add((0, 1, None, "b"), (0, 2, None, b"\xff"))
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="partition 0 offset 2"):
            topic.run()
    assert topic.landed() == [(0, 0, "a")]


@pytest.fixture
def land_once(spark, topic, tmp_path):
    paths = [str(tmp_path / n) for n in ("once", "state", "once-checkpoint")]

    def run(checkpoint=paths[2]):
        stream_land(topic.stream(maxFilesPerTrigger="1"), ReadOptions("orders"), *paths[:2], checkpoint).awaitTermination()
        landed = pairs(spark.read.parquet(paths[0]), "partition", "offset", "value")
        return landed, load_token(spark, paths[1], "orders")[0]
    return run


def test_redelivered_and_late_records_land_once_each(topic, land_once):
    topic.add((0, 0, None, "a"), (0, 3, None, "d"), (1, 0, None, "x"), (0, 0, None, "a"))
    assert land_once() == (
        [(0, 0, "a"), (0, 3, "d"), (1, 0, "x")], '{"v":1,"topic":"orders","partitions":{"0":4,"1":1}}')
    topic.add((0, 3, None, "d"), (0, 2, None, "c"), (0, 4, None, "e"), (0, 4, None, "e"))
    topic.add((0, 2, None, "c"), (2, 0, None, "z"))
    assert land_once() == (
        [(0, 0, "a"), (0, 2, "c"), (0, 3, "d"), (0, 4, "e"), (1, 0, "x"), (2, 0, "z")],
        '{"v":1,"topic":"orders","partitions":{"0":5,"1":1,"2":1}}')


def test_a_batch_that_runs_again_lands_the_same_rows(topic, land_once, tmp_path):
    topic.add((0, 0, None, "a"))
    topic.add((0, 1, None, "b"), (0, 0, None, "a"))
    before = land_once()
    # As after a crash between the stored token and Spark's commit of the last batch.
    (tmp_path / "once-checkpoint" / "commits" / "1").unlink()
    (tmp_path / "once-checkpoint" / "commits" / ".1.crc").unlink()
    assert land_once() == before


def test_state_ahead_of_its_checkpoint_is_refused(topic, land_once, tmp_path):
    for i in range(3):
        topic.add((0, i, None, str(i)))
    land_once()
    with pytest.raises(StreamingQueryException, match="ahead of the checkpoint"):
        land_once(str(tmp_path / "fresh-checkpoint"))


@pytest.mark.parametrize("start", ["latest", datetime(2025, 3, 2, tzinfo=timezone.utc)])
def test_a_stream_begins_where_it_is_told_and_stays_there(spark, topic, make_log, tmp_path, start):
    def add(*rows):
        first, second = datetime(2025, 3, 1), datetime(2025, 3, 3)
        make_log([(p, o, None, v, None, first if o < 2 else second) for p, o, v in rows]).coalesce(1).write.mode("append").parquet(
            topic.files)

    paths = [str(tmp_path / n) for n in ("late", "late-state", "late-checkpoint")]

    def run(begin, known=None):
        stream_land(topic.stream(), ReadOptions("orders", begin), *paths, known=known).awaitTermination()
        return pairs(spark.read.schema(LANDED_SCHEMA).parquet(paths[0]), "partition", "offset", "value")
    add((0, 0, "a"), (0, 1, "b"), (1, 0, "x"))
    with pytest.raises(FeedRefused, match="as a table"):
        run(start)
    assert run(start, spark.read.schema(LOG_SCHEMA).parquet(topic.files)) == []
    assert load_token(spark, paths[1], "orders")[0] == '{"v":1,"topic":"orders","partitions":{"0":2,"1":1}}'
    add((0, 1, "b"), (0, 2, "c"), (2, 0, "new"))
    assert run(start) == [(0, 2, "c"), (2, 0, "new")]
    add((0, 0, "a"), (0, 2, "c"), (1, 0, "x"), (1, 1, "y"), (2, 0, "new"))
    assert run("earliest") == [(0, 2, "c"), (1, 1, "y"), (2, 0, "new")]
    assert [r["topic"] for r in stored_tokens(spark, paths[1]).collect()] == ["orders"]


def test_a_stream_appends_to_a_log(spark, topic, tmp_path):
    out, write = str(tmp_path / "out"), WriteOptions.parse("copy", {"key": "offset"})
    for start in (0, 5):
        topic.add(*[(0, o, None, str(o)) for o in range(start, start + 5)])
        rows = topic.stream().select("offset", F.col("value").cast("string").alias("text"))
        stream_append(rows, out, str(tmp_path / "append"), write, key_partition(2)).awaitTermination()
    records = envelope(load_log(spark, out, "copy")).collect()
    assert sorted((int(r["key"]), json.loads(r["value"])["text"]) for r in records) == [(i, str(i)) for i in range(10)]
    for p in (0, 1):
        assert sorted(r["offset"] for r in records if r["partition"] == p) == list(
            range(sum(r["partition"] == p for r in records)))
