"""Topics with a catalogue: committed appends, exact marks, the file index, and landings that a crash cannot double."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from rows import pairs
from tidelog.errors import FeedRefused
from tidelog.operators.bounds import landed_problems
from tidelog.options import ReadOptions, WriteOptions
from tidelog.plans import feed as feeds
from tidelog.plans.feed import feed_run, feed_topic, land, land_topic, landed_rows, write_run
from tidelog.plans.state import load_token
from tidelog.schema import BOUNDS_DDL
from tidelog.sinks.records import to_records
from tidelog.sources import catalogue
from tidelog.sources.catalogue import (
    FILES_DDL, catalogue_marks, commit_append, create_topic, expected_records, files_gone, limited_bounds, load_committed, log_files,
    offsets_at_indexed, raise_low,
)

TIDES = ReadOptions("tides")
WRITE = WriteOptions.parse("tides", {"key": "id"})


@pytest.fixture
def topic(spark, tmp_path):
    """A topic of three partitions; the last never gets a record. Record i lies in partition i % 2 and is i minutes old."""
    class Topic:
        path, landed, state = (str(tmp_path / n) for n in ("topic", "landed", "state"))

        def __init__(self):
            create_topic(spark, self.path, "tides", 3)

        def append(self, start, stop, lane=None):
            rows = spark.range(start, stop).withColumn("seq", F.col("id"))
            records = to_records(rows, WRITE, keep=("seq",))
            moment = F.lit("2026-09-07 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("seq").cast("int"))
            return commit_append(records, self.path, WRITE, F.col("seq") % 2 if lane is None else lane, "seq", moment)

        def marks(self):
            return pairs(catalogue_marks(spark, self.path, "tides"), "partition", "low", "high")

        def expire(self, *lows):
            raise_low(spark, self.path, "tides", spark.createDataFrame(lows, "partition int, low bigint"))

        def land(self, **more):
            return land_topic(spark, self.path, TIDES, self.landed, self.state, **more)

        def rows(self):
            return pairs(landed_rows(spark, self.landed, self.state, "tides"), "partition", "offset", "key")

        def token(self):
            return load_token(spark, self.state, "tides")[0]
    return Topic()


def records(upto, start=0):
    return [(i % 2, i // 2, str(i)) for i in range(start, upto)]


def test_marks_come_from_the_catalogue(spark, topic):
    assert topic.marks() == [(0, 0, 0), (1, 0, 0), (2, 0, 0)]
    assert topic.land() == 0 and topic.token() == '{"v":1,"topic":"tides","partitions":{"0":0,"1":0,"2":0}}'
    result = topic.append(0, 11)
    assert result.rows == 11 and result.batches == log_files(spark, topic.path, "tides").count() > 0
    topic.append(11, 20)
    assert topic.marks() == [(0, 0, 10), (1, 0, 10), (2, 0, 0)]
    assert pairs(load_committed(spark, topic.path, "tides"), "partition", "offset") == sorted((p, o) for p, o, _ in records(20))
    topic.expire((0, 4), (1, 99), (2, 5))
    assert topic.marks() == [(0, 4, 10), (1, 10, 10), (2, 0, 0)]
    topic.expire((0, 1))  # a low never falls
    assert topic.marks() == [(0, 4, 10), (1, 10, 10), (2, 0, 0)]
    assert {r["partition"] for r in files_gone(spark, topic.path, "tides").collect()} == {1}
    create_topic(spark, topic.path, "tides", 5)
    assert topic.marks()[3:] == [(3, 0, 0), (4, 0, 0)]
    with pytest.raises(ValueError, match="cannot become fewer"):
        create_topic(spark, topic.path, "tides", 2)


def test_unknown_topics_and_partitions_are_refused(spark, topic):
    other = WriteOptions.parse("ebbs", {"key": "id"})
    rows = to_records(spark.range(3).withColumn("seq", F.col("id")), other, keep=("seq",))
    with pytest.raises(FeedRefused, match="no topic 'ebbs'"):
        commit_append(rows, topic.path, other, F.lit(0), "seq")
    with pytest.raises(FeedRefused, match="no topic 'ebbs'"):
        feed_topic(spark, topic.path, ReadOptions("ebbs"))
    for lane, said in ((F.lit(3), "has no partition 3"), (F.lit(None), "has no partition null")):
        with pytest.raises(Exception, match=said):
            topic.append(0, 4, lane)
    assert topic.marks() == [(0, 0, 0), (1, 0, 0), (2, 0, 0)] and load_committed(spark, topic.path, "tides").count() == 0


def test_an_interrupted_append_leaves_nothing(spark, topic, monkeypatch):
    topic.append(0, 6)
    with monkeypatch.context() as m:
        m.setattr(catalogue, "_store_marks", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            topic.append(6, 30)
    assert topic.marks() == [(0, 0, 3), (1, 0, 3), (2, 0, 0)]
    assert load_committed(spark, topic.path, "tides").count() == 6 and log_files(spark, topic.path, "tides").agg(F.sum("records")).head()[0] == 6
    topic.append(6, 8, F.lit(0))  # touches partition 0 only, yet replaces what lay in partition 1 too
    assert topic.marks() == [(0, 0, 5), (1, 0, 3), (2, 0, 0)]
    assert pairs(load_committed(spark, topic.path, "tides"), "partition", "offset") == [(0, o) for o in range(5)] + [(1, o) for o in range(3)]


def test_a_landing_that_was_interrupted_is_replaced(spark, topic, monkeypatch):
    topic.append(0, 7)
    assert topic.land() == 7
    topic.append(7, 12)
    with monkeypatch.context() as m:
        m.setattr(feeds, "store_token", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            topic.land()
    assert topic.rows() == sorted(records(7))  # written, not committed
    topic.append(12, 15)
    assert topic.land() == 8 and topic.rows() == sorted(records(15))
    assert spark.read.parquet(topic.landed).count() == 15
    assert topic.land() == 0 and topic.land(full_refresh=True) == 15


def test_a_log_without_a_catalogue_lands_once_too(spark, make_log, tmp_path, monkeypatch):
    landed, state, orders = str(tmp_path / "landed"), str(tmp_path / "state"), ReadOptions("orders")
    log = make_log([(0, o, str(o), "x") for o in (2, 3, 9)])
    with monkeypatch.context() as m:
        m.setattr(feeds, "store_token", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            land(log, orders, landed, state)
    assert landed_rows(spark, landed, state, "orders").count() == 0
    assert land(log, orders, landed, state) == 3
    assert pairs(landed_rows(spark, landed, state, "orders"), "offset", "run") == [(2, 1), (3, 1), (9, 1)]


def test_expired_records_that_were_read_are_no_reason_to_refuse(make_log):
    orders = ReadOptions("orders")
    first = feed_run(make_log([(0, 0, None, "a"), (0, 4, None, "b")]), orders)
    later = feed_run(make_log([(0, 9, None, "c")]), orders, first.token_text())  # offsets 5 to 8 never were
    assert pairs(later.envelope, "offset") == [(9,)] and '"0":10' in later.token_text()


def test_retention_during_the_read_refuses_the_run(spark, topic, monkeypatch):
    topic.append(0, 10)
    real = feeds.write_run

    def slow(*args):
        topic.expire((0, 3))
        return real(*args)
    with monkeypatch.context() as m:
        m.setattr(feeds, "write_run", slow)
        with pytest.raises(FeedRefused, match="partition 0.*retention outran"):
            topic.land()
    assert topic.token() is None and topic.rows() == []
    assert topic.land() == 7


def test_a_slice_with_records_missing_is_refused(spark, topic, make_log, tmp_path):
    topic.append(0, 10)
    plan = feed_topic(spark, topic.path, TIDES)
    assert pairs(plan.proof, "partition", "records") == [(0, 5), (1, 5)]
    short = feeds.replace(plan, envelope=plan.envelope.where("not (partition = 1 and offset = 2)"))
    with pytest.raises(FeedRefused, match="partition 1, retention outran this run, which read 4 of 5 records"):
        write_run(short, topic.landed, 1)
    log = make_log([(p, o, None, "x") for p in (0, 1) for o in (3, 5, 8)])
    whole = feed_run(log, ReadOptions("orders"))
    assert sorted(map(tuple, whole.proof.collect())) == [(0, 3, 8, None), (1, 3, 8, None)]
    for missing, where in ((3, "offset 3"), (8, "offset 8")):
        short = feeds.replace(whole, envelope=whole.envelope.where(F.col("offset") != missing))
        with pytest.raises(FeedRefused, match=f"partition 0, retention outran this run, for the record at {where}"):
            write_run(short, str(tmp_path / "other"), 1)
    assert write_run(whole, str(tmp_path / "other"), 1) == 6
    gone = landed_problems(whole.proof, spark.createDataFrame([(0, 3, 3, 8)], "partition int, n bigint, head bigint, tail bigint"))
    assert [r["partition"] for r in gone.collect()] == [1]


def test_many_partitions_prove_themselves_from_what_was_written(spark, topic, monkeypatch):
    topic.append(0, 10)
    monkeypatch.setattr(feeds, "LITERAL_RANGES", 1)
    plan = feed_topic(spark, topic.path, TIDES)
    assert write_run(plan, topic.landed, 1) == 10
    with pytest.raises(FeedRefused, match="read 4 of 5"):
        write_run(feeds.replace(plan, envelope=plan.envelope.where("not (partition = 0 and offset = 4)")), topic.landed, 1)


def at(minute):
    return datetime(2026, 9, 7, minute // 60, minute % 60, tzinfo=timezone.utc)


def test_a_start_time_reads_candidate_files_only(spark, topic, monkeypatch):
    for start in range(0, 60, 12):
        topic.append(start, start + 12)
    for minute in (0, 1, 11, 12, 30, 59, 60):
        want = {}
        for p, o, key in records(60):
            if int(key) >= minute:
                want[p] = min(o, want.get(p, o))
        found = offsets_at_indexed(spark, topic.path, "tides", at(minute))
        assert dict(pairs(found, "partition", "at")) == want
        assert len(found.inputFiles()) <= 2 + len(catalogue_marks(spark, topic.path, "tides").inputFiles())
        with monkeypatch.context() as m:
            m.setattr(catalogue, "LISTED_FILES", 0)
            assert dict(pairs(offsets_at_indexed(spark, topic.path, "tides", at(minute)), "partition", "at")) == want
    topic.expire((0, 20))  # within a file
    assert dict(pairs(offsets_at_indexed(spark, topic.path, "tides", at(0)), "partition", "at")) == {0: 20, 1: 0}
    run = feed_topic(spark, topic.path, ReadOptions("tides", at(30)))
    assert pairs(run.bounds, "partition", "resume", "bound") == [(0, 20, 30), (1, 15, 30), (2, 0, 0)]
    again = feed_topic(spark, topic.path, ReadOptions("tides", at(30)), '{"v":1,"topic":"tides","partitions":{"0":29,"2":0}}')
    assert pairs(again.bounds, "partition", "resume") == [(0, 29), (1, 15), (2, 0)]


def test_limited_runs_cover_the_log_once(spark, topic):
    topic.append(0, 10)
    topic.append(10, 40)
    topic.append(40, 45, F.lit(2))
    token, seen, sizes = None, [], []
    while True:
        plan = feed_topic(spark, topic.path, TIDES, token, max_records=12)
        token = plan.token_text()
        got = pairs(plan.envelope, "partition", "offset")
        if not got:
            break
        seen += got
        sizes.append(len(got))
    assert sorted(seen) == pairs(load_committed(spark, topic.path, "tides"), "partition", "offset") and len(set(seen)) == len(seen)
    assert max(sizes) <= 12 and len(sizes) <= 5 and sum(sizes) == 45
    one = feed_topic(spark, topic.path, TIDES, max_bytes=1)
    assert one.envelope.count() == 3  # a record of each partition, so that every run moves
    with pytest.raises(ValueError):
        feed_topic(spark, topic.path, TIDES, max_records=0).envelope.count()


def test_limits_and_proofs_over_files_with_gaps(spark):
    moment = datetime(2026, 9, 7)
    files = spark.createDataFrame([
        (0, "a", 0, 10, 10, 100, moment, moment), (0, "b", 10, 40, 6, 60, moment, moment), (0, "c", 40, 50, 10, 100, moment, moment),
        (1, "d", 0, 8, 2, 20, moment, moment)], FILES_DDL)
    bounds = spark.createDataFrame([(0, 2, 50), (1, 0, 8), (2, 5, 5)], BOUNDS_DDL)
    assert pairs(expected_records(files, bounds), "partition", "records") == [(0, 24), (1, 2)]
    cut = spark.createDataFrame([(0, 2, 20), (1, 0, 8)], BOUNDS_DDL)
    assert pairs(expected_records(files, cut), "partition", "records") == [(1, 2)]  # b is cut and has gaps

    def upto(n, **more):
        return pairs(limited_bounds(bounds, files, n, **more), "partition", "bound")
    assert upto(26) == [(0, 50), (1, 8), (2, 5)]
    assert upto(12) == [(0, 10), (1, 8), (2, 5)]  # 8 of a; b would be 6 more and cannot be cut
    assert upto(16) == [(0, 40), (1, 8), (2, 5)] and upto(18) == [(0, 42), (1, 8), (2, 5)]  # c can be cut
    assert upto(2) == [(0, 3), (1, 8), (2, 5)]  # the first file of a partition is taken whole where it has gaps
    assert upto(None, max_bytes=120) == [(0, 10), (1, 8), (2, 5)] and upto(None) == [(0, 50), (1, 8), (2, 5)]
