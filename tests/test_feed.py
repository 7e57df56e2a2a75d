from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rows import pairs
from tidelog.errors import FeedRefused
from tidelog.options import ReadOptions, WriteOptions
from tidelog.plans.feed import feed_run, land
from tidelog.plans.state import load_token, store_token, stored_tokens
from tidelog.schema import WATERMARKS_DDL
from tidelog.session import scratch_path, snapshot, stage, use_footer_statistics
from tidelog.sinks.append import append_to_log, log_highs
from tidelog.sinks.records import to_records
from tidelog.sources.logs import load_log, watermarks

ORDERS = ReadOptions("orders")


def marks(spark, *rows):
    return spark.createDataFrame(rows, WATERMARKS_DDL)


@pytest.fixture
def feed(spark, tmp_path):
    """Runs over growing logs, with the landed rows and the stored token at hand."""
    class Feed:
        landed_path, state_path = str(tmp_path / "landed"), str(tmp_path / "state")

        def run(self, log, read=ORDERS, **more):
            return land(log, read, self.landed_path, self.state_path, **more)

        def landed(self):
            return pairs(spark.read.parquet(self.landed_path), "partition", "offset", "value")

        def token(self):
            return load_token(spark, self.state_path, "orders")[0]
    return Feed()


def test_first_run_second_run_and_a_run_with_nothing_new(spark, make_log, feed):
    first = [(1, 4, None, "ebb"), (3, 0, None, "slack"), (3, 2, None, "flood")]
    known = marks(spark, (0, 6, 6), (1, 4, 5), (3, 0, 3))
    assert feed.run(make_log(first), marks=known) == 3
    assert feed.token() == '{"v":1,"topic":"orders","partitions":{"0":6,"1":5,"3":3}}'
    more = [(0, 6, None, "neap"), (0, 7, None, "spring"), (1, 5, None, "ebb")]
    assert feed.run(make_log(first + more)) == 3
    token = feed.token()
    assert token == '{"v":1,"topic":"orders","partitions":{"0":8,"1":6,"3":3}}'
    assert feed.run(make_log(first + more)) == 0
    assert feed.token() == token
    assert feed.landed() == [(p, o, v) for p, o, _, v in sorted(first + more, key=lambda r: r[:2])]


def test_records_past_the_planned_bound_wait_for_the_next_run(spark, make_log):
    log = make_log([(0, o, None, str(o)) for o in range(10)])
    run = feed_run(log, ORDERS, marks=marks(spark, (0, 0, 6)))
    assert pairs(run.envelope, "offset") == [(o,) for o in range(6)]
    rest = feed_run(log, ORDERS, token=run.token_text())
    assert pairs(rest.envelope, "offset") == [(o,) for o in range(6, 10)]


def test_latest_lands_nothing_and_remembers(make_log, feed):
    log = [(0, 0, None, "a"), (0, 1, None, "b")]
    assert feed.run(make_log(log), ReadOptions("orders", "latest")) == 0
    assert feed.run(make_log([*log, (0, 2, None, "c")]), ReadOptions("orders", "latest")) == 1
    assert feed.landed() == [(0, 2, "c")]


def test_an_emptied_partition_keeps_its_place(make_log, feed):
    latest = ReadOptions("orders", "latest")
    feed.run(make_log([(0, 6, None, "p"), (1, 3, None, "q")]), ReadOptions("orders"))
    assert feed.run(make_log([(0, 6, None, "p"), (0, 7, None, "r")]), latest) == 1
    assert feed.run(make_log([(0, 7, None, "r"), (1, 4, None, "s"), (1, 5, None, "t")]), latest) == 2
    assert feed.run(make_log([]), latest) == 0
    assert feed.run(make_log([(1, 6, None, "u")]), latest) == 1


def test_appends_go_on_where_the_log_ends(spark, tmp_path):
    path, write = str(tmp_path / "log"), WriteOptions.parse("orders", {"value": "v"})
    rows = to_records(spark.createDataFrame([("a", 5, 1), ("b", 9, 1)], "v string, n long, lane int"), write, keep=("n", "lane"))
    for _ in range(2):
        append_to_log(rows, path, write, F.col("lane"), "n")
    assert pairs(load_log(spark, path), "partition", "offset") == [(1, 0), (1, 1), (1, 2), (1, 3)]
    with pytest.raises(Exception, match="no partition"):
        append_to_log(rows, path, write, F.lit(None).cast("int"), "n")


def test_a_timestamp_start_and_a_partition_added_later(make_log):
    days = [datetime(2026, 1, d) for d in (1, 2, 3)]
    log = make_log([(p, i, None, f"{p}{i}", None, day) for p in (0, 1) for i, day in enumerate(days)])
    read = ReadOptions.parse("orders", {"start": "2026-01-02"})
    assert pairs(feed_run(log, read).envelope, "value") == [("01",), ("02",), ("11",), ("12",)]
    again = feed_run(log, read, token='{"v":1,"topic":"orders","partitions":{"0":0}}')
    assert pairs(again.envelope, "value") == [("00",), ("01",), ("02",), ("11",), ("12",)]


def test_gaps_do_not_stop_a_run(make_log):
    run = feed_run(make_log([(0, 0, None, "a"), (0, 7, None, "b")]), ORDERS)
    assert run.envelope.count() == 2
    assert '"0":8' in run.token_text()


def test_an_open_transaction_shortens_the_token_and_is_read_next_time(spark, make_log, feed):
    log = make_log([(0, o, None, str(o)) for o in range(5)])
    stops = spark.createDataFrame([(0, 3)], "partition int, stop_offset bigint")
    assert feed.run(log, stops=stops) == 3
    assert feed.token() == '{"v":1,"topic":"orders","partitions":{"0":3}}'
    assert feed.run(log) == 2


def test_lost_and_reset_offsets_are_refused_and_change_nothing(spark, make_log, feed):
    log = make_log([(p, o, None, "x") for p in (0, 1) for o in range(4)])
    feed.run(log)
    before = feed.token()
    for moved, why in (((0, 5, 9), "retention"), ((0, 0, 2), "reset")):
        with pytest.raises(FeedRefused, match=why):
            feed.run(log, marks=marks(spark, moved, (1, 0, 4)))
    assert feed.token() == before and len(feed.landed()) == 8


def test_full_refresh_starts_over(make_log, feed):
    log = make_log([(0, 0, None, "a"), (0, 1, None, "b")])
    assert [feed.run(log), feed.run(log), feed.run(log, full_refresh=True)] == [2, 0, 2]


def test_bad_bytes_refuse_the_run_by_record_and_keep_the_token(make_log, feed):
    good = [(0, 0, None, "a")]
    feed.run(make_log(good))
    before = feed.token()
    with pytest.raises(FeedRefused, match="topic 'orders' partition 0 offset 1: its value "):
        feed.run(make_log([*good, (0, 1, None, b"\xff\xfe\x00")]))
    assert feed.token() == before and feed.landed() == [(0, 0, "a")]
    assert feed.run(make_log([*good, (0, 1, None, b"\xff\xfe\x00")]), ReadOptions("orders", encoding="base64")) == 1
    assert feed.landed() == [(0, 0, "a"), (0, 1, "//4A")]


def test_retention_while_reading_keeps_the_token(spark, make_log, feed):
    log = make_log([(0, o, None, "x") for o in range(4)])
    with pytest.raises(FeedRefused, match="partition 0.*retention"):
        feed.run(log, fresh_marks=lambda: marks(spark, (0, 2, 9)))
    assert feed.token() is None
    assert feed.run(log, fresh_marks=lambda: marks(spark, (0, 0, 9))) == 4


def test_bounds_too_many_for_the_driver_are_staged(spark, make_log, monkeypatch):
    log = make_log([(p, o, None, f"{p}-{o}") for p in range(6) for o in range(4)])
    token = '{"v":1,"topic":"orders","partitions":{"0":1,"1":2,"2":4}}'
    wanted = feed_run(log, ORDERS, token)
    monkeypatch.setattr("tidelog.plans.feed.small_rows", lambda df: None)
    monkeypatch.setattr("tidelog.operators.reading.SMALL_ROWS", 2)
    staged = feed_run(log, ORDERS, token)
    assert pairs(staged.envelope, "value") == pairs(wanted.envelope, "value")
    assert staged.token_text() == wanted.token_text()
    with pytest.raises(FeedRefused, match="partition 1.*reset"):
        feed_run(log, ORDERS, '{"v":1,"topic":"orders","partitions":{"1":9}}')


def test_a_token_of_another_topic_or_shape_is_refused(make_log):
    log = make_log([(0, 0)])
    for text in ('{"v":1,"topic":"other","partitions":{"0":0}}', "junk"):
        with pytest.raises(FeedRefused, match="token is unusable"):
            feed_run(log, ORDERS, token=text)


def test_an_empty_topic_is_refused(make_log):
    with pytest.raises(FeedRefused, match="no topic 'orders'"):
        feed_run(make_log([]), ORDERS)


def test_the_latest_token_of_each_topic_counts(spark, tmp_path):
    path = str(tmp_path / "state")
    assert load_token(spark, path, "a") == (None, 0)
    for topic, run in (("a", 1), ("b", 1), ("a", 2)):
        store_token(spark.createDataFrame([(topic, f"{topic}{run}")], "topic string, token string"), path, run)
    assert load_token(spark, path, "a") == ("a2", 2)
    assert load_token(spark, path, "c") == (None, 0)
    assert pairs(stored_tokens(spark, path), "topic", "token", "run") == [("a", "a2", 2), ("b", "b1", 1)]


def test_a_long_log_lands_whole_over_several_runs(spark, tmp_path, feed):
    """One partition, appended and landed in rounds of growing size."""
    path, write = str(tmp_path / "log"), WriteOptions.parse("orders", {"key": "id"})
    landed, edges = [], [0, 9_000, 30_000, 82_000]
    for start, stop in zip(edges, edges[1:]):
        rows = spark.range(start, stop).withColumn("text", F.repeat(F.col("id").cast("string"), 12))
        records = to_records(rows.withColumn("seq", F.col("id")), write, keep=("seq",))
        append_to_log(records, path, write, F.lit(0), "seq")
        landed.append(feed.run(load_log(spark, path, "orders")))
    assert landed == [9_000, 21_000, 52_000]
    rows = spark.read.parquet(feed.landed_path)
    bad = rows.where((F.col("offset") != F.col("key").cast("bigint"))
                     | (F.get_json_object("value", "$.text") != F.repeat("key", 12)))
    assert (rows.select("offset").distinct().count(), bad.count()) == (82_000, 0)
    assert feed.token() == '{"v":1,"topic":"orders","partitions":{"0":82000}}'


def test_slices_of_a_stored_log_skip_by_partition_and_offset(spark, tmp_path):
    path, write = str(tmp_path / "log"), WriteOptions.parse("orders", {"key": "id"})
    records = to_records(spark.range(100).withColumn("seq", F.col("id")), write, keep=("seq",))
    append_to_log(records, path, write, F.pmod("seq", F.lit(4)), "seq")
    log = load_log(spark, path, "orders")
    run = feed_run(log, ORDERS, token='{"v":1,"topic":"orders","partitions":{"0":25,"1":20,"2":25,"3":25}}')
    plan = run.envelope._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(offset,20)" in scan and "LessThan(offset,25)" in scan
    filters = scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "topic" in filters and "partition" in filters
    assert pairs(run.envelope, "partition", "offset") == [(1, o) for o in range(20, 25)]


def test_watermarks_of_a_stored_log_can_come_from_file_footers(spark, tmp_path):
    path, write = str(tmp_path / "log"), WriteOptions.parse("orders", {"key": "id"})
    for start in (0, 40):
        records = to_records(spark.range(start, start + 40).withColumn("seq", F.col("id")), write, keep=("seq",))
        append_to_log(records, path, write, F.pmod("seq", F.lit(3)), "seq", log_highs(spark, path, "orders"))
    other = use_footer_statistics(spark.newSession())
    marked = watermarks(load_log(other, path, "orders"))
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(offset), MAX(offset)]" in plan
    assert pairs(marked, "partition", "low", "high") == [(0, 0, 27), (1, 0, 27), (2, 0, 26)]
    run = feed_run(load_log(other, path, "orders"), ORDERS, '{"v":1,"topic":"orders","partitions":{"0":26,"1":26}}')
    assert pairs(run.envelope, "partition").count((2,)) == 26 and run.envelope.count() == 28


def test_small_tables_are_fixed_and_large_ones_staged_in_the_named_folder(spark):
    rows = spark.range(5)
    assert pairs(snapshot(rows, "t"), "id") == pairs(snapshot(rows, "t", limit=2), "id") == [(i,) for i in range(5)]
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch_path(spark, "x").startswith(named)
    assert stage(rows, "t").inputFiles()
