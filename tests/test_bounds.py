from datetime import datetime, timezone

import pytest

from rows import pairs
from tidelog.errors import FeedRefused
from tidelog.operators.bounds import (
    bound_problems, check_after_read, consumer_lag, effective_bounds, read_bounds, refuse_problems,
    unfinished, vanished_partitions,
)
from tidelog.schema import BOUNDS_DDL, TOKEN_DDL, WATERMARKS_DDL
from tidelog.sources.logs import discover_partitions, offsets_at, watermarks

WHEN = datetime(1970, 1, 1, tzinfo=timezone.utc)


def marks(spark, *rows):
    return spark.createDataFrame(rows, WATERMARKS_DDL)


def token(spark, offsets):
    return spark.createDataFrame(sorted(offsets.items()), TOKEN_DDL)


def listed(bounds):
    return [tuple(r) for r in bounds.collect()]


def test_earliest_starts_low_and_an_empty_partition_is_finished(spark):
    bounds = read_bounds(marks(spark, (1, 3, 3), (0, 17, 61)))
    assert listed(bounds) == [(0, 17, 61), (1, 3, 3)]
    assert listed(unfinished(bounds)) == [(0, 17, 61)]


def test_latest_starts_high(spark):
    assert listed(read_bounds(marks(spark, (0, 12, 57)), start="latest")) == [(0, 57, 57)]


@pytest.mark.parametrize("found, resume", [(31, 31), (4, 12), (80, 57), (-1, 57), (None, 57)])
def test_timestamp_start_is_clamped_and_unresolved_means_high(spark, found, resume):
    at = spark.createDataFrame([(0, found)], "partition int, at bigint")
    assert listed(read_bounds(marks(spark, (0, 12, 57)), start=WHEN, at=at)) == [(0, resume, 57)]


def test_partition_missing_from_the_timestamp_lookup_starts_high(spark):
    at = spark.createDataFrame([(0, 33)], "partition int, at bigint")
    bounds = read_bounds(marks(spark, (0, 12, 57), (1, 2, 26)), start=WHEN, at=at)
    assert listed(bounds) == [(0, 33, 57), (1, 26, 26)]


def test_stored_offset_wins_and_new_partitions_use_the_start(spark):
    bounds = read_bounds(marks(spark, (0, 12, 57), (1, 0, 7)), token(spark, {0: 29}), start="latest")
    assert listed(bounds) == [(0, 29, 57), (1, 7, 7)]


def test_stored_offsets_on_either_edge_are_fine(spark):
    bounds = read_bounds(marks(spark, (0, 12, 57), (1, 12, 57)), token(spark, {0: 12, 1: 57}))
    assert listed(bounds) == [(0, 12, 57), (1, 57, 57)]


def test_every_problem_is_in_one_refusal(spark):
    problems = bound_problems(
        marks(spark, (0, 12, 57), (1, 0, 5), (2, 0, 5)), token(spark, {0: 9, 1: 6, 2: 3}))
    assert pairs(problems, "partition", "stored") == [(0, 9), (1, 6)]
    with pytest.raises(FeedRefused) as refusal:
        refuse_problems("orders", problems.collect())
    text = str(refusal.value)
    assert "partition 0" in text and "retention" in text
    assert "partition 1" in text and "reset" in text
    assert "partition 2" not in text and not refusal.value.transient


def test_offsets_of_vanished_partitions_are_only_reported(spark):
    live, stored = marks(spark, (0, 0, 5)), token(spark, {0: 2, 9: 44})
    assert listed(vanished_partitions(live, stored)) == [(9, 44)]
    assert listed(read_bounds(live, stored)) == [(0, 2, 5)]


def test_effective_bounds_shorten_open_partitions_only(spark):
    planned = spark.createDataFrame([(0, 0, 5), (1, 4, 4), (2, 0, 5), (3, 2, 5)], BOUNDS_DDL)
    stops = spark.createDataFrame([(0, 3), (1, 2), (2, 9)], "partition int, stop_offset bigint")
    assert pairs(effective_bounds(planned, stops), "partition", "resume", "bound") == [
        (0, 0, 3), (1, 4, 4), (2, 0, 5), (3, 2, 5)]


def test_retention_during_the_read_is_refused(spark):
    planned = spark.createDataFrame([(0, 3, 9), (1, 5, 5)], BOUNDS_DDL)
    check_after_read("orders", planned, marks(spark, (0, 3, 20), (1, 7, 20)))
    with pytest.raises(FeedRefused, match="partition 0.*retention.*offset 3"):
        check_after_read("orders", planned, marks(spark, (0, 4, 20), (1, 7, 20)))


def test_lag(spark):
    lag = consumer_lag(marks(spark, (0, 0, 9), (1, 2, 6)), token(spark, {0: 4}))
    assert pairs(lag, "partition", "next_offset", "high", "lag") == [(0, 4, 9, 5), (1, 2, 6, 4)]


def test_watermarks_of_data_and_of_empty_partitions(spark, make_log):
    log = make_log([(0, 3), (0, 7), (2, 0)])
    assert pairs(watermarks(log), "partition", "low", "high") == [(0, 3, 8), (2, 0, 1)]
    known = spark.createDataFrame([(0,), (1,), (2,)], "partition int")
    assert pairs(watermarks(log, known), "partition", "low", "high") == [(0, 3, 8), (1, 0, 0), (2, 0, 1)]


def test_offsets_at_takes_the_earliest_offset_not_the_earliest_time(make_log):
    early, late = datetime(2026, 1, 1), datetime(2026, 1, 2)
    log = make_log([
        (0, 0, None, None, None, early), (0, 1, None, None, None, late),
        (0, 2, None, None, None, early), (0, 3, None, None, None, late), (1, 0, None, None, None, early)])
    assert pairs(offsets_at(log, datetime(2026, 1, 2, tzinfo=timezone.utc)), "partition", "at") == [(0, 1)]


def test_partitions_of_a_missing_topic(make_log):
    log = make_log([(0, 0), (4, 1)])
    assert pairs(discover_partitions(log, "orders"), "topic", "partition") == [("orders", 0), ("orders", 4)]
    with pytest.raises(FeedRefused, match="'nope'"):
        discover_partitions(log, "nope")
