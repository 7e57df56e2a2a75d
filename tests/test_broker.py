import json
from datetime import datetime, timezone

import pytest

from tidelog.errors import FeedRefused
from tidelog.options import ReadOptions, WriteOptions
from tidelog.sources.broker import connection_secrets, sink_options, slice_options, stream_options

CONNECTION = {"kafka.bootstrap.servers": "b:9092", "kafka.client.id": "me"}


def test_a_slice_is_read_between_exact_offsets():
    bounds = [{"partition": 10, "resume": 4, "bound": 9}, {"partition": 2, "resume": 5, "bound": 5}]
    options = slice_options(CONNECTION, "orders", bounds)
    assert json.loads(options["startingOffsets"]) == {"orders": {"2": 5, "10": 4}}
    assert json.loads(options["endingOffsets"]) == {"orders": {"2": 5, "10": 9}}
    assert options["subscribe"] == "orders" and options["kafka.client.id"] == "me"
    assert options["kafka.isolation.level"] == "read_committed"
    assert (options["failOnDataLoss"], options["includeHeaders"]) == ("true", "true")


def test_a_stream_starts_by_position_or_time():
    assert stream_options(CONNECTION, ReadOptions("t", "latest"))["startingOffsets"] == "latest"
    at = datetime(2026, 1, 1, tzinfo=timezone.utc)
    options = stream_options(CONNECTION, ReadOptions("t", at), max_offsets_per_trigger=1000)
    assert options["startingTimestamp"] == "1767225600000"
    assert options["startingOffsetsByTimestampStrategy"] == "latest"
    assert options["maxOffsetsPerTrigger"] == "1000" and "startingOffsets" not in options


def test_a_write_is_durable():
    options = sink_options(CONNECTION, WriteOptions.parse("out", {"compression": "zstd"}))
    assert {k: options[k] for k in (
        "topic", "kafka.enable.idempotence", "kafka.acks", "kafka.linger.ms", "kafka.compression.type")} == {
        "topic": "out", "kafka.enable.idempotence": "true", "kafka.acks": "all", "kafka.linger.ms": "5",
        "kafka.compression.type": "zstd"}


def test_what_the_feed_sets_is_set_in_one_place():
    clashing = {**CONNECTION, "kafka.acks": "1", "topic": "x"}
    with pytest.raises(FeedRefused) as refusal:
        sink_options(clashing, WriteOptions.parse("out"))
    assert "'kafka.acks'" in str(refusal.value) and "'topic'" in str(refusal.value)
    with pytest.raises(FeedRefused, match="bootstrap"):
        sink_options({}, WriteOptions.parse("out"))


def test_secrets_are_known_by_their_option_name():
    connection = {**CONNECTION, "kafka.ssl.key.password": "pw1", "kafka.sasl.jaas.config": "conf",
                  "kafka.X.Token": "tok", "kafka.oauth.clientSecret": "sec"}
    assert sorted(connection_secrets(connection)) == ["conf", "pw1", "sec", "tok"]
