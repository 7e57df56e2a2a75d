import pytest

from rows import pairs
from tidelog.errors import FeedRefused
from tidelog.operators.token import advance_token, parse_token, parse_tokens, token_offsets
from tidelog.schema import BOUNDS_DDL

GOOD = '{"v":1,"topic":"tides","partitions":{"0":7,"4":310,"11":0}}'


def test_text_is_stable_and_in_numeric_partition_order(spark):
    bounds = spark.createDataFrame([(20, 0, 2), (3, 0, 8), (0, 1, 6)], BOUNDS_DDL)
    assert advance_token("tides", bounds).collect()[0]["token"] == '{"v":1,"topic":"tides","partitions":{"0":6,"3":8,"20":2}}'


def test_round_trip(spark):
    stored = parse_token(spark, GOOD, "tides")
    assert pairs(stored, "partition", "next_offset") == [(0, 7), (4, 310), (11, 0)]
    again = advance_token("tides", stored.selectExpr("partition", "next_offset as bound"))
    assert again.head()["token"] == GOOD


@pytest.mark.parametrize("text", [None, ""])
def test_no_token(spark, text):
    assert parse_token(spark, text, "tides") is None


def token_with(version="1", topic='"tides"', partitions='{"5":60}'):
    parts = {"v": version, "topic": topic, "partitions": partitions}
    return "{" + ",".join(f'"{name}":{value}' for name, value in parts.items() if value is not None) + "}"


NO_JSON, NO_VERSION, LACKS = "no JSON value", "states no version", "lacks topic or partitions"
NO_ENTRY = "holds an entry that is no partition with an offset"
BAD = {
    GOOD[:-9]: NO_JSON, GOOD + ";": NO_JSON, GOOD + ", " + GOOD: NO_JSON, "<token/>": NO_JSON,
    '"tides"': NO_VERSION, token_with(version=None): NO_VERSION, token_with(version="true"): NO_VERSION,
    token_with(version="1.5"): NO_VERSION, token_with(version="7"): "of version 7 instead of 1",
    token_with(topic=None): LACKS, token_with(topic="[]"): LACKS, token_with(partitions=None): LACKS,
    token_with(partitions='"5"'): LACKS, token_with(topic='"waves"'): "of another topic",
    **{token_with(partitions=f'{{"{partition}":{offset}}}'): NO_ENTRY for partition, offset in (
        ("east", 1), ("+5", 1), ("", 1), ("5000000000", 1), ("5", -60), ("5", 6.25), ("5", "null"), ("5", '"60"'),
        ("5", 10**19), ("5", "[60]"))},
}


def test_refusals(spark):
    tokens = spark.createDataFrame([(t,) for t in BAD], "token string")
    judged = {r["token"]: (r["problem"], r["partitions"]) for r in parse_tokens(tokens, topic="tides").collect()}
    assert judged == {text: (why, None) for text, why in BAD.items()}


def test_odd_but_usable_tokens(spark):
    texts = [
        '{"v":1,"topic":"tides","partitions":{}}',
        ' {"extra":[1],"v":1,"topic":"tides","partitions":{"007":3}} ',
        '{"v":1,"topic":"tides","partitions":{"0":1,"1":2,"0":9}}',
        '{"v":1,"topic":"tides","partitions":{"3":9000000000}}',
    ]
    parsed = parse_tokens(spark.createDataFrame(list(enumerate(texts)), "id int, token string"), topic="tides")
    assert {r["id"]: (r["problem"], r["partitions"]) for r in parsed.collect()} == {
        0: (None, {}), 1: (None, {7: 3}), 2: (None, {0: 9, 1: 2}), 3: (None, {3: 9000000000})}
    assert pairs(token_offsets(parsed), "id", "partition", "next_offset") == [
        (1, 7, 3), (2, 0, 9), (2, 1, 2), (3, 3, 9000000000)]


def test_the_refusal_never_repeats_the_token(spark):
    with pytest.raises(FeedRefused) as refusal:
        parse_token(spark, '{"v":1,"topic":"tides","partitions":{"0":"kelp77"}}', "tides")
    assert "kelp77" not in str(refusal.value) and not refusal.value.transient
