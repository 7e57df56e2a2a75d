import random

import pytest
from pyspark.sql import functions as F

from rows import pairs
from tidelog.errors import TRANSIENT_CODES
from tidelog.functions.classify import classify_errors
from tidelog.functions.redact import redact, redact_properties, redact_values, usable_secrets
from tidelog.operators.health import first_failure, parse_ticks, stats_totals, tick_deltas, with_request_floor
from tidelog.operators.prefix import dense_rank_in_order
from tidelog.plans import stats
from tidelog.plans.stats import land_deltas, landed_deltas

FINAL_CODES = (
    "Local_Authentication", "Local_Ssl", "TopicAuthorizationFailed", "UnknownTopicOrPart", "OffsetOutOfRange",
    "MsgSizeTooLarge", "SaslAuthenticationFailed", "SomethingNew", "", "local_transport",
)


def scattered(rng, n):
    """Sequence numbers in clusters that fall into blocks of every level, some negative."""
    return sorted({(rng.randint(-3, 3) << rng.choice([13, 23, 26, 38, 45, 58])) + rng.randint(0, 60) for _ in range(n)})


def ticks(spark, *rows):
    return spark.createDataFrame(rows, "client string, seq bigint, stats string")


def test_ticks_are_cumulative(spark):
    told = ticks(
        spark, ("a", 1, '{"tx":3,"rx":2,"tx_bytes":70,"rx_bytes":55}'),
        ("a", 2, '{"tx":11,"rx":5,"tx_bytes":250,"rx_bytes":95}'))
    deltas = tick_deltas(parse_ticks(told))
    assert pairs(deltas, "seq", "requests", "wire_bytes") == [(1, 3, 125), (2, 8, 220)]
    assert pairs(stats_totals(parse_ticks(told)), "client", "requests", "wire_bytes") == [("a", 11, 345)]


def test_a_counter_that_falls_back_adds_nothing(spark):
    told = ticks(spark, *[("a", i, f'{{"tx":{v}}}') for i, v in enumerate([-5, 10, 3, 12, 12, 20])])
    assert [r[1] for r in pairs(tick_deltas(parse_ticks(told)), "seq", "requests")] == [0, 10, 0, 2, 0, 8]


def test_only_whole_numbers_count_and_only_objects_are_ticks(spark):
    told = ticks(
        spark, ("a", 1, '{"tx":"4","tx_bytes":1.5,"rx_bytes":7}'), ("a", 2, "not json"), ("a", 3, "[1]"),
        ("a", 4, "{}"), ("a", 5, ' {"tx":9} '), ("a", 6, '{"tx":null,"tx_bytes":1e2}'), ("a", 7, None), ("a", 8, "5"),
        ("a", 9, '{"tx":99999999999999999999}'), ("a", 10, '{"tx":{"tx":3}'))
    assert pairs(parse_ticks(told), "seq", "tx", "tx_bytes", "rx_bytes") == [
        (1, 0, 0, 7), (4, 0, 0, 0), (5, 9, 0, 0), (6, 0, 0, 0), (9, 0, 0, 0)]


def test_the_last_of_a_repeated_member_counts(spark):
    told = ticks(
        spark, ("a", 1, '{"tx":1,"tx":8}'), ("a", 2, ' {"tx":5,"tx":"5","rx_bytes":3}'), ("a", 3, '{"tx":1,"tx":2'),
        ("a", 4, '{"tx":1,"tx":2} {"tx":9}'), ("a", 5, '{"tx":1,"tx":2},{"tx":9}'), ("a", 6, '[{"tx":1,"tx":2}]'),
        ("a", 7, '{"x":{"tx":1,"tx":2},"tx":6}'), ("a", 8, "{'tx':1}"), ("a", 9, '{"x":1,"x":[2,{"tx":4}],"tx_bytes":7}'))
    assert pairs(parse_ticks(told), "seq", "tx", "tx_bytes", "rx_bytes") == [
        (1, 8, 0, 0), (2, 0, 0, 3), (7, 6, 0, 0), (9, 0, 7, 0)]


def test_what_stands_after_an_object_is_left_unread(spark):
    told = ticks(
        spark, ("a", 1, '{"tx":4} end'), ("a", 2, '{"tx":4}{"tx":5}'), ("a", 3, '{"tx":1,"tx":2} end'), ("a", 4, '{"tx":3,"x":NaN}'),
        ("a", 5, '{"tx":6,"x":{"y":1,"y":2}}'), ("a", 6, '{"tx":4,"TX":5}'), ("a", 7, '{"tx":{"y":1,"y":2},"rx_bytes":5}'), ("a", 8, '{"tx":7'))
    assert pairs(parse_ticks(told), "seq", "tx", "rx_bytes") == [(1, 4, 0), (2, 4, 0), (5, 6, 0), (6, 4, 0), (7, 0, 5)]


def test_a_tick_is_made_and_its_counters_are_read_once(spark):
    made = F.format_string('{"tx":%d,"tx":%d}', "id", "id")
    plan = parse_ticks(spark.range(9).select("id", made.alias("stats")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_string(") == 1 and plan.count("from_json(") == 1


def plan_after_a_run(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_counters_are_not_taken_for_less_than_their_ticks(spark):
    told = spark.range(9000).select(F.col("id").alias("client"), F.format_string('{"tx":%d}', "id").alias("stats"))
    counters = parse_ticks(told)
    size = [df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() for df in (told, counters)]
    assert int(str(size[1])) >= int(str(size[0]))


@pytest.mark.parametrize("before", [False, True])
def test_what_earlier_blocks_held_is_never_broadcast(spark, before):
    """One row per client and block: its size follows the data, so it must not go through the driver, however small it looks."""
    told = spark.range(4000).select(
        (F.col("id") % 40).alias("client"), (F.col("id") * 1000).alias("seq"), F.format_string('{"tx":%d}', "id").alias("stats"))
    highs = spark.range(50).selectExpr("id client", "100L tx", "0L tx_bytes", "0L rx_bytes")
    deltas = tick_deltas(parse_ticks(told), bits=12, before=highs if before else None)
    rows, plan = plan_after_a_run(deltas)
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") >= (3 if before else 2)
    least = 100 if before else 0
    assert {(r.client, r.seq): r.requests for r in rows} == {
        (i % 40, i * 1000): max(0, i - max(least, i - 40)) for i in range(4000)}


def test_ranks_are_found_without_a_broadcast(spark):
    rows = spark.range(4000).select((F.col("id") % 3).alias("k"), (F.col("id") * 1000).alias("seq"))
    ranked, plan = plan_after_a_run(dense_rank_in_order(rows, ["k"], "seq", "n", 12))
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert {(r.k, r.seq): r.n for r in ranked} == {(i % 3, i * 1000): i // 3 for i in range(4000)}


def test_runs_one_after_the_other_add_what_one_run_adds(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "b", None]), i, f'{{"tx":{rng.randint(-9, 99)},"rx_bytes":{rng.randint(0, 99)}}}')
            for i in range(240)]
    landed, state = str(tmp_path / "landed"), str(tmp_path / "state")
    for run, (low, high) in enumerate([(0, 90), (90, 91), (91, 91), (91, 240)], 1):
        assert land_deltas(ticks(spark, *rows[low:high], ("z", 1000 + run, "no tick")), "clients", landed, state, bits=12) == run
    shown = ["client", "seq", "requests", "wire_bytes"]
    key = lambda r: r[1]
    whole = sorted(map(tuple, tick_deltas(parse_ticks(ticks(spark, *rows))).select(*shown).collect()), key=key)
    found = landed_deltas(spark, landed, state, "clients")
    assert sorted(map(tuple, found.select(*shown).collect()), key=key) == whole
    assert {r["run"] for r in found.select("run").distinct().collect()} == {1, 2, 4}


def test_a_run_that_ended_before_its_commit_counts_no_tick_twice(spark, tmp_path, monkeypatch):
    landed, state = str(tmp_path / "landed"), str(tmp_path / "state")
    assert landed_deltas(spark, landed, state, "c") is None
    land_deltas(ticks(spark, ("a", 1, '{"tx":3}')), "c", landed, state)
    with monkeypatch.context() as broken:
        def lost(*_):
            raise OSError("driver lost")
        broken.setattr(stats, "store_token", lost)
        with pytest.raises(OSError):
            land_deltas(ticks(spark, ("a", 2, '{"tx":10}')), "c", landed, state)
    assert pairs(landed_deltas(spark, landed, state, "c"), "run", "seq", "requests") == [(1, 1, 3)]
    assert land_deltas(ticks(spark, ("a", 2, '{"tx":10}'), ("a", 3, '{"tx":11}')), "c", landed, state) == 2
    assert pairs(landed_deltas(spark, landed, state, "c"), "run", "seq", "requests") == [(1, 1, 3), (2, 2, 7), (2, 3, 1)]


def test_a_client_that_never_ticked_made_one_request(spark):
    told = ticks(spark, ("a", 1, '{"tx":4}'), ("b", 1, '{"tx":0}'), ("c", 1, "broken"))
    clients = spark.createDataFrame([(c,) for c in "abccd"], "client string")
    floored = with_request_floor(clients, stats_totals(parse_ticks(told)))
    assert pairs(floored, "client", "requests", "wire_bytes") == [("a", 4, 0), ("b", 0, 0), ("c", 1, 0), ("d", 1, 0)]


@pytest.mark.parametrize("bits", [12, 21])
def test_deltas_of_a_hot_client_equal_a_plain_walk_and_sum_to_the_totals(spark, bits):
    rng = random.Random(bits)
    rows, wanted = [], {}
    for client, n in (("hot", 400), ("cold", 30), ("one", 1)):
        seqs = scattered(rng, n)
        best = [0, 0, 0]
        for i, s in enumerate(seqs):
            now = [rng.randint(-5, 1000 + 10 * i) for _ in best]
            rows.append((client, s, *now))
            grew = [max(0, a - b) for a, b in zip(now, best)]
            wanted[client, s] = (grew[0], grew[1] + grew[2])
            best = [max(a, b) for a, b in zip(now, best)]
    rng.shuffle(rows)
    counters = spark.createDataFrame(rows, "client string, seq bigint, tx bigint, tx_bytes bigint, rx_bytes bigint")
    deltas = tick_deltas(counters, bits=bits)
    got = {(r["client"], r["seq"]): (r["requests"], r["wire_bytes"]) for r in deltas.collect()}
    assert got == wanted
    summed = deltas.groupBy("client").agg(F.sum("requests").alias("requests"), F.sum("wire_bytes").alias("wire_bytes"))
    assert pairs(summed, "client", "requests", "wire_bytes") == pairs(
        stats_totals(counters), "client", "requests", "wire_bytes")


@pytest.mark.parametrize("bits", [12, 21])
def test_ranks_in_a_hot_key_are_dense_and_in_order(spark, bits):
    rng = random.Random(bits)
    rows = [(key, seq) for key, n in ((0, 400), (1, 30), (2, 1)) for seq in scattered(rng, n)]
    wanted = [(k, s, i) for key in range(3) for i, (k, s) in enumerate(sorted(r for r in rows if r[0] == key))]
    rng.shuffle(rows)
    ranked = dense_rank_in_order(spark.createDataFrame(rows, "k int, seq bigint"), ["k"], "seq", "n", bits)
    assert pairs(ranked, "k", "seq", "n") == wanted


def test_the_first_failure_decides(spark):
    reports = spark.createDataFrame([
        ("s", 1, None, None), ("s", 4, "MsgSizeTooLarge", "big"), ("s", 3, "Local_MsgTimedOut", "late"),
        ("fine", 1, None, None)], "session string, seq bigint, code string, reason string")
    assert sorted(tuple(r) for r in first_failure(reports).collect()) == [
        ("fine", None, None, None, None), ("s", 3, "Local_MsgTimedOut", "late", True)]


def test_ticks_count_by_kind_and_clients_may_be_null(spark):
    ticks = spark.createDataFrame([
        ("c", 1, '\n\t{"tx":4}'), ("c", 2, ' {"tx":9}'), ("c", 3, "[1]"), ("c", 4, "no"), (None, 1, '{"tx":2}'),
        (None, 2, '{"tx":5}')], "client string, seq bigint, stats string")
    got = {(r.client, r.seq): r.requests for r in tick_deltas(parse_ticks(ticks)).collect()}
    assert got == {("c", 1): 4, ("c", 2): 5, (None, 1): 2, (None, 2): 3}


def test_classification(spark):
    assert len(TRANSIENT_CODES) == 13
    rows = [(c,) for c in (*TRANSIENT_CODES, *FINAL_CODES, None)]
    judged = {r["code"]: r["transient"] for r in classify_errors(spark.createDataFrame(rows, "code string")).collect()}
    assert judged == {**dict.fromkeys(TRANSIENT_CODES, True), **dict.fromkeys([*FINAL_CODES, None], False)}


def masked(spark, text, how):
    return spark.createDataFrame([(text,)], "t string").select(how(F.col("t"))).head()[0]


def test_known_secrets_are_masked_everywhere_longest_first(spark):
    assert masked(spark, "kelp, reef and kelp", lambda t: redact_values(t, ["reef", "kelp"])) == "***, *** and ***"
    assert masked(spark, "abcdef abc", lambda t: redact_values(t, ["abc", "abcdef", "abc"])) == "*** ***"
    assert usable_secrets(["ab", "", "abc", "abcd", "abc"]) == ["abcd", "abc"]
    assert masked(spark, "a.c abc", lambda t: redact_values(t, ["a.c"])) == "*** abc"
    assert masked(spark, None, lambda t: redact(t, ["abc"])) is None


@pytest.mark.parametrize("text, wanted", [
    ('client.id=me;ssl.key.password="two words" then sasl.password=kelp',
     "client.id=me;ssl.key.password=*** then sasl.password=***"),
    ("ssl.keystore.password=x;sasl.oauthbearer.client.secret=y,z",
     "ssl.keystore.password=***;sasl.oauthbearer.client.secret=***,z"),
    ("saslxpassword=abc xsasl.password=abc sasl.password=", "saslxpassword=abc xsasl.password=abc sasl.password="),
    ('sasl.password="" end', "sasl.password=*** end"),
    ("sasl.password=a b", "sasl.password=*** b"),
])
def test_password_properties_are_masked(spark, text, wanted):
    assert masked(spark, text, redact_properties) == wanted
