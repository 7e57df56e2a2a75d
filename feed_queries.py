"""The registered queries: every operator over the whole of the given tables.

Tables are viewed as topics by sources.logs.as_log, with the table's own sequence number as offset.
Offsets of a partition therefore rise with gaps, as on a compacted topic.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.errors import TRANSIENT_CODES
from tidelog.functions.classify import classify_errors
from tidelog.functions.redact import redact_properties, redact_values
from tidelog.functions.rowjson import row_json, timestamp_text
from tidelog.operators.bounds import (
    bound_problems, consumer_lag, effective_bounds, read_bounds, unfinished, vanished_partitions,
)
from tidelog.operators.health import first_failure, parse_ticks, stats_totals, tick_deltas, with_request_floor
from tidelog.operators.reading import (
    compacted_view, dedupe_redelivered, envelope, landed_counts, offset_gaps, read_slice, utf8_rejects,
)
from tidelog.operators.token import advance_token, parse_tokens
from tidelog.options import ReadOptions, WriteOptions
from tidelog.plans.feed import feed_run, feed_topic, land_topic, landed_rows, write_run
from tidelog.plans.relay import relay
from tidelog.plans.state import load_token
from tidelog.plans.stats import land_deltas, landed_deltas
from tidelog.schema import LOG_SCHEMA
from tidelog.session import scratch_path, use_utc
from tidelog.sinks.append import append_offsets, append_to_log
from tidelog.sinks.records import to_records
from tidelog.sources.catalogue import (
    catalogue_marks, commit_append, create_topic, log_files, offsets_at_indexed, raise_low,
)
from tidelog.sources.logs import as_log, discover_partitions, header, load_log, offsets_at, watermarks
from tidelog.streaming.stream import LANDED_SCHEMA, stream_feed, stream_land

MIDMONTH = datetime(2024, 1, 15, tzinfo=timezone.utc)
LATER = datetime(2024, 1, 22, tzinfo=timezone.utc)
SECRETS = ("token", "tion", "tionhe", "thor", "th")


def _type() -> Column:
    return F.col("event_type")


def _user() -> Column:
    return F.col("user_id")


def _lane() -> Column:
    return F.pmod("user_id", F.lit(4))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _event_headers() -> Column:
    """A plain header, one that clicks repeat, one that is sometimes null, one that is not text."""
    second = F.when(_type() == "click", "id").otherwise("event")
    return F.array(
        header("type", _type()),
        header("id", _user().cast("string")),
        header("note", F.when(_type() != "view", F.concat(_type(), F.lit(' "quoted"')))),
        header(second, F.col("event_id").cast("string")),
        header("raw", F.lit(bytes([0xFF]))),
    )


def _as_events_log(events: DataFrame, value: Column | None = None, key: Column | None = None) -> DataFrame:
    return as_log(
        events, "events", _lane(), F.col("event_id"), F.col("ts"),
        key=_user().cast("string") if key is None else key,
        value=F.col("props") if value is None else value,
        headers=_event_headers(),
    )


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_events_log(_table(spark, sf_dir, "events"))


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return as_log(
        orders, "orders", F.pmod("o_custkey", F.lit(8)), F.col("o_orderkey"), F.col("o_orderdate"),
        key=F.col("o_orderkey").cast("string"), value=row_json(orders),
    )


def conversations_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn's offset keeps conversations apart and turns in order."""
    return as_log(
        _table(spark, sf_dir, "conversations"), "conversations", F.pmod("conv_id", F.lit(3)),
        F.shiftleft("conv_id", 20) + F.col("turn"), F.lit("2024-01-01 00:00:00"),
        key=F.col("conv_id").cast("string"), value=F.col("text"),
    )


def _token_at(log: DataFrame, moment: datetime) -> DataFrame:
    """The token of a run that landed everything before ``moment``."""
    return offsets_at(log, moment).withColumnRenamed("at", "next_offset")


def _shown(landed: DataFrame) -> DataFrame:
    return landed.withColumn("timestamp", timestamp_text(F.col("timestamp")))


def _record_text(records: DataFrame, *extra: str) -> DataFrame:
    """Records with readable key, value and headers."""
    listed = F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string")))
    return records.select(
        "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.array_join(listed, ";").alias("headers"), *extra)


def q_relay(spark, sf_dir):
    log = events_log(spark, sf_dir)
    run = feed_run(log, ReadOptions("events"))
    return relay(run.envelope, {
        "id": F.col("offset"), "name": F.get_json_object("value", "$.k"), "seen_at": timestamp_text(F.col("timestamp"))})


def q_envelope(spark, sf_dir):
    return _shown(envelope(events_log(spark, sf_dir)))


def q_feed_slice(spark, sf_dir):
    log = events_log(spark, sf_dir)
    bounds = read_bounds(watermarks(log), _token_at(log, MIDMONTH))
    return read_slice(log, bounds).select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"))


def q_watermarks(spark, sf_dir):
    return watermarks(events_log(spark, sf_dir))


def q_partitions(spark, sf_dir):
    events, orders = events_log(spark, sf_dir), orders_log(spark, sf_dir)
    conversations = conversations_log(spark, sf_dir)
    return (
        discover_partitions(events, "events")
        .unionByName(discover_partitions(orders, "orders"))
        .unionByName(discover_partitions(conversations, "conversations"))
    )


def q_bounds_earliest(spark, sf_dir):
    return read_bounds(watermarks(events_log(spark, sf_dir)), start="earliest")


def q_bounds_latest(spark, sf_dir):
    return read_bounds(watermarks(events_log(spark, sf_dir)), start="latest")


def q_bounds_timestamp(spark, sf_dir):
    log = events_log(spark, sf_dir)
    return read_bounds(watermarks(log), start=MIDMONTH, at=offsets_at(log, MIDMONTH))


def q_bounds_resume(spark, sf_dir):
    """Partition 3 was added after the token was written, so it begins at the start position."""
    log = events_log(spark, sf_dir)
    token = _token_at(log, MIDMONTH).where(F.col("partition") != 3)
    return read_bounds(watermarks(log), token, start="earliest")


def q_unfinished(spark, sf_dir):
    """Even partitions were read to the end, odd ones up to the middle of the month."""
    log = events_log(spark, sf_dir)
    marks = watermarks(log)
    even = F.col("partition") % 2 == 0
    done = marks.where(even).select("partition", F.col("high").alias("next_offset"))
    return unfinished(read_bounds(marks, done.unionByName(_token_at(log, MIDMONTH).where(~even))))


def q_bound_problems(spark, sf_dir):
    """Retention has passed partition 0's stored offset; partition 1 was reset below its own."""
    log = events_log(spark, sf_dir)
    kept = watermarks(log).join(offsets_at(log, LATER), "partition").select(
        "partition", F.col("at").alias("low"), "high")
    stored = (
        F.when(F.col("partition") == 0, F.col("next_offset"))
        .when(F.col("partition") == 1, F.col("high") + 5)
        .when(F.col("partition") == 2, F.col("low"))
        .otherwise(F.col("high"))
    )
    token = kept.join(_token_at(log, MIDMONTH), "partition").select("partition", stored.alias("next_offset"))
    return bound_problems(kept, token).select(
        "partition", "stored", "low", "high",
        F.when(F.col("stored") < F.col("low"), "retention").otherwise("reset").alias("problem"))


def q_effective_bounds(spark, sf_dir):
    """Transactions opened on LATER hold back partitions 0 to 2; partition 2 was already finished."""
    log = events_log(spark, sf_dir)
    marks = watermarks(log)
    done = marks.where(F.col("partition") == 2).select("partition", F.col("high").alias("next_offset"))
    stops = offsets_at(log, LATER).where(F.col("partition") < 3).withColumnRenamed("at", "stop_offset")
    return effective_bounds(read_bounds(marks, done), stops)


def q_offset_gaps(spark, sf_dir):
    return offset_gaps(events_log(spark, sf_dir))


def q_vanished_partitions(spark, sf_dir):
    """A token of an eight-partition topic against a four-partition one."""
    token = watermarks(orders_log(spark, sf_dir)).select("partition", F.col("high").alias("next_offset"))
    return vanished_partitions(watermarks(events_log(spark, sf_dir)), token)


def q_token(spark, sf_dir):
    return advance_token("orders", read_bounds(watermarks(orders_log(spark, sf_dir))))


def q_token_empty(spark, sf_dir):
    """Starting at latest lands nothing and still records where to go on."""
    run = feed_run(orders_log(spark, sf_dir), ReadOptions("orders", "latest"))
    return run.token.withColumn("landed", F.lit(run.envelope.count()).cast("bigint"))


def q_token_parse(spark, sf_dir):
    """One stored token per event, each event type with its own kind of damage."""
    def good(topic):
        return F.format_string(
            f'{{"v":1,"topic":"{topic}","partitions":{{"10":%d,"2":%d}}}}', F.col("event_id"), _user())

    text = (
        F.when(_type() == "view", good("events"))
        .when(_type() == "click", good("other"))
        .when(_type() == "signup", F.format_string('{"v":2,"topic":"events","partitions":{"0":%d}}', "event_id"))
        .when(_type() == "purchase", F.format_string(
            '{"v":1,"topic":"events","partitions":{"0":%d,"1":-%d}}', F.col("event_id"), _user() + 1))
        .otherwise(F.format_string("not json %d", "event_id"))
    )
    tokens = _table(spark, sf_dir, "events").select("event_id", text.alias("token"))
    return parse_tokens(tokens, topic="events").select(
        "event_id", "problem", F.explode_outer("partitions").alias("partition", "next_offset"))


def q_headers_json(spark, sf_dir):
    return envelope(events_log(spark, sf_dir)).select("partition", "offset", "headers")


def q_payload_base64(spark, sf_dir):
    return envelope(conversations_log(spark, sf_dir), "base64").select("partition", "offset", "key", "value")


def q_utf8_rejects(spark, sf_dir):
    """Broken bytes at the end of error values, a lone surrogate in signup keys, accents elsewhere."""
    text = F.concat(F.col("props"), F.lit(" é"))
    value = F.when(_type() == "error", F.concat(F.encode("props", "UTF-8"), F.lit(bytes([0xFF, 0xFE, 0x00])))
                   ).otherwise(F.encode(text, "UTF-8"))
    key = F.when(_type() == "signup", F.lit(bytes([0xED, 0xA0, 0x80]))
                 ).otherwise(F.encode(_user().cast("string"), "UTF-8"))
    return utf8_rejects(_as_events_log(_table(spark, sf_dir, "events"), value, key))


def q_row_json(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", row_json(orders).alias("value"))


def q_row_json_decimal(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").cast("decimal(38,9)").alias("price"))
    return orders.select("o_orderkey", row_json(orders).alias("value"))


def q_row_json_nonfinite(spark, sf_dir):
    number = (
        F.when(_type() == "error", F.lit(float("nan")))
        .when(_type() == "signup", F.lit(float("inf")))
        .when(_type() == "click", F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    rows = _table(spark, sf_dir, "events").select("event_id", number.alias("value"))
    return rows.select("event_id", row_json(rows).alias("json"))


def q_row_json_nested(spark, sf_dir):
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    returned = F.col("l_returnflag") == "R"
    rows = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(~returned, F.struct(
            F.col("l_quantity").alias("quantity"), price.alias("price"),
            F.struct(F.col("l_shipdate").alias("at"), F.col("l_shipdate").cast("date").alias("day")).alias("ship"),
        )).alias("line"),
        F.array(F.col("l_returnflag"), F.when(returned, F.col("l_linestatus"))).alias("flags"),
        F.create_map(F.lit("tax"), F.col("l_tax"), F.lit("discount"), F.when(~returned, F.col("l_discount"))
                     ).alias("rates"),
    )
    return rows.select("l_orderkey", "l_linenumber", row_json(rows).alias("value"))


def q_sink_records(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return _record_text(to_records(orders, WriteOptions.parse("orders_out", {"topic": "orders-out"})))


def q_sink_value_column(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    write = WriteOptions.parse("events_out", {"key": "event_id", "value": "props"})
    return _record_text(to_records(events, write))


def q_sink_key_headers(spark, sf_dir):
    events = _table(spark, sf_dir, "events").withColumn("note", F.when(_type() != "view", _type()))
    write = WriteOptions.parse("events_out", {"key": "user_id", "headers": ["ts", "note", "event_id"]})
    return _record_text(to_records(events, write))


def q_sink_tombstones(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(
        "event_id", F.when(_type() != "error", F.col("props")).alias("payload"))
    return _record_text(to_records(events, WriteOptions.parse("events_out", {"key": "event_id", "value": "payload"})))


def q_append_offsets(spark, sf_dir):
    """Two appends: what came before the middle of the month, then the rest on top of it."""
    events = _table(spark, sf_dir, "events").select("event_id", "ts", _lane().cast("int").alias("partition"))
    early = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    first = append_offsets(events.where(early), None, "event_id")
    highs = events.where(early).groupBy("partition").agg(F.count(F.lit(1)).alias("high"))
    second = append_offsets(events.where(~early), highs, "event_id")
    return first.unionByName(second).select("event_id", "partition", "offset")


def q_sink_log_table(spark, sf_dir):
    """Rows become records, get offsets, land in a log table by two appends, and are read back as a feed."""
    path = scratch_path(spark, "log")
    orders = _table(spark, sf_dir, "orders")
    write = WriteOptions.parse("orders", {"key": "o_orderkey", "value": "o_orderpriority", "compression": "zstd"})
    records = to_records(orders.withColumn("seq", F.col("o_orderkey")).withColumn(
        "lane", F.pmod("o_custkey", F.lit(8))), write, keep=("seq", "lane"))
    early = F.col("seq") % 5 < 2
    append_to_log(records.where(early), path, write, partition=F.col("lane"), order="seq")
    append_to_log(records.where(~early), path, write, partition=F.col("lane"), order="seq")
    run = feed_run(load_log(spark, path, "orders"), ReadOptions("orders"))
    return run.envelope.select("topic", "partition", "offset", "key", "value", "headers")


def q_incremental_two_runs(spark, sf_dir):
    """A run over what was there by mid-month, then one from its token: together the whole log."""
    log = events_log(spark, sf_dir)
    first = feed_run(log.where(F.col("timestamp") < F.lit(MIDMONTH)), ReadOptions("events"))
    second = feed_run(log, ReadOptions("events"), token=first.token_text())
    landed = first.envelope.withColumn("run", F.lit(1)).unionByName(second.envelope.withColumn("run", F.lit(2)))
    return landed.select("run", "partition", "offset", "key", "value")


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return _as_events_log(files)


def q_incremental_emptied_partition(spark, sf_dir):
    """Three runs from the latest record; before the second, partition 2 loses all its records for a while."""
    log = events_log(spark, sf_dir)
    mid, later = (F.lit(f"2024-01-{d} 00:00:00").cast("timestamp") for d in (15, 22))
    read = ReadOptions("events", "latest")
    first = feed_run(log.where(F.col("timestamp") < mid), ReadOptions("events"))
    second = feed_run(log.where((F.col("timestamp") < later) & (F.col("partition") != 2)), read, first.token_text())
    third = feed_run(log, read, second.token_text())
    runs = [run.envelope.select(F.lit(k).alias("run"), "partition", "offset") for k, run in enumerate((first, second, third), 1)]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


def q_stream_feed(spark, sf_dir):
    landed, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "checkpoint")
    stream_feed(_events_stream(spark, sf_dir), landed, checkpoint).awaitTermination()
    return spark.read.parquet(landed).select("topic", "partition", "offset", "key", "value", "headers")


def q_stream_land(spark, sf_dir):
    """Every record delivered twice in the stream, landed once."""
    landed, state, checkpoint = (scratch_path(spark, n) for n in ("landed", "state", "checkpoint"))
    twice = _events_stream(spark, sf_dir).unionByName(_events_stream(spark, sf_dir))
    stream_land(twice, ReadOptions("events"), landed, state, checkpoint).awaitTermination()
    return spark.read.parquet(landed).select("partition", "offset", "key", "value")


def q_landed_counts(spark, sf_dir):
    log = events_log(spark, sf_dir)
    return landed_counts(read_slice(log, read_bounds(watermarks(log), _token_at(log, MIDMONTH))))


def q_consumer_lag(spark, sf_dir):
    log = events_log(spark, sf_dir)
    return consumer_lag(watermarks(log), _token_at(log, MIDMONTH))


def q_dedupe(spark, sf_dir):
    """A run that landed, and its retry that landed everything from mid-month on again."""
    log = events_log(spark, sf_dir)
    again = log.where(F.col("timestamp") >= F.lit(MIDMONTH))
    landed = envelope(log).unionByName(envelope(again))
    return _shown(dedupe_redelivered(landed)).drop("headers")


def q_compacted_view(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    log = _as_events_log(events, value=F.when(_type() != "error", F.col("props")))
    return compacted_view(log).select(
        "partition", "offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative client statistics, one tick per event; each event type has its own damage."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    events = _table(spark, sf_dir, "events").withColumn("k", k)
    tx, sent = F.expr("event_id div 10 + k"), F.expr("event_id * 100 + k * 1000")
    received = F.expr("event_id * 50 + k * 700")
    stats = (
        F.when(_type() == "view", F.format_string('{"tx":%d,"rx":7,"tx_bytes":%d,"rx_bytes":%d}', tx, sent, received))
        .when(_type() == "signup", F.format_string('{"tx":"%d","tx_bytes":%d,"rx_bytes":%d}', tx, sent, received))
        .when(_type() == "click", F.format_string('{"tx":%d.5,"tx_bytes":%d}', tx, sent))
        .when(_type() == "purchase", F.format_string('{"rx_bytes":%d,"tx":%d}', received, tx))
        .otherwise(F.format_string("not json %d", "event_id"))
    )
    return events.select(
        _user().alias("client"), F.col("event_id").alias("seq"), stats.alias("stats"))


def q_stats_delta(spark, sf_dir):
    return tick_deltas(parse_ticks(ticks(spark, sf_dir))).select("client", "seq", "requests", "wire_bytes")


def q_stats_totals(spark, sf_dir):
    return stats_totals(parse_ticks(ticks(spark, sf_dir)))


def q_stats_floor(spark, sf_dir):
    """Every customer is a client; those without events never ticked."""
    clients = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("client"))
    return with_request_floor(clients, stats_totals(parse_ticks(ticks(spark, sf_dir))))


# The codes the delivery reports below cycle through, transient ones first.
REPORT_CODES = (
    *TRANSIENT_CODES,
    "TopicAuthorizationFailed", "SaslAuthenticationFailed", "UnknownTopicOrPart", "OffsetOutOfRange",
    "MsgSizeTooLarge", "Local_Authentication", "Local_MaxPollExceeded",
)


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery report per event: an error or signup event failed, any other was acknowledged."""
    codes = F.array(*[F.lit(c) for c in REPORT_CODES])
    k = F.get_json_object("props", "$.k").cast("int")
    failed = _type().isin("error", "signup")
    return _table(spark, sf_dir, "events").select(
        _user().alias("session"), F.col("event_id").alias("seq"),
        F.when(failed, F.element_at(codes, F.pmod(k, F.lit(len(REPORT_CODES))) + 1)).alias("code"),
        F.when(failed, F.concat(_type(), F.lit(" at "), F.col("event_id").cast("string"))).alias("reason"))


def q_first_failure(spark, sf_dir):
    return first_failure(reports(spark, sf_dir))


def q_classify_errors(spark, sf_dir):
    return classify_errors(reports(spark, sf_dir)).select("session", "seq", "code", "transient")


def q_redact_values(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", redact_values(F.col("text"), SECRETS).alias("text"))


def q_redact_properties(spark, sf_dir):
    """Token lines read as a quoted password property; a property dump is added to every text."""
    dump = F.concat(
        F.replace("text", F.lit("token = "), F.lit("sasl.password=")), F.lit(" ssl.key.password="), F.col("source"),
        F.lit(", ssl.keystore.password="), F.col("lang"), F.lit("; bootstrap.servers=b:9092"))
    return _table(spark, sf_dir, "documents").select("doc_id", redact_properties(dump).alias("text"))


def q_feed_slice_many(spark, sf_dir):
    """A slice over more partitions than fit in literals: 150 of them, each from the middle of its offsets."""
    orders = _table(spark, sf_dir, "orders")
    log = as_log(orders, "orders", F.pmod("o_custkey", F.lit(150)), F.col("o_orderkey"), F.col("o_orderdate"),
                 key=F.col("o_custkey").cast("string"))
    middle = watermarks(log).select("partition", F.floor((F.col("low") + F.col("high")) / 2).cast("bigint").alias("next_offset"))
    return read_slice(log, read_bounds(watermarks(log), middle)).select(
        "partition", "offset", F.col("key").cast("string").alias("key"))


def q_append_offsets_blocks(spark, sf_dir):
    """Numbers in blocks of 4,096 sequence numbers, so that each partition's count is carried over many blocks."""
    events = _table(spark, sf_dir, "events").select("event_id", _lane().cast("int").alias("partition"))
    highs = spark.range(4).select(F.col("id").cast("int").alias("partition"), (F.col("id") * 1000).alias("high"))
    return append_offsets(events, highs, "event_id", bits=12)


COMMITS = (None, "2024-01-15", "2024-01-22", None)  # days at which an append ends and the next begins


def _append_events(spark, sf_dir, path, part):
    """Append number ``part`` (1 to 3) of the events to a catalogued topic."""
    since, until = (d and F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in COMMITS[part - 1: part + 1])
    events = _table(spark, sf_dir, "events")
    events = events if since is None else events.where(F.col("ts") >= since)
    events = events if until is None else events.where(F.col("ts") < until)
    write = WriteOptions.parse("events", {"key": "event_id", "value": "props"})
    records = to_records(events.select("*", F.col("event_id").alias("seq"), _lane().alias("lane"), F.col("ts").alias("at")), write,
                         keep=("seq", "lane", "at"))
    return commit_append(records, path, write, F.col("lane"), "seq", F.col("at"))


def _events_topic(spark, sf_dir, parts, partitions=6):
    """A catalogued topic with the first ``parts`` appends; two of its six partitions never get a record."""
    path = scratch_path(spark, "topic")
    create_topic(spark, path, "events", partitions)
    for part in range(1, parts + 1):
        _append_events(spark, sf_dir, path, part)
    return path


def _run_rows(plan, run):
    return plan.envelope.select(F.lit(run).alias("run"), "partition", "offset", "key", "value")


def _all_gone(marks, partition):
    return marks.where(F.col("partition") == partition).select("partition", F.col("high").alias("low"))


def q_watermarks_catalogue(spark, sf_dir):
    """Marks after three appends: partition 1 lost its first seven offsets to retention, partition 2 all; 4 and 5 are empty."""
    path = _events_topic(spark, sf_dir, 3)
    marks = catalogue_marks(spark, path, "events")
    seven = marks.where(F.col("partition") == 1).select("partition", F.lit(7).cast("bigint").alias("low"))
    raise_low(spark, path, "events", seven.unionByName(_all_gone(marks, 2)))
    return catalogue_marks(spark, path, "events")


def q_topic_files(spark, sf_dir):
    """What the index holds of a topic, added up by partition."""
    return log_files(spark, _events_topic(spark, sf_dir, 3), "events").groupBy("partition").agg(
        F.min("first").alias("first"), F.max("next").alias("next"), F.sum("records").alias("records"),
        timestamp_text(F.min("least_time")).alias("least_time"), timestamp_text(F.max("greatest_time")).alias("greatest_time"))


def q_incremental_expired(spark, sf_dir):
    """Three runs, with partition 2 expired after the first and partition 1 after the second; then one from the beginning."""
    path, token, runs = _events_topic(spark, sf_dir, 0), None, []
    for k in (1, 2, 3):
        _append_events(spark, sf_dir, path, k)
        plan = feed_topic(spark, path, ReadOptions("events"), token)
        token = plan.token_text()
        runs.append(_run_rows(plan, k))
        if k < 3:
            raise_low(spark, path, "events", _all_gone(catalogue_marks(spark, path, "events"), 3 - k))
    runs.append(_run_rows(feed_topic(spark, path, ReadOptions("events")), 4))
    return runs[0].unionByName(runs[1]).unionByName(runs[2]).unionByName(runs[3])


def q_land_retry(spark, sf_dir):
    """The second run lands its slice and ends before its token is stored; when it runs again there is more to read."""
    path = _events_topic(spark, sf_dir, 1)
    landed, state = scratch_path(spark, "landed"), scratch_path(spark, "state")
    land_topic(spark, path, ReadOptions("events"), landed, state)
    _append_events(spark, sf_dir, path, 2)
    text, run = load_token(spark, state, "events")
    write_run(feed_topic(spark, path, ReadOptions("events"), text), landed, run + 1)
    _append_events(spark, sf_dir, path, 3)
    land_topic(spark, path, ReadOptions("events"), landed, state)
    return landed_rows(spark, landed, state, "events").select("run", "partition", "offset", "key", "value")


def q_bounds_time_index(spark, sf_dir):
    """Where each partition of a stored topic begins at an instant within its second append."""
    path = _events_topic(spark, sf_dir, 3)
    return offsets_at_indexed(spark, path, "events", datetime(2024, 1, 18, 6, tzinfo=timezone.utc))


def q_bounds_limited(spark, sf_dir):
    """Two runs over a third of the records each, dealt evenly to the partitions, then one without a limit."""
    path, token, runs = _events_topic(spark, sf_dir, 3), None, []
    third = _table(spark, sf_dir, "events").count() // 3
    for k, most in ((1, third), (2, third), (3, None)):
        plan = feed_topic(spark, path, ReadOptions("events"), token, max_records=most)
        token = plan.token_text()
        runs.append(_run_rows(plan, k))
    return runs[0].unionByName(runs[1]).unionByName(runs[2]).select("run", "partition", "offset", "key")


def q_stats_delta_two_runs(spark, sf_dir):
    """Ticks of which every other one repeats members, in two runs by sequence number, in blocks of 4,096 numbers."""
    told = ticks(spark, sf_dir)
    again = F.concat(F.lit('{"tx":12345,"tx_bytes":"x",'), F.expr("substring(stats, 2)"))
    told = told.withColumn("stats", F.when((F.col("seq") % 2 == 0) & F.col("stats").startswith("{"), again).otherwise(F.col("stats")))
    half = told.agg(F.max("seq")).head()[0] // 2
    landed, state = scratch_path(spark, "landed"), scratch_path(spark, "state")
    land_deltas(told.where(F.col("seq") <= half), "events", landed, state, bits=12)
    land_deltas(told.where(F.col("seq") > half), "events", landed, state, bits=12)
    return landed_deltas(spark, landed, state, "events").select("run", "client", "seq", "requests", "wire_bytes")


def q_stream_land_latest(spark, sf_dir):
    """A stream that begins at the end of a log: three batches, the second and third with copies of all that came before."""
    topic, landed, state, checkpoint = (scratch_path(spark, n) for n in ("topic", "landed", "state", "checkpoint"))
    log, when = events_log(spark, sf_dir), F.col("timestamp")
    mid, later = F.lit(MIDMONTH), F.lit(LATER)
    for part in (log.where(when < mid), log.where(when < later), log):
        part.write.mode("append").parquet(topic)
        stream_land(
            spark.readStream.schema(LOG_SCHEMA).parquet(topic), ReadOptions("events", "latest"), landed, state, checkpoint,
            known=spark.read.schema(LOG_SCHEMA).parquet(topic)).awaitTermination()
    return spark.read.schema(LANDED_SCHEMA).parquet(landed).select(
        F.col("batch_id").alias("batch"), "partition", "offset", "key", "value")


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}
