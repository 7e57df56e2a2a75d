import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from rows import pairs
from tidelog.functions.rowjson import timestamp_text
from tidelog.operators.reading import (
    compacted_view, dedupe_redelivered, envelope, landed_counts, offset_gaps, read_slice, utf8_rejects,
)
from tidelog.schema import BOUNDS_DDL, ENVELOPE_SCHEMA


def test_schema_is_fixed(make_log):
    for encoding in ("utf8", "base64"):
        schema = envelope(make_log([(0, 0)]), encoding).schema
        assert [(f.name, f.dataType) for f in schema] == [(f.name, f.dataType) for f in ENVELOPE_SCHEMA]


def test_a_record_lands_as_one_row(make_log):
    log = make_log([(4, 19, "pier", "low tide", [("from", bytearray(b"gauge"))], datetime(2025, 6, 1, 4, 30))])
    row = envelope(log).withColumn("timestamp", timestamp_text("timestamp")).head()
    assert tuple(row) == ("orders", 4, 19, "2025-06-01T04:30:00.000000Z", "pier", "low tide", '{"from":"gauge"}')


def test_nulls_stay_null_and_empty_stays_empty(make_log):
    rows = envelope(make_log([(0, 0), (0, 1, "", "")])).orderBy("offset").collect()
    assert [(r["key"], r["value"], r["headers"]) for r in rows] == [(None, None, "{}"), ("", "", "{}")]


BAD = [b"\x80", b"ok\xe9", b"\xed\xb0\x81", b"\xc1\xbf", b"\xf5\x81\x81\x81", b"cut \xf0\x9f\x8c"]


@pytest.mark.parametrize("field", ["key", "value"])
@pytest.mark.parametrize("raw", BAD)
def test_bytes_that_are_not_text_stop_the_read_and_name_the_record(make_log, field, raw):
    key, value = (raw, "fine") if field == "key" else ("fine", raw)
    log = make_log([(5, 20, "a", "b"), (5, 21, key, value)])
    with pytest.raises(PySparkException, match=f"topic 'orders' partition 5 offset 21: its {field} "):
        envelope(log).collect()
    assert pairs(utf8_rejects(log), "topic", "partition", "offset", "field") == [("orders", 5, 21, field)]


def test_rejects_are_found_even_when_no_payload_is_read(make_log):
    log = make_log([(0, 0, b"\xff", b"\xff"), (0, 1, "é", "日本"), (0, 2)])
    assert utf8_rejects(log).count() == 2


def test_base64_lands_any_bytes_on_one_line(make_log):
    long = bytes(range(256))
    log = make_log([(0, 0, b"\x00\x10\x83", b"\xfb\xf0", [("note", bytearray(b"as text"))]), (0, 1, None, long)])
    first, second = envelope(log, "base64").orderBy("offset").collect()
    assert (first["key"], first["value"], first["headers"]) == ("ABCD", "+/A=", '{"note":"as text"}')
    assert second["key"] is None and "\n" not in second["value"] and len(second["value"]) == 344


def headers_of(make_log, headers):
    listed = [(name, None if raw is None else bytearray(raw)) for name, raw in headers]
    return envelope(make_log([(0, 0, None, None, listed)])).head()["headers"]


def test_repeated_header_names_become_arrays_in_first_position(make_log):
    text = headers_of(make_log, [("hop", b"x"), ("raw", b"\xfb"), ("none", None), ("hop", None), ("hop", b"y")])
    assert text == '{"hop":["x",null,"y"],"raw":"base64:+w==","none":null}'


@pytest.mark.parametrize("headers", [
    [("q", b'he said "hi"'), ("n\"me", b"[x]"), ("tab", b"\t\\")],
    [("[", b"]"), ("[", b"[]"), ("", b""), ("]\"", b"\"]")],
    [("a", None), ("a", b"\xff\xfe"), ("b", "日本".encode())],
])
def test_headers_are_json_whatever_they_hold(make_log, headers):
    wanted = {}
    for name, raw in headers:
        try:
            text = None if raw is None else raw.decode()
        except UnicodeDecodeError:
            text = {b"\xff\xfe": "base64://4="}[raw]
        wanted.setdefault(name, []).append(text)
    wanted = {n: v[0] if len(v) == 1 else v for n, v in wanted.items()}
    assert json.loads(headers_of(make_log, headers)) == wanted


def test_slice_discards_what_lies_outside_each_range(spark, make_log):
    log = make_log([(p, o) for p in (0, 1, 2) for o in range(6)])
    bounds = spark.createDataFrame([(0, 2, 4), (1, 6, 6), (2, 5, 9)], BOUNDS_DDL)
    assert pairs(read_slice(log, bounds), "partition", "offset") == [(0, 2), (0, 3), (2, 5)]


def test_slice_with_nothing_to_read(spark, make_log):
    bounds = spark.createDataFrame([(0, 6, 6)], BOUNDS_DDL)
    assert read_slice(make_log([(0, 0)]), bounds).count() == 0


@pytest.mark.parametrize("limits", [(0, 100), (0, 2)])
def test_slice_by_join_equals_slice_by_literals(spark, make_log, monkeypatch, limits):
    log = make_log([(p, o) for p in range(5) for o in range(10)])
    bounds = spark.createDataFrame([(p, p, 9 - p) for p in range(5)], BOUNDS_DDL)
    wanted = pairs(read_slice(log, bounds), "partition", "offset")
    monkeypatch.setattr("tidelog.operators.reading.LITERAL_RANGES", limits[0])
    monkeypatch.setattr("tidelog.operators.reading.SMALL_ROWS", limits[1])
    got = read_slice(log, bounds)
    assert got.columns == log.columns
    assert pairs(got, "partition", "offset") == wanted and wanted


def test_gaps_are_reported_and_counts_are_of_records(make_log):
    log = make_log([(0, 0), (0, 2), (0, 9), (1, 4)])
    assert pairs(offset_gaps(log), "partition", "records", "missing") == [(0, 3, 7), (1, 1, 0)]
    assert pairs(landed_counts(log), "partition", "messages") == [(0, 3), (1, 1)]


def test_redelivered_records_collapse(make_log):
    log = make_log([(0, 0, "a", "x"), (0, 1, "a", "x"), (1, 0, "b", "y")])
    copies = log.unionByName(log).unionByName(log)
    assert pairs(dedupe_redelivered(envelope(copies)), "partition", "offset", "key", "value") == [
        (0, 0, "a", "x"), (0, 1, "a", "x"), (1, 0, "b", "y")]


def test_compaction_keeps_the_last_value_and_obeys_tombstones(make_log):
    log = make_log([
        (0, 0, "a", "old"), (0, 1, "b", "kept"), (0, 2, "a", "new"), (0, 3, "c", "gone"), (0, 4, "c", None),
        (1, 0, "a", "elsewhere"), (1, 1, "d", None), (1, 2, "d", "back")])
    got = [(r["partition"], r["offset"], r["key"].decode(), r["value"].decode()) for r in compacted_view(log).collect()]
    assert sorted(got) == [(0, 1, "b", "kept"), (0, 2, "a", "new"), (1, 0, "a", "elsewhere"), (1, 2, "d", "back")]


@pytest.mark.parametrize("shape", [compacted_view, dedupe_redelivered])
def test_payloads_of_single_records_are_not_grouped(spark, make_log, tmp_path, shape):
    make_log([(0, o, str(o % 7), "v") for o in range(50)]).write.parquet(str(tmp_path / "log"))
    plan = shape(spark.read.parquet(str(tmp_path / "log")))._jdf.queryExecution().executedPlan().toString()
    grouped = [line for line in plan.splitlines() if "SortAggregate" in line]
    # Only the copies of repeated records are: the partial and the final step of their own branch.
    assert len(grouped) == (0 if shape is compacted_view else 2)


def test_copies_of_one_record_may_be_most_of_the_rows(make_log):
    copies = make_log([(0, 5, "hot", "same")] * 60 + [(0, o, "k", str(o)) for o in range(5)] + [(1, 5, "k", "other")] * 2)
    assert pairs(dedupe_redelivered(envelope(copies)), "partition", "offset", "value") == [
        *[(0, o, str(o)) for o in range(5)], (0, 5, "same"), (1, 5, "other")]
