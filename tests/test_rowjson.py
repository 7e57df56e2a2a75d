import json
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tidelog.functions.rowjson import row_json

EVERY_TYPE = "day date, seen timestamp, berth int, ship string, tons decimal(38,9), draught double, moored boolean, imo bigint"
WHEN = datetime(2025, 3, 4, 5, 6, 7, 80900)


def written(df, columns=None):
    return [r[0] for r in df.select(row_json(df, columns)).collect()]


def test_each_type_has_its_spelling(spark):
    rows = [
        (date(2025, 3, 4), WHEN, -12, 'the "Gull"\n', Decimal("-0.5"), 6.25, False, 9_876_543_210_123),
        (None, None, None, None, None, float("nan"), None, None),
    ]
    full, empty = written(spark.createDataFrame(rows, EVERY_TYPE))
    assert full == (
        '{"day":"2025-03-04","seen":"2025-03-04T05:06:07.080900Z","berth":-12,"ship":"the \\"Gull\\"\\n",'
        '"tons":"-0.500000000","draught":6.25,"moored":false,"imo":9876543210123}')
    assert json.loads(empty) == dict.fromkeys(part.split()[0] for part in EVERY_TYPE.split(", "))


def test_decimals_keep_all_38_digits_and_no_exponent(spark):
    wide = Decimal("-" + "98765" * 5 + "4321" + ".000000007")
    df = spark.createDataFrame([(wide,), (Decimal("0"),), (Decimal("0.000000002"),)], "a decimal(38,9)")
    assert [json.loads(t)["a"] for t in written(df)] == [f"{wide:f}", "0.000000000", "0.000000002"]


def test_doubles_are_numbers_or_null(spark):
    values = [0.1, -2.5e300, 1e-7, 12345678.9, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [json.loads(t)["x"] for t in written(df)] == [0.1, -2.5e300, 1e-7, 12345678.9, None, None, None, None]


def test_nested_values_keep_nulls_at_every_level(spark):
    schema = "hold struct<deck: int, goods: array<string>>"
    df = spark.createDataFrame([((3, [None, "rope", None]),), (None,), ((None, None),), ((4, []),)], schema)
    assert [json.loads(t)["hold"] for t in written(df)] == [
        {"deck": 3, "goods": [None, "rope", None]}, None, {"deck": None, "goods": None}, {"deck": 4, "goods": []}]


def test_the_same_rules_hold_inside_nested_values(spark):
    schema = ("rows array<struct<x: double, p: decimal(10,2), at: timestamp>>, "
              "m map<string, double>, days map<date, decimal(5,1)>, none array<double>")
    df = spark.createDataFrame([(
        [(float("nan"), Decimal("1.5"), WHEN), None, (2.5, None, None)],
        {"a": float("inf"), "b": 0.5, "c": None}, {date(2026, 1, 2): Decimal("3")}, None)], schema)
    assert json.loads(written(df)[0]) == {
        "rows": [{"x": None, "p": "1.50", "at": "2025-03-04T05:06:07.080900Z"}, None,
                 {"x": 2.5, "p": None, "at": None}],
        "m": {"a": None, "b": 0.5, "c": None}, "days": {"2026-01-02": "3.0"}, "none": None}


def test_column_order_and_odd_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`b.c` int, a int, `tick``s` int")
    assert written(df) == ['{"b.c":1,"a":2,"tick`s":3}']
    assert written(df, ["a"]) == ['{"a":2}']
    assert written(df, []) == ["{}"]


def test_local_timestamps_read_as_utc(spark):
    df = spark.sql("select timestamp_ntz'2024-01-02 03:04:05.6' as t")
    assert written(df) == ['{"t":"2024-01-02T03:04:05.600000Z"}']


def test_text_is_escaped_only_where_json_needs_it(spark):
    text = 'é <b> & + / \\ \t \u0001'
    df = spark.createDataFrame([(text,)], "s string")
    assert json.loads(written(df)[0]) == {"s": text}
    assert "é <b> & + /" in written(df)[0]
    assert df.select(F.length("s")).head()[0] == len(text)
