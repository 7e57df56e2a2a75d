"""Payload bytes to text, and headers to JSON text. All in-row, all inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_text(raw: Column) -> Column:
    """Whether the bytes are valid UTF-8; null counts as text."""
    return F.coalesce(F.is_valid_utf8(raw.cast("string")), F.lit(True))


def base64_text(raw: Column) -> Column:
    """Base64 on one line; Spark's own breaks lines after 76 characters."""
    return F.replace(F.base64(raw), F.lit("\r\n"), F.lit(""))


def strict_text(raw: Column, field: str) -> Column:
    """UTF-8 text, or a failed job that names the record. Never a replacement character."""
    refusal = F.raise_error(F.concat(
        F.lit("topic '"), F.col("topic"), F.lit("' partition "), F.col("partition").cast("string"),
        F.lit(" offset "), F.col("offset").cast("string"),
        F.lit(f": its {field} holds bytes that are no UTF-8 text; encoding base64 would land them"),
    ))
    return F.when(is_text(raw), raw.cast("string")).otherwise(refusal.cast("string"))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, which lambdas otherwise repeat at each use."""
    return F.transform(F.array(value), body)[0]


def _bare(listed: Column) -> Column:
    """A one-element JSON array of a string or null without its brackets; text inside is in quotes."""
    return F.btrim(listed, F.lit("[]"))


def header_text(raw: Column) -> Column:
    """A header value as text. Headers never stop a read: other bytes become marked base64."""
    return F.coalesce(F.try_validate_utf8(raw.cast("string")), F.concat(F.lit("base64:"), base64_text(raw)))


def headers_json(headers: Column) -> Column:
    """A JSON object of name to value; a repeated name holds an array and keeps its first position."""
    names = F.array_distinct(F.transform(headers, lambda h: h["key"]))
    texts = F.transform(headers, lambda h: F.struct(h["key"], header_text(h["value"]).alias("text")))

    def member(name: Column, entries: Column) -> Column:
        values = F.transform(F.filter(entries, lambda e: e["key"] == name), lambda e: e["text"])
        written = _bind(values, lambda v: F.when(F.size(v) == 1, _bare(F.to_json(v))).otherwise(F.to_json(v)))
        return F.concat(_bare(F.to_json(F.array(name))), F.lit(":"), written)

    grouped = _bind(texts, lambda es: F.array_join(F.transform(names, lambda n: member(n, es)), ","))
    return (
        F.when(F.coalesce(F.size(headers), F.lit(0)) <= 0, F.lit("{}"))
        # Names rarely repeat; without repeats the headers are a map.
        .when(F.size(names) == F.size(headers), F.to_json(F.map_from_entries(texts)))
        .otherwise(F.concat(F.lit("{"), grouped, F.lit("}")))
    )
