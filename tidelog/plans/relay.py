"""A projection between a feed and a sink. The caller names its columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.options import WriteOptions
from tidelog.sinks.records import to_records

SOURCE_ORDER = "source_order"


def projected(landed: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """The named columns of the envelope, in no order."""
    return landed.select(*[column.alias(name) for name, column in columns.items()])


def relay(landed: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """The projection in log order.

    The order is a range sort on (partition, offset), so a hot partition spreads over many tasks.
    """
    return projected(landed.orderBy("partition", "offset"), columns)


def relay_records(landed: DataFrame, write: WriteOptions, columns: Mapping[str, Column], partitions: int) -> DataFrame:
    """The projection as records, with ``source_order`` for append_to_log to number them by.

    A log orders its records itself, so nothing is sorted or staged here. ``partitions`` is how many the
    read topic has; it keeps the order unique, as partitions count from 0.
    """
    order = (F.col("offset") * partitions + F.col("partition")).alias(SOURCE_ORDER)
    rows = landed.select(*[column.alias(name) for name, column in columns.items()], order)
    return to_records(rows, write, keep=(SOURCE_ORDER,))
