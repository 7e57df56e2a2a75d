"""Which failures a retry may cure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.errors import TRANSIENT_CODES


def is_transient(code: Column) -> Column:
    """False for unknown codes and for no code at all."""
    return F.coalesce(code.isin(*TRANSIENT_CODES), F.lit(False))


def classify_errors(reports: DataFrame, column: str = "code") -> DataFrame:
    return reports.withColumn("transient", is_transient(F.col(column)))
