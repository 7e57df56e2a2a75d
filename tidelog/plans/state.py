"""Stored tokens: the two newest of each topic, in turns, so a crash leaves the old one or the new one, never none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import path_exists

STATE_DDL = "token string, run bigint, topic string, slot int"
SLOTS = 2


def store_token(token: DataFrame, path: str, run: int) -> None:
    """Put the token of run number ``run`` in the place of the last but one; call it after the slice has landed."""
    stored = token.select(
        "token", F.lit(run).cast("bigint").alias("run"), "topic", F.lit(run % SLOTS).cast("int").alias("slot"))
    (
        stored.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("topic", "slot").parquet(path)
    )


def stored_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The latest token of every topic, without what streams keep beside it (their names hold '#')."""
    return _latest(spark.read.schema(STATE_DDL).parquet(path).where(~F.contains("topic", F.lit("#"))))


def _latest(states: DataFrame) -> DataFrame:
    return states.groupBy("topic").agg(F.max_by("token", "run").alias("token"), F.max("run").alias("run"))


def load_token(
    spark: SparkSession, path: str, topic: str, up_to: int | None = None
) -> tuple[str | None, int]:
    """(token text or None, number of the run that wrote it or 0), of runs numbered ``up_to`` at most."""
    mine = F.col("topic") == topic
    if up_to is not None:
        mine = mine & (F.col("run") <= up_to)
    if not path_exists(spark, path):
        return None, 0
    row = _latest(spark.read.schema(STATE_DDL).parquet(path).where(mine)).head()
    return (row["token"], row["run"]) if row else (None, 0)
