"""Client statistics as an incremental run: new ticks in, their deltas out, the highest counters kept for the next run."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.health import COUNTERS, counter_highs, parse_ticks, tick_deltas
from tidelog.operators.prefix import BLOCK_BITS
from tidelog.plans.state import SLOTS, load_token, store_token
from tidelog.session import local_table, path_exists, stage


def _highs_folder(state_path: str, name: str, run: int) -> str:
    return f"{state_path}/highs/{quote(name, safe='')}/slot={run % SLOTS}"


def _deltas_folder(landed_path: str, name: str) -> str:
    return f"{landed_path}/stats={quote(name, safe='')}"


def land_deltas(
    ticks: DataFrame, name: str, landed_path: str, state_path: str, client: str = "client", seq: str = "seq",
    column: str = "stats", bits: int = BLOCK_BITS,
) -> int:
    """Land what each new tick adds as this run's folder, and keep the highest counters of each client. Gives the run's number.

    ``ticks`` are those that no earlier run took, such as the slice of a feed run. They are parsed once and staged as numbers.
    The highs have one row per client and are replaced, in two folders by turns; the run's own number is stored last and is the
    commit. A run that ended before it reads the highs of the run before once more and replaces both of its folders, so no
    tick counts twice. A client that no run has seen starts at 0, and one without new ticks keeps its highs.
    """
    spark = ticks.sparkSession
    _, last = load_token(spark, f"{state_path}/commits", name)
    run = last + 1
    counters = stage(parse_ticks(ticks.select(client, seq, column), column), "ticks")
    before = None
    if last:
        counts = [T.StructField(c, T.LongType()) for c in COUNTERS]
        before = spark.read.schema(T.StructType([counters.schema[client], *counts])).parquet(
            _highs_folder(state_path, name, last))
    tick_deltas(counters, client, seq, bits, before).write.mode("overwrite").parquet(
        f"{_deltas_folder(landed_path, name)}/run={run}")
    counter_highs(counters, client, before).write.mode("overwrite").parquet(_highs_folder(state_path, name, run))
    done = local_table(spark, [(name, str(run))], "topic string, token string")
    store_token(done, f"{state_path}/commits", run)
    return run


def landed_deltas(spark: SparkSession, landed_path: str, state_path: str, name: str) -> DataFrame | None:
    """The deltas of all committed runs, with ``run``; None before the first one."""
    _, last = load_token(spark, f"{state_path}/commits", name)
    folder = _deltas_folder(landed_path, name)
    if not last or not path_exists(spark, folder):
        return None
    return spark.read.parquet(folder).where(F.col("run") <= last)
