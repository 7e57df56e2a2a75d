"""Session helpers: a local session for tests and bench, the shared scratch folder, small tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Partition-level tables (watermarks, bounds, tokens) have one row per topic partition. Up to this
# many rows they go to the driver or into a broadcast (24 bytes a row); past it they are staged.
SMALL_ROWS = 200_000


def local_session(app: str = "tidelog", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session. On a cluster, bring your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Stack traces for every column call make plans several times slower to build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Feed timestamps are UTC text and UTC instants, so the session zone has to be UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_footer_statistics(spark: SparkSession) -> SparkSession:
    """Let watermarks of a stored log come from Parquet footers, so they cost files and not records.

    Needs the v2 Parquet reader, for the whole session.
    """
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: the one the session names, on every executor's reach."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="tidelog-")
        spark.sparkContext.setCheckpointDir(root)
        return root
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of its own file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/tidelog/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage for good."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_rows(df: DataFrame, limit: int = SMALL_ROWS) -> list | None:
    """The rows of a partition-level table, or None when there are more than ``limit``."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def local_table(spark: SparkSession, rows: Iterable, schema: str | T.StructType) -> DataFrame:
    """A small table that is part of the plan, with its size known to Catalyst.

    ``rows`` are tuples or Rows in schema order.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(schema)
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(values), f.type) for values, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def snapshot(df: DataFrame, name: str, limit: int = SMALL_ROWS) -> DataFrame:
    """Evaluate a partition-level table once, so that a run cannot see it change underneath."""
    rows = small_rows(df, limit)
    if rows is None:
        return stage(df, name)
    return local_table(df.sparkSession, rows, df.schema)
