"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm.common import staged, table
from tidelog.llm.decontaminate import drop_contaminated
from tidelog.llm.line_dedup import drop_boilerplate
from tidelog.llm.near_dup import drop_near_duplicates
from tidelog.llm.packing import pack, public_tokenizer
from tidelog.llm.toxicity import drop_toxic


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Python gets at most BATCH_ROWS whole texts at once, for the rest of the session: a batch is held by the JVM and by its worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7."""
    small_batches(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of ten sites or more, but for one document that keeps each such line."""
    return drop_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8: five-word shingles, full sets."""
    small_batches(spark)
    return drop_near_duplicates(docs, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, within an edit for each 20 of its characters."""
    small_batches(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 1024; see op6."""
    small_batches(spark)
    return pack(docs, public_tokenizer())


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

# The first stage is a trained classifier and the last a tokenizer and a search: SQL can express neither. The tests hold
# each stage's operator against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents. Null ids and texts, repeated rows and more columns are as the stages say."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
