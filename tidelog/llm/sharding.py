"""Shards that all have the corpus's mixture of sources: proportional stratified interleaving. DataFrame work only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ranked, staged

DIGITS = 13  # of an md5, 52 bits
BLOCK_ROWS = 50_000


def _fraction(text: Column) -> Column:
    """A hash of text as 52 bits; a double holds it exactly."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("long")


def interleave(documents: DataFrame, shards: int, *, seed: int = 42) -> DataFrame:
    """doc_id, source, size, text_crc32, shard and slot of each row (doc_id, text, source).

    Within its source a row has a rank by a seeded hash of its doc_id (ties: by text). Its place is
    (rank + u) / rows of the source, u a seeded hash of the source between 0 and 1, so each source is spread evenly over
    the whole order and small sources start at different points. Sorted by place, the rows are cut into shards whose
    counts differ by one at most. Between two places each source has its share, give or take one row; that rounding of
    m sources together can shift a cut by m rows at most, so in a shard by n * m / total rows of a source of n.

    A null source is a source, null ids and repeated rows are ranked like others, a null text has size 16. Any source
    may hold most of the rows: ranks and places come from blocks of the hash of about BLOCK_ROWS rows each, and only
    counts are added up over blocks.
    """
    raw = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    rows = staged(documents.select(
        "doc_id", "source", raw.alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        _fraction(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))).alias("draw")))
    total = rows.count()
    blocks = max(1, -(-total // BLOCK_ROWS))
    scale = float(1 << 52)
    piece = F.floor(F.col("draw") * F.lit(blocks) / F.lit(scale)).cast("int")
    order = ["draw", "doc_id", "text_crc32", "size"]
    in_source = ranked(rows.withColumn("piece", piece), ["source"], "piece", order, "rank").drop("piece")
    sizes = rows.groupBy("source").agg(F.count("*").alias("held")).withColumnRenamed("source", "of")
    start = _fraction(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("source"), F.lit("-")))) / F.lit(scale)
    placed = (
        in_source.join(sizes, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("place", (F.col("rank") + start) / F.col("held"))
        .withColumn("piece", F.least(F.floor(F.col("place") * blocks), F.lit(blocks - 1)).cast("int")))
    order = ranked(staged(placed), [], "piece", ["place", "source", "rank"], "position")
    return (
        order.withColumn("shard", F.expr(f"position * {shards} div {max(1, total)}").cast("int"))
        .withColumn("slot", F.col("position") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}"))
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot"))
