"""What several operators of this folder share: staged tables, folds, ranks without a hot task, components."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.session import stage


def staged(df: DataFrame) -> DataFrame:
    """The rows of df as a table under spark.checkpoint.dir: its lineage ends there, and a lost executor costs a new read."""
    return stage(df, "llm")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels nobody may learn from: crc32(doc_id as text) mod 3 is 1. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """doc_id and y (0 or 1) of the labels outside the held-out fold. Ids labelled both ways, or null, are left out."""
    return (
        labels.select(F.col("doc_id").alias("id"), F.col(column).cast("int").alias("y"))
        .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other"))
        .filter(F.col("y") == F.col("other")).select("id", "y")
    )


def share_of(n: int, bound: int, key: Column, seed: int, *salt: Column) -> Column:
    """True for about bound of n rows, chosen by a hash of key; for all rows if there are no more than bound.

    Rows with one key are chosen all or none. salt takes in what tells them apart, as the text of rows with one id or none.
    """
    if n <= bound:
        return F.lit(True)
    return F.xxhash64(F.lit(seed), key, *salt).bitwiseAND(F.lit((1 << 40) - 1)) < F.lit(int((1 << 40) * bound / n))


def same(names: list[str], left: str, right: str) -> Column:
    """Equality of some columns in which null equals null."""
    parts = [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names]
    return functools.reduce(operator.and_, parts, F.lit(True))


def ranked(df: DataFrame, keys: list[str], block: str, order: list[str], name: str) -> DataFrame:
    """df with a gapless number from 0 within keys, by block and then by order.

    block is a column of df that cuts each key's rows into ordered pieces of bounded size. A window runs within a
    piece only; how many rows the pieces before it hold comes from counts, so a key with a third of all rows is
    no task of its own. df is read twice and has to give the same rows both times.
    """
    parts = [*keys, block]
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy(*parts).agg(F.count("*").alias("held")).withColumn(
        "ahead", F.coalesce(F.sum("held").over(before), F.lit(0)))
    within = Window.partitionBy(*parts).orderBy(*order)
    numbered = df.withColumn("place_in_block", F.row_number().over(within) - 1)
    out = numbered.alias("l").join(starts.alias("r"), same(parts, "l", "r"))
    return out.select("l.*", (F.col("r.ahead") + F.col("l.place_in_block")).alias(name)).drop("place_in_block")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (src, dst): the smallest node that it reaches.

    Alternating large-star and small-star steps: each step links a node's neighbours to the smallest of them, so
    chains shorten by halves. Each step is one aggregation, merged before its shuffle, and one join, which Spark
    splits where a node is hot. Steps end in written tables. Self links are fine, nulls take no part.
    """
    spark = edges.sparkSession
    now = staged(
        edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .filter(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct())
    nodes = now.select(F.col("src").alias("node")).union(now.select("dst")).distinct()
    links = now.filter("src != dst")
    if links.isEmpty():
        return nodes.select("node", F.col("node").alias("component"))

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    seen = mark(links)
    while True:
        both = links.union(links.select("dst", "src"))
        least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("root"))
        large = (
            both.filter("dst > src").alias("b").join(least.alias("m"), F.col("b.src") == F.col("m.src"))
            .select(F.col("b.dst").alias("src"), F.col("m.root").alias("dst")).filter("src != dst").distinct())
        large = staged(large)
        least = large.groupBy("src").agg(F.min("dst").alias("root"))
        small = large.alias("b").join(least.alias("m"), F.col("b.src") == F.col("m.src"))
        small = small.select(F.explode(F.array("b.src", "b.dst")).alias("src"), F.col("m.root").alias("dst"))
        links = staged(small.filter("src != dst").distinct())
        now_seen = mark(links)
        if now_seen == seen:
            break
        seen = now_seen
    out = nodes.alias("n").join(links.alias("l"), F.col("n.node") == F.col("l.src"), "left")
    return staged(out.select("n.node", F.coalesce("l.dst", "n.node").alias("component")))
