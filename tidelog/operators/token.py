"""The offset token: next offset to read per partition of one topic, as byte-stable JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.errors import FeedRefused
from tidelog.schema import TOKEN_DDL
from tidelog.session import local_table

TOKEN_VERSION = 1


def advance_token(topic: str, effective: DataFrame) -> DataFrame:
    """One row (topic, token): ``{"v":1,"topic":..,"partitions":{"0":n,..}}`` in numeric partition order.

    Built from bounds, not from rows, so a run with nothing to read still yields one. The grouped
    list has one entry per topic partition. Store it only after the slice is safely landed.
    """
    entries = F.array_sort(F.collect_list(F.struct("partition", "bound")))
    named = F.transform(entries, lambda e: F.struct(e["partition"].cast("string"), e["bound"]))
    body = F.struct(
        F.lit(TOKEN_VERSION).alias("v"), F.lit(topic).alias("topic"),
        F.map_from_entries(named).alias("partitions"),
    )
    return effective.agg(F.to_json(body).alias("token")).select(F.lit(topic).alias("topic"), "token")


def _kind(part: Column) -> Column:
    return F.schema_of_variant(part)


def parse_tokens(tokens: DataFrame, column: str = "token", topic: str | None = None) -> DataFrame:
    """Add ``partitions`` (map<int,bigint>) and ``problem`` (null when usable) to stored tokens.

    Refused: text that is not one JSON value, a missing or other version, no topic or partitions, a
    partition that is not a plain number, an offset that is not a whole number from 0 up, and a
    token of another topic. A partition named twice keeps its last offset.
    """
    shape = "array<struct<v: variant, topic: variant, partitions: map<string, variant>>>"
    # Read as the only element of an array, so that text after the token does not pass.
    listed = F.concat(F.lit("["), F.col(column), F.lit("]"))
    parsed = tokens.withColumn("_t", F.from_json(listed, shape))
    root = F.col("_t")[0]
    version = F.when(_kind(root["v"]) == "BIGINT", F.try_variant_get(root["v"], "$", "int"))
    named = F.when(_kind(root["topic"]) == "STRING", F.try_variant_get(root["topic"], "$", "string"))
    typed = F.transform(
        F.map_entries(root["partitions"]),
        lambda e: F.struct(
            F.when(e["key"].rlike("^[0-9]+$"), e["key"].try_cast("int")).alias("partition"),
            F.when(_kind(e["value"]) == "BIGINT", F.try_variant_get(e["value"], "$", "bigint")).alias("next_offset"),
        ),
    )
    is_json = F.get_json_object(listed, "$").isNotNull() & (F.coalesce(F.size("_t"), F.lit(0)) <= 1)
    parsed = parsed.select(
        *tokens.columns, version.alias("_v"), named.alias("_topic"), typed.alias("_entries"), is_json.alias("_json")
    )
    bad_entry = F.exists(
        "_entries", lambda e: e["partition"].isNull() | e["next_offset"].isNull() | (e["next_offset"] < 0)
    )
    problem = (
        F.when(~F.col("_json"), F.lit("no JSON value"))
        .when(F.col("_v").isNull(), F.lit("states no version"))
        .when(F.col("_v") != TOKEN_VERSION,
              F.format_string(f"of version %d instead of {TOKEN_VERSION}", F.col("_v")))
        .when(F.col("_topic").isNull() | F.col("_entries").isNull(), F.lit("lacks topic or partitions"))
    )
    if topic is not None:
        problem = problem.when(F.col("_topic") != topic, F.lit("of another topic"))
    problem = problem.when(bad_entry, F.lit("holds an entry that is no partition with an offset"))
    judged = parsed.withColumn("problem", problem)
    entries = F.col("_entries")
    last_wins = F.aggregate(
        entries, F.expr("cast(map() as map<int, bigint>)"),
        lambda acc, e: F.map_concat(
            F.map_filter(acc, lambda k, _: k != e["partition"]),
            F.create_map(e["partition"], e["next_offset"])),
    )
    unique = F.size(F.array_distinct(entries["partition"])) == F.size(entries)
    offsets = F.when(unique, F.map_from_entries(entries)).otherwise(last_wins)
    return judged.select(
        *tokens.columns,
        F.when(F.col("problem").isNull(), offsets).alias("partitions"),
        "problem",
    )


def token_offsets(parsed: DataFrame) -> DataFrame:
    """(partition, next_offset) of the usable tokens of ``parse_tokens``, with their other columns."""
    keep = [c for c in parsed.columns if c not in ("partitions", "problem")]
    return parsed.where(F.col("problem").isNull()).select(
        *keep, F.explode("partitions").alias("partition", "next_offset")
    )


def parse_token(spark: SparkSession, text: str | None, topic: str) -> DataFrame | None:
    """One stored token as (partition, next_offset); None or empty text means no token.

    The refusal never repeats the token: it is opaque state and must not leak into reports.
    """
    if not text:
        return None
    parsed = parse_tokens(local_table(spark, [(text,)], "token string"), topic=topic)
    row = parsed.select("partitions", "problem").head()
    if row["problem"] is not None:
        raise FeedRefused(
            f"topic '{topic}': its token is unusable ({row['problem']}). Remove it and let 'start' decide"
        )
    return local_table(spark, sorted(row["partitions"].items()), TOKEN_DDL)
