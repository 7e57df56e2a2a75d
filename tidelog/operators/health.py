"""Tables about runs: client statistics and delivery failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.classify import is_transient
from tidelog.operators.prefix import BLOCK_BITS, running_max_before

COUNTERS = ("tx", "tx_bytes", "rx_bytes")


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _whole(found: Column) -> Column:
    """A whole JSON number, else 0. Strings and fractions count as 0, so the kind is checked first."""
    whole = F.schema_of_variant(found) == "BIGINT"
    return F.when(whole, F.try_variant_get(found, "$", "bigint")).otherwise(_zero())


def _once(value: Column) -> Column:
    """A value as a row of its own: found once, however often it is used, and not again by a filter that is pushed down."""
    return F.explode(F.array(value))


def parse_ticks(ticks: DataFrame, column: str = "stats") -> DataFrame:
    """Replace the statistics JSON by its cumulative counters; ticks that are not JSON objects are ignored.

    A member that a tick repeats counts with its last value. No variant can hold such an object and a text that is no variant
    costs an exception, so only the counters are read as variants, and the whole text only where that finds no single object.
    """
    kept = [c for c in ticks.columns if c != column]
    text, shape = F.col("_text"), f"array<struct<{', '.join(f'{c}: variant' for c in COUNTERS)}>>"
    told = ticks.select(*kept, _once(F.col(column)).alias("_text")).where(text.rlike(r"^\s*\{"))
    listed = F.concat(F.lit("["), text, F.lit("]"))
    listed = F.when(F.json_array_length(listed) == 1, F.from_json(listed, shape, {"allowSingleQuotes": "false"}))
    listed = told.select(*kept, "_text", _once(listed).alias("_listed"))
    # Text after the object's end, which no list can hold, is left unread.
    whole = F.when(F.size("_listed") == 1, F.lit(None).cast("variant")).otherwise(F.try_parse_json(text))
    read = listed.select(*kept, "_listed", _once(whole).alias("_tick"))
    member = {c: F.coalesce(F.col("_listed")[0][c], F.try_variant_get("_tick", f"$.{c}", "variant")) for c in COUNTERS}
    an_object = (F.size("_listed") == 1) | F.schema_of_variant("_tick").startswith("OBJECT")
    # Numbers and not variants leave the last step: a variant counts as 2 KB, so Spark would take what comes after for nearly nothing.
    found = F.struct(*[_whole(member[c]).alias(c) for c in COUNTERS])
    return read.where(an_object).select(*kept, _once(found).alias("_found")).select(*kept, "_found.*")


def tick_deltas(
    counters: DataFrame, client: str = "client", seq: str = "seq", bits: int = BLOCK_BITS, before: DataFrame | None = None
) -> DataFrame:
    """Per tick, what it adds: requests from tx, wire bytes from tx_bytes and rx_bytes.

    A delta is measured against the highest value so far, so a counter that falls back adds nothing.
    ``seq`` is a bigint unique within a client. ``before`` are highs (client, tx, tx_bytes, rx_bytes) of earlier ticks.
    """
    highs = {c: f"_prev_{c}" for c in COUNTERS}
    seen = running_max_before(counters, [client], seq, highs, bits, before)

    def delta(name: str) -> Column:
        previous = F.greatest(F.col(highs[name]), _zero())
        return F.greatest(F.col(name) - previous, _zero())

    return seen.select(
        *counters.columns, delta("tx").alias("requests"),
        (delta("tx_bytes") + delta("rx_bytes")).alias("wire_bytes"),
    )


def counter_highs(counters: DataFrame, client: str = "client", before: DataFrame | None = None) -> DataFrame:
    """The highest counters of each client, from ``before`` on; a client without ticks here keeps what it had."""
    told = counters.select(client, *COUNTERS)
    if before is not None:
        told = told.unionByName(before.select(client, *COUNTERS))
    return told.groupBy(client).agg(*[F.max(c).alias(c) for c in COUNTERS])


def stats_totals(counters: DataFrame, client: str = "client") -> DataFrame:
    """Requests and wire bytes per client.

    The deltas of a counter sum to its maximum, in whatever order ticks came. So totals need no
    window: one aggregation, merged on the map side before its shuffle.
    """
    def total(name: str) -> Column:
        return F.greatest(F.max(name), _zero())

    return counters.groupBy(client).agg(
        total("tx").alias("requests"), (total("tx_bytes") + total("rx_bytes")).alias("wire_bytes")
    )


def with_request_floor(clients: DataFrame, totals: DataFrame, client: str = "client") -> DataFrame:
    """Every client once; one that closed before its first tick still made one request."""
    once = clients.select(client).distinct()
    return once.join(totals, client, "left").select(
        client,
        F.coalesce("requests", F.lit(1).cast("bigint")).alias("requests"),
        F.coalesce("wire_bytes", _zero()).alias("wire_bytes"),
    )


def first_failure(reports: DataFrame, session: str = "session", seq: str = "seq") -> DataFrame:
    """Every write session with the failure that decides it, its earliest; all but the session is null on success."""
    when_failed = F.when(F.col("code").isNotNull(), F.col(seq))
    first = reports.groupBy(session).agg(F.min_by(F.struct(seq, "code", "reason"), when_failed).alias("first"))
    code = F.col("first.code")
    return first.select(
        session, F.col(f"first.{seq}").alias(seq), code.alias("code"), F.col("first.reason").alias("reason"),
        F.when(code.isNotNull(), is_transient(code)).alias("transient"),
    )
