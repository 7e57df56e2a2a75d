"""Running folds along one sequence per key, when one key may hold a third of all rows.

A window over a whole key is one task. Here a key's rows are cut into blocks by the high bits of
their sequence number. Numbers are unique in a key, so a block holds at most 2**BLOCK_BITS rows,
however skewed the keys are. Windows run inside blocks, and each block gets the fold of all blocks
before it, found the same way one level up on one row per block. Nothing is sampled, staged or
collected, these folds are not broadcast, and a lost executor recomputes the same blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 21  # three levels (21 + 21 + 22) cover a signed 64-bit sequence

Fold = Callable[[Column], Column]
Combine = Callable[[Column, Column], Column]


def block_of(seq: Column, bits: int = BLOCK_BITS) -> Column:
    # Never null, so joins on it add no filter and both uses of the block totals are one shuffle.
    return F.coalesce(F.shiftright(seq.cast("bigint"), bits), F.lit(0).cast("bigint"))


def _whole_key(keys: Sequence[str]) -> Column:
    """The keys as one value that is never null itself, so rows whose key is null meet their own block's carry."""
    return F.struct(*keys)


def _unsent(carry: DataFrame) -> DataFrame:
    """Not to be broadcast: up to a row for each key and block, and Spark may take it for far smaller than it is.

    The rows that meet it are already dealt out and sorted by key and block, so a merge join moves none of them.
    """
    return carry.hint("merge")


def block_carry(
    partials: DataFrame, keys: Sequence[str], columns: Sequence[str],
    fold: Fold, combine: Combine, bits: int = BLOCK_BITS, top_bits: int = 64 - BLOCK_BITS,
) -> DataFrame:
    """Per (keys, _block), the fold of ``columns`` over all earlier blocks of the same keys.

    ``partials`` has one row per (keys, _block). ``top_bits`` is how many bits _block may use.
    """
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    if top_bits <= bits + 1:
        whole = before.partitionBy(*keys)
        return partials.select(*keys, "_block", *[fold(F.col(c)).over(whole).alias(c) for c in columns])
    partials = partials.withColumn("_super", block_of(F.col("_block"), bits))
    near = before.partitionBy(*keys, "_super")
    inner = partials.select(
        *keys, "_super", "_block", *[fold(F.col(c)).over(near).alias(f"_in_{c}") for c in columns])
    supers = partials.groupBy(*keys, F.col("_super").alias("_block")).agg(*[fold(F.col(c)).alias(c) for c in columns])
    outer = block_carry(supers, keys, columns, fold, combine, bits, top_bits - bits)
    outer = outer.select(*keys, F.col("_block").alias("_super"), *[F.col(c).alias(f"_out_{c}") for c in columns])
    joined = inner.join(_unsent(outer), [*keys, "_super"])
    return joined.select(
        *keys, "_block",
        *[combine(F.col(f"_in_{c}"), F.col(f"_out_{c}")).alias(c) for c in columns])


def _add(a: Column, b: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.coalesce(a, zero) + F.coalesce(b, zero)


def dense_rank_in_order(
    df: DataFrame, keys: Sequence[str], seq: str, out: str, bits: int = BLOCK_BITS, starts: DataFrame | None = None
) -> DataFrame:
    """Number each key's rows in ``seq`` order without gaps; ``seq`` is a bigint unique within the key.

    Numbers begin at 0, or at ``start`` of ``starts`` (keys, start), which meets the block totals
    only and never the rows.
    """
    zero = F.lit(0).cast("bigint")
    blocked = df.withColumn("_key", _whole_key(keys)).withColumn("_block", block_of(F.col(seq), bits))
    partials = blocked.groupBy("_key", "_block").agg(F.count(F.lit(1)).alias("_n"))
    carry = block_carry(partials, ["_key"], ["_n"], F.sum, _add, bits, 64 - bits)
    if starts is not None:
        carry = carry.join(starts.select(_whole_key(keys).alias("_key"), "start"), "_key", "left").select(
            "_key", "_block", _add(F.col("_n"), F.col("start")).alias("_n"))
    in_block = Window.partitionBy("_key", "_block").orderBy(seq)
    local = blocked.withColumn("_rank", F.row_number().over(in_block).cast("bigint") - 1)
    joined = local.join(_unsent(carry), ["_key", "_block"])
    return joined.select(*df.columns, (F.col("_rank") + F.coalesce("_n", zero)).alias(out))


def running_max_before(
    df: DataFrame, keys: Sequence[str], seq: str, columns: dict[str, str], bits: int = BLOCK_BITS,
    starts: DataFrame | None = None,
) -> DataFrame:
    """Per row, the maximum of each column over the key's earlier rows (null on the first).

    ``columns`` maps a column to the name of its running maximum. ``starts`` (keys, columns; one row per key) are maxima from
    before the first row; like block totals they meet the carry only and never the rows.
    """
    blocked = df.withColumn("_key", _whole_key(keys)).withColumn("_block", block_of(F.col(seq), bits))
    partials = blocked.groupBy("_key", "_block").agg(*[F.max(c).alias(c) for c in columns])
    carry = block_carry(partials, ["_key"], list(columns), F.max, F.greatest, bits, 64 - bits)
    if starts is not None:
        held = starts.select(_whole_key(keys).alias("_key"), *[F.col(c).alias(f"_start_{c}") for c in columns])
        carry = carry.join(_unsent(held), "_key", "left").select(
            "_key", "_block", *[F.greatest(c, f"_start_{c}").alias(c) for c in columns])
    carry = carry.select("_key", "_block", *[F.col(c).alias(f"_carry_{c}") for c in columns])
    before = Window.partitionBy("_key", "_block").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    local = blocked.select("*", *[F.max(c).over(before).alias(f"_local_{c}") for c in columns])
    joined = local.join(_unsent(carry), ["_key", "_block"])
    return joined.select(
        *df.columns,
        *[F.greatest(f"_local_{c}", f"_carry_{c}").alias(name) for c, name in columns.items()])
