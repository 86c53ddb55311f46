"""Shards, batches and rank shares from global positions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.positions import POSITION
from textloom.sources.tables import SHARD


def shard_count(n_rows: int, shard_rows: int) -> int:
    return math.ceil(n_rows / shard_rows)


def shard_of(position: Column, n_rows: int, shards: int) -> Column:
    """Balanced blocks of consecutive positions; the first ones are one row longer."""
    size, longer = divmod(n_rows, max(shards, 1))
    head = longer * (size + 1)
    in_head = F.floor(position / F.lit(size + 1))
    if size == 0:
        return in_head
    in_tail = F.lit(longer) + F.floor((position - head) / F.lit(size))
    return F.when(position < head, in_head).otherwise(in_tail)


def assign_shards(positioned: DataFrame, n_rows: int, shard_rows: int) -> DataFrame:
    """Add ``shard_id``; no shard is larger than ``shard_rows``."""
    shards = shard_count(n_rows, shard_rows)
    return positioned.withColumn(SHARD, shard_of(F.col(POSITION), n_rows, shards))


def assign_batches(positioned: DataFrame, batch_size: int) -> DataFrame:
    """Add ``batch_id``: consecutive groups of ``batch_size``, the last may be short."""
    return positioned.withColumn("batch_id", F.floor(F.col(POSITION) / F.lit(batch_size)))


def assign_ranks(positioned: DataFrame, n_rows: int, world_size: int) -> DataFrame:
    """One row per (row, rank): every rank gets the same number of rows.

    Rows go round the ranks by position. If ``n_rows`` is not a multiple of
    ``world_size``, rows from the start are repeated. Adds ``rank`` and the place
    ``rank_pos`` within the rank. Narrow.
    """
    if n_rows == 0:
        slots = F.array().cast("array<bigint>")
    else:
        padded = math.ceil(n_rows / world_size) * world_size
        slots = F.sequence(F.col(POSITION), F.lit(padded - 1).cast("bigint"), F.lit(n_rows).cast("bigint"))
    return (
        positioned.withColumn("_slot", F.explode(slots))
        .withColumn("rank", F.pmod("_slot", F.lit(world_size)).cast("int"))
        .withColumn("rank_pos", F.floor(F.col("_slot") / F.lit(world_size)))
        .drop("_slot")
    )


def batch_matrix(batched: DataFrame, ids: str = "input_ids", order: str = POSITION,
                 by: tuple[str, ...] = ()) -> DataFrame:
    """The id arrays of each batch as ``rows``, in order. A group has one batch's rows."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(ids).alias("v"))))
    return (batched.groupBy(*by, "batch_id").agg(pairs.alias("_pairs"))
            .select(*by, "batch_id", F.transform("_pairs", lambda p: p["v"]).alias("rows")))
