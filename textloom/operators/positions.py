"""Exact global row positions without a global window.

Rows are cut into ordered pieces, one task each. The pieces are counted, and a row's
position is the number of rows in earlier pieces plus its place in its own. Only the
piece sizes, at most 100,000 numbers, ever meet in one task or are broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.hashing import seeded_hash
from textloom.sources.workspace import written

POSITION = "pos"
_ROWS_PER_PIECE = 1_000_000
_SMALL_PIECE = 10_000
_MAX_PIECES = 100_000
_HASH_DIGITS = 8


def count_rows(df: DataFrame) -> int:
    return df.count()


def piece_count(n_rows: int, cores: int) -> int:
    """Enough pieces to keep the cores busy and the pieces small, within the bound."""
    wanted = max(min(cores, math.ceil(n_rows / _SMALL_PIECE)), math.ceil(n_rows / _ROWS_PER_PIECE), 1)
    return min(wanted, _MAX_PIECES)


def _rows_before(pieces: DataFrame) -> DataFrame:
    """Rows in earlier pieces, from one row per row of the table: its piece number."""
    sizes = pieces.groupBy("piece").agg(F.count("*").alias("size"))
    earlier = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("piece", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))


def _hash_piece(hashed: Column, pieces: int) -> Column:
    """The piece of a hash value: equal ranges of its leading digits."""
    leading = F.conv(F.substring(hashed, 1, _HASH_DIGITS), 16, 10).cast("bigint")
    return F.floor(leading * pieces / F.lit(float(16 ** _HASH_DIGITS))).cast("int")


def hash_positions(df: DataFrame, keys: Sequence[str], seed: int, epoch: int | None = None,
                   n_rows: int | None = None, name: str = POSITION) -> DataFrame:
    """Add each row's position in seeded random order; ``keys`` must be unique.

    The order is md5 of ``seed:[epoch:]keys``, then the keys. The piece of a row is
    a range of its hash: a pure function of the keys, so it holds after a lost
    executor, and even, as the keys are unique. The keys are read once to count,
    and the rows are shuffled once, straight to the task of their piece. Tasks come
    out in position order.
    """
    salts = (seed,) if epoch is None else (seed, epoch)
    if n_rows is None:
        n_rows = count_rows(df.select(*keys))
    pieces = piece_count(n_rows, df.sparkSession.sparkContext.defaultParallelism)
    hashed = df.withColumn("_hash", seeded_hash(keys, *salts)).withColumn(
        "piece", _hash_piece(F.col("_hash"), pieces))
    place = F.row_number().over(Window.partitionBy("piece").orderBy("_hash", *keys))
    return (
        hashed.repartitionById(pieces, "piece").withColumn("_place", place)
        .join(F.broadcast(_rows_before(hashed.select("piece"))), "piece")
        .withColumn(name, F.col("before") + F.col("_place") - 1)
        .drop("piece", "_hash", "_place", "before")
    )


def key_positions(df: DataFrame, keys: Sequence[str], n_rows: int | None = None,
                  name: str = POSITION) -> DataFrame:
    """Add each row's position in key order; ``keys`` must be unique.

    One range shuffle and a local sort. Range bounds come from a sample of the whole
    composite key, so one frequent leading value is spread over many pieces. The sorted
    rows are written with their piece and place, which fixes both: a task run again
    reads the same numbers. Counting the pieces reads these numbers only.
    """
    if n_rows is None:
        n_rows = count_rows(df.select(*keys))
    pieces = piece_count(n_rows, df.sparkSession.sparkContext.defaultParallelism)
    ordered = df.repartitionByRange(pieces, *keys).sortWithinPartitions(*keys)
    numbered = written(ordered.withColumn("_row", F.monotonically_increasing_id()), "key-order")
    numbered = numbered.withColumn("piece", F.shiftright("_row", 33))
    place = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return (numbered.join(F.broadcast(_rows_before(numbered.select("piece"))), "piece")
            .withColumn(name, F.col("before") + place).drop("piece", "before", "_row"))
