"""Exact seeded train / test split."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.hashing import seeded_hash
from textloom.operators.positions import count_rows
from textloom.sources.tables import SPLIT

_DIGITS_PER_PASS = 4
_HASH_DIGITS = 32
_RANKED_ROWS = 100_000


def split_sizes(n_rows: int, train_ratio: float, test_ratio: float) -> tuple[int, int]:
    """Rows of ``train`` (rounded down) and ``test`` (rounded up)."""
    n_train, n_test = math.floor(train_ratio * n_rows), math.ceil(test_ratio * n_rows)
    if n_train + n_test > n_rows:
        raise ValueError(f"{n_train} train and {n_test} test rows from {n_rows}")
    if n_rows and n_train == 0:
        raise ValueError("the train split would be empty")
    return n_train, n_test


def _row_at(hashed: DataFrame, keys: Sequence[str], rank: int):
    """Hash and keys of the row with 1-based ``rank`` in hash order.

    Each pass counts the rows of the current hash prefix by the next four digits
    (at most 65,536 counts come back) and goes down into the one that holds the
    rank, until it is small enough to be sorted.
    """
    prefix = ""
    while len(prefix) < _HASH_DIGITS:
        inside = hashed.filter(F.col("_hash").startswith(prefix))
        counts = (inside.groupBy(F.substring("_hash", 1, len(prefix) + _DIGITS_PER_PASS).alias("p"))
                  .agg(F.count("*").alias("n")).collect())
        for p, n in sorted(tuple(row) for row in counts):
            if rank <= n:
                prefix = p
                break
            rank -= n
        if n <= _RANKED_ROWS:
            break
    ranked = hashed.filter(F.col("_hash").startswith(prefix)).orderBy("_hash", *keys).limit(rank)
    return ranked.orderBy(F.col("_hash").desc(), *[F.col(k).desc() for k in keys]).first()


def _up_to(row, keys: Sequence[str]) -> Column:
    """True for rows at or before ``row`` in hash order."""
    if row is None:
        return F.lit(False)
    names = ["_hash", *keys]
    here = F.struct(*[F.col(name) for name in names])
    there = F.struct(*[F.lit(row[name]).alias(name) for name in names])
    return here <= there


def _row_hash(df: DataFrame) -> Column:
    """A hash over all columns of a row, nulls included."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns]), {"ignoreNullFields": "false"}).cast("binary"))


def _first_rows(df: DataFrame, keys: Sequence[str], seed: int, rank: int) -> Column:
    """True for the first ``rank`` rows in seeded order; expects the columns ``_hash`` and ``_row`` of the labelled table.

    Rows of equal keys on both sides of the cut are told apart by a hash of all their columns. Rows equal in
    all columns cannot be, and are an error if the cut goes through them.
    """
    hashed = df.select(*keys, seeded_hash(keys, seed).alias("_hash"))
    cut = _row_at(hashed, keys, rank) if rank else None
    inside = _up_to(cut, keys)
    if cut is None:
        return inside
    beyond = hashed.filter(inside).count() - rank
    if not beyond:
        return inside
    tied = reduce(and_, [F.col(k).eqNullSafe(F.lit(cut[k])) for k in keys])
    rows = df.filter(tied).select(_row_hash(df).alias("_hash"))
    n_inside = rows.count() - beyond
    last = _row_at(rows, [], n_inside)["_hash"]
    if rows.filter(F.col("_hash") <= last).count() != n_inside:
        raise ValueError("rows that are equal in all columns stand on both sides of the cut between splits")
    return (inside & ~tied) | (tied & (F.col("_row") <= last))


def train_test_split(df: DataFrame, keys: Sequence[str], train_ratio: float, test_ratio: float,
                     seed: int) -> DataFrame:
    """Add ``split``: the first rows in seeded random order are ``test``, the next ``train``.

    Sizes are exact, also where ``keys`` repeat: then all columns of a row decide on which side of the cut it stands
    (an error if rows on both sides are equal in all of them). Only the keys are read to find the
    row at which to cut; the rows themselves are not shuffled.
    """
    n_rows = count_rows(df.select(*keys))
    n_train, n_test = split_sizes(n_rows, train_ratio, test_ratio)
    labelled = F.when(_first_rows(df, keys, seed, n_test), "test")
    if n_train + n_test < n_rows:
        labelled = labelled.when(_first_rows(df, keys, seed, n_train + n_test), "train")
    else:
        labelled = labelled.otherwise("train")
    out = (df.withColumns({"_hash": seeded_hash(keys, seed), "_row": _row_hash(df)})
           .withColumn(SPLIT, labelled).drop("_hash", "_row"))
    return out.filter(F.col(SPLIT).isNotNull()) if n_train + n_test < n_rows else out
