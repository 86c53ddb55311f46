"""Feeding training from the tokenized shards: batches, rank shares and epoch orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.config import CorpusConfig, FeedConfig
from textloom.operators.arrange import assign_batches, assign_ranks, batch_matrix
from textloom.operators.positions import POSITION, count_rows, hash_positions, key_positions
from textloom.sources.batch_files import FILE_BATCHES, write_batch_files
from textloom.sources.tables import SHARD, SPLIT, read_splits
from textloom.sources.workspace import is_current, manifest, record

INPUT_IDS = "input_ids"


def tokenized_split(spark: SparkSession, root: str, split: str) -> tuple[DataFrame, list[str]]:
    """The rows of one tokenized split, and the columns that identify a row."""
    rows = read_splits(spark, root, [split]).drop(SPLIT, SHARD)
    return rows, [name for name in rows.columns if name != INPUT_IDS]


def batches(rows: DataFrame, keys: Sequence[str], batch_size: int) -> DataFrame:
    """``(batch_id, rows)`` in key order: what a reader without shuffle gets."""
    placed = key_positions(rows.select(*keys, INPUT_IDS), keys)
    return batch_matrix(assign_batches(placed, batch_size))


def rank_batches(rows: DataFrame, keys: Sequence[str], seed: int, epoch: int, world_size: int,
                 batch_size: int) -> DataFrame:
    """``(rank, batch_id, rows)`` of an epoch: seeded order, equal shares, batches within each share."""
    n_rows = count_rows(rows.select(*keys))
    placed = hash_positions(rows.select(*keys, INPUT_IDS), keys, seed, epoch, n_rows)
    shares = assign_ranks(placed, n_rows, world_size).drop(POSITION).withColumnRenamed("rank_pos", POSITION)
    return batch_matrix(assign_batches(shares, batch_size), by=("rank",))


def write_rank_files(rows: DataFrame, keys: Sequence[str], target: str, seed: int, epoch: int, world_size: int, batch_size: int,
                     max_length: int, file_batches: int = FILE_BATCHES) -> int:
    """The batches of :func:`rank_batches` as files that a trainer opens at any batch; returns the number of files."""
    n_rows = count_rows(rows.select(*keys))
    placed = hash_positions(rows.select(*keys, INPUT_IDS), keys, seed, epoch, n_rows)
    shares = assign_ranks(placed, n_rows, world_size).drop(POSITION).withColumnRenamed("rank_pos", POSITION)
    return write_batch_files(shares, target, batch_size, file_batches, INPUT_IDS, POSITION, max_length)


def write_epoch(spark: SparkSession, root: str, target: str, epoch: int, world_size: int, corpus: CorpusConfig,
                feed: FeedConfig, splits: Sequence[str] = ("train", "test")) -> None:
    """Write the batches of every split and rank for one epoch, one directory for each.

    A split whose batches were made of the same rows and settings is left as it is.
    """
    for split in splits:
        place = f"{target}/epoch={epoch}/split={split}"
        made_of = manifest(spark, upstream=[root], seed=corpus.seed, epoch=epoch, world_size=world_size, batch_size=feed.batch_size)
        if is_current(spark, place, made_of):
            continue
        rows, keys = tokenized_split(spark, root, split)
        fed = rank_batches(rows, keys, corpus.seed, epoch, world_size, feed.batch_size)
        fed.write.mode("overwrite").partitionBy("rank").parquet(place)
        record(spark, place, made_of)


def read_rank(spark: SparkSession, target: str, epoch: int, split: str, rank: int) -> DataFrame:
    """The batches of one rank, in order."""
    fed = spark.read.parquet(f"{target}/epoch={epoch}/split={split}")
    return fed.where(F.col("rank") == rank).drop("rank").orderBy("batch_id")
