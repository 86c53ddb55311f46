"""From source corpora to train and test shards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.config import CorpusConfig
from textloom.operators.arrange import shard_count, shard_of
from textloom.operators.chunk import PART, lengths_before_and_after, split_long_texts
from textloom.operators.combine import combine_corpora
from textloom.operators.positions import POSITION, count_rows, hash_positions
from textloom.operators.profile import length_counts, length_histogram
from textloom.operators.split import split_sizes
from textloom.sources.tables import SHARD, SPLIT, write_shards
from textloom.sources.workspace import checkpointed, is_current, manifest, materialize, record


def prepare_source(source: DataFrame, keys: Sequence[str], path: str, config: CorpusConfig,
                   column: str = "text", inputs: Sequence[str] | None = None) -> DataFrame:
    """Texts of one source in the length range, written to ``path`` or reused from there.

    They are reused if the source's files (``inputs``, or those Spark names), its columns and the length range are the same.
    """
    spark = source.sparkSession
    made_of = manifest(spark, sorted(source.inputFiles()) if inputs is None else inputs, keys=list(keys), column=column,
                       schema=source.schema.simpleString(), range=[config.min_chars, config.max_chars])
    return materialize(spark, path, lambda: split_long_texts(
        source, keys, config.min_chars, config.max_chars, column), made_of)


def profile(df: DataFrame, config: CorpusConfig, column: str = "text") -> DataFrame:
    """Length histogram of a corpus. The texts are read once, for the checkpointed counts."""
    return length_histogram(checkpointed(length_counts(df, column)), config.histogram_bins)


def profile_stages(sources: Mapping[str, DataFrame], config: CorpusConfig,
                   column: str = "text") -> DataFrame:
    """Length histograms of each source before and after chunking, and of all chunks together.

    Stages are named ``<source> raw``, ``<source> chunks`` and ``combined``. Each text
    is read once; the combined counts are summed from those of the sources.
    """
    lengths = [
        lengths_before_and_after(df, config.min_chars, config.max_chars, column)
        .withColumn("stage", F.concat_ws(" ", F.lit(name), "stage")) for name, df in sources.items()]
    counts = checkpointed(reduce(DataFrame.unionAll, lengths)
                          .groupBy("stage", "length").agg(F.count("*").alias("cnt")))
    combined = (counts.filter(F.col("stage").endswith(" chunks"))
                .groupBy(F.lit("combined").alias("stage"), "length").agg(F.sum("cnt").alias("cnt")))
    return length_histogram(counts.unionByName(combined), config.histogram_bins, ["stage"])


def labelled_shards(corpus: DataFrame, keys: Sequence[str], config: CorpusConfig) -> DataFrame:
    """Seeded train / test split in balanced shards: the columns ``split`` and ``shard_id``.

    Rows are split, and sharded within their split, by position in seeded random
    order; they are shuffled once. Give a written table: its keys are read first,
    to be counted.
    """
    n_rows = count_rows(corpus.select(*keys))
    n_train, n_test = split_sizes(n_rows, config.train_ratio, config.test_ratio)
    placed = hash_positions(corpus, keys, config.seed, n_rows=n_rows)

    is_test = F.col(POSITION) < n_test
    test_shards = shard_count(n_test, config.shard_rows)
    train_shards = shard_count(n_train, config.shard_rows)
    shard = (F.when(is_test, shard_of(F.col(POSITION), n_test, test_shards))
             .otherwise(shard_of(F.col(POSITION) - n_test, n_train, train_shards)))
    return (
        placed.filter(F.col(POSITION) < n_test + n_train)
        .withColumn(SPLIT, F.when(is_test, "test").otherwise("train"))
        .withColumn(SHARD, shard).drop(POSITION))


def split_and_shard(corpus: DataFrame, keys: Sequence[str], root: str, config: CorpusConfig) -> None:
    """The split in shards, written below ``root``; see :func:`labelled_shards`."""
    write_shards(labelled_shards(corpus, keys, config), root)


def combine_sources(spark: SparkSession, sources: Mapping[str, DataFrame], keys: Sequence[str],
                    root: str, config: CorpusConfig, upstream: Sequence[str] = ()) -> None:
    """Combine prepared sources, split them and write the shards, unless that is done.

    ``upstream`` are the folders of the prepared sources: the shards are made anew when one of them, or a setting, is another.
    """
    made_of = manifest(spark, upstream=upstream, sources=list(sources), keys=list(keys), seed=config.seed,
                       ratios=[config.train_ratio, config.test_ratio], shard_rows=config.shard_rows)
    if not is_current(spark, root, made_of):
        combined = combine_corpora(sources)
        split_and_shard(combined, ["corpus", *keys, PART], root, config)
        record(spark, root, made_of)
