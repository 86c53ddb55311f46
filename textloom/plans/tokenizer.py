"""Learning a vocabulary from a corpus, and tokenizing the corpus with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from textloom.config import CorpusConfig, VocabularyConfig
from textloom.operators.encode import tokenize_corpus
from textloom.operators.learn import learn_bpe
from textloom.operators.model import BpeModel
from textloom.operators.word_stats import word_counts
from textloom.sources.tables import SHARD, SPLIT, read_splits
from textloom.sources.workspace import is_current, manifest, materialize, record, remove, scratch_path, withdraw

MODEL_MARKER = "vocab/_SUCCESS"


def _settings(config: VocabularyConfig) -> dict:
    """The settings that decide what is learned; the others only decide how."""
    return {"vocab_size": config.vocab_size, "min_frequency": config.min_frequency}


def learn_from_counts(counted: DataFrame, path: str, config: VocabularyConfig, wanted: dict | None = None) -> BpeModel:
    """The tokenizer at ``path``; learned from a table of word counts first if it is not there.

    It is learned anew if it was made of something else than ``wanted``: by default, of the files of ``counted`` as they
    are and of the settings.
    """
    spark = counted.sparkSession
    made_of = wanted or manifest(spark, sorted(counted.inputFiles()), **_settings(config))
    if not is_current(spark, path, made_of, MODEL_MARKER):
        withdraw(spark, path)
        learn_bpe(counted, config).save(spark, path)
        record(spark, path, made_of)
    return BpeModel.load(spark, path)


def learn_tokenizer(corpus: DataFrame, path: str, config: VocabularyConfig,
                    column: str = "text", upstream: Sequence[str] | None = None) -> BpeModel:
    """The tokenizer at ``path``; learned from all texts of ``corpus`` first if it is not there, or was made of something else.

    The texts are read once, for the word counts. ``upstream`` are the folders that the corpus is read from; by
    default its files as Spark names them.
    """
    spark = corpus.sparkSession
    made_of = manifest(spark, sorted(corpus.inputFiles()) if upstream is None else (), upstream or (), column=column,
                       **_settings(config))
    if is_current(spark, path, made_of, MODEL_MARKER):
        return BpeModel.load(spark, path)
    counts_path = scratch_path(spark, "word-counts")
    counted = materialize(spark, counts_path, lambda: word_counts(corpus, column))
    model = learn_from_counts(counted, path, config, made_of)
    remove(spark, counts_path)
    return model


def learn_from_splits(spark: SparkSession, root: str, path: str, config: VocabularyConfig,
                      splits: list[str] | None = None) -> BpeModel:
    """As above, from split directories; all splits unless some are named."""
    return learn_tokenizer(read_splits(spark, root, splits), path, config, upstream=[root])


def tokenize_splits(spark: SparkSession, root: str, target: str, model: BpeModel,
                    config: CorpusConfig, tokenizer_path: str | None = None) -> None:
    """Tokenize all shards in one job; the target has the same splits, shards and row keys.

    Encoding is narrow and shards are partition directories, so nothing is shuffled. The
    keys are what :mod:`textloom.plans.feed` orders the rows by. With ``tokenizer_path``, nothing is done if the
    target was made of these shards, that tokenizer and this length.
    """
    made_of = None
    if tokenizer_path is not None:
        made_of = manifest(spark, upstream=[root, tokenizer_path], max_length=config.max_length)
        if is_current(spark, target, made_of):
            return
    texts = read_splits(spark, root)
    keys = tuple(name for name in texts.columns if name != "text")
    directories = [name for name in (SPLIT, SHARD) if name in keys]
    (tokenize_corpus(texts, model, config.max_length, keys=keys)
     .write.mode("overwrite").partitionBy(*directories).parquet(target))
    record(spark, target, made_of)
