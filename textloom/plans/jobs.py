"""The jobs from the command line, one after the other:

    spark-submit -m textloom.plans.jobs prepare --source NAME=PATH [--source ...] --work DIR
    spark-submit -m textloom.plans.jobs tokenize --work DIR
    spark-submit -m textloom.plans.jobs feed --work DIR --epoch N --world-size W
    spark-submit -m textloom.plans.jobs export --work DIR --target DIR

``prepare`` brings each source to the length range, prints length profiles, combines
the sources and writes train and test shards. ``tokenize`` learns the vocabulary from
the shards and writes the tokenized shards. ``feed`` writes the batches of each split and
rank for one epoch. ``export`` writes the shards as ``{split}/{split}_shard_{i}.parquet``. Parts are reused as long as their inputs and
settings are the same; a change makes anew what depends on it.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from textloom import session
from textloom.config import CorpusConfig, FeedConfig, VocabularyConfig
from textloom.operators.profile import corpus_summary, length_report, null_texts
from textloom.plans import feed, prepare, tokenizer
from textloom.sources.shard_sink import write_named_shards
from textloom.sources.tables import SHARD, SPLIT, Source, keyed_texts, read_splits


def prepare_job(spark: SparkSession, sources: list[Source], work: str, config: CorpusConfig) -> None:
    texts = {source.name: keyed_texts(spark, source, f"{work}/copied/{source.name}") for source in sources}
    prepared = {source.name: prepare.prepare_source(texts[source.name], ["row_id"], f"{work}/prepared/{source.name}", config,
                                                    inputs=[source.path]) for source in sources}
    histogram = prepare.profile_stages(texts, config)
    reports = length_report(histogram, by=("stage",)).orderBy("stage", "bin_idx")
    for row in reports.collect():
        print(f"{row.stage}: {row.line}")
    for name, df in texts.items():
        counted, summary = null_texts(df).first(), corpus_summary(prepared[name]).first()
        print(f"{name}: {counted.n_rows} rows, {counted.null_texts} without text; "
              f"prepared: {summary.features}, {summary.num_rows} rows")
    prepare.combine_sources(spark, prepared, ["row_id"], f"{work}/splits", config,
                            upstream=[f"{work}/prepared/{name}" for name in prepared])


def tokenize_job(spark: SparkSession, work: str, corpus: CorpusConfig, vocabulary: VocabularyConfig) -> None:
    model = tokenizer.learn_from_splits(spark, f"{work}/splits", f"{work}/tokenizer", vocabulary)
    tokenizer.tokenize_splits(spark, f"{work}/splits", f"{work}/tokenized", model, corpus, f"{work}/tokenizer")


def feed_job(spark: SparkSession, work: str, epoch: int, world_size: int, corpus: CorpusConfig,
             config: FeedConfig) -> None:
    feed.write_epoch(spark, f"{work}/tokenized", f"{work}/feed", epoch, world_size, corpus, config)


def export_job(spark: SparkSession, work: str, target: str) -> None:
    shards = read_splits(spark, f"{work}/splits")
    write_named_shards(shards, target, order=[name for name in shards.columns if name not in (SPLIT, SHARD, "text")])


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    first = jobs.add_parser("prepare")
    first.add_argument("--source", action="append", required=True, type=Source.parse,
                       metavar="NAME=PATH[?key=A,B&column=C&format=F]")
    first.add_argument("--shard-rows", type=int, default=CorpusConfig.shard_rows)
    second = jobs.add_parser("tokenize")
    second.add_argument("--vocab-size", type=int, default=VocabularyConfig.vocab_size)
    second.add_argument("--min-frequency", type=int, default=VocabularyConfig.min_frequency)
    third = jobs.add_parser("feed")
    third.add_argument("--epoch", type=int, default=0)
    third.add_argument("--world-size", type=int, default=1)
    third.add_argument("--batch-size", type=int, default=FeedConfig.batch_size)
    fourth = jobs.add_parser("export")
    fourth.add_argument("--target", required=True, metavar="DIR")
    for job in (first, second, third, fourth):
        job.add_argument("--work", required=True, metavar="DIR")
    given = parser.parse_args(arguments)

    spark = session.builder().getOrCreate()
    if given.job == "prepare":
        prepare_job(spark, given.source, given.work, replace(CorpusConfig(), shard_rows=given.shard_rows))
    elif given.job == "tokenize":
        vocabulary = replace(VocabularyConfig(), vocab_size=given.vocab_size, min_frequency=given.min_frequency)
        tokenize_job(spark, given.work, CorpusConfig(), vocabulary)
    elif given.job == "export":
        export_job(spark, given.work, given.target)
    else:
        feed_job(spark, given.work, given.epoch, given.world_size, CorpusConfig(),
                 replace(FeedConfig(), batch_size=given.batch_size))


if __name__ == "__main__":
    main()
