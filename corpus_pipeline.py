"""A training-data pipeline of five stages, each calling one operator of ``textloom.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that is written and read
again as the next one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import blob_ledger, golay_simhash, hash_mixing, piece_codec, quality_trees
from textloom.llm.queries import table, tokenizer_file
from textloom.llm.tables import stored
from textloom.sources import workspace


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_trees.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays."""
    return golay_simhash.keep_one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; all documents stay."""
    return blob_ledger.redact(docs, blob_ledger.Ledger(spark, workspace.scratch_path(spark, "ledger")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return hash_mixing.take_mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix, checked by decoding them."""
    return piece_codec.round_trip(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_of_each),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: No SQL: the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0])
    return docs
