"""One query per operator of this folder, with production parameters over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (
    best_two_fit, blob_ledger, edit_counts, golay_simhash, hash_mixing, line_rules, piece_codec, pivot_index,
    quality_trees, spelling_tiles, token_alignment, token_files, url_rules)
from textloom.sources import tables, workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """Path of a public tokenizer's file; ``folder`` instead of where the package lies."""
    if folder is None:
        import public_tokenizers

        return public_tokenizers.path(name)
    return os.path.join(folder, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_corpus(spark, f"{sf_dir}/{name}.parquet")


@query
def op1_pivot_neighbors(spark, sf_dir):
    return pivot_index.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query
def op2_quality_trees(spark, sf_dir):
    return quality_trees.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_golay_simhash(spark, sf_dir):
    found = golay_simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_blob_ledger(spark, sf_dir):
    ledger = blob_ledger.Ledger(spark, workspace.scratch_path(spark, "ledger"))
    return blob_ledger.scan_documents(table(spark, sf_dir, "documents"), ledger)


@query
def op5_token_files(spark, sf_dir):
    path = workspace.scratch_path(spark, "token-files")
    token_files.write_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), path)
    return token_files.read_files(spark, path)


@query
def op6_edit_counts(spark, sf_dir):
    return edit_counts.count_after_edits(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op7_url_rules(spark, sf_dir):
    return url_rules.judge_urls(table(spark, sf_dir, "pages"))


@query
def op8_piece_codec(spark, sf_dir):
    return piece_codec.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op9_hash_mixing(spark, sf_dir):
    return hash_mixing.mixed_sizes(table(spark, sf_dir, "documents"))


@query
def op10_line_rules(spark, sf_dir):
    return line_rules.judge(table(spark, sf_dir, "documents")).drop("n_kept_words")


@query
def op11_best_two_fit(spark, sf_dir):
    return best_two_fit.places(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op12_token_alignment(spark, sf_dir):
    return token_alignment.align_documents(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


@query
def op13_spelling_tiles(spark, sf_dir):
    return spelling_tiles.spelling_groups(table(spark, sf_dir, "documents"))
