"""One query per operator, over the given tables.

Id arrays are shown as text (ids joined by a space), which compares alike in any
engine.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.config import (
    EOS_ID, PAD_ID, SPECIAL_TOKENS, CorpusConfig, FeedConfig, VocabularyConfig)
from textloom.functions import sequences as seq
from textloom.functions.formatting import fixed
from textloom.functions.text import characters, with_markers
from textloom.operators import arrange, chunk, combine, encode, permutation, positions, profile, split, trace
from textloom.operators import user_batches, user_tables
from textloom.operators.length_ledger import LengthLedger
from textloom.operators import word_stats as ws
from textloom.operators.model import BpeModel
from textloom.plans import feed, prepare, tokenizer
from textloom.sources import batch_files, shard_sink, tables, workspace
from textloom.streaming import arrivals
from textloom.streaming import batches as stream_batching
from textloom.streaming import best as stream_best

CORPUS = CorpusConfig()
FEED = FeedConfig()
KEYS = ["doc_id", "part_idx"]
LEARNED_MERGES = 120
SHARD_ROWS = 300
WORLD_SIZE = 4
EPOCH = 3
PROMPT_CHARS = 8
ARRIVING_FILES = 3
#: An arriving file of documents has about so many bytes of its source at most.
ARRIVING_BYTES = 64 * 1024 * 1024
#: An arriving file of tokenized rows has about so many rows at most.
ARRIVING_ROWS = 250_000
MIN_TRIGGERS = 2
FILE_BATCHES = 5

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Inputs ------------------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_corpus(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.split_long_texts(documents(spark, sf_dir), ["doc_id"], CORPUS.min_chars, CORPUS.max_chars)


def corpora(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three text tables with a common key."""
    keys = {"documents": F.col("doc_id").cast("string"),
            "conversations": F.concat_ws("-", "conv_id", "turn"),
            "benchmark": F.col("item_id").cast("string")}
    return {name: table(spark, sf_dir, name).select(key.alias("row_id"), "text")
            for name, key in keys.items()}


def losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training trace made from the events: one epoch a day."""
    valid = F.col("event_type").isin("error", "signup")
    return table(spark, sf_dir, "events").select(
        (F.dayofmonth("ts") - 1).alias("epoch"),
        F.when(valid, "valid").otherwise("train").alias("split"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("rank"),
        F.col("event_id").alias("batch_idx"), (F.col("value") / 100).alias("loss"), "ts")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample trace: what the assistant says in a conversation, by its first text."""
    talks = table(spark, sf_dir, "conversations")
    prompts = talks.filter("turn = 0").select("conv_id", F.col("text").alias("prompt"))
    said = talks.filter("role = 'assistant'")
    return said.join(prompts, "conv_id").select(
        F.col("conv_id").alias("prompt_id"), "prompt", F.col("turn").cast("int").alias("epoch"),
        F.col("text").alias("generated"))


def _place(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where this application keeps a result for an input directory, as its files are now."""
    state = workspace.files_state(spark, f"{sf_dir}/documents.parquet")
    return f"{workspace.scratch_root(spark)}/results/{zlib.crc32(f'{sf_dir} {state}'.encode()):08x}/{name}"


def chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_source(documents(spark, sf_dir), ["doc_id"], _place(spark, sf_dir, "chunks"), CORPUS)


def shard_root(spark: SparkSession, sf_dir: str) -> str:
    """Train and test shards of the chunks, written once."""
    root = _place(spark, sf_dir, "shards")
    if not workspace.is_complete(spark, root):
        config = CorpusConfig(shard_rows=SHARD_ROWS)
        prepare.split_and_shard(chunk_table(spark, sf_dir), KEYS, root, config)
    return root


def model(spark: SparkSession, sf_dir: str) -> BpeModel:
    """The tokenizer of the chunks, learned once."""
    path = _place(spark, sf_dir, "tokenizer")
    if workspace.is_complete(spark, f"{path}/vocab"):
        return BpeModel.load(spark, path)
    return learn(spark, sf_dir, path)


def word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word counts of the chunks, written once."""
    return workspace.materialize(spark, _place(spark, sf_dir, "word-counts"),
                                 lambda: ws.word_counts(chunk_table(spark, sf_dir)))


def learn(spark: SparkSession, sf_dir: str, path: str) -> BpeModel:
    counted = word_table(spark, sf_dir)
    n_chars = ws.distinct_characters(counted).count()
    config = VocabularyConfig(vocab_size=len(SPECIAL_TOKENS) + n_chars + LEARNED_MERGES)
    return tokenizer.learn_from_counts(counted, path, config)


def char_model(counted: DataFrame) -> BpeModel:
    """No merges: every character is a token."""
    return BpeModel((*SPECIAL_TOKENS, *ws.collect_alphabet(counted)), ())


def as_text(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), " ")


def code_ids(text: Column) -> Column:
    """Code points as ids, padded to the sequence length."""
    return seq.pad_truncate(F.transform(characters(text), lambda c: F.ascii(c)), CORPUS.max_length)


def coded_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks(spark, sf_dir).select(*KEYS, code_ids(F.col("text")).alias("input_ids"))


# Sources and sinks ---------------------------------------------------------------

@query
def scan_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query
def scan_splits(spark, sf_dir):
    return tables.read_splits(spark, shard_root(spark, sf_dir)).select("split", *KEYS, "text")


@query
def scan_shard(spark, sf_dir):
    path = f"{shard_root(spark, sf_dir)}/split=test/shard_id=0"
    return tables.read_shard(spark, path).select(*KEYS, "text")


@query
def write_splits(spark, sf_dir):
    labelled = split.train_test_split(chunk_table(spark, sf_dir), KEYS, CORPUS.train_ratio,
                                      CORPUS.test_ratio, CORPUS.seed)
    root = _place(spark, sf_dir, "written-splits")
    tables.write_splits(labelled, root, SHARD_ROWS)
    return tables.read_splits(spark, root).select("split", *KEYS, "text")


@query
def named_shards(spark, sf_dir):
    """Shards under the names ``{split}/{split}_shard_{i}.parquet``, read back with what their file names say."""
    root = _place(spark, sf_dir, "named-shards")
    labelled = prepare.labelled_shards(chunk_table(spark, sf_dir), KEYS, CorpusConfig(shard_rows=SHARD_ROWS))
    shard_sink.write_named_shards(labelled, root, order=KEYS)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    return (tables.read_plain_splits(spark, root, ["train", "test"])
            .select("split", name.alias("file"), *KEYS, "text"))


@query
def shard_assign(spark, sf_dir):
    rows = chunk_table(spark, sf_dir)
    n_rows = positions.count_rows(rows.select(*KEYS))
    placed = positions.key_positions(rows.select(*KEYS), KEYS, n_rows)
    return arrange.assign_shards(placed, n_rows, SHARD_ROWS).select(*KEYS, "pos", "shard_id")


@query
def shard_sizes(spark, sf_dir):
    return (tables.read_splits(spark, shard_root(spark, sf_dir))
            .groupBy("split", F.col("shard_id").cast("bigint").alias("shard_id"))
            .agg(F.count("*").alias("n_rows")))


@query
def text_corpus(spark, sf_dir):
    path = _place(spark, sf_dir, "chunk-lines")
    tables.write_text(tables.read_splits(spark, shard_root(spark, sf_dir)), path)
    return tables.read_lines(spark, path)


@query
def text_lines(spark, sf_dir):
    path = _place(spark, sf_dir, "document-lines")
    tables.write_text(documents(spark, sf_dir), path)
    return tables.read_lines(spark, path)


@query
def tokenizer_roundtrip(spark, sf_dir):
    path = _place(spark, sf_dir, "saved-tokenizer")
    model(spark, sf_dir).save(spark, path)
    return BpeModel.load(spark, path).merges_table(spark)


def tokenized_root(spark: SparkSession, sf_dir: str) -> str:
    """The tokenized shards, written once."""
    target = _place(spark, sf_dir, "tokenized")
    if not workspace.is_complete(spark, target):
        tokenizer.tokenize_splits(spark, shard_root(spark, sf_dir), target, model(spark, sf_dir), CORPUS)
    return target


@query
def tokenized_write(spark, sf_dir):
    target = tokenized_root(spark, sf_dir)
    return tables.read_splits(spark, target).select(
        "split", F.col("shard_id").cast("bigint").alias("shard_id"), as_text(F.col("input_ids")).alias("input_ids"))


@query
def materialize_reuse(spark, sf_dir):
    """The second call must not build: its builder would give no rows."""
    path = _place(spark, sf_dir, "reused")
    workspace.materialize(spark, path, lambda: chunks(spark, sf_dir))
    return workspace.materialize(spark, path, lambda: chunks(spark, sf_dir).filter("false"))


@query
def trace_write(spark, sf_dir):
    path = _place(spark, sf_dir, "trace")
    rows = losses(spark, sf_dir).drop("ts")
    rows.write.mode("overwrite").json(path)
    return tables.read_corpus(spark, path, "json", rows.schema)


# Projections, filters, reshaping ---------------------------------------------------

@query
def text_length(spark, sf_dir):
    return chunk.text_length(documents(spark, sf_dir)).select("doc_id", "length")


@query
def drop_short(spark, sf_dir):
    return chunk.drop_short(documents(spark, sf_dir), CORPUS.min_chars).select("doc_id")


@query
def keep_fitting(spark, sf_dir):
    return chunk.keep_fitting(documents(spark, sf_dir), CORPUS.min_chars, CORPUS.max_chars)


@query
def newline_parts(spark, sf_dir):
    return chunk.newline_parts(chunk.over_long(documents(spark, sf_dir), CORPUS.max_chars), ["doc_id"])


@query
def chunk_over_long(spark, sf_dir):
    return chunk.keep_fitting(newline_parts(spark, sf_dir), CORPUS.min_chars, CORPUS.max_chars)


@query
def split_long_texts(spark, sf_dir):
    return chunks(spark, sf_dir)


@query
def chunk_outcomes(spark, sf_dir):
    return chunk.part_outcomes(documents(spark, sf_dir), CORPUS.min_chars, CORPUS.max_chars)


@query
def chunk_conversations(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").withColumnRenamed("text", "utterance")
    return chunk.split_long_texts(said, ["conv_id", "turn"], CORPUS.min_chars, CORPUS.max_chars, "utterance")


# Set operations ----------------------------------------------------------------------

@query
def flatten_splits(spark, sf_dir):
    return combine.flatten_splits(tables.read_splits(spark, shard_root(spark, sf_dir))).select(*KEYS, "text")


@query
def combine_corpora(spark, sf_dir):
    return combine.combine_corpora(corpora(spark, sf_dir)).select("corpus", "row_id", "text")


# Profiles ------------------------------------------------------------------------------

@query
def corpus_count(spark, sf_dir):
    return profile.row_count(chunks(spark, sf_dir))


@query
def length_range(spark, sf_dir):
    return profile.length_range(profile.length_counts(documents(spark, sf_dir)))


@query
def length_bin_edges(spark, sf_dir):
    lengths = profile.length_counts(documents(spark, sf_dir))
    return profile.length_bin_edges(lengths, CORPUS.histogram_bins)


@query
def length_histogram(spark, sf_dir):
    return prepare.profile(chunks(spark, sf_dir), CORPUS)


@query
def length_report(spark, sf_dir):
    return profile.length_report(prepare.profile(documents(spark, sf_dir), CORPUS))


@query
def null_texts(spark, sf_dir):
    return profile.null_texts(documents(spark, sf_dir))


@query
def corpus_summary(spark, sf_dir):
    return profile.corpus_summary(table(spark, sf_dir, "documents"))


@query
def stage_profile(spark, sf_dir):
    return prepare.profile_stages(corpora(spark, sf_dir), CORPUS)


@query
def ledger_profile(spark, sf_dir):
    """As ``stage_profile``, from counts that are kept by file: first of one file, then of those that came since."""
    sources = {name: [f"{sf_dir}/{name}.parquet"] for name in ("documents", "conversations", "benchmark")}
    files = {name: [file for file, _ in workspace.file_states(spark, paths)] for name, paths in sources.items()}
    first = files["documents"][:1]
    ledger = LengthLedger(spark, workspace.scratch_path(spark, "ledger"), CORPUS)
    read = [ledger.update("documents", first)]
    read += [ledger.update(name, paths) for name, paths in sources.items()]
    expected = [len(first), len(files["documents"]) - len(first), len(files["conversations"]), len(files["benchmark"])]
    if read != expected:
        raise RuntimeError(f"files read: {read}, not {expected}")
    return ledger.profile(sources)


# Ordering, splitting -------------------------------------------------------------------

@query
def train_test_split(spark, sf_dir):
    return split.train_test_split(chunk_table(spark, sf_dir).select(*KEYS), KEYS, CORPUS.train_ratio,
                                  CORPUS.test_ratio, CORPUS.seed)


@query
def split_sizes(spark, sf_dir):
    return train_test_split(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n_rows"))


@query
def seeded_shuffle(spark, sf_dir):
    return positions.hash_positions(chunk_table(spark, sf_dir).select(*KEYS), KEYS, CORPUS.seed)


@query
def batch_assign(spark, sf_dir):
    placed = positions.key_positions(chunk_table(spark, sf_dir).select(*KEYS), KEYS)
    return arrange.assign_batches(placed, FEED.batch_size)


@query
def epoch_order(spark, sf_dir):
    return positions.hash_positions(chunk_table(spark, sf_dir).select(*KEYS), KEYS, CORPUS.seed, EPOCH)


@query
def epoch_bijection(spark, sf_dir):
    """An epoch's order, rank shares and batches by arithmetic on stored positions; nothing is shuffled."""
    stored, n_rows = _positions(spark, sf_dir)
    placed = permutation.epoch_positions(stored, n_rows, CORPUS.seed, EPOCH)
    place = F.col(permutation.EPOCH_POSITION)
    return placed.select(*KEYS, "pos", place, F.pmod(place, F.lit(WORLD_SIZE)).cast("int").alias("rank"),
                         F.floor(place / F.lit(WORLD_SIZE) / F.lit(FEED.batch_size)).alias("batch_id"))


def _positions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """The keys of the chunks with their positions, in that order, written once; and their number."""
    path = _place(spark, sf_dir, "positions")
    rows = chunk_table(spark, sf_dir).select(*KEYS)
    stored = workspace.materialize(spark, path, lambda: positions.key_positions(rows, KEYS))
    return stored, positions.count_rows(stored)


@query
def rank_shards(spark, sf_dir):
    rows = chunk_table(spark, sf_dir).select(*KEYS)
    n_rows = positions.count_rows(rows)
    placed = positions.hash_positions(rows, KEYS, CORPUS.seed, EPOCH, n_rows)
    return arrange.assign_ranks(placed, n_rows, WORLD_SIZE)


@query
def rank_sizes(spark, sf_dir):
    return rank_shards(spark, sf_dir).groupBy("rank").agg(F.count("*").alias("n_rows"))


# Vocabulary ------------------------------------------------------------------------------

@query
def pre_tokenize(spark, sf_dir):
    return ws.pre_tokenize(chunks(spark, sf_dir), KEYS)


@query
def word_counts(spark, sf_dir):
    return ws.word_counts(chunks(spark, sf_dir))


@query
def alphabet(spark, sf_dir):
    return char_model(ws.word_counts(chunks(spark, sf_dir))).vocab_table(spark)


def symbol_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, BpeModel]:
    counted = word_table(spark, sf_dir)
    chars = char_model(counted)
    return ws.as_symbols(counted, chars.tokens[len(SPECIAL_TOKENS):]), chars


def _shown_pairs(counts: DataFrame, chars: BpeModel) -> DataFrame:
    vocab = encode.vocab_array(chars)
    left, right = ws.pair_ids(F.col("pair"))
    return counts.select(F.get(vocab, left).alias("left_token"), F.get(vocab, right).alias("right_token"), "n")


@query
def pair_counts(spark, sf_dir):
    states, chars = symbol_states(spark, sf_dir)
    return _shown_pairs(ws.pair_counts(states), chars)


@query
def best_pairs(spark, sf_dir):
    states, chars = symbol_states(spark, sf_dir)
    return _shown_pairs(ws.best_pairs(ws.pair_counts(states), 25), chars)


@query
def first_merge(spark, sf_dir):
    """Every word after the first merge, as its tokens."""
    states, chars = symbol_states(spark, sf_dir)
    best = ws.best_pairs(ws.pair_counts(states), 1).first()
    new_id = chars.vocab_size
    merged = states.withColumn("s", ws.merge_pairs("s", [(best.pair, ws.symbol(new_id))]))
    left, right = (ws.token_id(sym) for sym in best.pair)
    grown = BpeModel((*chars.tokens, chars.tokens[left] + chars.tokens[right]), ((left, right, new_id),))
    shown = F.array_join(encode.id_tokens(ws.symbol_ids(F.col("s")), grown), " ")
    return merged.select("word", "cnt", shown.alias("symbols"))


@query
def bpe_merges(spark, sf_dir):
    return model(spark, sf_dir).merges_table(spark)


@query
def bpe_merges_32k(spark, sf_dir):
    """The merges of the full vocabulary, 32,000 tokens or until no pair is left."""
    config = VocabularyConfig(ranked_pairs=8_192)
    learned = tokenizer.learn_from_counts(word_table(spark, sf_dir), _place(spark, sf_dir, "tokenizer-32k"), config)
    return learned.merges_table(spark)


@query
def bpe_vocab(spark, sf_dir):
    return model(spark, sf_dir).vocab_table(spark)


@query
def vocab_size(spark, sf_dir):
    return model(spark, sf_dir).vocab_table(spark).agg(F.count("*").alias("vocab_size"))


@query
def special_ids(spark, sf_dir):
    return model(spark, sf_dir).vocab_table(spark).filter("special").select("token", "id")


# Tokenizing and decoding ---------------------------------------------------------------------

@query
def wrap_markers(spark, sf_dir):
    return chunks(spark, sf_dir).select(*KEYS, with_markers(F.col("text")).alias("text"))


@query
def special_literals(spark, sf_dir):
    """Texts with markers written into them: at the start, after sentences, at the end."""
    rows = chunk_table(spark, sf_dir)
    chars = char_model(word_table(spark, sf_dir))
    marked = F.concat(F.lit("[SOS]"), F.replace("text", F.lit(". "), F.lit(".[EOS] [UNK]")), F.lit("[[PAD]]"))
    return rows.select(*KEYS, as_text(encode.encode(marked, chars)).alias("ids"))


@query
def encode_corpus(spark, sf_dir):
    return chunks(spark, sf_dir).select(
        *KEYS, as_text(encode.encode(F.col("text"), model(spark, sf_dir))).alias("ids"))


@query
def encode_roundtrip(spark, sf_dir):
    """Decoding gives back the text but for its spacing."""
    known = model(spark, sf_dir)
    ids = encode.encode(F.col("text"), known)
    same = F.array_join(encode.id_tokens(F.col("ids"), known), "") == F.regexp_replace("text", r"(?U)\s+", "")
    return chunks(spark, sf_dir).select("text", ids.alias("ids")).agg(
        F.count("*").alias("n_rows"), F.count_if(~same).alias("mismatches"))


@query
def unknown_chars(spark, sf_dir):
    """The alphabet of the English texts, met by all texts."""
    english = table(spark, sf_dir, "documents").filter("lang = 'en'")
    known = char_model(ws.word_counts(chunk.split_long_texts(
        english, ["doc_id"], CORPUS.min_chars, CORPUS.max_chars)))
    ids = encode.encode(F.col("text"), known)
    return (chunks(spark, sf_dir).select(*KEYS, ids.alias("ids"))
            .select(*KEYS, F.size("ids").alias("n_ids"),
                    F.size(F.filter("ids", lambda i: i == 0)).alias("n_unknown")))


@query
def pad_truncate(spark, sf_dir):
    """Character codes of the whole documents: most are cut, some are padded."""
    return documents(spark, sf_dir).select("doc_id", as_text(code_ids(F.col("text"))).alias("ids"))


@query
def tokenize_corpus(spark, sf_dir):
    rows = encode.tokenize_corpus(chunks(spark, sf_dir), model(spark, sf_dir), CORPUS.max_length, keys=tuple(KEYS))
    return rows.select(*KEYS, as_text(F.col("input_ids")).alias("input_ids"))


@query
def tokenize_chars(spark, sf_dir):
    rows = chunk_table(spark, sf_dir)
    chars = char_model(word_table(spark, sf_dir))
    coded = encode.tokenize_corpus(rows, chars, CORPUS.max_length, keys=tuple(KEYS))
    return coded.select(*KEYS, as_text(F.col("input_ids")).alias("input_ids"))


@query
def encode_prompts(spark, sf_dir):
    """Prompts from other texts than the vocabulary: unseen words, unknown characters."""
    prompts = table(spark, sf_dir, "conversations")
    return prompts.select("conv_id", "turn", as_text(
        encode.prompt_ids(F.col("text"), model(spark, sf_dir))).alias("ids"))


@query
def decode_corpus(spark, sf_dir):
    known = model(spark, sf_dir)
    rows = encode.tokenize_corpus(chunks(spark, sf_dir), known, CORPUS.max_length, keys=tuple(KEYS))
    return rows.select(*KEYS, encode.decode(F.col("input_ids"), known).alias("decoded"))


# Training-data assembly ------------------------------------------------------------------------

@query
def next_token_pairs(spark, sf_dir):
    ids = F.col("input_ids")
    return coded_chunks(spark, sf_dir).select(
        *KEYS, as_text(seq.inputs(ids)).alias("input"), as_text(seq.targets(ids)).alias("target"))


def _token_pairs(rows: DataFrame, *keys: str) -> DataFrame:
    ids = F.col("input_ids")
    return (rows.select(*keys, F.posexplode(F.arrays_zip(seq.inputs(ids).alias("input"),
                                                         seq.targets(ids).alias("target"))).alias("pos", "pair"))
            .select(*keys, "pos", "pair.input", "pair.target"))


@query
def token_pairs_flat(spark, sf_dir):
    return _token_pairs(coded_chunks(spark, sf_dir), *KEYS)


@query
def loss_token_counts(spark, sf_dir):
    """Positions per batch whose target is not padding."""
    counted = seq.valid_length(seq.targets(F.col("input_ids")), PAD_ID)
    narrow = (chunk_table(spark, sf_dir).select(*KEYS, code_ids(F.col("text")).alias("input_ids"))
              .select(*KEYS, counted.alias("counted")))
    placed = arrange.assign_batches(positions.key_positions(narrow, KEYS), FEED.batch_size)
    return placed.groupBy("batch_id").agg(F.sum("counted").alias("loss_tokens"))


@query
def valid_lengths(spark, sf_dir):
    ids = F.col("input_ids")
    return coded_chunks(spark, sf_dir).select(
        *KEYS, seq.valid_length(ids).alias("valid_length"),
        as_text(seq.valid_mask(ids).cast("array<int>")).alias("mask"))


@query
def batch_matrix(spark, sf_dir):
    """The short texts are placed and gathered, and become long id arrays in their batch."""
    texts = chunk_table(spark, sf_dir).select(*KEYS, "text")
    placed = arrange.assign_batches(positions.key_positions(texts, KEYS), FEED.batch_size)
    ids = F.transform("rows", lambda text: as_text(code_ids(text)))
    return arrange.batch_matrix(placed, "text").select("batch_id", F.array_join(ids, "|").alias("rows"))


@query
def rank_batches(spark, sf_dir):
    """The batches of each rank in one epoch, by row label."""
    shares = rank_shards(spark, sf_dir).drop("pos").withColumnRenamed("rank_pos", "pos")
    labelled = arrange.assign_batches(shares, FEED.batch_size).withColumn("label", F.concat_ws(":", *KEYS))
    return arrange.batch_matrix(labelled, "label", by=("rank",)).select(
        "rank", "batch_id", F.array_join("rows", " ").alias("rows"))


def _fed(spark: SparkSession, sf_dir: str, arranged: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    """Both splits of the tokenized shards, arranged, with the name of the split."""
    root = tokenized_root(spark, sf_dir)
    fed = [arranged(*feed.tokenized_split(spark, root, split)).withColumn("split", F.lit(split))
           for split in ("train", "test")]
    return fed[0].unionByName(fed[1]).withColumn("rows", F.array_join(F.transform("rows", as_text), "|"))


@query
def feed_batches(spark, sf_dir):
    """Batches of learned ids in key order, per split."""
    return _fed(spark, sf_dir, lambda rows, keys: feed.batches(rows, keys, FEED.batch_size))


@query
def feed_rank_batches(spark, sf_dir):
    """Batches of learned ids of each rank in one epoch, per split."""
    return _fed(spark, sf_dir, lambda rows, keys: feed.rank_batches(
        rows, keys, CORPUS.seed, EPOCH, WORLD_SIZE, FEED.batch_size))


@query
def rank_files(spark, sf_dir):
    """As ``feed_rank_batches``, through files that a trainer opens at any batch."""
    def written(rows: DataFrame, keys: list[str]) -> DataFrame:
        target = workspace.scratch_path(spark, "rank-files")
        feed.write_rank_files(rows, keys, target, CORPUS.seed, EPOCH, WORLD_SIZE, FEED.batch_size, CORPUS.max_length, FILE_BATCHES)
        return batch_files.read_batch_files(spark, target)

    return _fed(spark, sf_dir, written)


@query
def finish_sequences(spark, sf_dir):
    """The first characters as prompt, the rest as generated; a full stop ends it."""
    # What lies behind the length of a sequence cannot be in it.
    start = F.substring("text", 1, CORPUS.max_length)
    ids = F.transform(characters(start), lambda c: F.when(c == ".", EOS_ID).otherwise(F.ascii(c)))
    split_ids = documents(spark, sf_dir).select("doc_id", ids.alias("ids")).select(
        "doc_id", F.slice("ids", 1, PROMPT_CHARS).alias("prompt"),
        F.slice("ids", F.lit(PROMPT_CHARS + 1), F.size("ids")).alias("generated"))
    done = seq.finish_sequence(F.col("prompt"), F.col("generated"), CORPUS.max_length)
    return split_ids.select("doc_id", as_text(done).alias("ids"))


# Traces -------------------------------------------------------------------------------------------

def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


@query
def epoch_loss(spark, sf_dir):
    return _rounded(trace.epoch_loss(losses(spark, sf_dir)), "loss")


@query
def epoch_perplexity(spark, sf_dir):
    return _rounded(trace.with_perplexity(trace.epoch_loss(losses(spark, sf_dir))), "loss", "perplexity")


@query
def best_epochs(spark, sf_dir):
    return _rounded(trace.best_epochs(trace.epoch_loss(losses(spark, sf_dir))), "loss")


@query
def epoch_duration(spark, sf_dir):
    return trace.epoch_duration(losses(spark, sf_dir))


@query
def loss_history(spark, sf_dir):
    listed = trace.loss_history(_rounded(trace.epoch_loss(losses(spark, sf_dir)), "loss"))
    shown = F.transform("losses", lambda x: fixed(x, 6))
    return listed.select("split", "page", F.array_join(shown, " ").alias("losses"))


@query
def sample_trace(spark, sf_dir):
    listed = trace.sample_trace(samples(spark, sf_dir))
    return listed.select("prompt_id", "prompt", "page", F.array_join("generated", "\n--\n").alias("generated"))


@query
def epoch_report(spark, sf_dir):
    return trace.epoch_report(losses(spark, sf_dir), FEED.epochs)


# Streams --------------------------------------------------------------------------------------------

def _arriving_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files that arrive in ``ARRIVING_FILES`` triggers; the files of a trigger grow in number, not in size."""
    size = sum(int(state.split(":")[0]) for _, state in workspace.file_states(spark, [f"{sf_dir}/documents.parquet"]))
    a_trigger = max(1, math.ceil(size / (ARRIVING_FILES * ARRIVING_BYTES)))
    root = _place(spark, sf_dir, "arriving-documents")
    if not workspace.is_complete(spark, root):
        documents(spark, sf_dir).repartition(ARRIVING_FILES * a_trigger).write.mode("overwrite").parquet(root)
    return arrivals.arriving_shards(spark, root, "doc_id bigint, text string", files_per_trigger=a_trigger)


def _arriving_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written shards, in a few triggers."""
    root = shard_root(spark, sf_dir)
    written = spark.read.parquet(root)
    a_trigger = max(1, len(written.inputFiles()) // ARRIVING_FILES)
    return arrivals.arriving_shards(spark, root, written.schema, files_per_trigger=a_trigger)


@query
def stream_chunk(spark, sf_dir):
    arrived = chunk.split_long_texts(_arriving_texts(spark, sf_dir), ["doc_id"], CORPUS.min_chars, CORPUS.max_chars)
    path = workspace.scratch_path(spark, "stream-chunk")
    arrivals.run_to_end(arrivals.append_to(arrived, f"{path}/rows", f"{path}/checkpoint"), MIN_TRIGGERS)
    return spark.read.parquet(f"{path}/rows")


@query
def stream_tokenize(spark, sf_dir):
    arrived = _arriving_shards(spark, sf_dir)
    tokenized = encode.tokenize_corpus(arrived, model(spark, sf_dir), CORPUS.max_length, keys=tuple(KEYS))
    path = workspace.scratch_path(spark, "stream-tokenize")
    arrivals.run_to_end(arrivals.append_to(tokenized, f"{path}/rows", f"{path}/checkpoint"), MIN_TRIGGERS)
    return spark.read.parquet(f"{path}/rows").select(*KEYS, as_text(F.col("input_ids")).alias("input_ids"))


@query
def stream_word_counts(spark, sf_dir):
    arrived = chunk.split_long_texts(_arriving_texts(spark, sf_dir), ["doc_id"], CORPUS.min_chars, CORPUS.max_chars)
    path = workspace.scratch_path(spark, "stream-words")
    arrivals.run_to_end(arrivals.count_words_to(arrived, f"{path}/counts", f"{path}/checkpoint",
                                                triggers_per_base=2), MIN_TRIGGERS)
    return arrivals.latest_counts(spark, f"{path}/counts")


def _arriving_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokenized rows of both splits as files of bounded size that arrive one after the other, in key order."""
    root, path = workspace.scratch_path(spark, "arriving-tokens"), workspace.scratch_path(spark, "pieces")
    rows = tables.read_splits(spark, tokenized_root(spark, sf_dir)).select("split", *KEYS, "input_ids")
    n_files = max(ARRIVING_FILES, math.ceil(positions.count_rows(rows) / ARRIVING_ROWS))
    ranged = rows.repartitionByRange(n_files, *KEYS).withColumn("piece", F.spark_partition_id())
    ranged.write.partitionBy("piece").parquet(path)
    pieces = spark.read.schema(ranged.schema).parquet(path)
    for k in range(n_files):        # a stream takes files by their time, so each is written after the one before
        pieces.where(F.col("piece") == k).drop("piece").coalesce(1).write.mode("append").parquet(root)
    return arrivals.arriving_shards(spark, root, rows.schema, files_per_trigger=1)


@query
def stream_batches(spark, sf_dir):
    """Full batches over arriving files, and the last, short ones from the state; as in ``feed_batches``."""
    path = workspace.scratch_path(spark, "stream-batches")
    checkpoint = f"{path}/checkpoint"
    arrivals.run_to_end(stream_batching.batches_to(
        _arriving_tokens(spark, sf_dir), f"{path}/rows", checkpoint, ["split"], KEYS, FEED.batch_size), MIN_TRIGGERS)
    rows = spark.read.parquet(f"{path}/rows").unionByName(stream_batching.waiting_rows(spark, checkpoint, ["split"]))
    filled = arrange.batch_matrix(rows, order=stream_batching.PLACE, by=("split",))
    return filled.withColumn("rows", F.array_join(F.transform("rows", as_text), "|"))


@query
def stream_best_epochs(spark, sf_dir):
    """As ``best_epochs``, while the rows of all epochs arrive in any order."""
    root, path = workspace.scratch_path(spark, "arriving-trace"), workspace.scratch_path(spark, "stream-best")
    trace_rows = losses(spark, sf_dir).select("epoch", "split", "loss", "batch_idx")
    counted = trace_rows.groupBy("epoch", "split").agg(F.count("*").alias("epoch_rows"))
    rows = workspace.written(trace_rows.join(counted, ["epoch", "split"]), "trace")
    for k in range(ARRIVING_FILES):
        rows.where(F.pmod(F.xxhash64("batch_idx"), F.lit(ARRIVING_FILES)) == k).coalesce(1).write.mode("append").parquet(root)
    stream = arrivals.arriving_shards(spark, root, rows.schema, files_per_trigger=1).withColumn("run", F.lit("run"))
    arrivals.run_to_end(stream_best.best_epochs_to(stream, f"{path}/rows", f"{path}/checkpoint", ["run"]), MIN_TRIGGERS)
    return _rounded(spark.read.parquet(f"{path}/rows").select("epoch", "loss"), "loss")


# User functions --------------------------------------------------------------------------------------

def _lengths(batch: dict, column: str) -> dict:
    return {"length": [len(text) for text in batch[column]]}


def _fitting_lines(batch: dict, low: int, high: int) -> dict:
    found = {"doc_id": [], "text": []}
    for doc_id, text in zip(batch["doc_id"], batch["text"]):
        if len(text) >= low:
            for part in [text] if len(text) <= high else text.split("\n"):
                if low <= len(part) <= high:
                    found["doc_id"].append(doc_id)
                    found["text"].append(part)
    return found


@query
def map_batches(spark, sf_dir):
    return user_batches.map_batches(
        documents(spark, sf_dir), _lengths, "length int", CORPUS.batch_rows,
        {"column": "text"}, remove_columns=["text"])


@query
def flat_map_batches(spark, sf_dir):
    return user_batches.map_batches(
        documents(spark, sf_dir), _fitting_lines, "doc_id bigint, text string", CORPUS.batch_rows,
        {"low": CORPUS.min_chars, "high": CORPUS.max_chars}, remove_columns=["doc_id", "text"])


def _lines_between(text: str, low: int, high: int) -> list[str]:
    if len(text) < low:
        return []
    return [text] if len(text) <= high else text.split("\n")


@query
def table_function(spark, sf_dir):
    """The chunker as a table function in SQL: variable numbers of rows, bound arguments, a column named by the call."""
    user_tables.flat_map(spark, "candidate_parts", _lines_between)
    documents(spark, sf_dir).createOrReplaceTempView("texts_to_cut")
    return spark.sql(f"""
        SELECT doc_id, p.place AS part_idx, p.part AS text
        FROM texts_to_cut, LATERAL candidate_parts(text, named_struct('low', {CORPUS.min_chars}, 'high', {CORPUS.max_chars}), 'part string') p
        WHERE length(p.part) BETWEEN {CORPUS.min_chars} AND {CORPUS.max_chars}""")


@query
def table_function_groups(spark, sf_dir):
    """Batches within each language, by a table function over groups."""
    user_tables.batches(spark, "batches_of")
    table(spark, sf_dir, "documents").select("doc_id", "lang").createOrReplaceTempView("texts_by_language")
    return spark.sql(f"""
        SELECT doc_id, lang, batch_id, place
        FROM batches_of(TABLE(texts_by_language) PARTITION BY lang ORDER BY (doc_id), {FEED.batch_size})""")
