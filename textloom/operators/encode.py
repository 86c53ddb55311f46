"""Encoding texts to ids, and decoding them.

Words are cut by Spark. A narrow Arrow step then encodes the distinct words of each
batch, with the merges shipped to the task: no shuffle, no join, so a frequent word
or source cannot overload a task, and rows without words survive.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.config import PAD_ID, SPECIAL_TOKENS, UNK_ID
from textloom.functions.sequences import pad_truncate
from textloom.functions.text import marked_words, with_markers
from textloom.operators.model import BpeModel

_CACHED_WORDS = 200_000
_CACHED_WORD_CHARS = 64


class WordEncoder:
    """Encodes one word: always the merge of lowest rank, the leftmost first."""

    def __init__(self, tokens: tuple[str, ...], merges: tuple[tuple[int, int, int], ...]) -> None:
        self.specials = {token: i for i, token in enumerate(SPECIAL_TOKENS)}
        self.char_ids = {t: i for i, t in enumerate(tokens) if len(t) == 1}
        self.ranks = {(left, right): (rank, new) for rank, (left, right, new) in enumerate(merges)}
        self.cache: dict[str, list[int]] = {}

    def __call__(self, word: str) -> list[int]:
        if word in self.specials:
            return [self.specials[word]]
        known = self.cache.get(word)
        if known is None:
            known = self._merge([self.char_ids.get(c, UNK_ID) for c in word])
            if len(word) <= _CACHED_WORD_CHARS:
                if len(self.cache) >= _CACHED_WORDS:
                    self.cache.clear()
                self.cache[word] = known
        return known

    def _merge(self, ids: list[int]) -> list[int]:
        ranks = self.ranks
        end = len(ids)
        after = list(range(1, end + 1))
        before = list(range(-1, end - 1))
        waiting = []
        for i in range(end - 1):
            entry = ranks.get((ids[i], ids[i + 1]))
            if entry:
                waiting.append((entry[0], i, entry[1]))
        heapq.heapify(waiting)
        while waiting:
            rank, i, new = heapq.heappop(waiting)
            j = after[i] if ids[i] is not None else end
            if j >= end or ranks.get((ids[i], ids[j]), (None,))[0] != rank:
                continue        # one of the two has been merged meanwhile
            ids[i], ids[j] = new, None
            k = after[i] = after[j]
            if k < end:
                before[k] = i
                entry = ranks.get((new, ids[k]))
                if entry:
                    heapq.heappush(waiting, (entry[0], i, entry[1]))
            h = before[i]
            if h >= 0:
                entry = ranks.get((ids[h], new))
                if entry:
                    heapq.heappush(waiting, (entry[0], h, entry[1]))
        return [i for i in ids if i is not None]


def _encode_batch(encoder: WordEncoder, words: pa.ListArray) -> pa.ListArray:
    """Ids of each row: encode the distinct words, then gather."""
    distinct = words.flatten().dictionary_encode()
    per_word = pa.array([encoder(w) for w in distinct.dictionary.to_pylist()], pa.list_(pa.int32()))
    in_order = per_word.take(distinct.indices)
    first = words.offsets[0].as_py() if len(words) else 0
    word_ends = pa.compute.subtract(words.offsets, first)
    return pa.ListArray.from_arrays(in_order.offsets.take(word_ends), in_order.values)


def encode_words(words: Column, model: BpeModel) -> Column:
    """Ids of an array of words, as one array."""
    tokens, merges = model.tokens, model.merges

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import pyarrow.compute  # noqa: F401  (``pa.compute`` on the worker)
        encoder = WordEncoder(tokens, merges)
        for batch in batches:
            yield _encode_batch(encoder, batch)

    return run(words)


def encode(text: Column, model: BpeModel) -> Column:
    """Ids of a text, without markers. Characters outside the alphabet give ``[UNK]`` each."""
    return encode_words(F.coalesce(marked_words(text), F.array().cast("array<string>")), model)


def prompt_ids(text: Column, model: BpeModel) -> Column:
    """Ids of a prompt: the start marker, then the text."""
    return F.concat(F.array(F.lit(model.token_to_id(SPECIAL_TOKENS[2]))), encode(text, model))


def tokenize(text: Column, model: BpeModel, length: int) -> Column:
    """Ids of a text between markers, cut or padded to ``length``.

    The markers are part of the text before it is cut, so cutting loses the end marker.
    """
    return pad_truncate(encode(with_markers(text), model), length, PAD_ID)


def tokenize_corpus(df: DataFrame, model: BpeModel, length: int, column: str = "text",
                    keys: tuple[str, ...] = ()) -> DataFrame:
    """``input_ids`` of a corpus; other columns than ``keys`` are dropped."""
    return df.filter(F.col(column).isNotNull()).select(
        *keys, tokenize(F.col(column), model, length).alias("input_ids"))


def vocab_array(model: BpeModel) -> Column:
    """All tokens in id order as one constant; tokens never hold a newline."""
    return F.split(F.lit("\n".join(model.tokens)), "\n", -1)


def id_tokens(ids: Column, model: BpeModel) -> Column:
    """The token of each id."""
    vocab = vocab_array(model)
    return F.transform(ids, lambda i: F.get(vocab, i))


def decode(ids: Column, model: BpeModel, skip_special_tokens: bool = True) -> Column:
    """Tokens joined by one space. This does not restore the spacing of the text."""
    if skip_special_tokens:
        ids = F.filter(ids, lambda i: i >= len(SPECIAL_TOKENS))
    return F.array_join(id_tokens(ids, model), " ")
