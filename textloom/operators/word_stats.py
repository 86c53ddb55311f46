"""Word, character and symbol-pair counts.

During learning a word is a string with one code point per symbol: the symbol with
id ``i`` is written as the ``i``-th usable code point. Strings then sort like id
sequences, merging a pair is a native ``replace``, and everything stays in generated
code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.config import SPECIAL_TOKENS
from textloom.functions.text import characters, words

_FIRST_POINT = 1            # no NUL: ``translate`` would delete it
_SURROGATES = (0xD800, 0xE000)
_LAST_ID = 0x10FFFF - _FIRST_POINT - (_SURROGATES[1] - _SURROGATES[0])

# Every code point together with the next one.
_ADJACENT = r"(?s)(?=(..))."
ADJACENT_PAIRS_SQL = f"regexp_extract_all({{}}, '{_ADJACENT}', 1)"


def symbol(token_id: int) -> str:
    """The code point that stands for a token id."""
    if not 0 <= token_id <= _LAST_ID:
        raise ValueError(f"token id {token_id} is out of range")
    point = token_id + _FIRST_POINT
    if point >= _SURROGATES[0]:
        point += _SURROGATES[1] - _SURROGATES[0]
    return chr(point)


def token_id(sym: str) -> int:
    """The token id that a code point stands for."""
    point = ord(sym)
    if point >= _SURROGATES[1]:
        point -= _SURROGATES[1] - _SURROGATES[0]
    return point - _FIRST_POINT


def pre_tokenize(df: DataFrame, keys: Sequence[str] = (), column: str = "text") -> DataFrame:
    """One row per word, numbered within its text."""
    return df.select(*keys, F.posexplode(words(F.col(column))).alias("word_idx", "word"))


def word_counts(df: DataFrame, column: str = "text") -> DataFrame:
    """Frequency of each distinct word. Frequent words shrink before the shuffle."""
    exploded = df.select(F.explode(words(F.col(column))).alias("word"))
    return exploded.groupBy("word").agg(F.count("*").alias("cnt"))


def distinct_characters(counted: DataFrame) -> DataFrame:
    """The characters of all words. Never more than Unicode has."""
    return counted.select(F.explode(characters(F.col("word"))).alias("token")).distinct()


def collect_alphabet(counted: DataFrame) -> list[str]:
    """The distinct characters in code-point order."""
    return sorted(row.token for row in distinct_characters(counted).collect())


def as_symbols(counted: DataFrame, alphabet: Sequence[str]) -> DataFrame:
    """Word counts with each word as its symbol string ``s``."""
    first = len(SPECIAL_TOKENS)
    target = "".join(symbol(first + i) for i in range(len(alphabet)))
    written = F.translate("word", "".join(alphabet), target) if alphabet else F.col("word")
    return counted.select("word", "cnt", written.alias("s"))


def adjacent_pairs(symbols: Column) -> Column:
    """All pairs of neighbouring symbols, overlapping ones too."""
    return F.regexp_extract_all(symbols, F.lit(_ADJACENT), F.lit(1))


def pair_counts(states: DataFrame) -> DataFrame:
    """Sum of word frequencies over neighbouring symbols, by ``pair``."""
    return (states.select(F.explode(adjacent_pairs(F.col("s"))).alias("pair"), "cnt")
            .groupBy("pair").agg(F.sum("cnt").alias("n")))


def best_pairs(counts: DataFrame, limit: int) -> DataFrame:
    """The most frequent pairs; equal counts rank by left id, then right id."""
    return counts.orderBy(F.col("n").desc(), "pair").limit(limit)


def pair_ids(pair: Column) -> tuple[Column, Column]:
    """Left and right token id of a pair."""
    def decoded(sym: Column) -> Column:
        point = F.ascii(sym)
        gap = F.when(point >= _SURROGATES[1], _SURROGATES[1] - _SURROGATES[0]).otherwise(0)
        return point - gap - _FIRST_POINT
    return decoded(F.substring(pair, 1, 1)), decoded(F.substring(pair, 2, 1))


def symbol_ids(symbols: Column) -> Column:
    """A symbol string as an array of token ids."""
    return F.transform(characters(symbols), lambda c: F.ascii(c) - F.lit(_FIRST_POINT) - F.when(
        F.ascii(c) >= _SURROGATES[1], _SURROGATES[1] - _SURROGATES[0]).otherwise(0))


def sql_text(text: str) -> str:
    """A text as a SQL literal, all characters escaped."""
    return "'" + "".join(f"\\U{ord(c):08X}" for c in text) + "'"


def merge_expression(symbols: str, merges: Sequence[tuple[str, str]]) -> str:
    """SQL that replaces pairs by new symbols, from left to right and without overlap.

    The number of steps is filled up to a power of two with steps that do nothing,
    so that rounds share their generated code.
    """
    steps = list(merges)
    while len(steps) & (len(steps) - 1):
        steps.append(("", ""))
    for pair, new in steps:
        symbols = f"replace({symbols}, {sql_text(pair)}, {sql_text(new)})"
    return symbols


def merge_pairs(symbols: str, merges: Sequence[tuple[str, str]]) -> Column:
    """:func:`merge_expression` as a column."""
    return F.expr(merge_expression(symbols, merges))
