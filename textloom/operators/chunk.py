"""Bringing texts to a length range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "part_idx"


def text_length(df: DataFrame, column: str = "text", name: str = "length") -> DataFrame:
    """Add the length of a column in code points."""
    return df.withColumn(name, F.length(column))


def drop_short(df: DataFrame, min_chars: int, column: str = "text") -> DataFrame:
    """Rows of at least ``min_chars`` code points; null texts go too."""
    return df.filter(F.length(column) >= min_chars)


def keep_fitting(df: DataFrame, min_chars: int, max_chars: int,
                 column: str = "text") -> DataFrame:
    """Rows whose text is in the range, both ends included."""
    return df.filter(F.length(column).between(min_chars, max_chars))


def over_long(df: DataFrame, max_chars: int, column: str = "text") -> DataFrame:
    """Rows whose text is too long."""
    return df.filter(F.length(column) > max_chars)


def newline_parts(df: DataFrame, keys: Sequence[str], column: str = "text") -> DataFrame:
    """One row per line of each text, empty lines included, numbered from 0."""
    return df.select(*keys, F.posexplode(F.split(column, "\n", -1)).alias(PART, column))


def _candidate_parts(text: Column, max_chars: int) -> Column:
    return F.when(F.length(text) <= max_chars, F.array(text)).otherwise(F.split(text, "\n", -1))


def split_long_texts(df: DataFrame, keys: Sequence[str], min_chars: int, max_chars: int,
                     column: str = "text") -> DataFrame:
    """Texts in the range stay whole; longer ones give those of their lines that fit.

    Short texts, and lines too short or still too long, are dropped. ``part_idx``
    is the line number in the source text. Narrow: no shuffle, no Python.
    """
    return (
        df.filter(F.length(column) >= min_chars)
        .select(*keys, F.posexplode(_candidate_parts(F.col(column), max_chars)).alias(PART, column))
        .filter(F.length(column).between(min_chars, max_chars))
    )


def lengths_before_and_after(df: DataFrame, min_chars: int, max_chars: int,
                             column: str = "text", keys: Sequence[str] = ()) -> DataFrame:
    """``(*keys, stage, length)`` of every text (``raw``) and of every part it gives (``chunks``).

    Each text is read once for both.
    """
    text = F.col(column)
    part_lengths = F.when(F.length(text) >= min_chars, F.filter(
        F.transform(_candidate_parts(text, max_chars), F.length),
        lambda n: n.between(min_chars, max_chars))).otherwise(F.array().cast("array<int>"))

    def staged(name: str, lengths: Column) -> Column:
        return F.transform(lengths, lambda n: F.struct(F.lit(name).alias("stage"), n.alias("length")))

    both = F.concat(staged("raw", F.array(F.length(text))), staged("chunks", part_lengths))
    return df.filter(text.isNotNull()).select(*keys, F.inline(both))


def part_outcomes(df: DataFrame, min_chars: int, max_chars: int,
                  column: str = "text") -> DataFrame:
    """How many parts the splitting keeps, and how many it drops for which reason."""
    length = F.length("part")
    outcome = (F.when(length < min_chars, "too_short")
               .when(length > max_chars, "too_long").otherwise("kept"))
    return (
        df.filter(F.col(column).isNotNull())
        .select(F.explode(F.when(F.length(column) < min_chars, F.array(column))
                          .otherwise(_candidate_parts(F.col(column), max_chars))).alias("part"))
        .groupBy(outcome.alias("outcome")).agg(F.count("*").alias("parts"))
    )
