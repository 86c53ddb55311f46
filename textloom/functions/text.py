"""Word expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.config import EOS_TOKEN, SOS_TOKEN, SPECIAL_TOKENS

# A word is a run of word characters or a run of other visible
# characters; both classes are the Unicode ones.
WORD_PATTERN = r"(?U)\w+|[^\w\s]+"

_marker = "|".join(token.replace("[", r"\[").replace("]", r"\]") for token in SPECIAL_TOKENS)

# As above, but a marker token written out in the text is one word of its own.
MARKED_WORD_PATTERN = rf"(?U){_marker}|\w+|(?:(?!{_marker})[^\w\s])+"


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def marked_words(text: Column) -> Column:
    """The words of a text to encode; literal marker tokens stay whole."""
    return F.regexp_extract_all(text, F.lit(MARKED_WORD_PATTERN), F.lit(0))


def characters(text: Column) -> Column:
    """The code points of a text."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "", -1))


def with_markers(text: Column) -> Column:
    """The text between the start and the end marker."""
    return F.concat(F.lit(SOS_TOKEN), text, F.lit(EOS_TOKEN))
