"""Numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def grouped(value: Column) -> Column:
    """A whole number with thousands separators."""
    return F.format_number(value, 0)


def fixed(value: Column, decimals: int) -> Column:
    """A number with a fixed number of decimals, rounded by its exact binary value."""
    return F.replace(F.format_number(value, decimals), F.lit(","), F.lit(""))


def left_aligned(text: Column, width: int) -> Column:
    """Filled up with spaces; longer texts are not cut."""
    return F.rpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))


def zero_padded(text: Column, width: int) -> Column:
    """Filled up with leading zeros; longer texts are not cut."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))
