"""Putting splits and corpora together."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.sources.tables import SPLIT


def flatten_splits(df: DataFrame) -> DataFrame:
    """All splits as one table; duplicates stay."""
    return df.drop(SPLIT)


def combine_corpora(corpora: Mapping[str, DataFrame]) -> DataFrame:
    """UNION ALL of corpora with the same columns, tagged with their name in ``corpus``."""
    tagged = [df.withColumn("corpus", F.lit(name)) for name, df in corpora.items()]
    return reduce(DataFrame.unionByName, tagged)
