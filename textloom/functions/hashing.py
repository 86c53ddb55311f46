"""Seeded row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(keys: Sequence[str], *salts: int) -> Column:
    """Hex md5 of the salts and the key columns, joined by ``:``.

    The same for every run, partitioning and engine; spreads unique keys evenly.
    """
    parts = [F.lit(str(salt)) for salt in salts] + [F.col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))
