"""The learned vocabulary and its tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from textloom.config import SPECIAL_TOKENS

VOCAB_SCHEMA = "token string, id int, special boolean"
MERGES_SCHEMA = "rank int, left_id int, right_id int, new_id int"


@dataclass(frozen=True)
class BpeModel:
    """Tokens by id, and merges ``(left id, right id, new id)`` by rank.

    Its size is bounded by the alphabet (Unicode) plus ``vocab_size``, whatever the
    size of the corpus. So it may live on the driver and go out with tasks.
    """

    tokens: tuple[str, ...]
    merges: tuple[tuple[int, int, int], ...]

    @cached_property
    def ids(self) -> dict[str, int]:
        return {token: i for i, token in enumerate(self.tokens)}

    @property
    def vocab_size(self) -> int:
        return len(self.tokens)

    def token_to_id(self, token: str) -> int:
        return self.ids[token]

    def first(self, merges: int) -> "BpeModel":
        """The model after the first ``merges`` merges."""
        kept = self.merges[:merges]
        base = min((new for _, _, new in self.merges), default=len(self.tokens))
        size = max((new + 1 for _, _, new in kept), default=base)
        return BpeModel(self.tokens[:max(size, base)], kept)

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        rows = [(token, i, i < len(SPECIAL_TOKENS)) for i, token in enumerate(self.tokens)]
        return spark.createDataFrame(rows, VOCAB_SCHEMA)

    def merges_table(self, spark: SparkSession) -> DataFrame:
        rows = [(rank, *merge) for rank, merge in enumerate(self.merges)]
        return spark.createDataFrame(rows, MERGES_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write ``vocab`` and ``merges``; the vocabulary, last, marks the model as finished."""
        self.merges_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")
        self.vocab_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BpeModel":
        return BpeModel.of_tables(spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges"))

    @staticmethod
    def of_tables(vocab: DataFrame, merges: DataFrame) -> "BpeModel":
        tokens = tuple(row.token for row in sorted(vocab.collect(), key=lambda row: row.id))
        ranked = sorted(merges.collect(), key=lambda row: row.rank)
        return BpeModel(tokens, tuple((row.left_id, row.right_id, row.new_id) for row in ranked))
