"""Length profiles that are kept up as files come.

The ledger has the numbers of texts by length, before and after chunking, for each source file it has read. A file is known
by its name, size and time: only files that are new or changed are read, each text once, and the counts of files that
are gone are left out. Histograms are made of the counts, so no text is read for a profile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.config import CorpusConfig
from textloom.operators.chunk import lengths_before_and_after
from textloom.operators.profile import length_histogram
from textloom.sources.workspace import file_states

_SCHEMA = "source string, file string, state string, stage string, length int, cnt bigint"
_READ = "read"              # the stage of the row that says that a file has been read, also one without texts


class LengthLedger:
    """Counts of lengths in a table at ``path``; one chunking range per ledger."""

    def __init__(self, spark: SparkSession, path: str, config: CorpusConfig) -> None:
        self.spark, self.path, self.config = spark, path, config
        if not file_states(spark, [path]):
            spark.createDataFrame([], _SCHEMA).write.mode("append").parquet(path)

    def _known(self) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).parquet(self.path)

    def _present(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.createDataFrame(file_states(self.spark, paths), "file string, state string")

    def update(self, source: str, paths: Sequence[str], column: str = "text", fmt: str = "parquet") -> int:
        """Read the files of a source, at or below ``paths``, that the ledger does not know; returns how many."""
        known = self._known().where((F.col("source") == source) & (F.col("stage") == _READ)).select("file", "state")
        new = self._present(paths).join(known, ["file", "state"], "left_anti").collect()     # names only, of new files
        if not new:
            return 0
        texts = (self.spark.read.format(fmt).load([row["file"] for row in new])
                 .select(F.col(column).alias("text"), F.col("_metadata.file_path").alias("read_from")))
        lengths = lengths_before_and_after(texts, self.config.min_chars, self.config.max_chars, "text", keys=("read_from",))
        counted = lengths.groupBy("read_from", "stage", "length").agg(F.count("*").alias("cnt"))
        listed = self.spark.createDataFrame([(row["file"], row["state"], _uri_name(self.spark, row["file"])) for row in new],
                                            "file string, state string, name string")
        found = counted.join(listed, _uri_name_column(F.col("read_from")) == F.col("name")).select(
            F.lit(source).alias("source"), "file", "state", "stage", "length", "cnt")
        marks = listed.select(F.lit(source).alias("source"), "file", "state", F.lit(_READ).alias("stage"),
                              F.lit(None).cast("int").alias("length"), F.lit(0).cast("bigint").alias("cnt"))
        found.unionByName(marks).coalesce(1).write.mode("append").parquet(self.path)
        return len(new)

    def counts(self, sources: dict[str, Sequence[str]]) -> DataFrame:
        """``(source, stage, length, cnt)`` over the files that the sources have now. No text is read."""
        parts = [self._known().where((F.col("source") == source) & (F.col("stage") != _READ))
                 .join(self._present(paths), ["file", "state"], "left_semi") for source, paths in sources.items()]
        together = parts[0]
        for part in parts[1:]:
            together = together.unionByName(part)
        return together.groupBy("source", "stage", "length").agg(F.sum("cnt").alias("cnt"))

    def profile(self, sources: dict[str, Sequence[str]]) -> DataFrame:
        """Histograms of each source before and after chunking, and of all chunks together, as of one pass over all texts."""
        counts = self.counts(sources)
        staged = counts.select(F.concat_ws(" ", "source", "stage").alias("stage"), "length", "cnt")
        combined = (counts.where("stage = 'chunks'").groupBy(F.lit("combined").alias("stage"), "length")
                    .agg(F.sum("cnt").alias("cnt")))
        return length_histogram(staged.unionByName(combined), self.config.histogram_bins, ["stage"])


def _uri_name(spark: SparkSession, path: str) -> str:
    """A path as the column of file names has it, without what stands differently in front of it."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString().removeprefix("file:").lstrip("/")


def _uri_name_column(path: Column) -> Column:
    return F.regexp_replace(path, "^(file:)?/*", "")
