"""Reading corpora, and split directories of Parquet shards."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.sources.workspace import manifest, materialize

SPLIT = "split"
SHARD = "shard_id"


def read_corpus(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
                schema: T.StructType | str | None = None, **options) -> DataFrame:
    """A source corpus in any format Spark reads (``parquet``, ``json``, ``text``, ...)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


@dataclass(frozen=True)
class Source:
    """A source of texts: where it lies, which column has the texts, and which columns name a row.

    Without key columns rows are named by where they stand, see :func:`keyed_texts`.
    """

    name: str
    path: str
    fmt: str = "parquet"
    column: str = "text"
    keys: tuple[str, ...] = ()

    @classmethod
    def parse(cls, given: str) -> Source:
        """``NAME=PATH``, then options: ``NAME=PATH?key=conv_id,turn&column=text&format=json``."""
        name, _, rest = given.partition("=")
        path, _, query = rest.partition("?")
        options = {k: v for k, _, v in (item.partition("=") for item in query.split("&") if item)}
        if not name or not path or set(options) - {"key", "column", "format"}:
            raise ValueError(f"not a source: {given}")
        fmt = options.get("format", "parquet")
        keys = tuple(k for k in options.get("key", "").split(",") if k)
        return cls(name, path, fmt, options.get("column", "value" if fmt == "text" else "text"), keys)


def row_key(keys: Sequence[str]) -> Column:
    """One text that names a row: the key itself, or a JSON list of several."""
    parts = [F.col(k).cast("string") for k in keys]
    return parts[0] if len(parts) == 1 else F.to_json(F.array(*parts))


def keyed_texts(spark: SparkSession, source: Source, kept_at: str) -> DataFrame:
    """``(row_id string, text)`` of a source, with an id that stays the same in every run.

    With key columns, the id is made of them. A Parquet source without key is numbered by
    file and row. Any other source without key is first written to ``kept_at`` as
    Parquet, once, and numbered from there: its ids hold as long as that copy does. It is
    copied again when its files change.
    """
    df = read_corpus(spark, source.path, source.fmt)
    if source.keys:
        return df.select(row_key(source.keys).alias("row_id"), F.col(source.column).alias("text"))
    if source.fmt != "parquet":
        df = materialize(spark, kept_at, lambda: df.select(source.column),
                         manifest(spark, [source.path], fmt=source.fmt, column=source.column))
    place = F.concat_ws(":", F.element_at(F.split("_metadata.file_path", "/"), -1), "_metadata.row_index")
    return df.select(place.alias("row_id"), F.col(source.column).alias("text"))


def read_shard(spark: SparkSession, path: str) -> DataFrame:
    """One shard, a file or a directory, without its split and shard columns."""
    return spark.read.parquet(path)


def write_splits(df: DataFrame, root: str, shard_rows: int) -> None:
    """Write ``split=<name>/`` directories with files of at most ``shard_rows`` rows.

    Rows stay in the partition they are in: no shuffle. For balanced, numbered
    shards see :func:`write_shards`.
    """
    (df.write.mode("overwrite").option("maxRecordsPerFile", shard_rows)
       .partitionBy(SPLIT).parquet(root))


def write_shards(df: DataFrame, root: str) -> None:
    """Write ``split=<name>/shard_id=<i>/`` directories.

    ``df`` has the columns ``split`` and ``shard_id`` and comes in position order, so
    that a task holds a few neighbouring shards. No shuffle: a shard that spans tasks
    gets a file from each.
    """
    df.write.mode("overwrite").partitionBy(SPLIT, SHARD).parquet(root)


def read_splits(spark: SparkSession, root: str, splits: list[str] | None = None) -> DataFrame:
    """All splits below ``root`` with the column ``split``.

    Works for ``split=train/...`` (the directories then prune the scan).
    """
    df = spark.read.parquet(root)
    return df if splits is None else df.filter(F.col(SPLIT).isin(splits))


def read_plain_splits(spark: SparkSession, root: str,
                      splits: list[str] | None = None) -> DataFrame:
    """Splits below ``root`` laid out as ``<name>/*.parquet``, with the column ``split``.

    All of them, or only the directories named. Directories without Parquet files
    give no rows.
    """
    paths = [root] if splits is None else [f"{root}/{name}" for name in splits]
    df = (spark.read.option("recursiveFileLookup", "true")
          .option("pathGlobFilter", "*.parquet").parquet(*paths))
    return df.withColumn(SPLIT, F.element_at(F.split("_metadata.file_path", "/", -1), -2))


def write_text(df: DataFrame, path: str, column: str = "text") -> None:
    """One text per record, newline separated; inner newlines make further lines."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").option(
        "lineSep", "\n").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a text corpus."""
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")
