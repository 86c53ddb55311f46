"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from textloom.sources import workspace


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` as a Parquet table in the shared folder; cuts the lineage.

    Later reads prune columns, see the same rows after a lost executor, and join on
    plain shuffles, which Spark can split where one key is frequent. What was shuffled for
    the table is of no more use once it is written; Spark is told to remove it then.
    """
    spark = df.sparkSession
    path = workspace.scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(_SHUFFLE_CLEANUP, "false")
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs inside hand tasks at most so many rows at once: bounds the memory for rows of large binaries."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def row_reader(spark: SparkSession) -> Iterator[None]:
    """Jobs inside read Parquet row by row: a batch of columns would hold thousands of rows of large binaries."""
    key = "spark.sql.parquet.enableVectorizedReader"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(table: DataFrame) -> None:
    """Remove the files of a table made by :func:`stored`."""
    for name in {file.rsplit("/", 2)[-2] for file in table.inputFiles()}:
        workspace.remove(table.sparkSession, f"{workspace.scratch_root(table.sparkSession)}/{name}")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have (names differ by more than case)."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def cores(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


@contextmanager
def for_this_task(build: Callable[[], object]) -> Iterator[object]:
    """An object with caches for the time of a task; its memory is given back when the task ends."""
    made = build()
    try:
        yield made
    finally:
        vars(made).clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # there with the GNU library only
        if trim is not None:
            trim(0)


def text_slices(batch: pa.RecordBatch, rows: int = 2000, size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows and, but for a single longer one, ``size`` bytes of column ``text``."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, min(start + rows, int(np.searchsorted(ends, before + size, side="right"))))
        yield batch.slice(start, end - start)
        start = end


def key_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``keys``, from batches sorted by them.

    A run is carried over from batch to batch until its key ends; only one run is
    held at a time.
    """
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        ends = run_ends(columns)
        start = 0
        for end in ends:
            key = tuple(c[start].as_py() for c in columns)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield pa.Table.from_batches(held)


def run_ends(columns: list[pa.Array]) -> list[int]:
    import numpy as np

    n = len(columns[0])
    changed = np.zeros(n, dtype=bool)
    for column in columns:
        values = column.to_numpy(zero_copy_only=False)
        changed[1:] |= values[1:] != values[:-1]
    return [*np.flatnonzero(changed).tolist(), n]
