"""The corpus steps over shards as they arrive.

Chunking and tokenizing keep no state. Word counts keep one number per word.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from textloom.operators.word_stats import word_counts
from textloom.sources.workspace import is_complete, is_directory, names_in, remove

TRIGGERS_PER_BASE = 20
# The state store is a setting of the session while a stream starts: one start at a time.
_starting = threading.Lock()
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def arriving_shards(spark: SparkSession, path: str, schema: T.StructType | str,
                    files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files in the directory ``path``, as a stream; or just the file ``path``."""
    reader = spark.readStream.schema(schema)
    if not is_directory(spark, path):
        path, name = path.rsplit("/", 1)
        reader = reader.option("pathGlobFilter", name)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a stateless stream over what has arrived, and append to a Parquet table.

    The checkpoint makes each input file count once, also after a restart.
    """
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(path))


def run_to_end(running: StreamingQuery, least_triggers: int = 1) -> None:
    """Wait for a stream over what has arrived; an error if it took fewer triggers than given."""
    running.awaitTermination()
    triggers = sum(1 for progress in running.recentProgress if progress["numInputRows"] > 0)
    if triggers < least_triggers:
        raise RuntimeError(f"the stream took {triggers} triggers, not {least_triggers}")


def with_rocksdb(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a stream whose state is kept in RocksDB, whatever the session's setting is."""
    with _starting:
        before = spark.conf.get(_STATE_STORE)
        spark.conf.set(_STATE_STORE, _ROCKSDB)
        try:
            return start()
        finally:
            spark.conf.set(_STATE_STORE, before)


def count_words_to(stream: DataFrame, path: str, checkpoint: str, column: str = "text",
                   triggers_per_base: int = TRIGGERS_PER_BASE) -> StreamingQuery:
    """Running word counts; every trigger writes the counts it has changed.

    Every ``triggers_per_base`` triggers, what has been written becomes one table of the
    newest counts, and the changes before it go: a reader meets that many folders at
    most. A trigger that runs again replaces what it wrote. Read with :func:`latest_counts`.
    """
    spark = stream.sparkSession

    def write_changed(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
        if (batch_id + 1) % triggers_per_base == 0:
            _write_base(changed.sparkSession, path, batch_id)

    return with_rocksdb(spark, lambda: (
        word_counts(stream, column).writeStream.outputMode("update")
        .foreachBatch(write_changed).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()))


def _written(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """The trigger up to which there is a base (-1: none), and the later triggers."""
    bases = [int(name.split("=")[1]) for name in names_in(spark, f"{path}/base")
             if is_complete(spark, f"{path}/base/{name}")]
    base = max(bases, default=-1)
    changes = [int(name.split("=")[1]) for name in names_in(spark, f"{path}/changes")]
    return base, [k for k in changes if k > base]


def _write_base(spark: SparkSession, path: str, upto: int) -> None:
    base, changes = _written(spark, path)
    if base < upto:
        latest_counts(spark, path).write.mode("overwrite").parquet(f"{path}/base/upto={upto}")
    for old in [f"base/{n}" for n in names_in(spark, f"{path}/base") if n != f"upto={upto}"] + \
            [f"changes/{n}" for n in names_in(spark, f"{path}/changes") if int(n.split("=")[1]) <= upto]:
        remove(spark, f"{path}/{old}", below=path)


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of each word, from the newest base and the changes since."""
    base, changes = _written(spark, path)
    parts = []
    if changes:             # one table of all triggers since the base, one listing
        parts.append(spark.read.schema("word string, cnt bigint, batch_id int").option("basePath", f"{path}/changes")
                     .parquet(*[f"{path}/changes/batch_id={k}" for k in changes]))
    if base >= 0:
        parts.append(spark.read.schema("word string, cnt bigint").parquet(f"{path}/base/upto={base}").withColumn("batch_id", F.lit(base)))
    if not parts:
        return spark.createDataFrame([], "word string, cnt bigint")
    together = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return together.groupBy("word").agg(F.max_by("cnt", "batch_id").alias("cnt"))
