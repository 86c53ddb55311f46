"""Full batches of rows that arrive bit by bit.

Rows that do not fill a batch wait in the state of the stream, and the rows of the next trigger go behind them, so
every batch is full, across files, triggers and restarts; the last rows can be had as a short batch once nothing more is to
come. Rows are batched by ``lane``. A lane's rows of one trigger are held by one task, and files per
trigger bound them: the more lanes, the more tasks share a trigger.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from textloom.streaming.arrivals import with_rocksdb

BATCH = "batch_id"
PLACE = "place"
_WAITING, _NEXT = "waiting", "next"
#: Rows that are plain Python values at once; the others of a trigger stay in the arrays they came in.
_HELD_ROWS = 5_000


class BatchFiller(StatefulProcessor):
    """Gives the rows of a key batch numbers and places, and holds back those of a batch that is not full."""

    def __init__(self, schema: T.StructType, key_names: Sequence[str], order: Sequence[str], batch_size: int) -> None:
        self.row_schema, self.key_names, self.order, self.batch_size = schema, list(key_names), list(order), batch_size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getListState(_WAITING, T.StructType([T.StructField(PLACE, T.IntegerType()), *self.row_schema.fields]))
        self.next = handle.getValueState(_NEXT, T.StructType([T.StructField(BATCH, T.LongType())]))

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import pandas as pd

        names = self.row_schema.fieldNames()
        arrived = pd.concat(list(rows), ignore_index=True)[names].sort_values(self.order, kind="stable")
        held = [tuple(row)[1:] for row in self.waiting.get()] if self.waiting.exists() else []
        number = self.next.get()[0] if self.next.exists() else 0
        for start in range(0, len(arrived), _HELD_ROWS):
            part = arrived.iloc[start:start + _HELD_ROWS]
            held += zip(*[[_plain(value, field.dataType) for value in part[field.name]] for field in self.row_schema.fields])
            n_full = len(held) // self.batch_size
            given, held = held[:n_full * self.batch_size], held[n_full * self.batch_size:]
            places = [(number + k // self.batch_size, k % self.batch_size) for k in range(len(given))]
            number += n_full
            yield pd.DataFrame([(*key, *row, *place) for row, place in zip(given, places)],
                               columns=[*self.key_names, *names, BATCH, PLACE], dtype=object)
        if held:
            self.waiting.put([(k, *row) for k, row in enumerate(held)])
        else:
            self.waiting.clear()
        self.next.update((number,))

    def close(self) -> None:
        pass


def _plain(value, kind: T.DataType):
    """A value of a column as Python has it. A null comes as not-a-number in a column of numbers; so do nulls of doubles."""
    if value is None or isinstance(value, float) and value != value:
        return None
    if isinstance(kind, T.IntegralType):
        return int(value)
    value = value.tolist() if hasattr(value, "tolist") else value
    return list(value) if isinstance(value, (list, tuple)) else value


def full_batches(stream: DataFrame, by: Sequence[str], order: Sequence[str], batch_size: int) -> DataFrame:
    """Rows of full batches, with ``batch_id`` and ``place`` in it.

    Batches are filled for each value of the columns ``by``, in order of arrival, and by the columns ``order`` among
    the rows of one trigger. The state has less than ``batch_size`` rows for each value. Rows may have nulls
    in any column but those of ``order``; a double that is not a number becomes a null.
    """
    rows = T.StructType([f for f in stream.schema.fields if f.name not in by])
    out = T.StructType([*(stream.schema[name] for name in by), *rows.fields,
                        T.StructField(BATCH, T.LongType()), T.StructField(PLACE, T.IntegerType())])
    return stream.groupBy(*by).transformWithStateInPandas(
        statefulProcessor=BatchFiller(rows, by, order, batch_size), outputStructType=out, outputMode="Append", timeMode="None")


def batches_to(stream: DataFrame, path: str, checkpoint: str, by: Sequence[str], order: Sequence[str],
               batch_size: int) -> StreamingQuery:
    """Run the stream over what has arrived and append the rows of full batches to a Parquet table, each once."""
    filled = full_batches(stream, by, order, batch_size)
    return with_rocksdb(stream.sparkSession, lambda: (
        filled.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)))


def waiting_rows(spark: SparkSession, checkpoint: str, by: Sequence[str]) -> DataFrame:
    """The rows that wait in the state of a stopped stream, with the number of the batch they are to be in and their place."""
    def state(name: str) -> DataFrame:
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()

    keys = [F.col(f"key.{name}").alias(name) for name in by]
    number = state(_NEXT).select(*keys, F.col(f"value.{BATCH}").alias(BATCH))
    held = state(_WAITING).select(*keys, "list_element.*")
    rows = [name for name in held.columns if name not in (*by, PLACE)]
    return held.join(number, list(by)).select(*by, *rows, BATCH, PLACE)
