"""The best epochs of training runs while their losses arrive.

Rows of an epoch's trace come in any order, from all ranks, and epochs may overtake each other. An epoch is judged once
all of its rows are there, and after the epochs before it; until then its sum and count wait in the state of the
stream, next to the best loss so far and the epoch that is due.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from textloom.streaming.arrivals import with_rocksdb

_EPOCH = T.StructType([T.StructField("epoch", T.IntegerType())])
_SUMS = T.StructType([T.StructField("total", T.DoubleType()), T.StructField("rows", T.LongType())])
_DUE = T.StructType([T.StructField("epoch", T.IntegerType()), T.StructField("best", T.DoubleType())])


class BestEpochs(StatefulProcessor):
    """Judges the epochs of one run in their order, each once, when it is complete."""

    def __init__(self, key_names: Sequence[str], first_epoch: int) -> None:
        self.key_names, self.first_epoch = list(key_names), first_epoch

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getMapState("open", _EPOCH, _SUMS)
        self.due = handle.getValueState("due", _DUE)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import pandas as pd

        arrived: dict[int, list[float]] = {}
        expected: dict[int, int] = {}
        for part in rows:
            for epoch, loss, n in zip(part["epoch"].tolist(), part["loss"].tolist(), part["epoch_rows"].tolist()):
                arrived.setdefault(epoch, []).append(loss)
                expected[epoch] = n
        complete: dict[int, float] = {}
        for epoch, losses in arrived.items():
            total, n = self.open.getValue((epoch,)) if self.open.containsKey((epoch,)) else (0.0, 0)
            total, n = math.fsum([total, *losses]) if all(map(math.isfinite, [total, *losses])) else total + sum(losses), n + len(losses)
            # A complete epoch has no rows to wait for: it is kept with the mean, and marked by a count below 0.
            state = (total / n, -1) if n >= expected[epoch] else (total, n)
            self.open.updateValue((epoch,), state)
        due, best = self.due.get() if self.due.exists() else (self.first_epoch, math.inf)
        found = []
        while self.open.containsKey((due,)):
            loss, n = self.open.getValue((due,))
            if n != -1:
                break
            if math.isfinite(loss) and loss < best:
                best = loss
                found.append((*key, due, loss))
            self.open.removeKey((due,))
            due += 1
        self.due.update((due, best))
        yield pd.DataFrame(found, columns=[*self.key_names, "epoch", "loss"])

    def close(self) -> None:
        pass


def best_epochs(stream: DataFrame, by: Sequence[str], split: str = "valid", first_epoch: int = 0) -> DataFrame:
    """Epochs whose loss in ``split`` is below that of all earlier ones of their run, as they become known.

    ``stream`` has ``epoch``, ``split``, ``loss`` and ``epoch_rows``, the number of rows that an epoch has in the split; a run is a value
    of the columns ``by``. Epochs count up from ``first_epoch`` without gaps. An epoch with a loss that is not finite is never a best
    one. Per run, the state has a sum and a count for each epoch that waits, and two numbers. Rows without epoch or loss are ignored.
    """
    rows = stream.where((F.col("split") == split) & F.col("epoch").isNotNull() & F.col("loss").isNotNull()).select(
        *by, F.col("epoch").cast("int").alias("epoch"), F.col("loss").cast("double").alias("loss"),
        F.col("epoch_rows").cast("long").alias("epoch_rows"))
    out = T.StructType([*(rows.schema[name] for name in by), T.StructField("epoch", T.IntegerType()), T.StructField("loss", T.DoubleType())])
    return rows.groupBy(*by).transformWithStateInPandas(
        statefulProcessor=BestEpochs(by, first_epoch), outputStructType=out, outputMode="Append", timeMode="None")


def best_epochs_to(stream: DataFrame, path: str, checkpoint: str, by: Sequence[str], split: str = "valid",
                   first_epoch: int = 0) -> StreamingQuery:
    """Run the stream over what has arrived and append the best epochs to a Parquet table, each once."""
    best = best_epochs(stream, by, split, first_epoch)
    return with_rocksdb(stream.sparkSession, lambda: (
        best.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)))
