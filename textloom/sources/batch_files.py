"""Training batches in files that a trainer opens at any place.

The batches of a rank are record batches of Arrow IPC files, in order, ``FILE_BATCHES`` to a file. The file format ends with
the offsets of its record batches, and the files have the number of their first batch in their name, so batch
``k`` is found by arithmetic and read from a memory map without those before it::

    {target}/rank=2/batches-000000010000.arrow
"""

from __future__ import annotations

import os
import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.shard_sink import _filesystem

FILE_BATCHES = 10_000


def file_name(first: int) -> str:
    return f"batches-{first:012d}.arrow"


def write_batch_files(rows: DataFrame, target: str, batch_size: int, file_batches: int = FILE_BATCHES, ids: str = "input_ids",
                      place: str = "pos", max_length: int = 128) -> int:
    """Write ``rows (rank, <place>, <ids>)``, whose places count from 0 in each rank; returns the number of files.

    Ids become fixed-size lists of ``max_length``. A file has the rows of one run of batches of one rank: bounded, and one
    task's. It is written aside and renamed, and its name and content follow from its rows: a task run again leaves the
    same file. Rows must not have nulls, and all id lists the given length; a row that does not is an error.
    """
    per_file = batch_size * file_batches
    kind = pa.list_(pa.int32(), max_length)
    schema = pa.schema([("input_ids", kind)])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, folder = _filesystem(target)
        key, out, held, writer, attempt = None, None, None, None, None

        def finish():
            nonlocal held
            if held is not None and len(held):
                writer.write_batch(pa.RecordBatch.from_arrays([held], schema=schema))
            held = None
            writer.close()
            out.close()
            name = posixpath.join(folder, f"rank={key[0]}", file_name(key[1] * file_batches))
            filesystem.move(attempt, name)
            return pa.RecordBatch.from_arrays([pa.array([1], pa.int64())], names=["files"])

        for batch in batches:
            ranks, files = batch.column("rank").to_pylist(), batch.column("file").to_pylist()
            lists = batch.column("ids")
            cuts = [k for k in range(1, len(ranks)) if (ranks[k], files[k]) != (ranks[k - 1], files[k - 1])]
            for start, end in zip([0, *cuts], [*cuts, len(ranks)]):
                if (ranks[start], files[start]) != key:
                    if key is not None:
                        yield finish()
                    key = (ranks[start], files[start])
                    filesystem.create_dir(posixpath.join(folder, f"rank={key[0]}"), recursive=True)
                    attempt = posixpath.join(folder, f"rank={key[0]}", f"_{file_name(key[1] * file_batches)}.{os.urandom(4).hex()}")
                    out = filesystem.open_output_stream(attempt)
                    writer = pa.ipc.new_file(out, schema)
                part = lists.slice(start, end - start)
                flat = part.flatten()
                if len(flat) != max_length * len(part):
                    raise ValueError(f"id lists must have {max_length} ids")
                part = pa.FixedSizeListArray.from_arrays(flat.cast(pa.int32()), max_length)
                held = part if held is None else pa.concat_arrays([held, part])
                full = len(held) // batch_size * batch_size
                for at in range(0, full, batch_size):
                    writer.write_batch(pa.RecordBatch.from_arrays([held.slice(at, batch_size)], schema=schema))
                held = held.slice(full)
        if key is not None:
            yield finish()

    numbered = rows.select("rank", F.floor(F.col(place) / F.lit(per_file)).alias("file"), F.col(place).alias("at"), F.col(ids).alias("ids"))
    placed = numbered.repartition("rank", "file").sortWithinPartitions("rank", "file", "at").select("rank", "file", "ids")
    return placed.mapInArrow(write, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


class BatchReader:
    """The batches of one rank. ``batch(k)`` reads one; iteration goes on from any place."""

    def __init__(self, target: str, rank: int, file_batches: int = FILE_BATCHES) -> None:
        self.folder = posixpath.join(target.removeprefix("file://").removeprefix("file:"), f"rank={rank}")
        self.file_batches = file_batches
        self._open: tuple[int, pa.ipc.RecordBatchFileReader] | None = None
        firsts = sorted(int(name[len("batches-"):-len(".arrow")]) for name in os.listdir(self.folder) if name.startswith("batches-"))
        if firsts != list(range(0, len(firsts) * file_batches, file_batches)):
            raise ValueError(f"files are missing in {self.folder}")
        self.n_batches = firsts[-1] + self._file(firsts[-1]).num_record_batches if firsts else 0

    def _file(self, first: int) -> pa.ipc.RecordBatchFileReader:
        if self._open is None or self._open[0] != first:
            self._open = (first, pa.ipc.open_file(pa.memory_map(posixpath.join(self.folder, file_name(first)))))
        return self._open[1]

    def batch(self, k: int) -> pa.RecordBatch:
        if not 0 <= k < self.n_batches:
            raise IndexError(f"batch {k} of {self.n_batches}")
        return self._file(k // self.file_batches * self.file_batches).get_batch(k % self.file_batches)

    def __len__(self) -> int:
        return self.n_batches

    def from_batch(self, k: int) -> Iterator[pa.RecordBatch]:
        """The batches from number ``k`` on: where a trainer that stopped goes on."""
        for at in range(k, self.n_batches):
            yield self.batch(at)


def read_batch_files(spark: SparkSession, target: str) -> DataFrame:
    """``(rank, batch_id, rows)`` of all files, for jobs that want the batches as a table."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rank, name = path.split("/")[-2:]
                first = int(name[len("batches-"):-len(".arrow")])
                file = pa.ipc.open_file(pa.BufferReader(content.as_buffer()))
                for k in range(file.num_record_batches):
                    rows = file.get_batch(k).column("input_ids").to_pylist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(rank[len("rank="):])], pa.int32()), pa.array([first + k], pa.int64()),
                         pa.array([rows], pa.list_(pa.list_(pa.int32())))], names=["rank", "batch_id", "rows"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "batches-*.arrow").option("recursiveFileLookup", "true")
             .load(target).select("path", "content"))
    return files.mapInArrow(read, "rank int, batch_id long, rows array<array<int>>")
