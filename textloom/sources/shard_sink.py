"""A sink that names shards ``{split}/{split}_shard_{i}.parquet``, written in two phases.

Spark's own writers choose their file names. This one is a Python data source: each task writes the shards it has to
attempt files in a folder aside, and only when all tasks are done does the driver rename them, so a reader sees the
names of finished shards only, and each once, whatever tasks failed or ran twice::

    register(spark)
    named_shards(df).write.format("named_shards").mode("overwrite").save(root)

The folder must be one that all executors reach by a file, hdfs, s3 or gs URI.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from textloom.sources.tables import SHARD, SPLIT

FORMAT = "named_shards"
_ASIDE = "_attempts"
_DONE = "_SUCCESS"


def shard_name(split: str, shard: int) -> str:
    return f"{split}/{split}_shard_{shard}.parquet"


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class ShardsWritten(WriterCommitMessage):
    """Attempt files of one task, and the names they are to have."""

    files: list[tuple[str, str]]


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool) -> None:
        self.path = path
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def _aside(self, folder: str) -> str:
        return posixpath.join(folder, _ASIDE, self.job)

    def write(self, iterator: Iterator) -> ShardsWritten:
        """Rows of one task; those of a shard follow one another."""
        import numpy as np
        import pyarrow.parquet as pq

        filesystem, folder = _filesystem(self.path)
        aside = self._aside(folder)
        written: list[tuple[str, str]] = []
        open_key, writer = None, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                splits, shards = batch.column(SPLIT).to_pylist(), batch.column(SHARD).to_numpy(zero_copy_only=False)
                changed = [k for k in range(1, len(splits)) if splits[k] != splits[k - 1] or shards[k] != shards[k - 1]]
                kept = [name for name in batch.schema.names if name not in (SPLIT, SHARD)]
                for start, end in zip([0, *changed], [*changed, len(splits)]):
                    key = (splits[start], int(np.int64(shards[start])))
                    part = batch.slice(start, end - start).select(kept)
                    if key != open_key:
                        if writer is not None:
                            writer.close()
                        name = shard_name(*key)
                        if name in (done for _, done in written):
                            raise ValueError(f"the rows of {name} do not follow one another")
                        filesystem.create_dir(aside, recursive=True)
                        attempt = posixpath.join(aside, f"{uuid.uuid4().hex}.parquet")
                        written.append((attempt, name))
                        writer = pq.ParquetWriter(attempt, part.schema, filesystem=filesystem)
                        open_key = key
                    writer.write_batch(part)
            if writer is not None:
                writer.close()
        except BaseException:
            for attempt, _ in written:
                _remove(filesystem, attempt)
            raise
        return ShardsWritten(written)

    def commit(self, messages: list[ShardsWritten | None]) -> None:
        """Give all shards their names; without ``overwrite`` none may be there yet."""
        filesystem, folder = _filesystem(self.path)
        files = [pair for message in messages if message is not None for pair in message.files]
        names = [name for _, name in files]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("a shard was written by two tasks: bring its rows together, as named_shards does")
        before = _shards_in(filesystem, folder)
        if not self.overwrite and set(names) & before:
            self.abort(messages)
            raise FileExistsError(f"{sorted(set(names) & before)[0]} is there already")
        _remove(filesystem, posixpath.join(folder, _DONE))
        if self.overwrite:
            for name in before - set(names):
                _remove(filesystem, posixpath.join(folder, name))
        for split in {posixpath.dirname(name) for name in names}:
            filesystem.create_dir(posixpath.join(folder, split), recursive=True)
        for attempt, name in files:
            if name in before:
                _remove(filesystem, posixpath.join(folder, name))
            filesystem.move(attempt, posixpath.join(folder, name))
        self._clean(filesystem, folder)
        filesystem.create_dir(folder, recursive=True)
        filesystem.open_output_stream(posixpath.join(folder, _DONE)).close()

    def abort(self, messages: list[ShardsWritten | None]) -> None:
        """Remove what the attempts of this job have left; finished shards of earlier jobs stay."""
        self._clean(*_filesystem(self.path))

    def _clean(self, filesystem, folder: str) -> None:
        from pyarrow import fs

        if filesystem.get_file_info(self._aside(folder)).type == fs.FileType.Directory:
            filesystem.delete_dir(self._aside(folder))
        top = posixpath.join(folder, _ASIDE)
        if (filesystem.get_file_info(top).type == fs.FileType.Directory
                and not filesystem.get_file_info(fs.FileSelector(top))):
            filesystem.delete_dir(top)


def _remove(filesystem, name: str) -> None:
    from pyarrow import fs

    if filesystem.get_file_info(name).type == fs.FileType.File:
        filesystem.delete_file(name)


def _shards_in(filesystem, folder: str) -> set[str]:
    """Names of the shards below a folder, ``{split}/{split}_shard_{i}.parquet``."""
    from pyarrow import fs

    if filesystem.get_file_info(folder).type != fs.FileType.Directory:
        return set()
    found = set()
    for entry in filesystem.get_file_info(fs.FileSelector(folder)):
        if entry.type == fs.FileType.Directory and entry.base_name != _ASIDE:
            found |= {f"{entry.base_name}/{file.base_name}" for file in filesystem.get_file_info(fs.FileSelector(entry.path))
                      if file.base_name.startswith(f"{entry.base_name}_shard_")}
    return found


class NamedShards(DataSource):
    """Write only; any reader of Parquet reads the result."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ""

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        missing = {SPLIT, SHARD} - set(schema.fieldNames())
        if missing:
            raise ValueError(f"no column {sorted(missing)}")
        return ShardWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NamedShards)


def named_shards(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """``df`` with the rows of each shard in one task, one after the other, in ``order``: what the sink asks for.

    A shard has a bounded number of rows, and so has a task. One shuffle.
    """
    return df.repartition(SPLIT, SHARD).sortWithinPartitions(SPLIT, SHARD, *order)


def write_named_shards(df: DataFrame, root: str, order: Sequence[str] = (), overwrite: bool = True) -> None:
    """Write ``df``, with the columns ``split`` and ``shard_id``, as ``{split}/{split}_shard_{i}.parquet`` below ``root``."""
    register(df.sparkSession)
    named_shards(df, order).write.format(FORMAT).mode("overwrite" if overwrite else "append").save(root)
