"""Shared scratch folder and reuse of finished results."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables, seen by all executors.

    It is the one named by ``spark.checkpoint.dir``. Only a local session may go
    without; it gets a temporary folder.
    """
    app_id = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or _local_roots.get(app_id)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = _local_roots[app_id] = tempfile.mkdtemp(prefix="textloom-")
    return f"{root.rstrip('/')}/textloom/{app_id}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read back, lineage cut."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table below the scratch folder: lineage cut, columns pruned when read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and directories in a directory; none if there is no such directory."""
    fs, target = _filesystem(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(target)) if fs.exists(target) else []


def files_state(spark: SparkSession, path: str) -> str:
    """Name, size and time of the file, or of the files in the directory, at ``path``."""
    fs, target = _filesystem(spark, path)
    return " ".join(sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(target)))


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a write to ``path`` has finished; a half-written folder has no marker."""
    fs, marker = _filesystem(spark, f"{path.rstrip('/')}/_SUCCESS")
    return fs.exists(marker)


def remove(spark: SparkSession, path: str, below: str | None = None) -> None:
    """Delete an intermediate table of this application, or one ``below`` a folder of the caller's."""
    if not path.startswith((below or scratch_root(spark)).rstrip("/") + "/"):
        raise ValueError(f"{path} is not below the folder")
    fs, target = _filesystem(spark, path)
    fs.delete(target, True)


# Results that know what they were made of ------------------------------------------------

MANIFEST = "_manifest.json"         # readers of tables pass over names with an underscore


def files_digest(spark: SparkSession, path: str) -> str:
    """A hash over names, sizes and times of all files at or below ``path``; marks and manifests left out."""
    fs, target = _filesystem(spark, path)
    if not fs.exists(target):
        return "none"
    found, files = [], fs.listFiles(target, True)
    while files.hasNext():
        status = files.next()
        if not status.getPath().getName().startswith(("_", ".")):
            found.append(f"{status.getPath()}:{status.getLen()}:{status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def file_states(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str]]:
    """Full name, and size with time, of all files at or below ``paths``; marks left out."""
    found = []
    for path in paths:
        fs, target = _filesystem(spark, path)
        if fs.exists(target):
            files = fs.listFiles(target, True)
            while files.hasNext():
                status = files.next()
                if not status.getPath().getName().startswith(("_", ".")):
                    found.append((str(status.getPath().toString()), f"{status.getLen()}:{status.getModificationTime()}"))
    return sorted(found)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _filesystem(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _filesystem(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def manifest(spark: SparkSession, inputs: Sequence[str] = (), upstream: Sequence[str] = (), **parameters) -> dict:
    """What a result depends on: files of the inputs as they are now, manifests of earlier results, and settings."""
    earlier = {path: hashlib.sha256((_read_text(spark, f"{path.rstrip('/')}/{MANIFEST}") or files_digest(spark, path)).encode()).hexdigest()
               for path in upstream}
    made_of = {"inputs": {path: files_digest(spark, path) for path in inputs}, "upstream": earlier, "parameters": parameters}
    return json.loads(json.dumps(made_of, sort_keys=True, default=str))


def is_current(spark: SparkSession, path: str, wanted: dict | None, marker: str = "_SUCCESS") -> bool:
    """True if the result at ``path`` is finished and was made of what ``wanted`` says; without it, if it is finished.

    ``marker`` is the file that is there once the data are.
    """
    fs, done = _filesystem(spark, f"{path.rstrip('/')}/{marker}")
    if not fs.exists(done):
        return False
    if wanted is None:
        return True
    kept = _read_text(spark, f"{path.rstrip('/')}/{MANIFEST}")
    return kept is not None and json.loads(kept) == wanted


def record(spark: SparkSession, path: str, wanted: dict | None) -> None:
    """Put the manifest of a finished result next to its data: from then on it counts as current."""
    if wanted is not None:
        _write_text(spark, f"{path.rstrip('/')}/{MANIFEST}", json.dumps(wanted, sort_keys=True, indent=1))


def withdraw(spark: SparkSession, path: str) -> None:
    """Take a result's manifest away, before parts of it are written anew."""
    fs, target = _filesystem(spark, f"{path.rstrip('/')}/{MANIFEST}")
    fs.delete(target, False)


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame], wanted: dict | None = None) -> DataFrame:
    """The table at ``path``; built and written first if it is not finished, or was made of something else than ``wanted``.

    The manifest is written last: a run that stops before leaves a result that is built again.
    """
    if not is_current(spark, path, wanted):
        build().write.mode("overwrite").parquet(path)
        record(spark, path, wanted)
    return spark.read.parquet(path)
