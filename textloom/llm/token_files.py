"""Token ids in binary files: frequency-ranked, byte-aligned codes with control bytes apart.

Ids are replaced by their rank of frequency, so frequent ones are small. A rank takes one to four bytes;
its length is a 2-bit field in a separate stream of control bytes, four ranks a byte.
Decoding looks up each control byte in a table that says how long its four codes are.

A file holds a run of documents in ascending order of id; files are numbered in that
order too, and the ids by rank are in a file of their own, so the folder can be read by whoever has it::

    magic 8 bytes | documents, ids, ids in earlier files, control bytes, data bytes: 5 x uint64
    doc_id int64 x documents (null: the smallest int64) | n_tokens int64 x documents | control | data

    ranks.bin: magic 8 bytes | ids uint64 | id uint32 x ids, most frequent first
"""

from __future__ import annotations

import itertools
import os
import posixpath
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.tables import cores, for_this_task, small_batches, stored, text_slices
from textloom.llm.word_encoder import WordEncoder
from textloom.sources import workspace

MAGIC = b"TLTOKEN1"
HEADER = "<8s5Q"
END_ID = 0
#: Ids in a block: the unit of a file, of memory and of recovery.
BLOCK_IDS = 3_000_000
#: Bytes of text in a range of ids, one task; tasks get larger, not more, beyond the largest number of ranges.
BYTES_PER_TASK = 64_000_000
MOST_PARTS = 100_000
NULL_ID = -(1 << 63)
#: The table of ids by rank, written before any data file, and the mark of a finished folder, written after all.
RANKS_FILE, DONE_FILE = "ranks.bin", "_SUCCESS"


# Codes ---------------------------------------------------------------------------

def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned ranks below 2^32."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    fields = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    fields[:len(ranks)] = extra
    fields = fields.reshape(-1, 4)
    control = fields[:, 0] | fields[:, 1] << 2 | fields[:, 2] << 4 | fields[:, 3] << 6
    sizes = extra + np.uint8(1)
    first = np.cumsum(sizes, dtype=np.int64) - sizes
    source = ranks.view(np.uint8).reshape(-1, 4)
    data = np.zeros(int(sizes.sum(dtype=np.int64)), dtype=np.uint8)
    data[first] = source[:, 0]
    for byte in range(1, int(extra.max(initial=0)) + 1):
        longer = np.flatnonzero(extra >= byte)
        data[first[longer] + byte] = source[longer, byte]
    return control.tobytes(), data.tobytes()


_FIELDS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])[None, :]) & 3).astype(np.uint8)


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of :func:`encode_ranks`."""
    extra = _FIELDS[np.frombuffer(control, dtype=np.uint8)].ravel()[:n]
    source = np.frombuffer(data, dtype=np.uint8)
    sizes = extra + np.uint8(1)
    first = np.cumsum(sizes, dtype=np.int64) - sizes
    ranks = source[first].astype(np.uint32) if n else np.zeros(0, dtype=np.uint32)
    for byte in range(1, int(extra.max(initial=0)) + 1):
        longer = np.flatnonzero(extra >= byte)
        ranks[longer] |= source[first[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


# Blocks ----------------------------------------------------------------------------

BLOCKS = ("part int, block int, inside long, n_ids long, doc_ids binary, sizes binary, ids binary, used binary, uses binary")


def token_blocks(docs: DataFrame, tokenizer_path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encoded documents in ascending order of id, in blocks numbered within range parts.

    Texts are shuffled by ranges of id and sorted; equal ids are ordered by a hash of their text and
    their text, so an id of many texts has many ranges too, and equal rows may stand in any order.
    A task run again makes the same blocks. One block at a time is held.
    """
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("inside", pa.int64()), ("n_ids", pa.int64()),
                        ("doc_ids", pa.binary()),
                        ("sizes", pa.binary()), ("ids", pa.binary()), ("used", pa.binary()), ("uses", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with for_this_task(lambda: WordEncoder(tokenizer_path)) as encoder:
            yield from encoded_blocks(encoder, batches)

    def encoded_blocks(encoder: WordEncoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, part, inside, held, n_held = 0, 0, 0, [], 0

        def flush() -> pa.RecordBatch:
            doc_ids, sizes, ids = (np.concatenate(c) for c in zip(*held))
            narrow = ids.astype("<u2") if ids.max(initial=0) < 1 << 16 else ids.astype("<u4")
            uses = np.bincount(ids)
            used = np.flatnonzero(uses)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([inside], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([doc_ids.tobytes()]), pa.array([sizes.tobytes()]),
                 pa.array([narrow.tobytes()]), pa.array([used.astype("<u4").tobytes()]),
                 pa.array([uses[used].astype("<u4").tobytes()])], schema=schema)

        for batch in batches:
            for piece in text_slices(batch, rows=1000, size=min(4_000_000, 4 * block_ids)):
                part = piece.column("part")[0].as_py()
                ids, sizes = encoder.encode(piece.column("text"))
                ends = np.cumsum(sizes)
                with_end = np.insert(ids, ends, END_ID)
                doc_ids = piece.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                held.append((doc_ids, sizes + 1, with_end))
                n_held += len(with_end)
                if n_held >= block_ids:
                    yield flush()
                    number, inside, held, n_held = number + 1, inside + n_held, [], 0
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(max(cores(docs.sparkSession), -(-size // BYTES_PER_TASK)), MOST_PARTS)
    keyed = rows.withColumns({"text_hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = (keyed.repartitionByRange(parts, "doc_id", "text_hash", "row").sortWithinPartitions("doc_id", "text_hash", "text")
               .select("doc_id", "text", F.spark_partition_id().alias("part")))
    return ordered.mapInArrow(run, BLOCKS)


def _block_ids(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * n else "<u4").astype(np.uint32)


def ranked_ids(blocks: DataFrame) -> np.ndarray:
    """The ids of the corpus, most frequent first; at most the size of the vocabulary.

    Every block has the counts of its ids, so no ids are read again.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for used, uses in zip(batch.column("used"), batch.column("uses")):
                used, uses = (np.frombuffer(b.as_py(), "<u4") for b in (used, uses))
                if len(used):
                    total = np.pad(total, (0, max(0, int(used[-1]) + 1 - len(total))))
                    total[used] += uses
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())],
                                         names=["id", "n"])

    counts = (blocks.select("used", "uses").mapInArrow(count, "id long, n long").groupBy("id")
              .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id"))
    return np.array([row["id"] for row in counts.select("id").collect()], dtype=np.uint32)


def _shared_filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _write_file(filesystem, name: str, parts: list) -> None:
    """A file under another name, then renamed: there is a whole one or none."""
    attempt = f"{name}.{os.getpid()}-{os.urandom(4).hex()}"
    with filesystem.open_output_stream(attempt) as out:
        for part in parts:
            out.write(part)
    filesystem.move(attempt, name)


def write_files(blocks: DataFrame, ranked: np.ndarray, path: str) -> int:
    """The ids by rank, one file for each block, and the mark that all are there; returns the number of files.

    A file is written under another name and renamed, and its name and content follow from
    the block: a task run again or twice leaves the same file. ``path`` is a folder all
    executors reach by a file, hdfs, s3 or gs URI.
    """
    # One row for each range, MOST_PARTS at most: small enough for one task, and to be broadcast.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before_part = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_part"))
    placed = (blocks.select("part", "block", "inside", "n_ids", "doc_ids", "sizes", "ids")
              .join(F.broadcast(before_part), "part")
              .withColumn("before", F.col("before_part") + F.col("inside")).drop("before_part", "inside"))
    rank = np.zeros(int(ranked.max(initial=0)) + 1, dtype=np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, folder = _shared_filesystem(path)
        filesystem.create_dir(folder, recursive=True)
        for batch in batches:
            for row in (dict(zip(batch.schema.names, values)) for values in zip(*batch.columns)):
                row = {name: value.as_py() for name, value in row.items()}
                control, data = encode_ranks(rank[_block_ids(row["ids"], row["n_ids"])])
                n_docs = len(row["doc_ids"]) // 8
                head = struct.pack(HEADER, MAGIC, n_docs, row["n_ids"], row["before"], len(control), len(data))
                name = posixpath.join(folder, f"tokens-{row['part']:06d}-{row['block']:06d}.bin")
                _write_file(filesystem, name, [head, row["doc_ids"], row["sizes"], control, data])
                yield pa.RecordBatch.from_arrays([pa.array([1], pa.int64())], names=["files"])

    filesystem, folder = _shared_filesystem(path)
    filesystem.create_dir(folder, recursive=True)
    _write_file(filesystem, posixpath.join(folder, RANKS_FILE), [struct.pack("<8sQ", MAGIC, len(ranked)), ranked.astype("<u4").tobytes()])
    done = placed.mapInArrow(write, "files long")
    with small_batches(blocks.sparkSession, 1):
        n_files = done.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
    _write_file(filesystem, posixpath.join(folder, DONE_FILE), [])
    return n_files


def read_ranks(spark: SparkSession, path: str) -> np.ndarray:
    """The ids by rank of a finished folder: at most as many as the vocabulary has."""
    if not workspace.is_complete(spark, path):
        raise ValueError(f"{path} is not a finished folder of token files")
    content = spark.read.format("binaryFile").load(f"{path.rstrip('/')}/{RANKS_FILE}").select("content").first()[0]
    magic, n = struct.unpack_from("<8sQ", content)
    if magic != MAGIC or len(content) != 16 + 4 * n:
        raise ValueError("not a whole file of ranks")
    return np.frombuffer(content, "<u4", n, 16)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files of a finished folder alone."""
    ranked = read_ranks(spark, path)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])
    id_of = ranked.astype("<u4")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for content in itertools.chain.from_iterable(batch.column("content") for batch in batches):
            doc_ids, start, sizes, ids = parse(memoryview(content.as_buffer()), id_of)
            ends = np.cumsum(sizes)
            raw = memoryview(ids.tobytes())
            sums = [zlib.crc32(raw[4 * (e - s):4 * e]) for e, s in zip(ends.tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, mask=doc_ids == NULL_ID), pa.array(start + ends - sizes), pa.array(sizes),
                 pa.array(sums, pa.int64())], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "tokens-*.bin").load(path)
    return files.select("content").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def parse(content: memoryview, id_of: np.ndarray) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """Document ids, ids in earlier files, numbers of ids and the ids of one file."""
    magic, n_docs, n_ids, before, n_control, n_data = struct.unpack_from(HEADER, content)
    if magic != MAGIC or len(content) != struct.calcsize(HEADER) + 16 * n_docs + n_control + n_data:
        raise ValueError("not a whole token file")
    at = struct.calcsize(HEADER)
    doc_ids = np.frombuffer(content, "<i8", n_docs, at)
    sizes = np.frombuffer(content, "<i8", n_docs, at + 8 * n_docs)
    control = content[at + 16 * n_docs:at + 16 * n_docs + n_control]
    data = content[at + 16 * n_docs + n_control:]
    return doc_ids, before, sizes, id_of[decode_ranks(control, data, n_ids)]


def write_documents(docs: DataFrame, tokenizer_path: str, path: str, block_ids: int = BLOCK_IDS) -> int:
    """Encode and write ``docs (doc_id, text)``; returns the number of data files.

    Every row is a document, in ascending order of id: null ids first, rows of one id by
    a hash of their text, then their text. Null and empty texts have the end id only. Other columns are ignored; an
    empty table writes no data file, and the folder reads as an empty table.
    """
    with small_batches(docs.sparkSession, 2000):
        blocks = stored(token_blocks(docs, tokenizer_path, block_ids), "blocks", compression="zstd")
    return write_files(blocks, ranked_ids(blocks), path)
