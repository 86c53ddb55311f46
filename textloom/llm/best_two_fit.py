"""Packing token sequences by best-two-fit, over counts of lengths.

A sequence is filled greedily: the longest document left opens it, and the longest that
fits is added until none does. Then its smallest document is given back if two documents that are
left fill the expanded gap more tightly: the two of largest sum.

Only lengths matter for that, and there are at most ``capacity`` of them. Documents are counted by
length, and the same choice is made as often at once as the counts allow, so the plan is a
short list of fillings with how often each is used, the same as one sequence
after the other gives. Each filling takes a run of the documents of each of its lengths; a document
finds its sequence and place from its number among those of its length. Documents
are numbered where they are encoded, and no ids are moved for the plan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.tables import for_this_task, small_batches, stored, text_slices
from textloom.llm.word_encoder import WordEncoder

CAPACITY = 1024
END_ID = 2
#: Bytes of text encoded at once.
SLICE_BYTES = 8_000_000


# Pieces ----------------------------------------------------------------------------

PIECES = "doc_id long, piece int, start long, length int, ids binary, part int, number long"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``docs (doc_id, text)`` as pieces of at most ``capacity`` ids, written to the shared folder.

    Only documents of more ids are cut; then all pieces but the first are full. ``ids`` are little-endian unsigned
    32-bit integers. ``number`` counts the pieces of one length within ``part``, the task that made
    them. Null and empty texts have the end id only. Every row is a document, also of null or repeated ids;
    other columns are ignored; an empty table has no pieces.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
                        ("ids", pa.binary()), ("part", pa.int32()), ("number", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, dtype=np.int64)
        with for_this_task(lambda: WordEncoder(tokenizer_path)) as encoder:
            for batch in batches:
                for rows in text_slices(batch, size=SLICE_BYTES):
                    ids, sizes = encoder.encode(rows.column("text"))
                    yield cut(rows, np.insert(ids, np.cumsum(sizes), end_id), sizes + 1, seen)

    def cut(rows: pa.RecordBatch, ids: np.ndarray, sizes: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        count = -(-sizes // capacity)
        row = np.repeat(np.arange(len(sizes)), count)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        first = sizes - (count - 1) * capacity
        length = np.where(piece == 0, first[row], capacity)
        start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
        # The numbers go on from batch to batch, in the order of the rows.
        order = np.argsort(length, kind="stable")
        in_order = length[order]
        number = np.empty(len(length), dtype=np.int64)
        number[order] = np.arange(len(length)) - np.searchsorted(in_order, in_order) + seen[in_order]
        seen += np.bincount(length, minlength=len(seen))
        ends = np.concatenate(([0], np.cumsum(length))) * 4
        data = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(ends.astype(np.int64)),
                                                                     pa.py_buffer(ids.astype("<u4"))])
        index = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id").take(index), pa.array(piece, pa.int32()), pa.array(start), pa.array(length, pa.int32()),
             data.cast(pa.binary()), rows.column("part").take(index), pa.array(number)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("part"))
    with small_batches(docs.sparkSession, 2000):
        return stored(rows.mapInArrow(run, PIECES), "pieces", compression="zstd")


# Plan ------------------------------------------------------------------------------

@dataclass
class Filling:
    """A sequence's lengths and how many documents of each, longest first, and how often it is used."""

    lengths: list[int]
    counts: list[int]
    times: int


def _longest_up_to(free: np.ndarray) -> np.ndarray:
    """For each size, the longest length up to it of which documents are left; 0 if there is none."""
    return np.maximum.accumulate(np.where(free > 0, np.arange(len(free)), 0))


def fill_one(left: np.ndarray, capacity: int) -> tuple[dict[int, int], dict[int, int]]:
    """Lengths of the next sequence with their counts, and the most documents of each held while it was filled."""
    free = left.copy()
    held: dict[int, int] = {}
    most: dict[int, int] = {}

    def take(length: int, n: int) -> None:
        held[length] = held.get(length, 0) + n
        most[length] = max(most.get(length, 0), held[length])
        free[length] -= n

    longest = int(np.flatnonzero(free)[-1])
    take(longest, 1)
    gap, docs = capacity - longest, 1
    while gap:
        fitting = np.flatnonzero(free[:gap + 1])
        if not len(fitting):
            break
        length = int(fitting[-1])
        n = min(int(free[length]), gap // length)
        take(length, n)
        gap, docs = gap - n * length, docs + n
    while gap and docs > 1:
        smallest = min(length for length, n in held.items() if n)
        room = gap + smallest
        a = np.flatnonzero(free[:room + 1])
        longest_to = _longest_up_to(free[:room + 1])
        b = longest_to[np.minimum(a, room - a)]
        # The second one must be another document.
        b = np.where((b == a) & (free[a] < 2), longest_to[np.maximum(a - 1, 0)], b)
        sums = np.where(b > 0, a + b, 0)
        if not len(a) or sums.max() <= smallest:
            break
        best = int(np.flatnonzero(sums == sums.max())[-1])
        held[smallest] -= 1
        free[smallest] += 1
        take(int(a[best]), 1)
        take(int(b[best]), 1)
        gap, docs = room - int(sums[best]), docs + 1
    return {length: n for length, n in held.items() if n}, most


def plan_fillings(counts: np.ndarray, capacity: int) -> list[Filling]:
    """Fillings that use up ``counts`` documents of each length (index: the length, 0 unused).

    A filling is repeated as long as the same documents are there to choose from: what was chosen is left, and
    what was not there does not come back.
    """
    left = np.array(counts, dtype=np.int64)
    left[0] = 0
    plan = []
    while left.any():
        need, most = fill_one(left, capacity)
        times = min((int(left[length]) - most[length]) // n + 1 for length, n in need.items())
        for length, n in need.items():
            left[length] -= n * times
        lengths = sorted(need, reverse=True)
        plan.append(Filling(lengths, [need[length] for length in lengths], times))
    return plan


@dataclass
class Runs:
    """Which documents of a length a filling takes: arrays sorted by length and first number."""

    key: np.ndarray             # length << 48 | number of the first document
    first: np.ndarray
    sequence: np.ndarray        # of the first document
    each: np.ndarray            # documents of this length in one sequence
    offset: np.ndarray          # of the first of them


def document_runs(plan: list[Filling]) -> Runs:
    rows, used, sequence = [], {}, 0
    for filling in plan:
        offset = 0
        for length, n in zip(filling.lengths, filling.counts):
            first = used.get(length, 0)
            rows.append((length << 48 | first, first, sequence, n, offset))
            used[length] = first + n * filling.times
            offset += length * n
        sequence += filling.times
    rows.sort()
    return Runs(*np.array(rows, dtype=np.int64).reshape(-1, 5).T.copy())


# Places ----------------------------------------------------------------------------

def placed(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` with ``sequence_id`` and ``offset``; of :func:`pieces`, any other columns may be there.

    The driver gets one count for each length, ``capacity`` at most. The plan sent to tasks has one row for each
    filling and length.
    """
    per_part = stored(found.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    runs = document_runs(plan_fillings(counts, capacity))

    # One row for each task that encoded documents, for each length.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select(F.col("part").alias("of_part"), F.col("length").alias("of_length"),
                             F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = (found.join(before, (F.col("part") == F.col("of_part")) & (F.col("length") == F.col("of_length")))
                .withColumn("number", F.col("number") + F.col("before")).drop("of_part", "of_length", "before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "number"))
            k = np.searchsorted(runs.key, length << 48 | number, side="right") - 1
            within = number - runs.first[k]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(runs.sequence[k] + within // runs.each[k]),
                 pa.array(runs.offset[k] + within % runs.each[k] * length)],
                names=[*batch.schema.names, "sequence_id", "offset"])

    return numbered.mapInArrow(run, f"{', '.join(f'`{n}` {t}' for n, t in numbered.dtypes)}, sequence_id long, offset long")


def sequences(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(sequence_id, n_ids, ids, docs)``: the packed sequences, with the pieces in each in order.

    ``docs`` has ``(offset, doc_id, piece, length)``. A sequence has at most ``capacity`` pieces.
    """
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    grouped = placed(found, capacity).groupBy("sequence_id").agg(inside.alias("inside"))
    joined = F.aggregate("inside", F.lit(b"").cast("binary"), lambda data, d: F.concat(data, d["ids"]))
    return grouped.select(
        "sequence_id", F.aggregate("inside", F.lit(0), lambda n, d: n + d["length"]).alias("n_ids"), joined.alias("ids"),
        F.transform("inside", lambda d: F.struct(d["offset"], d["doc_id"], d["piece"], d["length"])).alias("docs"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids, sequence_id, offset)``: the pieces of all documents and their places.

    The pieces of a sequence follow each other without gaps from offset 0. Nulls, repeats and empty
    tables: see :func:`pieces`.
    """
    return placed(pieces(docs, tokenizer_path, capacity, end_id), capacity).drop("part", "number")


def places(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """As :func:`pack`, with ``ids_crc32``, the unsigned checksum of the ids, instead of the ids, which then stay where they are."""
    found = pieces(docs, tokenizer_path, capacity, end_id)
    return placed(found.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity).drop("part", "number")
