"""Alignment of the tokens of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes: a space and the text. A token overlaps those of the other side
that share a byte with it; groups are what overlaps hold together, and end where a token
of each side ends. Every token points to the farthest-right token that overlaps it (of two that
end together, to the one of the first tokenizer). Successors are doubled, all tokens at
once, until they stand still on the last token of each group, which labels the group.

Neither tokenizer has tokens that reach over a single space between other characters, so
words are aligned once and texts are put together from them; texts with other white space around
a space are aligned whole. Links are the pairs of tokens of both sides in one group.

The number of documents that hold a pair of ids is summed over blocks of documents. A block
keeps its distinct words with their pairs, and its documents as lists of words; the numbers of
documents of its distinct pairs come back to it by a join. No list of all links
is made, and no row per link leaves a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.distinct_words import coded_words, gather
from textloom.llm.tables import for_this_task, row_reader, small_batches, stored, text_slices
from textloom.llm.word_encoder import WordEncoder, vocabulary_bytes

SPACE = "▁"
NORMAL, BYTE = 1, 6
#: Bytes of text encoded at once, and words of documents in a block.
SLICE_BYTES = 1_000_000
BLOCK_WORDS = 400_000
#: Words whose alignment a worker keeps: at most so many, and none longer.
KEPT_WORDS = 120_000
LONGEST_KEPT = 100


# Two sides of a text ------------------------------------------------------------------

def piece_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a model file; raises if its pieces may reach over a space or texts are changed."""
    from sentencepiece import sentencepiece_model_pb2 as messages

    model = messages.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
        raise ValueError("only models that keep texts as they are, with a space put in front")
    normal = [p.piece for p in model.pieces if p.type == NORMAL]
    if any(SPACE in p.strip(SPACE) or (p.endswith(SPACE) and p.strip(SPACE)) for p in normal):
        raise ValueError("only models whose pieces do not reach over a space")
    return [bytes([int(p.piece[3:-1], 16)]) if p.type == BYTE else
            p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else b"" for p in model.pieces]


class Bytes:
    """Bytes of the ids of a vocabulary, as arrays."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.data, self.starts, self.sizes, ids.astype(np.int64))


def last_tokens(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The last token of each token's group, by pointer jumping.

    The arguments are the ends, ascending, of the tokens of both sides over the same bytes. Tokens are numbered
    first side first. A group that ends at a byte has there a token of each side, and the first's is its last.
    """
    n = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends, side="left")         # the token of the other side with the last byte
    over_b = np.searchsorted(a_ends, b_ends, side="left")
    successor = np.concatenate([np.where(b_ends[over_a] > a_ends, n + over_a, np.arange(n)), over_b])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor
        successor = further


@dataclass
class Aligned:
    """Texts or words, aligned: arrays with one entry for each, and the lists of their distinct pairs one after the other."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]           # a1,a2|b1;a3|b2,b3
    pairs: np.ndarray           # id of the first << 32 | id of the second
    uses: np.ndarray            # links of that pair
    n_pairs: np.ndarray

    @staticmethod
    def none(n: int = 0) -> Aligned:
        zeros = np.zeros(n, dtype=np.int64)
        return Aligned(zeros, zeros, zeros, zeros, [""] * n, np.zeros(0, np.uint64), np.zeros(0, np.int64), zeros)

    def __add__(self, other: Aligned) -> Aligned:
        return Aligned(*(x + y if isinstance(x, list) else np.concatenate([x, y])
                         for x, y in zip(vars(self).values(), vars(other).values())))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each is there."""
    ordered = np.sort(keys)
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(new)
    return ordered[at], np.diff(np.append(at, len(ordered)))


def distinct_in_groups(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups, ids and how often, of distinct pairs of a group and an id, in order."""
    keys, uses = distinct(group << 32 | ids.astype(np.int64))
    return keys >> 32, keys & 0xFFFFFFFF, uses


def align(a_ids: np.ndarray, a_sizes: np.ndarray, b_ids: np.ndarray, b_sizes: np.ndarray, a_bytes: Bytes, b_bytes: Bytes) -> Aligned:
    """Alignment of units whose ids follow one another; the bytes of both sides are equal in each."""
    n = len(a_sizes)
    if not len(a_ids):
        return Aligned.none(n)
    a_ends, b_ends = np.cumsum(a_bytes.sizes[a_ids]), np.cumsum(b_bytes.sizes[b_ids])
    last = last_tokens(a_ends, b_ends)
    closing = np.flatnonzero(last[:len(a_ids)] == np.arange(len(a_ids)))
    label = np.cumsum(np.bincount(closing, minlength=len(a_ids))) - 1       # of a token that closes a group
    a_group, b_group = label[last[:len(a_ids)]], label[last[len(a_ids):]]
    n_groups_all = len(closing)
    a_unit, b_unit = np.repeat(np.arange(n), a_sizes), np.repeat(np.arange(n), b_sizes)
    unit = a_unit[closing]
    in_a, in_b = np.bincount(a_group, minlength=n_groups_all), np.bincount(b_group, minlength=n_groups_all)

    # Distinct ids of each side in each group, then their products: few, however long a group is.
    ga, ia, ua = distinct_in_groups(a_group, a_ids)
    gb, ib, ub = distinct_in_groups(b_group, b_ids)
    b_first, b_count = np.searchsorted(gb, np.arange(n_groups_all)), np.bincount(gb, minlength=n_groups_all)
    each = b_count[ga]
    left = np.repeat(np.arange(len(ga)), each)
    right = np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each) + b_first[ga][left]
    pair = ia[left].astype(np.uint64) << np.uint64(32) | ib[right].astype(np.uint64)
    uses, of = ua[left] * ub[right], unit[ga[left]]
    order = np.lexsort((pair, of))
    pair, uses, of = pair[order], uses[order], of[order]
    new = np.ones(len(pair), dtype=bool)
    new[1:] = (pair[1:] != pair[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return Aligned(
        a_sizes, b_sizes, np.bincount(unit, minlength=n),
        np.bincount(unit, weights=in_a * in_b, minlength=n).astype(np.int64),
        group_texts(a_ids, b_ids, in_a, in_b, unit, n), pair[at], np.add.reduceat(uses, at),
        np.bincount(of[at], minlength=n))


def group_texts(a_ids: np.ndarray, b_ids: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, unit: np.ndarray, n: int) -> list[str]:
    """The groups of each unit written out."""
    def lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        numbers = pc.cast(pa.array(ids, pa.int64()), pa.string())
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, numbers), ",")

    written = pc.binary_join_element_wise(lists(a_ids, in_a), lists(b_ids, in_b), "|")
    offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(unit, minlength=n)))), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, written), ";").to_pylist()


class Aligner:
    """Alignments of texts by a byte-level tokenizer file and a piece model file."""

    def __init__(self, tokenizer_path: str, model_path: str, kept_words: int = KEPT_WORDS):
        import sentencepiece

        self.words = WordEncoder(tokenizer_path, names_are_text=True, kept_bytes=24_000_000)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.a_bytes, self.b_bytes = Bytes(vocabulary_bytes(tokenizer_path)), Bytes(piece_bytes(model_path))
        self.kept_words = kept_words
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.kept = Aligned.none()

    def units(self, a_ids: np.ndarray, a_sizes: np.ndarray, units: list[str]) -> Aligned:
        """Alignment of texts without the space in front; those whose bytes are not kept by both sides get no tokens."""
        lists = self.pieces.encode(units, num_threads=1)
        b_sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        b_ids = np.fromiter((k for own in lists for k in own), np.int64, int(b_sizes.sum()))
        a_ids = a_ids.astype(np.int64)
        spaced = [b" " + u.encode() for u in units]
        wanted = np.frombuffer(b"".join(spaced), np.uint8)
        if not all(np.array_equal(x, wanted) for x in (self.a_bytes.of(a_ids), self.b_bytes.of(b_ids))):
            same = [self.a_bytes.of(x).tobytes() == own == self.b_bytes.of(y).tobytes() for x, y, own in
                    zip(np.split(a_ids, np.cumsum(a_sizes)[:-1]), np.split(b_ids, np.cumsum(b_sizes)[:-1]), spaced)]
            same = np.array(same, dtype=bool)
            a_ids, b_ids = a_ids[np.repeat(same, a_sizes)], b_ids[np.repeat(same, b_sizes)]
            a_sizes, b_sizes = np.where(same, a_sizes, 0), np.where(same, b_sizes, 0)
        return align(a_ids, a_sizes, b_ids, b_sizes, self.a_bytes, self.b_bytes)

    def _word_units(self, words: list[str]) -> Aligned:
        return self.units(*self.words.word_ids(pa.array(words, pa.string()), " "), words)

    def texts(self, texts: pa.Array) -> tuple[Aligned, np.ndarray, np.ndarray]:
        """Units, offsets and units of each text: text ``i`` is made of ``units[index[offsets[i]:offsets[i + 1]]]``.

        Null and empty texts, and those with bytes that one side does not keep, are made of none.
        """
        offsets, index, words = coded_words(texts)
        odd = self.words.odd_words(words)
        listed = words.to_pylist()
        get = self.number.get
        numbers = np.fromiter((get(w, -1) for w in listed), np.int64, len(listed))
        missing = np.flatnonzero(numbers < 0).tolist()
        if len(self.number) + len(missing) > self.kept_words and self.number:
            self._forget()
            numbers[:] = -1
            missing = list(range(len(listed)))
        missing = [k for k in missing if not odd[k]]
        # The long ones last: they are not kept.
        missing.sort(key=lambda k: len(listed[k]) > LONGEST_KEPT)
        new = [listed[k] for k in missing]
        n_kept = sum(len(w) <= LONGEST_KEPT for w in new)
        first = len(self.number)
        units = self.kept + self._word_units(new) if new else self.kept
        numbers[missing] = np.arange(first, first + len(new))
        self.number.update(zip(new[:n_kept], range(first, first + n_kept)))
        if n_kept:
            total = int(units.n_pairs[:first + n_kept].sum())
            self.kept = Aligned(*(x[:total] if name in ("pairs", "uses") else x[:first + n_kept]
                                  for name, x in vars(units).items()))

        n = len(texts)
        irregular = np.logical_or.reduceat(odd[index], offsets[:-1])
        of_text = np.repeat(np.arange(n), np.diff(offsets))
        whole = [k for k in np.flatnonzero(irregular).tolist() if texts[k].as_py()]
        start = len(units.n_a)
        if whole:
            own = [texts[k].as_py() for k in whole]
            units = units + self.units(*self.words.whole([" " + t for t in own]), own)
        # A word of which a side does not keep the bytes spoils its text.
        found = np.where(irregular[of_text], -1, numbers[index])
        spoiled = np.zeros(n, dtype=bool)
        spoiled[of_text[(found >= 0) & (units.n_a[np.maximum(found, 0)] == 0)]] = True
        stays = (found >= 0) & ~spoiled[of_text]
        row = np.concatenate([of_text[stays], np.array(whole, dtype=np.int64)])
        used = np.concatenate([found[stays], np.arange(start, start + len(whole))])
        order = np.argsort(row, kind="stable")
        return units, np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))), used[order]


# Blocks ----------------------------------------------------------------------------

BLOCKS = ("block long, doc_ids array<long>, numbers binary, digests binary, n_words binary, words binary, times binary, "
          "n_pairs binary, pairs binary, uses binary, ids binary, docs binary")
_BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64()))] + [
    (c, pa.binary()) for c in ("numbers", "digests", "n_words", "words", "times", "n_pairs", "pairs", "uses", "ids", "docs")])


class Block:
    """Documents met so far, as distinct words of the block with their distinct pairs."""

    def __init__(self) -> None:
        self.slices: list[tuple] = []
        self.n_words = 0

    def add(self, doc_ids: pa.Array, units: Aligned, offsets: np.ndarray, used: np.ndarray) -> None:
        n = len(doc_ids)
        of_text = np.repeat(np.arange(n), np.diff(offsets))
        numbers = np.zeros((n, 4), dtype="<i8")
        for k, column in enumerate((units.n_a, units.n_b, units.n_groups, units.n_links)):
            numbers[:, k] = np.bincount(of_text, weights=column[used], minlength=n)
        texts = units.groups
        digests = b"".join(
            hashlib.sha256(";".join([texts[k] for k in used[a:b].tolist()]).encode()).digest() if a < b else bytes(32)
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
        # Distinct words of each document, then distinct words of the slice.
        words, _ = distinct(used)
        keys, times = distinct(of_text * max(1, len(words)) + np.searchsorted(words, used))
        doc, word = keys // max(1, len(words)), keys % max(1, len(words))
        starts = np.cumsum(units.n_pairs) - units.n_pairs
        pairs = gather(units.pairs, starts, units.n_pairs, words)
        uses = gather(units.uses, starts, units.n_pairs, words)
        n_pairs = units.n_pairs[words]
        # In how many documents of the slice each distinct pair is: their words' pairs, made distinct.
        ids, of_pair = np.unique(pairs, return_inverse=True)
        first = np.cumsum(n_pairs) - n_pairs
        held = gather(of_pair, first, n_pairs, word) + np.repeat(doc, n_pairs[word]) * max(1, len(ids))
        docs = np.bincount(distinct(held)[0] % max(1, len(ids)), minlength=len(ids))
        self.slices.append((doc_ids, numbers, digests, np.bincount(doc, minlength=n), word.astype("<i4"), times.astype("<i4"),
                            n_pairs.astype("<i4"), of_pair.astype("<i4"), uses, ids, docs))
        self.n_words += len(word)

    def row(self, block: int) -> pa.RecordBatch:
        """All slices as one row; words of different slices stay apart, pairs do not."""
        doc_ids, numbers, digests, n_words, words, times, n_pairs, of_pair, uses, ids, docs = zip(*self.slices)
        all_ids, place = np.unique(np.concatenate(ids), return_inverse=True)
        place = place.astype("<i4")
        self.slices.clear()
        first_id = np.cumsum([0, *map(len, ids)])
        first_word = np.cumsum([0, *map(len, n_pairs)])
        binaries = (
            np.concatenate(numbers).astype("<i8"), b"".join(digests), np.concatenate(n_words).astype("<i4"),
            np.concatenate([w + np.int32(first) for w, first in zip(words, first_word)]),
            np.concatenate(times), np.concatenate(n_pairs),
            np.concatenate([place[p + np.int32(first)] for p, first in zip(of_pair, first_id)]),
            _narrow(np.concatenate(uses)), all_ids.astype("<u8"),
            np.bincount(place, weights=np.concatenate(docs), minlength=len(all_ids)).astype("<i8"))
        own = pa.concat_arrays([d.cast(pa.int64()) for d in doc_ids])
        lists = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), lists,
             *(pa.array([b if isinstance(b, bytes) else b.tobytes()], pa.binary()) for b in binaries)], schema=_BLOCK_SCHEMA)


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """As 32-bit integers if they all are; their length in bytes tells."""
    return numbers.astype("<i4" if numbers.max(initial=0) < 1 << 31 else "<i8")


def aligned_blocks(docs: DataFrame, tokenizer_path: str, model_path: str, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs (doc_id, text)`` in blocks, one row each; only the task that reads a text ever sees it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number, part = Block(), 0, 0
        with for_this_task(lambda: Aligner(tokenizer_path, model_path)) as aligner:
            for rows in (rows for batch in batches for rows in text_slices(batch, size=SLICE_BYTES)):
                part = rows.column("part")[0].as_py()
                block.add(rows.column("doc_id"), *aligner.texts(rows.column("text")))
                pa.default_memory_pool().release_unused()
                if block.n_words >= block_words:
                    yield block.row(part << 32 | number)
                    block, number = Block(), number + 1
            if block.slices:
                yield block.row(part << 32 | number)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().alias("part"))
    return rows.mapInArrow(run, BLOCKS)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """``(block, place, a, b, docs)``: the distinct pairs of each block, and how many of its documents hold them."""
    schema = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, docs in zip(*(batch.column(c) for c in ("block", "ids", "docs"))):
                ids, docs = np.frombuffer(ids.as_buffer(), "<u8"), np.frombuffer(docs.as_buffer(), "<i8")
                for at in range(0, len(ids), 50_000):
                    own = ids[at:at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), block.as_py())), pa.array(np.arange(at, at + len(own)), pa.int32()),
                         pa.array((own >> np.uint64(32)).astype(np.int32)), pa.array((own & np.uint64(0xFFFFFFFF)).astype(np.int32)),
                         pa.array(docs[at:at + 50_000])], schema=schema)

    return blocks.select("block", "ids", "docs").mapInArrow(run, "block long, place int, a int, b int, docs long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``(a, b, n, best)``: in how many documents a pair is linked, and whether no pair of its first id is in more."""
    counts = stored(pairs.groupBy("a", "b").agg(F.sum("docs").alias("n")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _with_counts(key, blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """Results of the documents of one block, from the counts of its pairs."""
    row = {name: blocks.column(name)[0] for name in blocks.column_names}
    read = lambda name, kind: np.frombuffer(row[name].as_buffer(), kind)
    numbers = read("numbers", "<i8").reshape(-1, 4)
    n_docs = len(numbers)
    n = np.zeros(len(read("ids", "<u8")), dtype=np.int64)
    best = np.zeros(len(n), dtype=np.int64)
    if counts.num_rows:
        place = counts.column("place").to_numpy()
        n[place] = counts.column("n").to_numpy()
        best[place] = counts.column("best").to_numpy().astype(np.int64)
    pairs, n_pairs = read("pairs", "<i4"), read("n_pairs", "<i4")
    wide = row["uses"].as_buffer().size > 4 * len(pairs)
    uses = read("uses", "<i8" if wide else "<i4").astype(np.int64)
    of_word = np.repeat(np.arange(len(n_pairs)), n_pairs)
    word_best, word_sum = np.zeros(len(n_pairs), np.int64), np.zeros(len(n_pairs), np.int64)
    np.add.at(word_best, of_word, uses * best[pairs])
    np.add.at(word_sum, of_word, uses * n[pairs])
    words, times = read("words", "<i4"), read("times", "<i4").astype(np.int64)
    of_doc = np.repeat(np.arange(n_docs), read("n_words", "<i4"))
    n_best, count_sum = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
    np.add.at(n_best, of_doc, times * word_best[words])
    np.add.at(count_sum, of_doc, times * word_sum[words])
    digests = row["digests"].as_py().hex()
    hexes = [digests[64 * k:64 * k + 64] if a else "" for k, a in enumerate(numbers[:, 0].tolist())]
    return pa.table({"doc_id": row["doc_ids"].values, **{c: numbers[:, k] for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                     "n_best": n_best, "count_sum": count_sum, "groups_sha256": pa.array(hexes, pa.string())})


def align_documents(docs: DataFrame, tokenizer_path: str, model_path: str, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for each row of ``docs (doc_id, text)``.

    n_best: links whose pair is in as many documents as any pair of its first id; count_sum: these numbers of
    documents, summed over links; groups_sha256: checksum of the groups as :func:`group_texts` writes
    them. Texts that are null or empty, or whose bytes one side does not keep, have no tokens: zeros and the
    empty string. Every row is a document, also of a null or repeated id or an equal text. Other columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    with small_batches(spark, 2000):
        blocks = stored(aligned_blocks(docs, tokenizer_path, model_path, block_words), "aligned", compression="zstd")
    with small_batches(spark, 1), row_reader(spark):
        pairs = stored(block_pairs(blocks), "block-pairs")
    best = stored(pair_counts(pairs), "pair-best")
    counted = pairs.join(best, ["a", "b"]).select("block", "place", "n", "best")
    with row_reader(spark):
        return stored(blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_with_counts, RESULT), "alignments")


def aligned_groups(docs: DataFrame, tokenizer_path: str, model_path: str) -> DataFrame:
    """``(doc_id, groups)``: the groups of each document as a list of ``(a, b)``, the ids of both sides in order.

    Documents without tokens, as in :func:`align_documents`, have an empty list.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("written", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with for_this_task(lambda: Aligner(tokenizer_path, model_path)) as aligner:
            for rows in (rows for batch in batches for rows in text_slices(batch, size=SLICE_BYTES)):
                units, offsets, used = aligner.texts(rows.column("text"))
                written = [";".join([units.groups[k] for k in used[a:b].tolist()])
                           for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(written, pa.string())], schema=schema)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, written string")
    numbers = lambda side, k: F.split(F.split(side, "\\|")[k], ",").cast("array<int>")
    written = F.filter(F.split("written", ";"), lambda g: g != "")
    groups = F.transform(written, lambda g: F.struct(numbers(g, 0).alias("a"), numbers(g, 1).alias("b")))
    return found.select("doc_id", groups.alias("groups"))
