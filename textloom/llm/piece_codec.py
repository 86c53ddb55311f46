"""SentencePiece encoding and decoding with an Aho-Corasick automaton and one pass per word.

The automaton finds all pieces of the model; at each position its output links give
the pieces that end there. The pass keeps one state per position, the last piece of the best
encoding of the text so far, and relaxes it over these pieces. In a model of the BPE
kind, scores say which merge comes first, and they do not add up; there, exactly one of the
pieces that end at a position extends the encoding before it in the way the merges go.
It is the one whose seam with the piece before no merge would have crossed, which is decided from the
ranks of the merges inside the two pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textloom.llm.distinct_words import batch_words, gather
from textloom.llm.tables import for_this_task, text_slices

SPACE = "▁"
NORMAL, BYTE = 1, 6
KEPT_WORDS = 300_000
KEPT_SEAMS = 500_000
_EDGE = -1


class PieceModel:
    """Pieces, merge ranks and the automaton of a model file of the BPE kind with byte pieces."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as messages

        model = messages.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only models that keep texts as they are, with a space put in front")
        self.ids = {p.piece: k for k, p in enumerate(model.pieces) if p.type == NORMAL}
        if any(SPACE in p.strip(SPACE) or (p.endswith(SPACE) and p.strip(SPACE)) for p in self.ids):
            raise ValueError("only models whose pieces do not reach over a space")
        self.text = [p.piece for p in model.pieces]
        self.rank = [-p.score for p in model.pieces]
        self.byte_ids = [0] * 256
        for k, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:-1], 16)] = k
        self.known = {p for p in self.ids if len(p) == 1}
        self.bytes_of = [bytes([self.byte_ids.index(k)]) if p.type == BYTE else
                         p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else b""
                         for k, p in enumerate(model.pieces)]

        self.parts: list[tuple[int, int] | None] = [None] * len(self.text)
        self.born = [-1.0] * len(self.text)
        self.automaton = ahocorasick.Automaton()
        for piece, k in self.ids.items():
            ids, last = self.merge(piece)
            if ids == [k]:
                self.parts[k] = last
                self.born[k] = self.rank[k] if last else -1.0
                self.automaton.add_word(piece, (len(piece), k))
        self.automaton.make_automaton()
        self.seams: dict[int, bool] = {}
        self.kept: dict[str, bytes] = {}

    def merge(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """Plain merging of known characters, best score first, then leftmost; and the last merge made."""
        ids = [self.ids.get(c, _EDGE) for c in text]
        if _EDGE in ids:
            return [], None
        n = len(ids)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue: list[tuple[float, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                joined = self.ids.get(self.text[ids[i]] + self.text[ids[j]])
                if joined is not None:
                    heapq.heappush(queue, (self.rank[joined], i, joined, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        last = None
        while queue:
            _, i, joined, a, b = heapq.heappop(queue)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            last = (a, b)
            ids[i], ids[j] = joined, _EDGE
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [k for k in ids if k != _EDGE], last

    def seam_holds(self, a: int, b: int) -> bool:
        """True if merging the text of ``a`` and ``b`` ends with just these two pieces.

        The merges inside the two are undone from the last to the first. Whenever the pieces at the seam
        could be merged before the merge undone last, the seam would have been crossed. Of
        equal ranks the left one comes first.
        """
        limit, at_limit = float("inf"), False
        x, y = a, b
        while True:
            joined = self.ids.get(self.text[x] + self.text[y])
            if joined is not None:
                rank = self.rank[joined]
                if rank < limit or (at_limit and rank == limit):
                    return False
            if self.born[x] > self.born[y]:
                limit, at_limit = self.born[x], False
                x = self.parts[x][1]
            elif self.parts[y] is not None:
                limit, at_limit = self.born[y], True
                y = self.parts[y][0]
            else:
                return True

    def encode_known(self, text: str) -> list[int]:
        """Ids of a run of known characters: one pass over the automaton's matches."""
        n = len(text)
        last: list[int | None] = [None] * (n + 1)
        back = [0] * (n + 1)
        last[0] = _EDGE
        seams = self.seams
        for end, (length, k) in self.automaton.iter(text):
            if last[end + 1] is None:
                before = last[end + 1 - length]
                if before is None:
                    continue
                if before != _EDGE:
                    seam = before << 32 | k
                    holds = seams.get(seam)
                    if holds is None:
                        if len(seams) >= KEPT_SEAMS:
                            seams.clear()
                        holds = seams[seam] = self.seam_holds(before, k)
                    if not holds:
                        continue
                last[end + 1] = k
                back[end + 1] = end + 1 - length
        ids = []
        while n:
            ids.append(last[n])
            n = back[n]
        return ids[::-1]

    def encode_word(self, word: str) -> bytes:
        """Little-endian ids of a word with its space mark; characters without a piece become bytes."""
        kept = self.kept.get(word)
        if kept is not None:
            return kept
        ids: list[int] = []
        if self.known.issuperset(word):
            ids = self.encode_known(word)
        else:
            run = ""
            for c in word:
                if c in self.known:
                    run += c
                    continue
                ids += self.encode_known(run) if run else []
                ids += [self.byte_ids[b] for b in c.encode()]
                run = ""
            ids += self.encode_known(run) if run else []
        if len(self.kept) >= KEPT_WORDS:
            self.kept.clear()
        kept = self.kept[word] = np.array(ids, dtype="<u4").tobytes()
        return kept

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text.

        A piece never reaches over a space, so words are encoded apart. Spaces in
        a row belong to the word after them, and are merged plainly.
        """
        cut = batch_words(texts)
        empty = np.array([not w for w in cut.words], dtype=bool)
        spaced = np.logical_or.reduceat(empty[cut.index], cut.offsets[:-1])
        coded = [self.encode_word(SPACE + w) for w in cut.words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        values = np.frombuffer(b"".join(coded), dtype="<u4")
        per_text = np.add.reduceat(sizes[cut.index], cut.offsets[:-1])
        starts = np.cumsum(sizes) - sizes
        if not spaced.any():
            return gather(values, starts, sizes, cut.index), per_text
        of_text = np.repeat(np.arange(len(texts)), np.diff(cut.offsets))
        regular = iter(np.split(gather(values, starts, sizes, cut.index[~spaced[of_text]]),
                                np.cumsum(per_text[~spaced])[:-1]))
        parts = [self.encode_spaced(texts[k].as_py() or "") if odd else next(regular)
                 for k, odd in enumerate(spaced.tolist())]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))

    def encode_spaced(self, text: str) -> np.ndarray:
        """Ids of a text with spaces in a row or at an end; the empty text has none."""
        if not text:
            return np.zeros(0, dtype=np.uint32)
        out: list[bytes] = []
        waiting = 0
        for word in text.split(" "):
            waiting += 1
            if word:
                out.append(self._after_spaces(waiting, word))
                waiting = 0
        if waiting:
            out.append(self._after_spaces(waiting, ""))
        return np.frombuffer(b"".join(out), dtype="<u4")

    def _after_spaces(self, spaces: int, word: str) -> bytes:
        if spaces == 1:
            return self.encode_word(SPACE + word)
        known = 0
        while known < len(word) and word[known] in self.known:
            known += 1
        ids, _ = self.merge(SPACE * spaces + word[:known])
        head = np.array(ids, dtype="<u4").tobytes()
        rest = word[known:]
        return head + (self.encode_word(rest) if rest else b"")

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of the ids of many texts; the space put in front is taken away."""
        data, starts, lengths = self._byte_table()
        raw = gather(data, starts, lengths, ids.astype(np.int64)).tobytes()
        ends = np.cumsum(np.concatenate(([0], lengths[ids.astype(np.int64)])))
        bounds = ends[np.concatenate(([0], np.cumsum(sizes)))].tolist()
        return [raw[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(bounds[:-1], bounds[1:])]

    def _byte_table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not hasattr(self, "_table"):
            lengths = np.fromiter(map(len, self.bytes_of), np.int64, len(self.bytes_of))
            self._table = (np.frombuffer(b"".join(self.bytes_of), np.uint8), np.cumsum(lengths) - lengths, lengths)
        return self._table


ENCODED = "doc_id long, text string, ids array<int>"


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, text, ids)`` for each row of ``docs (doc_id, text)``; ids as the model's own library gives them.

    Null and empty texts have no ids. Repeated rows are encoded alike, one row each;
    other columns are ignored; an empty table gives no rows. The job is narrow.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with for_this_task(lambda: PieceModel(model_path)) as model:
            for part in (part for batch in batches for part in text_slices(batch)):
                ids, sizes = model.encode(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
                                                 pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text").cast(pa.string()), lists],
                                                 schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


DECODED = "doc_id long, n_tokens long, ids_crc32 long, decoded string, text string"


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, decoded, text)``: the text of the ids next to the one they were made of.

    ids_crc32 is the checksum of the ids as little-endian unsigned 32-bit integers.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                        ("decoded", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with for_this_task(lambda: PieceModel(model_path)) as model:
            for part in (part for batch in batches for part in text_slices(batch)):
                lists = part.column("ids")
                offsets = lists.offsets.to_numpy().astype(np.int64)
                ids = lists.flatten().to_numpy().astype("<u4")
                sums = checksums(ids, np.diff(offsets))
                texts = model.decode(ids, np.diff(offsets))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(sums, pa.int64()),
                     pa.array(texts, pa.string()), part.column("text").cast(pa.string())], schema=schema)

    return encoded.select("doc_id", "ids", "text").mapInArrow(run, DECODED)


def checksums(ids: np.ndarray, sizes: np.ndarray) -> list[int]:
    """Checksum of the ids of each text, as little-endian unsigned 32-bit integers."""
    raw = memoryview(ids.astype("<u4").tobytes())
    ends = np.cumsum(sizes)
    return [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, exact)``: exact if decoding gives the whole text back (null: the empty text).

    As :func:`decode` after :func:`encode`, in one pass and without the ids leaving their task. The only
    texts that do not come back are those that hold the model's own mark for a space.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                        ("exact", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with for_this_task(lambda: PieceModel(model_path)) as model:
            for part in (part for batch in batches for part in text_slices(batch)):
                ids, sizes = model.encode(part.column("text"))
                exact = [text == (own or "") for text, own in
                         zip(model.decode(ids, sizes), part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), pa.array(checksums(ids, sizes), pa.int64()),
                     pa.array(exact)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, exact boolean")
