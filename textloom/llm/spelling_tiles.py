"""Grouping of spelling variants by dense prefix-suffix tiling.

Two words are near if one code point inserted, deleted or replaced makes one of the other.
Then the first half of the shorter (or of both) is at the head of both, or its second half is
at the end of both. Words with the same head, or the same end, for a length are a tile: the words of that
length and those longer by one. A tile's words are rows of a matrix of code points, padded once at the
right and once at the left; comparing all rows of one block with all of another, column by column,
gives the common prefix and suffix of every pair. They are near if the two together
reach the longer length minus one. A pair with equal heads is judged in the tile of its head only.

A tile larger than a block is cut into blocks by a hash, and tasks take pairs of blocks. Small tiles
are compared many at once. Tasks return a number of near words and the best of them for each
word, never the pairs.

A word's form is its near word of largest count, if that count is at least twice its own. Counts
double along a chain of forms, so chains are short; their ends are found by pointer doubling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.tables import discard, run_ends, stored

# Letters of a word, and how often and where a letter is left out.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEFT_OUT = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
BLOCK_ROWS = 1024
#: Cells of a comparison held at once.
MOST_CELLS = 2_000_000


# Words -----------------------------------------------------------------------------

def without_letter(run: Column, doc_id: Column, left_out: int = LEFT_OUT) -> Column:
    """``run`` without one code point if the checksum of ``doc_id:run`` is divisible by ``left_out``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run).cast("long")).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % left_out == 0, cut).otherwise(run)


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: words of ``docs (doc_id, text)``, summed in each task before they are shuffled.

    Words are runs of letters, A-Z lower-cased, of which some lose a letter (:func:`without_letter`). Null texts have
    none; a null id counts as the empty one. Every row is a document.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    words = runs.select(without_letter(F.col("run"), F.col("doc_id")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


# Tiles -----------------------------------------------------------------------------

TILE = ["size", "head", "key"]


def tiles(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``(size, head, key, word, n)``: each word in the tiles of its length and of the length before, by head and by end."""
    length = F.length("word")
    sizes = F.filter(F.array(length, length - 1), lambda k: k >= least_length)
    sized = words.select("word", "n", F.explode(sizes).alias("size"))
    half = F.floor(F.col("size") / 2).cast("int")
    rest = F.col("size") - half
    keys = F.array(F.struct(F.lit(True).alias("head"), F.substring("word", F.lit(1), half).alias("key")),
                   F.struct(F.lit(False).alias("head"), F.substring(F.col("word"), F.length("word") - rest + 1, rest).alias("key")))
    return sized.select("size", F.explode(keys).alias("k"), "word", "n").select("size", "k.head", "k.key", "word", "n")


def cells(tiled: DataFrame, block_rows: int) -> DataFrame:
    """Words of tiles dealt to pairs of blocks ``(a, b)``; a tile of one word is left out, a short one is one block."""
    large = stored(tiled.groupBy(*TILE).agg(F.count("*").alias("words")).where("words > 1")
                   .select(*[F.col(k).alias(f"tile_{k}") for k in TILE], F.ceil(F.col("words") / block_rows).cast("int").alias("blocks")),
                   "tiles")
    same = [tiled[k] == large[f"tile_{k}"] for k in TILE]
    blocked = tiled.join(large, same).withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    return (blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))
            .select(*TILE, "a", "b", "own", "word", "n"))


def code_points(words: pa.Array, width: int, right: bool) -> np.ndarray:
    """One row for each word, padded with 0 at its end, or at its start if ``right``. All code points are below 256."""
    listed = words.to_pylist()
    pad = str.rjust if right else str.ljust
    return np.frombuffer("".join([pad(w, width, "\0") for w in listed]).encode("latin-1"), np.uint8).reshape(len(listed), width)


def common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of equal leading columns of all pairs of rows: ``(tiles, rows, width)`` each, to ``(tiles, rows, rows)``."""
    alive = np.ones((left.shape[0], left.shape[1], right.shape[1]), dtype=bool)
    length = np.zeros(alive.shape, dtype=np.int32)
    for column in range(left.shape[2]):
        alive &= (left[:, :, None, column] == right[:, None, :, column]) & (left[:, :, None, column] != 0)
        if not alive.any():
            break
        length += alive
    return length


def near_pairs(groups: list[tuple[np.ndarray, np.ndarray, bool]], forward: np.ndarray, backward: np.ndarray,
               lengths: np.ndarray, size: int, head: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``i, j`` of the near pairs of tiles of one size, each pair once.

    A group is two lists of rows and whether they are the same block.
    """
    rows, columns = max(len(g[0]) for g in groups), max(len(g[1]) for g in groups)
    left, right = np.full((len(groups), rows), -1), np.full((len(groups), columns), -1)
    for k, (one, two, _) in enumerate(groups):
        left[k, :len(one)], right[k, :len(two)] = one, two
    same = np.array([g[2] for g in groups], dtype=bool)
    prefix = common(forward[left], forward[right])
    suffix = common(backward[left][:, :, ::-1], backward[right][:, :, ::-1])
    longer = np.maximum(lengths[left][:, :, None], lengths[right][:, None, :])
    shorter = np.minimum(lengths[left][:, :, None], lengths[right][:, None, :])
    near = (prefix + suffix >= longer - 1) & (shorter == size)
    near &= (left >= 0)[:, :, None] & (right >= 0)[:, None, :]
    # Once each: within a block, the earlier row first. With equal heads, in the tile of the head only.
    near &= ~same[:, None, None] | (left[:, :, None] < right[:, None, :])
    if not head:
        near &= prefix < size // 2
    g, i, j = np.nonzero(near)
    return left[g, i], right[g, j]


FOUND = "word string, n_near long, best_n long, best string"
_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def judge(rows: pa.Table) -> pa.RecordBatch | None:
    """Near words in whole cells, of one size and side, sorted by cell: for each word their number and the best."""
    size, head = rows.column("size")[0].as_py(), rows.column("head")[0].as_py()
    words = rows.column("word").combine_chunks()
    lengths = pc.utf8_length(words).to_numpy()
    n = rows.column("n").to_numpy()
    own, a, b = (rows.column(c).to_numpy() for c in ("own", "a", "b"))
    ends = np.array(run_ends([rows.column(c).combine_chunks() for c in ("key", "a", "b")]))
    starts = np.concatenate(([0], ends[:-1]))
    keep = np.flatnonzero(ends - starts > 1)
    if not len(keep):
        return None
    forward, backward = code_points(words, size + 1, False), code_points(words, size + 1, True)
    found = []
    waiting: list[tuple[np.ndarray, np.ndarray, bool]] = []
    most = 0

    def flush() -> None:
        if waiting:
            found.append(near_pairs(waiting, forward, backward, lengths, size, head))
            waiting.clear()

    for k in keep[np.argsort((ends - starts)[keep], kind="stable")].tolist():
        at = np.arange(starts[k], ends[k])
        same = a[starts[k]] == b[starts[k]]
        group = (at, at, True) if same else (at[own[at] == a[starts[k]]], at[own[at] == b[starts[k]]], False)
        if not (len(group[0]) and len(group[1])):
            continue
        wider = max(most, len(group[0]), len(group[1]))
        # Tiles of about the same size are compared together.
        if waiting and ((len(waiting) + 1) * wider * max(wider, size) > MOST_CELLS or wider > 2 * len(waiting[0][0])):
            flush()
            wider = max(len(group[0]), len(group[1]))
        waiting.append(group)
        most = wider
    flush()
    i, j = (np.concatenate(side) for side in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
    if not len(i):
        return None
    one, other = np.concatenate([i, j]), np.concatenate([j, i])
    place = np.empty(len(words), dtype=np.int64)
    place[pc.array_sort_indices(words).to_numpy()] = np.arange(len(words))
    order = np.lexsort((place[other], -n[other], one))
    one, other = one[order], other[order]
    first = np.flatnonzero(np.concatenate(([True], one[1:] != one[:-1])))
    counts = np.diff(np.append(first, len(one)))
    return pa.RecordBatch.from_arrays(
        [words.take(pa.array(one[first])), pa.array(counts, pa.int64()), pa.array(n[other[first]], pa.int64()),
         words.take(pa.array(other[first]))], schema=_FOUND)


def near_words(words: DataFrame, block_rows: int = BLOCK_ROWS, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``(word, n_near, best_n, best)`` of ``words (word, n)`` with near words: how many, and the one of largest n, ties by code points."""
    keys = [*TILE, "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # Whole cells of one size and side are judged; the last cell of a batch may go on in the next one.
            cells_end = run_ends([batch.column(c) for c in keys])
            runs_end = set(run_ends([batch.column(c) for c in ("size", "head")]))
            if held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in keys):
                yield from judged(held)
                held = []
            start = 0
            for end in [e for e in cells_end[:-1] if e in runs_end or e == cells_end[-2]]:
                yield from judged([*held, batch.slice(start, end - start)])
                held, start = [], end
            held.append(batch.slice(start))
        if held:
            yield from judged(held)

    def judged(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = judge(pa.Table.from_batches(parts))
        if found is not None:
            yield found

    dealt = cells(tiles(words, least_length), block_rows).repartition(*keys).sortWithinPartitions(*keys)
    found = stored(dealt.mapInArrow(run, FOUND), "near")
    best = F.min(F.struct((-F.col("best_n")).alias("minus_n"), "best"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("at"))
            .select("word", "n_near", (-F.col("at.minus_n")).alias("best_n"), F.col("at.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``, which have no cycles: the end of each word's chain, by pointer doubling."""
    current = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("via"), F.col("root").alias("further"))
        following = stored(current.join(ahead, F.col("root") == F.col("via"), "left")
                           .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
                           "roots")
        discard(current)
        current = following
        if current.where("moved").isEmpty():
            return current.select("word", "root")


def spelling_groups(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for the words of ``docs (doc_id, text)``.

    Null and empty texts have no words; repeated rows count each. Words without a near word have n_near 0; without
    one of ``ratio`` times their count, form and form_n are null and root is the word. Of near words of the
    same count, the first in code-point order is the form. Other columns are ignored; an empty table gives no rows.
    """
    words = stored(word_counts(docs, least_length, least_count), "words")
    near = near_words(words, block_rows, least_length)
    judged = words.join(near.withColumnRenamed("word", "near_word"), F.col("word") == F.col("near_word"), "left")
    enough = F.col("best_n") >= ratio * F.col("n")
    found = stored(judged.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                 F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n")), "forms")
    ends = roots(found.where("form IS NOT NULL")).withColumnRenamed("word", "of_word")
    return (found.join(ends, F.col("word") == F.col("of_word"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
