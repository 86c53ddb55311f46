"""An inverted index from symbol pairs to the words that hold them, for learning merges.

The index is a written table: for each word and each distinct pair in it a posting with the word's symbol
string and its count. It is partitioned by word and sorted by pair within a file, in small pages, so
a lookup of a few pairs reads the pages of their postings and skips the others; each file has an even share of every list.

Merges are deltas on top of it, kept on the driver and sent out: a word's present state is its written
state with the merges since then applied in their order. A symbol made since then begins and ends with
written symbols, and where two symbols meet now, the last written symbol of the left one met the first
of the right one: the postings of that written pair are all words that can hold the pair now. So nothing is rewritten
between two writings of the index, a round depends on written files only, and a lost executor costs a
repeated lookup.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from textloom.operators.word_stats import ADJACENT_PAIRS_SQL, pair_counts
from textloom.sources.workspace import remove, scratch_path

WORDS_PER_FILE = 100_000
_FILE_BYTES = "16m"                # a file of words is smaller
#: Postings in a page, the least that is read.
_PAGE_ROWS = 500
#: Pairs whose changes a task sums before it passes them on.
_HELD_PAIRS = 200_000
_WORDS = "s string, cnt bigint"
_POSTINGS = "pair string, s string, cnt bigint"
#: In the result of a round, the row that has the number of postings read.
_ROWS_READ = ""


def merged_word(word: str, ranks: dict[str, int], symbols: dict[str, str], done: int = -1) -> str:
    """``word`` with the merges of ``ranks`` applied, each once and in order; those up to ``done`` have been."""
    while len(word) > 1:
        found = [r for r in map(ranks.get, map("".join, zip(word, word[1:]))) if r is not None and r > done]
        if not found:
            break
        done = min(found)
        pair, new = symbols[done]
        word = word.replace(pair, new)
    return word


class PairIndex:
    """The words of a learning run, found by the pairs in them."""

    def __init__(self, states: DataFrame, n_words: int) -> None:
        self.spark = states.sparkSession
        self.files = max(math.ceil(n_words / WORDS_PER_FILE), 1)
        self.session = self.spark.newSession()
        cores = self.spark.sparkContext.defaultParallelism
        for key, value in _lookup_settings(self.files, cores).items():
            self.session.conf.set(key, value)
        self.path: str | None = None
        self._write(states.repartition(self.files))

    def _write(self, states: DataFrame) -> None:
        before, self.path = self.path, scratch_path(self.spark, "pair-index")
        states.where("length(s) > 1").select("s", "cnt").write.parquet(f"{self.path}/words")
        postings = self.words().selectExpr(f"explode(array_distinct({ADJACENT_PAIRS_SQL.format('s')})) AS pair", "s", "cnt")
        (postings.sortWithinPartitions("pair").write.option("parquet.page.row.count.limit", _PAGE_ROWS)
         .option("parquet.page.size", 64 * 1024).parquet(f"{self.path}/postings"))
        if before is not None:
            remove(self.spark, before)
        self.merges: list[tuple[str, str]] = []
        self.first: dict[str, str] = {}
        self.last: dict[str, str] = {}

    def words(self) -> DataFrame:
        """The words as they were written."""
        return self.session.read.schema(_WORDS).parquet(f"{self.path}/words")

    def rewrite(self) -> None:
        """Write words and postings anew, with all merges applied; tasks read and write one file each."""
        if not self.merges:
            return
        ranks = {pair: k for k, (pair, _) in enumerate(self.merges)}
        symbols = dict(enumerate(self.merges))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                merged = [merged_word(s, ranks, symbols) for s in batch.column("s").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(merged, pa.string()), batch.column("cnt")], names=["s", "cnt"])

        self._write(self.words().mapInArrow(run, _WORDS))

    def all_pairs(self) -> DataFrame:
        """Counts of all pairs, after a rewrite; with the shuffle settings of the caller's session."""
        self.rewrite()
        return pair_counts(self.spark.read.schema(_WORDS).parquet(f"{self.path}/words"))

    def written_pair(self, pair: str) -> str:
        """The pair of written symbols that meet where ``pair`` is."""
        return self.last.get(pair[0], pair[0]) + self.first.get(pair[1], pair[1])

    def merge(self, merges: list[tuple[str, str]], neighbours: list[str], least_count: int) -> tuple[list[tuple[str, int]], int]:
        """Apply merges ``(pair, new symbol)``; returns changes of pair counts, and how many postings were read.

        Changes are those of ``neighbours``, and of pairs with a new symbol if they are ``least_count`` or more.
        What comes back is bounded: the neighbours are given, and a new pair ``(x, ab)`` or ``(ab, y)``
        needs an old one ``(x, a)`` or ``(b, y)`` of at least its count, so there are at most
        two new pairs for each merge and each old pair of that count.
        """
        looked_up = list(dict.fromkeys(self.written_pair(pair) for pair, _ in merges))
        before = len(self.merges)
        for pair, new in merges:
            self.first.setdefault(new, self.first.get(pair[0], pair[0]))
            self.last.setdefault(new, self.last.get(pair[1], pair[1]))
        self.merges += merges
        run = _changes(looked_up, self.merges, before, set(neighbours))
        postings = self.session.read.schema(_POSTINGS).parquet(f"{self.path}/postings")
        found = postings.where(postings["pair"].isin(looked_up))
        if self.files == 1:
            found = found.coalesce(1)           # known to be one partition, a round needs no shuffle
        summed = found.mapInArrow(run, "pair string, n bigint").groupBy("pair").sum("n").toDF("pair", "n")
        near = set(neighbours)
        rows = summed.where(f"n < 0 OR n >= {least_count} OR pair = ''").collect()
        n_read = sum(row.n for row in rows if row.pair == _ROWS_READ)
        return [(row.pair, row.n) for row in rows if row.pair != _ROWS_READ and (row.n >= least_count or row.pair in near)], n_read

    def close(self) -> None:
        if self.path is not None:
            remove(self.spark, self.path)
            self.path = None


def _changes(looked_up: list[str], merges: list[tuple[str, str]], before: int, neighbours: set[str]):
    """The function that sums the changes of pair counts over postings, for the merges from number ``before`` on."""
    old_ranks = {pair: k for k, (pair, _) in enumerate(merges[:before])}
    new_ranks = {pair: k for k, (pair, _) in enumerate(merges[before:], start=before)}
    symbols = dict(enumerate(merges))
    made = {new for _, new in merges[before:]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        changes: dict[str, int] = {}
        n_read = 0
        for batch in batches:
            n_read += batch.num_rows
            for pair, written, count in zip(*(c.to_pylist() for c in batch.columns)):
                # A word with several of the pairs has a posting for each: it is taken once.
                if next(p for p in looked_up if p in written) != pair:
                    continue
                old = merged_word(written, old_ranks, symbols)
                new = merged_word(old, new_ranks, symbols)
                if new == old:
                    continue
                for state, sign in ((old, -count), (new, count)):
                    for k in range(len(state) - 1):
                        changed = state[k:k + 2]
                        if changed in neighbours or changed[0] in made or changed[1] in made:
                            changes[changed] = changes.get(changed, 0) + sign
            if len(changes) > _HELD_PAIRS:
                yield _rows(changes)
                changes = {}
        changes[_ROWS_READ] = n_read
        yield _rows(changes)

    return run


def _rows(changes: dict[str, int]) -> pa.RecordBatch:
    kept = [(pair, n) for pair, n in changes.items() if n]
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())],
                                      names=["pair", "n"])


def _lookup_settings(files: int, cores: int) -> dict[str, str]:
    """One task per file; shuffles, of sums only, grow with the files beyond what the cores need."""
    return {
        "spark.sql.shuffle.partitions": str(max(1, min(files, cores), files // 64)),
        "spark.sql.files.maxPartitionBytes": _FILE_BYTES,
        "spark.sql.files.openCostInBytes": _FILE_BYTES,
        # All pairs of a round reach the file reader as a list, none as a range.
        "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
        "spark.sql.adaptive.enabled": "false",
    }
