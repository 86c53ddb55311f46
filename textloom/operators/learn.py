"""Learning merges as a series of Spark jobs over the word-count table.

Each round takes the longest run of top-ranked pairs whose merges cannot influence
each other, applies them at once to the words that an inverted index finds for them
(:mod:`textloom.operators.pair_index`), and brings back how the counts of the few pairs
that matter have changed. The result equals one merge at a time:

* Merging ``(a, b)`` changes the count of an old pair only if that pair ends in
  ``a`` or starts with ``b``. A round stops before such a pair, so the counts of
  the pairs it takes stay true.
* A new pair such as ``(x, ab)`` occurs at most as often as the old pair ``(x, a)``
  and ranks behind it on equal counts, its id being higher. So it could only come
  first if ``(x, a)`` had, and that pair would have ended the round.
* Merging ``(a, a)``, or into a token that is there already, ends the round.

The driver keeps a bounded ranking of the best pairs. Pairs outside it rank behind
its boundary for good: counts of old pairs only fall, and new pairs are reported by
the round that makes them. Once the ranking is used up, or many merges wait, the index is
written anew and all pairs are counted again.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from textloom.config import SPECIAL_TOKENS, VocabularyConfig
from textloom.operators.model import BpeModel
from textloom.operators.pair_index import PairIndex
from textloom.operators.word_stats import as_symbols, best_pairs, collect_alphabet, symbol, token_id

#: The pairs of a round are one list in the file reader's filter, see ``pair_index``; mostly a conflict ends a round before.
_MAX_PAIRS_PER_ROUND = 512


def _rank_key(pair: str, count: int) -> tuple[int, str]:
    return (-count, pair)


class PairRanking:
    """The best pairs with their exact counts, and the rank where knowledge ends."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.counts: dict[str, int] = {}
        self.boundary: tuple[int, str] | None = None
        self.stale = True

    def refill(self, rows: list[tuple[str, int]]) -> None:
        """Start again from the best ``limit`` pairs."""
        self.counts = dict(rows)
        full = len(rows) >= self.limit
        self.boundary = _rank_key(*rows[-1]) if full else None
        self.stale = False

    @property
    def lowest_count(self) -> int:
        """New pairs below this count rank behind the boundary."""
        return 1 if self.boundary is None else -self.boundary[0]

    def ranked(self) -> list[tuple[str, int]]:
        return sorted(self.counts.items(), key=lambda item: _rank_key(*item))

    def neighbours(self, taken: list[str]) -> list[str]:
        """Known pairs whose count the merges of ``taken`` can lower."""
        lefts, rights = {p[0] for p in taken}, {p[1] for p in taken}
        return [p for p in self.counts if p[1] in lefts or p[0] in rights]

    def update(self, taken: list[str], changes: list[tuple[str, int]]) -> None:
        for pair in taken:
            self.counts.pop(pair, None)
        for pair, change in changes:
            count = self.counts.get(pair, 0) + change
            known = pair in self.counts
            inside = self.boundary is None or _rank_key(pair, count) <= self.boundary
            if count > 0 and inside:
                self.counts[pair] = count
            elif known:
                del self.counts[pair]
        if len(self.counts) > 4 * self.limit:
            kept = self.ranked()[:2 * self.limit]
            self.counts = dict(kept)
            self.boundary = _rank_key(*kept[-1])


class Round:
    """The merges of one round, taken from the top of the ranking."""

    def __init__(self, ranking: PairRanking, tokens: list[str], ids: dict[str, int],
                 room: int, threshold: int) -> None:
        self.merges: list[tuple[str, int]] = []
        self.new_tokens: list[str] = []
        self.reuses_token = False
        lefts: set[str] = set()
        rights: set[str] = set()
        for pair, count in ranking.ranked():
            left, right = pair
            text = tokens[token_id(left)] + tokens[token_id(right)]
            if (count < threshold or len(self.new_tokens) >= room or left in rights or right in lefts
                    or len(self.merges) >= _MAX_PAIRS_PER_ROUND):
                break
            if text in ids or text in self.new_tokens:
                if not self.merges:
                    self.merges.append((pair, ids[text]))
                    self.reuses_token = True
                break
            self.merges.append((pair, len(tokens) + len(self.new_tokens)))
            self.new_tokens.append(text)
            lefts.add(left)
            rights.add(right)
            if left == right:
                break

    @property
    def pairs(self) -> list[str]:
        return [pair for pair, _ in self.merges]

    @property
    def replacements(self) -> list[tuple[str, str]]:
        return [(pair, symbol(new_id)) for pair, new_id in self.merges]


@dataclass(frozen=True)
class RoundReport:
    """What a round did."""

    merges: int
    postings_read: int
    seconds: float


def learn_bpe(counted: DataFrame, config: VocabularyConfig,
              on_round: Callable[[RoundReport], None] | None = None) -> BpeModel:
    """Learn a vocabulary from word counts ``(word, cnt)``.

    Ids: the special tokens, the alphabet in code-point order, then merges as they
    come. Stops when the vocabulary is full, no pair is left, or the best pair is
    rarer than ``min_frequency``. The alphabet is never cut.

    ``counted`` is read several times; give a written table rather than a long plan.
    ``on_round`` is told what each round did.
    """
    alphabet = collect_alphabet(counted)
    tokens = [*SPECIAL_TOKENS, *alphabet]
    ids = {token: i for i, token in enumerate(tokens)}
    merges: list[tuple[int, int, int]] = []
    threshold = max(1, config.min_frequency)
    if len(tokens) >= config.vocab_size or not alphabet:
        return BpeModel(tuple(tokens), ())

    states = as_symbols(counted, alphabet).select("s", "cnt")
    index = PairIndex(states, counted.count())
    ranking = PairRanking(config.ranked_pairs)
    try:
        while len(tokens) < config.vocab_size:
            if ranking.stale or not ranking.counts or len(index.merges) >= config.merges_per_index:
                if not ranking.stale and ranking.boundary is None and not ranking.counts:
                    break
                top = best_pairs(index.all_pairs(), ranking.limit).collect()
                ranking.refill([(row.pair, row.n) for row in top])
            started = time.perf_counter()
            step = Round(ranking, tokens, ids, config.vocab_size - len(tokens), threshold)
            if not step.merges:
                break
            changes, n_read = index.merge(step.replacements, ranking.neighbours(step.pairs), ranking.lowest_count)
            for pair, new_id in step.merges:
                merges.append((token_id(pair[0]), token_id(pair[1]), new_id))
            for text in step.new_tokens:
                ids[text] = len(tokens)
                tokens.append(text)
            if step.reuses_token:
                ranking.stale = True
            else:
                ranking.update(step.pairs, changes)
            if on_round is not None:
                on_round(RoundReport(len(step.merges), n_read, time.perf_counter() - started))
    finally:
        index.close()
    return BpeModel(tuple(tokens), tuple(merges))
