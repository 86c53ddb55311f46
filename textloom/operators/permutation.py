"""Epoch orders by arithmetic: a keyed bijection of row positions.

Positions are stored with the rows once. The order of an epoch is a permutation of them that is a formula of
seed and epoch, so any row's place, rank and batch follow from its position alone, and the rows of
any batch from its number, by the inverse: no row is moved and nothing is sorted.

The permutation is an unbalanced Feistel network: positions are written as two digits, ``x = l * b + r`` with
``l < a`` and ``r < b``, and every round adds a keyed hash of one digit to the other. Each round can be undone, so it is a
bijection of all ``a * b`` numbers. A result that is no position goes through the network again until it is one
("cycle walking"); this too can be undone. There are less than ``a``, about the root of the number of
rows, numbers too many, so the most walks any position takes is found by trying all of them.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.positions import POSITION

ROUNDS = 6
#: Hex digits of the hash that a round adds: far more than a digit of a position has.
HASH_DIGITS = 12
EPOCH_POSITION = "epoch_pos"


@dataclass(frozen=True)
class Permutation:
    """The order of one epoch over ``n`` positions: ``place(x)`` is where position ``x`` comes, ``position(y)`` the inverse."""

    n: int
    seed: int
    epoch: int

    @cached_property
    def digits(self) -> tuple[int, int]:
        a = math.isqrt(max(self.n - 1, 0)) + 1
        return a, max(1, -(-self.n // a))

    def _added(self, k: int, digit: int) -> int:
        text = f"{self.seed}:{self.epoch}:{k}:{digit}"
        return int(hashlib.md5(text.encode()).hexdigest()[:HASH_DIGITS], 16)

    def _through(self, x: int) -> int:
        a, b = self.digits
        left, right = divmod(x, b)
        for k in range(ROUNDS):
            if k % 2:
                right = (right + self._added(k, left)) % b
            else:
                left = (left + self._added(k, right)) % a
        return left * b + right

    def _back(self, y: int) -> int:
        a, b = self.digits
        left, right = divmod(y, b)
        for k in reversed(range(ROUNDS)):
            if k % 2:
                right = (right - self._added(k, left)) % b
            else:
                left = (left - self._added(k, right)) % a
        return left * b + right

    def place(self, position: int) -> int:
        if not 0 <= position < self.n:
            raise ValueError(f"{position} is not one of {self.n} positions")
        x = self._through(position)
        while x >= self.n:
            x = self._through(x)
        return x

    def position(self, place: int) -> int:
        if not 0 <= place < self.n:
            raise ValueError(f"{place} is not one of {self.n} places")
        x = self._back(place)
        while x >= self.n:
            x = self._back(x)
        return x

    @cached_property
    def walks(self) -> int:
        """The most walks after the first pass that any position takes: the longest chain of numbers that are none."""
        a, b = self.digits
        after = {x: self._through(x) for x in range(self.n, a * b)}
        longest = 0
        for x in set(after) - set(after.values()):          # the heads of chains; a cycle of such numbers is never entered
            steps = 0
            while x in after:
                x, steps = after[x], steps + 1
            longest = max(longest, steps)
        return longest

    def column(self, position: Column) -> Column:
        """:meth:`place` as a column."""
        a, b = self.digits

        def added(k: Column, digit: Column) -> Column:
            text = F.concat_ws(":", F.lit(f"{self.seed}:{self.epoch}"), k.cast("string"), digit.cast("string"))
            return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("bigint")

        def one_round(state: Column, k: Column) -> Column:
            left, right = state["l"], state["r"]
            return F.when(k % 2 == 0, F.struct(((left + added(k, right)) % a).alias("l"), right.alias("r"))).otherwise(
                F.struct(left.alias("l"), ((right + added(k, left)) % b).alias("r")))

        def through(x: Column) -> Column:
            start = F.struct(F.floor(x / F.lit(b)).cast("bigint").alias("l"), (x % b).cast("bigint").alias("r"))
            if b == 1:
                start = F.struct(x.cast("bigint").alias("l"), F.lit(0).cast("bigint").alias("r"))
            return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, one_round, lambda s: s["l"] * b + s["r"])

        passes = F.array(*map(F.lit, range(self.walks + 1)))
        return F.aggregate(passes, position.cast("bigint"),
                           lambda x, k: F.when((k == 0) | (x >= self.n), through(x)).otherwise(x))


def epoch_positions(positioned: DataFrame, n_rows: int, seed: int, epoch: int, position: str = POSITION,
                    name: str = EPOCH_POSITION) -> DataFrame:
    """Add each row's place in an epoch's order. ``position`` holds 0 to ``n_rows - 1``, each once. Narrow."""
    return positioned.withColumn(name, Permutation(n_rows, seed, epoch).column(F.col(position)))


def places_of_batch(n_rows: int, batch: int, batch_size: int, rank: int = 0, world_size: int = 1) -> list[int]:
    """The places, in an epoch's order, of the rows of one batch of one rank.

    Rows go round the ranks; if their number is not a multiple of ``world_size``, rows from the start are repeated.
    """
    share = -(-n_rows // world_size)
    own = range(batch * batch_size, min((batch + 1) * batch_size, share))
    return [(k * world_size + rank) % n_rows for k in own]


def batch_rows(positioned: DataFrame, n_rows: int, seed: int, epoch: int, batch: int, batch_size: int, rank: int = 0,
               world_size: int = 1, position: str = POSITION) -> DataFrame:
    """The rows of one batch of one rank in one epoch, with ``place_in_batch``.

    Their positions are computed first; the table is read with a filter on at most ``batch_size`` positions, which skips
    all other parts of a table that is stored in their order.
    """
    order = Permutation(n_rows, seed, epoch)
    wanted = [order.position(place) for place in places_of_batch(n_rows, batch, batch_size, rank, world_size)]
    found = positioned.where(F.col(position).isin(wanted))
    where = F.array(*[F.lit(p).cast("bigint") for p in wanted])
    return found.withColumn("place_in_batch", (F.array_position(where, F.col(position).cast("bigint")) - 1).cast("int"))
