"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its nearest reference points (pivots), nearest first. Every
pivot has an inverted list of the vectors that name it. Two vectors are candidates if
they name at least ``shared`` pivots in common; these are counted first, and only candidates are verified by their cosine.
Vectors that share so many pivots share one even if each leaves out the last ``shared - 1`` of its own, in
the order of pivots, so these have no entries in lists.
No two pivots are near each other: a group of near copies of any size has one or few
of its own, and its vectors name the same ones. Where there are fewer pivots than
``shared``, all of them are asked for.

Lists are kept by label, and a list longer than a block is cut into blocks by a
hash; tasks take pairs of blocks. A pair that meets in several lists is judged in the list
of its first common pivot only, which any task can tell from the two descriptions. Tasks
return sums of links and a spanning forest of them, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import components
from textloom.llm.tables import key_groups, stored

THRESHOLD = 0.93
NEAREST = 8
SHARED = 2
BLOCK_ROWS = 1024
#: The pivots are a sample of this many vectors for each square root of their number, within limits.
PIVOTS_PER_ROOT = 4
LEAST_PIVOTS = 64
MOST_PIVOTS = 16_384
MOST_PIVOT_NUMBERS = 4_000_000
#: No two pivots have this cosine or more.
PIVOT_COSINE = 0.8


def pivot_count(n_vectors: int, dimension: int) -> int:
    """A power of two that grows with the root of ``n_vectors``: lists grow with the root too."""
    wanted = 2 ** math.ceil(math.log2(max(1.0, PIVOTS_PER_ROOT * math.sqrt(n_vectors))))
    return max(1, min(max(wanted, LEAST_PIVOTS), MOST_PIVOTS, MOST_PIVOT_NUMBERS // max(1, dimension)))


def _usable() -> Column:
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.coalesce(whole & F.exists("embedding", lambda x: x != 0), F.lit(False)))


def spread_out(points: np.ndarray, limit: float = PIVOT_COSINE, block: int = 256) -> np.ndarray:
    """The unit vectors, in order, without those that have a cosine of ``limit`` with an earlier one that stays."""
    kept = points[:0]
    for start in range(0, len(points), block):
        part = points[start:start + block]
        part = part[(part @ kept.T < limit).all(axis=1)]
        near, stays = part @ part.T >= limit, np.zeros(len(part), dtype=bool)
        for k in range(len(part)):
            stays[k] = not near[k, :k][stays[:k]].any()
        kept = np.concatenate([kept, part[stays]])
    return kept


def choose_pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """Unit reference points for each dimension: the distinct vectors of the least hashes, a bounded sample, thinned."""
    sizes = {row["dim"]: row["n"] for row in
             classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(64).collect()}
    pivots = {}
    for dim, n in sizes.items():
        sample = (classes.where(F.col("dim") == dim).select("node", "embedding")
                  .orderBy(F.xxhash64("embedding"), "embedding").limit(pivot_count(n, dim)).collect())
        points = np.array([row["embedding"] for row in sample], dtype=np.float64)
        points /= np.abs(points).max(axis=1, keepdims=True)
        pivots[dim] = spread_out(points / np.linalg.norm(points, axis=1, keepdims=True))
    return pivots


def described(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """``classes`` with ``nearest``: the pivots that a vector names, in ascending order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for start in range(0, len(rows), 1000):
                    yield name(batch.take(pa.array(rows[start:start + 1000])), int(dim))

    def name(part: pa.RecordBatch, dim: int) -> pa.RecordBatch:
        n = part.num_rows
        points = pivots.get(dim, np.eye(1, dim))
        near = -unit_rows(part.column("embedding"), n) @ points.T
        k = min(nearest, len(points))
        named = np.argpartition(near, k - 1, axis=1)[:, :k] if k < len(points) else np.tile(np.arange(k), (n, 1))
        named = np.sort(named, axis=1).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(named.ravel()))
        return pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "nearest"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in classes.dtypes)
    return classes.mapInArrow(run, f"{kinds}, nearest array<int>")


def unit_rows(vectors: pa.Array, n: int) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def cells(named: DataFrame, block_rows: int, shared: int) -> DataFrame:
    """List entries dealt to pairs of blocks ``(a, b)`` of their list; short lists are one block.

    Only lists of several blocks are in the table that says how many: entries meet it without their vectors' shuffle
    where Spark finds it small.
    """
    keys = ["label", "dim", "pivot"]
    least = F.least(F.lit(shared), F.size("nearest"))
    entries = named.withColumn("pivot", F.explode(F.slice("nearest", F.lit(1), F.size("nearest") - least + 1)))
    large = stored(entries.groupBy(*keys).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")).where("blocks > 1")
                   .select(*[F.col(k).alias(f"list_{k}") for k in keys], "blocks"), "lists")
    same = [F.col(k) == F.col(f"list_{k}") for k in keys]
    blocked = (entries.join(large, same, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
               .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    return (blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))
            .select(*keys, "a", "b", "own", "node", "copies", "nearest", "embedding"))


def shared_pivots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many pivots each row of ``left`` has in common with each of ``right``."""
    known, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    place = place.reshape(-1, left.shape[1])
    names = np.zeros((len(place), len(known)), dtype=np.float32)
    np.put_along_axis(names, place, 1, axis=1)
    return names[:len(left)] @ names[len(left):].T


def verified(dealt: DataFrame, threshold: float, shared: int) -> DataFrame:
    """``(node, links, root)``: links of a node found in a cell, and a node it is tied to there."""
    keys = ["label", "dim", "pivot", "a", "b"]
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, keys):
            found = judge(group)
            if found is not None:
                yield found

    def judge(group: pa.Table) -> pa.RecordBatch | None:
        n = group.num_rows
        if n < 2:
            return None
        a, b, pivot = (group.column(c)[0].as_py() for c in ("a", "b", "pivot"))
        own = group.column("own").to_numpy()
        node = group.column("node").to_numpy()
        copies = group.column("copies").to_numpy()
        nearest = group.column("nearest").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        left, right = np.flatnonzero(own == a), np.flatnonzero(own == b)
        if not (len(left) and len(right)):
            return None
        candidates = shared_pivots(nearest[left], nearest[right]) >= min(shared, nearest.shape[1])
        if a == b:
            candidates = np.triu(candidates, 1)
        i, j = np.nonzero(candidates)
        if not len(i):
            return None
        unit = unit_rows(group.column("embedding").combine_chunks(), n)
        if len(i) * 8 > candidates.size:        # most pairs are candidates: all cosines at once, then only theirs
            close = (unit[left] @ unit[right].T)[i, j] >= threshold - 1e-9
            i, j = i[close], j[close]
        i, j = left[i], right[j]
        keep = [np.zeros(0, dtype=bool)]
        for at in range(0, len(i), 100_000):
            x, y = i[at:at + 100_000], j[at:at + 100_000]
            common = (nearest[x][:, :, None] == nearest[y][:, None, :]).any(axis=2)
            first = np.where(common, nearest[x], np.iinfo(np.int32).max).min(axis=1)
            keep.append((first == pivot) & (np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold))
        kept = np.concatenate(keep)
        i, j = i[kept], j[kept]
        if not len(i):
            return None
        links = (np.bincount(i, weights=copies[j], minlength=n) + np.bincount(j, weights=copies[i], minlength=n))
        touched = np.flatnonzero(links)
        root = smallest_tied(node, i, j)
        return pa.RecordBatch.from_arrays([pa.array(node[touched]), pa.array(links[touched].astype(np.int64)),
                                           pa.array(root[touched])], schema=schema)

    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(run, "node long, links long, root long")


def smallest_tied(node: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node that each is tied to by the links ``i - j`` of one cell."""
    root = node.copy()
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (root == before).all():
            return root


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, nearest: int = NEAREST,
                           shared: int = SHARED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors (vec_id, embedding, label)``.

    Equal vectors of one label are one class with a number of copies: copies link with
    each other and share their class's links. Vectors that are null, zero, or hold nulls or
    numbers that are not finite, and rows without label, link with nothing; a row
    without id too, and it is kept. Vectors of different length never link. Rows of one id count
    as that many vectors in n_links, each row with the links of its own label and vector, and are one in components. Other columns are
    ignored; an empty table gives no rows. ``shared`` pivots of ``nearest`` decide
    what is compared: the recall is measured in the tests.
    """
    rows = vectors.select("vec_id", "label", "embedding")
    classes = stored(rows.where(_usable()).groupBy("label", "embedding")
                     .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
                     .withColumn("dim", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()), "classes")
    named = stored(described(classes.select("label", "dim", "node", "copies", "embedding"), choose_pivots(classes), nearest), "named")
    found = stored(verified(cells(named, block_rows, shared), threshold, shared), "found")

    # Which class each row is of; classes with a row of the same id belong together.
    of_class = classes.select(F.col("label").alias("class_label"), F.col("embedding").alias("class_embedding"), "node")
    members = stored(rows.where(_usable()).join(of_class, (F.col("label") == F.col("class_label"))
                                                & (F.col("embedding") == F.col("class_embedding"))).select("vec_id", "node"), "members")
    several = members.groupBy("vec_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z").select("vec_id", "a")
    same_id = members.join(several, "vec_id").select("a", F.col("node").alias("b"))
    roots = stored(components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(same_id)), "tied")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = stored(classes.select("node", "least", "copies").join(links, "node", "left").join(roots, "node", "left")
                    .select("node", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
                            F.coalesce("root", "node").alias("root")), "rooted")
    lowest = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "lowest")
    result = rooted.join(lowest, "root").select("node", "n", "component_id")
    linked = members.join(result, "node").select("vec_id", F.col("n").cast("long").alias("n_links"), "component_id")
    alone = rows.where(~_usable()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"),
                                                                    F.lit(True)))
