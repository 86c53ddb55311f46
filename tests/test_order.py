"""Positions, splits, shards, batches and ranks."""

import math

import pytest
from pyspark.sql import functions as F

from textloom.operators import arrange, positions, split


def rows(spark, n, partitions=4):
    return spark.range(n).repartition(partitions).withColumn("part", (F.col("id") % 3).cast("int"))


@pytest.mark.parametrize("small", [1_000_000, 100, 7])
def test_hash_positions_are_exact_for_any_partitioning(spark, small, monkeypatch):
    monkeypatch.setattr(positions, "_ROWS_PER_PIECE", small)
    results = []
    for partitions in (1, 4, 16):
        placed = positions.hash_positions(rows(spark, 1000, partitions), ["id", "part"], 42)
        results.append({(r.id): r.pos for r in placed.collect()})
    assert sorted(results[0].values()) == list(range(1000))
    assert results[0] == results[1] == results[2]


def test_hash_positions_follow_the_hash_and_change_with_the_epoch(spark):
    import hashlib
    placed = positions.hash_positions(rows(spark, 300), ["id", "part"], 42).orderBy("pos").collect()
    expected = sorted(range(300), key=lambda i: (hashlib.md5(f"42:{i}:{i % 3}".encode()).hexdigest(), i))
    assert [r.id for r in placed] == expected
    other = positions.hash_positions(rows(spark, 300), ["id", "part"], 42, epoch=1).orderBy("pos").collect()
    assert [r.id for r in other] != expected


def test_key_positions_with_one_hot_leading_key(spark):
    """Most rows share one leading key value."""
    df = spark.range(30_000).select(F.when(F.col("id") < 25_000, 7).otherwise(F.col("id")).alias("doc"),
                                    F.col("id").alias("part")).repartition(5)
    placed = positions.key_positions(df, ["doc", "part"])
    wrong = placed.filter(F.col("pos") != F.col("part"))
    assert placed.count() == 30_000 and wrong.count() == 0


def test_positions_of_no_rows(spark):
    assert positions.key_positions(rows(spark, 0), ["id"]).count() == 0
    assert positions.hash_positions(rows(spark, 0), ["id"], 1).count() == 0


@pytest.mark.parametrize("n", [1, 2, 10, 997])
def test_split_is_exact_disjoint_and_complete(spark, n):
    if n == 1:
        with pytest.raises(ValueError):
            split.split_sizes(n, .8, .2)
        return
    seen = []
    for partitions in (1, 5):
        out = split.train_test_split(rows(spark, n, partitions), ["id", "part"], .8, .2, 42)
        assert out.count() == n
        test = {r.id for r in out.filter("split = 'test'").collect()}
        assert len(test) == math.ceil(.2 * n)
        seen.append(test)
    assert seen[0] == seen[1]


def test_split_may_leave_rows_out(spark):
    out = split.train_test_split(rows(spark, 100), ["id", "part"], .5, .2, 1)
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 50, "test": 20}


def test_split_goes_down_to_the_row(spark, monkeypatch):
    """Small passes: the cut is found over several hash prefixes."""
    whole = split.train_test_split(rows(spark, 500), ["id", "part"], .8, .2, 42)
    expected = {r.id for r in whole.filter("split = 'test'").collect()}
    monkeypatch.setattr(split, "_DIGITS_PER_PASS", 1)
    monkeypatch.setattr(split, "_RANKED_ROWS", 1)
    again = split.train_test_split(rows(spark, 500), ["id", "part"], .8, .2, 42)
    assert {r.id for r in again.filter("split = 'test'").collect()} == expected


@pytest.mark.parametrize("n, size, expected", [(10, 4, [4, 3, 3]), (9, 3, [3, 3, 3]), (2, 5, [2]), (7, 1, [1] * 7)])
def test_shards_are_balanced_blocks(spark, n, size, expected):
    placed = positions.key_positions(rows(spark, n), ["id"])
    shards = arrange.assign_shards(placed, n, size).groupBy("shard_id").agg(
        F.count("*").alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi")).orderBy("shard_id").collect()
    assert [s.n for s in shards] == expected
    assert all(s.hi - s.lo + 1 == s.n for s in shards)


def test_batches(spark):
    placed = positions.key_positions(rows(spark, 10), ["id"])
    sizes = arrange.assign_batches(placed, 4).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in sizes] == [4, 4, 2]


@pytest.mark.parametrize("n, world", [(10, 4), (8, 4), (2, 5), (1, 4), (0, 3)])
def test_ranks_get_equal_shares(spark, n, world):
    placed = positions.hash_positions(rows(spark, n), ["id"], 42, epoch=2)
    shares = arrange.assign_ranks(placed, n, world).collect()
    per_rank = [sorted(r.rank_pos for r in shares if r.rank == k) for k in range(world)]
    assert all(p == list(range(math.ceil(n / world))) for p in per_rank)
    order = [r.id for r in placed.orderBy("pos").collect()]
    for r in shares:
        assert r.id == order[(r.rank_pos * world + r.rank) % n]


def test_batch_matrix_keeps_order(spark):
    placed = positions.key_positions(rows(spark, 5), ["id"])
    ids = arrange.assign_batches(placed, 2).withColumn("input_ids", F.array("id", F.col("id") + 1))
    got = {r.batch_id: r.rows for r in arrange.batch_matrix(ids).collect()}
    assert got == {0: [[0, 1], [1, 2]], 1: [[2, 3], [3, 4]], 2: [[4, 5]]}


def test_counting_pieces_reads_no_payload(spark):
    df = rows(spark, 500).withColumn("text", F.lit("x"))
    plan = positions.key_positions(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and sum("text" in line.split("Batched")[0] for line in scans) == 1
