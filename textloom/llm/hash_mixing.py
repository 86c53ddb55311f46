"""Mixing sources to target weights by hash thresholds, without sorting rows.

Every document has a hash of its id. Words are summed by source and hash bucket; running
sums over the buckets of a source show in which bucket its budget ends. Only rows in that
bucket are read again, in finer buckets, until the bucket holds one hash. Then
all documents below the threshold are in and the others are out: a row is judged by
its own source and hash alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.tables import free_name, stored
from textloom.operators.positions import key_positions

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix has 3/2 of all words; a source at most twice its own.
MIX_SHARE = 1.5
MOST_TIMES = 2
WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
BUCKET_BITS = 10


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(doc_id: Column) -> Column:
    """60 bits of the md5 of the id as text (null: of the empty text)."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` of ``sizes (source, size)``.

    Sources are numbered in code-point order (null last) by range pieces, not in one
    task. Targets are shares by weight; those above the limit stop there and the rest
    is shared again, round by round, until none is above.
    """
    # One more character in front keeps the order, and null after all others.
    rank = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    summed = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("rank", rank),
                    "sources")
    numbered = key_positions(summed, ["rank"])
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod("pos", F.lit(len(WEIGHTS))).cast("int"))
    weighted = stored(numbered.select("source", "source_size", weight.alias("weight")), "weighted")

    limit = F.col("source_size") * MOST_TIMES
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, capped_before = None, -1
    while True:
        capped = F.lit(False) if level is None else F.col("weight") * F.lit(level) > limit
        row = weighted.agg(F.count(F.when(capped, 1)).alias("n"),
                           F.coalesce(F.sum(F.when(capped, limit)), F.lit(0)).alias("fixed"),
                           F.sum(F.when(~capped, F.col("weight"))).alias("open")).first()
        if row["n"] == capped_before or not row["open"]:
            break
        capped_before, level = row["n"], (MIX_SHARE * total - row["fixed"]) / row["open"]
    share = F.least(limit.cast("double"), F.col("weight") * F.lit(float(level or 0)))
    return stored(weighted.select("source", "source_size", share.alias("target")), "targets")


def budgets(targets: DataFrame) -> DataFrame:
    """How often a source is taken whole, and the words still to be taken from a part of it."""
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return targets.withColumn("times", times.cast("int")).withColumn(
        "budget", F.col("target") - F.col("times") * F.col("source_size"))


def edges(sizes: DataFrame, budgeted: DataFrame) -> DataFrame:
    """``(source, budget, edge, rows, under, upto)``: the hash at which a source's budget ends.

    ``sizes``: ``(source, h, size)``; ``budgeted``: ``(source, budget)``. ``under`` are the words of all smaller hashes, ``upto``
    those with the edge's own ``rows``. Sources whose budget is not reached are left out. Buckets are cut finer, and only the one
    where the budget ends, until it holds one hash.
    """
    open_now = stored(budgeted.select("source", "budget", F.lit(0).cast("double").alias("before"),
                                      F.lit(0).cast("long").alias("prefix")), "open")
    done: list[DataFrame] = []
    for left in range(HASH_BITS - BUCKET_BITS, -1, -BUCKET_BITS):
        within = (sizes.alias("s").join(open_now.alias("o"), F.col("s.source").eqNullSafe(F.col("o.source")))
                  .where(F.shiftright("h", left + BUCKET_BITS) == F.col("prefix")))
        by_bucket = (within.groupBy("o.source", "budget", "before", F.shiftright("h", left).alias("bucket"))
                     .agg(F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high"), F.count("*").alias("rows")))
        so_far = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        summed = by_bucket.withColumn("upto", F.col("before") + F.sum("words").over(so_far))
        over = summed.where("upto > budget")
        edge = stored(over.groupBy("source").agg(F.min_by(
            F.struct("budget", "bucket", "low", "high", "rows", "upto", (F.col("upto") - F.col("words")).alias("under")),
            "bucket").alias("e")).select("source", "e.*"), "edge")
        single = F.col("low") == F.col("high")
        done.append(edge.where(single).select("source", "budget", F.col("low").alias("edge"), "rows", "under", "upto"))
        open_now = edge.where(~single).select("source", "budget", F.col("under").alias("before"),
                                              F.col("bucket").alias("prefix"))
        if left == 0 or open_now.isEmpty():
            break
    return reduce(DataFrame.unionByName, done)


#: A row's hashes, each looked at only where the one before does not tell: of the id, of the text, of the place of the row.
HASHES = ("h", "text_h", "row_h")


def thresholds(sizes: DataFrame, budgeted: DataFrame) -> DataFrame:
    """``budgeted`` with ``cut_<hash>`` and ``edge_<hash>`` for each of a row's hashes; see :func:`beyond_times`.

    In hash order, rows are in while the middle of a row is within the budget: the sum taken misses the budget by half
    of one document at most. Where several rows have the hash of an edge, they are told apart by the next hash.
    """
    plan, left = budgeted, budgeted.select("source", "budget")
    within = sizes
    for k, name in enumerate(HASHES):
        found = stored(edges(within.select("source", F.col(name).alias("h"), "size"), left), "edges")
        last = k == len(HASHES) - 1
        lump = F.lit(False) if last else F.col("rows") > 1
        fits = F.col("under") + F.col("upto") <= 2 * F.col("budget")
        cuts = found.select(F.col("source").alias("of"), (F.col("edge") + F.when(~lump & fits, 1).otherwise(0)).alias(f"cut_{name}"),
                            F.when(lump, F.col("edge")).alias(f"edge_{name}"))
        plan = plan.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        left = found.where(lump).select("source", (F.col("budget") - F.col("under")).alias("budget"), "edge")
        if last or left.isEmpty():
            break
        within = stored(within.alias("s").join(left.alias("o"), F.col("s.source").eqNullSafe(F.col("o.source"))
                                               & (F.col(f"s.{name}") == F.col("o.edge"))).select("s.*"), "lumps")
        left = left.drop("edge")
    for name in HASHES:
        for column in (f"cut_{name}", f"edge_{name}"):
            if column not in plan.columns:
                plan = plan.withColumn(column, F.lit(None).cast("long"))
    # Without a cut, the budget is not reached: all of the source is in.
    return stored(plan.withColumn("cut_h", F.coalesce("cut_h", F.lit(1 << HASH_BITS))), "thresholds")


def hashes(docs: DataFrame) -> dict[str, Column]:
    """The columns :data:`HASHES` of rows of ``docs (doc_id, text)``. Equal rows differ by their place in the table only."""
    text = F.shiftrightunsigned(F.xxhash64("text"), 64 - HASH_BITS)
    row = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - HASH_BITS)
    return {"h": id_hash(docs["doc_id"]), "text_h": text, "row_h": row}


def plan_mix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sizes of all rows, and target, times and cuts of each source."""
    sizes = stored(docs.select("doc_id", "source", *[column.alias(name) for name, column in hashes(docs).items()],
                               word_count(F.col("text")).alias("size")), "sizes")
    return sizes, thresholds(sizes, budgets(source_targets(sizes)))


def beyond_times(row: str, plan: str) -> Column:
    """1 if a row is taken once more than its source is taken whole, else 0."""
    inside = F.lit(False)
    for name in reversed(HASHES):
        h, cut, edge = F.col(f"{row}.{name}"), F.col(f"{plan}.cut_{name}"), F.col(f"{plan}.edge_{name}")
        inside = F.coalesce(h < cut, F.lit(False)) | (F.coalesce(h == edge, F.lit(False)) & inside)
    return F.when(inside, 1).otherwise(0)


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for each row of ``docs (doc_id, text, source)``.

    A document is taken 0, 1 or 2 times, whole. Rows of one id, or with a null id, are taken alike, but for those of
    the one id at which a source's budget ends: these go by their text, and equal ones by their place in the
    table, so that every source misses its target by half of one document at most. Empty and null texts have size 0 and
    are never taken. The null source is a source like any other. Empty table: no rows.
    """
    sizes, plan = plan_mix(docs)
    rows = sizes.alias("s").join(plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")))
    return rows.select("s.doc_id", "s.size", "p.source_size", "p.target",
                       (F.col("s.size") * (F.col("p.times") + beyond_times("s", "p"))).cast("long").alias("taken"))


def take_mix(docs: DataFrame) -> DataFrame:
    """The rows of the mix: ``docs`` repeated as often as each is taken; columns as they were.

    A document without words adds nothing to the mix; it is kept once if its hash or
    source would take it. Rows equal in id and text are told apart by their place, which is the same in both
    readings of a written table.
    """
    _, plan = plan_mix(docs)
    once = free_name(docs, "copy")
    own = {name: free_name(docs, f"own_{name}") for name in HASHES}
    marked = docs.withColumns({own[name]: column for name, column in hashes(docs).items()})
    rows = marked.select(F.struct(*[F.col(own[name]).alias(name) for name in HASHES]).alias("s"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    joined = rows.join(plan.select(F.struct("*").alias("p")), F.col("d.source").eqNullSafe(F.col("p.source")))
    times = F.col("p.times") + beyond_times("s", "p")
    times = F.when(F.coalesce(F.col("d.text"), F.lit("")).rlike(WORD), times).otherwise(F.least(F.lit(1), times))
    return joined.select("d.*", F.explode(F.array_repeat(F.lit(1), times)).alias(once)).drop(once)
