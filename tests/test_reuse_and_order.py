"""Reuse by manifest, splits with repeated keys, epoch orders by arithmetic, named shards, batches over a stream."""

import os
import random
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.config import CorpusConfig, FeedConfig, VocabularyConfig
from textloom.operators import permutation, trace, user_tables
from textloom.operators.length_ledger import LengthLedger
from textloom.operators.permutation import Permutation
from textloom.operators.split import train_test_split
from textloom.plans import jobs, prepare, queries
from textloom.sources import batch_files, shard_sink, tables, workspace
from textloom.streaming import arrivals, batches, best

SF_DIR = "/root/testdata/sf0.001"


# Reuse -------------------------------------------------------------------------------

def built_at(root):
    """When each result was last written."""
    return {name: os.path.getmtime(f"{root}/{name}/{workspace.MANIFEST}") for name in
            ("prepared/documents", "splits", "tokenizer", "tokenized", "feed/epoch=0/split=train")}


def run_jobs(spark, source, work, corpus, vocabulary):
    jobs.prepare_job(spark, [source], work, corpus)
    jobs.tokenize_job(spark, work, corpus, vocabulary)
    jobs.feed_job(spark, work, 0, 2, corpus, FeedConfig())


def test_a_change_builds_what_depends_on_it(spark, tmp_path, capsys):
    texts, work = str(tmp_path / "texts"), str(tmp_path / "work")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    docs.limit(40).coalesce(1).write.parquet(texts)
    source = tables.Source("documents", texts, keys=("doc_id",))
    corpus, vocabulary = CorpusConfig(shard_rows=200), VocabularyConfig(vocab_size=90)

    def changed(before):
        run_jobs(spark, source, work, corpus, vocabulary)
        now = built_at(work)
        return {name for name in now if name not in before or now[name] != before[name]}, now

    everything, state = changed({})
    assert len(everything) == 5
    same, state = changed(state)
    assert same == set()
    vocabulary = replace(vocabulary, vocab_size=92)
    learned, state = changed(state)
    assert learned == {"tokenizer", "tokenized", "feed/epoch=0/split=train"}
    corpus = replace(corpus, min_chars=70)
    ranged, state = changed(state)
    assert ranged == everything
    assert spark.read.parquet(f"{work}/prepared/documents").where("length(text) < 70").isEmpty()
    corpus = replace(corpus, shard_rows=150)
    sharded, state = changed(state)
    assert sharded == everything - {"prepared/documents"}
    docs.orderBy(F.desc("doc_id")).limit(20).write.mode("append").parquet(texts)
    arrived, state = changed(state)
    assert arrived == everything
    same, _ = changed(state)
    assert same == set()


def test_a_result_without_manifest_is_built_again(spark, tmp_path):
    path = str(tmp_path / "result")
    wanted = workspace.manifest(spark, size=3)
    made = []

    def build():
        made.append(1)
        return spark.range(3)

    for _ in range(2):
        assert workspace.materialize(spark, path, build, wanted).count() == 3
    assert len(made) == 1
    os.remove(f"{path}/{workspace.MANIFEST}")           # a run that stopped between the data and their manifest
    workspace.materialize(spark, path, build, wanted)
    workspace.materialize(spark, path, build, workspace.manifest(spark, size=4))
    assert len(made) == 3


# Splits ------------------------------------------------------------------------------

def sizes(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


@pytest.mark.parametrize("ratios", [(0.8, 0.2), (0.5, 0.2)])
def test_repeated_keys_have_exact_sizes(spark, ratios):
    rows = [(k % 7, f"text {k}", None if k % 3 else k) for k in range(700)]
    df = spark.createDataFrame(rows, "id int, text string, more int").repartition(5)
    out = train_test_split(df, ["id"], *ratios, seed=3).cache()
    assert sizes(out) == {"train": round(700 * ratios[0]), "test": round(700 * ratios[1])}
    again = train_test_split(df.repartition(3), ["id"], *ratios, seed=3)
    assert out.columns == ["id", "text", "more", "split"] and out.exceptAll(again).isEmpty()


def test_null_keys_and_equal_rows(spark):
    df = spark.createDataFrame([(None, f"t{k}") for k in range(50)], "id int, text string")
    assert sizes(train_test_split(df, ["id"], 0.8, 0.2, seed=1)) == {"train": 40, "test": 10}
    equal = spark.createDataFrame([(1, "same")] * 50, "id int, text string")
    with pytest.raises(ValueError, match="equal in all columns"):
        train_test_split(equal, ["id"], 0.8, 0.2, seed=1)


# Epoch orders ------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 99, 100, 101, 1000, 2047])
def test_every_epoch_is_a_permutation(n):
    seen = set()
    for epoch in range(3):
        order = Permutation(n, 42, epoch)
        places = [order.place(x) for x in range(n)]
        assert sorted(places) == list(range(n))
        assert [order.position(y) for y in places] == list(range(n))
        seen.add(tuple(places))
    assert n < 10 or len(seen) == 3
    if n >= 1000:           # no order left: a row's neighbours are spread
        assert sum(abs(a - b) for a, b in zip(places, places[1:])) / n == pytest.approx(n / 3, rel=0.1)


def test_column_is_the_formula_and_moves_no_row(spark, tmp_path):
    path = str(tmp_path / "positions")
    for n in (1, 2, 5, 977, 10_007):
        spark.range(n).withColumnRenamed("id", "pos").coalesce(1).write.mode("overwrite").parquet(path)
        stored = spark.read.parquet(path)
        order = Permutation(n, 7, 2)
        placed = permutation.epoch_positions(stored, n, 7, 2)
        assert {r["pos"]: r["epoch_pos"] for r in placed.collect()} == {x: order.place(x) for x in range(n)}
        assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()


def test_a_batch_is_found_by_arithmetic(spark, tmp_path):
    path, n, world, size = str(tmp_path / "rows"), 1003, 4, 28
    spark.range(n).selectExpr("id AS pos", "concat('row ', id) AS text").write.option("parquet.page.row.count.limit", 50).parquet(path)
    stored = spark.read.parquet(path)
    placed = {r["pos"]: r["epoch_pos"] for r in permutation.epoch_positions(stored, n, 42, 5).collect()}
    at = {place: pos for pos, place in placed.items()}
    all_rows = []
    for rank in range(world):
        share = [at[(k * world + rank) % n] for k in range(-(-n // world))]
        all_rows += share
        for batch in (0, 3, len(share) // size):
            found = permutation.batch_rows(stored, n, 42, 5, batch, size, rank, world)
            got = [r["pos"] for r in sorted(found.collect(), key=lambda r: r["place_in_batch"])]
            assert got == share[batch * size:(batch + 1) * size]
    assert set(all_rows) == set(range(n)) and len(all_rows) == 1004
    assert "PushedFilters: [In(pos" in found._jdf.queryExecution().toString()


# Named shards ------------------------------------------------------------------------

def below(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, files in os.walk(root) for f in files)


def shards(spark, counts):
    rows = [(split, shard, f"{split} {shard} {k}") for (split, shard), n in counts.items() for k in range(n)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "split string, shard_id long, text string").repartition(6)


def test_shards_have_their_names_and_rows(spark, tmp_path):
    root = str(tmp_path / "out")
    counts = {("train", 0): 40, ("train", 1): 39, ("train", 10): 5, ("test", 0): 11}
    shard_sink.write_named_shards(shards(spark, counts), root, order=["text"])
    assert below(root) == ["_SUCCESS", "test/test_shard_0.parquet", "train/train_shard_0.parquet",
                           "train/train_shard_1.parquet", "train/train_shard_10.parquet"]
    for (split, shard), n in counts.items():
        own = tables.read_shard(spark, f"{root}/{split}/{split}_shard_{shard}.parquet")
        assert own.columns == ["text"]
        assert [r["text"] for r in own.collect()] == sorted(f"{split} {shard} {k}" for k in range(n))
    assert sizes(tables.read_plain_splits(spark, root, ["train", "test"])) == {"train": 84, "test": 11}
    # Overwriting takes shards away that are no more; adding must not meet one.
    with pytest.raises(Exception, match="is there already"):
        shard_sink.write_named_shards(shards(spark, {("test", 0): 2, ("test", 5): 2}), root, overwrite=False)
    shard_sink.write_named_shards(shards(spark, {("test", 1): 3}), root, overwrite=False)
    assert "test/test_shard_1.parquet" in below(root) and len(below(root)) == 6
    shard_sink.write_named_shards(shards(spark, {("train", 0): 2}), root)
    assert below(root) == ["_SUCCESS", "train/train_shard_0.parquet"]


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    shard_sink.write_named_shards(shards(spark, {("train", 0): 4}), root)
    broken = shard_sink.named_shards(shards(spark, {("train", k): 20 for k in range(8)})).withColumn(
        "text", F.when((F.col("shard_id") == 5) & F.col("text").endswith(" 19"), F.raise_error(F.lit("broken row")))
        .otherwise(F.col("text")))
    with pytest.raises(Exception, match="broken row"):
        broken.write.format(shard_sink.FORMAT).mode("overwrite").save(root)
    assert below(root) == ["_SUCCESS", "train/train_shard_0.parquet"]
    assert spark.read.parquet(f"{root}/train").count() == 4
    scattered = shards(spark, {("train", 0): 50})           # the rows of a shard in several tasks
    with pytest.raises(Exception, match="two tasks"):
        scattered.write.format(shard_sink.FORMAT).mode("overwrite").save(root)
    assert below(root) == ["_SUCCESS", "train/train_shard_0.parquet"]


def test_no_rows_no_shards(spark, tmp_path):
    shard_sink.write_named_shards(shards(spark, {("train", 0): 1}).limit(0), str(tmp_path / "out"))
    assert below(tmp_path / "out") == ["_SUCCESS"]


# Batches over a stream -----------------------------------------------------------------

def test_batches_are_full_across_files_and_restarts(spark, tmp_path):
    arriving, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))

    def arrive(low, high):
        (spark.range(low, high).selectExpr("concat('s', id % 3 DIV 2) AS split", "id", "array(id, id + 1) AS ids",
                                           "nullif(id % 5, 0) AS maybe")
         .coalesce(1).write.mode("append").parquet(arriving))

    def run(least_triggers=1):
        stream = arrivals.arriving_shards(spark, arriving, "split string, id long, ids array<long>, maybe long", 1)
        arrivals.run_to_end(batches.batches_to(stream, out, checkpoint, ["split"], ["id"], 7), least_triggers)

    arrive(0, 25)
    arrive(25, 30)
    run()
    arrive(30, 101)
    run()                   # a new query from the same checkpoint: the waiting rows are still there
    run(0)                  # nothing has arrived
    rows = spark.read.parquet(out).collect()
    waiting = batches.waiting_rows(spark, checkpoint, ["split"]).collect()
    for split, ids in (("s0", [k for k in range(101) if k % 3 < 2]), ("s1", [k for k in range(101) if k % 3 == 2])):
        own = sorted((r["batch_id"], r["place"], r["id"]) for r in rows if r["split"] == split)
        rest = sorted((r["batch_id"], r["place"], r["id"]) for r in waiting if r["split"] == split)
        assert [x for _, _, x in own + rest] == ids and len(own) % 7 == 0 and len(rest) == len(ids) % 7
        assert [(b, p) for b, p, _ in own + rest] == [divmod(k, 7) for k in range(len(ids))]
    assert all(r["ids"] == [r["id"], r["id"] + 1] and r["maybe"] == (r["id"] % 5 or None) for r in rows + waiting)


class Kept:
    """A state variable."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def put(self, value):
        self.value = value

    update = put

    def clear(self):
        self.value = None


def test_rows_of_a_trigger_are_given_out_in_parts():
    import pandas as pd

    kind = T.StructType([T.StructField("id", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType()))])
    filler = batches.BatchFiller(kind, ["split"], ["id"], 7)
    filler.waiting, filler.next = Kept(), Kept()
    n = 2 * batches._HELD_ROWS + 100
    frames = [pd.DataFrame({"split": "s", "id": ids, "ids": [[k] for k in ids]}) for ids in (list(range(n - 1, 9, -1)), list(range(10)))]
    given = list(filler.handleInputRows(("s",), iter(frames), None))
    assert len(given) >= 3 and max(map(len, given)) <= batches._HELD_ROWS + 7
    rows = [tuple(row) for frame in given for row in frame[["id", "batch_id", "place"]].itertuples(index=False)]
    waiting = [(row[1], filler.next.value[0], row[0]) for row in filler.waiting.value]
    assert rows + waiting == [(k, *divmod(k, 7)) for k in range(n)] and len(waiting) == n % 7


def test_tokenized_rows_arrive_in_files_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(queries, "ARRIVING_ROWS", 30)
    n_rows = queries.tables.read_splits(spark, queries.tokenized_root(spark, SF_DIR)).count()
    roots = []
    shown = arrivals.arriving_shards
    monkeypatch.setattr(arrivals, "arriving_shards", lambda spark, path, *a, **k: roots.append(path) or shown(spark, path, *a, **k))
    got = sorted(tuple(r) for r in queries.stream_batches(spark, SF_DIR).select("split", "batch_id", "rows").collect())
    assert len(spark.read.parquet(roots[0]).inputFiles()) >= -(-n_rows // 30) > 3
    assert got == sorted(tuple(r) for r in queries.feed_batches(spark, SF_DIR).select("split", "batch_id", "rows").collect())


# Best epochs over a stream ----------------------------------------------------------------

def test_best_epochs_of_shuffled_arrivals_and_after_a_restart(spark, tmp_path):
    arriving, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    rng = random.Random(11)
    rows = []
    for run in ("a", "b"):
        for epoch in range(12):
            losses = [rng.uniform(1, 3) + 6 / (epoch + 1) for _ in range(5)]
            if (run, epoch) == ("b", 1):
                losses[2] = float("inf")
            rows += [(run, epoch, split, x, 5) for x in losses for split in ("valid", "train")]
    rng.shuffle(rows)
    schema = "run string, epoch int, split string, loss double, epoch_rows long"

    def run_on(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(arriving)
        stream = arrivals.arriving_shards(spark, arriving, schema, 1)
        arrivals.run_to_end(best.best_epochs_to(stream, out, checkpoint, ["run"]), 0)
        return sorted(tuple(r) for r in spark.read.parquet(out).collect())

    seen = [run_on(rows[:70]), run_on(rows[70:71]), run_on(rows[71:])]
    trace_rows = spark.createDataFrame(rows, schema)
    wanted = sorted(tuple(r) for r in trace.best_epochs(trace.epoch_loss(trace_rows, ["run"]), ["run"]).collect())
    assert [r[:2] for r in seen[-1]] == [r[:2] for r in wanted]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(seen[-1], wanted))
    assert set(seen[0]) <= set(seen[1]) <= set(seen[2]) and len(seen[2]) > 4


# Profiles kept up -----------------------------------------------------------------------

def test_a_ledger_reads_new_files_only(spark, tmp_path):
    root, config = str(tmp_path / "texts of all"), CorpusConfig()
    texts = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").limit(90).collect()] + [None, ""]

    def add(part, name):
        spark.createDataFrame([(t,) for t in part], "body string").coalesce(1).write.mode("append").parquet(f"{root}/{name}")

    def histogram(df):
        return sorted(tuple(r) for r in df.collect())

    def plain(part):
        return histogram(prepare.profile_stages({"d": spark.createDataFrame([(t,) for t in part], "text string")}, config))

    ledger = LengthLedger(spark, str(tmp_path / "ledger"), config)
    sources = {"d": [root]}
    assert ledger.update("d", [root], "body") == 0 and histogram(ledger.profile(sources)) == []
    add(texts[:30], "one")
    assert [ledger.update("d", [root], "body") for _ in range(2)] == [1, 0]
    assert histogram(ledger.profile(sources)) == plain(texts[:30])
    add(texts[30:60], "two")
    add(texts[60:], "three")
    assert LengthLedger(spark, str(tmp_path / "ledger"), config).update("d", [root], "body") == 2
    assert histogram(ledger.profile(sources)) == plain(texts)
    shutil.rmtree(f"{root}/two")            # a source without its middle files
    assert ledger.update("d", [root], "body") == 0
    assert histogram(ledger.profile(sources)) == plain(texts[:30] + texts[60:])
    assert "body" not in ledger.profile(sources)._jdf.queryExecution().executedPlan().toString()


def test_a_ledger_query_takes_tables_of_several_files(spark, tmp_path):
    for name in ("documents", "conversations", "benchmark"):
        table = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        table.repartition(3 if name != "benchmark" else 1).write.parquet(f"{tmp_path}/{name}.parquet")
    got = sorted(tuple(r) for r in queries.ledger_profile(spark, str(tmp_path)).collect())
    assert got == sorted(tuple(r) for r in queries.stage_profile(spark, str(tmp_path)).collect()) and got


# Table functions --------------------------------------------------------------------------

def test_table_functions_take_their_columns_from_the_call(spark):
    user_tables.flat_map(spark, "repeats", lambda value, times=2: [value] * times)
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "k int, word string")
    rows.createOrReplaceTempView("some_words")
    call = "SELECT k, p.* FROM some_words, LATERAL repeats({}) p ORDER BY k, place"
    three = spark.sql(call.format("word, named_struct('times', k), 'again string'"))
    assert three.columns == ["k", "place", "again"]
    assert [tuple(r) for r in three.collect()] == [(1, 0, "a"), (3, 0, ""), (3, 1, ""), (3, 2, "")]
    assert [tuple(r) for r in spark.sql(call.format("k, null, 'n int'")).collect()] == [(k, j, k) for k in (1, 2, 3) for j in (0, 1)]
    for wrong in ("word, null, 'no_type'", "word, 5, 'n int'", "word, null, word"):
        with pytest.raises(Exception, match="column must be|not a name|must be a struct"):
            spark.sql(call.format(wrong)).collect()
    user_tables.batches(spark, "in_batches")
    grouped = spark.sql("SELECT * FROM in_batches(TABLE(SELECT id % 2 AS g, id FROM range(9)) PARTITION BY g ORDER BY (id DESC), 2)")
    assert sorted(tuple(r) for r in grouped.collect()) == sorted(
        (g, x, k // 2, k % 2) for g, ids in ((0, [8, 6, 4, 2, 0]), (1, [7, 5, 3, 1])) for k, x in enumerate(ids))
    assert spark.sql("SELECT * FROM in_batches(TABLE(SELECT id FROM range(0)) PARTITION BY (id), 2)").collect() == []


# Batch files ------------------------------------------------------------------------------

def test_a_trainer_opens_its_batches_at_any_place(spark, tmp_path):
    target = str(tmp_path / "files")
    rows = [(rank, pos, [1000 * rank + pos, pos, 7]) for rank, n in ((0, 100), (1, 95), (3, 5)) for pos in range(n)]
    df = spark.createDataFrame(rows, "rank int, pos long, input_ids array<int>").repartition(7)
    assert batch_files.write_batch_files(df, target, 7, file_batches=4, max_length=3) == 4 + 4 + 1
    assert batch_files.write_batch_files(df, target, 7, file_batches=4, max_length=3) == 9           # a run again leaves the same
    for rank, n in ((0, 100), (1, 95), (3, 5)):
        reader = batch_files.BatchReader(target, rank, file_batches=4)
        wanted = [[[1000 * rank + pos, pos, 7] for pos in range(at, min(at + 7, n))] for at in range(0, n, 7)]
        assert len(reader) == len(wanted)
        for k in (len(wanted) - 1, 0, len(wanted) // 2):
            assert reader.batch(k).column("input_ids").to_pylist() == wanted[k]
        assert [b.column("input_ids").to_pylist() for b in reader.from_batch(len(wanted) // 2)] == wanted[len(wanted) // 2:]
        with pytest.raises(IndexError):
            reader.batch(len(wanted))
    table = {(r["rank"], r["batch_id"]): r["rows"] for r in batch_files.read_batch_files(spark, target).collect()}
    assert len(table) == 15 + 14 + 1 and table[(1, 13)] == [[1000 + pos, pos, 7] for pos in range(91, 95)]
    os.remove(f"{target}/rank=0/{batch_files.file_name(4)}")
    with pytest.raises(ValueError, match="missing"):
        batch_files.BatchReader(target, 0, file_batches=4)
    with pytest.raises(Exception, match="must have 4 ids"):
        batch_files.write_batch_files(df, str(tmp_path / "wrong"), 7, max_length=4)
