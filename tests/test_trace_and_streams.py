"""Trace summaries, and streams against batch."""

import math

import pytest
from pyspark.sql import functions as F

from textloom.config import CorpusConfig
from textloom.operators import chunk, encode, trace, word_stats
from textloom.plans import feed, jobs, prepare, queries, tokenizer
from textloom.plans.queries import char_model
from textloom.sources import tables, workspace
from textloom.streaming import arrivals


def losses(spark, values):
    rows = [(epoch, "valid", 0, i, v) for epoch, vs in enumerate(values) for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "epoch int, split string, rank int, batch_idx bigint, loss double")


def test_epoch_loss_is_the_mean_of_all_batches(spark):
    rows = spark.createDataFrame([(0, "train", 0, 0, 1.0), (0, "train", 0, 1, 2.0), (0, "train", 1, 2, 6.0)],
                                 "epoch int, split string, rank int, batch_idx bigint, loss double")
    out = trace.with_perplexity(trace.epoch_loss(rows)).first()
    assert out.loss == 3.0 and out.perplexity == pytest.approx(math.exp(3))


def test_best_epochs_are_strictly_better(spark):
    means = trace.epoch_loss(losses(spark, [[3.0], [3.0], [2.0], [2.5], [1.0]]))
    assert [r.epoch for r in trace.best_epochs(means).orderBy("epoch").collect()] == [0, 2, 4]


def test_best_epochs_are_never_nan_or_infinite(spark):
    nan, inf = math.nan, math.inf
    for values, best in (([nan, 2.0, inf], [1]), ([inf, 2.0, nan, 1.0], [1, 3]), ([nan, nan], []), ([3.0, nan, inf, 3.0, 2.0], [0, 4]),
                         ([-inf, 1.0], [0])):
        means = spark.createDataFrame([(e, "valid", v) for e, v in enumerate(values)], "epoch int, split string, loss double")
        assert [r.epoch for r in trace.best_epochs(means).orderBy("epoch").collect()] == best


def test_history_pages(spark):
    means = trace.epoch_loss(losses(spark, [[float(i)] for i in range(5)]))
    page = trace.loss_history(means).first()
    assert page.losses == [0.0, 1.0, 2.0, 3.0, 4.0] and page.page == 0
    far = means.withColumn("epoch", F.col("epoch") + 998)
    assert [len(r.losses) for r in trace.loss_history(far).orderBy("page").collect()] == [2, 3]
    assert [len(r.losses) for r in trace.loss_history(far, epochs_per_list=5_000).collect()] == [5]


def test_sample_trace_in_epoch_order(spark):
    rows = spark.createDataFrame([(1, "p", 1, "b"), (1, "p", 0, "a"), (2, "q", 0, "c")],
                                 "prompt_id bigint, prompt string, epoch int, generated string")
    assert {r.prompt: r.generated for r in trace.sample_trace(rows).collect()} == {"p": ["a", "b"], "q": ["c"]}


def test_sample_trace_bounds_prompts_of_many_samples(spark):
    rows = spark.createDataFrame([(1, "p", k // 4, f"{k:02d}") for k in range(23)],
                                 "prompt_id bigint, prompt string, epoch int, generated string")
    pages = [r.generated for r in trace.sample_trace(rows, samples_per_list=10).orderBy("page").collect()]
    assert [len(p) for p in pages] == [10, 10, 3] and sum(pages, []) == [f"{k:02d}" for k in range(23)]


def test_duration_and_report(spark):
    times = spark.sql("""select 4 as epoch, timestamp_ntz '2024-01-01 00:00:00' as ts
                         union all select 4, timestamp_ntz '2024-01-01 01:01:59.999'""")
    spent = trace.epoch_duration(times)
    assert spent.select("minutes", "seconds").first() == (61, 59)
    batches = spark.sql("""select 4 as epoch, 'train' as split, 0.25D as loss, timestamp_ntz '2024-01-01 00:00:00' as ts
                           union all select 4, 'train', 0.75D, timestamp_ntz '2024-01-01 00:30:00'
                           union all select 4, 'valid', 0.54555D, timestamp_ntz '2024-01-01 01:01:59.999'
                           union all select 5, 'valid', 0.5D, null""")
    report = trace.epoch_report(batches, 50).orderBy("epoch")
    out, timeless = report.collect()
    assert timeless.line.startswith("Epoch: 06/50, 0m 0s ::")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert out.line == (f"Epoch: 05/50, 61m 59s ::Train Loss: {0.5:<8.4f}, Train PPL: {math.exp(.5):<8.4f}"
                        f" | Valid Loss: {0.54555:<8.4f}, Valid PPL: {math.exp(.54555):<8.4f}")
    assert out.checkpoint == f"epoch-04-valid_loss-{0.54555:0>7.4f}.pt"


@pytest.fixture(scope="module")
def shard_dir(spark, tmp_path_factory):
    """Five files of documents, one source holding most rows."""
    root = str(tmp_path_factory.mktemp("arriving") / "documents")
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    df.repartition(5).write.parquet(root)
    return root


def chunks(df):
    return chunk.split_long_texts(df, ["doc_id"], 62, 126)


def test_streams_equal_batch(spark, shard_dir, tmp_path):
    batch = spark.read.parquet(shard_dir)
    arriving = arrivals.arriving_shards(spark, shard_dir, batch.schema, 1)
    model = char_model(word_stats.word_counts(chunks(batch)))
    keys = ("doc_id", "part_idx")

    out = str(tmp_path / "tokens")
    arrivals.append_to(encode.tokenize_corpus(chunks(arriving), model, 128, keys=keys), out,
                       str(tmp_path / "c1")).awaitTermination()
    expected = encode.tokenize_corpus(chunks(batch), model, 128, keys=keys)
    assert sorted(spark.read.parquet(out).collect()) == sorted(expected.collect())

    counts = str(tmp_path / "counts")
    arrivals.run_to_end(arrivals.count_words_to(chunks(arriving), counts, str(tmp_path / "c2"), triggers_per_base=2), 5)
    assert workspace.names_in(spark, f"{counts}/changes") == ["batch_id=4"]     # five triggers, two in each base
    assert workspace.names_in(spark, f"{counts}/base") == ["upto=3"]
    assert sorted(arrivals.latest_counts(spark, counts).collect()) == sorted(
        word_stats.word_counts(chunks(batch)).collect())


def test_more_documents_arrive_in_more_files_not_in_larger_ones(spark, tmp_path, monkeypatch):
    spark.range(600).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 12) AS text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    size = sum(f.stat().st_size for f in (tmp_path / "documents.parquet").glob("*.parquet"))
    monkeypatch.setattr(queries, "ARRIVING_BYTES", size // 10)
    rows = queries.stream_chunk(spark, str(tmp_path))
    arrived = spark.read.parquet(queries._place(spark, str(tmp_path), "arriving-documents"))
    a_file = [r["count"] for r in arrived.groupBy(F.input_file_name()).count().collect()]
    assert sum(a_file) == 600 and max(a_file) <= 60
    assert sorted(tuple(r) for r in rows.collect()) == sorted(tuple(r) for r in queries.chunks(spark, str(tmp_path)).collect())


def test_a_restarted_stream_reads_only_new_files(spark, shard_dir, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "chk"))
    batch = spark.read.parquet(shard_dir)
    first, second = batch.filter("doc_id % 2 = 0"), batch.filter("doc_id % 2 = 1")
    for part in (first, second):
        part.write.mode("append").parquet(source)
        arriving = arrivals.arriving_shards(spark, source, batch.schema)
        arrivals.append_to(chunks(arriving), out, checkpoint).awaitTermination()
    assert sorted(spark.read.parquet(out).collect()) == sorted(chunks(batch).collect())


def test_from_sources_to_tokenized_shards(spark, shard_dir, tmp_path):
    config = CorpusConfig(shard_rows=50)
    root, target = str(tmp_path / "splits"), str(tmp_path / "tokenized")
    source = prepare.prepare_source(spark.read.parquet(shard_dir), ["doc_id"], str(tmp_path / "prepared"), config)
    prepare.combine_sources(spark, {"documents": source, "again": source}, ["doc_id"], root, config)
    prepared = tables.read_splits(spark, root)
    assert prepared.count() == 2 * source.count()
    shards = prepared.groupBy("split", "shard_id").count().collect()
    assert max(r["count"] for r in shards) <= 50
    test_rows = sum(r["count"] for r in shards if r.split == "test")
    assert test_rows == math.ceil(.2 * prepared.count())

    model = char_model(word_stats.word_counts(prepared))
    tokenizer.tokenize_splits(spark, root, target, model, config)
    done = tables.read_splits(spark, target)
    assert sorted(done.groupBy("split", "shard_id").count().collect()) == sorted(shards)
    assert done.filter(F.size("input_ids") != config.max_length).count() == 0
    # Texts of at most 126 characters are never cut.
    assert done.filter(~F.array_contains("input_ids", 3)).count() == 0


def test_jobs_from_the_command_line(spark, shard_dir, tmp_path, capsys):
    work = str(tmp_path / "work")
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.txt").write_text("\n".join(["short", "x" * 80, "y" * 100, "x" * 80]))
    data = "/root/testdata/sf0.001"
    jobs.main(["prepare", "--source", f"documents={shard_dir}?key=doc_id", "--source", f"unnamed={shard_dir}",
               "--source", f"talks={data}/conversations.parquet?key=conv_id,turn",
               "--source", f"benchmark={data}/benchmark.parquet?key=item_id", "--source", f"lines={lines}?format=text",
               "--work", work, "--shard-rows", "40"])
    printed = capsys.readouterr().out
    assert "documents raw: Length distribution (total count: 200):\ndocuments raw: Length: " in printed
    assert "lines: 4 rows, 0 without text; prepared: row_id, part_idx, text, 3 rows" in printed
    splits = tables.read_splits(spark, f"{work}/splits")
    assert {r.corpus for r in splits.select("corpus").distinct().collect()} == {
        "documents", "unnamed", "talks", "benchmark", "lines"}
    assert splits.select("corpus", "row_id", "part_idx").distinct().count() == splits.count()
    for _ in range(2):
        jobs.main(["tokenize", "--work", work, "--vocab-size", "100"])
    done = tables.read_splits(spark, f"{work}/tokenized")
    assert done.count() == splits.count()
    assert spark.read.parquet(f"{work}/tokenizer/vocab").count() == 100

    jobs.main(["feed", "--work", work, "--epoch", "2", "--world-size", "3", "--batch-size", "10"])
    for split in ("train", "test"):
        ids = [r.input_ids for r in done.filter(F.col("split") == split).collect()]
        shares = [[row for b in feed.read_rank(spark, f"{work}/feed", 2, split, rank).collect() for row in b.rows]
                  for rank in range(3)]
        assert len({len(s) for s in shares}) == 1 and len(shares[0]) == math.ceil(len(ids) / 3)
        dealt = sorted(map(tuple, sum(shares, [])))
        assert set(dealt) == set(map(tuple, ids)) and len(dealt) - len(ids) in (0, 1, 2)
        sizes = [len(b.rows) for b in feed.read_rank(spark, f"{work}/feed", 2, split, 0).collect()]
        assert all(n == 10 for n in sizes[:-1])


def test_sources_need_a_name_and_a_path():
    source = tables.Source.parse("a=/x/y?key=k,l&format=json&column=body")
    assert source == tables.Source("a", "/x/y", "json", "body", ("k", "l"))
    for wrong in ("a", "=x", "a=", "a=x?kye=b"):
        with pytest.raises(ValueError):
            tables.Source.parse(wrong)


def test_ids_of_keyless_sources_hold(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ntwo\ntwo\n")
    source = tables.Source("a", str(tmp_path / "in"), "text", "value")
    first = tables.keyed_texts(spark, source, str(tmp_path / "kept"))
    rows = sorted(first.collect())
    assert [r.text for r in rows] == ["one", "two", "two"] and len({r.row_id for r in rows}) == 3
    assert rows == sorted(tables.keyed_texts(spark, source, str(tmp_path / "kept")).collect())
