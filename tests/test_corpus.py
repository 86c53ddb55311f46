"""Chunking, profiles, set operations, sources and sinks on small frames."""

import weakref

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.config import CorpusConfig
from textloom.operators import chunk, combine, profile
from textloom.operators.user_batches import map_batches
from textloom.plans import prepare
from textloom.sources import tables, workspace


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id bigint, text string")


def split(spark, values, low=62, high=126):
    rows = chunk.split_long_texts(texts(spark, values), ["id"], low, high).collect()
    return sorted((r.id, r.part_idx, r.text) for r in rows)


def test_length_limits_are_inclusive(spark):
    values = ["x" * n for n in (61, 62, 126, 127)]
    assert [r[0] for r in split(spark, values)] == [1, 2]


def test_over_long_text_gives_its_fitting_lines(spark):
    text = "\n".join("abc"[i] * n for i, n in enumerate((10, 70, 200)))
    assert split(spark, [text]) == [(0, 1, "b" * 70)]


def test_fitting_text_keeps_its_newlines(spark):
    text = "a" * 40 + "\n" + "b" * 39
    assert split(spark, [text]) == [(0, 0, text)]


def test_carriage_returns_and_code_points_count(spark):
    line = "é😀" * 31
    assert split(spark, [line + "\r\n" + "z" * 70]) == [(0, 0, line + "\r"), (0, 1, "z" * 70)]


def test_empty_lines_are_parts(spark):
    rows = chunk.newline_parts(texts(spark, ["\na\n\nb\n"]), ["id"]).orderBy("part_idx").collect()
    assert [r.text for r in rows] == ["", "a", "", "b", ""]


def test_null_and_empty_input(spark):
    assert split(spark, [None, ""]) == []
    empty = texts(spark, ["x"]).filter("false")
    assert prepare.profile(empty, CorpusConfig()).collect() == []
    assert chunk.part_outcomes(empty, 62, 126).collect() == []


def test_part_outcomes_add_up(spark):
    values = ["s", "x" * 70, "\n".join(["y" * 70, "z" * 200, "w"]), None]
    counts = {r.outcome: r.parts for r in chunk.part_outcomes(texts(spark, values), 62, 126).collect()}
    assert counts == {"kept": 2, "too_short": 2, "too_long": 1}


@pytest.mark.parametrize("lengths", [
    [3, 3, 4, 5, 7, 8, 8], [5, 5], [1], list(range(100)), [0, 1000, 999, 500, 500, 31]])
def test_histogram_equals_numpy(spark, lengths):
    df = texts(spark, ["x" * n for n in lengths])
    rows = prepare.profile(df, CorpusConfig()).orderBy("bin_idx").collect()
    edges = np.linspace(min(lengths), max(lengths), 21).astype(np.int64)
    counts, _ = np.histogram(lengths, bins=edges)
    assert [r.cnt for r in rows] == counts.tolist()
    assert [r.lo for r in rows] + [rows[-1].hi] == edges.tolist()
    assert [r.pct for r in rows] == pytest.approx([c / len(lengths) * 100 for c in counts])


def test_report_line(spark):
    df = texts(spark, ["x" * n for n in (1000, 1000, 3000)])
    lines = [r.line for r in profile.length_report(prepare.profile(df, CorpusConfig())).orderBy("bin_idx").collect()]
    assert lines[0] == "Length distribution (total count: 3):"
    assert lines[1] == "Length: 1,000 - 1,100, Counts: 2, Percentage: 66.666667%"


def test_stage_profiles_equal_single_profiles(spark):
    config = CorpusConfig(min_chars=3, max_chars=6)
    sources = {"a": texts(spark, ["x" * n for n in (2, 4, 40)] + ["yyy\nzzzzz\nw", None]),
               "b": texts(spark, ["x" * n for n in (5, 5)])}
    staged = prepare.profile_stages(sources, config)
    parts = {name: chunk.split_long_texts(df, ["id"], 3, 6) for name, df in sources.items()}
    expected = {"a raw": sources["a"], "b raw": sources["b"], "a chunks": parts["a"], "b chunks": parts["b"],
                "combined": parts["a"].unionAll(parts["b"])}
    for stage, df in expected.items():
        got = staged.filter(F.col("stage") == stage).drop("stage").collect()
        assert sorted(got) == sorted(prepare.profile(df, config).collect()), stage
    assert staged.select("stage").distinct().count() == len(expected)


def test_combining_keeps_duplicates(spark):
    a = texts(spark, ["p", "q"])
    both = combine.combine_corpora({"one": a, "two": a})
    assert sorted((r.corpus, r.text) for r in both.collect()) == [
        ("one", "p"), ("one", "q"), ("two", "p"), ("two", "q")]


def test_plain_and_partitioned_layouts(spark, tmp_path):
    plain = tmp_path / "plain"
    texts(spark, ["p", "q"]).write.parquet(str(plain / "train"))
    texts(spark, ["r"]).write.parquet(str(plain / "test"))
    (plain / "notes").mkdir()
    (plain / "notes" / "readme.txt").write_text("no table here")
    got = tables.read_plain_splits(spark, str(plain)).select("split", "text")
    assert sorted(map(tuple, got.collect())) == [("test", "r"), ("train", "p"), ("train", "q")]
    assert tables.read_plain_splits(spark, str(plain), ["test"]).count() == 1

    tables.write_splits(got, str(tmp_path / "parts"), 1)
    again = tables.read_splits(spark, str(tmp_path / "parts"))
    assert sorted(map(tuple, again.select("split", "text").collect())) == sorted(map(tuple, got.collect()))
    assert len(list((tmp_path / "parts" / "split=train").glob("*.parquet"))) == 2


def test_text_corpus_lines(spark, tmp_path):
    tables.write_text(texts(spark, ["a\nb", "", "c\r"]), str(tmp_path / "lines"))
    assert sorted(r.line for r in tables.read_lines(spark, str(tmp_path / "lines")).collect()) == ["", "a", "b", "c\r"]


def test_json_and_text_sources(spark, tmp_path):
    texts(spark, ["p", "q"]).write.json(str(tmp_path / "j"))
    df = tables.read_corpus(spark, str(tmp_path / "j"), "json", "id bigint, text string")
    assert sorted(map(tuple, df.collect())) == [(0, "p"), (1, "q")]


def test_finished_results_are_reused_and_unfinished_ones_rebuilt(spark, tmp_path):
    path = str(tmp_path / "result")
    built = []

    def build():
        built.append(1)
        return texts(spark, ["a"])

    workspace.materialize(spark, path, build)
    assert workspace.materialize(spark, path, build).count() == 1
    assert len(built) == 1
    (tmp_path / "result" / "_SUCCESS").unlink()
    workspace.materialize(spark, path, build)
    assert len(built) == 2


def test_only_scratch_tables_can_be_removed(spark, tmp_path):
    with pytest.raises(ValueError):
        workspace.remove(spark, str(tmp_path))


def test_user_functions_on_batches(spark):
    df = texts(spark, ["a", "bb", "ccc", "dddd", "eeeee"]).coalesce(1)

    def sizes(batch, extra):
        return {"n": [len(t) + extra for t in batch["text"]], "batch_rows": [len(batch["text"])] * len(batch["text"])}

    got = map_batches(df, sizes, "n int, batch_rows int", 2, {"extra": 10})
    assert got.columns == ["id", "text", "n", "batch_rows"]
    assert [(r.n, r.batch_rows) for r in got.orderBy("id").collect()] == [(11, 2), (12, 2), (13, 2), (14, 2), (15, 1)]

    def letters(batch):
        return {"letter": [c for t in batch["text"] for c in t]}

    many = map_batches(df, letters, "letter string", remove_columns=["id", "text"])
    assert many.count() == 15


@pytest.mark.parametrize("rows_per_arrow_batch, bytes_per_arrow_batch", [("10000", "268435456"), ("7", "268435456"), ("10000", "20000")])
@pytest.mark.parametrize("size", [3_000, 20_000])
def test_user_batches_are_full_whatever_arrives(spark, size, rows_per_arrow_batch, bytes_per_arrow_batch):
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows_per_arrow_batch,
                "spark.sql.execution.arrow.maxBytesPerBatch": bytes_per_arrow_batch}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(25_000).repartition(1)
        got = map_batches(df, lambda batch: {"n": [len(batch["id"])]}, "n int", size, remove_columns=["id"])
        sizes = [r.n for r in got.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sizes == [size] * (25_000 // size) + [25_000 % size]


def test_a_batch_is_let_go_before_the_next_one():
    class Frame:
        schema = T.StructType([T.StructField("id", T.LongType())])

        def mapInArrow(self, function, schema):
            return function

    class Column(list):
        pass

    made, alive = [], []

    def function(batch):
        alive.append(sum(1 for ref in made if ref() is not None))
        column = Column(batch["id"])
        made.append(weakref.ref(column))
        return {"n": column}

    run = map_batches(Frame(), function, T.StructType([T.StructField("n", T.LongType())]), 2, remove_columns=["id"])
    given = list(run(iter([pa.RecordBatch.from_pydict({"id": list(range(7))})])))
    assert [b.num_rows for b in given] == [2, 2, 2, 1] and alive == [0, 0, 0, 0]
