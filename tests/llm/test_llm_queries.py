"""Registered queries against their SQL, and the pipeline against the operators' own results."""

import os

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from textloom.llm import oracles, queries

duckdb = pytest.importorskip("duckdb")
SF_DIR = "/root/testdata/sf0.001"
MORE = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for file in os.listdir(SF_DIR):
        database.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF_DIR}/{file}'")
    result = database.execute(oracles.ORACLES[name])
    names = [d[0] for d in result.description]
    df = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str(tuple(r[c] for c in names)) for r in df.collect()) == sorted(map(str, result.fetchall()))


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_points.queries())


def test_stages_of_the_pipeline(spark):
    docs = queries.table(spark, MORE, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    seen = [before]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, MORE)
        assert out.columns == docs.columns
        out.write.mode("overwrite").parquet(path := _place(spark, len(seen)))
        docs = spark.read.parquet(path)
        rows = docs.collect()
        seen.append({r["doc_id"]: r for r in rows})
    good, single, masked, mixed = seen[1:]
    predicted = {r["doc_id"] for r in queries.QUERIES["op2_quality_trees"](spark, MORE).collect() if r["predicted"] == 1}
    assert set(good) == predicted and good.items() <= before.items()
    assert set(single) < set(good) and len({r["text"] for r in single.values()}) == len(single)
    assert set(masked) == set(single)
    changed = [d for d in masked if masked[d] != single[d]]
    assert changed and all("[secret]" in masked[d]["text"] and masked[d]["n_chars"] == len(masked[d]["text"]) for d in changed)
    assert mixed.items() <= masked.items()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, MORE).collect()
    assert len(last) == docs.count() and all(r["exact"] for r in last)


def test_whole_pipeline(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 100


def _place(spark, k):
    from textloom.sources import workspace

    return workspace.scratch_path(spark, f"stage-{k}")
