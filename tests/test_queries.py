"""Every registered query against its SQL on the smallest tables."""

import math
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry_points
from textloom.plans.oracles import ORACLES
from textloom.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{file}'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def in_order(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


#: Queries that SQL is too slow for: ``test_vocabulary.py`` compares thousands of merges with plain learning.
WITHOUT_SQL = {"bpe_merges_32k"}


def test_every_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(comparable(row[c]) for c in columns) for row in df.collect()]
    result = database.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = [tuple(comparable(row[names.index(c)]) for c in columns) for row in result.fetchall()]
    assert in_order(got) == in_order(expected)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 20


def registered(root, before=""):
    """Names of the queries of the entry module in ``root``, in a process of its own."""
    done = subprocess.run([sys.executable, "-B", "-c", f"import sys\n{before}\nimport __spark_entry__ as e\nprint('NAMES', *e.queries())"],
                          cwd=root, env={**os.environ, "PYTHONPATH": str(root)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.rpartition("NAMES")[2].split())


def test_core_queries_do_not_need_the_rest(tmp_path):
    """Without packages of the training-data operators, and with their folder empty or gone, the core queries are there."""
    root = os.path.dirname(os.path.abspath(entry_points.__file__))
    blocked = "\n".join(f"sys.modules[{name!r}] = None" for name in ("xxhash", "ahocorasick", "tokenizers", "sentencepiece"))
    assert set(QUERIES) <= registered(root, blocked)
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(root, "textloom"), copy / "textloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), copy)
    assert registered(copy) == set(QUERIES)
    (copy / "textloom" / "llm" / "__pycache__").mkdir(parents=True)
    (copy / "corpus_pipeline.py").write_text("from textloom.llm import blob_ledger\n")
    assert registered(copy) == set(QUERIES)
