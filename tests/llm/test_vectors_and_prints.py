"""Links, fingerprints and components against brute force."""

import collections
import os

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import golay_simhash as gs
from textloom.llm import pivot_index as pi
from textloom.llm import queries
from textloom.llm.components import components

SF_DIR = "/root/testdata/sf0.001"
CHECK_DIR = "/root/testdata/check_s"


def roots_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# Components ----------------------------------------------------------------------

def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(205, 203), (203, 201), (201, 205)]
    links += [(7, 7), (300, 301), (301, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for link in links for n in link}
    expected = {n: r for n, r in roots_of(nodes, links).items() if n != r}
    assert got == expected


def test_components_without_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(1, None), (2, 2)], "a long, b long")).count() == 0


# Vectors ------------------------------------------------------------------------------

def brute_vectors(rows, threshold=pi.THRESHOLD):
    def usable(row):
        v, e, label = row
        return (v is not None and label is not None and e is not None and None not in e and np.isfinite(e).all()
                and any(e))

    good = [k for k, row in enumerate(rows) if usable(row)]
    links = collections.defaultdict(set)
    for x, i in enumerate(good):
        for j in good[x + 1:]:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if rows[i][2] == rows[j][2] and len(a) == len(b) and \
                    a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links[i].add(j)
                links[j].add(i)
    ids = {rows[i][0] for i in good}
    root = roots_of(ids, [(rows[i][0], rows[j][0]) for i in links for j in links[i]])
    return [(v, len(links[k]), root[v] if k in good else v) for k, (v, _, _) in enumerate(rows)]


def in_groups(n, dim, seed, spread=0.02, groups=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    rows = []
    for k in range(n):
        own = centres[k % groups] if k % 3 else rng.normal(size=dim)
        vector = own / np.linalg.norm(own) + spread * rng.normal(size=dim)
        rows.append((k, [float(np.float32(x)) for x in vector], int(k % 3)))
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block_rows", [1024, 7])
def test_vectors_against_brute_force(spark, block_rows):
    rows = in_groups(260, 32, seed=1)
    rows += [(1000 + k, rows[4][1], rows[4][2]) for k in range(9)]          # copies
    got = pi.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA), block_rows=block_rows).collect()
    expected = {v: (n, c) for v, n, c in brute_vectors(rows)}
    assert len(got) == len(rows)
    found, there = sum(r["n_links"] for r in got), sum(n for n, _ in expected.values())
    assert there > 500 and 0.95 * there <= found <= there
    assert all(r["n_links"] <= expected[r["vec_id"]][0] for r in got)
    assert sum(r["component_id"] == expected[r["vec_id"]][1] for r in got) >= 0.97 * len(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_vectors_that_link_with_nothing(spark):
    one = [0.5, 0.25, -0.5, 1.0]
    rows = [(1, one, 1), (2, [2 * x for x in one], 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [0.0] * 4, 1),
            (7, [1.0, None, 0.0, 0.0], 1), (8, [float("nan")] * 4, 1), (9, [float("inf"), 0.0, 0.0, 0.0], 1),
            (10, [-x for x in one], 1), (11, one[:3], 1), (12, one, 1), (None, one, 1), (13, [], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as node", "2 as pivot", "3 as root")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"])
                 for r in pi.near_duplicate_vectors(df).collect())
    assert got == [(0, 0, None, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True),
                   (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True),
                   (10, 0, 10, True), (11, 0, 11, True), (12, 2, 1, False), (13, 0, 13, True)]


def test_no_vectors(spark):
    assert pi.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def one_group(n, grouped, dim=64, noise=0.24, seed=3):
    """Vectors of one label, the first ``grouped`` of them distinct near copies of one point."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centre = rng.normal(size=dim)
    x[:grouped] = centre / np.linalg.norm(centre) + noise * x[:grouped]
    return x.astype(np.float32)


@pytest.mark.parametrize("n, grouped", [(3000, 1000), (300, 300)])
def test_recall_in_a_large_group_of_near_copies(spark, n, grouped):
    x = one_group(n, grouped)
    rows = [(k, [float(v) for v in x[k]], 1) for k in range(n)]
    got = {r["vec_id"]: r for r in pi.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = (unit @ unit.T >= pi.THRESHOLD).sum(axis=1) - 1
    assert links.sum() > 0.5 * grouped ** 2
    assert all(got[k]["n_links"] <= links[k] for k in range(n))
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * links.sum()
    assert all(got[k]["component_id"] == (0 if k < grouped else k) for k in range(n))


def test_vectors_of_many_lengths(spark):
    rows = [(100 * dim + k, [1.0] * (dim - 1) + [1.0 + 0.01 * k], 1) for dim in range(2, 72) for k in range(2)]
    got = pi.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in got} == {(v, 1, v - v % 100) for v, _, _ in rows}


def test_no_two_pivots_are_near(spark):
    x = one_group(700, 400).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    kept = pi.spread_out(x)
    cosines = kept @ kept.T
    np.fill_diagonal(cosines, 0)
    assert cosines.max() < pi.PIVOT_COSINE and (x @ kept.T).max(axis=1).min() >= pi.PIVOT_COSINE
    assert 300 < len(kept) < 320


def test_one_id_in_two_labels_and_with_two_vectors(spark):
    one, near, other = [1.0, 0.0, 0.0, 0.0], [1.0, 0.1, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]
    rows = [(1, one, 1), (1, near, 2), (2, near, 1), (3, one, 2), (4, other, 1), (4, one, 3), (5, other, 1), (5, near, 4)]
    got = sorted(tuple(r) for r in pi.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == sorted((v, n, c, v == c) for v, n, c in brute_vectors(rows))
    assert [n for v, n, *_ in got if v == 1] == [1, 1]


def test_shared_pivots_are_counted():
    rng = np.random.default_rng(2)
    left, right = (np.array([rng.choice(30, 8, replace=False) for _ in range(n)]) for n in (40, 25))
    wanted = [[len(set(x) & set(y)) for y in right.tolist()] for x in left.tolist()]
    assert pi.shared_pivots(left, right).tolist() == wanted


def test_recall_on_a_table_with_planted_links(spark):
    """Near copies of every fourth vector of the largest given table, and a large group of them; cosines from 0.93 up."""
    local = queries.table(spark, "/root/testdata/sf0.1", "embeddings").toPandas()
    rng = np.random.default_rng(9)
    x = np.array(local["embedding"].tolist(), dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels, dim = local["label"].to_numpy(), x.shape[1]

    def copies(of, spread):
        noise = rng.normal(size=(len(of), dim))
        noise /= np.linalg.norm(noise, axis=1, keepdims=True)
        return x[of] + spread[:, None] * noise

    every, group = np.arange(0, len(x), 4), np.full(len(x) // 4, 7)
    x = np.concatenate([x, copies(every, rng.uniform(0, 0.4, len(every))), copies(group, rng.uniform(0.1, 0.27, len(group)))]).astype(np.float32)
    labels = np.concatenate([labels, labels[every], labels[group]])
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = np.zeros(len(x), dtype=int)
    for label in set(labels):
        own = np.flatnonzero(labels == label)
        links[own] = (unit[own] @ unit[own].T >= pi.THRESHOLD).sum(axis=1) - 1
    rows = [(k, [float(v) for v in x[k]], int(labels[k])) for k in range(len(x))]
    got = {r["vec_id"]: r["n_links"] for r in pi.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect()}
    assert (links > 0).sum() > 0.4 * len(x) and all(got[k] <= links[k] for k in range(len(x)))
    assert sum(got.values()) >= 0.95 * links.sum()
    outside = [k for k in range(len(x)) if links[k] < 50]
    assert sum(got[k] for k in outside) >= 0.95 * links[outside].sum()


# Golay code and fingerprints --------------------------------------------------------

def test_golay_code_is_perfect():
    parity, errors = gs.golay_tables()
    words = np.arange(1 << 23, dtype=np.int64)
    home = gs.nearest_codeword(words, parity, errors)
    codewords = np.arange(4096, dtype=np.int64) << 11 | parity
    apart = np.bitwise_count(words ^ codewords[home])
    assert apart.max() == 3 and len(np.unique(home)) == 4096


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=3))
def test_near_fingerprints_share_a_key(value, bits):
    other = value
    for b in bits:
        other ^= 1 << b
    pair = np.array([value, other], dtype=np.uint64).view(np.int64)
    filed, rows, keys = gs.file_keys(pair, gs.golay_tables())
    assert set(filed[1]) & set(keys[rows == 0]) and set(filed[0]) & set(keys[rows == 1])
    assert len(set(keys[rows == 0])) == len(keys[rows == 0])


def plain_fingerprint(text):
    import re

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_prints(docs):
    prints = [(d, plain_fingerprint(t)) for d, t in docs]
    links = [(a, b) for k, (a, x) in enumerate(prints) for b, y in prints[k + 1:] if (x ^ y).bit_count() <= 3]
    root = roots_of({d for d, _ in prints}, links)
    return {d: (f"{x:016x}", root[d]) for d, x in prints}


TEXTS = [None, "", "  \n", "one", "One", "one two", "one two three", "a b c d e", "Ä b\x0bc\x1cd É f", "x " * 3000,
         "x " * 3001, "word word x y z"]


def test_fingerprints_of_odd_texts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "7 as fp", "8 as root")
    got = {r["doc_id"]: (f"{r['fp'] & (2**64 - 1):016x}", r["component_id"]) for r in gs.near_duplicates(df).collect()}
    assert got == brute_prints(list(enumerate(TEXTS)))


def test_near_duplicates_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF_DIR, "documents").collect()]
    rng = np.random.default_rng(5)
    for k in range(120):                                   # near copies of one long text, and copies
        words = docs[2][1].split() * 4
        words[rng.integers(len(words))] = f"w{k % 40}"
        docs.append((10_000 + k, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (f"{r['fp'] & (2**64 - 1):016x}", r["component_id"]) for r in gs.near_duplicates(df).collect()}
    expected = brute_prints(docs)
    assert got == expected
    assert len({c for _, c in expected.values()}) < len(docs) - 100


def test_groups_of_planted_fingerprints(spark):
    rng = np.random.default_rng(9)
    prints = set()
    for _ in range(60):
        value = int(rng.integers(0, 2**63)) * 2 + 1
        for _ in range(int(rng.integers(1, 12))):           # chains of near ones
            prints.add(value)
            for b in rng.choice(64, size=int(rng.integers(0, 5)), replace=False):
                value ^= 1 << int(b)
    values = sorted(prints)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    links = [(signed[i], signed[j]) for i in range(len(values)) for j in range(i + 1, len(values))
             if (values[i] ^ values[j]).bit_count() <= 3]
    classes = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r["fp"]: r["root"] for r in gs.link_fingerprints(classes).collect()}
    expected = roots_of(signed, links)
    assert {frozenset(n for n in signed if got.get(n, n) == r) for r in set(expected.values())} \
        == {frozenset(n for n in signed if expected[n] == r) for r in set(expected.values())}


def test_one_of_each_stays(spark):
    long = " ".join(f"word{k}" for k in range(400))
    rows = [(5, long, "a", 1), (3, long, "b", 2), (3, long, "b", 2), (9, long + " word", "a", 3),
            (4, "something else entirely here", None, 4), (None, "no id but words of its own", "c", 5), (1, None, "x", 6),
            (2, "", "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, fp long")
    got = gs.keep_one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["fp"]) for r in got.collect()) == [(0, 5), (1, 6), (3, 2), (4, 4)]
    assert gs.keep_one_of_each(docs.limit(0)).count() == 0


def test_rows_that_stay_are_joined_alike_at_any_size(spark):
    """Few numbers are not broadcast: the plan, and so the disk for each text, is that of a large table."""
    docs = spark.createDataFrame([(k, f"some words of text {k // 2}") for k in range(20)], "doc_id long, text string")
    kept = gs.keep_one_of_each(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert kept.count() == 10


def test_which_of_equal_ids_stays_does_not_depend_on_the_partitions(spark):
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(1, text.upper(), 1), (1, text, 2), (1, text, 3), (1, text.title(), 4), (None, text, 0)]        # one fingerprint
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    kept = {tuple(gs.keep_one_of_each(docs.repartition(n)).collect()) for n in (1, 3, 7)}
    assert len(kept) == 1 and next(iter(kept))[0]["doc_id"] == 1


def test_one_of_each_stays_in_groups_of_one_smallest_id(spark):
    texts = [" ".join(f"{mark}{k}" for k in range(300)) for mark in ("north", "south", "east", "west", "up")]
    rows = [(None, texts[0], 1), (None, texts[0], 1), (None, texts[1], 2), (None, texts[2], 3),
            (7, texts[3], 4), (8, texts[3], 5), (7, texts[4], 6), (9, texts[4], 7), (None, texts[4], 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    assert sorted(r["row"] for r in gs.keep_one_of_each(docs).collect()) == [1, 2, 3, 4, 6]
