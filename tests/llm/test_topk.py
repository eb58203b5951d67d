import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import topk
from millrace.llm.queries import QUERIES

SCHEMA = "vec_id long, vector array<long>"


def brute_force(queries, rows, k):
    expected = {}
    for q, vector in queries.items():
        scores = [
            (-sum(a * b for a, b in zip(vector, other)), i) for i, other in rows if i != q
        ]
        expected[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return {q: best for q, best in expected.items() if best}


def results(frame):
    found = {}
    for r in frame.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def test_query_equals_brute_force(spark):
    found = results(QUERIES["op3_maxscore"](spark, "/root/testdata/sf0.01"))
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    rows = [(r["vec_id"], [math.floor(256 * x) for x in r["embedding"]]) for r in table]
    queries = {i: v for i, v in rows if i % 50 == 0}
    assert found == brute_force(queries, rows, 5)


@pytest.mark.parametrize("low,high", [(0, 4), (-4, 4), (-9, -1)])
def test_sparse_ties_and_signs(spark, low, high):
    rng = random.Random(high)
    rows = [
        (i, [rng.randint(low, high) if rng.random() < 0.3 else 0 for _ in range(12)])
        for i in range(900)
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = topk.top_k(frame.where("vec_id % 30 = 0"), frame, k=4, shard_rows=700)
    assert results(found) == brute_force({i: v for i, v in rows if i % 30 == 0}, rows, 4)


def test_essential_postings_lead_to_the_competitive_rows():
    rng = np.random.default_rng(1)
    rows = rng.integers(-4, 5, (400, 20))
    query = np.zeros(20, np.int64)
    query[:5] = [50, 1, -1, 1, -2]
    scores = rows @ query
    block = topk.Block(np.arange(400), rows)
    for least in (195, 60, 0, -90):
        kept, found, read = block.competitive(query, least)
        assert set(kept) == set(np.flatnonzero(scores >= least))
        assert found.tolist() == scores[kept].tolist()
        assert least != 195 or read == (rows[:, 0] > 0).sum()
    kept, found, read = block.competitive(query, None)
    assert kept.tolist() == list(range(400)) and found.tolist() == scores.tolist()
    assert read == (np.sign(rows) * np.sign(query) > 0).sum()


def test_postings_and_blocks_are_left_out():
    rng = np.random.default_rng(2)
    # Few terms of each vector are not zero, and the later blocks hold smaller values.
    rows = rng.integers(-9, 10, (4000, 30)) * (rng.random((4000, 30)) < 0.2)
    rows[1000:] //= 3
    shard = topk.Shard(np.arange(4000), rows, 500)
    assert sum(len(block.rows) for block in shard.blocks) == np.count_nonzero(rows)
    for own in range(0, 4000, 100):
        scores = rows @ rows[own]
        expected = sorted((-int(s), i) for i, s in enumerate(scores) if i != own)[:5]
        assert shard.search(own, rows[own], 5) == [(-s, i) for s, i in expected]
    assert 0 < shard.traversed < shard.skipped


@pytest.mark.parametrize("filled,factor", [(1.0, 1), (0.1, 1), (1.0, 1 << 24)])
def test_queries_go_through_blocks_together(filled, factor, monkeypatch):
    rng = np.random.default_rng(3)
    rows = rng.integers(-9, 10, (3000, 24)) * (rng.random((3000, 24)) < filled) * factor
    asked = np.arange(0, 3000, 10)
    expected = []
    for number, own in enumerate(asked):
        order = sorted((-int(s), i) for i, s in enumerate(rows @ rows[own]) if i != own)[:5]
        expected += [(number, -s, i) for s, i in order]
    calls = []
    own_method = topk.Block.competitive_to
    monkeypatch.setattr(topk.Block, "competitive_to", lambda *x: calls.append(0) or own_method(*x))
    shard = topk.Shard(np.arange(3000), rows, 500)
    assert shard.search_all(asked, list(rows[asked]), 5) == expected
    # Once for a block, and not for each of the queries.
    assert len(calls) <= 6


def test_edge_rows(spark):
    rows = [(0, [1, 2]), (0, [1, 2]), (1, [3]), (2, None), (None, [9, 9]), (3, []), (4, [1, 1, 7])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash"))
    found = results(topk.top_k(frame.where("vec_id in (0, 2, 3)"), frame))
    assert found == {
        0: [(1, 3), (4, 3), (3, 0)],
        3: [(0, 0), (0, 0), (1, 0), (4, 0)],
    }
    assert topk.top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_scaling_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001]), (2, [nan]), (3, [-inf]), (4, None), (5, [None, 1.0]), (6, [])]
    frame = spark.createDataFrame(rows, "vec_id long, e array<float>").where(topk.usable("e"))
    found = {r["vec_id"]: r["v"] for r in frame.select("vec_id", topk.scaled("e").alias("v")).collect()}
    assert found == {1: [128, -1], 6: []}
