import math
import re
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import shards
from millrace.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def check_slots(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark):
    found = QUERIES["op5_rendezvous_shards"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    texts = {r["doc_id"]: r["text"].encode() for r in docs}
    assert len(found) == len(texts)
    for r in found:
        body = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"]) == (len(body) + 1, zlib.crc32(body), "key")
        assert 0 <= r["shard"] < 16 and r["grown_shard"] in (r["shard"], 16)
    check_slots(found)
    counts = Counter(r["shard"] for r in found)
    assert len(counts) == 16 and max(counts.values()) < 2 * min(counts.values())
    moved = sum(r["grown_shard"] == 16 for r in found) / len(found)
    assert 0.03 < moved < 0.1


def test_one_more_shard_takes_rows_only_into_itself(spark):
    keys = spark.range(5000)
    sizes = [shards.rendezvous_shard(F.col("id"), [1.0] * n).alias(f"s{n}") for n in range(1, 9)]
    for row in keys.select(*sizes).collect():
        for before, after, n in zip(row, row[1:], range(1, 8)):
            assert after in (before, n)


def test_shares_follow_weights(spark):
    placed = spark.range(20_000).select(shards.rendezvous_shard(F.col("id"), [1.0, 0.0, 3.0, 1.0]).alias("s"))
    counts = {r["s"]: r["count"] / 20_000 for r in placed.groupBy("s").count().collect()}
    assert set(counts) == {0, 2, 3}
    assert counts[2] == pytest.approx(0.6, abs=0.02)
    for weights in ([], [0.0], [1.0, -1.0]):
        with pytest.raises(ValueError, match="weights"):
            shards.rendezvous_shard(F.col("id"), weights)


def test_key_alone_decides_and_edge_rows(spark):
    rows = [(1, None), (1, ""), (1, "é"), (1, "é"), (None, "a"), (None, "b"), (2, "x" * 100_000)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("clash"))
    found = shards.shard_documents(frame.repartition(3), [1.0] * 4).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in found) == [
        (0, 2), (0, 2), (1, 1), (1, 1), (1, 3), (1, 3), (2, 100_001),
    ]
    by_key = {}
    for r in found:
        by_key.setdefault(r["doc_id"], set()).add((r["shard"], r["grown_shard"]))
    assert all(len(places) == 1 for places in by_key.values())
    check_slots(found)
    assert shards.shard_documents(frame.limit(0), [1.0] * 4).count() == 0


def test_no_python_on_executors(spark):
    plan = QUERIES["op5_rendezvous_shards"](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    assert not re.search("Python|Arrow|Pandas", plan.executedPlan().toString())


def plain_shard(key, shards):
    """The winner from XXH64 of the key, and of the shard seeded with it."""
    scores = []
    for shard in range(shards):
        seed = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
        bits = xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), seed) >> 11
        scores.append((-1 / math.log((bits + 0.5) / 2**53), -shard))
    return -max(scores)[1]


def test_query_against_scores_in_plain_python(spark):
    for r in QUERIES["op5_rendezvous_shards"](spark, "/root/testdata/sf0.001").collect():
        assert (r["shard"], r["grown_shard"]) == (plain_shard(r["doc_id"], 16), plain_shard(r["doc_id"], 17))
