import hashlib
import random
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bwt, repeats
from millrace.llm.queries import QUERIES
from millrace.sources import storage

SCHEMA = "doc_id long, text string"


def brute_force(texts, span):
    """(n_bytes, n_removed, n_spans, kept) for each doc_id, from a set of all strings seen so far."""
    seen, results = set(), {}
    for doc_id in sorted(texts):
        body = (texts[doc_id] or "").encode()
        gone = np.zeros(len(body) + 1, bool)
        for at in range(len(body) - span + 1):
            piece = body[at : at + span]
            if piece in seen:
                gone[at : at + span] = True
            seen.add(piece)
        kept = bytes(b for b, g in zip(body, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        results[doc_id] = (len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return results


def results(frame):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in frame.collect()}


@pytest.mark.parametrize("depth", [1, 2, 5, 9])
def test_merged_intervals(depth):
    rng = random.Random(depth)
    for _ in range(20):
        strings = [bytes(rng.choices(b"ab\x00\xff", k=rng.randrange(40))) for _ in range(rng.randrange(1, 12))]
        interval, string, offset = bwt.repeated_windows(strings, 3, depth)
        found, expected = defaultdict(set), defaultdict(set)
        for i, s, o in zip(interval, string, offset):
            found[i].add((s, o))
        for s, body in enumerate(strings):
            for o in range(len(body) - depth + 1):
                expected[body[o : o + depth]].add((s, o))
        many = {frozenset(x) for x in expected.values() if len(x) > 1}
        assert {frozenset(x) for x in found.values()} == many


@pytest.mark.parametrize("size", [1 << 22, 150])
def test_anchors_cover_all_windows(monkeypatch, size):
    monkeypatch.setattr(repeats, "BLOCK", size)
    text = bytes(random.Random(2).choices(b"abc", k=1000))
    keys, first, last = repeats.anchors(text)
    windows = [w for a, b in zip(first, last) for w in range(a, b + 1)]
    assert windows == list(range(len(text) - 99))
    moved = repeats.anchors(b"xyz" + text)[0]
    assert set(keys) <= set(moved)


def test_segments_without_a_shared_half_enter_no_transform(monkeypatch):
    """Of segments around one anchor only those go on that agree beside it in half of a window."""
    rng = random.Random(5)
    anchor, other = bytes(rng.choices(b"abcd", k=10)), bytes(rng.choices(b"efgh", k=200))
    key = repeats._gram_hashes(np.frombuffer(anchor, np.uint8), 10).view(np.int64)[0]
    word = lambda k: bytes(rng.choices(b"ijklmnop", k=k))
    left, right = other[:15], other[100:115]
    segments = [
        word(20) + anchor + word(20),
        word(20) + anchor + word(20),
        word(5) + left + anchor + word(20),
        word(9) + left + anchor + word(20),
        word(20) + anchor + right + word(3),
        word(20) + anchor + right + word(3),
        word(20) + anchor + right[:14] + b"z" + word(3),
        left + anchor + word(20),  # of another group
        b"",
    ]
    group = np.array([1] * 7 + [2] * 2)
    kept = repeats._sharing(segments, group, np.full(9, key), 40, 10)
    assert kept.tolist() == [2, 3, 4, 5]
    seen = []
    whole = repeats.repeated_windows
    monkeypatch.setattr(repeats, "repeated_windows", lambda s, *a: seen.extend(s) or whole(s, *a))
    n = np.arange(7)
    table = repeats.pa.table(
        [np.full(7, key), n, n, n, np.zeros(7, np.int32), np.array([len(s) - 39 for s in segments[:7]], np.int32)]
        + [repeats.pa.array(segments[:7], repeats.pa.binary())],
        names=["key", "d1", "d2", "doc_id", "at", "windows", "segment"],
    )
    list(repeats._cover(table, 40, 10))
    assert seen == segments[2:6]


def test_query_equals_brute_force(spark):
    found = results(QUERIES["op7_bwt_repeats"](spark, "/root/testdata/sf0.01"))
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert found == brute_force({r["doc_id"]: r["text"] for r in rows}, 100)


@pytest.mark.parametrize("hot", [4096, 2])
def test_mosaics_of_passages(spark, monkeypatch, hot):
    rng = random.Random(8)
    parts = ["".join(rng.choices("etaoin shrdlué", k=rng.randrange(5, 90))) for _ in range(30)]
    texts = {i: "".join(rng.choices(parts, k=rng.randrange(1, 9))) for i in range(80)}
    texts |= {100: "ab" * 300, 101: "ab" * 300, 102: "x" + "ab" * 200, 103: "", 104: None, 105: texts[3], 106: "q" * 40}
    frame = spark.createDataFrame(list(texts.items()), SCHEMA).repartition(4)
    assert results(repeats.remove_repeats(frame, span=40, gram=10, hot=hot)) == brute_force(texts, 40)


def test_edge_rows(spark):
    body = "a passage that is repeated in the text of several rows, and long enough to count " * 2
    rows = [(1, body), (1, body), (2, body), (None, body), (3, body[:99]), (4, None)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit("clash"))
    found = repeats.remove_repeats(frame)
    assert found.columns == ["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    removed = sorted((r["doc_id"] or 0, r["n_removed"]) for r in found.collect())
    own = brute_force({1: body}, 100)[1][1]
    assert removed == [(0, 0), (1, own), (1, own), (2, len(body)), (3, 0 if own else 0), (4, 0)]
    assert repeats.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_stored_again_in_another_file_keep_their_text(spark, tmp_path):
    """Joins are shuffled, not broadcast, and equal rows come from different tasks."""
    rng = random.Random(11)
    texts = [(i, "".join(rng.choices("abcdefghij klmnop", k=1500))) for i in range(300)]
    place = str(tmp_path / "docs")
    schema = "doc_id long, text string"
    spark.createDataFrame(texts, schema).coalesce(1).write.parquet(place)
    spark.createDataFrame(texts[:20] * 3, schema).repartition(3).write.mode("append").parquet(place)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = repeats.remove_repeats(spark.read.parquet(place)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == 360 and {r["n_removed"] for r in found} == {0}


def test_segments_and_shuffles_leave_the_disk(spark):
    """What found the repeats is gone before the texts are cut, without any collection of garbage."""
    rng = random.Random(12)
    passage = "".join(rng.choices("abcdefghij klmnop", k=300))
    rows = [(i, "".join(rng.choices("abcdefghij klmnop", k=400)) + passage) for i in range(200)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {x for x in names if x.startswith("shuffle_") and x.endswith(".data")}

    before, staged = shuffled(), set(storage._scopes[-1])
    done = repeats.remove_repeats(frame)
    for _ in range(100):  # files are deleted beside the job
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    assert not [x for x in set(storage._scopes[-1]) - staged if "/segments-" in x]
    assert sorted(r["n_removed"] for r in done.collect())[:2] == [0, 300]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") != "true"
