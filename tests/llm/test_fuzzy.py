import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import fuzzy
from millrace.llm.queries import QUERIES


def plain_distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a):
        entry = [i + 1]
        for j, y in enumerate(b):
            entry.append(min(line[j + 1] + 1, entry[j] + 1, line[j] + (x != y)))
        line = entry
    return line[-1]


def plain_fingerprint(body):
    """Byte by byte: the rolling hash, the chunks, the block size."""
    import zlib

    level = []
    for i in range(len(body)):
        rolled = sum(
            (body[i - ago] + 1) * pow(0x01000193, ago + 1, 1 << 32) for ago in range(7) if i >= ago
        ) % (1 << 32)
        mixed = (rolled ^ rolled >> 15) * 2246822519 % (1 << 32)
        mixed ^= mixed >> 13
        ones = 0
        while mixed >> ones & 1:
            ones += 1
        level.append(ones)
    size = 0
    while sum(x >= size for x in level) >= 64:
        size += 1

    def signature(size):
        chunks, start = [], 0
        for i, x in enumerate(level):
            if x >= size:
                chunks.append(body[start : i + 1])
                start = i + 1
        if start < len(body):
            chunks.append(body[start:])
        return "".join(fuzzy._CHARACTERS[zlib.crc32(c) % 64] for c in chunks)

    return f"{2**size}:{signature(size)}:{signature(size + 1)}"


def texts_of(kind):
    rng = random.Random(4)
    return ["", "a", "é" * 70, "Nd " * 2000, "".join(rng.choices("abc dé\n", k=5000))][kind]


@pytest.mark.parametrize("block", [1 << 21, 100])
@pytest.mark.parametrize("kind", range(5))
def test_fingerprint(monkeypatch, kind, block):
    monkeypatch.setattr(fuzzy, "BLOCK", block)
    body = texts_of(kind).encode()
    assert fuzzy.fingerprint(body) == plain_fingerprint(body)


def test_edit_distances():
    rng = random.Random(1)
    pairs = [["".join(rng.choices("abc", k=rng.randrange(30))) for _ in "ab"] for _ in range(200)]
    found = fuzzy.edit_distances([a for a, _ in pairs], [b for _, b in pairs])
    assert found.tolist() == [plain_distance(a, b) for a, b in pairs]


def test_likeness_at_compatible_sizes():
    same = "4:abcd:ab"
    pairs = [(same, same), (same, "4:abce:xy"), (same, "8:ab:q"), ("8:ab:q", same), (same, "16:ab:ab")]
    assert fuzzy.likeness(pairs).tolist() == [1, 0.75, 1, 1, 0]


def check(found, rows):
    """``rows``: (doc_id, text) in order."""
    found = sorted(found, key=lambda r: -1 if r["doc_id"] is None else r["doc_id"])
    assert [r["doc_id"] for r in found] == [i for i, _ in rows]
    texts = [t or "" for _, t in rows]
    prints = [fuzzy.fingerprint(t.encode()) for t in texts]
    for at, r in enumerate(found):
        after = (at + 1) % len(rows)
        n = len(texts[at]) // 4
        changed = texts[at][: len(texts[at]) - n] + texts[after][:n]
        assert r["n_chars"] == len(texts[at])
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == prints[at]
        assert r["edited_fingerprint"] == fuzzy.fingerprint(changed.encode())
        assert r["near_edited"] == fuzzy.likeness([(prints[at], r["edited_fingerprint"])])[0]
        assert r["near_next"] == fuzzy.likeness([(prints[at], prints[after])])[0]


def test_query_equals_row_by_row(spark):
    found = QUERIES["op4_fuzzy_hash"](spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    check(found, sorted((r["doc_id"], r["text"]) for r in rows))
    assert sum(r["near_edited"] for r in found) / len(found) > 0.6
    assert sum(r["near_next"] for r in found) / len(found) < 0.2


def test_edge_rows(spark):
    rows = [(None, "no key"), (1, None), (2, ""), (3, "é" * 500), (9, "long " * 40_000), (12, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit("c"))
    check(fuzzy.describe_documents(frame.repartition(3)).collect(), rows)
    check(fuzzy.describe_documents(frame.where("doc_id = 3")).collect(), [rows[3]])
    assert fuzzy.describe_documents(frame.limit(0)).count() == 0
    repeated = frame.where("doc_id = 3").union(frame.where("doc_id = 3"))
    assert [r["near_next"] for r in fuzzy.describe_documents(repeated).collect()] == [1, 1]
