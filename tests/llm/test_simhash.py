import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import components, simhash
from millrace.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    votes = Counter()
    for gram in grams:
        value = xxhash.xxh64_intdigest(gram, 42)
        votes.update(i for i in range(64) if value >> i & 1)
    return sum(1 << i for i in range(64) if 2 * votes[i] > len(grams))


def plain_groups(prints):
    ids = [i for i, _ in prints]
    fps = np.array([f for _, f in prints], np.uint64)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, fp in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(fps[:k] ^ fp) <= 3):
            a, b = sorted((find(ids[j]), find(ids[k])))
            root[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "A b", "a B c", "É b c d É b c", "x y " * 3000])
def test_fingerprint_of_edge_texts(text):
    assert simhash.simhash(text) == plain_fingerprint(text)


def test_query_equals_brute_force(spark):
    found = QUERIES["op1_simhash_groups"](spark, "/root/testdata/sf0.01").collect()
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in found} == prints
    assert {r["doc_id"]: r["component_id"] for r in found} == plain_groups(list(prints.items()))


@pytest.mark.parametrize("hot", [4096, 3, 0])
def test_links_have_all_components_at_any_bound(spark, hot):
    rng = random.Random(5)
    bases = [rng.getrandbits(64) for _ in range(6)]
    prints = {}
    for number in range(300):
        value = bases[number % 6]
        for _ in range(rng.randrange(9)):
            value ^= 1 << rng.randrange(64)
        prints.setdefault(value, number)
    rows = [(v - (1 << 64) if v >> 63 else v, i) for v, i in prints.items()]
    nodes = spark.createDataFrame(rows, "fp long, rep long")
    links = simhash.near_links(nodes, hot)
    roots = {r["node"]: r["root"] for r in components.connected_components(links).collect()}
    expected = plain_groups([(i, v) for v, i in prints.items()])
    assert {i: roots.get(i, i) for i in expected} == expected


def test_components_of_a_path_a_star_and_repeats(spark):
    links = [(i + 1, i) for i in range(10, 60)] + [(5, i) for i in range(100, 160)]
    links += [(7, 7), (2, 1), (1, 2), (2, 1)]
    frame = spark.createDataFrame(links, "a long, b long")
    rows = components.connected_components(frame).collect()
    roots = {r["node"]: r["root"] for r in rows}
    assert len(rows) == len(roots)
    assert roots == {i: 10 for i in range(10, 61)} | {i: 5 for i in [5, *range(100, 160)]} | {1: 1, 2: 1}


@pytest.mark.parametrize("part", [1, 7, 50_000])
def test_links_of_hubs_are_dealt_out(spark, part):
    rng = random.Random(4)
    links = [(0, i) for i in range(1, 200)] + [(500, i) for i in range(501, 700)]
    links += [(rng.randrange(700, 1200), rng.randrange(700, 1200)) for _ in range(300)]
    frame = spark.createDataFrame(links, "u long, v long")
    roots = {r["node"]: r["root"] for r in components.connected_components(frame, part).collect()}
    expected = {}
    for a, b in links:
        if a != b:
            one, other = ({x} if (own := expected.get(x)) is None else own for x in (a, b))
            for x in (joined := one | other):
                expected[x] = joined
    assert roots == {x: min(own) for x, own in expected.items()}
    dealt = components._smallest(frame.where("u <> v"), part)
    assert dealt.where("u = 0").agg(F.count("*"), F.min("m"), F.max("m")).first() == (199, 0, 0)


def test_edge_rows(spark):
    copy = "one two three four five six seven eight"
    rows = [(4, copy), (2, copy), (2, copy), (9, None), (8, " "), (None, copy), (7, "other words here")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("component_id", F.lit("x"))
    found = simhash.near_groups(frame)
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in found.collect()) == [
        (-1, None), (2, 2), (2, 2), (4, 2), (7, 7), (8, 8), (9, 8),
    ]
    kept = simhash.keep_one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 2, 7, 8]
    assert simhash.near_groups(spark.createDataFrame([], SCHEMA)).count() == 0
