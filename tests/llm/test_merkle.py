"""Witnesses against a tree that is built level by level in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle
from millrace.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    parts = []
    for value in (doc_id, source, lang, n_chars, text):
        shown = None if value is None else str(value)
        parts.append("-" if shown is None else f"{len(shown.encode())}:{shown}")
    return sha("".join(parts))


def plain_tree(digests):
    """Root, and for each leaf its runs: (place in the run, the whole run) by level."""
    paths = [[] for _ in digests]
    members, nodes = [[i] for i in range(len(digests))], list(digests)
    while len(nodes) > 1:
        next_nodes, next_members = [], []
        for begin in range(0, len(nodes), 8):
            run = nodes[begin : begin + 8]
            for place, own in enumerate(members[begin : begin + 8]):
                for leaf in own:
                    paths[leaf].append((place, run))
            next_nodes.append(sha("".join(run)))
            next_members.append(sum(members[begin : begin + 8], []))
        nodes, members = next_nodes, next_members
    return nodes[0], paths


def plain_check(rows):
    """The expected rows of the query, as a sorted list."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    made = {}
    for lang in order:
        own = sorted(trees[lang], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        made[lang] = own, *plain_tree([plain_leaf(*r) for r in own])
    root, heads = plain_tree([made[lang][1] for lang in order])
    found = []
    for lang, head in zip(order, heads):
        own, subroot, paths = made[lang]
        for row, path in zip(own, paths):
            doc_id, source, _, n_chars, text = row
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded, proof = plain_leaf(doc_id, source, lang, n_chars, text), ""
            for place, run in path + head:
                proof += "".join(run[:place] + run[place + 1 :])
                folded = sha("".join([*run[:place], folded, *run[place + 1 :]]))
            found.append((doc_id, plain_leaf(*row), subroot, root, sha(proof), folded, folded == root))
    return sorted(found, key=repr)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_query_against_a_plain_tree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in docs.collect()]
    found = QUERIES["op11_merkle_manifest"](spark, "/root/testdata/sf0.001")
    assert rows_of(found) == plain_check(rows)


@pytest.mark.parametrize("height", [1, 2])
def test_blocks_are_further_appends(spark, height):
    """Small blocks, so that trees have several layers."""
    rng = random.Random(5)
    sizes = {None: 9, "": 1, "de": 300, "en": 64, "ü": 65, "zz": 8, "a": 513}
    rows, number = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            number += rng.randrange(1, 4)
            rows.append((number, rng.choice(["web", None]), lang, rng.randrange(99), rng.choice(["Ab", "x", None, ""])))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = rows_of(merkle.check_documents(frame, merkle.Shape(height=height)))
    assert found == plain_check(rows)
    assert {r[-1] for r in found} == {True, False}


def test_many_trees(spark):
    rows = [(i, "s", f"lang{i % 150}", i, "Text") for i in range(400)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(merkle.check_documents(frame, merkle.Shape(height=1))) == plain_check(rows)


def test_repeated_rows_null_keys_empty_and_clashing_columns(spark):
    rows = [(1, "s", "en", 1, "A")] * 10 + [(None, None, None, None, None)] * 3 + [(1, "s", "en", 2, "B"), (2, "s", "en", 1, "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("at", "nodes", "root", "tree", "steps", "key"):
        frame = frame.withColumn(name, F.lit("clash"))
    assert rows_of(merkle.check_documents(frame)) == plain_check(rows)
    one = spark.createDataFrame([(7, "s", "en", 1, "only")], SCHEMA)
    assert rows_of(merkle.check_documents(one)) == plain_check([(7, "s", "en", 1, "only")])
    nothing = merkle.check_documents(spark.createDataFrame([], SCHEMA))
    assert nothing.columns[0] == "doc_id" and nothing.count() == 0


def test_witnesses_grow_as_siblings_come():
    block = merkle.Appending(2, 8)
    for i in range(9):
        block.append(sha(str(i)))
    # The first run has closed: each of its leaves has one step. The ninth leaf waits.
    assert [len(w) for w in block.witnesses] == [1] * 8 + [0]
    root = block.root()
    assert [len(w) for w in block.witnesses] == [2] * 9
    assert root == plain_tree([sha(str(i)) for i in range(9)])[0]


def test_a_carried_column_and_a_fold_by_hand(spark):
    leaves = [("t", i, sha(f"leaf {i}"), i * i) for i in range(20)]
    frame = spark.createDataFrame(leaves, "tree string, key int, digest string, square int")
    for r in merkle.manifest(frame).collect():
        own = r["digest"]
        for step in r["steps"]:
            own = sha(step["left"] + own + step["right"])
        assert own == r["root"] == r["subroot"] and r["square"] == r["key"] ** 2
