import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import suffixtree
from millrace.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, held_out boolean"


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b""]


def base_scores(rows):
    """(n_tokens, n_known, train_tokens, base_score) by doc_id, from (doc_id, text, held_out)."""
    c = Counter(t for _, text, held in rows if not held for t in tokens_of(text))
    total, kinds = sum(c.values()), len(c)
    return {
        i: (
            len(tokens_of(text)),
            sum(c[t] > 0 for t in tokens_of(text)),
            total,
            sum(np.log10((c[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in tokens_of(text)),
        )
        for i, text, _ in rows
    }


def plain_model(rows, depth, p_min, frequent):
    """Probability of a token after the tokens before it, step by step in dictionaries."""
    texts = [tokens_of(text) for _, text, held in rows if not held]
    c = Counter(t for text in texts for t in text)
    total = sum(c.values())
    words = sorted((w for w in c if w), key=lambda w: (-c[w], w))[:frequent]
    symbols = {b"": "END"} | {w: w for w in words}
    read = lambda text: [symbols.get(t, "OTHER") for t in text]
    all_symbols = ["END", "OTHER", *words]
    seen = {d: {} for d in range(depth + 1)}
    for text in texts:
        own = ["START"] * depth + read(text)
        for at in range(depth, len(own)):
            for d in range(depth + 1):
                seen[d].setdefault(tuple(own[at - d : at]), Counter())[own[at]] += 1
    # A context is counted where its string was frequent one level before.
    root = {s: (seen[0].get((), {}).get(s, 0) + 0.5) / (total + 0.5 * 1023) for s in all_symbols}
    retained = {(): None}

    def probability(context, s, below):
        for d in range(below, -1, -1):
            own = context[len(context) - d :]
            if own in retained:
                if d == 0:
                    return root[s]
                n = seen[d][own]
                size, kinds = sum(n.values()), len(n)
                return (n[s] + kinds * probability(context, s, d - 1)) / (size + kinds)

    eligible = {(s,) for s in all_symbols if seen[0].get((), {}).get(s, 0) >= max(1, p_min * total)} | {("START",)}
    for d in range(1, depth + 1):
        added, strings = [], set()
        for context, n in seen[d].items():
            if context not in eligible:
                continue
            size, kinds = sum(n.values()), len(n)
            gain = sum(v * np.log(v / size / probability(context, s, d - 1)) for s, v in n.items())
            if gain > kinds / 2 * np.log(max(total, 2)):
                added.append(context)
            strings |= {(*context, s) for s, v in n.items() if v >= max(1, p_min * total)}
        retained |= dict.fromkeys(added)
        eligible = strings
    once, twice = (sum(v == k for v in c.values()) for k in (1, 2))
    discount = min(once / (once + 2 * twice) if once else 0, 0.99)
    others = {w: n for w, n in c.items() if w not in symbols}
    size, kinds = sum(others.values()), len(others)

    def score(text):
        result, own = 0, ["START"] * depth + read(tokens_of(text))
        for at, token in enumerate(tokens_of(text), depth):
            p = probability(tuple(own[at - depth : at]), own[at], depth)
            if own[at] == "OTHER":
                p *= ((others[token] - discount) if token in others else discount * kinds + 0.5) / (size + 0.5)
            result += np.log10(p)
        return result

    return score, retained


def whole_model(rows, depth):
    """Log10 probability of a text by all words and all contexts, step by step in dictionaries."""
    texts = [tokens_of(text) for _, text, held in rows if not held]
    c = Counter(t for text in texts for t in text)
    total = sum(c.values())
    seen = {}
    for text in texts:
        own = [None] * depth + text
        for at in range(depth, len(own)):
            for d in range(1, depth + 1):
                seen.setdefault(tuple(own[at - d : at]), Counter())[own[at]] += 1
    retained = set()

    def probability(context, word):
        if not context:
            return (c[word] + 0.5) / (total + 0.5 * (len(c) + 1))
        parent = probability(context[1:], word)
        if context not in retained:
            return parent
        n = seen[context]
        return (n[word] + len(n) * parent) / (sum(n.values()) + len(n))

    for context, n in sorted(seen.items(), key=lambda x: len(x[0])):
        size = sum(n.values())
        gain = sum(v * np.log(v / size / probability(context[1:], w)) for w, v in n.items())
        if gain > len(n) / 2 * np.log(max(total, 2)):
            retained.add(context)

    def score(text):
        own = [None] * depth + tokens_of(text)
        return sum(np.log10(probability(tuple(own[at - depth : at]), own[at])) for at in range(depth, len(own)))

    return score, retained


@pytest.mark.parametrize("head,hot", [(100_000, 500), (30, 10), (1, 1)])
def test_all_words_and_contexts_are_learnt(spark, head, hot):
    """More words than the symbols of the small tree, and contexts below any share of the tokens."""
    rng = random.Random(3)
    rows = []
    for i in range(150):
        text, at = [], rng.randrange(1500)
        for _ in range(rng.randrange(1, 80)):
            at = (at * 7 + 3) % 1500 if rng.random() < 0.7 else int(1500 * rng.random() ** 4)
            text.append(f"w{at}")
        rows.append((i, " ".join(text), i % 5 == 1))
    rows += [(150, None, False), (151, "never seen w1 w10", True), (152, "", True)]
    found = suffixtree.score_documents(spark.createDataFrame(rows, SCHEMA), head_words=head, hot=hot, parts=3).collect()
    score, retained = whole_model(rows, suffixtree.DEPTH)
    assert len({w for (w, *_) in retained}) > suffixtree.FREQUENT
    expected = base_scores(rows)
    assert len(found) == len(rows)
    for r in found:
        assert r["score"] == pytest.approx(score(rows[r["doc_id"]][1]))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == expected[r["doc_id"]][:3]
        assert r["base_score"] == pytest.approx(expected[r["doc_id"]][3])


def test_query_base_scores_and_held_out_gain(spark):
    found = QUERIES["op8_suffix_tree"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1 for r in docs}
    expected = base_scores([(r["doc_id"], r["text"], held[r["doc_id"]]) for r in docs])
    assert len(found) == len(docs)
    for r in found:
        own = expected[r["doc_id"]]
        assert r["held_out"] == held[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == own[:3]
        assert r["base_score"] == pytest.approx(own[3])
    unseen = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


@pytest.mark.parametrize("frequent,head", [(6, 100_000), (6, 9), (0, 1), (1021, 100_000)])
def test_scores_equal_step_by_step(spark, frequent, head):
    if frequent > head:
        frequent = head
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(120):
        text, at = [], 0
        for _ in range(rng.randrange(1, 60)):
            # The next word leans on the one before.
            at = (at * 3 + 1) % 5 if rng.random() < 0.6 else int(40 * rng.random() ** 3)
            text.append(words[at])
        rows.append((i, " ".join(text), i % 5 == 1))
    frame = spark.createDataFrame(rows, SCHEMA)
    found = suffixtree.score_documents(frame, frequent=frequent, head_words=head).collect()
    score, retained = plain_model(rows, suffixtree.DEPTH, suffixtree.P_MIN, frequent)
    assert frequent == 0 or len(retained) > 1
    expected = base_scores(rows)
    for r in found:
        assert r["score"] == pytest.approx(score(rows[r["doc_id"]][1]))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == expected[r["doc_id"]][:3]
        assert r["base_score"] == pytest.approx(expected[r["doc_id"]][3])


def test_probabilities_of_all_events_sum_to_one():
    levels = [
        (np.array([1, 2, 3, 4]), np.array([50, 20, 100, 30])),
        (np.array([3 << 10 | 3, 3 << 10 | 4, 4 << 10 | 1]), np.array([90, 10, 30])),
    ]
    tree = suffixtree.grow_tree(levels)
    assert len(tree.contexts[1]) > 0
    for context in (0, 1, 3, 4):
        codes = (context << 10) | np.arange(1, 1024)
        assert np.exp(tree.log_probabilities(codes)).sum() == pytest.approx(1)
    others = suffixtree.OtherWords(tokens=10, kinds=3, discount=0.4)
    seen = np.exp(others.log_probabilities(np.array([5, 3, 2]))).sum()
    assert seen + others.unseen() == pytest.approx(1)


def test_edge_rows(spark):
    rows = [(1, None, False), (2, "", None), (None, "A a\tB", False), (3, "a " * 50_000, True), (3, "new", True)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash"))
    found = suffixtree.score_documents(frame).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found) == [
        (1, 1, 6), (1, 1, 6), (2, 1, 6), (4, 4, 6), (50_001, 50_001, 6),
    ]
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in found)
    untaught = suffixtree.score_documents(frame.withColumn("held_out", F.lit(True))).collect()
    assert all(r["train_tokens"] == r["n_known"] == 0 and np.isfinite(r["score"]) for r in untaught)
    assert suffixtree.score_documents(frame.limit(0)).count() == 0


def test_tokens_are_dealt_out_in_chunks():
    """A row that is shuffled holds the tokens of a bucket, not one token, and every token is in one of them."""
    rng = np.random.default_rng(4)
    texts = [rng.choice([1, 2, 3, 4, 5, -7, 10**15], 200) for _ in range(50)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(50)), pa.array([1, 0] * 25), pa.array([x.tobytes() for x in texts], pa.binary())],
        ["row", "train", "words"],
    )
    parts, buckets, common, found = 2, 3, np.array([0, 2]), []
    for flow in (None, *range(2 * parts)):
        run = suffixtree._chunk_rows(6, common, flow, parts, buckets)
        chunks = pa.Table.from_batches(run([batch]))
        assert chunks.num_rows <= buckets
        if chunks.num_rows:
            found.append(np.stack(suffixtree._gathered(chunks)))
    row, _, *words = np.concatenate(found, axis=1)
    padded = [[0, 0, 0, *x.tolist()] for x in texts]
    expected = [(2 * i + 1 - i % 2, *x[at - 3 : at + 1][::-1]) for i, x in enumerate(padded) for at in range(3, 203)]
    assert sorted(zip(row.tolist(), *(w.tolist() for w in words))) == sorted(expected)


def test_numbers_of_pairs():
    rng = np.random.default_rng(5)
    for high, low in ((9, 7), (1 << 40, 1 << 30)):
        one, two = rng.integers(0, 9, 500) * (high // 9), rng.integers(0, 7, 500) * (low // 7)
        number = suffixtree._numbered(one, two)
        assert len(set(zip(number.tolist(), one.tolist(), two.tolist()))) == len(set(number.tolist()))
        assert set(number.tolist()) == set(range(len(set(zip(one.tolist(), two.tolist())))))


def test_chunks_take_few_bytes():
    """A shuffled token takes a fraction of its six columns, and they come back whole."""
    rng = np.random.default_rng(6)
    texts = [rng.integers(1, 60_000, 400) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(1 << 33, (1 << 33) + 500)), pa.array([1] * 500), pa.array([x.tobytes() for x in texts], pa.binary())],
        ["row", "train", "words"],
    )
    run = suffixtree._chunk_rows(60_000, np.array([0]), 0, 1, 20)
    chunks = pa.Table.from_batches(run([batch]))
    row, _, *words = suffixtree._gathered(chunks)
    padded = [np.append([0, 0, 0], x) for x in texts]
    expected = [((1 << 34) + 2 * i + 1, *x[at - 3 : at + 1][::-1]) for i, x in enumerate(padded) for at in range(4, 403)]
    assert sorted(zip(row.tolist(), *(w.tolist() for w in words))) == sorted(expected)
    assert sum(len(x) for x in chunks.column("chunk").to_pylist()) < 12 * len(row)


def test_chunks_hold_any_number():
    rng = np.random.default_rng(8)
    for size in (0, 1, 2, 500):
        columns = [rng.integers(-(1 << 62), 1 << 62, size) * 2 for _ in range(7)]
        columns[3] = np.full(size, -(1 << 63))
        columns[4] = np.zeros(size, np.int64)
        bucket = rng.integers(0, 5, size) * (1 << 40)
        chunks = pa.Table.from_batches([suffixtree._dealt(bucket, columns)])
        assert sorted(chunks.column("bucket").to_pylist()) == sorted(set(bucket.tolist()))
        found = suffixtree._gathered(chunks, 7)
        order = np.argsort(bucket, kind="stable")
        assert all((x == y[order]).all() for x, y in zip(found, columns))


def test_words_are_cut_in_batches_as_one_by_one():
    rng = random.Random(9)
    pieces = [" ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "a", "B", "Z", "é", "\x1c", "\x85", "\xa0", "\0", "İ", "x"]
    texts = [None, "", " ", " a ", *("".join(rng.choices(pieces, k=rng.randrange(30))) for _ in range(500))]
    words, sizes = suffixtree._cut(pa.array(["left out", *texts]).slice(1))
    expected = [suffixtree.words_of(t) for t in texts]
    assert words.to_pylist() == [w for own in expected for w in own]
    assert sizes.tolist() == [len(own) for own in expected]
    rows = suffixtree._word_rows(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))
    counts = pa.Table.from_batches(rows).to_pydict()
    assert dict(zip(counts["word"], counts["n"])) == Counter(w for own in expected for w in (*own, b""))


def test_most_frequent_words(spark):
    rng = random.Random(10)
    counts = [(f"w{i}".encode(), rng.randrange(1, 9)) for i in range(60)]
    frame = spark.createDataFrame(counts, "word binary, n long").repartition(4)
    order = sorted(counts, key=lambda x: (-x[1], x[0]))
    for limit in (0, 1, 7, 30, 59, 60, 100):
        assert suffixtree._most_frequent(frame, limit) == order[:limit]
    assert suffixtree._most_frequent(frame.limit(0), 5) == []
