"""Ids and decoded texts against the public library, as its file stands."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe
from millrace.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [
    "a", "B", " ", "  ", "\n", "\t", "\r\n", "é", "’s", "'s", "'ll", "'", "''", "12", "!?", "!", "#", "~^", "`", "_", "...",
    " ", "　", " ", "\u0085", "​", "日本", "😀", "<|endoftext|>", "<|endof", "\x1c", "\x1f", "\x00",
    "́", "½", "²", "zq", "Qx", "don't", "'S", "ß", "и", "word", "the",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def expected(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    shown = tokenizer.decode(ids, skip_special_tokens=False)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), shown)]
    return (len(ids), *digest)


def test_random_texts_in_odd_neighbourhoods(vocabulary, tokenizer):
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choices(ALPHABET, k=rng.randrange(14)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert vocabulary.encode(text).tolist() == ids, repr(text)
        assert vocabulary.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False)


def test_random_characters_of_all_planes(vocabulary, tokenizer):
    rng = random.Random(4)
    spans = [(32, 127), (0, 0x250), (0x2000, 0x2070), (0x300, 0x3100), (0x1F300, 0x1F700)]
    text = "".join(chr(rng.randrange(*rng.choice(spans))) for _ in range(200_000))
    assert vocabulary.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_cuts_are_forced_boundaries_and_parts_are_encoded_alone(vocabulary, tokenizer):
    text = "The quick brown fox, 123 times; naïve café — 東京 <tag> don't~^`zq " * 50
    body = text.encode()
    cuts = vocabulary.cuts(body).tolist()
    assert len(cuts) > 600
    # No token holds the two bytes around a cut.
    around = {bytes(body[c - 1 : c + 1]) for c in cuts}
    assert not any(pair in token for pair in around for token in vocabulary.tokens[:-1])
    edges = [0, *cuts, len(body)]
    parts = [body[a:b].decode() for a, b in zip(edges, edges[1:])]
    joined = [i for part in parts for i in tokenizer.encode(part, add_special_tokens=False).ids]
    assert joined == tokenizer.encode(text, add_special_tokens=False).ids
    # Equal fragments are encoded once.
    vocabulary.counts = [0, 0]
    vocabulary.encode(text)
    assert vocabulary.counts[0] == len(cuts) + 1 and vocabulary.counts[1] < 40


def test_long_runs_and_bounded_memory(monkeypatch, tokenizer):
    monkeypatch.setattr(bpe, "REMEMBERED", 5_000)
    monkeypatch.setattr(bpe, "_BLOCK", 1_000)
    monkeypatch.setattr(bpe, "_TOGETHER", 70)
    own = bpe.Vocabulary(PATH)
    rng = random.Random(5)
    texts = ["x" * 30_000, "".join(rng.choices("abcdefgh", k=20_000)), " ".join("".join(rng.choices("aeiou", k=5)) for _ in range(9_000))]
    for text in texts:
        assert own.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert own._held <= 5_000 + 70 * 400 and all(len(f) <= bpe._SHORT for f in own._known)


def test_query_on_all_documents(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    found = QUERIES["op12_forced_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert {tuple(r) for r in found} == {(r["doc_id"], *expected(tokenizer, r["text"])) for r in docs}
    assert len(found) == len(docs)


def test_edge_rows(spark, tokenizer):
    rows = [(1, None), (2, ""), (3, " "), (3, " "), (None, "no key"), (4, "word " * 3000), (5, "a <|endoftext|> b")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"ids": F.lit("clash"), "n_tokens": F.lit(0)})
    found = bpe.digest_documents(frame.repartition(3))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        ((k, *expected(tokenizer, t)) for k, t in rows), key=repr
    )
    coded = {r["doc_id"]: r["ids"] for r in bpe.encode_documents(frame).collect()}
    assert coded[5] == [64, 220, 50256, 275] and coded[1] == []
    assert bpe.digest_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_other_kinds_of_vocabularies_are_refused():
    with pytest.raises(ValueError, match="no plain byte-level"):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
