import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_pieces(pieces, texts, tokenizer, window):
    """``texts`` has one text for each doc_id."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    full = [sum(p["length"] for p in by_sequence[s]) for s in sorted(by_sequence)]
    assert all(n == window for n in full[:-1])


def test_query_is_a_packing_of_all_ids(spark, tokenizer):
    pieces = QUERIES["op9_concat_pack"](spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    check_pieces(pieces, {r["doc_id"]: r["text"] for r in rows}, tokenizer, 1024)


def test_edge_rows_over_several_tasks(spark, tokenizer):
    rng = random.Random(3)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "é", "’s", "'s", "'ll", "12", "!?", " ", "日本", "😀", "<|endoftext|>", "\x1c", "́"]
    texts = {i: "".join(rng.choices(alphabet, k=rng.randrange(60))) for i in range(300)}
    texts |= {1000: None, 1001: "", 1002: " ", 1003: "word " * 5000, None: "no key"}
    frame = spark.createDataFrame(list(texts.items()), SCHEMA).withColumn("start", F.lit("x"))
    pieces = packing.pack_documents(frame.repartition(5), window=64).collect()
    check_pieces(pieces, texts, tokenizer, 64)
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_are_packed_each(spark):
    frame = spark.createDataFrame([(1, "two words")] * 3, SCHEMA)
    pieces = packing.pack_documents(frame, window=4).collect()
    assert sum(p["length"] for p in pieces) == 3 * pieces[0]["doc_tokens"]


def test_names_of_special_tokens_are_their_ids(tokenizer):
    path = packing.vocabulary_path()
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y z", "plain text", ""]
    for text, ids in zip(texts, packing.encode_texts(texts, path)):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.encode_texts(texts, path)[0], "<u2").tolist() == [64, 220, 50256, 275]


def test_each_vocabulary_has_a_memory_of_its_own_within_its_bound(monkeypatch):
    first, second = (public_tokenizers.path(f"byte_bpe_{x}.tiktoken") for x in ("50k", "multi_50k"))
    text = "words that two vocabularies cut apart differently, naïve façades über allem"
    own = [packing.encode_texts([text], path)[0] for path in (first, second, first)]
    assert own[0] == own[2] != own[1]
    monkeypatch.setattr(packing, "REMEMBERED", 10_000)
    for i in range(50):
        packing.encode_texts([f"some {'x' * 500}{i} more {i} words"], first)
        assert packing._memories[first].held < 12_000
