"""The whole pipeline against brute force, stage by stage."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_packing import check_pieces, tokenizer  # noqa: F401
from test_repeats import brute_force
from test_simhash import plain_fingerprint, plain_groups

import corpus_pipeline
from millrace.llm import packing, workers

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The rows after each stage, with some rows that must go or stay added to the input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = [(100_001, None, None), (100_002, "12 34 !!", "en"), (100_003, "", "de"), (None, "the thing", None)]
    more = spark.createDataFrame(extra, "doc_id long, text string, lang string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    result = [docs]
    for name, apply in corpus_pipeline.STAGES:
        place = str(tmp_path_factory.mktemp(name) / "rows")
        apply(spark, result[-1], SF_DIR).write.parquet(place)
        result.append(spark.read.parquet(place))
    return result


def texts_of(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_workers_drop_what_other_operators_hold(monkeypatch):
    monkeypatch.setattr(workers, "_running", None)
    path = packing.vocabulary_path()
    workers.enter("packing")
    packing.encode_texts(["one two two"], path)
    workers.enter("packing")
    assert packing._memories[path] and packing._encoder.cache_info().currsize
    workers.enter("langid")
    assert not packing._memories and not packing._encoder.cache_info().currsize
    # Ids have a type without an encoder.
    assert packing._kind(path) == np.dtype("<u2")
    assert packing._encoder.cache_info().currsize == 0


def test_columns_stay(kept):
    for frame in kept[:4]:
        assert frame.dtypes == kept[0].dtypes


def test_language_keeps_clean_texts(kept):
    before, after = texts_of(kept[0]), texts_of(kept[1])
    assert set(before) - set(after) >= {100_001, 100_002, 100_003}
    assert len(set(before) - set(after)) <= 5
    assert all(before[i] == text for i, text in after.items())
    assert kept[1].where("lang is null").count() == 0


def test_one_of_each_group_stays(kept):
    before = texts_of(kept[1])
    groups = plain_groups([(i, plain_fingerprint(t)) for i, t in before.items() if i is not None])
    assert set(texts_of(kept[2])) == {*groups.values(), None}


def test_repeats_are_cut(kept):
    before, after = texts_of(kept[2]), texts_of(kept[3])
    unknown = before.pop(None)
    expected = brute_force(before, 100)
    assert after.pop(None) == unknown
    assert set(after) == {i for i, r in expected.items() if r[0] > r[1]}
    for i, text in after.items():
        n_bytes, removed, _, _ = expected[i]
        assert n_bytes - removed - 6 <= len(text.encode()) <= n_bytes - removed
    assert kept[3].where((F.char_length("text") != F.col("n_chars")) & F.col("doc_id").isNotNull()).count() == 0


def test_all_ids_are_packed(kept, tokenizer):  # noqa: F811
    check_pieces(kept[4].collect(), texts_of(kept[3]), tokenizer, 1024)


def test_run_gives_the_rows_of_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns[0] == "doc_id" and found.count() > 100


def test_empty_input_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("score", F.lit("clash"))
    rows = docs.limit(0)
    for name, apply in corpus_pipeline.STAGES[:3]:
        rows = apply(spark, rows, SF_DIR)
        assert rows.columns == docs.columns and rows.count() == 0
    few = docs.where("doc_id < 20")
    assert corpus_pipeline.cut_repeats(spark, few, SF_DIR).columns == docs.columns
    assert corpus_pipeline.drop_near_copies(spark, few, SF_DIR).columns == docs.columns
    assert corpus_pipeline.detect_language(spark, few, SF_DIR).columns == docs.columns
