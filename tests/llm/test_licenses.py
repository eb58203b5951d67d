import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import licenses
from millrace.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(text):
    """(n_words, n_base, first, last, base_labels, labels, score) by trying every place."""
    words = WORD.findall((text or "").translate(UPPER))
    places, base = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        own = phrase.split()
        at = [p for p in range(len(words)) if words[p : p + len(own)] == own]
        places += at
        base |= {label} if at else set()
    labels, score = set(base), 1.0 if base else 0.0
    for label, templates in licenses.TEMPLATES.items():
        for own in (t.split() for t in templates):
            votes = {}
            for t in range(len(own) - 1):
                for p in range(len(words) - 1):
                    if words[p : p + 2] == own[t : t + 2]:
                        votes.setdefault(p - t, set()).add(t)
            span, before = set(), None
            for diagonal in [*sorted(votes), None]:
                if before is not None and (diagonal is None or diagonal - before > licenses.SLACK):
                    share = len(span) / (len(own) - 1)
                    if share >= licenses.COVER:
                        labels.add(label)
                        score = max(score, share)
                    span = set()
                if diagonal is not None:
                    span |= votes[diagonal]
                before = diagonal
    ends = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score


def plain(row):
    return tuple(row[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")) + (
        pytest.approx(row["score"]),
    )


def test_query_equals_brute_force(spark):
    found = QUERIES["op10_license_scan"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    texts = {r["doc_id"]: r["text"] for r in docs}
    assert len(found) == len(texts)
    for r in found:
        assert plain(r) == brute_force(texts[r["doc_id"]])


TEXTS = [
    None,
    "",
    "!!!",
    "MIT",
    "MIT License. mit-license, MIT\nLICENSE",
    "the general public license of the General Public License",
    "Licensed under the Apache License, Version 2.0.",
    "licensed under an apache license version 2 0",
    "Licensed today under the quite new Apache License, and version 2.0.",
    "Licensed under CC BY-NC 4.0.",
    "Permission is granted hereby, free of charge, to any person obtaining one copy of this software and "
    "associated documentation files",
    "éMIT License MITé License mitK license",
    "mit license " * 3000,
    "redistribution and use in source " * 50,
]


def test_edge_texts_equal_brute_force(spark):
    rows = [*enumerate(TEXTS), (None, TEXTS[6]), (4, TEXTS[4])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("labels", F.lit("clash"))
    found = licenses.scan_licenses(frame.repartition(3)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert plain(r) == brute_force(TEXTS[6 if r["doc_id"] is None else r["doc_id"]])
    assert licenses.scan_licenses(frame.limit(0)).count() == 0


def test_no_python_on_executors(spark):
    plan = QUERIES["op10_license_scan"](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    assert not re.search("Python|Arrow|Pandas", plan.executedPlan().toString())


def test_templates_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(licenses, "MAX_TEMPLATE_GRAMS", 3)
    with pytest.raises(ValueError, match="template k-grams"):
        licenses.template_grams(spark, licenses.BASE_PHRASES, {})
    with pytest.raises(ValueError, match="needs 2 words"):
        licenses.template_grams(spark, {"mit": "mit"}, {})
