"""License scans by diagonal voting.

All rolling word k-grams of all texts meet the k-grams of license templates in a hash join. A hit at
word ``p`` of a text and word ``t`` of a template votes for the diagonal ``p - t``. Votes are summed
by diagonal, neighbouring diagonals are merged (an inserted or missing word moves a match to the
next diagonal), and a merged span counts if it covers enough of its template.

Everything is DataFrame work. Each hit compares the words themselves, so hash collisions cannot
produce a match.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words of a k-gram.
K = 2
#: Template k-grams that may be broadcast; a larger table is refused, not cut.
MAX_TEMPLATE_GRAMS = 100_000
#: Diagonals at most this far apart are merged.
SLACK = 2
#: Share of a template's k-grams that a merged span must cover.
COVER = 0.7

# The phrases of the base scan and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# License statements as they are commonly written, in lower case.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
    ],
    "gpl-3": [
        "licensed under the gnu general public license version 3",
        "under the terms of the gnu general public license as published by the free software "
        "foundation",
    ],
    "cc-by-nc": [
        "licensed under cc by nc 4 0",
        "creative commons attribution noncommercial 4 0 international license",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met"
    ],
    "mpl-2.0": ["subject to the terms of the mozilla public license v 2 0"],
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of digits, a-z and everything beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, _NO_WORD), "")


def template_grams(
    spark: SparkSession, phrases: Mapping[str, str], templates: Mapping[str, Sequence[str]]
) -> DataFrame:
    """One row for each k-gram of each template: its words, place, label and template size."""
    listed = [(text, label, True) for text, label in phrases.items()]
    listed += [(text, label, False) for label, texts in templates.items() for text in texts]
    rows = []
    for number, (text, label, base) in enumerate(listed):
        own = text.split()
        if len(own) < K:
            raise ValueError(f"a template needs {K} words: {text!r}")
        grams = len(own) - K + 1
        rows += [(*own[i : i + K], number, i, grams, label, base) for i in range(grams)]
    if len(rows) > MAX_TEMPLATE_GRAMS:
        raise ValueError(f"{len(rows)} template k-grams; the limit is {MAX_TEMPLATE_GRAMS}")
    schema = "t0 string, t1 string, tmpl int, tpos int, grams int, label string, base boolean"
    return spark.createDataFrame(rows, schema).withColumn("gram", F.xxhash64("t0", "t1"))


def scan_licenses(
    docs: DataFrame,
    phrases: Mapping[str, str] = BASE_PHRASES,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
) -> DataFrame:
    """One row for each row of ``docs``: places of base phrases, labels, best cover.

    Defined results: NULL and empty texts have no word, no place, empty labels and score 0; rows are
    told apart by position, so repeated rows and NULL ``doc_id`` give one result each; an empty
    table gives no rows; columns other than ``doc_id`` and ``text`` are not read. A phrase's place
    counts each time, overlapping or not. ``score`` is the largest covered share of any template
    that counts, 1 for a base phrase.
    """
    table = F.broadcast(template_grams(docs.sparkSession, phrases, templates))
    listed = docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", words(F.col("text")).alias("w")
    )
    # One row for each word; the last word, and a text without words, keep a row with a NULL partner.
    grams = listed.select(
        "rid",
        "doc_id",
        F.size("w").alias("n"),
        F.posexplode_outer(F.arrays_zip(F.col("w").alias("a"), F.expr("slice(w, 2, greatest(size(w), 1))").alias("b"))),
    ).select(
        "rid",
        "doc_id",
        "n",
        F.coalesce("pos", F.lit(0)).alias("pos"),
        F.col("col.a").alias("a"),
        F.col("col.b").alias("b"),
    )
    keyed = grams.withColumn("gram", F.xxhash64("a", "b"))
    same = (
        (keyed["gram"] == table["gram"]) & (keyed["a"] == table["t0"]) & (keyed["b"] == table["t1"])
    )
    # Votes; the first row of each text stays without a hit, so that every text has a result.
    hits = (
        keyed.join(table, same, "left")
        .where(F.col("tmpl").isNotNull() | (F.col("pos") == 0))
        .select("rid", "doc_id", "n", "pos", "tmpl", "tpos", "grams", "label", "base")
    )
    votes = hits.groupBy(
        "rid", "doc_id", "n", "tmpl", "grams", "label", "base", (F.col("pos") - F.col("tpos")).alias("diag")
    ).agg(F.collect_set("tpos").alias("seen"))
    by_diagonal = Window.partitionBy("rid", "tmpl").orderBy("diag")
    # Base phrases are exact: no merging. Others join the diagonal before if it is near.
    starts = F.when(
        F.col("base") | F.lag("diag").over(by_diagonal).isNull()
        | (F.col("diag") - F.lag("diag").over(by_diagonal) > SLACK),
        1,
    ).otherwise(0)
    spans = (
        votes.withColumn("starts", starts)
        .withColumn("span", F.sum("starts").over(by_diagonal))
        .groupBy("rid", "doc_id", "n", "tmpl", "grams", "label", "base", "span")
        .agg(
            F.min("diag").alias("place"),
            F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("covered"),
        )
        .withColumn("share", F.col("covered") / F.col("grams"))
    )
    exact = F.col("base") & (F.col("covered") == F.col("grams"))
    found = exact | (~F.col("base") & (F.col("share") >= COVER))
    joined = lambda flag: F.array_join(
        F.array_sort(F.collect_set(F.when(flag, F.col("label")))), ","
    )
    return spans.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n").cast("long").alias("n_words"),
        F.count(F.when(exact, 1)).alias("n_base"),
        F.min(F.when(exact, F.col("place"))).cast("long").alias("first_word"),
        F.max(F.when(exact, F.col("place"))).cast("long").alias("last_word"),
        joined(exact).alias("base_labels"),
        joined(found).alias("labels"),
        F.coalesce(F.max(F.when(found, F.col("share"))), F.lit(0.0)).alias("score"),
    ).drop("rid")
