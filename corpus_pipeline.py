"""From raw documents to packed training sequences, in four stages.

Each stage takes ``(spark, docs, sf_dir)`` and reads all rows that the stage before kept. Its result is
written as Parquet in the shared folder and read again as the next stage's ``docs``. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import langid, packing, repeats, simhash, workers
from millrace.sources.storage import stage

#: A text whose language is less likely than this is rejected: no language has a majority.
LEAST_SCORE = 0.5
#: Rows of an Arrow batch in all stages. Texts are whole and may be long, and Python workers of one
#: stage live on in the next, beside the executor's own memory.
BATCH_ROWS = 500


def _prepare(spark: SparkSession) -> None:
    workers.find_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in one of the labelled languages; others, such as texts without a letter, go.

    The model learns from the labelled rows of ``docs`` alone. ``lang`` keeps its label, and NULL is
    filled with the predicted language. Without any label there is nothing to tell, and only texts
    without a letter go.
    """
    _prepare(spark)
    model = langid.fit(docs)
    found = langid.identify(docs, model)
    if model.languages:
        sure = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    else:
        sure = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    named = F.when(F.col("lang_pred") != langid.UNKNOWN, F.col("lang_pred"))
    return found.where(sure).select(
        *[F.coalesce("lang", named).alias("lang") if c == "lang" else F.col(c) for c in docs.columns]
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest ``doc_id`` of each group of linked SimHash fingerprints.

    Shingles of three words and at most three differing bits, as the operator's own query has them.
    """
    _prepare(spark)
    return simhash.keep_one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 100 bytes that appeared earlier; texts without a rest go.

    Bytes of a character that was cut through are left out. ``n_chars`` counts what is left.
    """
    _prepare(spark)
    cut = repeats.remove_repeats(docs)
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(repeats.text_of("kept"))
    changed = cut.where((F.col("n_removed") == 0) | (F.octet_length("kept") > 0)).withColumn(
        "__text", text
    )
    whole = (F.col("n_removed") == 0) | F.col("__text").isNull()
    columns = {
        "text": F.col("__text"),
        "n_chars": F.when(whole, F.col("n_chars")).otherwise(F.char_length("__text").cast("long")),
    }
    return changed.where(F.col("__text").isNull() | (F.length("__text") > 0) | whole).select(
        *[columns.get(c, F.col(c)).alias(c) for c in docs.columns]
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts in windows of 1,024 token ids."""
    _prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language", detect_language),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("packing", pack),
]

#: Hash majorities, n-gram models and tokenizers cannot be put in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
