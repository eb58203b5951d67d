"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters of the lower-cased whole text give n-grams of one to three code points, hashed into
``FEATURES`` counters. Document frequencies are counted over all labelled rows. The weights are
trained by the follow-the-regularised-leader rule with an L1 and an L2 penalty, on a bounded sample:
the ``ROWS_PER_LANGUAGE`` rows of each language with the smallest hash of their key. A fifth of the
sample takes no part in training and sets the temperature that calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from millrace.llm import workers

#: Hash places for n-grams.
FEATURES = 1 << 15
#: Longest n-gram.
LONGEST = 3
#: The bound of the training sample, for each language, and of the number of languages.
ROWS_PER_LANGUAGE = 800
MAX_LANGUAGES = 500
#: Groups of tasks whose first rows of a language are brought together before those of all.
PARTS = 64
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 0.1, 3
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_MIX = np.uint32(2654435761)


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(places, counts) of the n-grams of a whole text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found, rolled = [], np.zeros(len(points), np.uint32)
    shift = np.uint32(32 - (FEATURES.bit_length() - 1))
    for n in range(1, LONGEST + 1):
        if len(points) < n:
            break
        rolled = rolled[: len(points) - n + 1] * np.uint32(16777619) + points[n - 1 :] + np.uint32(n)
        mixed = (rolled ^ (rolled >> np.uint32(15))) * _MIX
        found.append(mixed >> shift)
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    counts = np.bincount(np.concatenate(found), minlength=FEATURES)
    places = np.flatnonzero(counts)
    return places, counts[places]


@dataclass
class LanguageModel:
    """Weights (languages x features and a constant), inverse document frequencies, temperature."""

    languages: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float = 1.0

    def logits(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        values = tfidf(places, counts, self.idf)
        return self.weights[:, places] @ values + self.weights[:, -1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0
        odds = softmax(self.logits(*ngrams(text)) / self.temperature)
        best = int(odds.argmax())
        return self.languages[best], float(odds[best])


def tfidf(places: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[places]
    return values / max(float(np.sqrt(values @ values)), 1e-12)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train_ftrl(
    samples: list[tuple[np.ndarray, np.ndarray, int]], languages: int, seed: int = 7
) -> np.ndarray:
    """Weights from (places, values, language) rows; the last place is the constant."""
    z = np.zeros((languages, FEATURES + 1))
    n = np.zeros((languages, FEATURES + 1))
    order = np.random.default_rng(seed)

    def weights(zs, ns):
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(ns)) / ALPHA + L2)

    for _ in range(EPOCHS):
        for at in order.permutation(len(samples)):
            places, values, language = samples[at]
            own = np.append(places, FEATURES)
            x = np.append(values, 1.0)
            zs, ns = z[:, own], n[:, own]
            w = weights(zs, ns)
            wrong = softmax(w @ x)
            wrong[language] -= 1
            gradient = wrong[:, None] * x
            grown = ns + gradient * gradient
            z[:, own] = zs + gradient - (np.sqrt(grown) - np.sqrt(ns)) / ALPHA * w
            n[:, own] = grown
    return weights(z, n)


def calibrate(logits: np.ndarray, truth: np.ndarray) -> float:
    """Temperature with the least log loss, by golden-section search over its logarithm.

    The target of the true language is (m + 1) / (m + k) for m rows and k languages, and that of each
    other 1 / (m + k); without this, rows that are all told apart would ask for a temperature of 0.
    """
    if not len(truth):
        return 1.0
    targets = np.full(logits.shape, 1.0)
    targets[np.arange(len(truth)), truth] += len(truth)
    targets /= targets.sum(axis=1, keepdims=True)

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1)
        total = top + np.log(np.exp(scaled - top[:, None]).sum(axis=1))
        return float(np.mean(total - (targets * scaled).sum(axis=1)))

    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(50):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """Learn from the rows of ``docs`` with text and ``lang``.

    Rows with NULL ``doc_id``, ``text`` or ``lang``, or without an n-gram, teach nothing. Without any
    row the model knows no language and answers ``und``. More than ``MAX_LANGUAGES`` labels are refused.
    """
    known = docs.where("text is not null and lang is not null and doc_id is not null")
    # Before anything that grows with the number of languages reaches the driver.
    labels = known.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if labels > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    frequencies, rows = _frequencies(known.select("text"))
    idf = np.log((1 + rows) / (1 + frequencies)) + 1
    # The first rows of each task, then of the tasks of each part, then of a language.
    by_hash = F.xxhash64("doc_id")
    chosen = known.select("lang", "doc_id", (F.spark_partition_id() % PARTS).alias("part"))
    for keys in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(by_hash, "doc_id")
        chosen = chosen.withColumn("at", F.row_number().over(order))
        chosen = chosen.where(F.col("at") <= rows_per_language).drop("at")
    chosen = chosen.select("doc_id").distinct()
    # At most rows_per_language * MAX_LANGUAGES keys.
    texts = known.join(F.broadcast(chosen), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    coded = texts.select("doc_id", "lang", _coded("text").alias("grams")).select(
        "doc_id", "lang", "grams.*"
    )
    samples = sorted(coded.collect(), key=lambda r: (r["lang"], r["doc_id"]))
    languages = sorted({r["lang"] for r in samples})
    if not languages:
        return LanguageModel([], np.zeros((0, FEATURES + 1)), idf)
    ready = []
    for r in samples:
        places = np.frombuffer(r["places"], "<u2").astype(np.int64)
        counts = np.frombuffer(r["counts"], "<u4")
        if len(places):
            ready.append((places, tfidf(places, counts, idf), languages.index(r["lang"])))
    held, used = ready[::5], [r for i, r in enumerate(ready) if i % 5]
    weights = train_ftrl(used, len(languages))
    logits = [weights[:, p] @ v + weights[:, -1] for p, v, _ in held]
    truth = np.array([c for _, _, c in held], np.int64)
    temperature = calibrate(np.array(logits).reshape(len(held), len(languages)), truth)
    return LanguageModel(languages, weights, idf, temperature)


def _frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Number of texts with each n-gram, and of all texts: one small vector from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("langid")
        seen = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[ngrams(text)[0]] += 1
                seen[FEATURES] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(seen[at])], ["place", "n"]
        )

    total = np.zeros(FEATURES + 1, np.int64)
    counted = texts.mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    for place, n in counted.collect():
        total[place] = n
    return total[:FEATURES], int(total[FEATURES])


def _coded(text: str) -> Column:
    kind = "struct<places: binary, counts: binary>"

    @arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        workers.enter("langid")
        found = [ngrams(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [
                pa.array([p.astype("<u2").tobytes() for p, _ in found], pa.binary()),
                pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary()),
            ],
            ["places", "counts"],
        )

    return run(text)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    A text that is NULL or has no letter is ``und`` with score 0, as is every text for a model
    without languages. Input columns of these two names are replaced, all others kept; repeated rows
    give equal results.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf("struct<lang: string, score: double>")
    def run(texts: pa.Array) -> pa.Array:
        workers.enter("langid")
        own = shared.value
        found = [own.predict(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
            ["lang", "score"],
        )

    kept = docs.drop("lang_pred", "score")
    return (
        kept.withColumn("__found", run("text"))
        .withColumn("lang_pred", F.col("__found.lang"))
        .withColumn("score", F.col("__found.score"))
        .drop("__found")
    )


def held_out(key: str, parts: int, part: int) -> Column:
    """Whether the checksum of the key as text falls in ``part`` of ``parts``; NULL never does."""
    rest = F.crc32(F.col(key).cast("string").cast("binary")) % parts
    return F.coalesce(rest == part, F.lit(False))
