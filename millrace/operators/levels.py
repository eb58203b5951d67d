"""One-hot encoding of any number of levels: their dictionary is a table and never on the driver.

The different values of all categorical columns are found in one scan, sorted and numbered by blocks,
and written as (feature, level, place). Rows meet the dictionary in a join, at fit and at score: Spark
sends a small one to every task and shuffles by level otherwise, and adaptive execution splits a level
that very many rows share, because both sides of the join are plain. Vectors are put together inside the
JVM, as the columns that a sparse vector is made of.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.keys import add_sequential_key
from millrace.sources.storage import fresh_path

FEATURE, LEVEL, PLACE = "feature", "level", "place"
#: Places of a vector: its indices are 32-bit integers.
MOST_PLACES = (1 << 31) - 1


def level_dictionary(df: DataFrame, cat: Sequence[str]) -> DataFrame:
    """(feature, level, place) of every level of every column of ``cat``; places count from 0 in order.

    NULL is no level. ``feature`` is the column's position in ``cat``.
    """
    each = [F.struct(F.lit(i).alias(FEATURE), F.col(f"`{c}`").cast("string").alias(LEVEL)) for i, c in enumerate(cat)]
    found = df.select(F.inline(F.array(*each))).where(F.col(LEVEL).isNotNull()).distinct()
    numbered = add_sequential_key(found, [FEATURE, LEVEL], "_at")
    # One row for each column.
    firsts = numbered.groupBy(FEATURE).agg(F.min("_at").alias("_first"))
    placed = numbered.join(F.broadcast(firsts), FEATURE)
    return placed.select(FEATURE, LEVEL, (F.col("_at") - F.col("_first")).cast("int").alias(PLACE))


def level_counts(dictionary: DataFrame, features: int) -> list[int]:
    """How many levels each column has: one number a column."""
    counts = dict(map(tuple, dictionary.groupBy(FEATURE).count().collect()))
    return [counts.get(i, 0) for i in range(features)]


def as_vector(parts: Column) -> Column:
    """A struct of a vector's own parts, as a vector."""

    @F.arrow_udf(VectorUDT())
    def run(column: pa.Array) -> pa.Array:
        return column

    return run(parts)


class LevelEncoder(Transformer, MLWritable, MLReadable):
    """One-hot block by a dictionary table, then numbers, as one sparse vector.

    ``cat`` are the categorical columns, ``num`` numeric ones that are complete, ``sizes`` the numbers of
    levels, ``path`` the dictionary's folder. A level that the dictionary lacks, or NULL, is all zeros.
    """

    cat = Param(Params._dummy(), "cat", "categorical columns", TypeConverters.toListString)
    num = Param(Params._dummy(), "num", "numeric columns", TypeConverters.toListString)
    sizes = Param(Params._dummy(), "sizes", "levels of each column", TypeConverters.toListInt)
    output = Param(Params._dummy(), "output", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, cat=None, num=None, sizes=None, output=None, path=None):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if k != "path" and v is not None}
        self._set(**given)
        self.path = path

    def _transform(self, df: DataFrame) -> DataFrame:
        cat, num, sizes = (self.getOrDefault(p) for p in (self.cat, self.num, self.sizes))
        dictionary = df.sparkSession.read.parquet(self.path)
        rows, indices, values, base = df, [], [], 0
        for i, (c, size) in enumerate(zip(cat, sizes)):
            own = dictionary.where(F.col(FEATURE) == i).select(
                F.col(LEVEL).alias(f"_level_{i}"), F.col(PLACE).alias(f"_place_of_{i}")
            )
            rows = rows.join(own, F.col(f"`{c}`").cast("string") == F.col(f"_level_{i}"), "left")
            indices.append(F.col(f"_place_of_{i}") + base)
            values.append(F.when(F.col(f"_place_of_{i}").isNotNull(), F.lit(1.0)))
            base += size
        indices += [F.lit(base + j) for j in range(len(num))]
        values += [F.col(f"`{c}`").cast("double") for c in num]
        parts = F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(base + len(num)).alias("size"),
            F.array_compact(F.array(*indices)).cast("array<int>").alias("indices"),
            F.array_compact(F.array(*values)).cast("array<double>").alias("values"),
        )
        output = self.getOrDefault(self.output)
        return rows.select(*(F.col(f"`{c}`") for c in df.columns), as_vector(parts).alias(output))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    """Params as the library writes them; the dictionary is copied, so that a model stands alone."""

    def __init__(self, encoder: LevelEncoder):
        super().__init__()
        self.encoder = encoder

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.encoder, path, self.sparkSession)
        self.sparkSession.read.parquet(self.encoder.path).write.parquet(f"{path}/levels")


class _Reader(MLReader):
    def load(self, path: str) -> LevelEncoder:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        encoder = LevelEncoder(path=f"{path}/levels")
        encoder._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(encoder, metadata)
        return encoder


def fit_levels(df: DataFrame, cat: Sequence[str], num: Sequence[str], output: str) -> LevelEncoder:
    """Learn the dictionary of ``cat`` from all rows of ``df``; the encoder is a stage of a pipeline."""
    spark: SparkSession = df.sparkSession
    path = fresh_path(spark, "levels")
    level_dictionary(df, cat).write.parquet(path)
    sizes = level_counts(spark.read.parquet(path), len(cat))
    if sum(sizes) + len(num) > MOST_PLACES:
        raise ValueError(f"{sum(sizes)} levels are more than a vector has places: {json.dumps(dict(zip(cat, sizes)))}")
    return LevelEncoder(cat=list(cat), num=list(num), sizes=sizes, output=output, path=path)
