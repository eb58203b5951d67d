"""Gradient-boosted regression trees on Spark ML."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.columns import present_double
from millrace.operators.features import FEATURES, feature_stages, with_many_levels
from millrace.sources.storage import delete_path, fresh_path, shared_dir, stage, stage_scope

LABEL, ROW = "_label", "_row"
# The defaults of the three model parameters.
DEFAULT_PARAMS = {"learning_rate": 0.01, "n_estimators": 100, "max_depth": 6}
STAGE_EVERY = 10
# The tree learners' own default.
DEFAULT_BINS = 32
#: Rows that one task learns from: the learners keep them in memory and read them again for every level.
TASK_ROWS = 1_000_000


def _parameters(params: Mapping[str, Any] | None) -> tuple[float, int, int, dict[str, Any]]:
    """Learning rate, rounds, depth, and what else is meant for the tree learner itself."""
    merged = {**DEFAULT_PARAMS, **(params or {})}
    rate, rounds, depth = (merged.pop(name) for name in DEFAULT_PARAMS)
    return float(rate), int(rounds), int(depth), merged


@contextmanager
def _training_rows(
    df: DataFrame, cat: Sequence[str], num: Sequence[str], target: str
) -> Iterator[DataFrame]:
    """The columns a fit needs, written once, since a fit passes over its rows many times."""
    rows = df.select(*(F.col(f"`{c}`") for c in (*cat, *num)), present_double(target).alias(LABEL))
    path = fresh_path(df.sparkSession, "training")
    try:
        rows.write.parquet(path)
        yield df.sparkSession.read.schema(rows.schema).parquet(path)
    finally:
        delete_path(df.sparkSession, path)


def bin_edges(rows: DataFrame, num: Sequence[str], bins: int) -> list[list[float]]:
    """Lower edges of all bins but the first, for each numeric feature.

    The learner would draw its split points from rows it picks by their place, so the model would
    depend on the partitioning. These edges depend on the values alone: each feature's values are
    counted over all rows, and the exact quantiles are read off the counts in the order of the values.
    A feature with at most ``bins`` different values has a bin for each. Only finite values count.
    """
    if not num:
        return []
    each = [F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(num)]
    finite = rows.select(F.inline(F.array(*each))).where(F.abs("v") < float("inf"))
    counts = stage(finite.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")), "values")
    sizes = {r["i"]: (r["kinds"], r["n"]) for r in counts.groupBy("i").agg(F.count("*").alias("kinds"), F.sum("n").alias("n")).collect()}
    edges: list[list[float]] = [[0.0] for _ in num]
    few = [i for i, (kinds, _) in sizes.items() if kinds <= bins]
    values = counts.where(F.col("i").isin(few)).select("i", "v").collect() if few else []
    for i in few:
        found = sorted(r["v"] for r in values if r["i"] == i)
        edges[i] = found[1:] or found
    places = {
        i: [(n - 1) * (k / bins) for k in range(1, bins)] for i, (_, n) in sizes.items() if i not in few
    }
    if places:
        ranks = {i: sorted({f(x) for x in own for f in (math.floor, math.ceil)}) for i, own in places.items()}
        at = _values_at(counts.where(F.col("i").isin(list(ranks))), ranks)
        for i, own in places.items():
            found = set()
            for x in own:
                low, high = math.floor(x), math.ceil(x)
                a, b = at[i, low], at[i, high]
                found.add(a if a == b else (high - x) * a + (x - low) * b)
            edges[i] = sorted(found)
    return edges


def _values_at(counts: DataFrame, ranks: Mapping[int, Sequence[int]]) -> dict[tuple[int, int], float]:
    """The value at each rank (from 0) of each feature ``i``, from (i, v, n) over all its values.

    One range sort over different values, then running counts within its parts; the driver gets the
    sums of the parts and the values asked for.
    """
    ordered = stage(counts.orderBy("i", "v").withColumn("part", F.spark_partition_id()), "ordered")
    sums = ordered.groupBy("i", "part").agg(F.sum("n").alias("n")).orderBy("i", "part").collect()
    found, before = {}, dict.fromkeys(ranks, 0)
    wanted = []
    for r in sums:
        start, end = before[r["i"]], before[r["i"]] + r["n"]
        before[r["i"]] = end
        own = [x - start for x in ranks[r["i"]] if start <= x < end]
        if own:
            wanted.append((r["i"], r["part"], start, own))
    spark = counts.sparkSession
    asked = spark.createDataFrame(wanted, "i int, part int, start long, ranks array<long>")
    window = Window.partitionBy("i", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = ordered.join(F.broadcast(asked), ["i", "part"]).withColumn("until", F.sum("n").over(window))
    hit = F.filter("ranks", lambda x: (x < F.col("until")) & (x >= F.col("until") - F.col("n")))
    for r in running.select("i", "v", "start", hit.alias("hit")).where(F.size("hit") > 0).collect():
        found |= {(r["i"], r["start"] + x): r["v"] for x in r["hit"]}
    return found


def fit_gbt(
    df: DataFrame,
    cat: Sequence[str],
    num: Sequence[str],
    target: str,
    params: Mapping[str, Any] | None = None,
) -> PipelineModel:
    """Encode, then fit ``GBTRegressor``: its first tree counts fully, later ones by the rate.

    ``params`` holds ``learning_rate``, ``n_estimators``, ``max_depth`` and any further parameter
    of the regressor by its Spark name. Levels of a column beyond ``MAX_LEVELS`` stay in a table that
    the model carries along.
    """
    rate, rounds, depth, extra = _parameters(params)
    shared_dir(df.sparkSession)
    options = {"seed": 42, "checkpointInterval": STAGE_EVERY, **extra}
    regressor = GBTRegressor(
        featuresCol=FEATURES,
        labelCol=LABEL,
        stepSize=rate,
        maxIter=rounds,
        maxDepth=depth,
        **options,
    )
    with _training_rows(df, cat, num, target) as training:
        wide = training if with_many_levels(training, cat) else None
        with stage_scope(df.sparkSession):
            edges = bin_edges(training, num, regressor.getMaxBins())
        encoder = Pipeline(stages=feature_stages(cat, num, edges, wide)).fit(training)
        model = regressor.fit(encoder.transform(_in_tasks(training)))
    return PipelineModel(stages=[*encoder.stages, model])


def _tasks_for(rows: DataFrame) -> int:
    return max(1, -(-rows.count() // TASK_ROWS))


def _in_tasks(rows: DataFrame) -> DataFrame:
    """``rows``, dealt out evenly if there may be more than ``TASK_ROWS`` to a task.

    A task's part of a file is bounded by its size on storage alone, which says little about that of its
    rows in memory.
    """
    tasks = _tasks_for(rows)
    if tasks == 1:
        return rows
    return rows.repartition(max(tasks, rows.sparkSession.sparkContext.defaultParallelism))


def fit_mean_boost(
    df: DataFrame,
    cat: Sequence[str],
    num: Sequence[str],
    target: str,
    params: Mapping[str, Any] | None = None,
    stage_every: int = STAGE_EVERY,
) -> PipelineModel:
    """Boosting that starts from the mean of the target, every tree counting by the rate.

    The start is a tree of depth 0 that holds the mean. Each round fits a tree to what the trees so
    far leave over. The result is one ordinary ``GBTRegressionModel`` made of all these trees, so
    it predicts in one pass and is saved and loaded like any other model.

    Vectors are written once, in buckets by a row number; what is left over is a table of its own, in
    the same buckets, so both meet without a shuffle. Only this narrow table is written again, after
    every ``stage_every`` rounds; in between, the remainder comes from it and the few trees since. So
    plans do not grow with the rounds, and a lost executor costs a part of one round.
    """
    rate, rounds, depth, extra = _parameters(params)
    spark = df.sparkSession
    options = {"seed": 42, **extra}

    def grow(rows: DataFrame, max_depth: int) -> DecisionTreeRegressionModel:
        learner = DecisionTreeRegressor(
            featuresCol=FEATURES, labelCol=LABEL, maxDepth=max_depth, **options
        )
        return learner.fit(rows)

    with _training_rows(df, cat, num, target) as training, _Buckets(spark, ROW) as buckets:
        wide = training if with_many_levels(training, cat) else None
        with stage_scope(spark):
            edges = bin_edges(training, num, int(extra.get("maxBins", DEFAULT_BINS)))
        encoder = Pipeline(stages=feature_stages(cat, num, edges, wide)).fit(training)
        encoded = encoder.transform(training).select(FEATURES, LABEL)
        # A number for each row that is settled once it is written.
        whole = stage(encoded.withColumn(ROW, F.monotonically_increasing_id()), "encoded")
        buckets.count = max(buckets.count, _tasks_for(whole))
        features = buckets.write(whole.select(ROW, FEATURES))
        labels = buckets.write(whole.select(ROW, LABEL))
        mean = labels.agg(F.avg(LABEL)).first()[0]
        if mean is None:
            raise ValueError("there is no row to fit a model on")
        size = features.select(FEATURES).first()[0].size
        # The tree that knows the mean only is grown from two rows of the right size.
        blank = spark.createDataFrame([(Vectors.sparse(size, []), mean)] * 2, [FEATURES, LABEL])
        trees, weights = [grow(blank, 0)], [1.0]
        pending = 1
        for _ in range(rounds):
            left_over = remainders(features, labels, trees[len(trees) - pending :], weights[len(trees) - pending :])
            if pending >= stage_every:
                labels, old = buckets.write(left_over.select(ROW, LABEL), dealt=True), labels
                buckets.drop(old)
                left_over, pending = remainders(features, labels, [], []), 0
            trees.append(grow(left_over.select(FEATURES, LABEL), depth))
            weights.append(rate)
            pending += 1
    return PipelineModel(stages=[*encoder.stages, _ensemble(spark, trees, weights)])


def remainders(
    features: DataFrame, labels: DataFrame, trees: Sequence, weights: Sequence[float]
) -> DataFrame:
    """(row, vector, what the trees leave of its label), of two tables in the same buckets."""
    rows = features.join(labels, ROW)
    if not trees:
        return rows
    scored = _ensemble(features.sparkSession, list(trees), list(weights)).transform(rows)
    return scored.select(ROW, FEATURES, (F.col(LABEL) - F.col("prediction")).alias(LABEL))


class _Buckets:
    """Tables in the shared folder that are bucketed by one key, dropped at the end of the block."""

    def __init__(self, spark: SparkSession, key: str):
        self.spark, self.key = spark, key
        self.count = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.paths: dict[str, str] = {}

    def __enter__(self) -> _Buckets:
        return self

    def write(self, rows: DataFrame, dealt: bool = False) -> DataFrame:
        """``rows`` as a table; ``dealt``: they come from these buckets and lie right already."""
        name = f"millrace_{uuid.uuid4().hex}"
        self.paths[name] = fresh_path(self.spark, "buckets")
        if not dealt:
            rows = rows.repartition(self.count, self.key)
        writer = rows.write.bucketBy(self.count, self.key).sortBy(self.key)
        writer.option("path", self.paths[name]).saveAsTable(name)
        return self.spark.table(name)

    def drop(self, table: DataFrame) -> None:
        for name, path in list(self.paths.items()):
            if any(f"/{path.rsplit('/', 1)[1]}/" in file for file in table.inputFiles()[:1]):
                self._drop(name)

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(self.spark, self.paths.pop(name))

    def __exit__(self, *_: object) -> None:
        for name in list(self.paths):
            self._drop(name)


def _ensemble(spark: SparkSession, trees: list, weights: list[float]) -> GBTRegressionModel:
    """One boosted model from single trees and their weights."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    regression = jvm.org.apache.spark.ml.regression
    java_trees = gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    java_weights = gateway.new_array(jvm.double, len(weights))
    for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        java_trees[i] = tree._java_obj
        java_weights[i] = weight
    uid = GBTRegressor._randomUID()
    model = GBTRegressionModel(regression.GBTRegressionModel(uid, java_trees, java_weights))
    model.setFeaturesCol(FEATURES)
    model.setPredictionCol("prediction")
    return model
