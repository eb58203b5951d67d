import json

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import boosting
from millrace.operators.boosting import fit_gbt, fit_mean_boost
from millrace.operators.features import (
    FEATURES,
    check_levels,
    check_outputs,
    check_signature,
    feature_stages,
    predict,
    signature,
)


def encoded(stages, fit_on, df):
    model = Pipeline(stages=stages).fit(fit_on)
    return [list(r[0]) for r in model.transform(df).select(vector_to_array(FEATURES)).collect()]


def test_onehot_block_comes_first_and_unseen_levels_are_zero(spark):
    seen = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 3.0)], "c string, n double")
    rows = spark.createDataFrame([("a", 5.0), ("b", 6.0), ("zz", 7.0), (None, 8.0)], "c string, n double")
    assert encoded(feature_stages(["c"], ["n"]), seen, rows) == [
        [1.0, 0.0, 5.0],
        [0.0, 1.0, 6.0],
        [0.0, 0.0, 7.0],
        [0.0, 0.0, 8.0],
    ]


def test_column_names_with_blanks_and_quotes(spark):
    df = spark.createDataFrame([("a", 5)], "`my c` string, `it's n` int")
    assert encoded(feature_stages(["my c"], ["it's n"]), df, df) == [[1.0, 5.0]]


@pytest.mark.parametrize("value", [None, float("nan")])
def test_a_missing_number_is_named(spark, value):
    df = spark.createDataFrame([(1.0,), (value,)], "pH double")
    with pytest.raises(Exception, match="column pH has a missing value"):
        encoded(feature_stages([], ["pH"]), df, df)


@pytest.fixture(scope="module")
def prices(spark):
    rows = [(i, "xy"[i % 2], float(i % 2 * 10 + i % 5)) for i in range(400)]
    return spark.createDataFrame(rows, "k bigint, c string, y double")


def test_gbt_on_one_binary_feature_predicts_group_means(spark, prices):
    model = fit_gbt(prices, ["c"], [], "y", {"n_estimators": 2, "max_depth": 1})
    means = {r["c"]: r["m"] for r in prices.groupBy("c").agg(F.avg("y").alias("m")).collect()}
    scored = predict(model, prices)
    assert scored.columns == ["k", "c", "y", "prediction"]
    assert all(r["prediction"] == pytest.approx(means[r["c"]]) for r in scored.collect())


@pytest.mark.parametrize("stage_every", [1, 2, 10])
def test_mean_start_equals_its_closed_form(spark, prices, tmp_path, stage_every):
    rate, rounds = 0.2, 5
    params = {"learning_rate": rate, "n_estimators": rounds, "max_depth": 1}
    model = fit_mean_boost(prices, ["c"], [], "y", params, stage_every=stage_every)
    overall = prices.agg(F.avg("y")).first()[0]
    means = {r["c"]: r["m"] for r in prices.groupBy("c").agg(F.avg("y").alias("m")).collect()}
    expected = {c: overall + (1 - (1 - rate) ** rounds) * (m - overall) for c, m in means.items()}
    model.write().save(str(tmp_path / "model"))
    for each in (model, PipelineModel.load(str(tmp_path / "model"))):
        for row in predict(each, prices).collect():
            assert row["prediction"] == pytest.approx(expected[row["c"]])


def test_mean_start_with_no_rounds_is_the_mean(prices):
    model = fit_mean_boost(prices, ["c"], [], "y", {"n_estimators": 0})
    assert predict(model, prices).first()["prediction"] == pytest.approx(prices.agg(F.avg("y")).first()[0])


def test_training_needs_a_target_on_every_row(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None)], "x double, y double")
    with pytest.raises(Exception, match="column y has a missing value"):
        fit_gbt(df, [], ["x"], "y", {"n_estimators": 1, "max_depth": 1})


@pytest.mark.parametrize("fit", [fit_gbt, fit_mean_boost])
def test_a_fit_does_not_depend_on_partitions(spark, fit):
    rows = spark.range(15_000).select(
        F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("c"),
        (F.xxhash64("id") % 1_000_003).cast("double").alias("x"),
        F.sin(F.col("id")).alias("z"),
    )
    rows = rows.withColumn("y", F.col("x") / 1000 + 50 * F.col("z") + F.length("c"))
    params = {"n_estimators": 3, "max_depth": 4, "learning_rate": 0.3}
    found = []
    for parts in (1, 4, 9):
        model = fit(rows.repartition(parts), ["c"], ["x", "z"], "y", params)
        scored = predict(model, rows).orderBy("x", "z").select("prediction").collect()
        found.append([r[0] for r in scored])
    assert found[0] == pytest.approx(found[1]) and found[0] == pytest.approx(found[2])
    assert len(set(found[0])) > 20


def test_binned_numbers_keep_their_order(spark):
    rows = spark.range(500).select((F.col("id") % 40).cast("double").alias("x"))
    rows = rows.withColumn("y", F.when(F.col("x") >= 17, 5.0).otherwise(1.0))
    model = fit_gbt(rows, [], ["x"], "y", {"n_estimators": 1, "max_depth": 1, "maxBins": 64})
    assert "<=" in model.stages[-1].toDebugString
    more = spark.createDataFrame([(-5.0,), (16.5,), (17.0,), (99.0,)], "x double")
    assert [r["prediction"] for r in predict(model, more).collect()] == [1.0, 1.0, 5.0, 5.0]


def test_too_many_levels_are_named(prices):
    with pytest.raises(ValueError, match="column k has more than 100 levels"):
        check_levels(prices.withColumn("k", F.col("k").cast("string")), ["c", "k"], 100)


def test_signature(spark, prices):
    recorded = signature(prices, ["c", "k"])
    assert [f["name"] for f in json.loads(recorded)["inputs"]] == ["c", "k"]
    check_signature(recorded, prices)
    check_signature(recorded, prices.withColumn("k", F.col("k").cast("double")))
    with pytest.raises(ValueError, match="input column c is missing"):
        check_signature(recorded, prices.drop("c"))
    with pytest.raises(ValueError, match="input column k is string"):
        check_signature(recorded, prices.withColumn("k", F.col("k").cast("string")))


def test_features_are_written_once_and_meet_remainders_without_a_shuffle(spark, prices, monkeypatch):
    written, plans = [], []
    write, fit = boosting._Buckets.write, boosting.DecisionTreeRegressor.fit
    monkeypatch.setattr(boosting._Buckets, "write", lambda self, rows, *a, **k: written.append(rows.columns) or write(self, rows, *a, **k))

    def looked_at(self, rows, *args):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return fit(self, rows, *args)

    monkeypatch.setattr(boosting.DecisionTreeRegressor, "fit", looked_at)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        params = {"learning_rate": 0.1, "n_estimators": 7, "max_depth": 1}
        boosting.fit_mean_boost(prices, ["c"], [], "y", params, stage_every=2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(FEATURES in columns for columns in written) == 1 and len(written) == 5
    joins = [p for p in plans if "SortMergeJoin" in p]
    assert len(joins) == 7 and not any("Exchange" in p for p in joins)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("millrace_")]


def test_signatures_have_two_sides_and_nested_types(spark, prices):
    nested = "s struct<a:int,b:array<string>>, m map<string,double>, prediction double"
    frame = spark.createDataFrame([], nested)
    recorded = signature(frame, ["s", "m"], outputs=frame.select("prediction"))
    check_signature(recorded, frame)
    check_signature(recorded, spark.createDataFrame([], "m map<string,int>, s struct<b:array<string>,a:bigint,c:int>"))
    for other in ("s struct<a:int>, m map<string,double>", "s struct<a:int,b:array<int>>, m map<string,double>", "s string, m map<string,double>"):
        with pytest.raises(ValueError, match="input column s is"):
            check_signature(recorded, spark.createDataFrame([], other))
    check_outputs(recorded, frame)
    with pytest.raises(ValueError, match="output column prediction is float"):
        check_outputs(recorded, frame.withColumn("prediction", F.col("prediction").cast("float")))
    with pytest.raises(ValueError, match="output column prediction is missing"):
        check_outputs(recorded, frame.drop("prediction"))
    check_outputs(signature(prices, ["c"]), frame)


@pytest.mark.parametrize("start", ["gbt", "mean"])
def test_rows_of_a_learners_task_are_bounded(spark, monkeypatch, start):
    # One file, as large as it may get, must not be one task of the learner.
    rows = [(i, float(i * 7919 % 50), "abc"[i % 3], float(i % 11)) for i in range(2000)]
    frame = spark.createDataFrame(rows, "key long, x double, level string, y double").coalesce(1)
    monkeypatch.setattr(boosting, "TASK_ROWS", 150)
    learner = boosting.GBTRegressor if start == "gbt" else boosting.DecisionTreeRegressor
    sizes, fit = [], learner.fit

    def seen(self, given, *more):
        sizes.append([r["count"] for r in given.groupBy(F.spark_partition_id()).count().collect()])
        return fit(self, given, *more)

    monkeypatch.setattr(learner, "fit", seen)
    grow = boosting.fit_gbt if start == "gbt" else boosting.fit_mean_boost
    grow(frame, ["level"], ["x"], "y", {"n_estimators": 1, "max_depth": 2})
    assert sum(sizes[-1]) == 2000
    # Buckets are dealt by hash, so not quite evenly.
    assert max(sizes[-1]) <= (150 if start == "gbt" else 300)
