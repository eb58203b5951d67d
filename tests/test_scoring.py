import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import scoring


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, 10.0, "a"), (2, 20.0, "b"), (3, 30.0, "c")], "k int, x double, s string")


def test_python_model_gives_one_prediction_per_row(spark, items):
    class Model:
        factor = 2.0

        def predict(self, batch: pd.DataFrame):
            assert list(batch.columns) == ["x"]
            return (batch["x"] * self.factor).to_numpy()

    scored = scoring.score_with(items.repartition(3), Model().predict, ["x"])
    assert rows(scored) == [(1, 10.0, "a", 20.0), (2, 20.0, "b", 40.0), (3, 30.0, "c", 60.0)]


def test_only_features_travel_to_python(items):
    plan = scoring.score_with(items, lambda b: b["x"], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan
    assert "Exchange" not in plan


def test_a_model_with_too_few_predictions_stops_the_query(items):
    with pytest.raises(Exception, match="1 predictions for"):
        scoring.score_with(items.coalesce(1), lambda b: [1.0], ["x"]).collect()


def test_forms_of_predictions(spark, items):
    keys = items.select("k")
    per_row = items.select("k", F.col("x").alias("prediction"))
    one_row = items.agg(F.max("x").alias("prediction"))
    attach = scoring.attach_predictions
    assert rows(attach(keys, per_row, "k")) == [(1, 10.0), (2, 20.0), (3, 30.0)]
    assert rows(attach(keys, one_row, "k")) == [(1, 30.0), (2, 30.0), (3, 30.0)]
    assert rows(attach(keys, 4, "k")) == [(1, 4.0), (2, 4.0), (3, 4.0)]
    assert rows(attach(keys, None, "k")) == [(1, None), (2, None), (3, None)]
    assert dict(attach(keys, None, "k").dtypes)["prediction"] == "double"


@pytest.mark.parametrize(
    ("predicted", "problem"),
    [([1, 2], "without a prediction"), ([1, 2, 3, 4], "not among the rows"), ([1, 2, 3, 3], "more than once")],
)
def test_predictions_must_fit_the_rows(spark, items, predicted, problem):
    predictions = spark.createDataFrame([(k, 0.0) for k in predicted], "k int, prediction double")
    with pytest.raises(ValueError, match=problem):
        scoring.attach_predictions(items, predictions, "k")


def test_save_predictions(spark, items, database):
    predictions = spark.createDataFrame([(1, 0.5), (3, 1.5), (9, 9.0)], "k int, prediction double")
    written = scoring.save_predictions(items, predictions, "k", f"{database}.p")
    assert written.columns == ["k", "x", "s", "prediction", "prediction_timestamp_utc"]
    assert rows(written.select("k", "prediction")) == [(1, 0.5), (2, None), (3, 1.5)]
    assert written.where("prediction_timestamp_utc is null").isEmpty()
    assert rows(spark.table(f"{database}.p")) == rows(written)


def test_save_refuses_two_predictions_for_a_key(spark, items, database):
    predictions = spark.createDataFrame([(1, 0.5), (1, 1.5), (9, 9.0)], "k int, prediction double")
    with pytest.raises(Exception, match="more than one prediction for k 1"):
        scoring.save_predictions(items, predictions, "k", f"{database}.p")


@pytest.mark.parametrize("nothing", ["none", "empty"])
def test_no_predictions_write_nothing(spark, items, database, nothing):
    predictions = None if nothing == "none" else items.select("k", "x").where("false")
    assert scoring.save_predictions(items, predictions, "k", f"{database}.p") is None
    assert not spark.catalog.tableExists(f"{database}.p")


def test_each_side_is_shuffled_once(spark, items):
    predictions = items.select("k", F.col("x").alias("prediction"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = scoring.meet(items, predictions, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange") == 2
    assert "SortAggregate" not in plan


def test_doubled_rows_and_missing_keys_do_not_fit(spark, items):
    predictions = items.select("k", F.col("x").alias("prediction"))
    with pytest.raises(ValueError, match="more than once"):
        scoring.attach_predictions(items.union(items.where("k = 2")), predictions, "k")
    unkeyed = spark.createDataFrame([(None, 1.0)], "k int, x double")
    with pytest.raises(ValueError, match="without a prediction"):
        scoring.attach_predictions(unkeyed, unkeyed.withColumnRenamed("x", "prediction"), "k")
