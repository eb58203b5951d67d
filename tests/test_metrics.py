import pytest

from millrace.operators.metrics import (
    add_absolute_error,
    champion_gate,
    compare_predictions,
    regression_metrics,
)


def pairs(spark, rows):
    return spark.createDataFrame(rows, "y double, p double")


def test_metrics_against_hand_computed_values(spark):
    row = regression_metrics(pairs(spark, [(1.0, 2.0), (2.0, 2.0), (6.0, 3.0)]), "y", "p").first()
    assert row["mse"] == pytest.approx(10 / 3)
    assert row["mae"] == pytest.approx(4 / 3)
    assert row["r2_score"] == pytest.approx(1 - 10 / 14)


def test_metrics_agree_with_the_spark_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    df = pairs(spark, [(float(i % 17), float(i * 3 % 13)) for i in range(500)])
    row = regression_metrics(df, "y", "p").first()
    for ours, theirs in (("mse", "mse"), ("mae", "mae"), ("r2_score", "r2")):
        evaluator = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=theirs)
        assert row[ours] == pytest.approx(evaluator.evaluate(df))


@pytest.mark.parametrize(
    ("rows", "r2"),
    [
        ([(3.0, 3.0), (3.0, 3.0)], 1.0),
        ([(3.0, 3.0), (3.0, 4.0)], 0.0),
        ([(3.0, 4.0)], None),
        ([], None),
    ],
)
def test_r2_without_spread(spark, rows, r2):
    assert regression_metrics(pairs(spark, rows), "y", "p").first()["r2_score"] == r2


def test_no_rows_give_no_errors(spark):
    assert tuple(regression_metrics(pairs(spark, []), "y", "p").first()) == (None, None, None)


@pytest.mark.parametrize("row", [(1.0, None), (None, 1.0), (1.0, float("nan"))])
def test_metrics_refuse_missing_values(spark, row):
    with pytest.raises(Exception, match="has a missing value"):
        regression_metrics(pairs(spark, [(1.0, 1.0), row]), "y", "p").collect()


def test_absolute_error(spark):
    df = add_absolute_error(pairs(spark, [(1.0, 3.0), (3.0, 1.0)]), "y", "p", "e")
    assert [r["e"] for r in df.collect()] == [2.0, 2.0]


@pytest.mark.parametrize(
    ("current", "latest", "promote", "reason"),
    [
        ([1.5, 2.0], [1.0, 3.0], True, "current model is better"),
        ([1.0, 3.0], [1.5, 2.0], False, "current model is not better"),
        ([1.0, 3.0], [2.0, 2.0], False, "current model is not better"),
        ([None, 2.0], [9.0, 9.0], False, "current model has missing errors"),
        ([float("nan"), 2.0], [9.0, 9.0], False, "current model has missing errors"),
        ([1.0, 2.0], [None, 9.0], False, "latest model has missing errors"),
        ([1.0, 2.0], [float("nan"), 9.0], False, "latest model has missing errors"),
        ([], [], False, "no rows to evaluate"),
    ],
)
def test_gate_with_a_champion(spark, current, latest, promote, reason):
    rows = list(zip([1.0, 2.0][: len(current)], current, latest, strict=True))
    df = spark.createDataFrame(rows, "y double, c double, l double")
    decision = champion_gate(df, "y", "c", "l").first()
    assert (decision["promote"], decision["reason"]) == (promote, reason)


@pytest.mark.parametrize(
    ("rows", "promote", "reason"),
    [
        ([(1.0, 5.0)], True, "no latest model"),
        ([], False, "no rows to evaluate"),
        ([(1.0, None)], False, "current model has missing errors"),
    ],
)
def test_gate_without_a_champion(spark, rows, promote, reason):
    decision = champion_gate(pairs(spark, rows), "y", "p").first()
    assert (decision["promote"], decision["reason"]) == (promote, reason)
    assert decision["mae_latest"] is None


def test_comparison_frame(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, y double")
    current = spark.createDataFrame([(2, 21.0), (1, 11.0)], "k int, prediction double")
    latest = spark.createDataFrame([(1, 12.0)], "k int, prediction double")
    assert compare_predictions(df, "k", "y", current).columns == ["k", "actual", "prediction_current"]
    both = compare_predictions(df, "k", "y", current, latest)
    assert sorted(map(tuple, both.collect())) == [(1, 10.0, 11.0, 12.0), (2, 20.0, 21.0, None)]
