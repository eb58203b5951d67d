"""Regression metrics and the champion test. Each is one aggregate over one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import absolute_error, present_double


def metric_columns(actual: str, predicted: str) -> dict[str, Column]:
    """Aggregates for mean squared error, mean absolute error and R².

    A missing value stops the query. R² is NULL for fewer than two rows; where all true values are
    equal it is 1.0 for perfect predictions and 0.0 otherwise. No rows give NULLs.
    """
    y, p = present_double(actual), present_double(predicted)
    n = F.count(F.lit(1))
    squared = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * n
    r2 = (
        F.when(n < 2, None)
        .when(spread > 0, 1 - squared / spread)
        .otherwise(F.when(squared == 0, 1.0).otherwise(0.0))
    )
    return {"mse": squared / F.nullif(n, F.lit(0)), "mae": F.avg(F.abs(y - p)), "r2_score": r2}


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row with ``mse``, ``mae`` and ``r2_score``."""
    return df.agg(*(c.alias(name) for name, c in metric_columns(actual, predicted).items()))


def add_absolute_error(df: DataFrame, actual: str, predicted: str, name: str) -> DataFrame:
    """Add the distance between true and predicted value as column ``name``."""
    return df.withColumn(name, absolute_error(actual, predicted))


def compare_predictions(
    df: DataFrame,
    key: str,
    actual: str,
    current: DataFrame,
    latest: DataFrame | None = None,
    prediction: str = "prediction",
) -> DataFrame:
    """Key, true value and one or two models' predictions side by side, joined on the key."""
    compared = df.select(F.col(f"`{key}`"), F.col(f"`{actual}`").alias("actual"))
    for label, predictions in (("current", current), ("latest", latest)):
        if predictions is not None:
            named = F.col(f"`{prediction}`").alias(f"prediction_{label}")
            compared = compared.join(predictions.select(F.col(f"`{key}`"), named), key, "left")
    return compared


def _strict_mae(actual: str, predicted: str) -> Column:
    """Mean absolute error, NULL if a row lacks a value."""
    error = absolute_error(F.col(f"`{actual}`"), F.col(f"`{predicted}`")).cast("double")
    error = F.nanvl(error, F.lit(None).cast("double"))
    return F.when(F.count(error) == F.count(F.lit(1)), F.avg(error))


def gate_columns(actual: str, current: str, latest: str | None) -> dict[str, Column]:
    """Aggregates for both models' mean absolute errors over the same rows."""
    return {
        "n_rows": F.count(F.lit(1)),
        "mae_current": _strict_mae(actual, current),
        "mae_latest": _strict_mae(actual, latest) if latest else F.lit(None).cast("double"),
    }


def decide(measured: DataFrame, has_latest: bool) -> DataFrame:
    """Turn the aggregates of :func:`gate_columns` into a decision with its reason.

    Without a champion the challenger is promoted; with one only if its error is strictly lower. An
    empty evaluation set or a missing error never promotes.
    """
    current, latest = F.col("mae_current"), F.col("mae_latest")
    reason = F.when(F.col("n_rows") == 0, "no rows to evaluate").when(
        current.isNull(), "current model has missing errors"
    )
    if not has_latest:
        reason = reason.otherwise("no latest model")
        promoted = ["no latest model"]
    else:
        reason = (
            reason.when(latest.isNull(), "latest model has missing errors")
            .when(current < latest, "current model is better")
            .otherwise("current model is not better")
        )
        promoted = ["current model is better"]
    return measured.withColumn("reason", reason).withColumn(
        "promote", F.col("reason").isin(promoted)
    )


def champion_gate(
    df: DataFrame, actual: str, current: str, latest: str | None = None
) -> DataFrame:
    """One row: ``mae_current``, ``mae_latest``, ``promote`` and ``reason``."""
    measured = df.agg(*(c.alias(n) for n, c in gate_columns(actual, current, latest).items()))
    return decide(measured, latest is not None).select(
        "mae_current", "mae_latest", "promote", "reason"
    )
