"""Scoring with Python models, shaping predictions and writing them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.clean import stamp_utc
from millrace.operators.keys import attach_by_key, repeat_row
from millrace.sources.storage import stage
from millrace.sources.tables import write_merged

PREDICTED_AT = "prediction_timestamp_utc"


def score_with(
    df: DataFrame,
    predict_fn: Callable[[pd.DataFrame], Any],
    feature_cols: Sequence[str],
    output: str = "prediction",
) -> DataFrame:
    """Add the predictions of a Python model as a double column, one per row.

    ``predict_fn`` takes a pandas frame of the feature columns and returns one number per row. It
    is broadcast in pickled form, so each executor receives it once and each task unpacks it once.
    Only the feature columns travel to Python, in Arrow batches; all others stay in the JVM.
    """
    packed = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(predict_fn))

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predict = cloudpickle.loads(packed.value)
        for frame in frames:
            predictions = pd.Series(predict(frame), dtype="float64").reset_index(drop=True)
            if len(predictions) != len(frame):
                raise ValueError(f"{len(predictions)} predictions for {len(frame)} rows")
            yield predictions

    scored = F.pandas_udf(batches, "double")
    features = F.struct(*(F.col(f"`{c}`") for c in feature_cols))
    return df.withColumn(output, scored(features))


def with_null_prediction(df: DataFrame, output: str = "prediction") -> DataFrame:
    """Add an empty prediction column."""
    return df.withColumn(output, F.lit(None).cast("double"))


def meet(df: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Rows and predictions by ``key``, whichever side has it, with ``_rows`` and ``_predictions``.

    The two columns say how often the key comes on each side, NULL where it does not. Predictions are
    counted while they are grouped, rows while they lie by their key for the join: each side is shuffled
    once, with its values.
    """
    column = F.col(f"`{key}`")
    values = [c for c in predictions.columns if c != key]
    grouped = predictions.groupBy(column).agg(
        F.count(F.lit(1)).alias("_predictions"), *(F.first(F.col(f"`{c}`")).alias(c) for c in values)
    )
    counted = df.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(column)))
    return counted.join(grouped, key, "full_outer")


def attach_exactly(df: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Join predictions to the rows of ``df`` by ``key``; an error unless both hold the same keys, once each.

    What has met is written once, so that the check is a scan of two columns and nothing is shuffled
    again for the result. A NULL key meets none.
    """
    placed = stage(meet(df, predictions, key), "scored")
    found = placed.agg(
        F.count_if(F.col("_predictions").isNull()).alias("without a prediction"),
        F.count_if(F.col("_rows").isNull()).alias("not among the rows"),
        F.count_if((F.col("_rows") > 1) | (F.col("_predictions") > 1)).alias("more than once"),
    )
    wrong = {reason: n for reason, n in found.first().asDict().items() if n}
    if wrong:
        raise ValueError(f"predictions do not fit the rows by {key}: {wrong}")
    return placed.drop("_rows", "_predictions")


def attach_predictions(
    df: DataFrame,
    predictions: DataFrame | float | None,
    key: str,
    output: str = "prediction",
) -> DataFrame:
    """Put predictions of any accepted form on the rows of ``df``.

    - a frame with the key: one prediction per row, joined on the key; both must hold the same keys;
    - a frame without the key: exactly one row, repeated on every row of ``df``;
    - a number: repeated on every row;
    - ``None``: a NULL prediction on every row.
    """
    if predictions is None:
        return with_null_prediction(df, output)
    if not isinstance(predictions, DataFrame):
        return df.withColumn(output, F.lit(float(predictions)))
    if key not in predictions.columns:
        return repeat_row(df, predictions)
    return attach_exactly(df, predictions, key)


def save_predictions(
    df: DataFrame, predictions: DataFrame | None, key: str, table: str
) -> DataFrame | None:
    """Join predictions to their rows, stamp the time, replace ``table`` and return it.

    No predictions: nothing is written and the result is ``None``. Rows without a prediction get
    NULL, predictions without a row are left out. Two predictions for one key stop the query; they are
    counted in the shuffle that the join needs anyway.
    """
    if predictions is None or predictions.isEmpty():
        return None
    values = [c for c in predictions.columns if c != key]
    repeated = F.concat(F.lit(f"more than one prediction for {key} "), F.col(f"`{key}`").cast("string"))
    packed = F.first(F.struct(*(F.col(f"`{c}`") for c in values)))
    single = predictions.groupBy(F.col(f"`{key}`")).agg(
        F.when(F.count(F.lit(1)) == 1, packed).otherwise(F.raise_error(repeated)).alias("_row")
    )
    single = single.select(F.col(f"`{key}`"), *(F.col("_row")[c].alias(c) for c in values))
    return save_scored(attach_by_key(df, single, key), table)


def save_scored(scored: DataFrame, table: str) -> DataFrame:
    """Stamp rows that already carry their predictions, replace ``table`` and return it."""
    write_merged(stamp_utc(scored, PREDICTED_AT), table)
    return scored.sparkSession.table(table)
