"""Typing and projecting an untidy table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import lenient_double, strict_long, utc_now


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Read ``columns`` as double; bad text and NaN become NULL."""
    return df.withColumns({c: lenient_double(c, df.schema[c].dataType) for c in columns})


def cast_strict_int(df: DataFrame, column: str) -> DataFrame:
    """Read ``column`` as bigint; a missing or bad value stops the query."""
    return df.withColumn(column, strict_long(column))


def select_features(
    df: DataFrame, cat: Sequence[str], num: Sequence[str], target: str, key: str
) -> DataFrame:
    """Categorical, numeric, target and key column, in that order; the key as string."""
    plain = [F.col(f"`{c}`") for c in (*cat, *num, target)]
    return df.select(*plain, F.col(f"`{key}`").cast("string").alias(key))


def split_xy(
    df: DataFrame, cat: Sequence[str], num: Sequence[str], target: str
) -> tuple[DataFrame, DataFrame]:
    """Feature columns (numeric, then categorical) and the target column."""
    return df.select(*(F.col(f"`{c}`") for c in (*num, *cat))), df.select(F.col(f"`{target}`"))


def stamp_utc(df: DataFrame, name: str) -> DataFrame:
    """Add the time of the query as column ``name``."""
    return df.withColumn(name, utc_now())


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns, as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )
