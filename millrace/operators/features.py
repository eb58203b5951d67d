"""Feature encoding as Spark ML stages, and model signatures."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.ml import Transformer
from pyspark.ml.feature import (
    Bucketizer,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.levels import fit_levels

FEATURES = "_features"
# Levels of one categorical column that may go to the driver and into the model; more stay in a table.
MAX_LEVELS = 100_000


def feature_stages(
    cat: Sequence[str],
    num: Sequence[str],
    edges: Sequence[Sequence[float]] | None = None,
    wide: DataFrame | None = None,
) -> list:
    """Stages that turn the columns into one vector: one-hot block first, then the numbers.

    Levels are learnt in the fit, in alphabetical order. A level not seen there, or NULL, gives all
    zeros: the indexer puts it in an extra last slot, which the encoder leaves out. A missing
    number stops the query and the error names its column. With ``edges``, a number becomes the
    index of its bin. With ``wide``, the rows to learn from, levels are kept in a table from the start and
    there may be any number of them.
    """
    index = [f"_index_{c}" for c in cat]
    onehot = [f"_onehot_{c}" for c in cat]
    numeric = [f"_number_{i}" for i in range(len(num))]
    stages: list = []
    if num:
        checked = ", ".join(
            f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), "
            f"raise_error('column {_quoted(c)} has a missing value')) AS {alias}"
            for c, alias in zip(num, numeric, strict=True)
        )
        stages.append(SQLTransformer(statement=f"SELECT *, {checked} FROM __THIS__"))
    if num and edges is not None:
        binned = [f"_bin_{i}" for i in range(len(num))]
        infinite = float("inf")
        splits = [[-infinite, *own, infinite] for own in edges]
        stages.append(Bucketizer(splitsArray=splits, inputCols=numeric, outputCols=binned))
        # A bin is marked as a category; the sum is a plain number, so trees keep its order.
        numeric = [f"_place_{i}" for i in range(len(num))]
        places = ", ".join(f"{b} + 0D AS {p}" for b, p in zip(binned, numeric, strict=True))
        stages.append(SQLTransformer(statement=f"SELECT *, {places} FROM __THIS__"))
    if wide is not None and cat:
        return [*stages, fit_levels(wide, cat, numeric, FEATURES)]
    if cat:
        stages += [
            StringIndexer(
                inputCols=list(cat),
                outputCols=index,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=index, outputCols=onehot, dropLast=True),
        ]
    stages.append(
        VectorAssembler(inputCols=[*onehot, *numeric], outputCol=FEATURES, handleInvalid="error")
    )
    return stages


def with_many_levels(df: DataFrame, cat: Sequence[str], most: int | None = None) -> list[str]:
    """The categorical columns that have more than ``most`` levels."""
    bound = MAX_LEVELS if most is None else most
    # One level more than the bound tells; NULL is no level.
    return [
        c
        for c in cat
        if df.select(F.col(f"`{c}`")).distinct().limit(bound + 2).count() > bound + 1
    ]


def check_levels(df: DataFrame, cat: Sequence[str], most: int = MAX_LEVELS) -> None:
    """Raise if a categorical column has more than ``most`` levels; none is ever left out."""
    for c in with_many_levels(df, cat, most):
        raise ValueError(f"categorical column {c} has more than {most} levels")


def _quoted(name: str) -> str:
    return name.replace("\\", "\\\\").replace("'", "\\'")


def signature(
    df: DataFrame, inputs: Sequence[str], output: str = "prediction", outputs: DataFrame | None = None
) -> str:
    """Input and output columns of a model with their types, nested ones too, as JSON.

    ``outputs`` is a frame of what the model adds; without it the output is a number named ``output``.
    """
    fields = [df.schema[c].jsonValue() for c in inputs]
    made = outputs.schema if outputs is not None else T.StructType([T.StructField(output, T.DoubleType())])
    return json.dumps({"inputs": fields, "outputs": [f.jsonValue() for f in made]})


def _fits(expected: T.DataType, actual: T.DataType) -> bool:
    """Whether a value of one type can stand for the other: any number for a number, at every depth."""
    if isinstance(expected, T.NumericType):
        return isinstance(actual, T.NumericType)
    if isinstance(expected, T.ArrayType):
        return isinstance(actual, T.ArrayType) and _fits(expected.elementType, actual.elementType)
    if isinstance(expected, T.MapType):
        return (
            isinstance(actual, T.MapType)
            and _fits(expected.keyType, actual.keyType)
            and _fits(expected.valueType, actual.valueType)
        )
    if isinstance(expected, T.StructType):
        if not isinstance(actual, T.StructType):
            return False
        present = {f.name: f.dataType for f in actual}
        return all(f.name in present and _fits(f.dataType, present[f.name]) for f in expected)
    return expected == actual


def _check_side(recorded: str, side: str, df: DataFrame, fits: Callable[[T.DataType, T.DataType], bool]) -> None:
    present = {f.name: f.dataType for f in df.schema}
    name = side.removesuffix("s")
    for field in json.loads(recorded).get(side, []):
        expected = T.StructField.fromJson(field)
        actual = present.get(expected.name)
        if actual is None:
            raise ValueError(f"{name} column {expected.name} is missing")
        if not fits(expected.dataType, actual):
            raise ValueError(
                f"{name} column {expected.name} is {actual.simpleString()}, "
                f"the model was fitted on {expected.dataType.simpleString()}"
            )


def check_signature(recorded: str, df: DataFrame) -> None:
    """Raise unless ``df`` has every recorded input column.

    Strings must meet strings. Numbers may have any numeric type, since models read them as double. Nested
    types are compared part by part.
    """
    _check_side(recorded, "inputs", df, _fits)


def check_outputs(recorded: str, scored: DataFrame) -> None:
    """Raise unless ``scored`` has every recorded output column with the very type that was recorded."""
    _check_side(recorded, "outputs", scored, lambda expected, actual: expected == actual)


def predict(model: Transformer, df: DataFrame, output: str = "prediction") -> DataFrame:
    """Every column of ``df`` plus the model's prediction, without the columns made on the way."""
    scored = model.transform(df)
    return scored.select(
        *(scored[f"`{c}`"] for c in df.columns), scored["prediction"].alias(output)
    )
