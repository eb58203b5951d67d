import statistics
from decimal import Context, Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.impute import column_statistics, exact_medians, impute


def test_median_of_an_even_count_is_the_mean_of_the_two_middle_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    assert exact_medians(df, ["x"]) == {"x": 3.0}


def test_median_edges(spark):
    df = spark.createDataFrame([(None, 5.0, float("nan"))], "a double, b double, c double")
    assert exact_medians(df, ["a", "b", "c"]) == {"a": None, "b": 5.0, "c": None}
    assert exact_medians(df.where("false"), ["a", "b"]) == {"a": None, "b": None}
    assert exact_medians(df, []) == {}


@pytest.mark.parametrize("rows", [4999, 5000])
def test_narrowing_search_is_exact(spark, rows):
    rng = np.random.default_rng(rows)
    frame = pd.DataFrame(
        {
            "smooth": rng.normal(size=rows),
            "few": rng.integers(0, 3, rows).astype(float),
            "two": np.where(np.arange(rows) % 2 == 0, 1.0, 2.0),
            "hot": np.where(rng.random(rows) < 0.4, 5.0, rng.random(rows) * 10),
            "heavy": rng.standard_cauchy(rows) ** 3,
        }
    )
    frame.loc[rng.random(rows) < 0.1, "smooth"] = np.nan
    found = exact_medians(spark.createDataFrame(frame), list(frame.columns), buckets=50)
    assert found == {c: frame[c].median() for c in frame}


@pytest.mark.parametrize("buckets", [1, 2, 4096])
def test_digits_that_split_badly_do_not_change_the_result(spark, buckets):
    """With one part by distance, cuts have to do it all."""
    numbers = [float(i * 37 % 51) for i in range(60)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    assert exact_medians(df, ["x"], buckets=buckets) == {"x": statistics.median(numbers)}


WIDE = [-(2**63), 2**63 - 1, 2**60 + 1, 2**60 + 2, 2**60 + 3, 0, -5, 2**60, 2**61]


@pytest.mark.parametrize("count", [9, 8, 5, 4, 1])
def test_bigints_keep_every_digit(spark, count):
    values = sorted(WIDE)[:count] if count != 5 else [2**60 + i for i in (5, 1, 4, 2, 3)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x bigint")
    found = exact_medians(df, ["x"])["x"]
    assert found == statistics.median([Fraction(v) for v in values])
    assert isinstance(found, int) or found.as_tuple().exponent == -1


@pytest.mark.parametrize("kind", ["decimal(38,10)", "decimal(38,0)", "decimal(20,3)", "decimal(5,2)"])
def test_decimals_keep_every_digit(spark, kind):
    precision, scale = map(int, kind[8:-1].split(","))
    step = Decimal(1).scaleb(-scale)
    top = Decimal("9" * precision).scaleb(-scale, Context(prec=60))
    context = Context(prec=60)
    values = [context.subtract(top, step * i) for i in (3, 1, 2, 0)] + [top.copy_negate(), step, step.copy_negate()]
    for own in (values, values[:6], values[:4], values[1:2]):
        df = spark.createDataFrame([(v,) for v in own], f"x {kind}")
        expected = statistics.median([Fraction(v) for v in own])
        assert Fraction(exact_medians(df, ["x"])["x"]) == expected


def test_doubles_of_all_sizes(spark):
    huge, tiny = 1.7e308, 5e-324
    sets = [
        [huge, -huge, huge / 2, -huge / 3, 1.0], [tiny, 2 * tiny, 3 * tiny, 0.0], [-0.0, 0.0, 0.0],
        [float("inf"), float("-inf"), 3.0], [float("inf")] * 3 + [1.0], [10.0**k for k in range(-300, 300)],
        [-(10.0**k) for k in range(-300, 300, 7)] + [1.0, 2.0], [huge, huge],
    ]
    for values in sets:
        df = spark.createDataFrame([(v,) for v in values], "x double")
        ordered = sorted(values)
        low, high = ordered[(len(values) - 1) // 2], ordered[len(values) // 2]
        middle = low if low == high else (low + high) / 2
        assert exact_medians(df, ["x"], buckets=16)["x"] == middle


def test_types_share_their_scans(spark, monkeypatch):
    from millrace.operators import impute as module

    passes, count = [], module._count_parts
    monkeypatch.setattr(module, "_count_parts", lambda *a: passes.append(len(a[2])) or count(*a))
    df = spark.range(10_001).select(
        (F.col("id") + 2**60).alias("b"), F.col("id").cast("decimal(38,10)").alias("d"),
        (F.col("id") / 7).alias("x"), F.col("id").cast("string").alias("s"), F.lit(3).alias("one"),
    )
    found = exact_medians(df, list(df.columns))
    assert found == {"b": 2**60 + 5000, "d": 5000, "x": 5000 / 7, "s": 5000.0, "one": 3}
    assert passes[0] == 4 and len(passes) <= 3


def test_exact_fills_keep_integers_and_decimals(spark):
    rows = [(2**60 + 1, Decimal("1.05")), (2**60 + 2, Decimal("2.00")), (None, None)]
    df = spark.createDataFrame(rows, "b bigint, d decimal(10,2)")
    filled = impute(df, {"b": "median", "d": "median"}, exact=True)
    assert filled.dtypes == [("b", "decimal(20,1)"), ("d", "decimal(11,3)")]
    assert sorted(map(tuple, filled.collect()))[1] == (Decimal(2**60 + 1) + Decimal("0.5"), Decimal("1.525"))


def test_impute_by_rule(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, None, None), (2.0, None, 3.0, None), (None, 3.0, float("nan"), 4.0), (9.0, None, None, 1.0)],
        "a double, b double, c double, d double",
    )
    filled = impute(df, {"a": "median", "b": "mean", "c": 0})
    assert filled.columns == ["a", "b", "c", "d"]
    assert [tuple(r) for r in filled.collect()] == [
        (1.0, 1.0, 0.0, None),
        (2.0, 2.0, 3.0, None),
        (2.0, 3.0, 0.0, 4.0),
        (9.0, 2.0, 0.0, 1.0),
    ]


def test_impute_leaves_columns_without_any_value(spark):
    df = spark.createDataFrame([(None, 1)], "a double, k int")
    assert impute(df, {"a": "median"}).first() == (None, 1)
    assert impute(df.where("false"), {"a": "mean"}).count() == 0


@pytest.mark.parametrize("values", [[1, 2, None], [1, 3, None]])
@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(10,0)"])
def test_types_follow_from_types_and_rules(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], "a int").select(F.col("a").cast(kind))
    assert impute(df, {"a": 0}).dtypes == [("a", kind)]
    middle = (values[0] + values[1]) / 2
    for rule in ("mean", "median"):
        widened = impute(df, {"a": rule})
        assert widened.dtypes == [("a", "double")]
        assert sorted(r[0] for r in widened.collect()) == sorted([*map(float, values[:2]), middle])


def test_approximate_median_is_close(people):
    found = column_statistics(people, {"score": "median"}, approx=True)
    assert abs(found["score"] - exact_medians(people, ["score"])["score"]) <= 1


def test_unknown_rule(people):
    with pytest.raises(ValueError, match="unknown imputation rules"):
        impute(people, {"score": "mode"})
