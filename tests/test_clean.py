import pytest
from pyspark.sql import functions as F

from millrace.operators import clean


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("7", 7.0),
        (" 7 ", 7.0),
        ("-1.5", -1.5),
        ("1e3", 1000.0),
        (".5", 0.5),
        ("inf", float("inf")),
        ("-Infinity", float("-inf")),
        ("", None),
        ("abc", None),
        ("n/a", None),
        ("nan", None),
        ("0x10", None),
        ("0x1p3", None),
        ("1_000", None),
        ("1d", None),
        ("1f", None),
        ("1F ", None),
        (" +INF ", float("inf")),
        ("-inf", float("-inf")),
        ("infinityf", None),
        ("1e3D", None),
        (None, None),
    ],
)
def test_text_becomes_number_or_null(spark, text, number):
    df = spark.createDataFrame([(text,)], "x string")
    assert values(clean.coerce_numeric(df, ["x"]), "x") == [number]


def test_numbers_are_widened_and_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (None, 2.5)], "a int, b double")
    typed = clean.coerce_numeric(df, ["a", "b"])
    assert typed.dtypes == [("a", "double"), ("b", "double")]
    assert values(typed, "a") == [1.0, None]
    assert values(typed, "b") == [None, 2.5]


def test_strict_int_cuts_towards_zero(spark):
    df = spark.createDataFrame([(5.9,), (-5.9,), (0.0,)], "y double")
    assert values(clean.cast_strict_int(df, "y"), "y") == [5, -5, 0]
    assert values(clean.cast_strict_int(spark.createDataFrame([("12",)], "y string"), "y"), "y") == [12]


@pytest.mark.parametrize(
    ("value", "kind"),
    [(None, "string"), ("5,0", "string"), ("x", "string"), (None, "double"), (float("nan"), "double")],
)
def test_strict_int_refuses_bad_values(spark, value, kind):
    df = spark.createDataFrame([(value,)], f"y {kind}")
    with pytest.raises(Exception, match="column y holds a value that is no integer"):
        clean.cast_strict_int(df, "y").collect()


def test_strict_int_fails_with_ansi_mode_off(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="no integer"):
            clean.cast_strict_int(spark.createDataFrame([("5,0",)], "y string"), "y").collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_strict_int_cuts_text_with_a_fraction(spark):
    texts = ["5.0", "-2.7", "7", str(2**60 + 1), "1e3"]
    df = spark.createDataFrame([(t,) for t in texts], "y string")
    found = [r["y"] for r in clean.cast_strict_int(df, "y").collect()]
    assert found == [5, -2, 7, 2**60 + 1, 1000]


def test_projection_keeps_order_and_turns_the_key_into_text(spark):
    df = spark.createDataFrame([(1, 2.0, "w", 5, "gone")], "Id bigint, p H double, type string, q bigint, z string".replace("p H", "`p H`"))
    chosen = clean.select_features(df, ["type"], ["p H"], "q", "Id")
    assert chosen.dtypes == [("type", "string"), ("p H", "double"), ("q", "bigint"), ("Id", "string")]


def test_feature_and_target_columns(people):
    features, target = clean.split_xy(people, ["level"], ["score"], "key")
    assert features.columns == ["score", "level"]
    assert target.columns == ["key"]


def test_stamp_is_one_time_for_all_rows(people):
    stamped = clean.stamp_utc(people, "at")
    assert dict(stamped.dtypes)["at"] == "timestamp"
    assert stamped.agg(F.count_distinct("at"), F.count("at")).first() == (1, 1000)


def test_shape(people):
    assert clean.shape(people).first() == (1000, 3)
    assert clean.shape(people.where("false")).first() == (0, 3)
