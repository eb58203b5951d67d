"""The three jobs end to end, on a table shaped like the one the library was designed for."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import ledger
from millrace.operators.boosting import fit_mean_boost
from millrace.plans import pipelines
from millrace.plans.pipelines import Columns, prepare, score_batch, train_and_promote
from millrace.sources import tables
from millrace.sources.snapshots import read_snapshot

# The schema of the table these jobs were designed for.
NUMERIC = [
    "fixed_acidity",
    "volatile_acidity",
    "citric_acid",
    "residual_sugar",
    "chlorides",
    "free_sulfur_dioxide",
    "total_sulfur_dioxide",
    "density",
    "pH",
    "sulphates",
    "alcohol",
]
COLUMNS = Columns(num=NUMERIC, cat=["type"], target="quality")
FILLS = {"alcohol": "median", "citric_acid": "mean", "sulphates": 0}
SMALL = {"learning_rate": 0.1, "n_estimators": 2, "max_depth": 2}


@pytest.fixture
def raw_file(tmp_path):
    rows = 203
    frame = pd.DataFrame({c: [(i * (n + 3) % 17) / 4 for i in range(rows)] for n, c in enumerate(NUMERIC)})
    frame["quality"] = [3 + i % 6 for i in range(rows)]
    frame["type"] = ["white" if i % 3 else "red" for i in range(rows)]
    frame["unused"] = "x"
    text = frame.astype({"alcohol": object, "citric_acid": object, "sulphates": object})
    text.loc[5, "alcohol"] = "n/a"
    text.loc[6, "alcohol"] = None
    text.loc[7, "citric_acid"] = "?"
    text.loc[8, "sulphates"] = None
    path = tmp_path / "raw.csv"
    text.to_csv(path, index=False)
    for column, missing in (("alcohol", [5, 6]), ("citric_acid", [7]), ("sulphates", [8])):
        frame.loc[missing, column] = None
    return str(path), frame


@pytest.mark.parametrize("exact", [True, False])
def test_prepare(spark, database, raw_file, exact):
    path, frame = raw_file
    train, test = f"{database}.train_set", f"{database}.test_set"
    prepare(spark, path, COLUMNS, FILLS, train, test, exact=exact)
    stored = spark.table(train).unionByName(spark.table(test))
    assert stored.columns == ["type", *NUMERIC, "quality", "Id", "update_timestamp_utc"]
    types = dict(stored.dtypes)
    assert types["quality"] == "bigint" and types["Id"] == "string" and types["pH"] == "double"
    found = stored.toPandas().set_index("Id")
    assert sorted(map(int, found.index)) == list(range(1, len(frame) + 1))
    expected = frame.fillna(
        {"alcohol": frame["alcohol"].median(), "citric_acid": frame["citric_acid"].mean(), "sulphates": 0}
    )
    for column in (*NUMERIC, "quality"):
        ours = found.loc[[str(i + 1) for i in range(len(frame))], column].to_numpy()
        assert ours == pytest.approx(expected[column].to_numpy(dtype=float))
    if exact:
        assert spark.table(test).count() == math.ceil(len(frame) * 0.2)


def test_prepare_a_file_without_rows(spark, database, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text(",".join([*NUMERIC, "quality", "type"]) + "\n")
    train, test = f"{database}.train_set", f"{database}.test_set"
    prepare(spark, str(path), COLUMNS, FILLS, train, test)
    assert spark.table(train).isEmpty() and spark.table(test).isEmpty()
    assert spark.table(train).columns[-2:] == ["Id", "update_timestamp_utc"]


def test_a_bad_target_stops_the_preparation(spark, database, raw_file, tmp_path):
    _, frame = raw_file
    path = tmp_path / "bad.csv"
    frame.astype({"quality": object}).assign(quality="good").to_csv(path, index=False)
    with pytest.raises(Exception, match="column quality holds a value that is no integer: good"):
        prepare(spark, str(path), COLUMNS, FILLS, f"{database}.a", f"{database}.b")
    assert not spark.catalog.tableExists(f"{database}.a")


def test_prepare_again_replaces_the_tables(spark, database, raw_file):
    path, frame = raw_file
    tables = f"{database}.train_set", f"{database}.test_set"
    for _ in range(2):
        prepare(spark, path, COLUMNS, FILLS, *tables)
    assert sum(spark.table(t).count() for t in tables) == len(frame)


def test_train_promote_and_score(spark, database, raw_file, tmp_path):
    path, frame = raw_file
    train, test = f"{database}.train_set", f"{database}.test_set"
    prepare(spark, path, COLUMNS, FILLS, train, test, snapshots=True)

    def attempt(**options):
        return train_and_promote(
            spark,
            train,
            test,
            COLUMNS,
            database,
            "grader",
            str(tmp_path / "models"),
            "trial",
            params=SMALL,
            tags={"branch": "main"},
            snapshots=True,
            **options,
        )

    first, second = attempt(), attempt()
    assert (first["promote"], first["version"], first["reason"]) == (True, 1, "no latest model")
    assert (second["promote"], second["version"]) == (False, None)
    assert second["mae_current"] == pytest.approx(second["mae_latest"])
    assert first["mae"] == pytest.approx(first["mae_current"])
    other = attempt(fit=fit_mean_boost)
    assert other["promote"] == (other["mae_current"] < other["mae_latest"])

    assert spark.table(f"{database}.runs").count() == 3
    recorded = ledger.run_metadata(spark, database, first["run_id"]).first()
    assert set(recorded["metrics"]) == {"mse", "mae", "r2_score"}
    assert recorded["params"]["max_depth"] == "2"
    fitted_on = ledger.run_dataset(spark, database, first["run_id"])
    assert fitted_on.count() == read_snapshot(spark, train, 0).count()

    output = f"{database}.predictions"
    scored = score_batch(spark, test, COLUMNS, database, "grader", output, snapshots=True)
    assert scored.columns[-2:] == ["prediction", "prediction_timestamp_utc"]
    assert "quality" not in scored.columns
    assert scored.count() == math.ceil(len(frame) * 0.2)
    assert scored.where("prediction is null").isEmpty()


def test_score_needs_a_model_and_rows(spark, database, raw_file, tmp_path):
    path, _ = raw_file
    train, test = f"{database}.train_set", f"{database}.test_set"
    prepare(spark, path, COLUMNS, FILLS, train, test)
    with pytest.raises(LookupError, match="no alias"):
        score_batch(spark, test, COLUMNS, database, "grader", f"{database}.p")
    train_and_promote(
        spark, train, test, COLUMNS, database, "grader", str(tmp_path), "trial", params=SMALL
    )
    spark.table(test).where("false").write.saveAsTable(f"{database}.nothing")
    arguments = (COLUMNS, database, "grader", f"{database}.p")
    assert score_batch(spark, f"{database}.nothing", *arguments) is None
    assert not spark.catalog.tableExists(f"{database}.p")
    spark.table(test).drop("pH").write.saveAsTable(f"{database}.narrow")
    with pytest.raises(ValueError, match="input column pH is missing"):
        score_batch(spark, f"{database}.narrow", *arguments)


def test_an_empty_test_table_never_promotes(spark, database, raw_file, tmp_path):
    path, _ = raw_file
    train, test = f"{database}.train_set", f"{database}.test_set"
    prepare(spark, path, COLUMNS, FILLS, train, test)
    spark.table(test).where("false").write.saveAsTable(f"{database}.empty")
    outcome = train_and_promote(
        spark, train, f"{database}.empty", COLUMNS, database, "m", str(tmp_path), "trial", params=SMALL
    )
    assert (outcome["promote"], outcome["reason"]) == (False, "no rows to evaluate")
    assert outcome["version"] is None and outcome["r2_score"] is None


def test_clean_table_with_ties_and_bad_cells(spark):
    from millrace.operators.split import split_exact
    from millrace.plans.pipelines import clean_table

    rows = [
        ("b", "4", "1.5", "10.0"),
        ("a", "4", "n/a", "20"),
        (None, "1", None, "30"),
        ("a", "3", "2.5", "40"),
        ("c", "2", "9.5", "50"),
        ("b", "5", "NaN", "60"),
    ]
    raw = spark.createDataFrame(rows, "colour string, weight string, height string, price string")
    columns = Columns(num=["height", "weight"], cat=["colour"], target="price")
    cleaned = clean_table(raw, columns, {"height": "median"}, ["weight", "price"])
    assert cleaned.columns == ["colour", "height", "weight", "price", "Id"]
    found = cleaned.orderBy(F.col("Id").cast("int")).select("colour", "height", "weight", "price")
    assert [tuple(r) for r in found.collect()] == [
        (None, 2.5, 1.0, 30),
        ("c", 9.5, 2.0, 50),
        ("a", 2.5, 3.0, 40),
        ("b", 1.5, 4.0, 10),
        ("a", 2.5, 4.0, 20),
        ("b", 2.5, 5.0, 60),
    ]
    train, test = split_exact(cleaned, "Id")
    assert (train.count(), test.count()) == (4, 2)


def test_a_run_keeps_the_version_it_was_fitted_on(spark, database, raw_file, tmp_path):
    """By default: prepare, train, prepare again; versions that no run names are dropped."""
    path, frame = raw_file
    train, test = f"{database}.train_set", f"{database}.test_set"
    shapes = prepare(spark, path, COLUMNS, FILLS, train, test)
    assert shapes == {train: (162, 15), test: (41, 15)}
    first = sorted(map(tuple, spark.table(train).drop("update_timestamp_utc").collect()))
    outcome = train_and_promote(spark, train, test, COLUMNS, database, "grader", str(tmp_path / "models"), "trial", params=SMALL)
    half = tmp_path / "half.csv"
    half.write_text("\n".join(open(path).read().splitlines()[:101]) + "\n")
    for _ in range(4):
        prepare(spark, str(half), COLUMNS, FILLS, train, test)
    again = ledger.run_dataset(spark, database, outcome["run_id"]).drop("update_timestamp_utc")
    assert sorted(map(tuple, again.collect())) == first
    assert spark.table(train).count() == 80
    kept = sorted(r["version"] for r in tables.stored_versions(spark, train).collect())
    assert kept == [1, 4, 5]
    assert sorted(r["version"] for r in tables.stored_versions(spark, test).collect()) == [4, 5]
    with pytest.raises(ValueError, match="has no version 2"):
        tables.read_version(spark, train, 2)


def test_a_plain_overwrite_of_a_table_with_versions_adds_one(spark, database):
    table = f"{database}.t"
    assert tables.write_version(spark.range(3), table) == 1
    tables.write_merged(spark.range(5).withColumn("x", F.lit("y")), table)
    assert tables.latest_version(spark, table) == 2
    assert tables.read_version(spark, table, 1).columns == ["id"]
    assert tables.read_version(spark, table, 1).count() == 3
    assert spark.table(table).count() == 5
    nothing = spark.createDataFrame([], "version bigint")
    assert tables.drop_versions(spark, table, nothing) == []
    tables.write_version(spark.range(1), table)
    assert tables.drop_versions(spark, table, nothing) == [1]
    assert tables.latest_version(spark, f"{database}.unknown") is None
    assert tables.latest_version(spark, table) == 3
    tables.overwrite_table(spark.range(7), table)
    assert tables.latest_version(spark, table) is None
    assert tables.read_version(spark, table, 2).count() == 5


def test_a_changed_output_stops_the_scoring(spark, database, raw_file, tmp_path, monkeypatch):
    path, _ = raw_file
    train, test = f"{database}.train_set", f"{database}.test_set"
    prepare(spark, path, COLUMNS, FILLS, train, test)
    train_and_promote(spark, train, test, COLUMNS, database, "grader", str(tmp_path / "models"), "trial", params=SMALL)
    real = pipelines.predict
    monkeypatch.setattr(
        pipelines, "predict", lambda *a: real(*a).withColumn("prediction", F.col("prediction").cast("string"))
    )
    with pytest.raises(ValueError, match="output column prediction is string"):
        score_batch(spark, test, COLUMNS, database, "grader", f"{database}.scored")
    assert not spark.catalog.tableExists(f"{database}.scored")
