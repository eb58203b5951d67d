import pytest
from pyspark.sql import functions as F

from millrace.operators import keys
from millrace.sources.raw_csv import read_raw_csv


@pytest.mark.parametrize("partitions", [1, 4, 9])
def test_numbers_do_not_depend_on_partitioning(spark, people, partitions):
    numbered = keys.add_sequential_key(people.repartition(partitions), [F.desc("score"), "key"])
    found = {r["key"]: r["id"] for r in numbered.collect()}
    ordered = sorted(people.collect(), key=lambda r: (-r["score"], r["key"]))
    assert found == {r["key"]: i for i, r in enumerate(ordered, 1)}
    assert numbered.columns == ["key", "score", "level", "id"]


def test_numbers_of_nothing_and_of_one_row(people):
    assert keys.add_sequential_key(people.where("false"), ["key"]).count() == 0
    assert keys.add_sequential_key(people.where("key = 5"), ["key"]).select("id").collect() == [(1,)]


def test_rows_that_tie_still_get_every_number(spark):
    df = spark.range(500).select(F.lit(1).alias("same"))
    numbered = keys.add_sequential_key(df, ["same"])
    assert sorted(r["id"] for r in numbered.collect()) == list(range(1, 501))


@pytest.mark.parametrize("block_bytes", ["128m", "4k"])
def test_file_rows_are_numbered_in_file_order(spark, people, tmp_path, block_bytes):
    path = str(tmp_path / "csv")
    people.orderBy("key").repartitionByRange(3, "key").sortWithinPartitions("key").write.csv(path, header=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block_bytes)
    try:
        raw = read_raw_csv(spark, path, with_position=True)
        rows = keys.number_file_rows(raw).select("key", "id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 1000
    assert all(int(r["key"]) + 1 == r["id"] for r in rows)


def test_file_rows_must_be_complete(spark, people, tmp_path):
    path = str(tmp_path / "csv")
    people.coalesce(1).write.csv(path, header=True)
    raw = read_raw_csv(spark, path, with_position=True)
    with pytest.raises(Exception, match="rows were removed"):
        keys.number_file_rows(raw.where("level <> 'a'"))


def test_a_million_blocks_are_broadcast_by_hash(spark):
    staged = spark.range(1_000_000).select(
        F.concat(F.lit("file:/a/long/path/of/a/file/"), F.col("id").cast("string")).alias("_file"),
        F.lit(0).alias("_block"),
        F.col("id").alias("_line"),
    )
    numbered = keys._number_staged(staged, ["_file", "_block"], "_line", "id")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_zip_by_position(spark):
    left = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, x string")
    right = spark.createDataFrame([(20.0,), (10.0,)], "y double")
    pairs = keys.zip_by_position(left, right, ["k"], ["y"])
    assert sorted((r["k"], r["y"]) for r in pairs.where("y is not null").collect()) == [(1, 10.0), (2, 20.0)]
    assert pairs.where("y is null").select("k").collect() == [(3,)]
    surplus = keys.zip_by_position(right, left, ["y"], ["k"])
    assert sorted(r["k"] for r in surplus.collect()) == [1, 2]


def test_repeat_row(spark, people):
    one = people.agg(F.max("score").alias("top"), F.lit("x").alias("mark"))
    repeated = keys.repeat_row(people, one)
    assert repeated.columns == ["key", "score", "level", "top", "mark"]
    assert repeated.select("top", "mark").distinct().collect() == [(49.0, "x")]
    assert repeated.count() == 1000


@pytest.mark.parametrize("condition", ["false", "key < 2"])
def test_repeat_row_needs_exactly_one(people, condition):
    with pytest.raises(Exception, match="expected one row to repeat"):
        keys.repeat_row(people, people.where(condition).select(F.col("score").alias("s"))).collect()
