import pytest
from pyspark.sql import functions as F

from millrace.sources import snapshots, storage, tables
from millrace.sources.raw_csv import read_raw_csv


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_columns_are_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y z\n1;n/a\n2;\n")
    raw = read_raw_csv(spark, str(tmp_path / "a.csv"), sep=";")
    assert raw.dtypes == [("x", "string"), ("y z", "string")]
    assert rows(raw) == [("1", "n/a"), ("2", None)]


def test_overwrite(spark, database):
    tables.overwrite_table(spark.range(3), f"{database}.t")
    tables.overwrite_table(spark.range(2).withColumn("x", F.lit(1)), f"{database}.t")
    assert rows(tables.scan(spark, f"{database}.t")) == [(0, 1), (1, 1)]
    assert tables.scan(spark, f"{database}.t", ["x"]).columns == ["x"]


def test_merging_overwrite_keeps_old_columns_and_adds_new_ones(spark, database):
    table = f"{database}.t"
    tables.write_merged(spark.createDataFrame([(1, "a")], "k int, old string"), table)
    tables.write_merged(spark.createDataFrame([(2.5, 2), (3.5, 3)], "new double, K int"), table)
    merged = spark.table(table)
    assert merged.dtypes == [("k", "int"), ("old", "string"), ("new", "double")]
    assert rows(merged) == [(2, None, 2.5), (3, None, 3.5)]


def test_a_table_can_be_replaced_by_a_query_over_itself(spark, database):
    table = f"{database}.t"
    tables.write_merged(spark.range(10), table)
    tables.write_merged(spark.table(table).where("id >= 5").withColumn("twice", F.col("id") * 2), table)
    assert rows(spark.table(table)) == [(i, 2 * i) for i in range(5, 10)]
    tables.write_merged(spark.table(table).drop("twice").where("id = 7"), table)
    assert rows(spark.table(table)) == [(7, None)]


def test_merging_into_a_plain_managed_table(spark, database):
    spark.range(3).write.saveAsTable(f"{database}.t")
    tables.write_merged(spark.range(1).withColumn("x", F.lit("y")), f"{database}.t")
    assert rows(spark.table(f"{database}.t")) == [(0, "y")]


def test_a_failed_write_keeps_the_old_rows(spark, database):
    table = f"{database}.t"
    tables.write_merged(spark.range(3), table)
    broken = spark.range(3).withColumn("x", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        tables.write_merged(broken, table)
    assert rows(spark.table(table)) == [(0,), (1,), (2,)]


def test_running_readers_survive_one_overwrite(spark, database, tmp_path):
    table = f"{database}.t"
    tables.write_merged(spark.range(3), table)
    reader = spark.table(table)
    first = reader.inputFiles()
    tables.write_merged(spark.range(2), table)
    assert rows(spark.read.parquet(*first)) == [(0,), (1,), (2,)]
    tables.write_merged(spark.range(1), table)
    tables.write_merged(spark.range(4), table)
    versions = list((tmp_path / database / tables.VERSION_FOLDER / "t").iterdir())
    assert len(versions) == 2
    assert spark.table(table).count() == 4


@pytest.mark.parametrize("source", ["orc", "json"])
def test_merging_keeps_the_format_of_the_table(spark, database, source):
    spark.range(3).write.format(source).saveAsTable(f"{database}.t")
    tables.write_merged(spark.range(1).withColumn("Location", F.lit("y")), f"{database}.t")
    tables.write_merged(spark.range(2), f"{database}.t")
    assert rows(spark.table(f"{database}.t")) == [(0, None), (1, None)]


def test_three_part_names(spark, database):
    table = f"spark_catalog.{database}.t"
    tables.write_merged(spark.range(3), table)
    tables.write_merged(spark.range(2).withColumn("x", F.lit(1)), table)
    assert rows(spark.table(table)) == [(0, 1), (1, 1)]


def test_partitioned_tables_are_refused(spark, database):
    snapshots.write_snapshot(spark.range(3), f"{database}.t")
    with pytest.raises(ValueError, match="is partitioned"):
        tables.write_merged(spark.range(3), f"{database}.t")


def test_a_changed_type_is_refused(spark, database):
    tables.write_merged(spark.range(3), f"{database}.t")
    with pytest.raises(ValueError, match="column id is bigint in the table and string"):
        tables.write_merged(spark.range(3).withColumn("id", F.col("id").cast("string")), f"{database}.t")


@pytest.mark.parametrize("buckets", [0, 4])
def test_snapshots(spark, database, buckets):
    table = f"{database}.s"
    bucketing = {"bucket_key": "id", "buckets": buckets} if buckets else {}
    assert snapshots.write_snapshot(spark.range(5), table, **bucketing) == 0
    assert snapshots.write_snapshot(spark.range(3), table) == 1
    assert snapshots.write_snapshot(spark.range(2).withColumn("x", F.lit(1.5)), table) == 2
    assert snapshots.snapshot_versions(spark, table) == [0, 1, 2]
    assert snapshots.read_snapshot(spark, table, 1).count() == 3
    assert rows(snapshots.read_snapshot(spark, table)) == [(0, 1.5), (1, 1.5)]
    assert snapshots.read_snapshot(spark, table, 0).where("x is null").count() == 5
    with pytest.raises(ValueError, match="has no version 7"):
        snapshots.read_snapshot(spark, table, 7)


def test_next_snapshot_may_come_from_the_last(spark, database):
    table = f"{database}.s"
    snapshots.write_snapshot(spark.range(5), table)
    snapshots.write_snapshot(snapshots.read_snapshot(spark, table).where("id > 1"), table)
    assert rows(snapshots.read_snapshot(spark, table)) == [(2,), (3,), (4,)]


def test_change_feed(spark):
    old = spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, None, 4.0), (5, None, None)],
        "k int, s string, x double",
    )
    new = spark.createDataFrame(
        [(2, "b", None), (3, "c", None), (4, "d", 4.0), (5, None, None), (6, None, None)],
        "k int, s string, x double",
    )
    assert rows(snapshots.change_feed(old, new, "k")) == [
        (1, "a", 1.0, "delete"),
        (3, "c", None, "update"),
        (4, "d", 4.0, "update"),
        (6, None, None, "insert"),
    ]
    assert snapshots.change_feed(old, old, "k").isEmpty()


def test_change_feed_with_a_new_column(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    new = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "k int, s string, n int")
    assert rows(snapshots.change_feed(old, new, "k")) == [(1, "a", 1, "update")]


def test_change_feed_compares_null_keys_and_refuses_doubled_ones(spark):
    same = spark.createDataFrame([(None, "a"), (1, "b")], "k int, s string")
    assert snapshots.change_feed(same, same, "k").isEmpty()
    changed = spark.createDataFrame([(None, "z"), (1, "b")], "k int, s string")
    assert rows(snapshots.change_feed(same, changed, "k")) == [(None, "z", "update")]
    assert rows(snapshots.change_feed(same, same.where("k = 1"), "k")) == [(None, "a", "delete")]
    for doubled in (same.union(same.where("k = 1")), same.union(same.where("k is null"))):
        with pytest.raises(Exception, match="more than one row"):
            snapshots.change_feed(doubled, doubled, "k").collect()


VERSIONS = [
    [(1, "a", 1.0), (2, "b", None), (3, None, 3.0), (4, "d", 4.0), (5, "e", 5.0), (None, "n", 0.0), (7, "g", 7.0)],
    [(1, "a", 2.0), (2, None, None), (3, "c", 3.0), (5, "e", 5.0), (6, "f", 6.0), (8, "h", float("nan"))],
    [(1, "a", 1.0), (2, "b", None), (3, "x", 3.0), (4, "d", 4.0), (6, "f", 7.0), (None, "m", 0.0), (7, "g", -0.0)],
    [(1, "a", 1.0), (3, "x", 3.0), (4, "D", 4.0), (None, "m", 0.0), (9, None, None), (7, "g", 0.0)],
]
CHANGE_SCHEMA = "k int, s string, x double"


@pytest.mark.parametrize("recorded_from", [1, 2, 4])
def test_changes_of_many_versions_are_those_between_the_ends(spark, database, recorded_from):
    """Recorded changes are read, others computed; composed, they are one difference."""
    table, frames = f"{database}.t", [spark.createDataFrame(v, CHANGE_SCHEMA) for v in VERSIONS]
    for number, frame in enumerate(frames):
        if number == recorded_from:
            snapshots.record_changes(spark, table, "k")
        snapshots.write_snapshot(frame, table)
    snapshots.record_changes(spark, table, "k")
    for first in range(3):
        for last in range(first + 1, 4):
            changes = snapshots.table_changes(spark, table, first, last)
            found = snapshots.net_changes(changes, "k")
            expected = snapshots.change_feed(frames[first], frames[last], "k")
            assert found.columns == expected.columns
            # The texts of the rows, since NaN is not itself; both zeros are one value.
            plain = [[repr(r).replace("-0.0", "0.0") for r in rows(f)] for f in (found, expected)]
            assert plain[0] == plain[1]
    assert snapshots.net_changes(snapshots.table_changes(spark, table, 3, 3), "k").count() == 0


def test_recorded_changes_have_both_images(spark, database):
    table = f"{database}.t"
    snapshots.write_snapshot(spark.createDataFrame(VERSIONS[0], CHANGE_SCHEMA), table)
    snapshots.record_changes(spark, table, "k")
    snapshots.write_snapshot(spark.createDataFrame(VERSIONS[1], CHANGE_SCHEMA).withColumn("new", F.lit("y")), table)
    snapshots.write_snapshot(snapshots.read_snapshot(spark, table), table)
    stored = spark.table(f"{table}_changes").where("commit_version = 1").drop("commit_version", "new")
    nan = rows(stored.where("k = 8"))
    assert nan[0][0] == 8 and nan[0][3] == "insert"
    assert rows(stored.where("k <> 8 or k is null")) == sorted(
        [
            (1, "a", 1.0, "update_preimage"), (1, "a", 2.0, "update_postimage"),
            (2, "b", None, "update_preimage"), (2, None, None, "update_postimage"),
            (3, None, 3.0, "update_preimage"), (3, "c", 3.0, "update_postimage"),
            (4, "d", 4.0, "delete"), (5, "e", 5.0, "update_preimage"), (5, "e", 5.0, "update_postimage"),
            (6, "f", 6.0, "insert"), (7, "g", 7.0, "delete"), (None, "n", 0.0, "delete"),
        ],
        key=repr,
    )
    # An equal version has an empty partition.
    assert snapshots.partition_values(spark, f"{table}_changes") == [1, 2]
    with pytest.raises(ValueError, match="are not recorded"):
        snapshots.write_snapshot(spark.range(3), f"{database}.other")
        snapshots.table_changes(spark, f"{database}.other", 0, 1)


def test_digests_tell_null_and_nested_values_apart(spark):
    schema = "k int, a array<int>, m map<string,int>, s struct<x:int,y:string>, b binary, d decimal(20,3)"
    same = (1, [1, None], {"p": 1}, (1, None), b"x", None)
    others = [
        (1, [None, 1], {"p": 1}, (1, None), b"x", None),
        (1, [1, None], {"p": None}, (1, None), b"x", None),
        (1, [1, None], {"p": 1}, (None, "1"), b"x", None),
        (1, [1, None], {"p": 1}, (1, None), b"", None),
        (1, None, {"p": 1}, (1, None), b"x", None),
    ]
    old = spark.createDataFrame([same], schema)
    assert snapshots.change_feed(old, old, "k").isEmpty()
    for other in others:
        feed = snapshots.change_feed(old, spark.createDataFrame([other], schema), "k").collect()
        assert [r["change_type"] for r in feed] == ["update"]


def test_a_doubled_key_that_is_gone_is_refused(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, s string")
    with pytest.raises(Exception, match="more than one row"):
        snapshots.change_feed(old, old.where("k = 2"), "k").collect()


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n5,"he said ""hi"", ok"\n6,"two\nlines"\n')
    found = read_raw_csv(spark, str(tmp_path), multiline=True)
    assert rows(found) == [("5", 'he said "hi", ok'), ("6", "two\nlines")]


@pytest.mark.parametrize("bad", ["1,2,3", "1"])
def test_csv_rows_of_another_width_are_refused(spark, tmp_path, bad):
    (tmp_path / "a.csv").write_text(f"x,y\n1,2\n{bad}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw_csv(spark, str(tmp_path)).collect()


def test_csv_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path)).collect()


def test_stages_are_removed_at_the_end_of_their_scope(spark):
    with storage.stage_scope(spark):
        staged = storage.stage(spark.range(5), "test")
        assert staged.count() == 5
        path = staged.inputFiles()[0]
    with pytest.raises(Exception, match="(?i)not.exist|not_exist"):
        spark.read.parquet(path).count()


def test_release_deletes_what_this_process_staged(spark):
    staged = storage.stage(spark.range(5), "test")
    path = staged.inputFiles()[0]
    storage.release(spark)
    with pytest.raises(Exception, match="(?i)not.exist|not_exist"):
        spark.read.parquet(path).count()


def test_shared_folder_is_the_configured_one(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
