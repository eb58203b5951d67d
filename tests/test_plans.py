"""Physical plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import clean, impute, keys, metrics, split
from millrace.sources import snapshots, tables

ORDERS = "/root/testdata/sf0.001/orders.parquet"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return re.findall(r"Exchange (?!SinglePartition)\w*\(?", plan(df).replace("BroadcastExchange", ""))


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(ORDERS)


def test_coerce_and_fill_are_projections(orders):
    filled = impute.impute(
        clean.coerce_numeric(orders, ["o_totalprice"]), {"o_totalprice": "median"}
    )
    assert "Exchange" not in plan(filled)
    assert "Join" not in plan(filled)


@pytest.mark.parametrize("splitter", [split.split_exact, split.split_bucket])
def test_splits_are_filters(orders, splitter):
    for part in splitter(orders.select("o_orderkey", "o_totalprice"), "o_orderkey"):
        text = plan(part)
        assert "Exchange" not in text and "Join" not in text
        assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_numbering_never_gathers_rows(orders):
    numbered = keys.add_sequential_key(orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"])
    assert "SinglePartition" not in plan(numbered)
    assert "BroadcastHashJoin" in plan(numbered)
    assert shuffles(numbered) == []


def test_repeat_row_is_no_join(orders):
    repeated = keys.repeat_row(orders.select("o_orderkey"), orders.agg(F.max("o_totalprice").alias("m")))
    assert "Join" not in plan(repeated)


def test_metrics_read_two_columns_once(orders):
    measured = metrics.regression_metrics(orders, "o_totalprice", "o_custkey")
    text = plan(measured)
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_changes_of_bucketed_snapshots_need_no_shuffle(spark, orders, database):
    table = f"{database}.orders"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for part in (orders, orders.where("o_totalprice > 1000")):
            snapshots.write_snapshot(part, table, bucket_key="o_orderkey", buckets=4)
        feed = snapshots.change_feed(
            snapshots.read_snapshot(spark, table, 0),
            snapshots.read_snapshot(spark, table, 1),
            "o_orderkey",
        )
        assert "Exchange" not in plan(feed)
        assert "PartitionFilters: [isnotnull(snapshot_version" in plan(feed)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_change_feed_shuffles_keys_and_digests_alone(spark, orders):
    """Whole rows are fetched afterwards, and only where few changed are they not moved at all."""
    before = orders.withColumn("o_totalprice", F.expr("o_totalprice + IF(o_orderkey % 100 = 0, 1, 0)"))
    feed = snapshots.change_feed(before, orders, "o_orderkey")
    text = plan(feed)
    assert "NestedLoop" not in text and "Cartesian" not in text and "SortAggregate" not in text
    moved = [line for line in text.splitlines() if re.search(r"Exchange hashpartitioning", line)]
    assert moved and "SinglePartition" not in text
    aggregates = re.findall(r"HashAggregate\(keys=\[o_orderkey\S*\], functions=\[(.*?)\]", text)
    assert aggregates and all("o_comment" not in a and "first" not in a for a in aggregates)
    feed.collect()
    done = plan(feed)
    assert "BroadcastHashJoin" in done


def test_scan_reads_only_the_named_columns(spark, orders, database):
    tables.overwrite_table(orders, f"{database}.orders")
    text = plan(tables.scan(spark, f"{database}.orders", ["o_orderkey"]))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text
