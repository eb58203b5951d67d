import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import split


def keys_of(df):
    return sorted(r["key"] for r in df.select("key").collect())


def expected_test_keys(all_keys, size, seed):
    ordered = sorted(all_keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
    return sorted(ordered[: math.ceil(len(all_keys) * size)])


@pytest.mark.parametrize("partitions", [1, 4, 9])
@pytest.mark.parametrize("candidate_limit", [100_000, 1])
def test_exact_split(people, partitions, candidate_limit):
    train, test = split.split_exact(
        people.repartition(partitions), "key", 0.2, 42, candidate_limit=candidate_limit
    )
    assert keys_of(test) == expected_test_keys(range(1000), 0.2, 42)
    assert sorted(keys_of(train) + keys_of(test)) == list(range(1000))


@pytest.mark.parametrize(("rows", "size"), [(1, 0.2), (3, 0.5), (7, 0.99), (999, 0.333), (10, 0.05)])
def test_exact_size_is_rounded_up(people, rows, size):
    train, test = split.split_exact(people.where(F.col("key") < rows), "key", size, 7)
    assert test.count() == math.ceil(rows * size)
    assert train.count() == rows - test.count()


def test_rows_with_one_digest_are_parted_by_key(people, monkeypatch):
    monkeypatch.setattr(split, "key_digest", lambda key, seed: F.lit("0" * 32))
    train, test = split.split_exact(people, "key", 0.3)
    assert keys_of(test) == list(range(300))
    assert keys_of(train) == list(range(300, 1000))


def test_seed_changes_the_split(people):
    first = keys_of(split.split_exact(people, "key", seed=1)[1])
    second = keys_of(split.split_exact(people, "key", seed=2)[1])
    assert first != second
    assert first == expected_test_keys(range(1000), 0.2, 1)


def test_empty_input(people):
    train, test = split.split_exact(people.where("false"), "key")
    assert train.count() == test.count() == 0


def test_missing_keys_are_refused(spark):
    df = spark.createDataFrame([(1,), (None,)], "key bigint")
    with pytest.raises(Exception, match="key column key has a missing value"):
        split.split_exact(df, "key")
    with pytest.raises(Exception, match="key column key has a missing value"):
        split.split_bucket(df, "key")[0].collect()


@pytest.mark.parametrize("candidate_limit", [100_000, 5])
def test_a_key_on_both_sides_is_refused(spark, candidate_limit):
    df = spark.range(100).select(F.lit(1).alias("key"))
    with pytest.raises(ValueError, match="not unique"):
        split.split_exact(df, "key", candidate_limit=candidate_limit)


@pytest.mark.parametrize("partitions", [1, 4, 9])
def test_bucket_split(people, partitions):
    train, test = split.split_bucket(people.repartition(partitions), "key")
    wanted = [k for k in range(1000) if int(hashlib.md5(f"42:{k}".encode()).hexdigest()[:12], 16) % 1000 < 200]
    assert keys_of(test) == wanted
    assert sorted(keys_of(train) + wanted) == list(range(1000))


def test_sizes_are_checked(people):
    for size in (0, 1, -0.5, 2):
        with pytest.raises(ValueError, match="between 0 and 1"):
            split.split_exact(people, "key", size)
    with pytest.raises(ValueError, match="whole number"):
        split.split_bucket(people, "key", 0.00015)


@pytest.mark.parametrize("n", [0, 30, 999, 200_000])
def test_ordered_limit(people, n):
    first = split.ordered_limit(people, [F.desc("score"), "key"], n).collect()
    assert first == sorted(people.collect(), key=lambda r: (-r["score"], r["key"]))[:n]


@pytest.fixture(scope="module")
def odd_orders(spark):
    """Ties, NULLs and NaN in the first keys, and a unique last one."""
    rows = [
        (i, None if i % 13 == 0 else float("nan") if i % 17 == 0 else float(i * 7919 % 23), None if i % 5 == 0 else "abc"[i % 3])
        for i in range(4000)
    ]
    return spark.createDataFrame(rows, "k int, x double, `odd name` string").repartition(7)


@pytest.mark.parametrize("n", [51, 2000, 3999, 5000])
@pytest.mark.parametrize(
    "keys",
    [
        lambda: [F.desc("x"), F.asc_nulls_last("odd name"), "k"],
        lambda: ["x", F.desc_nulls_first("odd name"), F.desc("k")],
        lambda: [F.desc("k")],
        lambda: [F.expr("k % 2").asc(), "k"],
    ],
    ids=["falling", "rising", "one key", "expression"],
)
def test_large_limits_are_those_of_a_sort(odd_orders, keys, n):
    found = split.ordered_limit(odd_orders, keys(), n, merged=50)
    expected = odd_orders.orderBy(*keys()).limit(n)
    assert [r["k"] for r in found.collect()] == [r["k"] for r in expected.collect()]


def test_equal_keys_cannot_be_cut(spark):
    df = spark.range(1000).select(F.lit(1).alias("x"), "id")
    found = split.ordered_limit(df, ["x"], 600, merged=10)
    assert found.count() == 600 and found.distinct().count() == 600


def test_no_task_gets_all_rows_of_a_large_limit(spark):
    """A million of two million rows: only the part around the end is limited in one task."""
    df = spark.range(2_000_000).select(F.col("id"), (F.col("id") * 7919 % 2_000_003).alias("x"))
    found = split.ordered_limit(df, ["x", "id"], 1_000_000)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(x" in text
    (limit,) = re.findall(r"TakeOrderedAndProject\(limit=(\d+)", text)
    assert int(limit) <= 100_000
    assert found.count() == 1_000_000
    assert found.agg(F.max("x")).first()[0] == df.orderBy("x").limit(1_000_000).agg(F.max("x")).first()[0]
