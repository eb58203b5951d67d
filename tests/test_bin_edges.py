import pytest
from pyspark.sql import functions as F

from millrace.operators.boosting import bin_edges


def test_rare_values_of_a_large_table_have_bins(spark):
    # Few different rows: two hot ones, and three values that occur once.
    rows = spark.range(120_000).select(
        F.when(F.col("id") < 3, F.col("id") + 10).otherwise(F.col("id") % 2).cast("double").alias("x"),
        F.lit(1.0).alias("_label"),
    )
    assert bin_edges(rows, ["x"], 32) == [[1.0, 10.0, 11.0, 12.0]]


@pytest.mark.parametrize("n", [400, 120_000])
def test_edges_are_quantiles_of_all_rows(spark, n):
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 5_003).cast("double").alias("hot row"),
        (F.sin("id") * 100).alias("z"),
    )
    steps = F.array(*(F.lit(i / 16) for i in range(1, 16)))
    expected = rows.agg(F.percentile("hot row", steps), F.percentile("z", steps)).first()
    found = bin_edges(rows.repartition(7), ["hot row", "z"], 16)
    assert [len(e) for e in found] == [len(set(e)) for e in expected]
    for own, exact in zip(found, expected):
        assert own == pytest.approx(sorted(set(exact)))
    assert 7.0 in found[0]
