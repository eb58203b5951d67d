"""Row numbers and joins by row position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.raw_csv import BLOCK, FILE, LINE
from millrace.sources.storage import stage


def _number_staged(staged: DataFrame, block: Sequence[str], line: str, name: str) -> DataFrame:
    """Number stored rows 1..n, given their block and an ascending position inside the block.

    Blocks sort by the columns ``block``; inside a block ``line`` counts up by one from anywhere,
    and a gap is an error. One small aggregate per block gives its first line and size, and the
    running sum of the sizes is the block's offset. Blocks are known by a 64-bit hash, so an offset is
    16 bytes however long file names are, and all offsets are broadcast: 16 MB for a million blocks,
    which is 128 TB in blocks of 128 MB. Data rows are never shuffled.
    """
    size = F.count(F.lit(1))
    gap = F.raise_error(F.lit("rows were removed after their positions had been taken"))
    sizes = staged.groupBy(*block).agg(
        F.when(F.max(line) - F.min(line) + 1 == size, size).otherwise(gap).alias("_size"),
        F.min(line).alias("_first"),
    )
    # One row per block, not per data row, so one task can hold the running sum.
    earlier = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.xxhash64(*block).alias("_hash"),
        (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    offsets = stage(offsets, "offsets")
    if offsets.count() != offsets.select("_hash").distinct().count():
        raise RuntimeError("two blocks share a hash; store the rows in other files")
    hashed = staged.withColumn("_hash", F.xxhash64(*block))
    numbered = hashed.join(F.broadcast(offsets), "_hash")
    data = [F.col(f"`{c}`") for c in staged.columns if c not in (*block, line)]
    return numbered.select(*data, (F.col(line) + F.col("_shift")).cast("bigint").alias(name))


def add_sequential_key(
    df: DataFrame, order_keys: Sequence[str | Column], name: str = "id"
) -> DataFrame:
    """Number the rows 1..n in the order of ``order_keys``, which must end in a unique one.

    The sort is a range shuffle over all tasks. Its result is written once together with each row's
    task and place in it, which settles the order for good: neither a lost executor nor a different
    partitioning of a second run over the same sort can renumber rows.
    """
    placed = df.orderBy(*order_keys).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_place"),
    )
    return _number_staged(stage(placed, "sorted"), ["_part"], "_place", name)


def number_file_rows(df: DataFrame, name: str = "id", stored: bool = False) -> DataFrame:
    """Number rows 1..n in file order, files by name, without any sort.

    ``df`` holds the rows of ``read_raw_csv(..., with_position=True)``, none of them removed. They
    are written once, because a second reading of the text might cut it into other blocks; with
    ``stored=True`` they already come from a written table.
    """
    placed = df if stored else stage(df, "placed")
    return _number_staged(placed, [FILE, BLOCK], LINE, name)


def zip_by_position(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str | Column],
    right_keys: Sequence[str | Column],
) -> DataFrame:
    """Pair row i of ``left`` with row i of ``right``, each in the order of its own keys.

    Left rows without a partner get NULLs; surplus right rows are left out. Where both sides share
    a key, :func:`attach_by_key` says the same with one join and no sort.
    """
    row = "_row_number"
    numbered_left = add_sequential_key(left, left_keys, row)
    numbered_right = add_sequential_key(right, right_keys, row)
    return numbered_left.join(numbered_right, row, "left").drop(row)


def attach_by_key(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Left join on a unique key."""
    return df.join(other, key, "left")


def repeat_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the values of a frame of exactly one row on every row of ``df``.

    The row is a scalar subquery: evaluated once, then used as a constant. Any other number of rows
    stops the query.
    """
    packed = F.first(F.struct(*(F.col(f"`{c}`") for c in one_row.columns)))
    rows = F.count(F.lit(1))
    message = F.concat(F.lit("expected one row to repeat, found "), rows.cast("string"))
    checked = one_row.agg(F.when(rows == 1, packed).otherwise(F.raise_error(message)).alias("row"))
    repeated = df.withColumn("_row", checked.scalar())
    return repeated.select(
        *(F.col(f"`{c}`") for c in df.columns), *(F.col("_row")[c].alias(c) for c in one_row.columns)
    )
