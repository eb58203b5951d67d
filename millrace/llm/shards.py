"""Rendezvous hashing of record keys over weighted shards.

Each shard gives each key a score, ``weight / -ln(u)`` with ``u`` a hash of key and shard in (0, 1);
the key goes to the shard with the highest score. A shard's score does not depend on the other
shards, so one more shard only takes the keys on which it beats the former winner.

Defined results: rows with a NULL key share one shard (their hash depends on the shard alone);
repeated keys share a shard and get slots of their own; an empty table gives no rows; shards of
weight zero get nothing; further columns of the input are kept as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.storage import stage


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard of each key, 0 to ``len(weights) - 1``. Equal scores go to the smaller shard."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be non-negative and one of them positive")
    scores = []
    for shard, weight in enumerate(weights):
        if weight == 0:
            continue
        # 53 bits of the hash, moved by half a step so that neither 0 nor 1 comes up.
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
        uniform = (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**53))
        scores.append(
            F.struct((F.lit(float(weight)) / -F.log(uniform)).alias("s"), F.lit(-shard).alias("n"))
        )
    return (-F.array_max(F.array(*scores))["n"]).cast("int")


def with_slots(df: DataFrame, shard: str, order: Sequence[str], slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, with no task that holds a whole shard.

    The rows are written once together with the task that wrote them. A window numbers the rows of
    each pair of shard and task, and a running total over the pairs (a few bytes for each) moves
    these numbers. Every window therefore holds at most what one task read, whatever key is hot.
    """
    part = "__part"
    rows = stage(df.withColumn(part, F.spark_partition_id()), "shards")
    counts = rows.groupBy(shard, part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        shard, part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    within = Window.partitionBy(shard, part).orderBy(*order)
    numbered = rows.withColumn("__row", F.row_number().over(within) - 1)
    return (
        numbered.join(offsets, [shard, part])
        .withColumn(slot, (F.col("__row") + F.col("__before")).cast("long"))
        .drop(part, "__row", "__before")
    )


def shard_documents(
    docs: DataFrame, weights: Sequence[float], added_weight: float = 1.0
) -> DataFrame:
    """Shard every document by ``doc_id``; ``grown_shard`` is its place with one more shard.

    ``size`` is the number of UTF-8 bytes of the text plus 1 and ``text_crc32`` its checksum, both
    with NULL read as the empty text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id")
    placed = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard(key, weights).alias("shard"),
        rendezvous_shard(key, [*weights, added_weight]).alias("grown_shard"),
    )
    numbered = with_slots(placed, "shard", ["doc_id", "size", "text_crc32"])
    return numbered.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
