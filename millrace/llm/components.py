"""Connected components of a links table, by alternating large and small stars.

Each round is two joins over the links that are left; nothing is gathered on the driver but a count
and a checksum. In a join against its own aggregate a node with very many links would be one key, which
adaptive execution does not split. Such a node's minimum is therefore copied, once for each ``part``
links, and its links are dealt out to the copies by a hash of the other end. The nodes in question are
broadcast: with ``part`` at least a ``HUBS``-th of all links, no more than ``HUBS`` can have that many.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.storage import stage

#: Links of one node that meet in one task, at least; and nodes with more, at most.
PART = 50_000
HUBS = 100_000


def _smallest(links: DataFrame, part: int) -> DataFrame:
    """(u, v, m) for each link: m is the smallest of u and all its partners in ``links``."""
    least = links.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    least = least.select("u", F.least("u", "m").alias("m"), F.floor(F.col("n") / part).alias("more"))
    hubs = least.where("more > 0").select("u", "more")
    own = F.coalesce(F.pmod(F.xxhash64("v"), F.col("more") + 1), F.lit(0))
    dealt = links.join(F.broadcast(hubs), "u", "left").select("u", "v", own.alias("part"))
    copied = least.select("u", "m", F.explode(F.sequence(F.lit(0).cast("long"), "more")).alias("part"))
    return dealt.join(copied, ["u", "part"]).select("u", "v", "m")


def _large_star(links: DataFrame, part: int) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    starred = _smallest(both, part).where(F.col("v") > F.col("u"))
    return starred.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame, part: int) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _smallest(down, part)
    moved = starred.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(starred.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, part: int = PART) -> DataFrame:
    """(node, root) for each node of ``links`` (two columns of one type), root the smallest node.

    Links from a node to itself and repeated links change nothing; NULL ends are left out.
    """
    first, second = links.columns
    current = stage(
        links.select(F.col(first).alias("u"), F.col(second).alias("v")).where("u <> v").distinct(),
        "links",
    )
    # A star never adds links, and a link has two ends.
    part = max(part, -(-2 * current.count() // HUBS))
    seen = None
    while True:
        current = stage(_small_star(_large_star(current, part), part), "links")
        mark = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if mark == seen:
            break
        seen = mark
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one link for each node with the same components as the links (a, b)."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        label = label[label]
        if np.array_equal(label, before):
            break
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]
