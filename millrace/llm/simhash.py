"""SimHash fingerprints and near-duplicate groups, searched by pigeonring filtering.

A fingerprint is cut into ``SEGMENTS`` segments that form a ring. If two fingerprints differ in at
most ``BITS`` bits, then some segment of the ring starts a chain in which the first l segments
together differ in at most floor(l * BITS / SEGMENTS) bits, for every l. With four segments and three
bits these budgets are 0, 1, 2 and 3: the first segment is equal, and the second differs in one bit
at most, so one of its halves is equal. Start, first segment and that half are the join key (24 bits
of content, eight keys for a fingerprint); the whole chain is checked before the Hamming distance.

Equal fingerprints are one node. A key that more than ``HOT`` different fingerprints share is not
compared in pairs at all: each such fingerprint is linked through the values around it (distance at
most 1 from one end and 2 from the other), which is exact and linear in their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import workers
from millrace.llm.components import connected_components, forest
from millrace.sources.storage import stage

SEED = 42
SHINGLE = 3
BITS = 3
SEGMENTS = 4
#: Different fingerprints under one key that are still compared in pairs, in numpy blocks.
HOT = 4096

_WIDTH = 64 // SEGMENTS
_BUDGETS = [length * BITS // SEGMENTS for length in range(1, SEGMENTS + 1)]


def simhash(text: str | None) -> int:
    """Unsigned fingerprint of a whole text; 0 without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-SHINGLE] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[SHINGLE - 1 :].tolist())],
        np.uint64,
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for each row; fp holds the 64 bits as a signed long. NULL text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("simhash")
        for batch in batches:
            found = np.array([simhash(t) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def _keys(nodes: DataFrame) -> DataFrame:
    """Eight rows for each node: start of the chain, its first segment, half of the second."""
    half = _WIDTH // 2
    keys = []
    for start in range(SEGMENTS):
        first = F.shiftrightunsigned("fp", start * _WIDTH).bitwiseAND(F.lit((1 << _WIDTH) - 1))
        second = (start + 1) % SEGMENTS * _WIDTH
        for part in range(2):
            rest = F.shiftrightunsigned("fp", second + part * half).bitwiseAND(
                F.lit((1 << half) - 1)
            )
            key = F.shiftleft(first, half).bitwiseOR(rest)
            keys.append(key + F.lit((2 * start + part) << (_WIDTH + half)))
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "fp", "rep")


def _chain_passes(start: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Whether each chain from ``start`` keeps within its budgets; the last is the distance."""
    shift = (start * _WIDTH).astype(np.uint64)
    # The ring, turned so that the chain starts at the lowest bits.
    turned = (differ >> shift) | (differ << ((np.uint64(64) - shift) & np.uint64(63)))
    alive = np.arange(len(differ))
    for length, budget in enumerate(_BUDGETS, 1):
        mask = np.uint64((1 << (_WIDTH * length)) - 1)
        alive = alive[np.bitwise_count(turned[alive] & mask) <= budget]
    return alive


def _links_of_runs(key: np.ndarray, fp: np.ndarray, rep: np.ndarray):
    """Links between rows of equal key, as a forest. The rows are sorted by key."""
    start = (key >> (_WIDTH + _WIDTH // 2)) >> 1
    lefts, rights, waiting = [], [], 0
    at, step = np.arange(len(key)), 1
    while len(at := at[: np.searchsorted(at, len(key) - step)]):
        at = at[key[at] == key[at + step]]
        near = at[_chain_passes(start[at], fp[at] ^ fp[at + step])]
        lefts.append(rep[near])
        rights.append(rep[near + step])
        waiting += len(near)
        if waiting > 1 << 20:
            a, b = forest(np.concatenate(lefts), np.concatenate(rights))
            lefts, rights, waiting = [a], [b], 0
        step += 1
    if not waiting and not any(map(len, lefts)):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(np.concatenate(lefts), np.concatenate(rights))


def _compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by key; the last run of a batch waits for the next batch."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            now = [np.concatenate(pair) for pair in zip(rest, now)]
        cut = int(np.searchsorted(now[0], now[0][-1]))
        rest = [c[cut:] for c in now]
        if cut:
            yield _link_batch(now[0][:cut], now[1][:cut], now[2][:cut])
    if rest is not None:
        yield _link_batch(*rest)


def _link_batch(key, fp, rep) -> pa.RecordBatch:
    links = _links_of_runs(key, fp.view(np.uint64), rep)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in links], ["a", "b"])


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, rep, close) for all values within two bits; close: within one."""
    masks = [0, *(1 << i for i in range(64))]
    masks += [1 << i | 1 << j for i, j in combinations(range(64), 2)]
    flips = np.array(masks, np.uint64)
    close = pa.array(np.arange(len(flips)) <= 64)
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for fp, rep in zip(fps, batch.column(1).to_pylist()):
            values = pa.array((flips ^ fp).view(np.int64))
            reps = pa.array(np.full(len(flips), rep, np.int64))
            yield pa.RecordBatch.from_arrays([values, reps, close], ["value", "rep", "close"])


def _links_of_hot(nodes: DataFrame) -> DataFrame:
    """Links within three bits among ``nodes``, by common values. A value has 2,081 rows at most."""
    around = nodes.mapInArrow(_surroundings, "value long, rep long, close boolean")
    met = around.groupBy("value").agg(
        F.min(F.when(F.col("close"), F.col("rep"))).alias("a"), F.collect_set("rep").alias("reps")
    )
    pairs = met.where(F.col("a").isNotNull() & (F.size("reps") > 1))
    return pairs.select("a", F.explode("reps").alias("b")).where("a <> b").distinct()


def near_links(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """Links (a, b) between ``rep`` values whose different ``fp`` lie within three bits.

    The links have the same connected components as all such pairs; they are not all pairs.
    """
    keyed = _keys(nodes)
    crowded = stage(keyed.groupBy("key").count().where(F.col("count") > hot).select("key"), "hot")
    plain = keyed
    if not crowded.isEmpty():
        plain = keyed.join(crowded, "key", "left_anti")
    links = (
        plain.repartition("key")
        .sortWithinPartitions("key")
        .select("key", "fp", "rep")
        .mapInArrow(_compare_runs, "a long, b long")
    )
    if crowded.isEmpty():
        return links
    members = keyed.join(crowded, "key", "left_semi").select("fp", "rep").distinct()
    return links.union(_links_of_hot(members))


def near_groups(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    Defined results: a text without a word (NULL, empty, white space) has fingerprint zero and is
    linked like any other; repeated rows give one result each; rows with NULL ``doc_id`` have a
    fingerprint but take no part in linking, and their component is NULL; an empty table gives no
    rows; further columns are not read. ``doc_id`` must be an integer.
    """
    prints = stage(
        fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "prints"
    )
    nodes = stage(
        prints.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("rep")),
        "nodes",
    )
    roots = connected_components(near_links(nodes, hot))
    placed = nodes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "fp", F.coalesce("root", "rep").alias("component_id")
    )
    return prints.join(placed, "fp", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the smallest of its group, one row for each.

    Rows with NULL ``doc_id`` are kept.
    """
    groups = near_groups(docs)
    keepers = groups.where("doc_id = component_id").select("doc_id").distinct()
    known = docs.join(keepers, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return known.select(docs.columns).union(docs.where(F.col("doc_id").isNull()))
