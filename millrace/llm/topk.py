"""Exact top-k by inner product with MaxScore over sharded postings.

The terms of a vector are its components. Within a shard the vectors stand in blocks. A block has two
postings lists for every term, one for each sign, without zeros, and knows the largest value of each
list. For a query this bounds what a term can add to a score. Sorted by bound, the longest run of
small terms whose bounds together stay below the current k-th score is non-essential: a vector that is
in no list of the other, essential terms cannot enter the result. Essential postings are traversed
first; what they and the remaining bounds keep competitive is probed with the other terms. Blocks come
in the order of all their bounds, those that stay below the k-th score are skipped, and the shards'
best are merged.

Vectors without a component at some place count as zero there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.storage import stage

K = 5
#: Vectors of a shard on average, and of a block of postings.
SHARD_ROWS = 4096
BLOCK_ROWS = 512
#: Terms that are probed before competitive vectors are told apart again.
PROBED = 8
#: Queries that are searched together, and the share of entries that are not zero from which on the
#: postings of a block stand in a matrix.
QUERIES = 256
DENSE = 0.25
SCALE = 256


def scaled(vector: str) -> Column:
    """floor(SCALE * x) of every component, with x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long"))


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite."""
    broken = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))),
    )
    return F.col(vector).isNotNull() & ~broken


class Block:
    """Postings of some vectors: for each term the rows where it is positive, and where it is negative.

    List 2 t holds the rows in which term t is positive, list 2 t + 1 those in which it is negative;
    zeros are in none. A query uses of each term the list of its own sign, which alone adds to a score.
    Where lists hold much of all rows, they stand as rows of a matrix as well, and the lists of many
    queries are traversed in one product.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        terms = vectors.shape[1]
        term, row = np.nonzero(vectors.T)
        value = vectors[row, term]
        number = 2 * term + (value < 0)
        order = np.argsort(number, kind="stable")
        self.rows, self.values = row[order], value[order]
        self.starts = np.searchsorted(number[order], np.arange(2 * terms + 1))
        self.largest = np.zeros(2 * terms, np.int64)
        np.maximum.at(self.largest, number, np.abs(value))
        self.matrix = None
        if len(value) > DENSE * vectors.size:
            self.matrix = np.zeros((2 * terms, len(ids)))
            self.matrix[number, row] = np.abs(value)
            self.columns = np.ascontiguousarray(vectors.T, np.float64)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """What each term of a query, or of each of several, can add to a score."""
        return np.abs(queries) * self.largest[2 * np.arange(queries.shape[-1]) + (queries < 0)]

    def competitive(self, query: np.ndarray, least: int | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows whose score reaches ``least`` (all, if it is None), their scores, and the number of
        postings that were traversed."""
        known = np.array([least is not None])
        _, rows, score, read = self.competitive_to(query[None], np.array([least or 0]), known)
        return rows, score, int(read[0])

    def competitive_to(
        self, queries: np.ndarray, least: np.ndarray, known: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same for many queries: pairs of query and row, their scores, postings by query.

        ``least`` counts for the queries that are ``known`` to have one.
        """
        bound = self.bounds(queries)
        order = np.argsort(bound, axis=1, kind="stable")
        together = np.cumsum(np.take_along_axis(bound, order, 1), axis=1)
        # Of the terms before, the bounds stay below: only they are no essential ones.
        split = ((together < least[:, None]) & known[:, None]).sum(axis=1)
        rest = np.append(np.zeros((len(queries), 1), np.int64), together, axis=1)
        rest = np.take_along_axis(rest, split[:, None], 1)[:, 0]
        essential = np.zeros(queries.shape, bool)
        np.put_along_axis(essential, order, np.arange(queries.shape[1]) >= split[:, None], 1)
        weights = np.where(essential, queries, 0)
        largest = np.maximum(self.largest[::2], self.largest[1::2])
        # Sums of products are then exact as doubles, in any order.
        exact = int((np.abs(queries) * largest).sum(axis=1).max(initial=0)) < 1 << 53
        gain, read = self._gains(weights, exact)
        all_rows = ~known | (least <= 0)
        alive = all_rows[:, None] | ((gain > 0) & (gain + rest[:, None] >= least[:, None]))
        # What essential terms of the other sign take away, then the others by falling bounds.
        if self.matrix is not None and exact:
            score = (weights.astype(np.float64) @ self.columns).astype(np.int64)
            alive &= ~known[:, None] | (score + rest[:, None] >= least[:, None])
            query, row = np.nonzero(alive)
            score = score[query, row]
        else:
            query, row = np.nonzero(alive)
            taken = np.minimum(self.vectors[row] * weights[query], 0).sum(axis=1)
            score = gain[query, row] + taken
        rest = rest[query]
        for step in range(0, int(split.max(initial=0)), PROBED):
            keep = ~known[query] | (score + rest >= least[query])
            query, row, score, rest = query[keep], row[keep], score[keep], rest[keep]
            if not len(query):
                break
            place = split[query][:, None] - 1 - np.arange(step, step + PROBED)
            terms = order[query[:, None], np.maximum(place, 0)]
            factor = np.where(place >= 0, queries[query[:, None], terms], 0)
            score = score + (self.vectors[row[:, None], terms] * factor).sum(axis=1)
            rest = rest - np.where(place >= 0, bound[query[:, None], terms], 0).sum(axis=1)
        keep = ~known[query] | (score >= least[query])
        return query[keep], row[keep], score[keep], read

    def _gains(self, weights: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray]:
        """For each query and row, what the postings of terms with a weight add to its score; and the
        number of these postings by query."""
        lists = 2 * np.arange(weights.shape[1]) + (weights < 0)
        read = np.where(weights != 0, self.starts[lists + 1] - self.starts[lists], 0).sum(axis=1)
        if self.matrix is not None and exact:
            by_list = np.zeros((len(weights), len(self.matrix)))
            np.put_along_axis(by_list, lists, np.abs(weights).astype(np.float64), 1)
            return (by_list @ self.matrix).astype(np.int64), read
        gain = np.zeros((len(weights), len(self.ids)), np.int64)
        for number, own in enumerate(weights):
            terms = np.flatnonzero(own)
            begin = self.starts[lists[number, terms]]
            sizes = self.starts[lists[number, terms] + 1] - begin
            at = np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
            np.add.at(gain[number], self.rows[at], self.values[at] * np.repeat(own[terms], sizes))
        return gain, read


class Shard:
    """Blocks of postings, searched in the order of what their terms can add up to for the queries.

    ``traversed`` and ``skipped`` count postings that searches read as essential ones and that they
    left out, among those that can add to a score.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block_rows: int = BLOCK_ROWS):
        parts = [slice(at, at + block_rows) for at in range(0, len(ids), block_rows)]
        self.blocks = [Block(ids[part], vectors[part]) for part in parts]
        self.width = vectors.shape[1]
        self.traversed = self.skipped = 0

    def search(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) for a query, without rows of the id ``own``."""
        return [(s, i) for _, s, i in self.search_all(np.array([own]), [query], k)]

    def search_all(
        self, own: np.ndarray, vectors: list[np.ndarray], k: int
    ) -> list[tuple[int, int, int]]:
        """The k best (number of the query, score, id) for each query, without rows of its own id.

        Queries go through a block together, each with its own k-th score, and through the blocks in
        the order of what they can reach in all.
        """
        queries = np.zeros((len(vectors), self.width), np.int64)
        for number, vector in enumerate(vectors):
            queries[number, : len(vector)] = vector[: self.width]
        lists = 2 * np.arange(self.width) + (queries < 0)
        reach = [block.bounds(queries).sum(axis=1) for block in self.blocks]
        best = (np.empty(0, np.int64),) * 3  # query, score, id
        least, known = np.zeros(len(queries), np.int64), np.zeros(len(queries), bool)
        for number in sorted(range(len(reach)), key=lambda n: -float(reach[n].sum())):
            block = self.blocks[number]
            sizes = block.starts[lists + 1] - block.starts[lists]
            usable = np.where(queries != 0, sizes, 0).sum(axis=1)
            self.skipped += int(usable.sum())
            asked = np.flatnonzero(~known | (reach[number] >= least))
            if not len(asked):
                continue
            query, row, score, read = block.competitive_to(queries[asked], least[asked], known[asked])
            self.traversed += int(read.sum())
            self.skipped -= int(read.sum())
            query = asked[query]
            other = block.ids[row] != own[query]
            found = (query[other], score[other], block.ids[row[other]])
            query, score, doc = (np.concatenate(x) for x in zip(best, found))
            order = np.lexsort((doc, -score, query))
            query, score, doc = query[order], score[order], doc[order]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            best = (query[place < k], score[place < k], doc[place < k])
            last = place == k - 1
            least[query[last]], known[query[last]] = score[last], True
        return list(zip(*(x.tolist() for x in best)))


def _search_shards(k: int):
    """Rows come sorted by shard, the vectors of a shard before the queries against it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, vectors, index = None, [], [], None
        asked, queries = [], []

        def search() -> pa.RecordBatch:
            nonlocal index
            if index is None:
                index = Shard(np.array(ids, np.int64), _rectangle(vectors))
            found = index.search_all(np.array(asked, np.int64), queries, k)
            number, score, doc = zip(*found) if found else ((), (), ())
            columns = [[asked[n] for n in number], doc, score]
            asked.clear(), queries.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
            )

        for batch in batches:
            heads = (c.to_pylist() for c in batch.columns[:3])
            for shard, is_query, vec_id, vector in zip(*heads, _vectors(batch.column(3))):
                if shard != current:
                    if asked:
                        yield search()
                    current, ids, vectors, index = shard, [], [], None
                if not is_query:
                    ids.append(vec_id)
                    vectors.append(vector)
                    continue
                asked.append(vec_id)
                queries.append(vector)
                if len(asked) == QUERIES:
                    yield search()
        if asked:
            yield search()

    return run


def _vectors(column: pa.ListArray) -> list[np.ndarray]:
    """Each list as an array of its own: it outlives the batch."""
    values = column.flatten().to_numpy().astype(np.int64)
    return np.split(values, np.cumsum(column.value_lengths().to_numpy())[:-1]) if len(column) else []


def _rectangle(vectors: list[np.ndarray]) -> np.ndarray:
    width = max(map(len, vectors), default=0)
    table = np.zeros((len(vectors), width), np.int64)
    for row, vector in enumerate(vectors):
        table[row, : len(vector)] = vector
    return table


def top_k(
    queries: DataFrame, vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k best among the rows of other ids.

    Both inputs need ``vec_id`` and ``vector`` (array of long). Equal scores go to the smaller
    ``vec_id``. Defined results: rows with NULL ``vec_id`` or ``vector`` take no part; repeated rows
    are candidates each; of repeated query ids the smallest vector is searched; with fewer than k
    candidates all are returned; empty inputs give no rows. Products and sums must fit in 64 bits.

    Vectors are dealt out to shards at random, so that no id or value makes a shard large; queries
    go to every shard in turn and are never held together.
    """
    known = "vec_id is not null and vector is not null"
    vectors = vectors.where(known).select(F.col("vec_id").cast("long"), "vector")
    shards = max(1, -(-vectors.count() // shard_rows))
    dealt = stage(vectors.withColumn("shard", F.floor(F.rand(11) * shards).cast("int")), "vectors")
    asked = (
        queries.where(known)
        .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
        .agg(F.min("vector").alias("vector"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    rows = dealt.select("shard", F.lit(False).alias("is_query"), "vec_id", "vector").union(
        asked.select("shard", F.lit(True).alias("is_query"), "vec_id", "vector")
    )
    best = (
        rows.repartition("shard")
        .sortWithinPartitions("shard", "is_query")
        .mapInArrow(_search_shards(k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
