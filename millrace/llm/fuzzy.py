"""Context-triggered piecewise hashing of whole texts.

A rolling hash over the last seven bytes ends a chunk wherever its low bits are all ones; with one bit
more the ends are a subset. A signature has one character for each chunk. The block size is the
smallest power of two that gives at most ``LONGEST`` characters, so a signature always covers the
whole text. A fingerprint holds the signatures for this block size and for twice that size:
``block:signature:signature``. Two fingerprints are compared by edit distance where they have
signatures for the same block size; otherwise they are not alike.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.storage import stage

LONGEST = 64
ROLLING = 7
#: Bytes of a text that are hashed at a time.
BLOCK = 1 << 21
# Fixed value: the characters of base 64.
_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

_FIELDS = (
    "doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def levels(body: bytes) -> np.ndarray:
    """For each byte, how many low bits of the rolling hash that ends there are ones."""
    found = []
    for begin in range(0, len(body), BLOCK):
        back = min(begin, ROLLING - 1)
        block = np.frombuffer(body[begin - back : begin + BLOCK], np.uint8).astype(np.uint32)
        rolled = np.zeros(len(block) + ROLLING - 1, np.uint32)
        for ago in range(ROLLING):
            rolled[ago : ago + len(block)] += (block + np.uint32(1)) * np.uint32(
                pow(0x01000193, ago + 1, 1 << 32)
            )
        rolled = rolled[: len(block)][back:]
        mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(2246822519)
        mixed ^= mixed >> np.uint32(13)
        found.append(np.bitwise_count(mixed & ~(mixed + np.uint32(1))).astype(np.uint8))
    return np.concatenate(found) if found else np.empty(0, np.uint8)


def fingerprint(body: bytes) -> str:
    level = levels(body)
    at_least = np.cumsum(np.bincount(level, minlength=34)[::-1])[::-1]
    size = int(np.flatnonzero(at_least < LONGEST)[0])
    return f"{1 << size}:{_signature(body, level, size)}:{_signature(body, level, size + 1)}"


def _signature(body: bytes, level: np.ndarray, size: int) -> str:
    ends = (np.flatnonzero(level >= size) + 1).tolist()
    if not ends or ends[-1] != len(body):
        ends.append(len(body))
    starts = [0, *ends[:-1]]
    return "".join(_CHARACTERS[zlib.crc32(body[s:e]) & 63] for s, e in zip(starts, ends) if s < e)


def likeness(pairs: Sequence[tuple[str, str]]) -> np.ndarray:
    """0 to 1 for each pair of fingerprints; 1 for equal ones."""
    result = np.zeros(len(pairs))
    at, left, right = [], [], []
    for number, (one, other) in enumerate(pairs):
        if one == other:
            result[number] = 1.0
            continue
        size_a, *own = one.split(":")
        size_b, *theirs = other.split(":")
        ratio = int(size_a) / int(size_b)
        if ratio in (0.5, 1, 2):
            at.append(number)
            left.append(own[ratio == 0.5])
            right.append(theirs[ratio == 2])
    if at:
        longest = np.array([max(len(a), len(b), 1) for a, b in zip(left, right)])
        result[at] = 1 - edit_distances(left, right) / longest
    return result


def edit_distances(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Levenshtein distances of many pairs of short strings at once."""
    tall, wide = max(map(len, left)), max(map(len, right))
    a = np.zeros((len(left), tall), np.uint8)
    b = np.zeros((len(right), wide), np.uint8)
    for row, (x, y) in enumerate(zip(left, right)):
        a[row, : len(x)] = np.frombuffer(x.encode(), np.uint8)
        b[row, : len(y)] = np.frombuffer(y.encode(), np.uint8)
    rows, columns = np.array(list(map(len, left))), np.array(list(map(len, right)))
    steps = np.arange(wide + 1, dtype=np.int16)
    line = np.tile(steps, (len(left), 1))
    result = np.where(rows == 0, columns, 0)
    for i in range(tall):
        entry = np.empty_like(line)
        entry[:, 0] = i + 1
        changed = (b != a[:, i : i + 1]).astype(np.int16)
        entry[:, 1:] = np.minimum(line[:, 1:] + 1, line[:, :-1] + changed)
        line = np.minimum.accumulate(entry - steps, axis=1) + steps
        done = np.flatnonzero(rows == i + 1)
        result[done] = line[done, columns[done]]
    return result


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many characters of the following text."""
    count = len(text) // 4
    return text[: len(text) - count] + following[:count]


def _describe(texts: list[str], following: list[str], prints: list[str], next_prints: list[str]):
    """Columns of the result behind the key, for texts and the texts that follow them."""
    bodies = [edited(t, n).encode("utf-8") for t, n in zip(texts, following)]
    edited_prints = [fingerprint(b) for b in bodies]
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(b).hexdigest() for b in bodies], pa.string()),
        pa.array(prints, pa.string()),
        pa.array(edited_prints, pa.string()),
        pa.array(likeness(list(zip(prints, edited_prints)))),
        pa.array(likeness(list(zip(prints, next_prints)))),
    ]


def _inner_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows of a task but the last; its first and last text go on as they are.

    Rows come in order. ``edge``: 0 for a result, 1 for the first text of a task, 2 for the last.
    """
    part = TaskContext.get().partitionId()
    last = None
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            piece = batch.slice(begin, 256)
            ids, texts = piece.column(0), [t or "" for t in piece.column(1).to_pylist()]
            prints = [fingerprint(t.encode("utf-8")) for t in texts]
            if last is None:
                yield _edge(part, 1, ids.slice(0, 1), texts[0])
            else:
                ids = pa.concat_arrays([last[0], ids])
                texts, prints = [last[1], *texts], [last[2], *prints]
            last = (ids.slice(len(ids) - 1), texts[-1], prints[-1])
            n = len(texts) - 1
            described = _describe(texts[:-1], texts[1:], prints[:-1], prints[1:])
            yield _with_edge(part, 0, ids.slice(0, n), described, [None] * n)
    if last is not None:
        yield _edge(part, 2, last[0], last[1])


def _edge(part: int, edge: int, ids: pa.Array, text: str) -> pa.RecordBatch:
    empty = [pa.nulls(1, kind) for kind in (pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)]
    return _with_edge(part, edge, ids, empty, [text])


def _with_edge(part, edge, ids, described, texts) -> pa.RecordBatch:
    names = [field.split()[0] for field in _FIELDS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(ids), part, np.int32)),
            pa.array(np.full(len(ids), edge, np.int32)),
            pa.array(texts, pa.string()),
            ids,
            *described,
        ],
        ["part", "edge", "text", *names],
    )


def _edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in _FIELDS.split(", ")]
    for batch in batches:
        texts, following = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        prints = [fingerprint(t.encode("utf-8")) for t in texts]
        next_prints = [fingerprint(t.encode("utf-8")) for t in following]
        described = _describe(texts, following, prints, next_prints)
        yield pa.RecordBatch.from_arrays([batch.column(0), *described], names)


def describe_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how near it is to that and to the next.

    The next document is the next row by ``doc_id``, and the first one after the last. Documents are
    range-partitioned and read in order; only the first and last text of each task are joined again,
    and only numbers of tasks come to the driver. Defined results: NULL text is empty; rows of equal
    ``doc_id`` follow each other in an order fixed by their text and a seeded number; NULL ``doc_id``
    comes first; a single row follows itself; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    fields = _FIELDS.format(kind=docs.schema["doc_id"].dataType.simpleString())
    order = ["doc_id", "mark", "salt"]
    ranged = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("mark"), F.rand(5).alias("salt"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    rows = stage(
        ranged.select("doc_id", "text").mapInArrow(
            _inner_rows, f"part int, edge int, text string, {fields}"
        ),
        "fuzzy",
    )
    parts = sorted(r["part"] for r in rows.where("edge = 1").select("part").collect())
    links = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, after int")
    heads = rows.where("edge = 1").select(
        F.col("part").alias("after"), F.col("text").alias("following")
    )
    tails = rows.where("edge = 2").select("part", "doc_id", "text")
    edges = (
        tails.join(links, "part")
        .join(heads, "after")
        .select("doc_id", "text", "following")
        .mapInArrow(_edge_rows, fields)
    )
    names = [field.split()[0] for field in fields.split(", ")]
    return rows.where("edge = 0").select(*names).union(edges)
