"""Concatenate and cut: fixed windows over one long run of token ids.

First pass: every text becomes token ids, ended by id 0, and is written once with the task that wrote
it and with the number of ids before it in that task. The totals of the tasks, one number each, are
summed up in order. Second pass: the place of every id in the whole run is now known, so each row is
cut at multiples of the window on its own, without a shuffle. Only the last window has padding.

Task and place are read back from what was written, so a lost executor changes nothing.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import workers
from millrace.sources.storage import fresh_path

WINDOW = 1024
END = 0
#: Bytes of chunks and ids that one worker remembers; it starts anew beyond that.
REMEMBERED = 32 << 20
#: What a remembered chunk costs beside its own bytes.
_OVERHEAD = 200
#: Texts that are encoded together.
TOGETHER = 128

#: Ids, as bytes, of chunks that follow a single space; None where white space must not be cut off.
#: One memory for each vocabulary, with the bytes it holds.
_memories: dict[str, "_Memory"] = {}


class _Memory(dict):
    held = 0


def vocabulary_path() -> str:
    """Place of the public byte-level vocabulary, as ranks, on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoder(path: str):
    """The encoder and the number of bytes of each token."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoder = tiktoken.Encoding(
        "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return encoder, sizes


def added_tokens(path: str) -> dict[str, int]:
    """Tokens that stand for themselves wherever their text appears: those of the same vocabulary's
    JSON file beside ``path``; none if there is no such file."""
    spec = Path(path).with_suffix(".json")
    if not spec.exists():
        return {}
    tokens = json.loads(spec.read_text(encoding="utf-8"))["added_tokens"]
    return {token["content"]: token["id"] for token in tokens}


@lru_cache(maxsize=2)
def _added(path: str):
    tokens = added_tokens(path)
    longest_first = sorted(tokens, key=len, reverse=True)
    return tokens, re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if tokens else None


@lru_cache(maxsize=2)
def _kind(path: str) -> np.dtype:
    """The type that holds an id; it takes no encoder."""
    with open(path, "rb") as file:
        most = max(int(line.split()[1]) for line in file)
    return np.dtype("<u2" if most < 1 << 16 else "<u4")


def _forget() -> None:
    _memories.clear()
    _encoder.cache_clear()
    _added.cache_clear()


workers.remembers("packing", _forget)


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian numbers of two or four bytes, without the end.

    Names of added tokens in a text are their ids, and what stands between them is encoded on its own.
    """
    tokens, named = _added(path)
    kind = _kind(path)
    odd = {i: named.split(t) for i, t in enumerate(texts) if named.search(t)} if named else {}
    plain = [t for i, t in enumerate(texts) if i not in odd]
    between = [part for parts in odd.values() for part in parts[::2]]
    coded = iter(_encode_plain([*plain, *between], path))
    found = [b"" if i in odd else next(coded) for i in range(len(texts))]
    for i, parts in odd.items():
        own = [np.array([tokens[p]], kind).tobytes() if k % 2 else next(coded) for k, p in enumerate(parts)]
        found[i] = b"".join(own)
    return found


def _encode_plain(texts: list[str], path: str) -> list[bytes]:
    """Ids of texts without added tokens.

    The vocabulary's rule never joins a character to a single space after it, so a text without other
    white space next to a space may be cut before every space, and equal chunks are encoded once.
    Other texts are encoded whole.
    """
    encoder, kind = _encoder(path)[0], _kind(path)
    chunks = _memories.setdefault(path, _Memory())
    if chunks.held > REMEMBERED:
        chunks.clear()
        chunks.held = 0
    parts = [text.split(" ") for text in texts]
    new = list(set().union(*(own[1:] for own in parts)).difference(chunks))
    _remember(new, path)
    encoded = []
    for text, own in zip(texts, parts):
        first = own[0]
        own[0] = ""
        try:
            if own[1:] and first != first.rstrip():
                raise TypeError
            rest = b"".join(map(chunks.__getitem__, own[1:]))
        except TypeError:  # a chunk of None
            first, rest = text, b""
        encoded.append(np.array(encoder.encode_ordinary(first), kind).tobytes() + rest)
    chunks.held += sum(len(c) + len(chunks[c] or b"") + _OVERHEAD for c in new)
    return encoded


def _remember(new: list[str], path: str) -> None:
    """Encode new chunks in one go: joined by spaces, their ids fall apart at the same spaces."""
    (encoder, sizes), kind = _encoder(path), _kind(path)
    chunks = _memories[path]
    plain = []
    for chunk in new:
        if chunk and chunk == chunk.strip():
            plain.append(chunk)
        else:
            chunks[chunk] = None
    if not plain:
        return
    ids = np.array(encoder.encode_ordinary(" " + " ".join(plain)), kind)
    ends = np.cumsum([len(chunk.encode("utf-8")) + 1 for chunk in plain])
    cuts = (np.searchsorted(np.cumsum(sizes[ids]), ends) + 1) * kind.itemsize
    body, start = ids.tobytes(), 0
    for chunk, end in zip(plain, cuts.tolist()):
        chunks[chunk] = body[start:end]
        start = end


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, part, before, n, ids): ids of each row, written once.

    ``part`` is the task that wrote the row and ``before`` the number of ids before it there. ``ids``
    holds little-endian numbers of two bytes, or of four for a vocabulary beyond 65,536.
    """
    spark = docs.sparkSession
    path = path or vocabulary_path()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("packing")
        width = _kind(path)
        end = np.array([END], width).tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for whole in batches:
            for begin in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(begin, TOGETHER)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                encoded = [ids + end for ids in encode_texts(texts, path)]
                sizes = np.array([len(x) // width.itemsize for x in encoded], np.int64)
                starts = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.full(len(texts), part, np.int32)),
                        pa.array(starts),
                        pa.array(sizes),
                        pa.array(encoded, pa.binary()),
                    ],
                    ["doc_id", "part", "before", "n", "ids"],
                )

    schema = f"doc_id {kind}, part int, before long, n long, ids binary"
    place = fresh_path(spark, "ids")
    docs.select("doc_id", "text").mapInArrow(run, schema).write.option(
        "compression", "zstd"
    ).parquet(place)
    return spark.read.schema(schema).parquet(place)


def pack_documents(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """Pieces of all rows of ``docs`` in windows of ``window`` ids, without padding between them.

    Rows keep the order in which they are stored. Defined results: NULL and empty texts are the end
    id alone; repeated rows and NULL ``doc_id`` are packed like others; an empty table gives no
    pieces; columns other than ``doc_id`` and ``text`` are not read. Only the very last sequence can
    be shorter than ``window``.
    """
    path = path or vocabulary_path()
    coded = encode_documents(docs, path)
    totals = coded.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total"))
    # One row for each task of the first pass.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = coded.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("at"), "ids"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("packing")
        width = _kind(path)
        for batch in batches:
            at = batch.column(1).to_pylist()
            rows, crcs, starts, lengths, totals = [], [], [], [], []
            for row, (place, ids) in enumerate(zip(at, batch.column(2).to_pylist())):
                ids = np.frombuffer(ids, width).astype("<u4")
                first = -place % window
                edges = [0, *range(first or window, len(ids), window), len(ids)]
                for start, end in zip(edges, edges[1:]):
                    rows.append(row)
                    starts.append(start)
                    lengths.append(end - start)
                    crcs.append(zlib.crc32(ids[start:end]))
                    totals.append(len(ids))
            begin = batch.column(1).to_numpy()[rows] + np.array(starts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(crcs, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(begin // window, pa.int64()),
                    pa.array(begin % window, pa.int64()),
                ],
                names,
            )

    names = [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    ]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{name} long" for name in names[1:])
    return placed.mapInArrow(cut, schema)
