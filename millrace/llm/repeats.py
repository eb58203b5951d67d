"""Repeated passages: every byte covered by a string of ``SPAN`` bytes that also starts earlier.

A corpus-wide suffix order cannot be kept on one machine, and most of it is of no use: a string that
occurs once says nothing. So the suffixes are first narrowed down, exactly, and then ordered in shards:

1. Each window of ``SPAN`` bytes has an anchor, its leftmost ``GRAM``-byte string of smallest hash.
   Equal windows have equal anchors at equal places, so a window whose anchor occurs once in the
   corpus occurs once. Windows of one occurrence of an anchor lie side by side and form a segment.
2. Segments whose anchor occurs again are grouped by anchor. Equal segments are one string; all of its
   occurrences but the earliest are covered whole.
3. A window that two segments share lies at the same place around the anchor in both, so at least half
   of what it has beside the anchor lies on one side. Segments that share neither half with another
   of their group share no window and go.
4. The segments that are left are dealt out to shards, whose Burrows-Wheeler transforms are
   merged by interleave refinement (``bwt``). Intervals with common prefixes of ``SPAN`` bytes are the
   repeated windows; in each, all but the earliest are covered.

An anchor with more than ``HOT`` occurrences does not form one group: its windows are groups of their
own, told apart by a 128-bit digest, so that no task holds more than ``HOT`` different segments of a
group. Later documents with a text seen before are covered whole and take part in no group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import workers
from millrace.llm.bwt import repeated_windows
from millrace.sources.storage import fresh_path, shuffles_dropped, stage, stage_scope

SPAN = 100
GRAM = 24
#: Occurrences of an anchor up to which its segments are one group.
HOT = 16384
#: Bytes of different segments whose shards are merged at a time, and shards for one merge.
MERGE_BYTES = 1 << 18
SHARDS = 4
#: Digests that one task remembers to send equal segments on once; it starts anew beyond that.
REMEMBERED = 100_000
#: A text is cut into overlapping blocks of this size, to bound memory.
BLOCK = 1 << 22

_MULTIPLIER = 0x9E3779B97F4A7C15
_SEGMENT = "key long, d1 long, d2 long, doc_id long, at int, windows int, segment binary"


def anchors(text: bytes, span: int = SPAN, gram: int = GRAM):
    """(hash, first window, last window) of each anchor of a text, in order."""
    windows = len(text) - span + 1
    if windows <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    found = []
    for begin in range(0, windows, BLOCK):
        block = np.frombuffer(text[begin : begin + BLOCK + span - 1], np.uint8)
        hashes = _gram_hashes(block, gram)
        # Upper bits decide, then the place: the leftmost of equal ones.
        ranked = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(
            len(hashes), dtype=np.uint64
        )
        place = _sliding_min(ranked, span - gram + 1) & np.uint64((1 << 24) - 1)
        place = place.astype(np.int64)
        found.append((place + begin, hashes[place]))
    place, hashes = (np.concatenate(x) for x in zip(*found))
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], windows) - 1
    return hashes[first].view(np.int64), first, last


def _gram_hashes(block: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hashes of all strings of ``gram`` bytes, built up by binary steps."""
    with np.errstate(over="ignore"):
        power = block.astype(np.uint64) + np.uint64(1)  # of the length `size`
        total, done, size = None, 0, 1
        while True:
            if gram & size:
                factor = np.uint64(pow(_MULTIPLIER, size, 1 << 64))
                if total is None:
                    total, done = power, size
                else:
                    keep = len(block) - done - size + 1
                    total = total[:keep] * factor + power[done : done + keep]
                    done += size
            if size * 2 > gram:
                break
            factor = np.uint64(pow(_MULTIPLIER, size, 1 << 64))
            power = power[:-size] * factor + power[size:]
            size *= 2
        mixed = total ^ (total >> np.uint64(31))
        mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ (mixed >> np.uint64(29))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _anchor_rows(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("repeats")
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                ids = batch.column(0).slice(part, 500).to_numpy()
                texts = batch.column(1).slice(part, 500).to_pylist()
                hashes = [anchors(t.encode("utf-8"), span, gram)[0] for t in texts]
                sizes = [len(h) for h in hashes]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hashes)), pa.array(np.repeat(ids, sizes))],
                    ["key", "doc_id"],
                )

    return run


def _segment_rows(span: int, gram: int):
    """Segments of documents with repeated anchors, and ranges covered by equal ones in this task.

    Input rows come in the order of ``doc_id``, so the first of equal segments is the earliest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("repeats")
        seen: set[tuple[int, bytes]] = set()
        before = None
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text, keys, hot in zip(*(c.to_pylist() for c in batch.columns)):
                if doc_id == before:  # a repeated row
                    continue
                before, covered = doc_id, None
                for row in _segments(doc_id, text.encode("utf-8"), keys, hot, span, gram):
                    mark = (row[0], row[1], row[2])
                    if mark not in seen:
                        seen.add(mark)
                        size += len(row[6])
                        covered = None
                    elif covered is not None and row[4] == covered[4] + covered[5]:
                        # It follows a covered one without a gap: one longer range.
                        covered = rows.pop()
                        row = covered = (*covered[:5], covered[5] + row[5], None)
                    else:
                        row = covered = (*row[:6], None)
                    rows.append(row)
                if size > 1 << 22 or len(rows) > 10_000:
                    yield _batch(rows)
                    rows, size = [], 0
                if len(seen) > REMEMBERED:
                    seen.clear()
        yield _batch(rows)

    return run


def _segments(doc_id, text, keys, hot, span, gram):
    """(key, d1, d2, doc_id, at, windows, bytes) of segments of repeated anchors."""
    own, first, last = anchors(text, span, gram)
    digest = xxhash.xxh3_128_digest
    for at in np.flatnonzero(np.isin(own, np.array(keys, np.int64))).tolist():
        low, high = int(first[at]), int(last[at])
        segment = text[low : high + span]
        yield (int(own[at]), *_halves(digest(segment)), doc_id, low, high - low + 1, segment)
    if hot:
        for at in np.flatnonzero(np.isin(own, np.array(hot, np.int64))).tolist():
            for low in range(int(first[at]), int(last[at]) + 1):
                halves = _halves(digest(text[low : low + span]))
                yield (halves[0], *halves, doc_id, low, 1, b"")


def _halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(
        digest[8:], "big", signed=True
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 7
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]
    names = [x.split()[0] for x in _SEGMENT.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names
    )


def _merge_groups(span: int, gram: int):
    """Covered ranges (doc_id, low, high) of segments sorted by key, digest, doc_id and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.enter("repeats")
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            waiting.append(batch)
            size += batch.column(6).nbytes + 64 * batch.num_rows
            if size < MERGE_BYTES * 4:
                continue
            table = pa.Table.from_batches(waiting)
            keys = table.column(0).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield from _cover(table.slice(0, cut), span, gram)
                waiting = table.slice(cut).combine_chunks().to_batches()
                size = sum(b.column(6).nbytes + 64 * b.num_rows for b in waiting)
        if waiting:
            yield from _cover(pa.Table.from_batches(waiting), span, gram)

    return run


def _cover(table: pa.Table, span: int, gram: int) -> Iterator[pa.RecordBatch]:
    key, d1, d2, doc, at, windows = (table.column(i).to_numpy() for i in range(6))
    if not len(key):
        return
    fresh_key = np.append(True, key[1:] != key[:-1])
    fresh = fresh_key | np.append(True, (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]))
    later = ~fresh
    yield _ranges(doc[later], at[later], at[later] + windows[later] + span - 1)
    # Different segments of groups that have several of them.
    string_of = np.flatnonzero(fresh)
    group = np.cumsum(fresh_key)[string_of]
    string_of = string_of[np.bincount(group)[group] > 1]
    group = np.cumsum(fresh_key)[string_of]
    long_enough = windows[string_of] > 0
    string_of, group = string_of[long_enough], group[long_enough]
    segments = table.column(6).combine_chunks().take(pa.array(string_of)).to_pylist()
    likely = _sharing(segments, group, key[string_of], span, gram)
    string_of, group = string_of[likely], group[likely]
    segments = [segments[i] for i in likely.tolist()]
    begin = 0
    while begin < len(segments):
        end, size = begin, 0
        while end < len(segments) and (size < MERGE_BYTES or group[end] == group[end - 1]):
            size += len(segments[end])
            end += 1
        interval, string, offset = repeated_windows(segments[begin:end], SHARDS, span)
        row = string_of[begin:end][string]
        place = at[row] + offset
        order = np.lexsort((place, doc[row], interval))
        again = order[1:][interval[order[1:]] == interval[order[:-1]]]
        again = again[np.lexsort((place[again], doc[row[again]]))]
        yield _runs(doc[row[again]], place[again], span)
        begin = end


def _sharing(segments: list[bytes], group: np.ndarray, key: np.ndarray, span: int, gram: int) -> np.ndarray:
    """Numbers of the segments that may share a window with another of their group.

    A shared window has ``span - gram`` bytes beside the anchor, so both segments agree in the nearer
    half of them on its left, or in the rest on its right. Equal hashes of different halves only keep
    a segment that could have gone.
    """
    sizes = np.array([len(s) for s in segments], np.int64)
    ends = np.cumsum(sizes)
    joined = np.frombuffer(b"".join(segments), np.uint8)
    if len(joined) < gram:
        return np.empty(0, np.int64)
    # The anchor is the leftmost string with the hash of the group, one across two segments is none.
    own = np.repeat(key.view(np.uint64), sizes)[: len(joined) - gram + 1]
    at = np.flatnonzero(_gram_hashes(joined, gram) == own)
    owner = np.searchsorted(ends, at, side="right")
    inside = at + gram <= ends[owner]
    owner, first = np.unique(owner[inside], return_index=True)
    at = at[inside][first]
    left = (span - gram) // 2
    kept = []
    for begin, length in ((at - left, left + gram), (at, span - left)):
        whole = (begin >= (ends - sizes)[owner]) & (begin + length <= ends[owner])
        if not whole.any():
            continue
        halves = _gram_hashes(joined, length)[begin[whole]]
        with np.errstate(over="ignore"):
            halves = halves ^ (group[owner[whole]].astype(np.uint64) * np.uint64(_MULTIPLIER))
        _, kind, met = np.unique(halves, return_inverse=True, return_counts=True)
        kept.append(owner[whole][met[kind] > 1])
    return np.unique(np.concatenate(kept)) if kept else np.empty(0, np.int64)


def _runs(doc: np.ndarray, place: np.ndarray, span: int) -> pa.RecordBatch:
    """Ranges of neighbouring windows, which come sorted."""
    if not len(doc):
        return _ranges(doc, place, place)
    breaks = np.append(True, (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + 1))
    first = np.flatnonzero(breaks)
    last = np.append(first[1:], len(doc)) - 1
    return _ranges(doc[first], place[first], place[last] + span)


def _ranges(doc, low, high) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(low, pa.int32()), pa.array(high, pa.int32())],
        ["doc_id", "low", "high"],
    )


def covered_ranges(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT):
    """(doc_id, sha, copy, ranges) for each document in which a string of ``span`` bytes starts again.

    ``copy``: the whole text appeared earlier and is at least ``span`` bytes long. ``ranges`` may
    overlap. ``docs`` needs a non-NULL ``doc_id`` of type long and ``text``; ``sha`` names the text
    that was judged, should several stand under one ``doc_id``. Segments and what was shuffled for them
    leave the disk before this returns.
    """
    spark = docs.sparkSession
    sized = docs.select("doc_id", F.sha2("text", 256).alias("sha"), F.octet_length("text").alias("n"))
    own = sized.groupBy("doc_id").agg(F.min(F.struct("sha", "n")).alias("own"), F.count("*").alias("rows"))
    with shuffles_dropped(spark):
        judged = stage(own.select("doc_id", "own.*", "rows"), "texts")
    docs = _one_row_each(docs, judged)
    earliest = judged.groupBy("sha").agg(F.min("doc_id").alias("first"))
    copies = (
        judged.join(earliest, "sha").where((F.col("doc_id") > F.col("first")) & (F.col("n") >= span))
    ).select("doc_id", "sha")
    places = docs.select("doc_id", "text").mapInArrow(
        _anchor_rows(span, gram), "key long, doc_id long"
    )
    # Counted beside the places themselves: anchors are looked for once and shuffled once.
    counted = places.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    again = counted.where("n > 1").select("doc_id", "key", (F.col("n") > hot).alias("hot"))
    wanted = (
        again.groupBy("doc_id")
        .agg(
            F.collect_set(F.when(~F.col("hot"), F.col("key"))).alias("keys"),
            F.collect_set(F.when(F.col("hot"), F.col("key"))).alias("hot"),
        )
        .join(copies.select("doc_id"), "doc_id", "left_anti")
        .join(judged.select("doc_id", "sha"), "doc_id")
    )
    texts = docs.select("doc_id", "text", F.sha2("text", 256).alias("sha"))
    found = (
        texts.join(wanted, ["doc_id", "sha"])
        .sortWithinPartitions("doc_id")
        .select("doc_id", "text", "keys", "hot")
        .mapInArrow(_segment_rows(span, gram), _SEGMENT)
    )
    path = fresh_path(spark, "ranges")
    with stage_scope(spark), shuffles_dropped(spark):
        segments = stage(found, "segments")
        inner = segments.where("segment is null").select(
            "doc_id", F.col("at").alias("low"), (F.col("at") + F.col("windows") + span - 1).alias("high")
        )
        met = (
            segments.where("segment is not null")
            .repartition("key")
            .sortWithinPartitions("key", "d1", "d2", "doc_id", "at")
            .mapInArrow(_merge_groups(span, gram), "doc_id long, low int, high int")
        )
        joined = inner.union(met).groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
        joined.write.parquet(path)
    ranges = spark.read.schema(joined.schema).parquet(path)
    marked = copies.select("doc_id", F.lit(True).alias("copy"))
    return (
        judged.select("doc_id", "sha")
        .join(marked, "doc_id", "left")
        .join(ranges, "doc_id", "left")
        .where("copy or ranges is not null")
        .select("doc_id", "sha", F.coalesce("copy", F.lit(False)).alias("copy"), "ranges")
    )


def _one_row_each(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """``docs`` without repeated rows: only those of a repeated ``doc_id`` are shuffled for it.

    Two tasks with the same row would each take the other's text for an earlier one.
    """
    again = judged.where("rows > 1").select("doc_id", "sha")
    if again.isEmpty():
        return docs
    others = docs.join(again.select("doc_id"), "doc_id", "left_anti").select("doc_id", "text")
    sized = docs.withColumn("sha", F.sha2("text", 256)).join(again, ["doc_id", "sha"], "left_semi")
    return others.union(sized.dropDuplicates(["doc_id", "sha"]).select("doc_id", "text"))


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` and ``kept_sha256``.

    ``kept`` holds the bytes that stay; a cut may fall inside a character. Strings are judged on the
    input; "earlier" is a smaller ``doc_id``, or an earlier start in the same text. Defined results:
    NULL text is empty; equal rows get equal results and do not repeat each other; of different texts
    under one ``doc_id`` the one with the smallest SHA-256 is judged and the others stay whole, as do
    rows with NULL ``doc_id``; an empty table gives no rows; other columns are kept, and replaced if
    they have one of the five names.
    """
    names = ["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    filled = F.coalesce("text", F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), filled.alias("text"))
    found = covered_ranges(own.where("doc_id is not null"), span, gram, hot)
    found = found.select(F.col("doc_id").alias("__id"), F.col("sha").alias("__sha"), "copy", "ranges")
    keyed = docs.drop(*names).withColumns(
        {"__id": F.col("doc_id").cast("long"), "__sha": F.sha2(filled, 256)}
    )

    @F.arrow_udf("struct<n_removed: long, n_spans: long, kept: binary>")
    def cut(texts: pa.Array, copies: pa.Array, ranges: pa.Array) -> pa.Array:
        workers.enter("repeats")
        rows = []
        for text, copy, own_ranges in zip(texts.to_pylist(), copies.to_pylist(), ranges.to_pylist()):
            body = (text or "").encode("utf-8")
            rows.append((len(body), 1, b"") if copy else _cut(body, own_ranges or []))
        removed, spans, kept = zip(*rows) if rows else ([], [], [])
        return pa.StructArray.from_arrays(
            [pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            ["n_removed", "n_spans", "kept"],
        )

    joined = keyed.join(found, ["__id", "__sha"], "left")
    done = joined.withColumn("__cut", cut("text", "copy", "ranges"))
    return done.select(
        *docs.drop(*names).columns,
        F.octet_length(filled).cast("long").alias("n_bytes"),
        F.col("__cut.n_removed").alias("n_removed"),
        F.col("__cut.n_spans").alias("n_spans"),
        F.col("__cut.kept").alias("kept"),
        F.sha2(F.col("__cut.kept"), 256).alias("kept_sha256"),
    )


def text_of(kept: str) -> Column:
    """Kept bytes as text, without those of characters that were cut through."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        texts = [(b or b"").decode("utf-8", "ignore") for b in column.to_pylist()]
        return pa.array(texts, pa.string())

    return run(kept)


def _cut(body: bytes, ranges: list[dict]) -> tuple[int, int, bytes]:
    kept, at, spans, removed, edge = [], 0, 0, 0, -1
    for low, high in sorted((r["low"], r["high"]) for r in ranges):
        if low > edge:
            spans += 1
        edge = max(edge, high)
        if high > at:
            low = max(low, at)
            kept.append(body[at:low])
            removed += high - low
            at = high
    kept.append(body[at:])
    return removed, spans, b"".join(kept)
