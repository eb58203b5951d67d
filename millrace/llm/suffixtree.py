"""Language-model scores from a probabilistic suffix tree over tokens, beside a unigram base.

A text is lower-cased (A-Z) and cut into words; an end follows. Words and the end are the symbols. A
context is a string of up to ``DEPTH`` symbols, or of the start and the symbols behind it. Each that
occurs is considered. It is retained if its next-symbol counts diverge from its parent's distribution
by more than their description costs: n * KL > T / 2 * ln N, for n tokens with T different symbols after
the context, of N in all. The parent is the longest retained proper suffix; distributions are smoothed
towards it with weight T / (n + T), and the root is the base. A symbol is scored in the state of the
longest retained suffix of what precedes it. The events are those of the base: the words seen in
training, and one for all others.

No task and not the driver holds this tree: all contexts of a token end with the token before it, by
which tokens are dealt out in chunks, and counts are made by sorting a bucket of them.

On request a small tree is grown instead, for a driver that keeps it. The ``frequent`` most frequent
words and the end are its symbols, and all other words are one symbol. A context is considered if it
makes up at least ``P_MIN`` of all tokens, which the level before has counted, so the tree has at most
DEPTH / P_MIN contexts. Within the symbol of other words, a word that occurred c times has the
probability (c - d) / C of all C such tokens, with the discount d = n1 / (n1 + 2 * n2) from the numbers
of words seen once and twice. What the discounts free is the probability of a word never seen.

Counts of the ``HEAD`` most frequent words go to all tasks. Other words, which are each rare, meet
their counts in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.storage import fresh_path, shuffles_dropped, stage, stage_scope

DEPTH = 3
P_MIN = 1e-4
#: Words that are symbols: all numbers of ten bits but those of start, other words and end.
FREQUENT = (1 << 10) - 3
#: Words whose counts are broadcast, and words that one task counts before it hands them on.
HEAD = 100_000
COUNTED = 400_000
#: Tokens whose contexts are sorted together.
TOGETHER = 1 << 20
#: Parts of the whole tree that are worked on one after the other.
PARTS = 4
#: Texts that are cut into words together.
TEXTS = 2000
#: Tokens that one call works on, on average, and texts whose sums are added up together.
BUCKET = 1 << 18
GROUP = 1 << 12
#: A context of one token with more than one of so many tokens is dealt out over tasks.
HOT = 500

_MULTIPLIER = 0x9E3779B97F4A7C15
_BITS = 10
_SYMBOL = (1 << _BITS) - 1
_OTHER, _END = 1, 2
_SYMBOLS = _SYMBOL  # that can come next; 0 is the start
#: The end among words: no word is empty.
END = b""


def words_of(text: str | None) -> list[bytes]:
    """Words of the whole text, A-Z lower-cased."""
    return (text or "").encode("utf-8").lower().split()


def codes_of(texts: list[list[bytes]], symbols: dict[bytes, int], depth: int) -> np.ndarray:
    """For each token of the texts, in order: the ``depth`` symbols before it and its own symbol."""
    tokens = [t for words in texts for t in (*repeat(None, depth), *words, END)]
    joined = np.fromiter(map(symbols.get, tokens, repeat(_OTHER)), np.int64, len(tokens))
    codes = joined.copy()
    for ago in range(1, depth + 1):
        codes[ago:] += joined[:-ago] << (_BITS * ago)
    return codes[joined > 0]


@dataclass
class SuffixTree:
    """By depth: retained contexts with the log weight of their parent, and log probabilities of seen
    next symbols under ``context << 9 | symbol``; all sorted, natural logarithms."""

    contexts: list[np.ndarray] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)
    values: list[np.ndarray] = field(default_factory=list)

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of each code's last symbol after the symbols before it."""
        result = np.zeros(len(codes))
        open_rows = np.arange(len(codes))
        for depth in range(len(self.contexts) - 1, -1, -1):
            context = (codes[open_rows] >> _BITS) & ((1 << (_BITS * depth)) - 1)
            at, known = _find(self.contexts[depth], context)
            rows = open_rows[known]
            key = (context[known] << _BITS) | (codes[rows] & _SYMBOL)
            place, seen = _find(self.keys[depth], key)
            result[rows[seen]] += self.values[depth][place[seen]]
            result[rows[~seen]] += self.weights[depth][at[known][~seen]]
            closed = np.zeros(len(open_rows), bool)
            closed[np.flatnonzero(known)[seen]] = True
            open_rows = open_rows[~closed]
        return result


def _find(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return at, sorted_values[at] == wanted


def grow_tree(levels: list[tuple[np.ndarray, np.ndarray]]) -> SuffixTree:
    """Tree from (context << bits | symbol, count) of each depth; depth 0 has all symbols."""
    symbols, own = levels[0]
    total = int(own.sum())
    counts = np.zeros(_SYMBOLS, np.int64)
    counts[symbols - 1] = own
    root = np.log((counts + 0.5) / (total + 0.5 * _SYMBOLS))
    tree = SuffixTree(
        [np.zeros(1, np.int64)], [np.zeros(1)], [np.arange(1, _SYMBOLS + 1)], [root]
    )
    for key, own in levels[1:]:
        order = np.argsort(key)
        key, own = key[order], own[order].astype(float)
        contexts, first, kinds = np.unique(key >> _BITS, return_index=True, return_counts=True)
        parent = np.exp(tree.log_probabilities(key))
        sizes = np.add.reduceat(own, first) if len(first) else np.empty(0)
        share = own / np.repeat(sizes, kinds)
        gain = np.add.reduceat(own * np.log(share / parent), first) if len(first) else sizes
        retained = gain > kinds / 2 * np.log(max(total, 2))
        smooth = (own + np.repeat(kinds, kinds) * parent) / np.repeat(sizes + kinds, kinds)
        kept = np.repeat(retained, kinds)
        tree.contexts.append(contexts[retained])
        tree.weights.append(np.log(kinds / (sizes + kinds))[retained])
        tree.keys.append(key[kept])
        tree.values.append(np.log(smooth[kept]))
    return tree


def _gram_rows(symbols, depth: int, contexts: np.ndarray):
    """Counts of (context << bits | symbol), for contexts of ``depth`` symbols among ``contexts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                waiting.append(words_of(text))
                size += len(waiting[-1]) + 1
                if size > TOGETHER:
                    yield count(waiting)
                    waiting, size = [], 0
        if waiting:
            yield count(waiting)

    def count(texts: list[list[bytes]]) -> pa.RecordBatch:
        codes = codes_of(texts, symbols.value, depth)
        codes, n = np.unique(codes[_find(contexts, codes >> _BITS)[1]], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["code", "n"])

    return run


def fit_tree(
    texts: DataFrame, counts: dict[bytes, int], total: int, depth: int = DEPTH, p_min: float = P_MIN
) -> tuple[SuffixTree, dict[bytes | None, int]]:
    """Tree over all rows of ``texts`` (one column), and the numbers of its symbols.

    ``counts`` holds the words that are symbols, and the end; ``total`` is the number of all tokens.
    Each level reads the texts once. The driver gets counts for at most 1 / p_min contexts a level,
    with at most 2 ** 10 symbols each.
    """
    words = sorted((w for w in counts if w != END), key=lambda w: (-counts[w], w))
    symbols: dict[bytes | None, int] = {None: 0, END: _END}
    symbols |= {w: i for i, w in enumerate(words, _END + 1)}
    known = np.array([counts[w] for w in [END, *words]], np.int64)
    codes = np.arange(_END, _END + len(known), dtype=np.int64)
    codes = np.append(codes, _OTHER)
    levels = [(codes, np.append(known, total - int(known.sum())))]
    shared = texts.sparkSession.sparkContext.broadcast(symbols)
    for level in range(1, depth + 1):
        # Strings of the level before, read as contexts: those that are frequent enough.
        codes, n = levels[-1]
        contexts = np.sort(codes[n >= max(1, p_min * total)])
        if level == 1:
            contexts = np.append(0, contexts)  # the start of a text
        grams = texts.mapInArrow(_gram_rows(shared, level, contexts), "code long, n long")
        table = grams.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
        levels.append(tuple(table.column(c).to_numpy().astype(np.int64) for c in ("code", "n")))
    return grow_tree(levels), symbols


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts, as ``words_of`` has them, and the number of words of each text."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, offsets = cut.flatten(), cut.offsets.to_numpy()
    some = pc.greater(pc.binary_length(words), 0)
    before = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))[offsets - offsets[0]]
    return words.filter(some).cast(pa.binary()), np.diff(before)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and, as the empty word, of ends."""
    seen = _counts([], [])
    for batch in batches:
        for begin in range(0, batch.num_rows, TEXTS):
            words, sizes = _cut(batch.column(0).slice(begin, TEXTS))
            each = words.value_counts()
            seen = pa.concat_tables([seen, _counts(each.field(0), each.field(1)), _counts([END], [len(sizes)])])
            if seen.num_rows > 2 * COUNTED:
                seen = _added_up(seen)
                if seen.num_rows > COUNTED:
                    yield from seen.to_batches()
                    seen = seen.slice(0, 0)
    yield from _added_up(seen).to_batches()


def _counts(words, n) -> pa.Table:
    return pa.table([pa.array(words, pa.binary()), pa.array(n, pa.int64())], names=["word", "n"])


def _added_up(counts: pa.Table) -> pa.Table:
    sums = counts.group_by("word", use_threads=False).aggregate([("n", "sum")])
    return sums.select(["word", "n_sum"]).rename_columns(["word", "n"])


@dataclass
class OtherWords:
    """Probabilities of words within the symbol of other words, from their counts."""

    tokens: int
    kinds: int
    discount: float

    def unseen(self) -> float:
        return (self.discount * self.kinds + 0.5) / (self.tokens + 0.5)

    def log_probability(self, n: Column) -> Column:
        """Natural logarithm for a word with count ``n``, NULL if it was never seen."""
        seen = F.log((n - F.lit(self.discount)) / F.lit(self.tokens + 0.5))
        return F.when(n.isNull(), F.lit(float(np.log(self.unseen())))).otherwise(seen)

    def log_probabilities(self, n: np.ndarray) -> np.ndarray:
        """The same for counts that are not 0."""
        return np.log((n - self.discount) / (self.tokens + 0.5))


def _score_rows(tree, symbols, head, others: OtherWords, depth: int, id_type: str):
    """Each row with the sums over its frequent words, and a list of its rare words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = head.value
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                batch = whole.slice(begin, 500)
                texts = [words_of(t) for t in batch.column(2).to_pylist()]
                sizes = np.array([len(w) + 1 for w in texts], np.int64)
                starts = np.cumsum(sizes) - sizes
                codes = codes_of(texts, symbols.value, depth)
                each, place = np.unique(codes, return_inverse=True)
                joint = tree.value.log_probabilities(each)[place]
                tokens = [t for words in texts for t in (*words, END)]
                n = np.fromiter(map(counts.get, tokens, repeat(-1)), np.int64, len(tokens))
                rare = n < 0
                inner = ((codes & _SYMBOL) == _OTHER) & ~rare
                joint[inner] += others.log_probabilities(n[inner])
                at = np.flatnonzero(rare)
                words = pa.array([tokens[i] for i in at.tolist()], pa.binary())
                offsets = np.searchsorted(at, np.append(starts, len(tokens))).astype(np.int32)
                sums = [(n > 0).astype(np.int64), np.log10(np.where(rare, 0.5, n + 0.5)), joint]
                sums[1][rare] = 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(sizes),
                        *[pa.array(np.add.reduceat(x, starts)) for x in sums],
                        pa.ListArray.from_arrays(pa.array(offsets), words),
                    ],
                    ["doc_id", "held_out", "n_tokens", "known", "base", "joint", "rare"],
                )

    fields = f"doc_id {id_type}, held_out boolean, n_tokens long, known long, base double"
    return run, f"{fields}, joint double, rare array<binary>"


_CODEC = "zstd"


def _planes(columns: list[np.ndarray]) -> tuple[int, list[np.ndarray]]:
    """The bytes of all columns by their place in a number, without those that are all zero; which they are."""
    mask, planes = 0, []
    for at, x in enumerate(columns):
        used = int(np.bitwise_or.reduce(x)) & ((1 << 64) - 1)
        split = x.view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            if (used >> (8 * byte)) & 0xFF:
                mask |= 1 << (8 * at + byte)
                planes.append(np.ascontiguousarray(split[:, byte]))
    return mask, planes


def _packed(columns: list[np.ndarray], first: np.ndarray) -> list[bytes]:
    """Chunks that begin at the places ``first``: length, planes and first row, and the compressed planes.

    The first column, the row, is held as the steps from one token to the next.
    """
    rows = columns[0][first]
    steps = np.diff(columns[0], prepend=0)
    steps[first] = 0
    mask, planes = _planes([steps, *columns[1:]])
    chunks = []
    for i, j, row in zip(first.tolist(), [*first[1:].tolist(), len(steps)], rows.tolist()):
        head = np.array([j - i, mask, row], np.int64).tobytes()
        chunks.append(head + pa.compress(b"".join([x[i:j] for x in planes]), codec=_CODEC, asbytes=True))
    return chunks


def _unpacked(chunks: list[bytes], columns: int) -> list[np.ndarray]:
    """Columns of all chunks, one behind the other."""
    heads = np.array([np.frombuffer(x, np.int64, 3) for x in chunks], np.int64).reshape(-1, 3)
    ends = np.cumsum(heads[:, 0])
    first = ends - heads[:, 0]
    whole = np.zeros((columns, int(heads[:, 0].sum()), 8), np.uint8)
    for chunk, i, j, mask in zip(chunks, first.tolist(), ends.tolist(), heads[:, 1].tolist()):
        places = [x for x in range(8 * columns) if (mask >> x) & 1]
        size = j - i
        planes = pa.decompress(memoryview(chunk)[24:], len(places) * size, codec=_CODEC)
        for at, plane in zip(places, np.frombuffer(planes, np.uint8).reshape(len(places), size)):
            whole[at // 8, i:j, at % 8] = plane
    result = [x.view(np.int64).ravel() for x in whole]
    steps = np.cumsum(result[0])
    result[0] = steps + np.repeat(heads[:, 2] - steps[first], heads[:, 0])
    return result


def _ended(of_words: np.ndarray, ends: np.ndarray, of_end) -> np.ndarray:
    """Values of words, with that of the end before each of the places ``ends``."""
    result = np.empty(len(of_words) + len(ends), of_words.dtype)
    last = np.zeros(len(result), bool)
    last[ends - 1] = True
    result[last], result[~last] = of_end, of_words
    return result


def _coded_rows(words_by_code, head, norm: float, id_type: str):
    """Each row with the codes of its tokens: numbers from 1 for the head, whose first is the end, and hashes.

    Beside them the sums of the base over the tokens of the head.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = pa.array(words_by_code.value, pa.binary()), head.value
        logs = np.log10((counts + 0.5) / norm)
        end = [1, int(counts[1] > 0), logs[1]]
        digest = xxhash.xxh64_intdigest
        for whole in batches:
            for begin in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(begin, TEXTS)
                words, sizes = _cut(batch.column(2))
                code = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy().astype(np.int64) + 1
                of_code = [(counts > 0).astype(np.int64)[code], logs[code]]
                rare = np.flatnonzero(code == 0)
                for x in of_code:
                    x[rare] = 0
                others = words.take(pa.array(rare)).dictionary_encode()
                hashes = [digest(x, 42) for x in others.dictionary.to_pylist()]
                code[rare] = np.array(hashes, np.uint64).view(np.int64)[others.indices.to_numpy()]
                sizes = sizes + 1
                ends = np.cumsum(sizes)
                own, *sums = [_ended(x, ends, of_end) for x, of_end in zip([code, *of_code], end)]
                words = [x.tobytes() for x in np.split(own, ends[:-1])]
                sums = [pa.array(np.add.reduceat(x, ends - sizes)) for x in sums]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(sizes), *sums, pa.array(words, pa.binary())],
                    ["doc_id", "held_out", "n", "known", "base", "words"],
                )

    return run, f"doc_id {id_type}, held_out boolean, n long, known long, base double, words binary"


#: Tokens go in chunks. Their columns: twice the row, plus one in training; the count of the token if it is
#: outside the head, else 0; the token, and the three before it (0 before the start); for those after a
#: frequent token also the count of both.
_CHUNK = "bucket long, chunk binary"
_COLUMNS = 6


def _spread(values: np.ndarray, into: int) -> np.ndarray:
    """Numbers below ``into``, from other bits than ``_flows`` uses."""
    with np.errstate(over="ignore"):
        mixed = (values.view(np.uint64) ^ (values.view(np.uint64) >> np.uint64(31))) * np.uint64(_MULTIPLIER)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) % np.uint64(into)).astype(np.int64)


def _pair(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (one.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + two.view(np.uint64)).view(np.int64)


def _dealt(bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """A chunk for each bucket."""
    if len(bucket) and bucket.max() < 1 << 16:
        bucket = bucket.astype(np.uint16)  # sorted by digits
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    each = bucket[first].astype(np.int64)
    chunks = _packed([x[order] for x in columns], first)
    return pa.RecordBatch.from_arrays([pa.array(each, pa.int64()), pa.array(chunks, pa.binary())], ["bucket", "chunk"])


def _chunk_rows(outside: int, common: np.ndarray, flow: int | None, parts: int, buckets: int):
    """Chunks of the tokens of the head in one flow, or those of all other tokens, dealt out by themselves.

    A flow has the tokens of one part by the token before, after one of ``common`` or after others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for row, train, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
                waiting.append((2 * row + train, words))
                size += len(words) // 8
                if size > TOGETHER:
                    yield deal(waiting)
                    waiting, size = [], 0
        if waiting:
            yield deal(waiting)

    def deal(texts: list[tuple[int, bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(x) // 8 for _, x in texts], np.int64)
        words = np.frombuffer(b"".join([x for _, x in texts]), np.int64)
        starts = np.cumsum(sizes) - sizes
        last = np.append(0, words[:-1])
        last[starts] = 0
        wanted = (words < 0) | (words >= outside)
        if flow is not None:
            wanted = ~wanted & (_flows(last, common, outside, parts) == flow)
        at = np.flatnonzero(wanted)
        text = np.searchsorted(starts, at, side="right") - 1
        place = at - starts[text]
        before = [np.where(place >= k, words[np.maximum(at - k, 0)], 0) for k in (1, 2, 3)]
        own = words[at]
        bucket = _spread(own, buckets) if flow is None else _buckets(last[at], own, flow % 2, buckets)
        row = np.array([r for r, _ in texts], np.int64)[text]
        return _dealt(bucket, [row, np.zeros(len(at), np.int64), own, *before])

    return run


def _flows(last: np.ndarray, common: np.ndarray, outside: int, parts: int) -> np.ndarray:
    """Twice the part by the token before, plus one after a common one."""
    many = np.zeros(outside + 1, bool)
    many[common] = True
    with np.errstate(over="ignore"):
        part = ((last.view(np.uint64) * np.uint64(_MULTIPLIER)) >> np.uint64(32)) % np.uint64(parts)
    return 2 * part.astype(np.int64) + many[np.where((last >= 0) & (last < outside), last, outside)]


def _buckets(last: np.ndarray, own: np.ndarray, often: np.ndarray | int, buckets: int) -> np.ndarray:
    """By the token before, with the token itself after a common one."""
    return _spread(np.where(np.asarray(often) > 0, _pair(last, own), last), buckets)


def _gathered(table: pa.Table, columns: int = _COLUMNS) -> list[np.ndarray]:
    return _unpacked(table.column("chunk").to_pylist(), columns)


def _counted_rare(outside: int, common: np.ndarray, parts: int, buckets: int):
    """Tokens outside the head with their counts, by flow and bucket: all of a word are here.

    In the place of their hashes they get numbers from ``outside`` on.
    """

    def run(table: pa.Table) -> pa.Table:
        row, _, own, *before = _gathered(table)
        kind = np.unique(own, return_inverse=True)[1]
        count = np.bincount(kind, weights=row & 1).astype(np.int64)[kind]
        # Tokens are compared with tokens and those before with those before: a small number tells as much.
        own = outside + kind * buckets + table.column("bucket")[0].as_py()
        flow = _flows(before[0], common, outside, parts)
        bucket = _buckets(before[0], own, flow % 2, buckets)
        return pa.Table.from_batches([_dealt(flow * buckets + bucket, [row, count, own, *before])])

    return run


def _numbered(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Equal pairs of small numbers get equal numbers from 0, without gaps."""
    bits, place = int(low.max()).bit_length(), len(low).bit_length()
    if int(high.max()).bit_length() + bits + place > 63:
        return np.unique(np.stack([high, low]), axis=1, return_inverse=True)[1].ravel()
    packed = (high << (bits + place)) | (low << place) | np.arange(len(low))
    packed.sort()
    key = packed >> place
    number = np.empty(len(low), np.int64)
    number[packed & ((1 << place) - 1)] = np.cumsum(np.append(False, key[1:] != key[:-1]))
    return number


def _small(words: list[np.ndarray], outside: int) -> list[np.ndarray]:
    """Words outside the head get small numbers, too."""
    joined = np.concatenate(words)
    rare = np.flatnonzero((joined < 0) | (joined >= outside))
    joined[rare] = np.unique(joined[rare], return_inverse=True)[1] + outside
    return np.split(joined, len(words))


def _smoothed(c, p, n, kinds, s, total: int) -> np.ndarray:
    """Probability after a context: its parent's, if it is not retained.

    Over the tokens after the context: ``n`` is their number, ``kinds`` that of different ones and ``s`` the
    sum of c * ln(c / p), for the counts ``c`` of the different ones and their probabilities by the parent.
    """
    gain = s - n * np.log(np.maximum(n, 1))
    retained = (n > 0) & (gain > kinds / 2 * np.log(max(total, 2)))
    return np.where(retained, (c + kinds * p) / np.maximum(n + kinds, 1), p)


def _counts_after(context: np.ndarray, own: np.ndarray, train: np.ndarray, p: np.ndarray):
    """(number of each pair of context and token, their counts, contexts and probabilities; n, kinds, s)."""
    pair = _numbered(context, own)
    c = np.bincount(pair, weights=train)
    some = np.empty(len(c), np.int64)
    some[pair] = np.arange(len(pair))
    of, p = context[some], p[some]
    seen = np.flatnonzero(c > 0)
    size = int(context.max()) + 1
    each = c[seen]
    sums = [np.bincount(of[seen], weights=x, minlength=size) for x in (each, np.ones(len(seen)), each * np.log(each / p[seen]))]
    return pair, c, of, p, sums


def _deeper(words: list[np.ndarray], train: np.ndarray, p: np.ndarray, depths: range, total: int) -> np.ndarray:
    """``p`` after contexts of these depths; all tokens after one context are here."""
    none = np.zeros(len(p), np.int64)
    context = none
    for word in words[1 : depths.start]:
        context = _numbered(context, word)
    for depth in depths:
        context = _numbered(context, words[depth])
        pair, c, of, own, sums = _counts_after(context, words[0], train, p)
        p = _smoothed(c, own, *(x[of] for x in sums), total)[pair]
    return p


def _sums(row, c0, rare, p, norm: float, groups: int) -> pa.Table:
    """Sums of each text, in chunks by groups of texts: those of the base over tokens outside the head alone.

    Sums of logarithms are kept as the bits of doubles.
    """
    rows, text = np.unique(row >> 1, return_inverse=True)
    known = np.bincount(text, weights=rare & (c0 > 0)).astype(np.int64)
    logs = [np.where(rare, np.log10((c0 + 0.5) / norm), 0.0), np.log10(p)]
    logs = [np.bincount(text, weights=x).view(np.int64) for x in logs]
    return pa.Table.from_batches([_dealt(_spread(rows, groups), [rows, known, *logs])])


def _summed(table: pa.Table) -> pa.Table:
    """One row for each text of a group."""
    rows, known, *logs = _gathered(table, 4)
    rows, text = np.unique(rows, return_inverse=True)
    whole = [np.bincount(text, weights=known).astype(np.int64)]
    whole += [np.bincount(text, weights=x.view(np.float64)) for x in logs]
    return pa.table([rows, *whole], names=["row", *_SUMS])


_SUMS = ["n_known", "base_score", "score"]
_SUMMED = "row long, n_known long, base_score double, score double"


def _scored(head, norm: float, total: int, groups: int):
    """Sums of texts over the tokens of a bucket: all tokens after the same one are here."""

    def run(table: pa.Table) -> pa.Table:
        counts = head.value
        row, more, *words = _gathered(table)
        c0, words = _own_counts(counts, more, words)
        p = _deeper(words, row & 1, (c0 + 0.5) / norm, range(1, DEPTH + 1), total)
        return _sums(row, c0, words[0] >= len(counts), p, norm, groups)

    return run


def _own_counts(counts: np.ndarray, more: np.ndarray, words: list[np.ndarray]):
    outside = len(counts)
    c0 = np.where((words[0] >= 0) & (words[0] < outside), counts[np.clip(words[0], 0, outside - 1)], more)
    return c0, _small(words, outside)


def _counted_pairs(head, norm: float, buckets: int):
    """Tokens after frequent ones with the count of both, by the two before, and what the contexts add up to.

    All tokens with the same one before are here.
    """

    def run(table: pa.Table) -> pa.Table:
        counts = head.value
        row, more, *words = _gathered(table)
        c0, small = _own_counts(counts, more, words)
        context = small[1]
        pair, c, _, _, sums = _counts_after(context, small[0], row & 1, (c0 + 0.5) / norm)
        columns = [row, more, *words, c.astype(np.int64)[pair]]
        dealt = _dealt(_spread(_pair(words[1], words[2]), buckets), columns)
        each = np.unique(context)
        none = pa.nulls(len(each))
        of = [pa.array(x[each]) for x in sums]
        tables = [
            pa.Table.from_batches([dealt]),
            pa.table([none.cast(pa.int64()), none.cast(pa.binary()), pa.array(each), *of], names=["bucket", "chunk", "w1", "n", "t", "s"]),
        ]
        return pa.concat_tables(tables, promote_options="default")

    return run, f"{_CHUNK}, w1 long, n double, t double, s double"


def _scored_after_common(head, contexts, norm: float, total: int, groups: int):
    """The same as ``_scored`` for tokens after frequent ones: all after the same two are here."""

    def run(table: pa.Table) -> pa.Table:
        counts, sums = head.value, contexts.value
        row, more, *words, c = _gathered(table, _COLUMNS + 1)
        c0, words = _own_counts(counts, more, words)
        at = np.searchsorted(sums[0], words[1])
        p = _smoothed(c, (c0 + 0.5) / norm, *(x[at] for x in sums[1:]), total)
        p = _deeper(words, row & 1, p, range(2, DEPTH + 1), total)
        return _sums(row, c0, words[0] >= len(counts), p, norm, groups)

    return run


def _score_all_contexts(
    docs: DataFrame, held_out: str, most: list, ends: int, total: int, kinds: int, parts: int, hot: int
) -> DataFrame:
    """Scores by the tree of all words and all contexts of up to ``DEPTH`` tokens.

    The contexts of a token end with the token before it, so the tree falls into parts by that token,
    which are worked on one after the other to bound the disk; in a part, tokens are dealt out by the
    token before them, in buckets of about ``BUCKET`` tokens. A context of one token with more than one
    of ``hot`` tokens, or more than ``TOGETHER``, is dealt out by the next token, and then by the two
    before. Tokens outside the head are dealt out by themselves first, for their counts.
    """
    spark = docs.sparkSession
    broadcast = spark.sparkContext.broadcast
    words = [(END, ends), *[x for x in most if x[0] != END]]
    counts = np.array([0, *(n for _, n in words)], np.int64)
    norm = float(total + 0.5 * (kinds + 1))
    head, outside = broadcast(counts), len(counts)
    run, schema = _coded_rows(broadcast([w for w, _ in words]), head, norm, docs.schema["doc_id"].dataType.simpleString())
    own = docs.select("doc_id", F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"), "text")
    made = own.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    path = fresh_path(spark, "coded")
    made.write.option("compression", "zstd").parquet(path)
    coded = spark.read.schema(made.schema).parquet(path)
    rows, tokens = coded.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets, groups = 1 + tokens // (parts * BUCKET), 1 + rows // GROUP
    # Behind the start of a text stand as many tokens as there are ends.
    after = np.append(counts[1], counts[1:])
    common = np.flatnonzero((after * hot > total) | (after > TOGETHER))
    common = common[common != 1]
    texts = coded.select("row", (~F.col("held_out")).cast("int").alias("train"), "words")

    with shuffles_dropped(spark):
        others = texts.mapInArrow(_chunk_rows(outside, common, None, parts, buckets), _CHUNK)
        counted = others.groupBy("bucket").applyInArrow(_counted_rare(outside, common, parts, buckets), _CHUNK)
        rare = stage(counted, "rare")

    def tokens_of_part(part: int, often: bool) -> DataFrame:
        flow = 2 * part + often
        frequent = texts.mapInArrow(_chunk_rows(outside, common, flow, parts, buckets), _CHUNK)
        own = rare.where(F.col("bucket").between(flow * buckets, (flow + 1) * buckets - 1))
        return frequent.unionByName(own.withColumn("bucket", F.col("bucket") - flow * buckets)).groupBy("bucket")

    def added_up(scored: DataFrame) -> DataFrame:
        # Each file costs executors a process that sets its mode: few files, in proportion to the input.
        return scored.groupBy("bucket").applyInArrow(_summed, _SUMMED).coalesce(1 + rows // (8 * GROUP))

    sums = []
    for part in range(parts):
        with shuffles_dropped(spark):
            scored = tokens_of_part(part, False).applyInArrow(_scored(head, norm, total, groups), _CHUNK)
            sums.append(stage(added_up(scored), "part"))
            if not len(common):
                continue
            path = fresh_path(spark, "sums")
            with stage_scope(spark):
                counted = tokens_of_part(part, True).applyInArrow(*_counted_pairs(head, norm, buckets))
                pairs = stage(counted.coalesce(1 + tokens // (2 * parts * TOGETHER)), "pairs")
                of = pairs.where("chunk is null").groupBy("w1").agg(*[F.sum(x).alias(x) for x in "nts"]).orderBy("w1")
                contexts = broadcast([x.to_numpy() for x in of.toArrow().columns])
                run = _scored_after_common(head, contexts, norm, total, groups)
                scored = pairs.where("chunk is not null").groupBy("bucket").applyInArrow(run, _CHUNK)
                added_up(scored).write.parquet(path)
            sums.append(spark.read.schema(_SUMMED).parquet(path))
    whole = reduce(DataFrame.unionByName, sums).groupBy("row").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return coded.select("row", "doc_id", "held_out", "n", "known", "base").join(whole, "row").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("known") + F.col("n_known")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.col("base_score")).alias("base_score"),
        "score",
    )


def _most_frequent(counts: DataFrame, limit: int) -> list[tuple[bytes, int]]:
    """The first ``limit`` words by falling counts, then by the words.

    Every partition would send as many to the driver; the numbers of words by count tell the count of the
    last one first, so only words of that count can be too many.
    """
    by_count = sorted(counts.groupBy("n").count().toArrow().to_pylist(), key=lambda r: -r["n"])
    ahead, least = 0, 1
    for r in by_count:
        least = r["n"]
        if ahead + r["count"] >= limit:
            break
        ahead += r["count"]
    order = [F.desc("n"), F.col("word")]
    rows = counts.where(F.col("n") > least).collect() if ahead else []
    rows += counts.where(F.col("n") == least).orderBy(*order).limit(limit - ahead).collect()
    return sorted([(bytes(r["word"]), r["n"]) for r in rows], key=lambda x: (-x[1], x[0]))


def score_documents(
    docs: DataFrame,
    held_out: str = "held_out",
    head_words: int = HEAD,
    frequent: int | None = None,
    parts: int = PARTS,
    hot: int = HOT,
) -> DataFrame:
    """Base and model score of each row; rows where the boolean ``held_out`` is not true teach both.

    All words and all contexts take part. With ``frequent``, only so many words are symbols, and only
    contexts of at least ``P_MIN`` of all tokens are considered: a small tree that the driver holds.
    ``n_known`` counts tokens seen in training, ``train_tokens`` is their number in training.
    Defined results: NULL and empty texts are the end alone; repeated rows and NULL ``doc_id`` give
    one result each and teach each time; without a training row all counts are zero; an empty table
    gives no rows; other columns are not read.
    """
    if frequent is not None and not 0 <= frequent <= min(FREQUENT, head_words):
        raise ValueError(f"frequent must lie between 0 and {min(FREQUENT, head_words)}")
    spark = docs.sparkSession
    training = docs.where(~F.coalesce(F.col(held_out), F.lit(False))).select("text")
    words = training.mapInArrow(_word_rows, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    with shuffles_dropped(spark):
        counts = stage(words, "words")
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    norm = float(np.log10(total + 0.5 * (kinds + 1)))
    most = _most_frequent(counts, head_words)
    ends = counts.where(F.length("word") == 0).first()
    head = dict(most) | {END: ends["n"] if ends else 0}
    rarer = counts
    if most:
        word, n = most[-1]
        rarer = counts.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > F.lit(word))))
    if frequent is None:
        return _score_all_contexts(docs, held_out, most, head[END], total, kinds, parts, hot)
    own_symbols = dict([x for x in most if x[0] != END][:frequent]) | {END: head[END]}
    tree, symbols = fit_tree(training, own_symbols, total)
    once, twice = counts.agg(F.count(F.when(F.col("n") == 1, 1)), F.count(F.when(F.col("n") == 2, 1))).first()
    discount = once / (once + 2 * twice) if once else 0.0
    others = OtherWords(
        total - sum(own_symbols.values()), kinds - len([w for w in own_symbols if head[w]]), min(discount, 0.99)
    )
    context = spark.sparkContext
    run, schema = _score_rows(
        context.broadcast(tree), context.broadcast(symbols), context.broadcast(head), others, DEPTH,
        docs.schema["doc_id"].dataType.simpleString(),
    )
    own = docs.select("doc_id", F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"), "text")
    rows = stage(
        own.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scores"
    )
    looked_up = (
        rows.select("row", F.explode("rare").alias("word"))
        .join(rarer, "word", "left")
        .groupBy("row")
        .agg(
            F.count("n").alias("more_known"),
            F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("more_base"),
            F.sum(others.log_probability(F.col("n"))).alias("more_joint"),
        )
    )
    none = F.lit(0.0)
    return rows.drop("rare").join(looked_up, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", none) - F.col("n_tokens") * F.lit(norm)).alias(
            "base_score"
        ),
        ((F.col("joint") + F.coalesce("more_joint", none)) / F.lit(float(np.log(10)))).alias("score"),
    )
