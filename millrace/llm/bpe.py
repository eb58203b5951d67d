"""Byte-level BPE by forced boundaries: cut where no token can reach across, encode the parts alone.

A merge only ever makes tokens of the vocabulary. So two neighbouring bytes that stand side by side
inside no token are never merged, whatever is around them: the place between them is a certain cut, and
both sides can be encoded on their own. A table of 256 x 256 pairs, taken from the vocabulary once, gives
the cuts of a whole text in one look-up for each byte.

The vocabulary's pattern splits a text before any merge, and it looks ahead. A cut of the raw text must
therefore also be one that the pattern cannot notice (see ``_unnoticed``); inside the stretches that the
pattern makes, every forced boundary is used. What is left are short fragments that come again and again,
so each worker encodes a fragment once and remembers its ids within a bound of bytes.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of fragments and ids that a worker remembers; it starts anew beyond that.
REMEMBERED = 64 << 20
#: What a remembered fragment costs beside its own bytes.
_OVERHEAD = 160
#: Fragments up to this length are remembered.
_SHORT = 64
#: Bytes from which on merges are looked up in a heap, and the rank of a pair that never merges.
_LONG = 256
_NEVER = 1 << 60
_NONE = np.int32(0x7FFFFFFF)
#: Lengths up to which pieces are merged side by side.
_WIDTHS = (2, 8, 12, 16, 24, 40, _SHORT)
#: Fragments that are looked up together, bytes that are cut at a time, and rows of one result batch.
_TOGETHER = 50_000
_BLOCK = 1 << 20
_ROWS = 256

# Unicode's white space, and the pattern that byte-level vocabularies split texts with.
_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
_PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^S\p{L}\p{N}]+|[S]+(?![^S])|[S]+".replace("S", _SPACE)
)
# Fragments that the pattern does not split.
_PLAIN = re.compile(rb" ?(?:[A-Za-z]+|[0-9]+|[!-&(-/:-@\[-`{-~]+)")


def vocabulary_path() -> str:
    """Place of the public byte-level vocabulary on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for.

    Printable Latin-1 signs stand for themselves, the other bytes, in order, for signs from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _unnoticed() -> np.ndarray:
    """Pairs of bytes between which a cut leaves the pattern's splits as they are.

    The left byte ends a character that is no white space, and the right one begins a character other
    than an apostrophe, which is either ASCII white space or no white space at all. Then no white space
    before the cut has to look past it, the match after the cut starts where one may start, and an
    apostrophe keeps what stands before it. Bytes that can belong to other white space do not qualify.
    """
    left, right = np.zeros(256, bool), np.zeros(256, bool)
    left[0x21:0x7F] = right[0x21:0x7F] = True
    left[0x80:0xC0] = True
    right[0xC2:0xF5] = True
    for character in _SPACE:
        own = character.encode("utf-8")
        left[own[-1]] = right[own[0]] = False
    right[[*range(0x09, 0x0E), 0x20]] = True
    right[ord("'")] = False
    return left[:, None] & right[None, :]


class Vocabulary:
    """Tokens, merges and forced boundaries of a byte-level BPE file, and an encoder of fragments."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]
        odd = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")]
        if model["type"] != "BPE" or any(odd) or model.get("ignore_merges") or spec.get("normalizer"):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        if split["type"] != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True):
            raise ValueError(f"{path} splits texts in another way")
        self.added = {}
        for token in spec["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"added token {token['content']} has conditions")
            self.added[token["content"]] = token["id"]
        byte_of = _byte_of_sign()
        ids = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()}
        size = 1 + max(*ids.values(), *self.added.values())
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        #: Bytes of each id.
        self.tokens = [b""] * size
        for token, i in ids.items():
            self.tokens[i] = token
        for content, i in self.added.items():
            self.tokens[i] = content.encode("utf-8")
        self.single = [ids[bytes([b])] for b in range(256)]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # Rank of each pair, as one number for both ids, and the id that each rank makes.
        self._width, self._ranks, self._made = size, {}, []
        for rank, pair in enumerate(merges):
            left, right = (bytes(byte_of[c] for c in part) for part in pair)
            self._ranks[ids[left] * size + ids[right]] = rank
            self._made.append(ids[left + right])
        #: Whether two bytes stand side by side inside no token.
        self.forced = np.ones((256, 256), bool)
        for token in ids:
            for a, b in zip(token, token[1:]):
                self.forced[a, b] = False
        self._cuts = (self.forced & _unnoticed()).ravel()
        # The same tables as arrays, for many pieces at once.
        self._single, self._made_array = np.array(self.single, np.int32), np.array(self._made, np.int32)
        self._pairs = np.array(sorted(self._ranks), np.int64)
        self._pair_ranks = np.array([self._ranks[p] for p in self._pairs.tolist()], np.int32)
        left, right = np.divmod(np.arange(1 << 16), 256)
        self._first_ranks = self._rank_of(self._single[left], self._single[right]).reshape(256, 256)
        self._named = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))))
        self._known: dict[bytes, bytes] = {}
        self._held = 0
        #: Fragments looked up and fragments encoded, for tests.
        self.counts = [0, 0]

    def cuts(self, body: bytes) -> np.ndarray:
        """Places in a raw text where it can be cut for certain, in ascending order."""
        found = []
        for begin in range(0, len(body), _BLOCK):
            block = np.frombuffer(body, np.uint8, min(_BLOCK + 1, len(body) - begin), begin)
            pairs = block[:-1].astype(np.uint16) << np.uint16(8) | block[1:]
            found.append(np.flatnonzero(self._cuts[pairs]) + (begin + 1))
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of bytes: always the pair of lowest rank is merged, the leftmost of equal ones first."""
        ids = [self.single[b] for b in piece]
        if len(ids) > _LONG:
            return self._merge_long(ids)
        width, rank_of, made = self._width, self._ranks.get, self._made
        ranks = [rank_of(a * width + b, _NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == _NEVER:
                break
            at = ranks.index(least)
            ids[at] = made[least]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank_of(ids[at - 1] * width + ids[at], _NEVER)
            if at < len(ranks):
                ranks[at] = rank_of(ids[at] * width + ids[at + 1], _NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs, for bytes too many to look through after each merge."""
        count, width = len(ids), self._width
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        heap = []

        def offer(at: int) -> None:
            rank = self._ranks.get(ids[at] * width + ids[after[at]])
            if rank is not None:
                heapq.heappush(heap, (rank, at, ids[at], ids[after[at]]))

        for at in range(count - 1):
            offer(at)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            # A pair of which a side has since been merged is out of date; -1 marks a side that is gone.
            if ids[at] != left or after[at] == count or ids[after[at]] != right:
                continue
            gone = after[at]
            ids[at], ids[gone] = self._made[rank], -1
            after[at] = after[gone]
            if after[at] < count:
                before[after[at]] = at
                offer(at)
            if before[at] >= 0:
                offer(before[at])
        return [i for i in ids if i >= 0]

    def _merge_short(self, pieces: list[bytes]) -> list[bytes]:
        """Ids, as bytes, of many short pieces at once: each step merges one pair in every row."""
        found: list[bytes] = [b""] * len(pieces)
        lengths = np.array([len(x) for x in pieces])
        low = 0
        for high in _WIDTHS:
            rows = np.flatnonzero((lengths > low) & (lengths <= high))
            low = high
            if not len(rows):
                continue
            padded = b"".join([pieces[i].ljust(high, b"\0") for i in rows.tolist()])
            signs = np.frombuffer(padded, np.uint8).reshape(-1, high)
            left = lengths[rows]
            ids = self._single[signs]
            ranks = self._first_ranks[signs[:, :-1], signs[:, 1:]]
            places = np.arange(high)
            ranks[places[1:] >= left[:, None]] = _NONE
            while True:
                at = ranks.argmin(axis=1)
                line = np.arange(len(at))
                least = ranks[line, at]
                done = least == _NONE
                if done.any():
                    for row, own, n in zip(rows[done].tolist(), ids[done].astype(self.kind), left[done].tolist()):
                        found[row] = own[:n].tobytes()
                    keep = ~done
                    rows, ids, ranks, left, at, least = (x[keep] for x in (rows, ids, ranks, left, at, least))
                    line = np.arange(len(at))
                if not len(rows):
                    break
                # What follows the pair moves up by one place.
                moved = np.minimum(places + (places > at[:, None]), high - 1)
                ids = np.take_along_axis(ids, moved, axis=1)
                ids[line, at] = self._made_array[least]
                left = left - 1
                moved = places[:-1] + (places[:-1] >= at[:, None])
                ranks = np.take_along_axis(ranks, np.minimum(moved, high - 2), axis=1)
                ranks[moved == high - 1] = _NONE
                before = np.flatnonzero(at > 0)
                ranks[before, at[before] - 1] = self._rank_of(ids[before, at[before] - 1], ids[before, at[before]])
                after = np.flatnonzero(at + 1 < left)
                ranks[after, at[after]] = self._rank_of(ids[after, at[after]], ids[after, at[after] + 1])
                last = np.flatnonzero((at + 1 >= left) & (at < high - 1))
                ranks[last, at[last]] = _NONE
        return found

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left.astype(np.int64) * self._width + right
        at = np.minimum(np.searchsorted(self._pairs, pairs), len(self._pairs) - 1)
        return np.where(self._pairs[at] == pairs, self._pair_ranks[at], _NONE)

    def _stretches(self, fragment: bytes) -> list[bytes]:
        """What the pattern makes of a fragment, cut further at every forced boundary if it is long."""
        # A word with a space before it is one stretch, as nearly all fragments are.
        if _PLAIN.fullmatch(fragment):
            stretches = [fragment]
        else:
            stretches = [x.encode("utf-8") for x in _PATTERN.findall(fragment.decode("utf-8"))]
        if len(fragment) <= _SHORT:
            return stretches
        found = []
        for body in stretches:
            signs = np.frombuffer(body, np.uint8)
            cuts = np.flatnonzero(self.forced[signs[:-1], signs[1:]]) + 1
            edges = [0, *cuts.tolist(), len(body)]
            found += [body[a:b] for a, b in zip(edges, edges[1:])]
        return found

    def encode_fragments(self, fragments: list[bytes]) -> list[bytes]:
        """Ids, as bytes, of each fragment."""
        parts = [self._stretches(f) for f in fragments]
        short = list({x for own in parts for x in own if len(x) <= _SHORT})
        ids = dict(zip(short, self._merge_short(short)))
        for own in parts:
            for x in own:
                if x not in ids:
                    ids[x] = np.array(self.merge(x), self.kind).tobytes()
        return [ids[own[0]] if len(own) == 1 else b"".join([ids[x] for x in own]) for own in parts]

    def _parts(self, text: str) -> Iterator[list[bytes] | bytes]:
        """Fragments of a text, some at a time, and in between the ids of added tokens, as bytes."""
        at = 0
        for match in self._named.finditer(text) if self.added else ():
            yield from self._fragments(text[at : match.start()])
            yield np.array([self.added[match[0]]], self.kind).tobytes()
            at = match.end()
        yield from self._fragments(text[at:] if at else text)

    def _fragments(self, text: str) -> Iterator[list[bytes]]:
        body = text.encode("utf-8")
        if body:
            edges = [0, *self.cuts(body).tolist(), len(body)]
            for begin in range(0, len(edges) - 1, _TOGETHER):
                own = edges[begin : begin + _TOGETHER + 1]
                yield [body[a:b] for a, b in zip(own, own[1:])]

    def encode_all(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of whole texts. Names of added tokens become their ids, the rest is encoded around them."""
        found: list[list[bytes]] = []
        waiting: list[tuple[list[bytes], int, list[bytes]]] = []
        size = 0
        for text in texts:
            found.append([])
            for part in self._parts(text):
                if isinstance(part, bytes):
                    found[-1].append(part)
                    continue
                # A place is kept for the ids of the part.
                waiting.append((found[-1], len(found[-1]), part))
                found[-1].append(b"")
                size += len(part)
                if size >= _TOGETHER:
                    self._look_up(waiting)
                    waiting, size = [], 0
        self._look_up(waiting)
        return [np.frombuffer(b"".join(own), self.kind) for own in found]

    def _look_up(self, waiting: list[tuple[list[bytes], int, list[bytes]]]) -> None:
        """Put the ids of all waiting fragments in their places; those not known are encoded together."""
        known = self._known
        new = list(set().union(*(part for _, _, part in waiting)).difference(known))
        self.counts[0] += sum(len(part) for _, _, part in waiting)
        self.counts[1] += len(new)
        known.update(zip(new, self.encode_fragments(new)))
        for own, place, part in waiting:
            own[place] = b"".join(map(known.__getitem__, part))
        for fragment in new:
            if len(fragment) > _SHORT:
                del known[fragment]
            else:
                self._held += len(fragment) + len(known[fragment]) + _OVERHEAD
        if self._held > REMEMBERED:
            known.clear()
            self._held = 0

    def encode(self, text: str) -> np.ndarray:
        """Ids of one whole text."""
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str | None = None) -> Vocabulary:
    """The vocabulary of a file, read once by each worker."""
    return Vocabulary(path or vocabulary_path())


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) for each row of ``docs``; ``path`` is a place on every machine.

    Defined results: a NULL or empty text has no ids; repeated rows and NULL ``doc_id`` give a row each;
    an empty table gives no rows; other columns are not read. Texts are encoded whole.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, _ROWS):
                part = batch.slice(begin, _ROWS)
                yield _id_batch(part.column(0), own.encode_all(t or "" for t in part.column(1).to_pylist()))

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def _id_batch(keys: pa.Array, coded: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.cumsum([0, *map(len, coded)])
    values = pa.array(np.concatenate(coded).astype(np.int32))
    ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    return pa.RecordBatch.from_arrays([keys, ids], ["doc_id", "ids"])


def decoded(ids: str, path: str | None = None) -> Column:
    """The text of a column of ids."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        own = vocabulary(path)
        values, edges = column.values.to_numpy(), column.offsets.to_pylist()
        texts = (own.decode(values[a:b].tolist()) for a, b in zip(edges, edges[1:]))
        return pa.array([t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist())], pa.string())

    return run(ids)


def digest_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each text, encoded and decoded again."""
    coded = encode_documents(docs, path).withColumn("text", decoded("ids", path))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
