"""Encoding with a vocabulary of scored pieces by streaming Viterbi, and decoding.

Among all ways to cut a text into pieces of the vocabulary the one with the highest sum of scores is
taken. The search reads the text once and keeps, for a window as long as the longest piece, the best
score and the last cut of every position. As soon as the best paths of all positions in the window go
through one cut, everything before it is final: its ids are handed out and its state is dropped. Equal
scores go to the path whose last piece is longer.

Space is the character U+2581 in pieces, and one stands before the text. No piece has it behind
another character, so every path has a cut before each run of spaces: stretches between such cuts do
not depend on each other, and one worker remembers the ids of stretches it has seen. A character
without a piece becomes the pieces of its UTF-8 bytes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.functions import arrow_udf

SPACE = "▁"
#: How much worse than the worst piece a character without a piece is.
UNKNOWN_PENALTY = 10.0
#: Stretches whose ids one worker remembers; it starts anew when there are more.
REMEMBERED = 500_000

_NONE = float("-inf")
_NO_PIECE = ({}, -1, 0.0)

_STRETCH = re.compile(f"[ {SPACE}]*[^ {SPACE}]*")


def model_path() -> str:
    """Place of the public piece model on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A vocabulary: pieces with ids and scores, byte pieces, and texts of ids."""

    def __init__(self, scores: dict[str, tuple[int, float]], byte_ids: list[int], size: int):
        self.longest = max(map(len, scores), default=1)
        self.unknown = min((s for _, s in scores.values()), default=0.0) - UNKNOWN_PENALTY
        self.byte_ids = byte_ids
        # By character: what can follow, and the id (or -1) and score of the piece that ends here.
        self.tree: dict[str, tuple[dict, int, float]] = {}
        for piece, (number, score) in scores.items():
            children = self.tree
            for letter in piece[:-1]:
                children = children.setdefault(letter, ({}, -1, 0.0))[0]
            children[piece[-1]] = (children.get(piece[-1], ({},))[0], number, score)
        self.scores = scores
        self.bytes = [b""] * size
        for piece, (number, _) in scores.items():
            self.bytes[number] = piece.replace(SPACE, " ").encode("utf-8")
        for value, number in enumerate(byte_ids):
            self.bytes[number] = bytes([value])
        self.independent = not any(SPACE in p.lstrip(SPACE) for p in scores)
        self.remembered: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, byte_ids = {}, [0] * 256
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                byte_ids[int(piece[3:5], 16)] = number
            elif not (model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
                scores[piece] = (number, model.get_score(number))
        return cls(scores, byte_ids, model.get_piece_size())

    def stream(self, characters: Iterator[str]) -> Iterator[list[int]]:
        """Lists of ids as they become final, for a text that comes in parts of any length."""
        text, start, score, back, ids = "", 0, [0.0], [0], [-1]
        check = 2 * self.longest
        # Position i of the open text: best score, cut before it, id of the piece between.
        for part in characters:
            text += part
            while start + self.longest <= len(text):
                stop = min(max(check, start + 1), len(text) - self.longest + 1)
                self._advance(text, start, stop, score, back, ids)
                start = stop
                if start >= check:
                    cut = self._common_cut(start, score, back)
                    # Where paths do not meet, as in a long alternation, look again later and later.
                    check = 2 * self.longest if cut else 2 * start
                    if cut:
                        yield self._path(text, cut, back, ids)
                        base = score[cut]
                        text, start = text[cut:], start - cut
                        score = [s - base for s in score[cut:]]
                        back = [max(0, b - cut) for b in back[cut:]]
                        ids = ids[cut:]
        self._advance(text, start, len(text), score, back, ids)
        if text:
            yield self._path(text, len(text), back, ids)

    def _advance(self, text: str, start: int, stop: int, score: list, back: list, ids: list) -> None:
        """Lengthen the best paths to each position from ``start`` by the pieces that begin there."""
        unknown, length = self.unknown, len(text)
        missing = min(length, stop - 1 + self.longest) + 1 - len(score)
        score += [_NONE] * missing
        back += [0] * missing
        ids += [-1] * missing
        for at in range(start, stop):
            own = score[at]
            children = self.tree
            for end in range(at, length):
                node = children.get(text[end])
                if node is None:
                    break
                children, number, gain = node
                if number >= 0 and own + gain > score[end + 1]:
                    score[end + 1], back[end + 1], ids[end + 1] = own + gain, at, number
            if own + unknown > score[at + 1] and self.tree.get(text[at], _NO_PIECE)[1] < 0:
                score[at + 1], back[at + 1], ids[at + 1] = own + unknown, at, -1

    @staticmethod
    def _common_cut(start: int, score: list[float], back: list[int]) -> int:
        """The last cut that the paths to all open positions share; 0 if there is none."""
        open_cuts = {i for i in range(start, len(score)) if score[i] > _NONE}
        while len(open_cuts) > 1:
            last = max(open_cuts)
            open_cuts.discard(last)
            open_cuts.add(back[last])
        return open_cuts.pop()

    def _path(self, text: str, end: int, back: list[int], ids: list[int]) -> list[int]:
        found: list[int] = []
        while end > 0:
            begin = back[end]
            if ids[end] >= 0:
                found.append(ids[end])
            else:
                body = text[begin:end].encode("utf-8", "surrogatepass")
                found += [self.byte_ids[b] for b in reversed(body)]
            end = begin
        return found[::-1]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return np.empty(0, np.int32)
        if not self.independent:
            parts = list(self.stream(iter([SPACE + text.replace(" ", SPACE)])))
            return np.array([i for part in parts for i in part], np.int32)
        if len(self.remembered) > REMEMBERED:
            self.remembered.clear()
        if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            stretches = text.split(" ")
        else:
            # A stretch stands behind one space that is not written.
            stretches = [s[1:] for s in _STRETCH.findall(" " + text) if s]
        try:
            return np.frombuffer(b"".join(map(self.remembered.__getitem__, stretches)), "<i4")
        except KeyError:
            for stretch in set(stretches).difference(self.remembered):
                parts = self.stream(iter([SPACE + stretch.replace(" ", SPACE)]))
                own = [i for part in parts for i in part]
                self.remembered[stretch] = np.array(own, "<i4").tobytes()
        return np.frombuffer(b"".join(map(self.remembered.__getitem__, stretches)), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; broken UTF-8 is replaced."""
        body = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return body.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _load(path: str) -> Pieces:
    return Pieces.load(path)


def encode_column(text: str, path: str | None = None):
    """Array of ids for a text column; NULL and empty texts have none."""
    path = path or model_path()

    @arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        pieces = _load(path)
        found = [pieces.encode(t or "") for t in texts.to_pylist()]
        offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
        values = np.concatenate(found) if found else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))

    return run(text)


def decode_column(ids: str, path: str | None = None):
    """Text for a column of ids; NULL and empty lists are the empty text."""
    path = path or model_path()

    @arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        pieces = _load(path)
        return pa.array([pieces.decode(np.array(i or [], np.int32)) for i in column.to_pylist()])

    return run(ids)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_ids, ids, ids_crc32, decoded_crc32, round_trip) for each row.

    The checksums cover the ids as little-endian 32-bit numbers and the UTF-8 of the decoded text;
    ``round_trip`` says whether decoding gives the text again. Defined results: NULL text is empty and
    has no ids; a text with U+2581 decodes to one with spaces in its place; repeated rows and NULL
    ``doc_id`` give one result each; an empty table gives no rows; other columns are not read.
    """
    path = path or model_path()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _load(path)
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                batch = whole.slice(begin, 500)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                ids = [pieces.encode(t) for t in texts]
                decoded = [pieces.decode(i) for i in ids]
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.diff(offsets).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))),
                        pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                        pa.array([zlib.crc32(d.encode("utf-8")) for d in decoded], pa.int64()),
                        pa.array([d == t for d, t in zip(decoded, texts)]),
                    ],
                    ["doc_id", "n_ids", "ids", "ids_crc32", "decoded_crc32", "round_trip"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_ids long, ids array<int>, ids_crc32 long, decoded_crc32 long, "
        "round_trip boolean",
    )
