"""Burrows-Wheeler transforms of shards of strings, and their merge by interleave refinement.

A shard is a list of byte strings. Every string ends with a terminator of its own, and terminators
sort below all bytes, in the order of the strings. The transform of a shard lists, for its suffixes
in sorted order, the symbols before each of them; with these, one suffix leads to the next longer one.

The merge compares no suffixes. It starts from all entries of the first shard, then those of the
second, and so on; this order is right for prefixes of length 0. From the order by prefixes of length
h, a stable sort by the preceding symbols gives the order by prefixes of length h + step, and entries
of a shard always keep their order. Where two neighbours begin to differ, their common prefix ends, so
entries fall into blocks of equal prefixes. What stands before an entry that is alone in its block is
alone, too: such entries are final and take no part in further rounds. Blocks that are left at the
wanted depth are the repeated intervals.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Transform:
    """Per suffix in sorted order: the two symbols before it as numbers of 9 bits each (byte + 1, or 0
    before the start), the entries of the suffixes that begin there (or -1), string and offset."""

    before: np.ndarray
    entries: np.ndarray
    string: np.ndarray
    offset: np.ndarray


def transform(strings: list[bytes]) -> Transform:
    """Suffixes of a shard sorted by prefix doubling."""
    sizes = np.array([len(s) + 1 for s in strings], np.int64)
    ends = np.cumsum(sizes) - 1
    total, count = int(sizes.sum()), len(strings)
    text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + count
    text[ends] = np.arange(count)
    bits = int(count + 256).bit_length()
    reach = max(1, 62 // bits)
    rank = text
    packed = np.zeros(total, np.int64)
    for ahead in range(reach):
        packed = (packed << bits) | np.append(text[ahead:], np.zeros(min(ahead, total), np.int64))
    rank = np.unique(packed, return_inverse=True)[1]
    while int(rank.max()) < total - 1:
        # Behind the last terminator nothing decides any more: terminators are all different.
        after = np.append(rank[reach:] + 1, np.zeros(min(reach, total), np.int64))
        rank = np.unique(rank * (total + 1) + after, return_inverse=True)[1]
        reach *= 2
    order = np.empty(total, np.int64)
    order[rank] = np.arange(total)
    string = np.repeat(np.arange(count), sizes)
    offset = (np.arange(total) - np.repeat(ends - sizes + 1, sizes))[order]
    symbols = np.maximum(text - count + 1, 0)
    # Symbols and entries one and two places before each suffix.
    back = np.stack([(order - 1) % total, (order - 2) % total])
    outside = np.stack([offset < 1, offset < 2])
    return Transform(
        np.where(outside, 0, symbols[back]), np.where(outside, -1, rank[back]), string[order], offset
    )


def merge(shards: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(entries, blocks) of the repeated intervals: entries count through all shards, come in merged
    order, and have equal blocks if they share the first ``depth`` symbols.

    Rounds take two symbols at a time, and one symbol once if ``depth`` is odd.
    """
    firsts = np.cumsum([0, *(len(t.string) for t in shards)])
    before = np.concatenate([t.before for t in shards], axis=1)
    entries = np.concatenate(
        [np.where(t.entries < 0, -1, t.entries + f) for t, f in zip(shards, firsts)], axis=1
    ).astype(np.int32)
    # Two symbols as one number of 16 bits, unless all byte values occur.
    present = np.zeros(258, bool)
    present[before[0]] = present[0] = True
    rank = np.cumsum(present) - 1
    kind = np.uint16 if present.sum() ** 2 <= 1 << 16 else np.uint32
    one = rank[before[0]].astype(kind)
    two = (rank[before[1]] * int(present.sum()) + rank[before[0]]).astype(kind)
    merged = np.arange(before.shape[1], dtype=np.int32)
    block = np.zeros(len(merged), np.int32)
    for step in [1] * (depth % 2) + [2] * (depth // 2):
        led = entries[step - 1][merged]
        there = led >= 0
        key = (one if step == 1 else two)[merged[there]]
        order = np.argsort(key, kind="stable")
        key, block, merged = key[order], block[there][order], led[there][order]
        same = (key[1:] == key[:-1]) & (block[1:] == block[:-1])
        block = np.cumsum(np.append(True, ~same), dtype=np.int32)[: len(merged)]
        shared = np.append(same, False) | np.append(False, same)
        merged, block = merged[shared[: len(merged)]], block[shared[: len(merged)]]
        if not len(merged):
            break
    return merged, block


def repeated_windows(strings: list[bytes], shards: int, depth: int):
    """(interval, string, offset) of every window of ``depth`` bytes that occurs more than once."""
    parts = [list(range(i, len(strings), shards)) for i in range(min(shards, len(strings)))]
    made = [transform([strings[i] for i in part]) for part in parts]
    merged, interval = merge(made, depth)
    string = np.concatenate([np.array(p)[t.string] for p, t in zip(parts, made)])[merged]
    offset = np.concatenate([t.offset for t in made])[merged]
    return interval, string, offset
