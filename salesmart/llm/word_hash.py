"""Words of many texts at once, as hashes, straight from Arrow buffers.

A chunk of texts is one byte array; a table says which byte separates words and what the others become. The
hash of a word is a polynomial of its bytes, read off running sums, so no text becomes a Python string.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
UNBASE = pow(BASE, -1, 1 << 64)
CHUNK_BYTES = 2 << 20

#: Fixed value: the bytes that separate words.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def byte_table(separators: bytes) -> np.ndarray:
    """What each byte becomes: 0 for separators, the byte itself, with A to Z lowered, for others.

    The zero byte, where it is no separator, becomes one that UTF-8 has no use for.
    """
    table = np.arange(256, dtype=np.uint8)
    table[0] = 0xFF
    table[65:91] += 32
    table[list(separators)] = 0
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Well spread 64 bits from any (splitmix64's finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as far as they were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", BASE), ("down", UNBASE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


@dataclass
class Words:
    """Words of a chunk: each one's hash, and where each text's words begin (one more than texts).

    ``data`` holds the chunk's bytes after the table, ``starts`` and ``ends`` the words' places in it.
    """

    hashes: np.ndarray
    first: np.ndarray
    data: np.ndarray | None = None
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    low = 0
    while low < len(starts):  # a long text in parts, which end with a word
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + CHUNK_BYTES, "right")))
        own = data[starts[low]:ends[high - 1]]
        begin, end = starts[low:high] - starts[low], ends[low:high] - starts[low]
        up, down = _POWERS.upto(len(own) + 1)
        total = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(own * up[:len(own)], dtype=np.uint64, out=total[1:])
        out[low:high] = (total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        low = high
    return mix(out)


def chunks(texts: pa.Array, table: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, their words); nulls have none. A chunk is one text or at most ``chunk_bytes``."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    if texts.null_count:  # a null may have bytes below it
        texts = texts.fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + chunk_bytes, "right")) - 1)
        bounds = offsets[low:high + 1] - offsets[low]
        own = table[data[offsets[low]:offsets[high]]]
        inside = own != 0
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        # Texts touch each other in the array: a word ends with its text.
        at = bounds[1:-1][bounds[1:-1] < len(own)]
        begin[at] |= inside[at]
        at = at[at > 0]
        end[at - 1] |= inside[at - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        yield low, high, Words(_hashes(own, starts, ends), np.searchsorted(starts, bounds), own, starts, ends)
        low = high


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each run of ``n`` words within a text; a gram's place is its first word's."""
    total = len(words.hashes) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    joined = words.hashes[:total].copy()
    for k in range(1, n):
        joined = joined * np.uint64(BASE) + words.hashes[k:k + total]
    joined = mix(joined)
    return joined, np.where(text[:total] == text[n - 1:], text[:total], -1)
