"""Words and hashes of many texts at once, as numpy arrays inside one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def blend(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all 64-bit values, one to one."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A name for a sequence from the names of its two parts; order matters."""
    return blend(blend(left + GOLDEN) + right)


@dataclass
class Texts:
    """Texts laid end to end, each followed by a newline, and the words in them."""

    buf: np.ndarray
    offset: np.ndarray  # of each text, and one past the last
    start: np.ndarray  # of each word
    length: np.ndarray
    first: np.ndarray  # number of each text's first word, and one past the last

    @property
    def of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(texts: Sequence[bytes], lower: bool = False) -> Texts:
    raw = b"\n".join([*texts, b""]) + bytes(8)
    buf = np.frombuffer(raw, np.uint8)
    if lower:
        buf = _LOWER[buf]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    offset = np.concatenate([[0], np.cumsum(lengths)])
    apart = np.concatenate([[True], _SEPARATORS[buf[: offset[-1]]], [True]])
    edge = np.flatnonzero(apart[1:] != apart[:-1])
    start, end = edge[0::2], edge[1::2]
    first = np.searchsorted(start, offset)
    return Texts(buf, offset, start, end - start, first)


def hash_spans(buf: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight at a time; ``buf`` has eight to spare."""
    # Eight bytes from any place on, as one little-endian number.
    eight = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    h = blend(length.astype(np.uint64) + np.uint64(int(GOLDEN) * (seed + 1) % 2**64))
    h = blend(h ^ (eight[start] & _KEEP[np.minimum(length, 8)]))
    rows, done = np.flatnonzero(length > 8), 8
    at, left = start[rows], length[rows]
    while len(rows):
        part = eight[at + done] & _KEEP[np.minimum(left - done, 8)]
        h[rows] = blend(h[rows] ^ part)
        done += 8
        more = left > done
        rows, at, left = rows[more], at[more], left[more]
    return h


def hash_words(texts: Texts, seed: int = 0) -> np.ndarray:
    return hash_spans(texts.buf, texts.start, texts.length, seed)


def batches(sizes: Sequence[int], most: int) -> Iterator[slice]:
    """Consecutive items of at most ``most`` in size together; a larger item comes alone."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values. Sorting is many times faster here than ``np.unique``, which hashes."""
    ordered = np.sort(values)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return ordered[new]


def dense(values: np.ndarray, space: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values below ``space``, ascending, and the place of each value among them."""
    if space > 1 << 24:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(space, bool)
    seen[values] = True
    distinct = np.flatnonzero(seen)
    place = np.zeros(space, np.int32)
    place[distinct] = np.arange(len(distinct), dtype=np.int32)
    return distinct, place[values]
