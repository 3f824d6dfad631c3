"""Numpy views of Arrow text columns: bytes, words and word hashes, without Python loops per word.

All functions work on UTF-8 bytes. Lower-casing touches A-Z only. Words are
hashed by tabulation (a random 64-bit number per position and byte, added up),
in blocks cut between words, so memory does not grow with a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_POSITIONS = 64
_TABLE = np.random.Generator(np.random.PCG64(20240611)).integers(
    0, 2**64, _POSITIONS * 256, dtype=np.uint64
)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty. ``offsets`` has one more entry than rows."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def blocks(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> Iterator[tuple[int, int]]:
    """Byte ranges of about BLOCK bytes that cut no word.

    A cut falls on a document border, or on a separator inside a long document.
    A single word longer than BLOCK stays whole.
    """
    at, n = 0, len(data)
    while at < n:
        end = min(at + BLOCK, n)
        if end < n:
            border = offsets[np.searchsorted(offsets, end, "right") - 1]
            if border > at:
                end = int(border)
            else:
                gaps = np.flatnonzero(separator[data[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:
                    stop = int(offsets[np.searchsorted(offsets, end, "left")])
                    gaps = np.flatnonzero(separator[data[end:stop]])
                    end = end + int(gaps[0]) + 1 if len(gaps) else stop
        yield at, end
        at = end


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE):
    """(starts, ends) of the words in ``data``; document borders in ``offsets`` end words too."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separator[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets[(offsets >= 0) & (offsets <= len(data))]] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, ~inside[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, ~inside[1:]
    starts = np.flatnonzero(inside & (before | border[:-1]))
    ends = np.flatnonzero(inside & (after | border[1:])) + 1
    return starts, ends


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (all non-empty, in order, not overlapping)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    value = _TABLE[((within & (_POSITIONS - 1)) << 8) | data[np.repeat(starts, lengths) + within]]
    if int(lengths.max()) > _POSITIONS:
        value = value * ((within // _POSITIONS).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    return mix(np.add.reduceat(value, first))


def hashed_words(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per block: (row of each word, hash of each lower-cased word), in text order."""
    data, offsets = text_bytes(column)
    for at, end in blocks(data, offsets):
        part = LOWER[data[at:end]]
        starts, ends = word_spans(part, offsets - at)
        if len(starts):
            yield np.searchsorted(offsets, starts + at, "right") - 1, hash_spans(part, starts, ends)
