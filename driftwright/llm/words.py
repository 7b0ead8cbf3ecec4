"""Hashes of the words of whole texts, taken from Arrow columns a piece at a time: no memo, no Python strings.

Words are runs of bytes other than ASCII white space, A-Z read as a-z. A word's hash is a polynomial in random values
of its bytes (differences of prefix sums, shifted to the word's begin by the inverse power), mixed to 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that are hashed at once; longer texts are taken in pieces that end at white space.
PIECE = 1 << 19
#: Bytes and rows of a slice of texts.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 512
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = (np.uint64(n) for n in (30, 27, 31))
_BASE = 0x9E3779B97F4A7C15
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def _letters() -> np.ndarray:
    values = np.random.RandomState(11).randint(1, 2**62, 256, dtype=np.int64).astype(np.uint64)
    values = mixed(values) | np.uint64(1)
    values[65:91] = values[97:123]
    return values


_VALUES = _letters()
_SOLID = np.ones(256, bool)
_SOLID[[32, *range(9, 14)]] = False
_MARK = np.zeros(256, bool)
_MARK[list(_PUNCTUATION)] = True
_powers: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64),) * 2


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, n of each."""
    global _powers
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            each = np.full(n, base, np.uint64)
            each[0] = 1
            made.append(np.multiply.accumulate(each))
        if n > 4 * PIECE:  # one giant word: not kept
            return made[0], made[1]
        _powers = (made[0], made[1])
    return _powers[0][:n], _powers[1][:n]


class Words(NamedTuple):
    """Word hashes of several texts end to end; words per text; byte offsets of begins and ends in ``data``."""

    ids: np.ndarray
    counts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offset of each text in them; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return whole, offsets - offsets[0]


def _pieces(data: np.ndarray, solid: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(data):
        stop = at + PIECE
        if stop < len(data):
            blank = np.flatnonzero(~solid[at:stop])
            if len(blank):
                stop = at + int(blank[-1]) + 1
            else:
                rest = np.flatnonzero(~solid[stop:])
                stop = stop + int(rest[0]) + 1 if len(rest) else len(data)
        stop = min(stop, len(data))
        yield at, stop
        at = stop


def hash_words(column: pa.Array, strip: bool = False) -> Words:
    """The words of every text. strip: ASCII punctuation at their ends is no part of the hash."""
    data, offsets = raw(column)
    solid = _SOLID[data]
    edge = np.zeros(len(data) + 1, bool)  # a text begins here
    edge[offsets] = True
    before = np.concatenate(([False], solid[:-1])) if len(data) else solid
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.concatenate((solid[1:], [False])) if len(data) else solid
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    lows, highs = starts, ends
    if strip and len(data):
        place = np.arange(len(data))
        plain = ~_MARK[data]
        following = np.minimum.accumulate(np.where(plain, place, len(data))[::-1])[::-1]
        lows = np.minimum(following[starts], ends)
        previous = np.maximum.accumulate(np.where(plain, place + 1, 0))
        highs = np.maximum(previous[ends - 1], lows)
    ids = np.empty(len(starts), np.uint64)
    for at, stop in _pieces(data, solid):
        first, last = np.searchsorted(starts, (at, stop))
        if first < last:
            up, down = powers(stop - at)
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUES[data[at:stop]] * up, dtype=np.uint64)))
            low, high = lows[first:last] - at, highs[first:last] - at
            ids[first:last] = (total[high] - total[low]) * down[np.minimum(low, stop - at - 1)]
    counts = np.diff(np.searchsorted(starts, offsets))
    return Words(mixed(ids), counts, starts, ends, data, offsets)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into slices of bounded rows and bytes; a longer text comes alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(total, total[at] + limit, side="right")) - 1
            stop = min(max(stop, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, stop - at)
            at = stop
