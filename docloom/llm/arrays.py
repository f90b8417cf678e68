"""Texts of an Arrow column as numpy arrays of word hashes.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z folded to
a-z.  All work is done on the column's own buffer, in windows of bounded
size, so that a text of any length needs memory in proportion to its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 18
BATCH_BYTES = 2 << 20

_RANDOM = np.random.default_rng(20_240_601)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64
_STEP = np.uint64(0xD1342543DE82EF95)


class Words(NamedTuple):
    """Word hashes of some texts; those of text ``i`` are at
    ``offsets[i]:offsets[i + 1]``, their bytes at ``start:end``; the text's
    own bytes are at ``bounds[i]:bounds[i + 1]``."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    offsets: np.ndarray
    bounds: np.ndarray


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others, one to one."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and where each text begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes; a longer text is alone."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


class _Kept(dict):
    """A cache that stays behind when a function that uses it is shipped."""

    def __reduce__(self):
        return dict, ()


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = _Kept()


def power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(WINDOW, 1 << max(0, length - 1).bit_length())
    if size not in _TABLES:
        _TABLES[size] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _TABLES[size]


def _cut(space: np.ndarray, offsets: np.ndarray, begin: int) -> int:
    """Where a window from ``begin`` ends: at most WINDOW bytes on, behind a
    space or at the end of a text; later only inside a longer word."""
    end = begin + WINDOW
    if end >= len(space):
        return len(space)
    border = int(offsets[np.searchsorted(offsets, end, "right") - 1])
    spaces = np.flatnonzero(space[max(begin, end - 4096) : end])
    if not len(spaces):
        spaces = np.flatnonzero(space[begin:end])
        behind = begin + int(spaces[-1]) + 1 if len(spaces) else begin
    else:
        behind = max(begin, end - 4096) + int(spaces[-1]) + 1
    if max(border, behind) > begin:
        return max(border, behind)
    later = np.flatnonzero(space[end:])
    word_end = end + int(later[0]) if len(later) else len(space)
    return min(word_end, int(offsets[np.searchsorted(offsets, end, "right")]))


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of texts given as ``utf8`` returns them."""
    space = _SPACE[data]
    first = np.empty(len(data), dtype=bool)
    first[:1] = True
    first[1:] = space[:-1]
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    first &= ~space
    last = np.empty(len(data), dtype=bool)
    last[-1:] = True
    last[:-1] = space[1:]
    inner = offsets[1:-1]
    last[inner[inner > 0] - 1] = True
    last &= ~space
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(start), dtype=np.uint64)
    begin = done = 0
    while begin < len(data):
        stop = _cut(space, offsets, begin)
        until = int(np.searchsorted(start, stop))
        power, inverse = power_tables(stop - begin)
        total = np.zeros(stop - begin + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[begin:stop]] * power[: stop - begin], out=total[1:])
        s, e = start[done:until] - begin, end[done:until] - begin
        hashes[done:until] = (total[e] - total[s]) * inverse[s]
        begin, done = stop, until
    return Words(mix(hashes), start, end, np.searchsorted(start, offsets), offsets)


def sequence_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, of which there is one at least."""
    count = len(hashes) - size + 1
    rolled = hashes[:count] + np.uint64(size)
    for step in range(1, size):
        rolled = rolled * _STEP + hashes[step : count + step]
    return mix(rolled)


def shingle_sets(found: Words, size: int) -> Iterator[np.ndarray]:
    """For every text the sorted, distinct hashes of its runs of ``size``
    words; of fewer words the whole sequence as one; of none, nothing."""
    rolled = sequence_hashes(found.hash, size) if len(found.hash) >= size else None
    for begin, end in zip(found.offsets[:-1].tolist(), found.offsets[1:].tolist(), strict=True):
        if end - begin >= size:
            yield np.unique(rolled[begin : end - size + 1])
        elif end > begin:
            yield sequence_hashes(found.hash[begin:end], end - begin)
        else:
            yield np.zeros(0, np.uint64)


def batch_words(
    batch: pa.RecordBatch, column: str = "text", limit: int = BATCH_BYTES
) -> Iterator[tuple[int, int, np.ndarray, Words]]:
    """``(first row, last row, bytes, words)`` of pieces of a batch, of about
    ``limit`` bytes."""
    data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
    for first, last in slices(offsets, limit):
        begin, end = offsets[first], offsets[last]
        piece = data[begin:end]
        yield first, last, piece, words(piece, offsets[first : last + 1] - begin)
