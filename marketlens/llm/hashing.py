"""64-bit hashes of words and word windows of many texts at once, in numpy.

Texts come as one Arrow column. Everything is computed on slices of about ``SLICE`` bytes,
so memory follows the slice (or the longest single text), not the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 18
#: Counters of parity bits that are held together.
COUNTERS = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WINDOW = np.uint64(0xD6E8FEB86659FD93)
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection that spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = 1 << max(10, (n - 1).bit_length())
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends."""
    column = column.cast(pa.large_string()).fill_null("")
    size = len(column)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64, size + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE`` bytes together."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def tokens(
    raw: np.ndarray, offsets: np.ndarray, gap_table: np.ndarray, lower: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every run of bytes outside ``gap_table``, where those of each text begin, and the
    first byte and the byte behind each run."""
    n = len(raw)
    none = np.zeros(0, np.int64)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none
    gap = gap_table[raw]
    start = ~gap
    new = np.zeros(n + 1, bool)
    new[offsets] = True
    start[1:] &= gap[:-1] | new[1:n]
    starts = np.flatnonzero(start)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds, none, none
    lengths = np.diff(np.append(starts, n))
    place = np.arange(starts[0], n) - np.repeat(starts, lengths)
    value = (_LOWER[raw] if lower else raw)[starts[0] :].astype(np.uint64)
    value += np.uint64(1)
    value *= powers(int(lengths.max()))[place]
    inside = ~gap[starts[0] :]
    value[~inside] = 0
    at = starts - starts[0]
    ends = starts + np.add.reduceat(inside.astype(np.int64), at)
    return mix(np.add.reduceat(value, at)), bounds, starts, ends


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and where the words of each text begin."""
    return tokens(raw, offsets, _GAP, lower)[:2]


def windows(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` consecutive entries."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(seed), np.uint64)
    for k in range(size):
        total *= _WINDOW
        total += hashes[k : k + n]
    return mix(total)


def each_text(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """Index and word hashes of every text of a column."""
    raw, offsets = texts_of(column)
    for first, last in slices(offsets):
        at = offsets[first : last + 1]
        hashes, bounds = word_hashes(raw[at[0] : at[-1]], at - at[0], lower)
        for i in range(first, last):
            yield i, hashes[bounds[i - first] : bounds[i - first + 1]]


def parities(sets: list[np.ndarray], words: int) -> np.ndarray:
    """``words`` words of 64 bits for every set: bits that an odd number of its elements fall on. Two sets
    differ in as many elements at least as in bits."""
    size, some = 64 * words, max(1, COUNTERS // (64 * words))
    out = np.zeros((len(sets), words), np.int64)
    for first in range(0, len(sets), some):
        part = sets[first : first + some]
        owner = np.repeat(np.arange(len(part)) * size, [len(s) for s in part])
        at = owner + (np.concatenate([np.zeros(0, np.uint64), *part]) % np.uint64(size)).astype(np.int64)
        odd = (np.bincount(at, minlength=len(part) * size) & 1).astype(np.uint8)
        out[first : first + some] = np.packbits(odd.reshape(len(part), size), axis=1).view(np.int64)
    return out


Batches = Iterator[pa.RecordBatch]
#: What clears the tables that a module's tasks keep in their worker for the next ones, by the module's name.
tables_of: dict[str, Callable[[], None]] = {}


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, giving back what memory it has freed when a task ends: workers serve later stages too, and
    the pages of freed arrays would otherwise stay with them, as would the tables of other modules."""

    def task(batches: Batches) -> Batches:
        for name, clear in tables_of.items():
            if name != run.__module__:
                clear()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return task
