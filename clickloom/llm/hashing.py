"""Word hashes of whole Arrow text columns: numpy over the UTF-8 buffer, no Python string per word.

A word is a maximal run of bytes other than space and 0x09-0x0D. Its hash sums the mixed blocks of eight
bytes, each with a drawn value of its place, so no arrangement of equal blocks cancels out; windows mix
halves with halves. One pass over the buffer serves every word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Seeds of the two independent hash families.
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser, so that every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _drawn(seed: int, first: int, last: int) -> np.ndarray:
    """Pseudo-random 64-bit values number `first` to `last` of a seed."""
    return mix(mix(np.arange(first, last, dtype=U64) * U64(0xD1342543DE82EF95) + U64(seed)) + U64(seed))


def slices(column: pa.Array, max_bytes: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, UTF-8 bytes, row offsets) of consecutive rows.

    Each slice has at most `max_bytes` of text, or a single longer one; null texts are empty.
    """
    column = column.cast(pa.string()) if not pa.types.is_string(column.type) else column
    if column.null_count:
        column = pa.compute.fill_null(column, "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, n + 1, column.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + max_bytes, "right")) - 1)
        yield first, last, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def letter_gaps(raw: np.ndarray) -> np.ndarray:
    """Bytes between runs of ASCII letters and non-ASCII characters."""
    folded = raw | 32
    return (raw < 128) & ~((folded >= 97) & (folded <= 122))


def words(
    raw: np.ndarray, offsets: np.ndarray, gap: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of the first word of every row (and one past the end).

    `gap` marks the bytes between words, white space by default. Rows are kept apart even where one
    ends and the next begins without a gap.
    """
    if gap is None:
        gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    inside = ~gap
    begins = inside.copy()
    begins[1:] &= gap[:-1]
    stops = inside.copy()
    stops[:-1] &= gap[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: Words of more blocks are hashed one by one; the others so many at once.
_BLOCKS, _AT_ONCE = 8, 1 << 14


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """Hash of the bytes of every word."""
    if not len(starts):
        return np.zeros(0, U64)
    sizes, seed = ends - starts, SEEDS[family]
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    # The eight bytes from every place of the buffer on.
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))

    def blocks(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        return eight[at] & (~U64(0) >> ((8 - np.minimum(left, 8)) * 8).astype(U64))

    total, places = np.zeros(len(starts), U64), _drawn(seed, 0, _BLOCKS)
    for part in range(0, len(starts), _AT_ONCE):
        here = slice(part, part + _AT_ONCE)
        at, left, sums = starts[here], sizes[here], total[here]
        sums += mix(blocks(at, left) + places[0])
        for k in range(1, _BLOCKS):
            rows = np.flatnonzero(left > 8 * k)
            if not len(rows):
                break
            sums[rows] += mix(blocks(at[rows] + 8 * k, left[rows] - 8 * k) + places[k])
    for row in np.flatnonzero(sizes > 8 * _BLOCKS):
        later = np.arange(8 * _BLOCKS, sizes[row], 8)
        drawn = _drawn(seed, _BLOCKS, _BLOCKS + len(later))
        total[row : row + 1] += mix(blocks(starts[row] + later, sizes[row] - later) + drawn).sum(dtype=U64)
    return mix(total + sizes.astype(U64))


def window_hashes(hashes: np.ndarray, firsts: np.ndarray, size: int, family: int = 0) -> np.ndarray:
    """Hash of `size` consecutive word hashes from each position in `firsts`, put together from runs of 1, 2, 4, ... words."""
    first, second = (U64(x | 1) for x in _drawn(SEEDS[family], 1 << 41, (1 << 41) + 2).tolist())
    run, length, found, done = hashes, 1, None, 0
    while True:
        if size & length:
            part = run[firsts + done]
            found = part if found is None else mix(found * first + part * second)
            done += length
        if done == size:
            return mix(found + U64(size))
        run = mix(run[:-length] * first + run[length:] * second)
        length *= 2


def window_firsts(row_words: np.ndarray, size: int) -> np.ndarray:
    """Positions of the words that begin a window of `size` words within their own row."""
    counts = np.diff(row_words)
    windows = np.maximum(counts - size + 1, 0)
    rows = np.repeat(np.arange(len(counts)), windows)
    within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    return row_words[rows] + within
