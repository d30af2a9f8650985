"""Words of Arrow text columns as 64-bit hashes, computed with numpy on the UTF-8 bytes.

A word is a run of bytes other than space and ``\\t \\n \\v \\f \\r``; these bytes never occur inside a
multi-byte character, so working on bytes equals working on characters. Two different words
share a hash with a probability of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20  # text handled at once; longer texts are cut at white space

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_MULTIPLIERS = np.array(
    [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64
)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PUNCTUATION = _SPACE.copy()  # besides white space, all ASCII characters but letters and digits
_PUNCTUATION[:128] |= [not chr(c).isalnum() for c in range(128)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of SplitMix64); a bijection."""
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLIERS[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLIERS[1]
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_BASE, -size, 1 << 64))])
        return self.up[:n], self.down[:n]


_powers = _Powers()


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets into them; a null text has no bytes."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), ends


def _pieces(data: np.ndarray, ends: np.ndarray, blank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of (row, start, end) triples of at most about PIECE_BYTES; only a word longer than that exceeds it."""
    group, size = [], 0
    for row in range(len(ends) - 1):
        start, stop = int(ends[row]), int(ends[row + 1])
        while start < stop:
            end = stop
            if stop - start > PIECE_BYTES:
                gaps = np.flatnonzero(blank[data[start : start + PIECE_BYTES]])
                if len(gaps):
                    end = start + int(gaps[-1]) + 1
                else:
                    later = np.flatnonzero(blank[data[start:stop]])
                    end = start + int(later[0]) + 1 if len(later) else stop
            if group and size + end - start > PIECE_BYTES:
                yield np.array(group)
                group, size = [], 0
            group.append((row, start, end))
            size += end - start
            start = end
    if group:
        yield np.array(group)


def word_hashes(
    column: pa.Array, lower: bool = False, punctuation: bool = False, blank: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (rows, hashes, spans) of consecutive words; rows ascend over all yields and may continue in the next one.

    Spans are the words' byte ranges in their texts. With ``punctuation``, ASCII punctuation separates words like white space;
    ``blank`` names the separating bytes (256 flags, none of them above 127) instead.
    """
    if blank is None:
        blank = _PUNCTUATION if punctuation else _SPACE
    data, ends = text_buffers(column)
    for group in _pieces(data, ends, blank):
        rows, starts, stops = group[:, 0], group[:, 1], group[:, 2]
        # a text's pieces and neighbouring texts lie side by side unless empty texts are between, which have no bytes
        low, high = int(starts[0]), int(stops[-1])
        part = data[low:high]
        if lower:
            part = _LOWER[part]
        inside = ~blank[part]
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        before[starts - low] = False
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        after[stops - low - 1] = False
        first, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        if not len(first):
            continue
        up, down = _powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        hashes = (total[last] - total[first]) * down[first] + (last - first).astype(np.uint64) * _MULTIPLIERS[2]
        row = rows[np.searchsorted(starts - low, first, "right") - 1]
        yield row, mix(hashes), np.stack([first, last], axis=1) + (low - ends[row])[:, None]


def words_and_spans(
    column: pa.Array, lower: bool = False, punctuation: bool = False
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (row, hashes, spans) for each row in order; rows without words get empty arrays."""
    none = np.empty(0, np.uint64), np.empty((0, 2), np.int64)
    done, held_row, held = 0, None, []

    def whole():
        return held[0] if len(held) == 1 else tuple(np.concatenate(x) for x in zip(*held))

    for rows, hashes, spans in word_hashes(column, lower, punctuation):
        cuts = np.flatnonzero(np.diff(rows)) + 1
        bounds = [0, *cuts.tolist(), len(rows)]
        for row, i, j in zip(rows[bounds[:-1]].tolist(), bounds, bounds[1:]):
            if row == held_row:
                held.append((hashes[i:j], spans[i:j]))
                continue
            if held_row is not None:
                yield held_row, *whole()
                done = held_row + 1
            for empty in range(done, row):
                yield empty, *none
            held_row, held, done = row, [(hashes[i:j], spans[i:j])], row
    if held_row is not None:
        yield held_row, *whole()
        done = held_row + 1
    for empty in range(done, len(column)):
        yield empty, *none


def words_by_row(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """Yield (row, hashes) for each row in order."""
    for row, hashes, _ in words_and_spans(column, lower):
        yield row, hashes


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, in order and with repeats."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    total = np.zeros(len(hashes) - width + 1, np.uint64)
    for i in range(width):
        # every place has a multiplier of its own, so that the order counts
        total += hashes[i : len(hashes) - width + 1 + i] * np.uint64(pow(_BASE, 2 * i + 1, 1 << 64))
    return mix(total ^ np.uint64(width))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """The sorted set of ``width``-word shingles; of a shorter text the whole sequence; of none nothing."""
    return np.unique(windows(hashes, min(width, len(hashes)))) if len(hashes) else hashes
