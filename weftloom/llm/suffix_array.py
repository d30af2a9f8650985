"""Suffix arrays of many short byte strings by induced sorting, and their permuted common prefixes, in numpy.

The strings are laid end to end, each closed by the symbol 0; bytes are 1 to 256. Order counts up to the closing symbol only: suffixes that are
equal up to there may come in any order.

Induced sorting is a scan in which every suffix places the one before it. Here the scan goes symbol by symbol, and all
suffixes that begin with one symbol are moved at once; those of a run of one symbol, which a scan would place within its own
bucket, are written down by a closed form.
"""

from __future__ import annotations

import numpy as np

SYMBOLS = 257


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, first positions of the texts)."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.zeros(len(texts), np.int64)
    np.cumsum(sizes[:-1], out=starts[1:])
    symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
    symbols[starts + sizes - 1] = 0
    return symbols, starts


def classify(symbols: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one (closing symbols are)."""
    differs = np.empty(len(symbols), bool)
    differs[:-1], differs[-1] = symbols[:-1] != symbols[1:], True
    rises = np.empty(len(symbols), bool)
    rises[:-1], rises[-1] = symbols[:-1] < symbols[1:], True
    ends = np.flatnonzero(differs)  # a run of one symbol has the type of its last
    return np.repeat(rises[ends], np.diff(ends, prepend=-1))


def _run_starts(symbols: np.ndarray) -> np.ndarray:
    begins = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
    return np.repeat(begins, np.diff(begins, append=len(symbols))).astype(np.int32)


def _through_runs(own: np.ndarray, run_start: np.ndarray) -> np.ndarray:
    """``own`` with what they place in their own bucket: the suffixes before them in their runs, a step at a time."""
    more = own - run_start[own]
    if not more.any():
        return own
    which = np.repeat(np.arange(len(own)), more + 1)
    step = np.arange(len(which)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    order = np.argsort(step, kind="stable")
    return (own[which] - step)[order].astype(np.int32)


def _deal(sources: np.ndarray, symbols: np.ndarray, queues: list[list[np.ndarray]], fits) -> None:
    """Append the suffix before each source to the queue of its first symbol, in order."""
    before = sources[sources > 0] - 1
    first = symbols[before]
    keep = fits(first)
    before, first = before[keep], first[keep]
    if not len(before):
        return
    order = np.argsort(first, kind="stable")
    before, first = before[order], first[order]
    cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
    for symbol, part in zip(first[np.r_[0, cuts]].tolist(), np.split(before, cuts)):
        queues[symbol].append(part)


def induce(symbols: np.ndarray, run_start: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """The suffix array that the leftmost smaller suffixes ``smaller``, in their order, imply."""
    none = np.empty(0, np.int32)
    first = symbols[smaller]
    given: list[np.ndarray] = [none] * SYMBOLS
    order = np.argsort(first, kind="stable")
    cuts = np.flatnonzero(np.diff(first[order])) + 1
    for part in np.split(smaller[order], cuts):
        if len(part):
            given[int(symbols[part[0]])] = part
    queues: list[list[np.ndarray]] = [[] for _ in range(SYMBOLS)]
    larger: list[np.ndarray] = [none] * SYMBOLS
    for symbol in range(SYMBOLS):
        if queues[symbol]:
            larger[symbol] = _through_runs(np.concatenate(queues[symbol]), run_start)
        _deal(np.concatenate([larger[symbol], given[symbol]]), symbols, queues, lambda s: s > symbol)
    queues = [[] for _ in range(SYMBOLS)]
    out: list[np.ndarray] = [none] * SYMBOLS
    for symbol in range(SYMBOLS - 1, -1, -1):  # from the end; queues hold descending order
        own = _through_runs(np.concatenate(queues[symbol]), run_start) if queues[symbol] else none
        if symbol == 0:
            own = given[0]
        _deal(np.concatenate([own, larger[symbol][::-1]]), symbols, queues, lambda s: s < symbol)
        out[symbol] = np.concatenate([larger[symbol], own[::-1]])
    return np.concatenate(out)


def _names(symbols: np.ndarray, places: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the substrings from each of ``places`` to the next one, from 1; ``ordered`` are the places in their order."""
    ends = np.append(places[1:], len(symbols) - 1)
    at = np.searchsorted(places, ordered)
    size = (ends - places)[at] + 1
    same = np.zeros(len(ordered), bool)
    maybe = np.flatnonzero(size[1:] == size[:-1]) + 1
    length = size[maybe]
    begin = np.cumsum(length) - length
    step = np.arange(int(length.sum())) - np.repeat(begin, length)
    equal = symbols[np.repeat(ordered[maybe], length) + step] == symbols[np.repeat(ordered[maybe - 1], length) + step]
    if len(maybe):
        same[maybe] = np.logical_and.reduceat(equal, begin)
    # substrings that begin with the closing symbol stand for nothing but the end of their text
    same[1:] |= (symbols[ordered[1:]] == 0) & (symbols[ordered[:-1]] == 0)
    names = np.empty(len(places), np.int64)
    names[at] = np.cumsum(~same)
    return names


def _rank(names: np.ndarray, left: np.ndarray, span: int = 1) -> np.ndarray:
    """Ranks of the suffixes of a string of names, of which ``left`` follow before its text is closed.

    Names of ``span`` substrings are joined by three (by two, if there are too many for 21 bits each) into names of longer stretches and
    sorted again, until they tell all apart or reach the end.
    """
    if span > left.max(initial=0):
        return names
    times, bits = (3, 21) if names.max() < 1 << 21 else (2, 31)
    joined = names << (bits * (times - 1))
    for i in range(1, times):
        step = i * span
        joined[:-step] |= np.where(left[:-step] >= step, names[step:], 0) << (bits * (times - 1 - i))
    order = np.argsort(joined)
    ordered = joined[order]
    ranks = np.empty_like(names)
    ranks[order] = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]])
    return _rank(ranks, left, times * span)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of ``symbols`` in the order of their suffixes."""
    is_smaller = classify(symbols)
    places = (np.flatnonzero(is_smaller[1:] & ~is_smaller[:-1]) + 1).astype(np.int32)
    if not len(places):
        return np.argsort(symbols, kind="stable").astype(np.int32)
    run_start = _run_starts(symbols)
    roughly = induce(symbols, run_start, places)
    leftmost = np.zeros(len(symbols), bool)
    leftmost[places] = True
    names = _names(symbols, places, roughly[leftmost[roughly]])
    closing = np.flatnonzero(symbols[places] == 0)
    left = closing[np.searchsorted(closing, np.arange(len(places)))] - np.arange(len(places))
    ranks = _rank(names, left)
    return induce(symbols, run_start, places[np.argsort(ranks, kind="stable")])


def common_prefixes(symbols: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(previous suffix in the array, symbols shared with it) by position; -1 and 0 for the first.

    Where the suffixes before two neighbours are neighbours too, what they share is one symbol more; only the others are compared.
    """
    n = len(symbols)
    previous = np.full(n, -1, np.int32)
    previous[array[1:]] = array[:-1]
    closing = np.flatnonzero(symbols == 0)
    rest = closing[np.searchsorted(closing, np.arange(n))] - np.arange(n)  # symbols before the text is closed
    follows = np.zeros(n, bool)
    follows[1:] = (previous[1:] == previous[:-1] + 1) & (previous[:-1] >= 0) & (symbols[:-1] != 0)
    follows[1:] &= symbols[previous[1:] - 1] == symbols[:-1]
    start = np.flatnonzero(~follows & (previous >= 0))
    padded = np.concatenate([symbols, np.zeros(4, np.uint16)]).astype(np.uint64)
    four = padded[:n] | (padded[1 : n + 1] << np.uint64(16)) | (padded[2 : n + 2] << np.uint64(32)) | (padded[3 : n + 3] << np.uint64(48))
    a, b = start, previous[start].astype(np.int64)
    most = np.minimum(rest[a], rest[b])
    length = np.zeros(len(start), np.int64)
    active = np.arange(len(start))
    while len(active):
        at = length[active]
        more = at + 4 <= most[active]
        active, at = active[more], at[more]
        equal = four[a[active] + at] == four[b[active] + at]
        active = active[equal]
        length[active] += 4
    for _ in range(3):
        more = np.flatnonzero(length < most)
        more = more[symbols[a[more] + length[more]] == symbols[b[more] + length[more]]]
        length[more] += 1
    anchor = np.zeros(n, np.int64)
    anchor[start] = start
    shared = np.zeros(n, np.int64)
    shared[start] = length
    np.maximum.accumulate(anchor, out=anchor)
    shared = np.maximum(shared[anchor] - (np.arange(n) - anchor), 0)
    shared[previous < 0] = 0
    return previous, shared
