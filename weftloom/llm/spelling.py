"""Operator 11: group spelling variants by search in tries of letter-group frequencies.

Every word is a vector of counts, one for each of ``GROUPS``. A single edit adds at most one letter and takes away at most one, so the
vectors of two near words differ by a surplus of at most one and a deficit of at most one. The words of the corpus are arranged in a trie by
successive counts. Its first levels are cells of a Spark shuffle: a word is stored in its own cell and sent to the cells that its
budget reaches, to half of them, as each pair needs to be found only once. Below, each task arranges a cell's words by the remaining counts
and searches depth first, with all probing words that still have a budget at a node at once. Words in the leaves are verified letter by letter.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftloom.operators.skew import skew_join
from weftloom.session import broadcast_if_small, materialize

MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5  # a form is at least so many times as frequent
DROP_EVERY = 199
# letters by group; frequent ones are alone. All other letters of U+00C0 to U+00FF are dealt over the groups by code point.
GROUPS = ("e", "t", "a", "o", "i", "n", "s", "r", "hé", "lè", "dü", "cumö", "fpgä", "wybß", "vkxç", "jqzñ")
TOP_LEVELS = 4  # of the trie; they are the cells of the shuffle
LEAF_WORDS = 48
BLOCK_WORDS = 30_000  # stored words of a cell in one task
PAIRS = 200_000  # pairs verified at once
PADDED = 48  # longest word that is verified by numpy
_RUN = re.compile("[a-zÀ-ÿ]+")

_group_of = np.arange(256, dtype=np.int64) % len(GROUPS)
for _i, _letters in enumerate(GROUPS):
    for _letter in _letters:
        _group_of[ord(_letter)] = _i


def _runs(text: str):
    """Lower-cased runs with their counts."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # of bytes, lower() touches A-Z only
    if len(lowered) < 1 << 20:
        return Counter(_RUN.findall(lowered))
    return Counter(m.group() for m in _RUN.finditer(lowered))


def _count_words(min_letters: int, drop_every: int | None, flush_at: int):
    def count(batches):
        known = Counter()

        def out():
            found = pa.record_batch([pa.array(list(known), pa.string()), pa.array(list(known.values()), pa.int64())], ["word", "n"])
            known.clear()
            return found

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in _runs(text.as_py()).items():
                    if len(run) < min_letters:
                        continue
                    if drop_every:
                        h = zlib.crc32(run.encode(), seed)
                        if h % drop_every == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < min_letters:
                                continue
                    known[run] += n
                if len(known) >= flush_at:
                    yield out()
        if known:
            yield out()

    return count


def count_words(
    docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, drop_every: int | None = None, flush_at: int = 300_000
) -> DataFrame:
    """``(word, n)``: runs of letters of all texts, lower-cased from A-Z only, of ``min_letters`` and ``min_count`` or more.

    With ``drop_every``, a run loses the letter at ``h % length`` where that number divides ``h``, the CRC-32 of ``doc_id:run``: planted misspellings.
    """
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    counted = texts.mapInArrow(_count_words(min_letters, drop_every, flush_at), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words as one run of Latin-1 bytes, which are their code points, and their ends in it."""
    coded = [w.encode("latin-1") for w in column.to_pylist()]
    ends = np.zeros(len(coded) + 1, np.int64)
    np.cumsum([len(c) for c in coded], out=ends[1:])
    return np.frombuffer(b"".join(coded), np.uint8), ends


def letter_counts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts by word and letter group."""
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    flat = np.bincount(row * len(GROUPS) + _group_of[data], minlength=(len(ends) - 1) * len(GROUPS))
    return flat.reshape(-1, len(GROUPS))


def _steps() -> list[tuple[int, ...]]:
    """How the first counts of a near word may differ: half of the ways, of which the other half are the opposites."""
    steps = []
    for step in itertools.product((-1, 0, 1), repeat=TOP_LEVELS):
        if step.count(1) <= 1 and step.count(-1) <= 1 and step >= (0,) * TOP_LEVELS:
            steps.append(step)
    return steps


def _cell(counts: np.ndarray) -> np.ndarray:
    """One number for the first counts; counts from 2^15 on share cells, which is harmless, as budgets are checked again."""
    cell = np.zeros(len(counts), np.int64)
    for i in range(TOP_LEVELS):
        cell = (cell << 15) | (counts[:, i] & 0x7FFF)
    return cell


def _place(batches):
    """Each word as a row of its own cell, and as a probe of those it may find near words in."""
    for batch in batches:
        counts = letter_counts(*_bytes(batch.column("word")))
        cells, rows, probing = [_cell(counts)], [np.arange(len(counts))], [np.zeros(len(counts), bool)]
        for step in _steps():
            moved = counts[:, :TOP_LEVELS] + np.array(step)
            own = np.flatnonzero((moved >= 0).all(axis=1))
            cells.append(_cell(moved[own]))
            rows.append(own)
            probing.append(np.ones(len(own), bool))
        taken = pa.array(np.concatenate(rows))
        yield pa.record_batch(
            [batch.column("word").take(taken), batch.column("n").take(taken), pa.array(np.concatenate(cells)), pa.array(np.concatenate(probing))],
            ["word", "n", "cell", "probing"],
        )


def _candidates(stored: np.ndarray, probes: np.ndarray):
    """Yield (stored rows, probing rows) that meet in a leaf within their budgets of one surplus and one deficit.

    ``stored`` is in lexicographic order, so a node of the trie is a run of its rows.
    """
    budget = np.ones((2, len(probes)), np.int8)
    stack = [(0, 0, len(stored), np.arange(len(probes)), budget[0], budget[1])]
    depth = stored.shape[1]
    while stack:
        level, low, high, probe, more, less = stack.pop()
        if high - low <= LEAF_WORDS or level == depth:
            for i in range(0, len(probe), 20_000):
                part = probe[i : i + 20_000]
                for j in range(low, high, LEAF_WORDS):  # equal vectors may fill a leaf without end
                    gap = stored[j : min(j + LEAF_WORDS, high), None, level:] - probes[None, part, level:]
                    fits = (np.maximum(gap, 0).sum(axis=2) <= more[i : i + 20_000]) & (np.maximum(-gap, 0).sum(axis=2) <= less[i : i + 20_000])
                    s, p = np.nonzero(fits)
                    if len(s):
                        yield s + j, part[p]
            continue
        values = stored[low:high, level]
        cuts = np.r_[0, np.flatnonzero(np.diff(values)) + 1, high - low]
        own = probes[probe, level]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            gap = values[a] - own
            fits = np.flatnonzero((gap == 0) | ((gap == 1) & (more > 0)) | ((gap == -1) & (less > 0)))
            if len(fits):
                gap = gap[fits]
                stack.append((level + 1, low + a, low + b, probe[fits], more[fits] - (gap == 1), less[fits] - (gap == -1)))


def _one_edit(a: bytes, b: bytes) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[start + (len(a) == len(b)) :] == b[start + 1 :]


def _verified(data: np.ndarray, ends: np.ndarray, padded: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of words differ by exactly one inserted, deleted or replaced letter."""
    size = np.diff(ends)
    near = np.zeros(len(i), bool)
    small = np.maximum(size[i], size[j]) <= PADDED
    for k in np.flatnonzero(~small).tolist():
        near[k] = _one_edit(data[ends[i[k]] : ends[i[k] + 1]].tobytes(), data[ends[j[k]] : ends[j[k] + 1]].tobytes())
    same = np.flatnonzero(small & (size[i] == size[j]))
    near[same] = (padded[i[same]] != padded[j[same]]).sum(axis=1) == 1
    apart = np.flatnonzero(small & (np.abs(size[i] - size[j]) == 1))
    swap = size[i[apart]] > size[j[apart]]
    short, long = np.where(swap, j[apart], i[apart]), np.where(swap, i[apart], j[apart])
    x, y = padded[short], padded[long]
    first = (x != y).argmax(axis=1)  # they differ somewhere, as the longer one has a letter where the shorter one has none
    shifted = (x[:, :-1] == y[:, 1:]) | (np.arange(PADDED)[None, :] < first[:, None])
    near[apart] = shifted.all(axis=1)
    return near


def _search(table: pa.Table) -> pa.Table:
    """Near pairs between a cell's stored and probing words, summed up by word: count, and the most frequent near word."""
    table = table.combine_chunks()
    column = table.column("word").chunk(0) if table.num_rows else pa.array([], pa.string())
    data, ends = _bytes(column)
    n, probing = table.column("n").to_numpy(), table.column("probing").to_numpy()
    counts = letter_counts(data, ends)
    size = np.diff(ends)
    padded = np.zeros((len(ends) - 1, PADDED + 1), np.uint8)  # one more, so that it ends in a blank
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(data)) - ends[row]
    padded[row[at < PADDED], at[at < PADDED]] = data[at < PADDED]
    home, guests = np.flatnonzero(~probing), np.flatnonzero(probing)
    home = home[np.lexsort(counts[home][:, ::-1].T)]
    own_cell = _cell(counts)
    cell = table.column("cell")[0].as_py()
    best: dict[int, list] = {}

    def take(i, j):
        mine = own_cell[j] == cell  # a probe at home: the pair is met twice there
        names = np.flatnonzero(_verified(data, ends, padded, i, j))
        for a, b, twice in zip(i[names].tolist(), j[names].tolist(), mine[names].tolist()):
            first, second = data[ends[a] : ends[a + 1]].tobytes(), data[ends[b] : ends[b + 1]].tobytes()
            if twice and first > second:
                continue
            for me, other, name, m in ((first, second, second, n[b]), (second, first, first, n[a])):
                entry = best.get(me)
                if entry is None:
                    best[me] = [1, m, name]
                else:
                    entry[0] += 1
                    if m > entry[1] or (m == entry[1] and name < entry[2]):
                        entry[1], entry[2] = m, name

    waiting, size_waiting = [], 0
    for i, j in _candidates(counts[home], counts[guests]):
        waiting.append((home[i], guests[j]))
        size_waiting += len(i)
        if size_waiting >= PAIRS:
            take(*(np.concatenate(x) for x in zip(*waiting)))
            waiting, size_waiting = [], 0
    if waiting:
        take(*(np.concatenate(x) for x in zip(*waiting)))
    text = lambda values: pa.array([v.decode("latin-1") for v in values], pa.string())
    return pa.table({
        "word": text(best), "n_near": pa.array([e[0] for e in best.values()], pa.int64()),
        "best_n": pa.array([int(e[1]) for e in best.values()], pa.int64()), "best": text([e[2] for e in best.values()]),
    })


def near_words(counted: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(word, n_near, best, best_n)`` for each word of ``counted(word, n)`` that has near words; words are distinct and not null.

    ``best`` is the near word of the largest n, of several the first by code point.
    """
    placed = counted.select("word", "n").mapInArrow(_place, "word string, n long, cell long, probing boolean")
    sizes = placed.where("not probing").groupBy("cell").agg(F.ceil(F.count("*") / block_words).cast("int").alias("blocks"))
    known = placed.join(broadcast_if_small(materialize(sizes)), "cell")  # cells without stored words fall away
    mine = F.array(F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = known.withColumn("block", F.explode(F.when(F.col("probing"), everywhere).otherwise(mine))).drop("blocks")
    found = dealt.groupBy("cell", "block").applyInArrow(_search, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("top")).select(
        "word", "n_near", F.col("top.w").alias("best"), (-F.col("top.m")).alias("best_n")
    )


def spelling_groups(counted: DataFrame, ratio: int = RATIO, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of ``counted(word, n)``.

    Two words are near if they differ by exactly one letter, inserted, deleted or replaced. A word's ``form`` is its most
    frequent near word, if that is at least ``ratio`` times as frequent, else null; ``root`` is the end of the chain of forms.
    An empty table gives no rows. Chains are followed by pointer doubling, in rounds that grow with the logarithm of their length.
    """
    near = near_words(counted, block_words)
    fits = F.col("best_n") >= ratio * F.col("n")
    words = materialize(
        counted.select("word", "n").join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n"),
        )
    )
    chains = materialize(words.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = chains.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(skew_join(chains, ahead, ["root"], "left"))
        chains = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.where("further is not null").isEmpty():
            break
    return words.join(chains, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
