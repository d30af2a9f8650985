"""Operator 12: mine word collocations from vertically partitioned suffix subtrees.

The suffix tree of all word sequences, cut off at three words, is never built as a whole. Its subtrees are told apart by word
prefixes: a prefix is one word, and one or two more where its words are so frequent that their suffixes would not fit the memory
budget. Prefixes are put into groups whose suffixes fit the budget together. A group's subtrees are built by one task, independently
of all others: it sorts the suffixes of its prefixes, and a phrase's count is the total of the leaves below its node.

Texts are read twice: once for the frequency of words, which decides the groups, once for the suffixes. Suffixes are folded and packed
chunk by chunk before they are shuffled. Words travel as 64-bit hashes of language and word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from weftloom.llm import words
from weftloom.operators.skew import skew_join
from weftloom.session import materialize

MIN_COUNT = 10
COVERED_PERCENT = 50
TOP = 2_000
UNKNOWN = "und"
SUFFIXES = 3_000_000  # memory budget of a group of prefixes
MAX_FREQUENT = 1_000_000  # words that may be frequent; more only if the budget were below a millionth of all words
BINS = 1 << 16  # of prefix hashes; groups are runs of bins
CHUNK_WORDS = 1_500_000  # suffixes folded at once, and up to 2^19 more; ids of a chunk's words must fit 21 bits
_ID_BITS = 21

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK = _BREAK.copy()
_BLANK[list(b" \t")] = True

WORDS = "h long, lang string, word string, f long"
PACKED = "part int, words binary, suffixes binary, n long"
NODES = "h1 long, h2 long, h3 long, a long"


def _language_hash(lang: str) -> np.uint64:
    total = np.uint64(0xC0110CA7)
    for byte in lang.encode():
        total = words.mix(np.array([total ^ np.uint64(byte)]))[0]
    return total


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """Yield (rows, hashes of language and word, byte ranges in the batch, whether a word begins a piece, languages by row)."""
    langs = [UNKNOWN if lang is None else lang for lang in batch.column("lang").to_pylist()]
    hashed = {lang: _language_hash(lang) for lang in set(langs)}
    by_row = np.array([hashed[lang] for lang in langs], np.uint64)
    data, ends = words.text_buffers(batch.column("text"))
    last_row, last_stop = -1, 0
    for rows, hashes, spans in words.word_hashes(batch.column("text"), lower=True, blank=_BLANK):
        at = spans + ends[rows][:, None]
        low = last_stop if rows[0] == last_row else int(at[0, 0])
        breaks = np.zeros(int(at[-1, 0]) - low + 1, np.int32)
        np.cumsum(_BREAK[data[low : int(at[-1, 0])]], out=breaks[1:])
        seen = breaks[at[:, 0] - low]
        first = np.empty(len(rows), bool)
        first[0] = rows[0] != last_row or seen[0] > 0
        first[1:] = (rows[1:] != rows[:-1]) | (seen[1:] > seen[:-1])
        last_row, last_stop = int(rows[-1]), int(at[-1, 1])
        yield rows, words.mix(hashes + by_row[rows]), at, first, langs


def _count_words(flush_at: int):
    def count(batches):
        known: dict[int, list] = {}

        def out():
            rows = list(known.items())
            known.clear()
            return pa.record_batch([
                pa.array([h for h, _ in rows], pa.int64()), pa.array([r[0] for _, r in rows], pa.string()),
                pa.array([r[1] for _, r in rows], pa.binary()).cast(pa.string()), pa.array([r[2] for _, r in rows], pa.int64()),
            ], ["h", "lang", "word", "f"])

        for batch in batches:
            data, _ = words.text_buffers(batch.column("text"))
            for rows, hashes, at, _, langs in _tokens(batch):
                distinct, first, n = np.unique(hashes.view(np.int64), return_index=True, return_counts=True)
                for h, i, f in zip(distinct.tolist(), first.tolist(), n.tolist()):
                    entry = known.get(h)
                    if entry is None:
                        known[h] = [langs[rows[i]], data[at[i, 0] : at[i, 1]].tobytes().lower(), f]
                    else:
                        entry[2] += f
                if len(known) >= flush_at:
                    yield out()
        if known:
            yield out()

    return count


def count_words(docs: DataFrame, flush_at: int = 300_000) -> DataFrame:
    """``(h, lang, word, f)``: how often each word occurs in its language; ``h`` stands for both."""
    texts = docs.select("lang", "text").where(F.col("text").isNotNull())
    return texts.mapInArrow(_count_words(flush_at), WORDS).groupBy("h", "lang", "word").agg(F.sum("f").alias("f"))


def plan_groups(counted: DataFrame, suffixes: int = SUFFIXES) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of frequent words, first bins of the groups) from word frequencies.

    At most ``MAX_FREQUENT`` words are frequent, as each of them occurs more often than a millionth of all words;
    their longer prefixes are taken to spread evenly over the bins. What reaches the driver is these hashes and ``BINS`` sums.
    """
    total = counted.agg(F.sum("f")).first()[0] or 0
    budget = max(suffixes, total // MAX_FREQUENT)
    frequent = counted.where(F.col("f") > budget).select("h", "f").toArrow()
    heavy = np.sort(frequent.column("h").to_numpy().astype(np.int64).view(np.uint64))
    light = counted.where(F.col("f") <= budget)
    sums = light.groupBy(F.shiftrightunsigned("h", 64 - 16).alias("bin")).agg(F.sum("f").alias("f")).toArrow()
    load = np.full(BINS, (frequent.column("f").to_numpy().sum() or 0) / BINS)
    load[sums.column("bin").to_numpy()] += sums.column("f").to_numpy()
    starts, held = [0], 0.0
    for i, own in enumerate(load.tolist()):
        if held and held + own > budget:
            starts.append(i)
            held = 0.0
        held += own
    return heavy, np.array(starts)


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _planes(*columns: np.ndarray) -> bytes:
    """Columns of 32-bit numbers, byte planes side by side, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.stack(columns).astype("<u4")[:, :, None].view(np.uint8).transpose(0, 2, 1).tobytes())


def _from_planes(packed: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(-1, 4, n).transpose(0, 2, 1)).view("<u4")[:, :, 0]


def prefix_hash(h1: np.ndarray, h2: np.ndarray, h3: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Hash of a suffix's prefix: its first word, and the next as long as the last one taken is frequent."""
    longer = _is_in(h1, heavy)
    prefix = np.where(longer, words.mix(h1 * np.uint64(3) + h2), h1)
    longest = longer & _is_in(h2, heavy)
    return np.where(longest, words.mix(prefix * np.uint64(5) + h3), prefix)


def _pack(hashes: np.ndarray, first: np.ndarray, begins: int, heavy: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """Fold a chunk's suffixes of two and three words that begin at its first ``begins`` words, packed by group of prefixes."""
    distinct, ids = np.unique(hashes, return_inverse=True)
    ids = (ids + 1).astype(np.uint64)  # 0: no word
    second, third = np.zeros_like(ids), np.zeros_like(ids)
    second[:-1] = np.where(first[1:], 0, ids[1:])
    third[:-2] = np.where(first[1:-1] | first[2:], 0, ids[2:])
    some = np.flatnonzero(second[:begins])
    key = (ids[some] << np.uint64(2 * _ID_BITS)) | (second[some] << np.uint64(_ID_BITS)) | third[some]
    key, n = np.unique(key, return_counts=True)
    mask = np.uint64((1 << _ID_BITS) - 1)
    one, two, three = key >> np.uint64(2 * _ID_BITS), (key >> np.uint64(_ID_BITS)) & mask, key & mask
    named = np.concatenate([np.zeros(1, np.uint64), distinct])
    prefix = prefix_hash(named[one], named[two], named[three], heavy)
    part = np.searchsorted(starts, (prefix >> np.uint64(64 - 16)).astype(np.int64), "right") - 1
    order = np.argsort(part, kind="stable")
    rows = []
    for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        if len(own):
            local, back = np.unique(np.concatenate([one[own], two[own], three[own]]), return_inverse=True)
            a, b, c = back.reshape(3, -1)
            rows.append((int(part[own[0]]), named[local].tobytes(), _planes(np.diff(a, prepend=0), b, c, n[own]), len(own)))
    kinds = pa.int32(), pa.binary(), pa.binary(), pa.int64()
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["part", "words", "suffixes", "n"])


def _pack_suffixes(heavy: np.ndarray, starts: np.ndarray, chunk_words: int):
    def pack(batches):
        held, size = [], 0
        for batch in batches:
            for _, hashes, _, first, _ in _tokens(batch):
                held.append((hashes, first))
                size += len(hashes)
                if size >= chunk_words:
                    hashes, first = (np.concatenate(x) for x in zip(*held))
                    yield _pack(hashes, first, size - 2, heavy, starts)
                    held, size = [(hashes[-2:], first[-2:])], 2  # their suffixes need the words to come
        if size:
            hashes, first = (np.concatenate(x) for x in zip(*held))
            yield _pack(hashes, first, size, heavy, starts)

    return pack


def _subtrees(heavy: np.ndarray, min_count: int):
    def build(table: pa.Table) -> pa.Table:
        """Nodes of two and three words in a group's subtrees; pairs whose leaves lie in several groups as parts of their total."""
        dictionaries = [np.frombuffer(x, np.uint64) for x in table.column("words").to_pylist()]
        named = np.unique(np.concatenate(dictionaries))
        columns = []
        for local, packed, n in zip(dictionaries, table.column("suffixes").to_pylist(), table.column("n").to_pylist()):
            step, b, c, count = _from_planes(packed, n)
            to = np.searchsorted(named, local).astype(np.uint32)
            columns.append((to[np.cumsum(step)], to[b], to[c], count.astype(np.int64)))
        one, two, three, count = (np.concatenate(x) for x in zip(*columns))
        pair = (one.astype(np.uint64) << np.uint64(32)) | two
        order = np.lexsort((three, pair))
        pair, three, count = pair[order], three[order], count[order]
        starts_pair = np.r_[True, pair[1:] != pair[:-1]]
        leaf = np.flatnonzero(starts_pair | np.r_[True, three[1:] != three[:-1]])
        leaf_total = np.add.reduceat(count, leaf)
        node = np.flatnonzero(starts_pair)
        node_total = np.add.reduceat(count, node)
        h1, h2 = named[(pair >> np.uint64(32)).astype(np.int64)], named[(pair & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        h3 = named[three]
        split = _is_in(h1[node], heavy) & _is_in(h2[node], heavy)
        pairs = node[split | (node_total >= min_count)]
        pairs_total = node_total[split | (node_total >= min_count)]
        triples = leaf[(h3[leaf] != 0) & (leaf_total >= min_count)]
        triples_total = leaf_total[(h3[leaf] != 0) & (leaf_total >= min_count)]
        both = np.concatenate([pairs, triples])
        long = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
        thirds = pa.array(h3[both].view(np.int64), mask=np.arange(len(both)) < len(pairs))
        totals = pa.array(np.concatenate([pairs_total, triples_total]))
        return pa.table({"h1": long(h1[both]), "h2": long(h2[both]), "h3": thirds, "a": totals})

    return build


def count_phrases(docs: DataFrame, counted: DataFrame, min_count: int = MIN_COUNT, suffixes: int = SUFFIXES, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``(h1, h2, h3, a)``: all phrases of two and three words (``h3`` null: two) that occur ``min_count`` times or more."""
    heavy, starts = plan_groups(counted, suffixes)
    texts = docs.select("lang", "text").where(F.col("text").isNotNull())
    packed = texts.mapInArrow(_pack_suffixes(heavy, starts, chunk_words), PACKED)
    nodes = packed.groupBy("part").applyInArrow(_subtrees(heavy, min_count), NODES)
    return nodes.groupBy("h1", "h2", "h3").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)); decimals of 38 digits hold these products up to counts of 10^16."""
    wide = lambda x: x.cast("decimal(19,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * wide(a) * wide(a), wide(left) * wide(right))


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, covered_percent: int = COVERED_PERCENT, top: int = TOP,
    suffixes: int = SUFFIXES, chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of two or three words.

    ``a`` is the phrase's count within pieces, overlaps included; ``l`` and ``r`` are the counts of its parts at the cut of the
    lowest score, ``n`` the words of the language. A phrase is dropped if a longer candidate that holds it has at least
    ``covered_percent`` % of its count. Texts that are null or without words have no phrases, a null language is ``und``,
    repeated rows count each time, ids and other columns are not looked at, an empty table gives no rows.
    """
    counted = materialize(count_words(docs))
    sizes = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    known = materialize(counted.where(F.col("f") >= min_count))
    phrases = materialize(count_phrases(docs, counted, min_count, suffixes, chunk_words))
    pairs = phrases.where("h3 is null").select("h1", "h2", "a")
    triples = phrases.where("h3 is not null")

    def word(at: str, count: str) -> DataFrame:
        return known.select(F.col("h").alias(at), F.col("f").alias(count), F.col("word").alias(f"w{at[1]}"))

    two = skew_join(pairs, word("h1", "l").join(known.select(F.col("h").alias("h1"), "lang"), "h1"), ["h1"])
    two = skew_join(materialize(two), word("h2", "r"), ["h2"])
    longer = triples.select("h1", "h2", "a").unionByName(triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    covering = longer.groupBy("h1", "h2").agg(F.max("a").alias("most"))
    two = two.join(covering, ["h1", "h2"], "left").where(
        F.col("most").isNull() | (100 * F.col("most") < covered_percent * F.col("a"))
    )
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))

    three = skew_join(triples, pairs.select("h1", "h2", F.col("a").alias("l2")), ["h1", "h2"])
    three = skew_join(materialize(three), pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("r1")), ["h2", "h3"])
    three = skew_join(materialize(three), word("h1", "l1").join(known.select(F.col("h").alias("h1"), "lang"), "h1"), ["h1"])
    three = skew_join(materialize(three), word("h2", "f2").drop("f2"), ["h2"])
    three = skew_join(materialize(three), word("h3", "r2"), ["h3"])
    s1, s2 = _score(F.col("a"), F.col("l1"), F.col("r1")), _score(F.col("a"), F.col("l2"), F.col("r2"))
    three = three.withColumn("s1", s1).withColumn("s2", s2)
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
