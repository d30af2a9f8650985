"""Operator 13: remove long repeated byte strings with suffix arrays built shard by shard.

A place is a start of ``LENGTH`` bytes within a text. Equal strings have equal anchors: the smallest hash of a ``GRAM``-byte part, the first of
several. So places are dealt to shards by anchor. Neighbouring places mostly share theirs and travel as one span, the bytes
that they cover; spans whose anchor occurs nowhere else can't repeat and stay at home. Equal spans travel once, marked by their
count, and are put into the shard twice. A shard sorts its spans' suffixes by induced sorting and finds the
places that share ``LENGTH`` bytes with a neighbour in the array.

An anchor in a common passage has spans of very many texts. Such spans are cut into shorter ones, dealt by all
that the places of a cut share, at last single places; so no shard grows with the number of texts that hold a passage.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftloom.llm import suffix_array, words
from weftloom.operators.skew import skew_join
from weftloom.session import discard, materialize

LENGTH = 200
GRAM = 24
SHARD_BYTES = 2_500_000
CROWD = 3_000  # different spans of an anchor in one shard; more are cut
CUTS = (16, 1)  # places in a cut span
PIECE_BYTES = 1 << 20
_POSITION_BITS = 22

SPANS = "key long, dig long, h1 long, h2 long, at long, n int"
PLACES = f"{SPANS}, c long"
PIECES = "key long, dig long, c long, text binary"
CUT = "key long, dig long, at int, key2 long, dig2 long, c long, text binary"
RANGES = "key long, dig long, ranges array<struct<at:int,n:int>>"
RESULT = "h1 long, h2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_ID = ["h1", "h2"]
_SPAN = ["key", "dig"]


class _Hashes:
    """Hashes of parts of a byte run."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = words._powers(len(data) + 1)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:-1], out=self.total[1:])

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        own = (self.total[last] - self.total[first]) * self.down[first]
        return words.mix(own + (last - first).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def _anchors(hashes: _Hashes, size: int, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor of each place, hashes of all grams)."""
    begins = np.arange(size - gram + 1)
    grams = hashes(begins, begins + gram)
    low = (grams & ~np.uint64((1 << _POSITION_BITS) - 1)) | begins.astype(np.uint64)
    window, width = length - gram + 1, 1
    while 2 * width <= window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < window:
        low = np.minimum(low[: len(low) - (window - width)], low[window - width :])
    return (low & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64), grams


def _groups(data: np.ndarray, ends: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of (row, first byte, last byte) of about PIECE_BYTES side by side; pieces of one text overlap by all but one byte of a place."""
    group, size = [], 0
    for row in range(len(ends) - 1):
        start, stop = int(ends[row]), int(ends[row + 1])
        while stop - start >= length:
            end = min(stop, start + PIECE_BYTES + length - 1)
            if group and (size + end - start > 2 * PIECE_BYTES or group[-1][2] > start):
                yield tuple(np.array(group).T)
                group, size = [], 0
            group.append((row, start, end))
            size += end - start
            if end == stop:
                break
            start = end - length + 1
    if group:
        yield tuple(np.array(group).T)


def _spans(length: int, gram: int):
    def find(batches):
        for batch in batches:
            data, ends = words.text_buffers(batch.column("text"))
            ids = [batch.column(c).to_numpy() for c in _ID]
            for rows, first, last in _groups(data, ends, length):
                low = int(first[0])
                part = data[low : int(last[-1])]
                hashes = _Hashes(part)
                anchor, grams = _anchors(hashes, len(part), length, gram)
                owner = np.searchsorted(first - low, np.arange(len(anchor)), "right") - 1
                places = np.flatnonzero(np.arange(len(anchor)) + length <= (last - low)[owner])
                own = anchor[places]
                begin = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (np.diff(places) != 1)])
                n = np.diff(begin, append=len(places))
                at = places[begin]
                row = rows[owner[at]]
                dig = hashes(at, at + n + (length - 1))
                yield pa.record_batch(
                    [pa.array(grams[own[begin]].view(np.int64)), pa.array(dig.view(np.int64)), pa.array(ids[0][row]), pa.array(ids[1][row]),
                     pa.array(at + low - ends[row]), pa.array(n.astype(np.int32))],
                    ["key", "dig", "h1", "h2", "at", "n"],
                )

    return find


def _repeated(batches):
    """Of rows sorted by anchor, those whose anchor has a neighbour, equal ones as one with a count.

    The first and the last anchor of a partition may go on in another one, so they are kept as well.
    """
    names = ["key", "dig", "h1", "h2", "at", "n"]
    held, known, begun = None, None, False  # the last row, if its anchor is single so far; an anchor known to repeat

    def out(rows):
        first = np.r_[True, (np.diff(np.stack([rows[c] for c in names[:5]])) != 0).any(axis=0)] if len(rows["key"]) else np.empty(0, bool)
        at = np.flatnonzero(first)
        columns = [pa.array(rows[c][at]) for c in names]
        return pa.record_batch([*columns, pa.array(np.diff(at, append=len(first)).astype(np.int64))], [*names, "c"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        if held is not None:
            rows = {c: np.concatenate([held[c], rows[c]]) for c in names}
        key = rows["key"]
        same = key[1:] == key[:-1]
        keep = np.r_[False, same] | np.r_[same, False]
        if not begun:
            keep[0], begun = True, True
        if known is not None:
            keep |= key == known
        held = None
        if keep[-1]:
            known = key[-1]
        else:
            held, known = {c: rows[c][-1:] for c in names}, None
        yield out({c: rows[c][keep] for c in names})
    if held is not None:
        yield out(held)


def _cut_out(length: int):
    """Bytes of the spans that were chosen in a text."""
    def cut(batches):
        for batch in batches:
            data, ends = words.text_buffers(batch.column("text"))
            chosen = batch.column("chosen")
            flat, row = chosen.flatten(), np.repeat(np.arange(len(chosen)), np.diff(chosen.offsets.to_numpy()))
            at = flat.field("at").to_numpy() + ends[row]
            to = at + flat.field("n").to_numpy() + (length - 1)
            for i in range(0, len(at), 20_000):
                texts = [data[a:b].tobytes() for a, b in zip(at[i : i + 20_000].tolist(), to[i : i + 20_000].tolist())]
                part = flat.slice(i, 20_000)
                yield pa.record_batch([part.field("key"), part.field("dig"), part.field("c"), pa.array(texts, pa.binary())], ["key", "dig", "c", "text"])

    return cut


def _cut_spans(length: int, gram: int, width: int):
    """Spans of one anchor cut into at most ``width`` places each, by distance from the anchor."""
    def cut(batches):
        for batch in batches:
            rows = []
            for key, dig, c, text in zip(*(batch.column(x).to_pylist() for x in ("key", "dig", "c", "text"))):
                data = np.frombuffer(text, np.uint8)
                hashes = _Hashes(data)
                anchor, n = int(_anchors(hashes, len(data), length, gram)[0][0]), len(data) - length + 1
                for slot in range((anchor - n + 1) // width, anchor // width + 1):
                    shared = anchor - slot * width  # the last place of the slot, were the span long enough
                    begin, end = max(0, shared - width + 1), min(n - 1, shared)
                    bounds = np.array([[shared, shared - width + 1 + length], [begin, end + length]])
                    common, own = hashes(bounds[:, 0], bounds[:, 1])
                    mixed = words.mix(np.array([np.uint64(key % (1 << 64)) ^ common, np.uint64(slot)]))
                    key2 = words.mix(mixed[:1] + mixed[1:])
                    rows.append((key, dig, begin, int(key2.view(np.int64)[0]), int(own.view(np.int64)), c, text[begin : end + length]))
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()
            names = ["key", "dig", "at", "key2", "dig2", "c", "text"]
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return cut


def _sort_shard(length: int):
    def sort(table: pa.Table) -> pa.Table:
        """Places of a shard's spans that share ``length`` bytes with another place, as runs."""
        texts, counts = table.column("text").to_pylist(), table.column("c").to_numpy()
        texts += [t for t, c in zip(texts, counts.tolist()) if c > 1]
        symbols, starts = suffix_array.lay_out(texts)
        previous, shared = suffix_array.common_prefixes(symbols, suffix_array.suffix_array(symbols))
        repeats = shared >= length
        repeats[previous[repeats]] = True
        places = np.flatnonzero(repeats)
        span = np.searchsorted(starts, places, "right") - 1
        places, span = places[span < len(counts)], span[span < len(counts)]
        begin = np.flatnonzero(np.r_[True, (np.diff(places) != 1) | (np.diff(span) != 0)]) if len(places) else np.empty(0, np.int64)
        at, n, span = (places - starts[span])[begin], np.diff(begin, append=len(places)), span[begin]
        own, first = np.unique(span, return_index=True)
        offsets = pa.array(np.append(first, len(span)).astype(np.int32))
        runs = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], ["at", "n"])
        taken = pa.array(own)
        return pa.table([table.column("key").take(taken), table.column("dig").take(taken), pa.ListArray.from_arrays(offsets, runs)], ["key", "dig", "ranges"])

    return sort


def _repeated_places(pieces: DataFrame, length: int, gram: int, cuts: tuple[int, ...], crowd: int, shard_bytes: int) -> DataFrame:
    """``(key, dig, ranges)``: which places of each span of ``pieces(key, dig, c, text)`` repeat."""
    crowded = materialize(pieces.groupBy("key").count().where(F.col("count") > crowd).select("key"))
    calm, deeper = pieces, None
    if cuts and not crowded.isEmpty():
        hot = skew_join(pieces, crowded, ["key"], "left_semi")
        calm = skew_join(pieces, crowded, ["key"], "left_anti")
        parts = materialize(hot.mapInArrow(_cut_spans(length, gram, cuts[0]), CUT))
        own = parts.groupBy("key2", "dig2").agg(F.sum("c").alias("c"), F.first("text").alias("text"))
        below = materialize(own.select(F.col("key2").alias("key"), F.col("dig2").alias("dig"), "c", "text"))
        found = _repeated_places(below, length, gram, cuts[1:], crowd, shard_bytes)
        found = found.select(F.col("key").alias("key2"), F.col("dig").alias("dig2"), "ranges")
        back = skew_join(parts.select("key", "dig", "at", "key2", "dig2"), materialize(found), ["key2", "dig2"])
        moved = F.transform("ranges", lambda r: F.struct((r["at"] + F.col("at")).alias("at"), r["n"].alias("n")))
        deeper = back.select("key", "dig", moved.alias("ranges"))
        deeper = deeper.groupBy("key", "dig").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))  # at most LENGTH places
    size = calm.agg(F.sum(F.octet_length("text") * F.when(F.col("c") > 1, 2).otherwise(1))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    dealt = calm.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    sort = _sort_shard(length)
    found = dealt.groupBy("shard").applyInArrow(lambda table: sort(table.drop_columns("shard")), RANGES)
    return found.unionByName(deeper) if deeper is not None else found


def _remove(length: int):
    def remove(batches):
        for batch in batches:
            data, ends = words.text_buffers(batch.column("text"))
            found = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for i, removed in enumerate(batch.column("removed")):
                text = data[ends[i] : ends[i + 1]]
                edge = np.zeros(len(text) + 1, np.int64)
                if removed.is_valid and len(removed.values):
                    at, n = (removed.values.field(c).to_numpy() for c in ("at", "n"))
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + n + (length - 1), -1)
                gone = np.cumsum(edge[:-1]) > 0
                found["n_bytes"].append(len(text))
                found["n_removed"].append(int(gone.sum()))
                found["n_spans"].append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                found["kept_sha256"].append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
            yield pa.record_batch([batch.column("h1"), batch.column("h2"), *(pa.array(v) for v in found.values())], ["h1", "h2", *found])

    return remove


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, cuts: tuple[int, ...] = CUTS, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """``(h1, h2, removed)``: for each text (by the two hashes of ``with_hashes``) its repeating places, as runs of ``n`` from byte ``at``.

    Texts without one are left out.
    """
    texts = with_hashes(docs).where(F.octet_length("text") >= length).select("text", *_ID)
    spans = materialize(texts.mapInArrow(_spans(length, gram), SPANS))  # read twice: for the limits of the ranges, and to be dealt
    # a salt, so that copies of a text without end can lie in several partitions
    order = ["key", "dig", "h1", "h2", "at"]
    dealt = spans.withColumn("salt", F.spark_partition_id()).repartitionByRange(*order, "salt").sortWithinPartitions(*order).drop("salt")
    places = dealt.mapInArrow(_repeated, PLACES).groupBy("key", "dig", "h1", "h2", "at", "n").agg(F.sum("c").alias("c"))
    places = materialize(places)
    discard(spans)
    shown = F.min(F.struct(*_ID, "at", "n")).alias("place")
    chosen = places.groupBy(*_SPAN).agg(F.sum("c").alias("c"), shown).select("place.*", *_SPAN, "c")
    by_text = chosen.groupBy(*_ID).agg(F.collect_list(F.struct("at", "n", *_SPAN, "c")).alias("chosen"))
    pieces = by_text.join(texts.dropDuplicates(_ID), _ID).select("text", "chosen").mapInArrow(_cut_out(length), PIECES)
    pieces = materialize(pieces)
    found = materialize(_repeated_places(pieces, length, gram, cuts, crowd, shard_bytes))
    hits = skew_join(places.select(*_SPAN, *_ID, F.col("at").alias("base")), found, _SPAN)
    run = F.explode(F.transform("ranges", lambda r: F.struct((r["at"] + F.col("base")).alias("at"), r["n"].cast("long").alias("n"))))
    return hits.select(*_ID, run.alias("run")).groupBy(*_ID).agg(F.collect_list("run").alias("removed"))


def with_hashes(docs: DataFrame) -> DataFrame:
    """``docs`` with a null text as an empty one, and two hashes that tell texts apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("text", text).withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), F.col("text")))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, cuts: tuple[int, ...] = CUTS, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs(doc_id, text)``.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same text or another; copies of a text count as
    others, so all of them lose what they share. A null text is empty; empty and short texts lose nothing; rows with a null or repeated id are
    judged like others, each row gives one; an empty table gives no rows; other columns are not looked at. Texts are told apart by 128 bits,
    anchors and spans by 64 each.
    """
    rows = docs.select("doc_id", "text")
    removed = repeated_spans(rows, length, gram, crowd, cuts, shard_bytes)
    hashed = with_hashes(rows)
    judged = hashed.select("text", *_ID).dropDuplicates(_ID).join(removed, _ID, "left").mapInArrow(_remove(length), RESULT)
    return skew_join(hashed.select("doc_id", *_ID), materialize(judged), _ID).drop(*_ID)
