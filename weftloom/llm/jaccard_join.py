"""Operator 9: exact Jaccard self-join on word shingles, as a blocked sparse product of document by shingle.

The product counts for each pair of documents the shingles that they share. It is done in column blocks. The
first block holds the few rarest shingles of each document, so many that two documents over the threshold must
meet there; it is a Spark join on the shingle. The others are ranges of shingle hashes, accumulated pair by pair
in numpy; a pair is given up as soon as its count can't reach the bound that the two sizes imply. The first quarter of
the hashes is done for all pairs before whole sets are gathered for those that are left.

Links matter only through the components that they form. So equal sets are folded into one node first, every
shingle of the first block links its nodes to one centre (two rounds), and then only pairs of nodes that
are still in different components are compared: no pairs are listed inside a group of look-alikes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from weftloom.llm import words
from weftloom.llm.graph import components
from weftloom.session import broadcast_if_small, discard, materialize, tidy_driver

SHINGLE_WORDS = 5
PERCENT = 75
ORDER_HINTS = 100_000  # most frequent shingles that are ordered by count; the others come first, by hash
STAR_ROUNDS = 2
BITMAP_WORDS = 8  # 64 bits each
EARLIER = 4  # shingles before a posting's own, by which most repeats of a pair are told
BROADCAST_IDS = 200_000  # ids of 8 bytes; more are joined by a shuffle
COLUMN_BLOCKS = 8
_BATCH_SHINGLES = 2_000_000
_SEEN_IN_BATCH, _HINT_COUNT = 3, 20


def _required(n_a, n_b, percent: int):
    """Least overlap of two sets of these sizes: the Jaccard bound solved for it."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def _as_long(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for row, hashes in words.words_by_row(batch.column("text"), lower=True):
        yield row, words.shingles(hashes, width)


def _keys_and_counts(width: int):
    """Size and 128-bit digest of each document's set; in rows of their own, shingles that several of a task's documents share.

    Shingles are counted over some millions at a time, copies once; they only serve an order, so near enough.
    """
    names = ["doc_id", "n", "key_a", "key_b", "shingle", "times"]

    def rows(*columns: pa.Array) -> pa.RecordBatch:
        size = max(len(c) for c in columns if c is not None)
        return pa.RecordBatch.from_arrays([pa.nulls(size, pa.int64()) if c is None else c for c in columns], names)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= _SEEN_IN_BATCH
        return rows(None, None, None, None, pa.array(_as_long(values[often])), pa.array(counts[often]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, known = [], 0, set()
        for batch in batches:
            n, key = np.zeros(len(batch), np.int64), np.zeros((len(batch), 2), np.uint64)
            for row, own in _sets(batch, width):
                n[row] = len(own)
                key[row] = own.sum(dtype=np.uint64), words.mix(own ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
                digest = key[row].tobytes()
                if len(own) and digest not in known:
                    known.add(digest)
                    held.append(own)
                    size += len(own)
                    if size >= _BATCH_SHINGLES:
                        yield counted(held)
                        held, size, known = [], 0, set()
            yield rows(batch.column("doc_id"), pa.array(n), pa.array(_as_long(key[:, 0])), pa.array(_as_long(key[:, 1])), None, None)
        if held:
            yield counted(held)

    return run


def _prefixes(width: int, percent: int, hints):
    """The rarest shingles of each set, in the common order, and a parity bitmap of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = hints.value
        for batch in batches:
            lists, sizes = [], np.zeros(len(batch) + 1, np.int64)
            bits = np.zeros((len(batch), BITMAP_WORDS), np.uint64)
            n = np.zeros(len(batch), np.int64)
            for row, own in _sets(batch, width):
                n[row] = len(own)
                if not len(own):
                    continue
                rank = np.zeros(len(own), np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
                    rank = np.where(frequent[at] == own, counts[at], 0)
                keep = len(own) - -(-percent * len(own) // 100) + 1
                lists.append(own[np.argsort(rank, kind="stable")[:keep]])
                sizes[row + 1] = keep
                parity = np.bincount((own >> np.uint64(3)).astype(np.int64) % (64 * BITMAP_WORDS), minlength=64 * BITMAP_WORDS) & 1
                bits[row] = np.packbits(parity.astype(np.uint8), bitorder="little").view(np.uint64)
            values = _as_long(np.concatenate(lists)) if lists else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n),
                    pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(values)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(batch) + 1) * BITMAP_WORDS, pa.int32()), pa.array(_as_long(bits).ravel())
                    ),
                ],
                ["doc_id", "n", "prefix", "bits"],
            )

    return run


def _parts_of_sets(width: int, end: int):
    """Size of each set and its shingles below ``end``, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.slice(start, 500)
                n, packed = [], []
                for _, own in _sets(part, width):
                    n.append(len(own))
                    packed.append(own[: np.searchsorted(own, np.uint64(end), "right")].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(packed, pa.binary())], ["node", "n", "packed"]
                )

    return run


def possible_pairs(
    left: list[np.ndarray], right: list[np.ndarray], n_left: np.ndarray, n_right: np.ndarray, percent: int = PERCENT
) -> np.ndarray:
    """Which pairs of sets may link, as far as the given parts of them tell; whole sets tell it exactly.

    ``left`` and ``right`` are sorted and hold all shingles of the two sets in one range; ``n_left`` and ``n_right`` are the whole sizes. The columns are
    taken in ranges of the hash. After each, what is left of the smaller side bounds what a pair can still gain.
    """
    need, count = _required(n_left, n_right, percent), np.zeros(len(left), np.int64)
    seen_left, seen_right = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    alive = np.minimum(n_left, n_right) >= need
    top = max((int(x[-1]) for side in (left, right) for x in side if len(x)), default=0) + 1
    edges = np.array([block * top // COLUMN_BLOCKS for block in range(1, COLUMN_BLOCKS)], np.uint64)
    cut_left = [np.concatenate([[0], np.searchsorted(x, edges), [len(x)]]) for x in left]
    cut_right = [np.concatenate([[0], np.searchsorted(x, edges), [len(x)]]) for x in right]
    for block in range(COLUMN_BLOCKS):
        pairs = np.flatnonzero(alive)
        if not len(pairs):
            break
        parts, owners = [], []
        for side, cuts in ((left, cut_left), (right, cut_right)):
            for k in pairs.tolist():
                part = side[k][cuts[k][block] : cuts[k][block + 1]]
                parts.append(part)
                owners.append(len(part))
        owner = np.repeat(np.concatenate([pairs, pairs]), owners)
        column = np.concatenate(parts)
        order = np.lexsort((column, owner))
        owner, column = owner[order], column[order]
        same = (owner[1:] == owner[:-1]) & (column[1:] == column[:-1])  # a set has a shingle once
        count += np.bincount(owner[1:][same], minlength=len(left))
        seen_left[pairs] += owners[: len(pairs)]
        seen_right[pairs] += owners[len(pairs) :]
        alive &= count + np.minimum(n_left - seen_left, n_right - seen_right) >= need
    return alive


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.slice(start, 500)
                left, right = (
                    [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column(name)] for name in ("packed_a", "packed_b")
                )
                n_left, n_right = (part.column(name).to_numpy() for name in ("n_a", "n_b"))
                found = pa.array(possible_pairs(left, right, n_left, n_right, percent))
                yield pa.RecordBatch.from_arrays(
                    [part.column("a").filter(found), part.column("b").filter(found)], ["a", "b"]
                )

    return run


def _verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are over the threshold: by a quarter of the columns, then by all."""
    pairs = materialize(pairs.distinct())
    for end in (1 << 62, (1 << 64) - 1):
        ids = materialize(
            pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
        )
        wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        sets = materialize(
            docs.join(wanted, "doc_id", "left_semi").mapInArrow(_parts_of_sets(width, end), "node long, n long, packed binary")
        )
        side = lambda name: sets.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("packed").alias(f"packed_{name}"))
        joined = pairs.join(side("a"), "a").join(side("b"), "b")
        left = materialize(joined.mapInArrow(_linked(percent), "a long, b long").distinct())
        discard(pairs, ids, sets)
        pairs = left
    return pairs


def _sizes_allow(percent: int, x: str, y: str) -> Column:
    low, high = F.least(f"{x}.n", f"{y}.n"), F.greatest(f"{x}.n", f"{y}.n")
    return F.lit(100) * low >= F.lit(percent) * high


def _possible(percent: int, x: str, y: str) -> Column:
    """Size and position bounds of two postings of one shingle, taking it for the first that they share."""
    col = lambda side, name: F.col(f"{side}.{name}")
    need = F.ceil(F.lit(percent) * (col(x, "n") + col(y, "n")) / F.lit(100 + percent))
    left = F.least(col(x, "n") - col(x, "pos"), col(y, "n") - col(y, "pos"))  # from this shingle on, itself included
    return _sizes_allow(percent, x, y) & (left >= need)


def jaccard_components(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, n_shingles, component_id)``.

    Words are runs of other than ASCII white space with A-Z in lower case. A document's set holds its
    distinct shingles of ``width`` words; of fewer words, the whole sequence is one shingle. Two documents
    link when their sets' Jaccard similarity is ``percent`` or more; the component id is the smallest id reachable by links.

    A null, empty or blank text has an empty set, links with nothing and is its own component. Rows without an id
    take no part and get a null component. Rows that share an id but not a text are treated as linked. An empty table gives
    no rows; other columns of ``docs`` are ignored. Sets are kept as 64-bit hashes and equal sets are told by 128 bits.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    told = materialize(
        docs.mapInArrow(_keys_and_counts(width), "doc_id long, n long, key_a long, key_b long, shingle long, times long")
    )
    keyed = told.where("n is not null").drop("shingle", "times")
    key = ["key_a", "key_b", "n"]
    classes = materialize(keyed.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("node")).where("node is not null"))
    member = materialize(
        keyed.where("n > 0 and doc_id is not null").join(classes, key).select("doc_id", "n", "node")
    )  # rows of one key may be very many: adaptive execution splits such a side of a join

    docs = _once(docs, keyed)
    hints = (
        told.where("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("n"))
        .where(F.col("n") >= _HINT_COUNT).orderBy(F.desc("n"), "shingle").limit(ORDER_HINTS).toArrow()
    )
    frequent = hints.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(frequent)
    shared = spark.sparkContext.broadcast((frequent[order], hints.column("n").to_numpy()[order]))

    # rows with one id and several texts
    several = materialize(member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("top")).where("a < top"))
    copies = materialize(member.where("doc_id <> node").join(several, "doc_id", "left_anti").select("doc_id").distinct())
    dropped = F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies
    nodes = materialize(
        docs.where("doc_id is not null").join(dropped, "doc_id", "left_anti")
        .mapInArrow(_prefixes(width, percent, shared), "doc_id long, n long, prefix array<long>, bits array<long>")
        .where("n > 0").withColumnRenamed("doc_id", "node")
    )
    entries = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "shingle"))
    met = materialize(entries.groupBy("shingle").count().where("count > 1").select("shingle"))
    tidy_driver(spark, 0)  # each shuffle of all entries goes before the next one comes
    postings = materialize(entries.join(met.hint("merge"), "shingle"))
    discard(met)
    tidy_driver(spark, 0)

    links = materialize(member.join(several, "doc_id").select("a", F.col("node").alias("b")).distinct())
    label = None
    for turn in range(STAR_ROUNDS + 1):
        if turn or not links.isEmpty():
            label = components(links)
        placed = _placed(postings, label)
        if turn < STAR_ROUNDS:
            pairs = _star_pairs(placed, turn, percent)
        else:
            full = _described(placed, nodes, discard_after=[postings, nodes])
            pairs = materialize(_cross_pairs(full, percent).distinct())
            discard(full)
            tidy_driver(spark, 0)
        links = links.unionByName(_verified(docs, pairs, width, percent))
    label = components(links)

    named = member.join(label, "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("component_id"))
    single = keyed.where("n = 0 or doc_id is null").select(
        "doc_id", "n", F.col("doc_id").alias("component_id")
    )
    return named.unionByName(single).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _once(docs: DataFrame, keyed: DataFrame) -> DataFrame:
    """``docs`` with rows that agree in id and text folded into one; only rows of repeated ids are shuffled."""
    repeated = materialize(keyed.where("n > 0 and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return docs
    several = broadcast_if_small(repeated)
    once = materialize(docs.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))
    return docs.join(several, "doc_id", "left_anti").unionByName(once)


def _placed(postings: DataFrame, label: DataFrame | None) -> DataFrame:
    """Postings with their node's component so far, of shingles that meet in several components."""
    if label is None:
        return postings.withColumn("component", F.col("node"))
    placed = postings.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(mixed.where("low < high").select("shingle"), "shingle")


def _star_pairs(placed: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each node with the centres of its shingles: the least node, in later rounds the least by a hash.

    The nodes of a group so tend to have the same centre, whichever shingles they share.
    """
    draw = F.xxhash64("node", F.lit(turn)) if turn else F.col("node")
    drawn = F.struct(draw.alias("draw"), "node", "n", "component")
    centres = placed.groupBy("shingle").agg(F.min(drawn).alias("c")).select("shingle", "c.node", "c.n", "c.component")
    x, y = placed.alias("x"), centres.alias("y")
    apart = (F.col("x.component") != F.col("y.component")) & _sizes_allow(percent, "x", "y")
    return x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & apart).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    )


def _described(placed: DataFrame, nodes: DataFrame, discard_after: list[DataFrame]) -> DataFrame:
    """Postings with their shingle's most frequent component, their set's bitmap and the set's postings just before.

    Rows with one id and several texts share a node; where such texts are of one size too, their postings can't be told apart and have none before.
    """
    placed = materialize(placed)
    sizes = placed.groupBy("shingle", "component").agg(F.count("*").alias("nodes"))
    main = sizes.groupBy("shingle").agg(F.max(F.struct("nodes", "component"))["component"].alias("main"))
    one_set = Window.partitionBy("node", "n")  # as the join below, so that they share a shuffle
    sets = nodes.select("node", "n", "bits", (F.count("*").over(one_set) == 1).alias("alone"))
    in_order = one_set.orderBy("pos")
    earlier = F.array(*[F.lag("shingle", i).over(in_order) for i in range(1, EARLIER + 1)])
    full = materialize(
        placed.join(main, "shingle").withColumn("earlier", earlier).join(sets, ["node", "n"])
        .withColumn("earlier", F.when(F.col("alone"), F.col("earlier"))).drop("alone")
    )
    discard(placed, *discard_after)
    tidy_driver(placed.sparkSession, 0)
    return full


def _cross_pairs(full: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that may link.

    In each shingle, only nodes outside its most frequent component are joined with the rest. Besides sizes and positions,
    the parity bitmaps bound the overlap: differing bits are shingles that the two sets don't share. A pair is left out where it
    shares one of the postings just before, as it has met there: the first shingle that it shares always names it, few others do.
    """
    x, y = full.where("component <> main").alias("x"), full.alias("y")
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    apart = (F.col("x.component") != F.col("y.component")) & once & _possible(percent, "x", "y")
    differing = sum(
        (F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(BITMAP_WORDS)), F.lit(0)
    )
    total = F.col("x.n") + F.col("y.n")
    enough = F.lit(100 + percent) * (total - differing) >= F.lit(2 * percent) * total
    first = ~F.coalesce(F.arrays_overlap("x.earlier", "y.earlier"), F.lit(False))
    return x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & apart & enough & first).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    )
