"""First-wins duplicate resolution in image order (D5), and what follows from it.

An image is kept unless an earlier *kept* image of its keyword resembles it. That is the
lexicographically first maximal independent set, not connected components: a removed image
removes nobody.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftloom.operators.simjoin import KEY, home_rows, probe_rows
from weftloom.session import discard, materialize, small_or_sorted

KEPT, UNKNOWN, REMOVED = 0, 1, 2


@dataclass(frozen=True)
class Portions:
    """How the work is cut; results do not depend on it.

    Cells of more than ``cell_rows`` images are checked for look-alikes by the thousand, and together
    get about ``pairs_per_image`` pairs for every image in the first round. Edges are
    settled in order, by one task per keyword, once at most ``finish_edges`` are open.
    """

    cell_rows: int = 512
    pairs_per_image: float = 64.0
    finish_edges: int = 100_000


STATE_SCHEMA = "keyword string, image_id long, state string"


def _in_order(edges: pa.Table) -> pa.Table:
    """Settle the few edges of one keyword, image after image."""
    a, b = edges.column("a").to_numpy(), edges.column("b").to_numpy()
    ids, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    a_place, b_place = places[: len(a)], places[len(a) :]
    waits = np.zeros(len(ids), dtype=bool)
    waits[a_place] |= edges.column("a_waits").to_numpy()
    waits[b_place] |= edges.column("b_waits").to_numpy()
    state = np.where(waits, UNKNOWN, KEPT)
    order = np.argsort(b_place, kind="stable")
    a_place = a_place[order]
    ends, starts = np.unique(b_place[order], return_index=True)
    for place, earlier in zip(ends, np.split(a_place, starts[1:])):
        before = state[earlier]
        if (before == KEPT).any():
            state[place] = REMOVED
        elif (before == UNKNOWN).any():
            state[place] = UNKNOWN
    names = np.array(["kept", "unknown", "removed"], dtype=object)
    keyword = edges.column("keyword")[0].as_py()
    return pa.table({
        "keyword": pa.array([keyword] * len(ids), pa.string()),
        "image_id": pa.array(ids, pa.int64()),
        "state": pa.array(names[state], pa.string()),
    })


def settle(edges: DataFrame, waiting: DataFrame | None = None, finish_edges: int = Portions.finish_edges) -> DataFrame:
    """State of every image that occurs in ``edges`` (``keyword, a, b`` with ``a < b``), a materialized table.

    ``waiting`` lists images that may still have earlier look-alikes which are not among the edges:
    these can be removed but not kept, and end as ``unknown`` together with whatever depends on
    them. The result has ``kept``, ``removed`` and ``unknown`` rows.

    By rounds: an image without an open earlier neighbour is kept, its later neighbours are removed, and
    edges of removed images go. Once at most ``finish_edges`` edges are open they are settled in
    order by one task per keyword, since a long chain would need a round for every two images.
    """
    live = edges.select("keyword", "a", "b")
    if waiting is None:
        live = live.withColumn("a_waits", F.lit(False)).withColumn("b_waits", F.lit(False))
    else:
        waiting = small_or_sorted(waiting)
        for side in ("a", "b"):
            mark = waiting.select("keyword", F.col("image_id").alias(side), F.lit(True).alias(f"{side}_waits"))
            live = live.join(mark, ["keyword", side], "left").fillna(False, [f"{side}_waits"])
        live = materialize(live)
    states = []
    while live.count() > finish_edges:
        heads = live.select("keyword", F.col("a").alias("image_id"), F.col("a_waits").alias("waits"))
        tails = live.select("keyword", F.col("b").alias("image_id"))
        kept = materialize(
            heads.where("not waits").select(*KEY).distinct().join(tails.hint("merge"), KEY, "left_anti")
        )
        as_side = lambda df, side: df.select("keyword", F.col("image_id").alias(side))
        kept_side = small_or_sorted(kept)
        removed = materialize(
            live.join(as_side(kept_side, "a"), ["keyword", "a"], "left_semi").select("keyword", F.col("b").alias("image_id")).distinct()
        )
        if removed.isEmpty():  # all that is left hangs on waiting images
            both = live.select("keyword", F.explode(F.array("a", "b")).alias("image_id")).distinct()
            states.append(both.withColumn("state", F.lit("unknown")))
            live = live.limit(0)
            break
        states += [kept.withColumn("state", F.lit("kept")), removed.withColumn("state", F.lit("removed"))]
        removed_side = small_or_sorted(removed)
        rest = live.join(as_side(removed_side, "a"), ["keyword", "a"], "left_anti").join(
            as_side(removed_side, "b"), ["keyword", "b"], "left_anti"
        )
        # images that lost their last edge without being removed
        touched = live.select("keyword", F.explode(F.array(
            F.struct(F.col("a").alias("image_id"), F.col("a_waits").alias("waits")),
            F.struct(F.col("b").alias("image_id"), F.col("b_waits").alias("waits")),
        )).alias("n")).select("keyword", "n.*").distinct()
        rest = materialize(rest)
        still = rest.select("keyword", F.explode(F.array("a", "b")).alias("image_id")).distinct()
        freed = touched.join(still.hint("merge"), KEY, "left_anti").join(removed_side, KEY, "left_anti").join(kept_side, KEY, "left_anti")
        states.append(materialize(freed.select(*KEY, F.when(F.col("waits"), "unknown").otherwise("kept").alias("state"))))
        live = rest
    result = live.groupBy("keyword").applyInArrow(_in_order, STATE_SCHEMA)
    for part in states:
        result = result.unionByName(part)
    return result


def _crowd_limits(assigned: DataFrame, index, cell_rows: int, per_image: float) -> DataFrame | None:
    """``(keyword, cell, limit)`` for the large cells with far more similar pairs than their part of ``per_image`` a row.

    In cells of more than ``cell_rows`` images about that many, drawn by hash, are compared to
    estimate their pairs. ``limit`` is an id up to which about the cell's part is expected. The draw
    only decides how the work is portioned, never what is compared in the end.
    """
    feature = index.feature
    homes, probes = home_rows(assigned, feature), probe_rows(assigned, feature)
    large = homes.groupBy("keyword", "cell").count().where(F.col("count") > cell_rows)
    cells = large.count()
    if not cells:
        return None
    cell_pairs = per_image * assigned.count() / cells
    large = materialize(large.select("keyword", "cell", (F.lit(cell_rows) / F.col("count")).alias("share")))
    drawn = F.pmod(F.xxhash64("image_id"), F.lit(1 << 40)) < F.col("share") * (1 << 40)
    large = small_or_sorted(large)
    draw = lambda rows: rows.join(large, ["keyword", "cell"]).where(drawn).drop("share")
    halves = F.percentile("b", [0.5**i for i in range(1, 31)], F.col("n"))
    counts = index.tally(draw(homes), draw(probes)).groupBy("keyword", "cell", "b").agg(F.sum("n").alias("n"))  # the pairs themselves can be many thousands a row
    pairs = counts.groupBy("keyword", "cell").agg(F.sum("n").alias("n"), halves.alias("ids"))
    expected = F.col("n") / (F.col("share") * F.col("share"))
    halvings = F.least(F.ceil(F.log2(expected / cell_pairs)), F.lit(30)).cast("int")
    limits = materialize(
        pairs.join(large, ["keyword", "cell"])
        .where(expected > 2 * cell_pairs)
        .select("keyword", "cell", F.element_at("ids", halvings).cast("long").alias("limit"))
    )
    return None if limits.isEmpty() else small_or_sorted(limits)


def _within(rows: DataFrame, limits: DataFrame, inside: bool) -> DataFrame:
    marked = rows.join(limits, ["keyword", "cell"], "left")
    fits = F.col("limit").isNull() | (F.col("image_id") <= F.col("limit"))
    return marked.where(fits if inside else ~fits).drop("limit")


def _later_copies(items: DataFrame, feature: str) -> DataFrame:
    """``(keyword, image_id, first_id)`` of every image whose feature an earlier image has exactly.

    Only a digest of the feature is grouped for all images; the features themselves are compared where
    a digest occurs more than once.
    """
    marked = items.select(*KEY, feature, F.xxhash64(feature).alias("digest"))
    shared = materialize(marked.groupBy("keyword", "digest").agg(F.count("*").alias("n")).where("n > 1").select("keyword", "digest"))
    suspects = marked.join(small_or_sorted(shared), ["keyword", "digest"], "left_semi")
    firsts = suspects.groupBy("keyword", "digest", feature).agg(F.min("image_id").alias("first_id"))
    return materialize(
        suspects.join(firsts.hint("merge"), ["keyword", "digest", feature]).where("image_id <> first_id").select(*KEY, "first_id")
    )


def first_wins(
    items: DataFrame,
    index,
    portions: Portions = Portions(),
) -> DataFrame:
    """Decide every image of ``items(keyword, image_id, <feature>)``: ``keyword, image_id, kept, removed_by``.

    The pairs are never all listed:

    * images with equal features share their fate, bar that only the first of them can be
      kept, so that one stands for them;
    * where a cell is crowded with look-alikes, only its first images, up to a number of pairs that
      is set by ``portions``, are compared with each other; those settled that way remove their look-alikes from
      the rest, which is linear in the rest, before the next portion with up to four times as many.

    A large group of near copies thus shrinks to the few kept ones in the first round.
    """
    items = items.select(*KEY, index.feature)
    feature = index.feature
    copies = _later_copies(items, feature)
    representatives = items.join(small_or_sorted(copies.select(*KEY)), KEY, "left_anti")
    active = assigned = index.assign(materialize(representatives))
    decided = None
    direct_edges = None
    finish_edges = portions.finish_edges
    per_image = portions.pairs_per_image
    while True:
        limits = _crowd_limits(active, index, portions.cell_rows, per_image)
        if limits is None:
            edges = materialize(index.pairs(active))
            if decided is None:
                direct_edges = edges
            states = materialize(settle(edges, None, finish_edges))
            fate = active.select(*KEY).join(small_or_sorted(states), KEY, "left").select(
                *KEY, (F.coalesce("state", F.lit("kept")) == "kept").alias("kept")
            )
            decided = fate if decided is None else decided.unionByName(fate)
            break
        homes, probes = home_rows(active, feature), probe_rows(active, feature)
        edges = materialize(index.match(_within(homes, limits, True), _within(probes, limits, True)))
        waiting = materialize(_within(probes, limits, False).select(*KEY).distinct())
        states = settle(edges, waiting, finish_edges)
        fate = materialize(
            active.select(*KEY)
            .join(states.hint("merge"), KEY, "left")
            .join(small_or_sorted(waiting).withColumn("waits", F.lit(True)), KEY, "left")
            .select(*KEY, F.coalesce("state", F.when(F.col("waits"), "unknown").otherwise("kept")).alias("state"))
        )
        settled = fate.where("state <> 'unknown'").select(*KEY, (F.col("state") == "kept").alias("kept"))
        open_rows = active.join(small_or_sorted(fate.where("state = 'unknown'").select(*KEY)), KEY, "left_semi")
        hot = limits.select("keyword", "cell")
        late = _within(probe_rows(open_rows, feature), limits, False)
        keepers = homes.join(small_or_sorted(settled.where("kept").select(*KEY)), KEY, "left_semi").join(hot, ["keyword", "cell"], "left_semi")
        peeled = materialize(
            index.match(keepers, late, nearest_only=True).select("keyword", F.col("b").alias("image_id")).distinct()
        )
        fate_now = settled.unionByName(peeled.withColumn("kept", F.lit(False)))
        decided = fate_now if decided is None else decided.unionByName(fate_now)
        before, active = active, materialize(open_rows.join(small_or_sorted(peeled), KEY, "left_anti"))
        discard(edges, waiting, *([] if before is assigned else [before]))
        per_image *= 4

    if direct_edges is not None:
        decided = materialize(decided)
        kept = small_or_sorted(decided.where("kept").select("keyword", F.col("image_id").alias("a")))
        candidates = direct_edges.join(kept, ["keyword", "a"], "left_semi")
    else:
        decided = materialize(decided)
        side = lambda keep: assigned.join(small_or_sorted(decided.where(F.col("kept") == keep).select(*KEY)), KEY, "left_semi")
        candidates = index.match(home_rows(side(True), feature), probe_rows(side(False), feature), nearest_only=True)
    removers = candidates.groupBy("keyword", F.col("b").alias("image_id")).agg(F.min("a").alias("removed_by"))
    fates = decided.join(removers.hint("merge"), KEY, "left").select(*KEY, "kept", "removed_by")
    # a copy goes with its first: removed by it if that is kept, otherwise by what removed that
    by_first = fates.select(
        "keyword",
        F.col("image_id").alias("first_id"),
        F.when(F.col("kept"), F.col("image_id")).otherwise(F.col("removed_by")).alias("removed_by"),
    )
    copied = copies.join(by_first.hint("merge"), ["keyword", "first_id"]).select(*KEY, F.lit(False).alias("kept"), "removed_by")
    return fates.unionByName(copied)


def greedy_dedup(nodes: DataFrame, edges: DataFrame, finish_edges: int = Portions.finish_edges) -> DataFrame:
    """First-wins resolution of given edges over ``nodes(keyword, image_id)``."""
    edges = materialize(edges.select("keyword", "a", "b"))
    states = materialize(settle(edges, None, finish_edges))
    kept = small_or_sorted(states.where("state = 'kept'").select("keyword", F.col("image_id").alias("a")))
    removers = (
        edges.join(kept, ["keyword", "a"], "left_semi")
        .groupBy("keyword", F.col("b").alias("image_id"))
        .agg(F.min("a").alias("removed_by"))
    )
    return nodes.select(*KEY).join(removers.hint("merge"), KEY, "left").select(
        *KEY, F.col("removed_by").isNull().alias("kept"), "removed_by"
    )


def dedup_counts(decisions: DataFrame) -> DataFrame:
    """Kept and removed images per keyword and layer."""
    return decisions.groupBy("keyword", "layer").agg(
        F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("removed")
    )


def review_pairs(band: DataFrame, decisions: DataFrame) -> DataFrame:
    """Band pairs ``(keyword, a, b, score)`` that reach the review queue.

    ``a`` must be kept, and ``b`` must not have been removed by an image before ``a``; it may
    well be removed later, by one after ``a``.
    """
    kept = decisions.where("kept").select("keyword", F.col("image_id").alias("a"))
    removed = decisions.where("removed_by is not null").select("keyword", F.col("image_id").alias("b"), "removed_by")
    return (
        band.join(kept.hint("merge"), ["keyword", "a"], "left_semi")
        .join(removed.hint("merge"), ["keyword", "b"], "left")
        .where("removed_by is null or removed_by > a")
        .select("keyword", "a", "b", "score")
    )
