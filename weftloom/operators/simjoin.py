"""Exact similarity self-joins inside a keyword.

Each index turns an image into cells: ``homes``, the cells it is stored in, and ``probes``, the
cells in which an image similar to it may be stored (``assign``, cheap to evaluate again). Two images are compared only where a cell of
one meets a cell of the other, and every similar pair ``a < b`` is reported exactly once: ``a`` at
home, ``b`` probing (``match``, which also names the cell); where all pairs are wanted, each unordered pair of places is
looked at once (``pairs``). No index is approximate; a poor choice of cells only costs time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from weftloom.functions import images
from weftloom.functions.vectors import hamming
from weftloom.session import discard, materialize, small_or_sorted

KEY = ["keyword", "image_id"]
PAIR_SCHEMA = "keyword string, cell {cell}, a long, b long, score double"
SLACK = 1e-9
DISTANCE_SLACK = 1e-6  # of distances that come from cosines: near 0 the root makes 1e-16 into 1e-8
MAX_SHELLS = 64
#: About what a task of ``StructureIndex`` takes for a pair's windows, for an image's summary, and for a place of the product of two summaries.
VERIFY_S, SUMMARY_S, PRODUCT_S = 3e-4, 2e-3, 2e-11
SUMMARY_BYTES, BOUND_ROWS, BOUND_COLUMNS = 230_000_000, 256, 1024


def _one_cell(items: DataFrame, *features: str) -> DataFrame:
    only = F.array(F.lit(0))
    return items.select(*KEY, *features).withColumn("homes", only).withColumn("probes", only)


def _meet(homes: DataFrame, probes: DataFrame, feature: str) -> DataFrame:
    """Pairs sharing a cell, as an equi-join; never broadcast, as rows come in many cells, which the size of their files does not tell."""
    left = homes.select("keyword", "cell", F.col("image_id").alias("a"), F.col(feature).alias("a_feature"))
    right = probes.select("keyword", "cell", F.col("image_id").alias("b"), F.col(feature).alias("b_feature"))
    return left.join(right.hint("merge"), ["keyword", "cell"]).where("a < b")


def _spread(rows: DataFrame, own_blocks: str, other_blocks: str, own: str, other: str) -> DataFrame:
    """Give a row one block of its own side and a copy for every block of the other side."""
    return rows.withColumn(own, F.pmod(F.xxhash64("image_id"), F.col(own_blocks)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1))
    )


def _dealt(rows: DataFrame, task: list[str], number: int | None, block_rows: int, together: float) -> DataFrame:
    """``number`` rows dealt to partitions of some ``together`` pairs of blocks, where the session's partitions would hold more than that."""
    partitions = math.ceil((number or 0) / (2 * together * block_rows))
    return rows.repartition(partitions, *task) if partitions > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def _compare_in_blocks(
    homes: DataFrame, probes: DataFrame, feature: str, block_rows: int, score, nearest_only: bool, large_block_rows: int | None = None,
    in_order: bool = True, together: float = 16, tally: bool = False,
) -> DataFrame:
    """Compare home and probe rows of each cell in tasks of about ``block_rows`` × ``block_rows``.

    With ``tally``, a row ``keyword, cell, b, n`` for each probe row with pairs in a task, instead of its n pairs. With ``in_order``, only pairs whose home row has the smaller id. A cell larger than that, however hot, is cut into blocks on both sides. Every row is sent to all
    blocks of the other side, so cells of many blocks may use ``large_block_rows`` instead.
    """
    rows_of = F.when(F.count("*") > 32 * block_rows, large_block_rows or block_rows).otherwise(block_rows)
    size = lambda rows, name: rows.groupBy("keyword", "cell").agg(F.ceil(F.count("*") / rows_of).cast("int").alias(f"{name}_blocks"), F.count("*").alias(name))
    blocks = materialize(size(homes, "home").join(size(probes, "probe"), ["keyword", "cell"]))  # a row for each cell
    number = blocks.agg(F.sum(F.col("home") * F.col("probe_blocks") + F.col("probe") * F.col("home_blocks"))).first()[0]
    blocks = small_or_sorted(blocks.drop("home", "probe"))
    columns = ["keyword", "cell", "image_id", F.col(feature).alias("feature"), "home_blocks", "probe_blocks"]
    left = homes.join(blocks, ["keyword", "cell"]).select(*columns)
    right = probes.join(blocks, ["keyword", "cell"]).select(*columns)
    rows = (
        _spread(left, "home_blocks", "probe_blocks", "home_block", "probe_block")
        .withColumn("at_home", F.lit(True))
        .unionByName(
            _spread(right, "probe_blocks", "home_blocks", "probe_block", "home_block").withColumn("at_home", F.lit(False))
        )
        .drop("home_blocks", "probe_blocks")
    )

    def compare(table: pa.Table) -> pa.Table:
        at_home = table.column("at_home").to_numpy()
        ids = table.column("image_id").to_numpy()
        home, probe = np.flatnonzero(at_home), np.flatnonzero(~at_home)
        wanted = ids[home][:, None] < ids[probe][None, :] if in_order else _others(ids[home], ids[probe])
        i, j, s = score(table.column("feature"), home, probe, wanted)
        a, b = ids[home][i], ids[probe][j]
        if tally:
            b, n = np.unique(b, return_counts=True)
            return _pair_table(table, b, b, n).select(["keyword", "cell", "b", "score"])
        if nearest_only and len(a):
            order = np.lexsort((a, b))
            first = order[np.r_[True, b[order][1:] != b[order][:-1]]]
            a, b, s = a[first], b[first], s[first]
        return _pair_table(table, a, b, s)

    task = ["keyword", "cell", "home_block", "probe_block"]
    if tally:
        schema = _pair_schema(homes).replace("a long, ", "")
        counted = _dealt(rows, task, number, block_rows, together).groupBy(*task).applyInArrow(compare, schema)
        return counted.select("keyword", "cell", "b", F.col("score").cast("long").alias("n"))
    return _dealt(rows, task, number, block_rows, together).groupBy(*task).applyInArrow(compare, _pair_schema(homes))


def _others(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of two ids that differ; a missing one, not a number here, pairs with nothing."""
    return (a[:, None] < b[None, :]) | (a[:, None] > b[None, :])


def _pair_schema(rows: DataFrame) -> str:
    return PAIR_SCHEMA.format(cell=rows.schema["cell"].dataType.simpleString())


def _pair_table(table: pa.Table, a: np.ndarray, b: np.ndarray, s: np.ndarray) -> pa.Table:
    keyword = pa.array([table.column("keyword")[0].as_py()] * len(a), pa.string())
    cell = pa.array([table.column("cell")[0].as_py()] * len(a), table.schema.field("cell").type)
    pairs = [pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())]
    return pa.table([keyword, cell, *pairs, pa.array(s, pa.float64())], ["keyword", "cell", "a", "b", "score"])


def _compare_inside(
    rows: DataFrame, feature: str, block_rows: int, score, large_block_rows: int | None = None, together: float = 16,
) -> DataFrame:
    """Compare the rows of each cell with each other, every unordered pair of blocks in one task.

    A row of block i goes to the tasks {i, 0}, {i, 1} ... of its cell, half as many places as if homes and probes were kept apart.
    """
    rows_of = F.when(F.count("*") > 32 * block_rows, large_block_rows or block_rows).otherwise(block_rows)
    blocks = materialize(rows.groupBy("keyword", "cell").agg(F.ceil(F.count("*") / rows_of).cast("int").alias("blocks"), F.count("*").alias("n")))
    number = blocks.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0]
    dealt = (
        rows.join(small_or_sorted(blocks.drop("n")), ["keyword", "cell"])
        .select("keyword", "cell", "image_id", F.col(feature).alias("feature"), "blocks", F.pmod(F.xxhash64("image_id"), F.col("blocks")).cast("int").alias("own"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("keyword", "cell", "image_id", "feature", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )

    def compare(table: pa.Table) -> pa.Table:
        ids, own = table.column("image_id").to_numpy(), table.column("own").to_numpy()
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        home, probe = np.flatnonzero(own == low), np.flatnonzero(own == high)
        wanted = ids[home][:, None] < ids[probe][None, :] if low == high else _others(ids[home], ids[probe])
        i, j, s = score(table.column("feature"), home, probe, wanted)
        return _pair_table(table, ids[home][i], ids[probe][j], s)

    task = ["keyword", "cell", "low", "high"]
    return _dealt(dealt, task, number, block_rows, together).groupBy(*task).applyInArrow(compare, _pair_schema(rows))


@dataclass(frozen=True)
class HammingIndex:
    """Pairs of 64-bit hashes at distance at most ``max_distance``.

    Multi-index hashing: of ``m`` chunks of the hash one differs in at most ``max_distance // m``
    bits. The chunk count is chosen so that this is 2 or less; then both hashes are stored under every
    chunk value within one bit, where they meet half way. That takes about 70 keys per hash at
    distance 8, instead of about 700 on one side. From distance 12 on the chunks get so short
    that nearly all hashes meet, and the keyword is compared in blocks instead.
    """

    max_distance: int
    feature: str = "bits"
    block_rows: int = 4096

    @property
    def in_blocks(self) -> bool:
        return self.max_distance >= 12

    @property
    def chunks(self) -> list[tuple[int, int, int]]:
        """(number, first bit, width) of each chunk."""
        count = max(2, self.max_distance // 3 + 1)
        edges = [round(64 * i / count) for i in range(count + 1)]
        return [(i, lo, hi - lo) for i, (lo, hi) in enumerate(zip(edges, edges[1:]))]

    @property
    def radius(self) -> int:
        return self.max_distance // len(self.chunks)

    def _chunk(self, bits: Column, lo: int, width: int) -> Column:
        return F.shiftrightunsigned(bits, lo).bitwiseAND(F.lit((1 << width) - 1))

    def _cell(self, number: int, value: Column) -> Column:
        return F.shiftleft(F.lit(number).cast("long"), 33).bitwiseOR(value)

    def assign(self, items: DataFrame) -> DataFrame:
        if self.in_blocks:
            return _one_cell(items, self.feature)
        cells = []
        for number, lo, width in self.chunks:
            value = self._chunk(F.col(self.feature), lo, width)
            cells.append(self._cell(number, value))
            if self.radius:
                cells += [self._cell(number, value.bitwiseXOR(F.lit(1 << i))) for i in range(width)]
        with_cells = items.select(*KEY, self.feature, F.array(*cells).alias("homes"))
        return with_cells.withColumn("probes", F.col("homes"))

    def match(self, homes: DataFrame, probes: DataFrame, nearest_only: bool = False) -> DataFrame:
        if self.in_blocks:
            return _compare_in_blocks(homes, probes, self.feature, self.block_rows, self._score(), nearest_only)
        pairs = _meet(homes, probes, self.feature)
        # A pair can meet in several cells; the one that counts is in the first chunk within the
        # radius, at the first hash's own value or, when two bits apart, with the lowest of them flipped.
        counts, taken = F.lit(False), F.lit(False)
        for number, lo, width in self.chunks:
            a = self._chunk(F.col("a_feature"), lo, width)
            difference = a.bitwiseXOR(self._chunk(F.col("b_feature"), lo, width))
            near = F.bit_count(difference) <= self.radius
            middle = F.when(F.bit_count(difference) <= 1, a).otherwise(a.bitwiseXOR(difference.bitwiseAND(-difference)))
            counts = counts | (near & ~taken & (F.col("cell") == self._cell(number, middle)))
            taken = taken | near
        distance = hamming(F.col("a_feature"), F.col("b_feature"))
        found = pairs.where(distance <= self.max_distance).where(counts)
        return found.select("keyword", "cell", "a", "b", distance.cast("double").alias("score"))

    def tally(self, homes: DataFrame, probes: DataFrame) -> DataFrame:
        """``keyword, cell, b, n``: the number of pairs of ``match`` by probe row, in one row or several."""
        if self.in_blocks:
            return _compare_in_blocks(homes, probes, self.feature, self.block_rows, self._score(), False, tally=True)
        return self.match(homes, probes).groupBy("keyword", "cell", "b").agg(F.count("*").alias("n"))

    def pairs(self, assigned: DataFrame) -> DataFrame:
        homes = home_rows(assigned, self.feature)
        if self.in_blocks:
            return _compare_inside(homes, self.feature, self.block_rows, self._score())
        return self.match(homes, probe_rows(assigned, self.feature))

    def _score(self):
        limit = self.max_distance

        def score(column, home, probe, earlier):
            bits = column.to_numpy().view(np.uint64)
            distance = np.bitwise_count(bits[home][:, None] ^ bits[probe][None, :])
            i, j = np.nonzero((distance <= limit) & earlier)
            return i, j, distance[i, j].astype(np.float64)

        return score


@dataclass(frozen=True)
class VectorIndex:
    """Pairs of vectors whose cosine exceeds ``threshold``; with ``centred``, whose correlation does.

    Correlation is the cosine of vectors less their mean. Unit vectors whose cosine exceeds the
    threshold are closer than ``r = sqrt(2 - 2 threshold)``. The index is a metric tree of two levels for every keyword above
    ``cell_rows`` images: an image belongs to the nearest of its keyword's pivots, and there to one of the shells into which
    the pivot's images are cut by their distance from it; a shell is a cell of about ``shell_rows`` images. A similar image lies behind the
    boundary to another pivot by no more than ``r`` allows, and in a shell whose distances differ by ``r`` at most: so an
    image probes the cells that both bounds leave, and no others.

    The number of pivots is bounded by ``max_pivots`` plus one per large keyword, at most twice ``max_pivots`` in all, each with at most
    ``MAX_SHELLS`` limits, so they can be sent to every task.
    """

    threshold: float
    feature: str = "embedding"
    centred: bool = False
    cell_rows: int = 4096
    max_pivots: int = 4096
    block_rows: int = 2048
    shell_rows: int = 1024

    def _unit(self, column) -> np.ndarray:
        return unit_rows(column, self.centred)

    @property
    def radius(self) -> float:
        return math.sqrt(max(0.0, 2 - 2 * self.threshold)) + DISTANCE_SLACK

    def _pivots(self, items: DataFrame) -> dict[str, np.ndarray]:
        sizes = items.groupBy("keyword").count()
        total, largest = sizes.agg(F.sum("count"), F.max("count")).first()
        cell_rows = max(self.cell_rows, math.ceil((total or 0) / self.max_pivots))
        if (largest or 0) <= cell_rows:
            return {}
        large = (
            sizes.where(F.col("count") > cell_rows)
            .select("keyword", (F.ceil(F.col("count") / cell_rows) / F.col("count")).alias("share"))
        ).collect()  # at most max_pivots rows, as each stands for more than total / max_pivots images
        shares = items.sparkSession.createDataFrame(large, "keyword string, share double")
        drawn = F.pmod(F.xxhash64("image_id"), F.lit(1 << 40)) < F.col("share") * (1 << 40)
        chosen = items.join(F.broadcast(shares), "keyword").where(drawn).select("keyword", self.feature).toArrow()
        keywords = np.array(chosen.column("keyword").to_pylist(), dtype=object)
        vectors = self._unit(chosen.column(self.feature)) if len(keywords) else None
        return {k: vectors[keywords == k] for k in set(keywords)}

    def _shells(self, placed: DataFrame) -> dict[str, dict[int, np.ndarray]]:
        """Inner limits of the shells by keyword and pivot, from approximate quantiles of the distances."""
        parts = F.least(F.ceil(F.count("*") / self.shell_rows), F.lit(MAX_SHELLS)).cast("int")
        summary = placed.where("pivot is not null").groupBy("keyword", "pivot").agg(
            parts.alias("parts"), F.percentile_approx("distance", [i / MAX_SHELLS for i in range(1, MAX_SHELLS)], 1000).alias("limits")
        )
        shells: dict[str, dict[int, np.ndarray]] = {}
        for keyword, pivot, parts, limits in summary.collect():  # a row for each pivot
            inner = [limits[i * MAX_SHELLS // parts - 1] for i in range(1, parts)]
            shells.setdefault(keyword, {})[pivot] = np.unique(inner)
        return shells

    def assign(self, items: DataFrame) -> DataFrame:
        items = items.select(*KEY, self.feature)
        pivots = self._pivots(items)
        if not pivots:
            return _one_cell(items, self.feature)
        context = items.sparkSession.sparkContext
        shared, unit, radius = context.broadcast(pivots), self._unit, self.radius

        def nearest(batches):
            for batch in batches:
                keywords = np.array(batch.column("keyword").to_pylist(), dtype=object)
                pivot, distance = np.zeros(len(keywords), np.int64), np.zeros(len(keywords))
                known = np.isin(keywords, list(shared.value))
                vectors = unit(batch.column("feature"))
                for keyword in set(keywords[known]):
                    rows = np.flatnonzero(keywords == keyword)
                    closeness = vectors[rows] @ shared.value[keyword].T
                    pivot[rows] = closeness.argmax(axis=1)
                    distance[rows] = _apart(closeness.max(axis=1))
                columns = [*batch.columns, pa.array(pivot, pa.int32(), mask=~known), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "pivot", "distance"])

        kind = items.schema[self.feature].dataType.simpleString()
        schema = f"keyword string, image_id long, feature {kind}"
        placed = materialize(
            items.withColumnRenamed(self.feature, "feature").mapInArrow(nearest, f"{schema}, pivot int, distance double")
        )
        limits = context.broadcast(self._shells(placed))

        def probe(batches):
            for batch in batches:
                keywords = np.array(batch.column("keyword").to_pylist(), dtype=object)
                own, distance = batch.column("pivot").to_numpy(zero_copy_only=False), batch.column("distance").to_numpy()
                homes, probes = [[0]] * len(keywords), [[0]] * len(keywords)
                vectors = unit(batch.column("feature"))
                for keyword in set(keywords) & set(shared.value):
                    pivot, shells = shared.value[keyword], limits.value.get(keyword, {})
                    between = _apart(pivot @ pivot.T)
                    rows = np.flatnonzero(keywords == keyword)
                    closeness = vectors[rows] @ pivot.T
                    nearest = own[rows].astype(np.int64)
                    gap = closeness[np.arange(len(rows)), nearest][:, None] - closeness
                    reach = gap <= radius * between[nearest] + SLACK
                    first, last = np.zeros(reach.shape, np.int64), np.zeros(reach.shape, np.int64)
                    away = _apart(closeness)
                    for p, inner in shells.items():
                        first[:, p] = np.searchsorted(inner, away[:, p] - radius, "left")
                        last[:, p] = np.searchsorted(inner, away[:, p] + radius, "right")
                    for at, row in enumerate(rows.tolist()):
                        shell = np.searchsorted(shells.get(nearest[at], ()), distance[row], "left")
                        homes[row] = [int(nearest[at] * MAX_SHELLS + shell)]
                        probes[row] = [
                            int(p) * MAX_SHELLS + s for p in np.flatnonzero(reach[at]) if p in shells for s in range(first[at, p], last[at, p] + 1)
                        ]
                columns = [*batch.columns[:3], pa.array(homes, pa.list_(pa.int32())), pa.array(probes, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:3], "homes", "probes"])

        found = placed.mapInArrow(probe, f"{schema}, homes array<int>, probes array<int>")
        assigned = materialize(found.withColumnRenamed("feature", self.feature))
        discard(placed)
        return assigned

    def _score(self):
        unit, threshold = self._unit, self.threshold

        def score(column, home, probe, wanted):
            vectors = unit(column)
            similarity = vectors[home] @ vectors[probe].T
            i, j = np.nonzero((similarity > threshold) & wanted)
            return i, j, similarity[i, j]

        return score

    def match(self, homes: DataFrame, probes: DataFrame, nearest_only: bool = False) -> DataFrame:
        return _compare_in_blocks(homes, probes, self.feature, self.block_rows, self._score(), nearest_only)

    def tally(self, homes: DataFrame, probes: DataFrame) -> DataFrame:
        return _compare_in_blocks(homes, probes, self.feature, self.block_rows, self._score(), False, tally=True)

    def pairs(self, assigned: DataFrame) -> DataFrame:
        """All similar pairs: inside each cell, and between a cell's images and those of lower cells that probe it.

        Both images of a similar pair probe the other's cell, so that it is enough if the one of the lower cell does.
        """
        homes = home_rows(assigned, self.feature)
        upward = F.filter("probes", lambda cell: cell > F.get("homes", F.lit(0)))
        guests = assigned.select(*KEY, self.feature, F.explode(upward).alias("cell"))
        inside = _compare_inside(homes, self.feature, self.block_rows, self._score())
        return inside.unionByName(_compare_in_blocks(homes, guests, self.feature, self.block_rows, self._score(), False, in_order=False))


@dataclass(frozen=True)
class StructureIndex:
    """Pairs of 256 × 256 gray rasters whose structural similarity exceeds ``threshold``.

    The feature is the raster, or the small image it is made from (``images.kept_small``). A keyword is one cell, compared in blocks. Only the images
    are stored and sent; the task of two blocks makes their rasters and summaries of the rasters' windows, whose products bound the similarity of
    all its pairs (``images.structure_bounds``). Finer summaries are made of the images that have a pair left, as long as that costs less
    than looking at the pairs themselves.
    """

    threshold: float
    feature: str = "gray"
    block_rows: int = 6400
    large_block_rows: int | None = None

    def assign(self, items: DataFrame) -> DataFrame:
        return _one_cell(items, self.feature)

    def _left(self, column, home: np.ndarray, probe: np.ndarray, left: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
        """Of the pairs that are true in ``left``, those whose bound exceeds the threshold; the lowest bounds go into ``bounds``."""
        for basis in images.BASES:
            rows, columns = np.flatnonzero(left.any(axis=1)), np.flatnonzero(left.any(axis=0))
            places = np.union1d(home[rows], probe[columns])
            length = basis[1] ** 2 * (2 if basis[0] == "slopes" else 1)
            if basis != images.BASES[0] and left.sum() * VERIFY_S < len(places) * SUMMARY_S + len(rows) * len(columns) * length * PRODUCT_S:
                continue
            most = max(BOUND_ROWS, SUMMARY_BYTES // (4 * length))  # images of a side whose summaries are held at a time
            whole = len(places) <= 2 * most
            summaries = lambda some: images.window_summaries((images.as_raster(column[k]) for k in some.tolist()), len(some), basis)
            held = summaries(places) if whole else None
            of = lambda some: held[np.searchsorted(places, some)] if whole else summaries(some)
            for some in np.split(rows, range(most, len(rows), most)):
                here = None if whole else summaries(home[some])
                for others in np.split(columns, range(BOUND_COLUMNS, len(columns), BOUND_COLUMNS)):
                    there = None
                    for first in range(0, len(some), BOUND_ROWS):
                        part = some[first : first + BOUND_ROWS]
                        if not left[np.ix_(part, others)].any():
                            continue
                        there = of(probe[others]).astype(np.float32) if there is None else there
                        bound = images.structure_bounds(of(home[part]) if whole else here[first : first + BOUND_ROWS], there)
                        left[np.ix_(part, others)] &= bound > self.threshold
                        if bounds is not None:
                            bounds[np.ix_(part, others)] = np.minimum(bounds[np.ix_(part, others)], bound)
            held = here = there = None  # before the next ones are made
        return left

    def possible(self, homes: DataFrame, probes: DataFrame) -> DataFrame:
        """Pairs whose bound exceeds the threshold, with the bound as their score."""

        def score(column, home, probe, wanted):
            bounds = np.ones(wanted.shape, np.float32)
            i, j = np.nonzero(self._left(column, home, probe, wanted.copy(), bounds))
            return i, j, bounds[i, j]

        return _compare_in_blocks(homes, probes, self.feature, self.block_rows, score, False, self.large_block_rows, together=1 / 8)

    def _score(self):
        def score(column, home, probe, wanted):
            by_size = np.argsort(pc.binary_length(column).to_numpy(), kind="stable")  # images of few pixels have coarse windows, which a coarse basis tells apart
            place = np.argsort(by_size)
            x, y = np.argsort(place[home], kind="stable"), np.argsort(place[probe], kind="stable")
            left = wanted[np.ix_(x, y)]
            if np.array_equal(home, probe):
                left = np.triu(left | left.T)
            i, j = np.nonzero(self._left(column, home[x], probe[y], left))
            i, j = x[i], y[j]
            found, s = images.verified_structure(home[i], probe[j], lambda k: images.as_raster(column[k]), self.threshold)
            return i[found], j[found], s

        return score

    def match(self, homes: DataFrame, probes: DataFrame, nearest_only: bool = False) -> DataFrame:
        return _compare_in_blocks(homes, probes, self.feature, self.block_rows, self._score(), nearest_only, self.large_block_rows, together=1 / 8)

    def tally(self, homes: DataFrame, probes: DataFrame) -> DataFrame:
        return _compare_in_blocks(homes, probes, self.feature, self.block_rows, self._score(), False, self.large_block_rows, together=1 / 8, tally=True)

    def pairs(self, assigned: DataFrame) -> DataFrame:
        return _compare_inside(home_rows(assigned, self.feature), self.feature, self.block_rows, self._score(), self.large_block_rows, together=1 / 8)


def _apart(closeness: np.ndarray) -> np.ndarray:
    """Distance of unit vectors from their cosine."""
    return np.sqrt(np.maximum(0.0, 2 - 2 * closeness))


def unit_rows(column, centred: bool) -> np.ndarray:
    """A list column as rows of a float64 matrix, each centred if asked and scaled to length 1."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    matrix = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    if centred:
        matrix = matrix - matrix.mean(axis=1, keepdims=True)
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)


def _rows(assigned: DataFrame, feature: str, cells: str) -> DataFrame:
    return assigned.select(*KEY, feature, F.explode(cells).alias("cell"))


def home_rows(assigned: DataFrame, feature: str) -> DataFrame:
    return _rows(assigned, feature, "homes")


def probe_rows(assigned: DataFrame, feature: str) -> DataFrame:
    return _rows(assigned, feature, "probes")


def similar_pairs(items: DataFrame, index) -> DataFrame:
    """All similar pairs ``a < b`` of a keyword, as ``(keyword, a, b, score)``.

    The output is as large as the data is repetitive; first-wins resolution does not use it but
    goes through ``greedy.first_wins``, which never lists the pairs inside a group of copies.
    """
    assigned = index.assign(items.where(F.col(index.feature).isNotNull()))
    return index.pairs(assigned).drop("cell")
