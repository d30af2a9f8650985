"""First-wins resolution and the similarity joins against plain loops."""

import numpy as np
import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from weftloom.functions import images
from weftloom.functions.vectors import median_bits
from weftloom.operators import dedup, features, greedy, simjoin
from weftloom.operators.dedup import Layer
from weftloom.operators.greedy import Portions
from weftloom.operators.simjoin import HammingIndex, StructureIndex, VectorIndex
from weftloom.params import NOTEBOOK_PRESET, SCRIPT_PRESET

RELAXED = settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=list(HealthCheck))


def first_wins_loop(items, similar):
    """items: {keyword: [(id, feature)]}; returns {(keyword, id): removed_by or None}."""
    fate = {}
    for keyword, rows in items.items():
        removed = {}
        rows = sorted(rows, key=lambda r: r[0])
        for i, (a, fa) in enumerate(rows):
            if a in removed:
                continue
            for b, fb in rows[i + 1:]:
                if b not in removed and similar(fa, fb):
                    removed[b] = a
        fate.update({(keyword, i): removed.get(i) for i, _ in rows})
    return fate


def decisions(frame):
    rows = frame.collect()
    assert all(r.kept == (r.removed_by is None) for r in rows)
    return {(r.keyword, r.image_id): r.removed_by for r in rows}


def edges_frame(spark, rows):
    return spark.createDataFrame(rows or [], "keyword string, a long, b long, score double")


@RELAXED
@given(st.sets(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=80), st.sampled_from([0, 3, 10_000]))
def test_settle_is_the_sequential_loop(spark, pairs, finish):
    pairs = {(min(p), max(p)) for p in pairs if p[0] != p[1]}
    nodes = spark.createDataFrame([("k", i) for i in range(26)], "keyword string, image_id long")
    edges = edges_frame(spark, [("k", a, b, 1.0) for a, b in pairs])
    want = first_wins_loop({"k": [(i, i) for i in range(26)]}, lambda x, y: (x, y) in pairs)
    assert decisions(greedy.greedy_dedup(nodes, edges, finish)) == want


@pytest.mark.parametrize("finish", [0, 10_000])
def test_chain_star_triangle(spark, finish):
    nodes = spark.createDataFrame(
        [("chain", i) for i in range(1, 5)] + [("star", i) for i in range(10, 15)] + [("alone", 30)],
        "keyword string, image_id long",
    )
    edges = edges_frame(
        spark, [("chain", 1, 2, 1.0), ("chain", 2, 3, 1.0), ("chain", 3, 4, 1.0)] + [("star", 10, i, 1.0) for i in range(11, 15)]
    )
    kept = {i for (_, i), by in decisions(greedy.greedy_dedup(nodes, edges, finish)).items() if by is None}
    assert kept == {1, 3, 10, 30}


@pytest.mark.parametrize("finish", [0, 10_000])
def test_waiting_images_stay_unknown(spark, finish):
    edges = greedy.materialize(edges_frame(spark, [("k", 1, 3, 1.0), ("k", 2, 4, 1.0), ("k", 4, 5, 1.0), ("k", 1, 6, 1.0)]))
    waiting = spark.createDataFrame([("k", 2), ("k", 6)], "keyword string, image_id long")
    states = {r.image_id: r.state for r in greedy.settle(edges, waiting, finish).collect()}
    assert states == {1: "kept", 3: "removed", 2: "unknown", 4: "unknown", 5: "unknown", 6: "removed"}


def hash_items(spark, rows):
    return spark.createDataFrame(rows, "keyword string, image_id long, bits long")


def near_hashes(seed, count, centres):
    rng = np.random.default_rng(seed)
    middle = rng.integers(-(2**63), 2**63, centres, dtype=np.int64)
    rows = []
    for i in range(count):
        value = int(middle[rng.integers(0, centres)])
        for bit in rng.choice(64, rng.integers(0, 7), replace=False):
            value ^= 1 << int(bit) if bit < 63 else -(1 << 63)
        rows.append(("k" if i % 3 else "j", i, value))
    return rows


def distance(x, y):
    return bin((x ^ y) & (2**64 - 1)).count("1")


@pytest.mark.parametrize("limit", [0, 1, 2, 5, 8, 11, 12, 20])
def test_hamming_pairs_are_complete_and_unique(spark, limit):
    rows = near_hashes(limit, 150, 12)
    got = simjoin.similar_pairs(hash_items(spark, rows), HammingIndex(limit)).collect()
    want = {
        (k, i, j, float(distance(x, y)))
        for k, i, x in rows for l, j, y in rows if k == l and i < j and distance(x, y) <= limit
    }
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_planted_hash_edges(spark):
    base = -0x0123456789ABCDEF
    rows = [(0, base), (1, base), (2, base ^ 0xFF), (3, base ^ 0x1FF), (4, base ^ (7 << 60 | 7 << 30 | 3 << 10))]
    got = {(r.a, r.b) for r in simjoin.similar_pairs(hash_items(spark, [("k", i, v) for i, v in rows]), HammingIndex(8)).collect()}
    assert {(0, 1), (0, 2), (1, 2), (2, 3)} <= got and (0, 3) not in got and (0, 4) in got


SMALL = Portions(cell_rows=4, pairs_per_image=0.5, finish_edges=100_000)
SMALL_ROUNDS = Portions(cell_rows=4, pairs_per_image=0.5, finish_edges=0)


@pytest.mark.parametrize("portions", [Portions(), SMALL, SMALL_ROUNDS])
def test_hash_layer_with_hot_cells(spark, portions):
    """A third of all images are exact copies and another third near copies, placed last in order."""
    rows = near_hashes(1, 60, 20)
    far = 0x5555555555555555
    rows += [("k", 100 + i, far) for i in range(60)] + [("k", 200 + i, far ^ (1 << (i % 30)) ^ (1 << (i % 7 + 31))) for i in range(60)]
    items = {}
    for k, i, v in rows:
        items.setdefault(k, []).append((i, v))
    want = first_wins_loop(items, lambda x, y: distance(x, y) <= 8)
    layer = Layer("hash", HammingIndex(8), portions=portions)
    assert decisions(dedup.run_layer(hash_items(spark, rows), layer)) == want


def clustered_vectors(seed, count, centres, dims=16, spread=0.15):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(centres, dims))
    middles /= np.linalg.norm(middles, axis=1, keepdims=True)
    return [
        ("k" if i % 4 else "j", i, (middles[rng.integers(0, centres)] + spread * rng.normal(size=dims) / np.sqrt(dims)).tolist())
        for i in range(count)
    ]


def cosine(x, y):
    x, y = np.array(x), np.array(y)
    return float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y)))


def vector_items(spark, rows):
    return spark.createDataFrame(rows, "keyword string, image_id long, embedding array<double>")


@pytest.mark.parametrize("threshold", [0.97, 0.9, 0.3])
@pytest.mark.parametrize("centred", [False, True])
def test_pivot_cells_lose_no_pair(spark, threshold, centred):
    rows = clustered_vectors(3, 240, 15)
    move = (lambda v: np.array(v) - np.mean(v)) if centred else np.array
    index = VectorIndex(threshold, centred=centred, cell_rows=20, block_rows=16)
    assert index._pivots(vector_items(spark, rows))  # the pivot path is taken
    got = simjoin.similar_pairs(vector_items(spark, rows), index).collect()
    want = {
        (k, i, j) for k, i, x in rows for l, j, y in rows if k == l and i < j and cosine(move(x), move(y)) > threshold
    }
    assert len(got) == len(want) and {(r.keyword, r.a, r.b) for r in got} == want


def test_vector_cells_spare_most_pairs(spark):
    rows = clustered_vectors(11, 1500, 40)
    index = VectorIndex(0.97, cell_rows=60, shell_rows=30)
    assigned = index.assign(vector_items(spark, rows)).collect()
    stored, sent = {}, {}
    for r in assigned:
        place = r.keyword, r.homes[0]
        stored[place] = stored.get(place, 0) + 1
        for cell in r.probes:
            if cell > r.homes[0]:
                sent[r.keyword, cell] = sent.get((r.keyword, cell), 0) + 1
    compared = sum(n * (n - 1) // 2 + n * sent.get(place, 0) for place, n in stored.items())
    sizes = {}
    for k, _, _ in rows:
        sizes[k] = sizes.get(k, 0) + 1
    assert 4 * compared <= sum(n * (n - 1) // 2 for n in sizes.values())
    vectors = {i: np.array(v) / np.linalg.norm(v) for _, i, v in rows}
    pivots = index._pivots(vector_items(spark, rows))
    for r in assigned:  # nothing is sent to a pivot out of reach
        away = np.linalg.norm(pivots[r.keyword] - vectors[r.image_id], axis=1)
        assert all(away[cell // simjoin.MAX_SHELLS] - away.min() <= 2 * index.radius for cell in r.probes)


@pytest.mark.parametrize("portions", [Portions(), SMALL])
@pytest.mark.parametrize("pivot_rows", [4096, 30])
def test_embedding_layer_with_hot_cells(spark, portions, pivot_rows):
    rows = clustered_vectors(5, 120, 12)
    one = np.ones(16) / 4
    rng = np.random.default_rng(7)
    rows += [("k", 500 + i, one.tolist()) for i in range(60)]
    rows += [("k", 600 + i, (one + 0.02 * rng.normal(size=16)).tolist()) for i in range(60)]
    rows += [("k", 700, [0.0] * 16), ("k", 701, [0.0] * 16)]
    items = {}
    for k, i, v in rows:
        items.setdefault(k, []).append((i, v))
    with np.errstate(invalid="ignore"):
        want = first_wins_loop(items, lambda x, y: cosine(x, y) > 0.97)
    layer = Layer("embedding", VectorIndex(0.97, cell_rows=pivot_rows, block_rows=16), "pass", portions=portions)
    assert decisions(dedup.run_layer(vector_items(spark, rows), layer)) == want


def test_flat_histograms_follow_the_first_image(spark):
    flat, a, b = [0.0] * 8, [1.0] + [0.0] * 7, [0.0] * 7 + [1.0]
    rows = [("x", 1, a), ("x", 2, flat), ("x", 3, b), ("x", 4, None), ("x", 5, [0.5] * 8),
            ("y", 11, flat), ("y", 12, a), ("y", 13, flat)]
    items = spark.createDataFrame(rows, "keyword string, image_id long, hist array<double>")
    layer = Layer("histogram", VectorIndex(0.98, "hist", centred=True), "flat")
    got = decisions(dedup.run_layer(items, layer))
    assert got == {("x", 1): None, ("x", 2): 1, ("x", 3): None, ("x", 4): 1, ("x", 5): 1,
                   ("y", 11): None, ("y", 12): 11, ("y", 13): 11}


def test_unreadable_embeddings(spark):
    rows = [("x", 1, [1.0, 0.0]), ("x", 2, None), ("x", 3, [1.0, 0.01]), ("y", 4, None), ("y", 5, None)]
    items = spark.createDataFrame(rows, "keyword string, image_id long, embedding array<double>")
    got = decisions(dedup.run_layer(items, Layer("embedding", VectorIndex(0.97), "pass")))
    assert got == {("x", 1): None, ("x", 3): 1, ("y", 4): None, ("y", 5): None}


def test_review_rule(spark):
    """3 is removed by 1, before 2 would flag it; 5 is removed by 4, but after 2 has flagged it."""
    band = edges_frame(spark, [("k", 2, 3, 0.85), ("k", 2, 5, 0.9), ("k", 3, 6, 0.9), ("k", 1, 6, 0.81)])
    fate = spark.createDataFrame(
        [("k", 1, True, None), ("k", 2, True, None), ("k", 3, False, 1), ("k", 4, True, None), ("k", 5, False, 4), ("k", 6, True, None)],
        "keyword string, image_id long, kept boolean, removed_by long",
    )
    assert {(r.a, r.b) for r in greedy.review_pairs(band, fate).collect()} == {(2, 5), (1, 6)}


# --- pixels ---


def pixel_rows(spark, pictures):
    rows = [(k, i, *(p.shape if p is not None else (-1, -1, -1)), p.tobytes() if p is not None else None) for k, i, p in pictures]
    return spark.createDataFrame(
        [(k, i, h, w, c, bytearray(d) if d is not None else None) for k, i, h, w, c, d in rows],
        "keyword string, image_id long, height int, width int, channels int, data binary",
    )


def picture(seed, height=300, width=280):
    """Soft random shapes, away from black and white."""
    rng = np.random.default_rng(seed)
    y, x = np.linspace(0, 11, height), np.linspace(0, 11, width)
    channels = []
    for _ in range(3):
        coarse = rng.uniform(30, 220, (13, 13))
        rows = np.stack([np.interp(x, np.arange(13), row) for row in coarse])
        channels.append(np.stack([np.interp(y, np.arange(13), column) for column in rows.T], axis=1))
    return np.stack(channels, axis=2).astype(np.uint8)


def test_pixel_features(spark):
    base = picture(1)
    brighter = (base.astype(int) + 10).clip(0, 255).astype(np.uint8)
    rows = pixel_rows(spark, [("k", 1, base), ("k", 2, brighter), ("k", 3, picture(2)), ("k", 4, None)])
    found = {r.image_id: r for r in features.pixel_features(rows).collect()}
    assert distance(found[1].bits, found[2].bits) <= 8 < distance(found[1].bits, found[3].bits)
    assert len(found[1].hist) == 768 and abs(np.linalg.norm(found[1].hist[:256]) - 1) < 1e-12
    assert len(found[1].gray) == 65536
    assert found[4].bits is None and found[4].hist is None and found[4].gray is None


def windows_ssim(a, b):
    """Window by window, from the definition."""
    from numpy.lib.stride_tricks import sliding_window_view

    x, y = (sliding_window_view(v.astype(float), (7, 7)).reshape(-1, 49) for v in (a, b))
    mx, my = x.mean(1), y.mean(1)
    cov = ((x - mx[:, None]) * (y - my[:, None])).sum(1) / 48
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    top = (2 * mx * my + c1) * (2 * cov + c2)
    return (top / ((mx**2 + my**2 + c1) * (x.var(1, ddof=1) + y.var(1, ddof=1) + c2))).mean()


def test_structural_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (256, 256)).astype(np.uint8)
    b = (a * 0.6 + rng.integers(0, 100, (256, 256))).astype(np.uint8)
    assert abs(images.structural_similarity(a, b) - windows_ssim(a, b)) < 1e-12
    assert images.structural_similarity(a, a) == pytest.approx(1)


def test_resize_and_hash_small_cases():
    flat = np.full((9, 13), 42.0)
    assert np.allclose(images.resize(flat, 256), 42) and np.allclose(images.area_resize(np.full((70, 90), 7.0), 32), 7)
    assert images.area_resize(np.arange(64.0 * 64).reshape(64, 64), 32)[0, 0] == pytest.approx((0 + 1 + 64 + 65) / 4)


def test_ssim_layer(spark):
    a, b = picture(3), picture(4)
    block = a.copy()
    block[100:130, 100:130] = 0
    rows = pixel_rows(spark, [("k", 1, a), ("k", 2, block), ("k", 3, b), ("k", 4, a), ("k", 5, None)])
    grays = features.pixel_features(rows, ("gray",))
    raster = {r.image_id: np.frombuffer(r.gray, np.uint8).reshape(256, 256) for r in grays.where("gray is not null").collect()}
    want = first_wins_loop({"k": list(raster.items())}, lambda x, y: windows_ssim(x, y) > 0.92)
    assert decisions(dedup.run_layer(grays, Layer("structure", StructureIndex(0.92)))) == want
    assert want[("k", 2)] == 1


@pytest.mark.parametrize("index", [StructureIndex(0.92), StructureIndex(0.92, block_rows=2), StructureIndex(0.92, block_rows=1, large_block_rows=3)])
def test_ssim_blocks_lose_no_pair(spark, index):
    shapes = [picture(i) for i in range(20, 24)]
    rng = np.random.default_rng(9)
    noisy = [(shapes[i % 4].astype(int) + rng.integers(-4, 5, shapes[0].shape)).clip(0, 255).astype(np.uint8) for i in range(36)]
    rows = pixel_rows(spark, [("k", i, p) for i, p in enumerate(noisy)])
    grays = greedy.materialize(features.pixel_features(rows, ("gray",)))
    got = simjoin.similar_pairs(grays, index).collect()
    assert len(got) == 4 * 36 and all(r.a % 4 == r.b % 4 and r.a < r.b for r in got)


def test_structure_bounds_hold_and_spare_rasters(spark):
    rng = np.random.default_rng(4)
    shapes = [picture(i) for i in range(40, 70)]
    near = [(shapes[i].astype(int) + rng.integers(-5, 6, shapes[i].shape)).clip(0, 255).astype(np.uint8) for i in range(10)]
    faded = [(shapes[0] * x).astype(np.uint8) for x in (0.2, 0.5, 0.95)] + [np.full((256, 256), x, np.uint8) for x in (0, 255)]
    noise = [rng.integers(0, 256, (256, 256)).astype(np.uint8)]
    gray = lambda p: p if p.ndim == 2 else np.rint(images.resize(p.mean(axis=2), 256)).clip(0, 255).astype(np.uint8)
    rasters = [gray(p) for p in shapes + near + faded + noise]
    summaries = np.stack([images.window_summary(p) for p in rasters])
    bounds = images.structure_bounds(summaries, summaries)
    for i in range(0, len(rasters), 3):
        for j in range(len(rasters)):
            assert images.structural_similarity(rasters[i], rasters[j]) <= bounds[i, j]
    items = spark.createDataFrame([("k", i, bytearray(p.tobytes())) for i, p in enumerate(rasters)], "keyword string, image_id long, gray binary")
    index = StructureIndex(0.92)
    assigned = index.assign(items)
    possible = index.possible(simjoin.home_rows(assigned, "gray"), simjoin.probe_rows(assigned, "gray")).count()
    found = {(r.a, r.b) for r in simjoin.similar_pairs(items, index).collect()}
    assert possible <= 0.1 * len(rasters) * (len(rasters) - 1) / 2
    assert found == {
        (i, j) for i in range(len(rasters)) for j in range(i + 1, len(rasters)) if images.structural_similarity(rasters[i], rasters[j]) > 0.92
    }


def test_full_cascade_on_pictures(spark):
    a, b, c = picture(5), picture(6), picture(7)
    noisy = (b.astype(int) + np.random.default_rng(1).integers(-3, 4, b.shape)).clip(0, 255).astype(np.uint8)
    rows = pixel_rows(spark, [("k", 1, a), ("k", 2, a), ("k", 3, b), ("k", 4, noisy), ("k", 5, c), ("j", 6, a)])
    items = features.pixel_features(rows).withColumn(
        "embedding", F.when(F.col("image_id") == 5, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))
    )
    for preset in (SCRIPT_PRESET, NOTEBOOK_PRESET):
        survivors, log = dedup.deduplicate(greedy.materialize(items), dedup.standard_layers(preset))
        assert {r.image_id for r in survivors.collect()} == {1, 5, 6}
        by_layer = {(r.layer, r.image_id): r.removed_by for r in log.collect()}
        assert by_layer[("hash", 2)] == 1 and by_layer[("hash", 4)] == 3 and by_layer[("embedding", 3)] == 1


def test_median_bits_match_numpy(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(20)]
    frame = spark.createDataFrame(rows, "i long, v array<double>").select("i", median_bits(F.col("v")).alias("bits"))
    for r in frame.collect():
        v = np.array(rows[r.i][1])
        assert r.bits == int.from_bytes(np.packbits(v > np.median(v)).tobytes(), "big", signed=True)


def test_large_tables_of_ids_are_not_broadcast(spark):
    n = 120_000  # two images each; their files have a few hundred KB
    nodes = spark.range(2 * n).select(F.lit("k").alias("keyword"), F.col("id").alias("image_id"))
    edges = spark.range(n).select(F.lit("k").alias("keyword"), (2 * F.col("id")).alias("a"), (2 * F.col("id") + 1).alias("b"))
    found = greedy.greedy_dedup(nodes, edges)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("kept = (image_id % 2 = 0) and removed_by is not distinct from if(kept, null, image_id - 1)").count() == 2 * n


def test_more_blocks_are_dealt_to_more_tasks(spark):
    draw = np.random.default_rng(3)
    rows = [("k", i, draw.normal(size=8).tolist()) for i in range(100)]
    items = spark.createDataFrame(rows, "keyword string, image_id long, embedding array<double>")
    index = VectorIndex(0.5, block_rows=4)  # 25 blocks: 5,000 rows for 625 pairs of blocks
    assigned = index.assign(items)
    pairs = index.match(simjoin.home_rows(assigned, "embedding"), simjoin.probe_rows(assigned, "embedding"))
    assert pairs.rdd.getNumPartitions() == 40  # of some 128 rows, however few the session's partitions
    unit = simjoin.unit_rows(assigned.orderBy("image_id").toArrow().column("embedding"), False)
    assert sorted((p.a, p.b) for p in pairs.collect()) == [tuple(map(int, p)) for p in np.argwhere(np.triu(unit @ unit.T > 0.5, 1))]
