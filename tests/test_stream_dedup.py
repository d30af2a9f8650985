"""First-wins resolution over a stream, against the sequential loop over the images as they arrive."""

import numpy as np
import pytest

from test_dedup import distance, near_hashes
from weftloom.operators.simjoin import HammingIndex, VectorIndex
from weftloom.streaming import dedup as streaming


def deliver(spark, root, parts, index, schema):
    """One micro-batch for each part, all through one checkpoint."""
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        streaming.stream_dedup(stream, index, f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return streaming.decisions(spark, f"{root}/state")


HASHES = "keyword string, image_id long, bits long"


def fates(frame):
    return {(r.keyword, r.image_id): (r.kept, r.removed_by) for r in frame.collect()}


def expected(rows, near):
    """Fates by the sequential loop, in the order of ``rows``."""
    found, kept = {}, []
    for keyword, image, feature in rows:
        remover = next((k[1] for k in kept if k[0] == keyword and near(k[2], feature)), None)
        found[keyword, image] = (remover is None, remover)
        if remover is None:
            kept.append((keyword, image, feature))
    return found


@pytest.mark.parametrize("cuts", [[], [30], [1, 2, 50]])
def test_any_split_gives_the_decisions_of_one_batch(spark, tmp_path, cuts):
    rows = near_hashes(3, 60, 6)
    edges = [0, *cuts, len(rows)]
    parts = [rows[a:b] for a, b in zip(edges, edges[1:])]
    got = fates(deliver(spark, str(tmp_path), parts, HammingIndex(8), HASHES))
    assert got == expected(rows, lambda x, y: distance(x, y) <= 8)
    assert any(not kept for kept, _ in got.values())


def test_late_small_ids_repeats_and_unreadable(spark, tmp_path):
    first = [("k", 10, 0), ("k", 11, None), ("k", 12, -1), ("k", 12, -1)]
    second = [("k", 3, 1), ("k", 10, 255 << 20), ("k", 11, 1 << 40 | (255 << 30)), ("other", 4, 0)]
    got = fates(deliver(spark, str(tmp_path), [first, second], HammingIndex(4), HASHES))
    assert got == {
        ("k", 10): (True, None), ("k", 12): (True, None),  # decided once, though the id comes again with another hash
        ("k", 3): (False, 10),  # a smaller id that comes later does not displace
        ("k", 11): (True, None),  # had no hash before
        ("other", 4): (True, None),
    }


def test_a_batch_run_again_replaces_its_own(spark, tmp_path):
    state, frame = str(tmp_path), lambda rows: spark.createDataFrame(rows, HASHES)
    batches = [frame([("k", 1, 0), ("k", 2, 3)]), frame([("k", 3, 1), ("k", 4, -1)]), frame([])]
    for number in (0, 1, 1, 2, 2):
        streaming.resolve_arrivals(batches[number], number, HammingIndex(4), state)
    rows = streaming.decisions(spark, state)
    assert rows.count() == 4
    assert fates(rows) == {("k", 1): (True, None), ("k", 2): (False, 1), ("k", 3): (False, 1), ("k", 4): (True, None)}


def test_vectors_with_zeros(spark, tmp_path):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 8))
    rows = [("k", i, (centres[i % 5] + 0.1 * rng.normal(size=8)).tolist()) for i in range(40)]
    rows += [("k", 40, [0.0] * 8), ("k", 41, [0.0] * 8)]
    schema = "keyword string, image_id long, embedding array<double>"
    got = fates(deliver(spark, str(tmp_path), [rows[:7], rows[7:41], rows[41:]], VectorIndex(0.9), schema))
    near = lambda x, y: any(x) and any(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) > 0.9
    assert got == expected(rows, near)
