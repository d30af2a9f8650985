"""Crowds are told by counts of pairs, which are not listed."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftloom.operators import greedy, simjoin
from weftloom.operators.simjoin import HammingIndex, VectorIndex


@pytest.mark.parametrize("index", [HammingIndex(4), HammingIndex(12), VectorIndex(0.6, block_rows=7)])
def test_counted_pairs_are_those_of_a_match(spark, index):
    draw = np.random.default_rng(8)
    rows = [("kj"[i % 2], i, int(draw.integers(0, 1 << 13)), draw.normal(size=4).tolist()) for i in range(60)]
    items = spark.createDataFrame(rows, "keyword string, image_id long, bits long, embedding array<double>")
    assigned = greedy.materialize(index.assign(items))
    homes, probes = simjoin.home_rows(assigned, index.feature), simjoin.probe_rows(assigned, index.feature)
    pairs = Counter((r.keyword, r.cell, r.b) for r in index.match(homes, probes).collect())
    counted = Counter()
    for r in index.tally(homes, probes).collect():
        counted[r.keyword, r.cell, r.b] += r.n
    assert pairs and counted == pairs
    whole = sorted((r.keyword, r.a, r.b) for r in index.pairs(assigned).collect())
    assert whole == sorted((r.keyword, r.a, r.b) for r in index.match(homes, probes).collect())


def test_crowds_are_estimated_without_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(VectorIndex, "match", lambda *_, **__: pytest.fail("the drawn pairs are listed"))
    items = spark.range(600).select(F.lit("k").alias("keyword"), F.col("id").alias("image_id"), F.array(F.lit(1.0), F.col("id") / 1e6).alias("embedding"))
    limits = greedy._crowd_limits(VectorIndex(0.9).assign(items), VectorIndex(0.9), 100, 4.0)
    assert limits.count() == 1 and 0 < limits.first().limit < 300


def test_repeated_and_missing_ids_pair_with_others_only(spark):
    rows = [("k", i % 40 if i % 9 else None, [1.0, float(i % 7)]) for i in range(120)]  # ids come with several features
    items = spark.createDataFrame(rows, "keyword string, image_id long, embedding array<double>")
    index = VectorIndex(0.9, cell_rows=16, shell_rows=8, block_rows=5)
    assigned = greedy.materialize(index.assign(items))
    homes, probes = simjoin.home_rows(assigned, "embedding"), simjoin.probe_rows(assigned, "embedding")
    want = sorted((r.a, r.b) for r in index.match(homes, probes).collect())
    assert want and sorted((r.a, r.b) for r in index.pairs(assigned).collect()) == want
