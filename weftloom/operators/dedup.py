"""Duplicate removal by layers, each seeing the survivors of the one before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from weftloom.functions.vectors import as_double, is_flat, l2_norm
from weftloom.operators.greedy import Portions, first_wins
from weftloom.operators.simjoin import KEY, HammingIndex, StructureIndex, VectorIndex
from weftloom.params import SCRIPT_PRESET, CurationParams
from weftloom.session import materialize, small_or_sorted

DECISIONS = [*KEY, "kept", "removed_by", "layer"]


@dataclass(frozen=True)
class Layer:
    """One pass of the cascade.

    ``unreadable`` says what a NULL feature means: ``drop`` (the image vanishes, neither kept nor
    removed), ``flat`` (an all-zero histogram) or ``pass`` (dropped, unless the whole keyword
    has no feature, in which case it passes through).
    """

    name: str
    index: object
    unreadable: str = "drop"
    portions: Portions = Portions()


def standard_layers(params: CurationParams = SCRIPT_PRESET) -> list[Layer]:
    return [
        Layer("hash", HammingIndex(params.hash_distance, "bits")),
        Layer("histogram", VectorIndex(params.histogram_min, "hist", centred=True), "flat"),
        Layer("structure", StructureIndex(params.ssim_high, "gray")),
        Layer("embedding", VectorIndex(params.embedding_min, "embedding"), "pass"),
    ]


def _all_kept(items: DataFrame) -> DataFrame:
    return items.select(*KEY, F.lit(True).alias("kept"), F.lit(None).cast("long").alias("removed_by"))


def _with_flat_histograms(items: DataFrame, layer: Layer) -> DataFrame:
    """Histogram layer. A histogram without variance correlates perfectly with every other.

    So the first image of a keyword, which is always kept, removes every flat one; and if it is
    itself flat it removes the whole keyword. Nothing else about flat rows needs comparing.
    """
    feature = layer.index.feature
    flat = F.col(feature).isNull() | is_flat(as_double(F.col(feature)))
    marked = materialize(items.select(*KEY, feature, flat.alias("flat")))
    firsts = marked.groupBy("keyword").agg(
        F.min("image_id").alias("first_id"), F.min_by("flat", "image_id").alias("first_flat")
    )
    marked = marked.join(firsts, "keyword")
    normal = marked.where("not flat and not first_flat")
    ruled = marked.where("flat or first_flat").select(
        *KEY,
        (F.col("image_id") == F.col("first_id")).alias("kept"),
        F.when(F.col("image_id") != F.col("first_id"), F.col("first_id")).alias("removed_by"),
    )
    return first_wins(normal, layer.index, layer.portions).unionByName(ruled)


def _with_vectors(items: DataFrame, layer: Layer) -> DataFrame:
    """Embedding layer. A zero vector resembles nothing, not even another zero vector."""
    zero = l2_norm(as_double(F.col(layer.index.feature))) == 0
    resolved = first_wins(items.where(~zero), layer.index, layer.portions)
    return resolved.unionByName(_all_kept(items.where(zero)))


def run_layer(items: DataFrame, layer: Layer) -> DataFrame:
    """Decisions of one layer over ``items(keyword, image_id, <features>)``: ``DECISIONS`` columns."""
    feature = layer.index.feature
    present = F.col(feature).isNotNull()
    if layer.unreadable == "flat":
        result = _with_flat_histograms(items, layer)
    elif isinstance(layer.index, VectorIndex):
        result = _with_vectors(items.where(present), layer)
    else:
        result = first_wins(items.where(present), layer.index, layer.portions)

    if layer.unreadable == "pass":
        readable = items.groupBy("keyword").agg(F.bool_or(present).alias("any")).where("not any")
        result = result.unionByName(_all_kept(items.join(readable, "keyword", "left_semi")))
    return result.withColumn("layer", F.lit(layer.name))


def deduplicate(items: DataFrame, layers: list[Layer]) -> tuple[DataFrame, DataFrame]:
    """Run the cascade; returns the survivors' keys and the decisions of every layer."""
    survivors, decisions = items, None
    for layer in layers:
        verdicts = materialize(run_layer(survivors, layer))
        kept = small_or_sorted(verdicts.where("kept").select(*KEY), 400_000)  # the features of all layers to come are on the other side
        survivors = survivors.join(kept, KEY, "left_semi")
        decisions = verdicts if decisions is None else decisions.unionByName(verdicts)
    return survivors.select(*KEY), decisions


def retained(items: DataFrame, survivors: DataFrame) -> DataFrame:
    """Images before and after the cascade, per keyword."""
    totals = items.groupBy("keyword").agg(F.count("*").alias("total"))
    kept = survivors.groupBy("keyword").agg(F.count("*").alias("retained"))
    return totals.join(kept, "keyword", "left").fillna(0, ["retained"])
