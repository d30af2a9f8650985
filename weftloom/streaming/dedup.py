"""First-wins duplicate resolution of arriving images (B7 with D5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from weftloom.functions.vectors import as_double, l2_norm
from weftloom.operators.dedup import Layer, run_layer
from weftloom.operators.ordering import number_rows
from weftloom.operators.simjoin import KEY, VectorIndex, home_rows, probe_rows
from weftloom.session import discard, materialize

BATCH_PLACES = 1 << 40  # places of one micro-batch
DECISIONS = "keyword string, image_id long, place long, kept boolean, removed_by long"


def _state(spark: SparkSession, path: str, schema: str, before: int) -> DataFrame:
    """What the micro-batches before number ``before`` wrote; a batch that is run again doesn't see what it wrote itself."""
    if before == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, batch long").parquet(path).where(F.col("batch") < before).drop("batch")


def resolve_arrivals(batch: DataFrame, number: int, index, state: str) -> None:
    """Decide the images ``batch(keyword, image_id, <feature>)`` of micro-batch ``number`` and add them to the state.

    Kept images of earlier micro-batches meet the arrivals through the index and remove their look-alikes; what is
    left is resolved among itself. An image that was decided before is left out, and of rows that share
    keyword and id within the batch the least feature counts. A NULL feature makes the image vanish, neither kept nor removed.
    """
    spark, feature = batch.sparkSession, index.feature
    base = number * BATCH_PLACES
    kept_schema = f"{KEY[0]} string, image_id long, place long, {feature} {batch.schema[feature].dataType.simpleString()}"
    decided = _state(spark, f"{state}/decisions", DECISIONS, number)
    earlier = _state(spark, f"{state}/kept", kept_schema, number)

    fresh = batch.where(F.col(feature).isNotNull()).groupBy(*KEY).agg(F.min(feature).alias(feature))
    fresh = materialize(fresh.join(decided.select(*KEY), KEY, "left_anti"))
    order = number_rows(fresh.select(*KEY), ["keyword"], [F.col("image_id")], "n")
    fresh_placed = materialize(fresh.join(order, KEY).withColumn("place", F.lit(base) + F.col("n")).drop("n"))

    # from here on the place is the id, as it is the order in which images came
    by_place = lambda rows: rows.select("keyword", F.col("place").alias("image_id"), feature)
    wanted = fresh.select("keyword").distinct()  # kept images of other keywords are not looked at
    met = by_place(earlier.join(wanted, "keyword", "left_semi")).unionByName(by_place(fresh_placed))
    if isinstance(index, VectorIndex):  # a zero vector resembles nothing
        met = met.where(l2_norm(as_double(F.col(feature))) > 0)
    assigned = index.assign(materialize(met))
    homes = home_rows(assigned.where(F.col("image_id") < base), feature)
    probes = probe_rows(assigned.where(F.col("image_id") >= base), feature)
    matched = materialize(
        index.match(homes, probes, nearest_only=True)
        .groupBy("keyword", F.col("b").alias("image_id")).agg(F.min("a").alias("removed_by"))
    )
    rest = by_place(fresh_placed).join(matched.select(*KEY), KEY, "left_anti")
    among = run_layer(materialize(rest), Layer("arrivals", index)).select(*KEY, "kept", "removed_by")
    fates = among.unionByName(matched.select(*KEY, F.lit(False).alias("kept"), "removed_by"))

    names = fresh_placed.select("keyword", "image_id", "place").unionByName(earlier.select("keyword", "image_id", "place"))
    fates = (
        fates.withColumnRenamed("image_id", "place").withColumnRenamed("removed_by", "remover")
        .join(fresh_placed.select("keyword", "image_id", "place"), ["keyword", "place"])
        .join(names.select("keyword", F.col("place").alias("remover"), F.col("image_id").alias("removed_by")), ["keyword", "remover"], "left")
    )
    fates = materialize(fates.select("keyword", "image_id", "place", "kept", "removed_by"))
    kept = fresh_placed.join(fates.where("kept").select(*KEY), KEY, "left_semi")
    kept.select("keyword", "image_id", "place", feature).write.mode("overwrite").parquet(f"{state}/kept/batch={number}")
    fates.write.mode("overwrite").parquet(f"{state}/decisions/batch={number}")
    discard(fresh, fresh_placed, matched, fates)


def stream_dedup(images: DataFrame, index, state: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Resolve a stream of ``(keyword, image_id, <feature>)``: the first to arrive of a group of look-alikes stays.

    Within a micro-batch the order is that of ``image_id``. If images arrive in that order, any split into
    micro-batches gives the decisions of one run over all of them. What was decided stays: a smaller id that arrives later does not
    displace a kept image. The state, tables in the folder ``state`` with a partition for each micro-batch, belongs to
    ``checkpoint``; a micro-batch that is run again replaces its own partition. Read the decisions with ``decisions``.

    Rules that look at a whole keyword (flat histograms, keywords without any embedding) need all its images and are not applied.
    """

    def resolve(batch: DataFrame, number: int) -> None:
        resolve_arrivals(batch, number, index, state)

    return (
        images.writeStream.foreachBatch(resolve)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def decisions(spark: SparkSession, state: str) -> DataFrame:
    """Decisions of all micro-batches: ``keyword, image_id, kept, removed_by``."""
    return spark.read.schema(f"{DECISIONS}, batch long").parquet(f"{state}/decisions").select(*KEY, "kept", "removed_by")
