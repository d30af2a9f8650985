"""Incremental, numbered and verified batch loading."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from weftloom.functions.text import suffix
from weftloom.operators.ordering import number_rows
from weftloom.params import IMAGE_SUFFIXES
from weftloom.session import broadcast_if_small, materialize
from weftloom.sources.sinks import overwrite_partitions

LEDGER_SCHEMA = "keyword string, filename string, batch_id int, committed_at timestamp"


def pending_images(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Image files that the ledger does not name. Only names decide: new bytes under a shipped name never ship."""
    wanted = suffix(F.col("filename")).isin([f".{s}" for s in IMAGE_SUFFIXES])
    return listing.where(wanted).join(ledger.select("keyword", "filename"), ["keyword", "filename"], "left_anti")


def batch_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("keyword").agg(F.max("batch_id").alias("batch_count"))


def assign_batches(pending: DataFrame, counts: DataFrame, batch_size: int = 300) -> DataFrame:
    """``(keyword, filename, batch_id)``: pending names in order, in batches that continue the ledger's count."""
    named = number_rows(pending.select("keyword", "filename"), ["keyword"], [F.col("filename")], "n")
    return named.join(counts, "keyword", "left").select(
        "keyword",
        "filename",
        (F.coalesce("batch_count", F.lit(0)) + 1 + F.floor((F.col("n") - 1) / batch_size)).cast("int").alias("batch_id"),
    )


def write_batches(assigned: DataFrame, images: DataFrame, target: str) -> None:
    """Store each batch as Snappy Parquet in its own partition; a number that is reused replaces the old one.

    One batch is one file, as its rows share a shuffle key, and holds at most the batch size.
    """
    rows = images.join(assigned, ["keyword", "filename"])
    overwrite_partitions(
        rows.select("image_bytes", "filename", "keyword", "batch_id").repartition("keyword", "batch_id"),
        target,
        ["keyword", "batch_id"],
    )


def verified_batches(assigned: DataFrame, stored: DataFrame) -> DataFrame:
    """Batches whose expected names are all in the target, and nothing else: ``(keyword, batch_id, images)``."""
    # first cut to the batches in question: they are partitions, so only their files are opened
    numbers = broadcast_if_small(assigned.select("keyword", "batch_id").distinct())
    present = stored.select("keyword", "filename", "batch_id").join(numbers, ["keyword", "batch_id"], "left_semi")
    expected = assigned.select("keyword", "filename", "batch_id").withColumn("expected", F.lit(1))
    both = expected.join(present.withColumn("stored", F.lit(1)), ["keyword", "batch_id", "filename"], "full")
    return (
        both.groupBy("keyword", "batch_id")
        .agg(F.count("expected").alias("images"), F.count("stored").alias("found"), F.count("*").alias("names"))
        .where("images = found and images = names")
        .select("keyword", "batch_id", "images")
    )


def commit_rows(assigned: DataFrame, verified: DataFrame) -> DataFrame:
    """Ledger rows of all verified batches; the images of a failed one stay pending, and its number is not used again."""
    done = assigned.join(broadcast_if_small(verified.select("keyword", "batch_id")), ["keyword", "batch_id"], "left_semi")
    return done.select("keyword", "filename", "batch_id", F.current_timestamp().alias("committed_at"))


def load_batches(
    spark: SparkSession, images: DataFrame, ledger_path: str, target: str, batch_size: int = 300
) -> DataFrame:
    """Ship everything pending: number, store, read back, commit. Returns the committed rows.

    Names are selected and numbered first, and bytes are read only for the pending ones. The ledger is
    appended last: a run that dies before leaves the images pending and reuses the numbers.
    """
    ledger = read_ledger(spark, ledger_path)
    pending = pending_images(images.select("keyword", "filename"), ledger)
    assigned = materialize(assign_batches(pending, batch_counts(ledger), batch_size))
    if assigned.isEmpty():
        return spark.createDataFrame([], LEDGER_SCHEMA)
    write_batches(assigned, images, target)
    stored = spark.read.schema("filename string, keyword string, batch_id int").parquet(target)
    committed = materialize(commit_rows(assigned, verified_batches(assigned, stored)))
    committed.write.mode("append").parquet(ledger_path)
    return committed


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows; a ledger that does not exist yet is empty."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def manifest_header(ledger: DataFrame) -> DataFrame:
    """``batch_count``, ``total_count`` and ``last_updated`` per keyword."""
    return ledger.groupBy("keyword").agg(
        F.max("batch_id").alias("batch_count"),
        F.count("*").alias("total_count"),
        F.max("committed_at").alias("last_updated"),
    )


def manifest_uploaded(ledger: DataFrame) -> DataFrame:
    """The names of a manifest, one ordered array per batch.

    A keyword's list has no bound, a batch's has: read in order of ``batch_id`` the arrays make up the list.
    """
    return ledger.groupBy("keyword", "batch_id").agg(F.array_sort(F.collect_list("filename")).alias("uploaded"))


def manifest_rollup(ledger: DataFrame) -> DataFrame:
    """Header and names together, a row per keyword and batch."""
    return manifest_uploaded(ledger).join(manifest_header(ledger), "keyword")
