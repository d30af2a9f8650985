"""Continuous form of the batch loader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from weftloom.operators.loader import load_batches


def image_stream(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    """New image files under ``keyword=…`` folders as ``(keyword, filename, image_bytes)``."""
    schema = "path string, modificationTime timestamp, length bigint, content binary, keyword string"
    files = (
        spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", max_files).load(root)
    )
    return files.select("keyword", F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), F.col("content").alias("image_bytes"))


def stream_load(
    images: DataFrame, ledger_path: str, target: str, checkpoint: str, batch_size: int = 300, trigger: dict | None = None
) -> StreamingQuery:
    """Ship every micro-batch through ``load_batches``.

    Numbers come from the ledger, not from the micro-batch, and the ledger filters names, so a
    replayed micro-batch ships nothing twice. ``trigger`` is passed to ``writeStream.trigger``.
    """

    def ship(batch: DataFrame, _: int) -> None:
        load_batches(batch.sparkSession, batch, ledger_path, target, batch_size)

    return (
        images.writeStream.foreachBatch(ship)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
