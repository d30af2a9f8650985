"""Sinks that replace exactly the partitions they write."""

from __future__ import annotations

from pyspark.sql import DataFrame


def overwrite_partitions(df: DataFrame, path: str, partitions: list[str], fmt: str = "parquet") -> None:
    """Write ``df`` so that every partition in it replaces the stored one, and no other is touched."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    writer.format(fmt).save(path)


def write_ranked(ranked: DataFrame, path: str) -> None:
    """Ranked table by keyword. Ranks of an earlier run of the same keyword do not survive."""
    overwrite_partitions(ranked.repartitionByRange("keyword", "rank").sortWithinPartitions("keyword", "rank"), path, ["keyword"])


def write_manifests(parts: DataFrame, path: str) -> None:
    """Manifests as one JSON object for each keyword and batch, which ``files.read_manifests`` reads; see ``loader.manifest_rollup``."""
    overwrite_partitions(parts.repartition("keyword", "batch_id"), path, ["keyword", "batch_id"], "json")


def write_reports(parts: DataFrame, path: str) -> None:
    """Report pages as ``keyword=…/part=…`` text files, each a document of its own."""
    overwrite_partitions(parts.select("html", "keyword", "part"), path, ["keyword", "part"], "text")
