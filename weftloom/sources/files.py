"""Readers with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType

from weftloom.operators.ordering import number_rows
from weftloom.params import IMAGE_SUFFIXES

SHARD_SCHEMA = "image_bytes binary, filename string, keyword string, batch_id int"
MANIFEST_SCHEMA = (
    "keyword string, uploaded array<string>, batch_count int, total_count int, last_updated timestamp"
)
PAGE_SCHEMA = "page_id bigint, url string, html string, final_url string, content_type string, status int"


def scan_images(spark: SparkSession, root: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES) -> DataFrame:
    """Files with an image suffix, in any case, directly in the folders of ``root``; ``keyword=…`` folders give the keyword.

    Without a use of ``image_bytes`` the contents are not read.
    """
    files = spark.read.format("binaryFile").load(root)
    keyword = F.col("keyword").cast("string") if "keyword" in files.columns else F.lit(None).cast("string")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    wanted = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).isin(*suffixes)
    return files.where(wanted).select(
        keyword.alias("keyword"), name.alias("filename"), F.col("length"), F.col("content").alias("image_bytes")
    )


def scan_pixels(spark: SparkSession, root: str) -> DataFrame:
    """Decoded PNG and JPEG files: ``(keyword, filename, height, width, channels, data)``; unreadable ones have height -1."""
    rows = spark.read.format("image").load(root)
    keyword = F.col("keyword").cast("string") if "keyword" in rows.columns else F.lit(None).cast("string")
    return rows.select(
        keyword.alias("keyword"),
        F.regexp_extract("image.origin", r"([^/]+)$", 1).alias("filename"),
        "image.height",
        "image.width",
        F.col("image.nChannels").alias("channels"),
        F.when(F.col("image.height") > 0, F.col("image.data")).alias("data"),
    )


def with_image_ids(listing: DataFrame) -> DataFrame:
    """Number the images of a keyword in name order; that order decides between duplicates."""
    ids = number_rows(listing.select("keyword", "filename"), ["keyword"], [F.col("filename")], "image_id")
    return listing.join(ids.withColumn("image_id", F.col("image_id").cast("long")), ["keyword", "filename"])


def scan_shards(spark: SparkSession, root: str, places: bool = False) -> DataFrame:
    """Stored batches; a filter on ``keyword`` reads only that keyword's folders.

    With ``places``, ``shard`` (the file's path) and ``row`` (from 0) say where a row lies: images are in the order of shards, then rows.
    """
    stored = spark.read.schema(SHARD_SCHEMA).parquet(root)
    if not places:
        return stored
    return stored.select("*", F.col("_metadata.file_path").alias("shard"), F.col("_metadata.row_index").alias("row"))


def shard_order(shards: DataFrame) -> DataFrame:
    """``image_id`` for the names in shards with places: the first row of a name counts, and its place is its turn in the keyword.

    Where a name occurs again, that row is left out, whatever its bytes.
    """
    names = first_rows(shards.select("keyword", "filename", "shard", "row"), ["keyword", "filename"], ["shard", "row"])
    numbered = number_rows(names, ["keyword"], [F.col("shard"), F.col("row")], "image_id")
    return numbered.withColumn("image_id", F.col("image_id").cast("long"))


def first_rows(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of every key in the given order (key and order together are unique).

    Narrow rows are reduced before the shuffle, so a hot key is no burden. Rows with bytes in them are not
    shuffled for this: later rows of repeated keys are found by key and order alone, and left out.
    """
    position = F.struct(*order)
    if not any(isinstance(f.dataType, BinaryType) for f in rows.schema):
        columns = [c for c in rows.columns if c not in key]
        packed = rows.groupBy(*key).agg(F.min_by(F.struct(*columns), position).alias("row"))
        return packed.select(*key, *[F.col("row")[c].alias(c) for c in columns])
    places = rows.select(*key, *order)
    repeated = places.groupBy(*key).agg(F.min(position).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = places.join(repeated, key).where(position > F.col("first")).select(*key, *order)
    return rows.join(later, [*key, *order], "left_anti")


def read_string_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of strings per file as ``(path, pos, url)``, order kept."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", F.posexplode(F.from_json("value", "array<string>")).alias("pos", "url"))


def read_manifests(spark: SparkSession, path: str, keywords: DataFrame) -> DataFrame:
    """Manifests of all keywords, with empty defaults for those without a file; one in parts has a row for each part."""
    stored = spark.read.schema(MANIFEST_SCHEMA).json(path, multiLine=True)
    return keywords.select("keyword").join(stored, "keyword", "left").select(
        "keyword",
        F.coalesce("uploaded", F.array().cast("array<string>")).alias("uploaded"),
        F.coalesce("batch_count", F.lit(0)).alias("batch_count"),
        F.coalesce("total_count", F.lit(0)).alias("total_count"),
        "last_updated",
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_SCHEMA).parquet(path)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """``(keyword, image_id, embedding)`` with the label as the keyword."""
    rows = spark.read.schema("vec_id bigint, embedding array<float>, label int").parquet(path)
    return rows.select(F.col("label").cast("string").alias("keyword"), F.col("vec_id").alias("image_id"), "embedding")
