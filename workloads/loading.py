"""Scan and batch-loading queries over ``orders`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftloom.operators import loader, scoring
from weftloom.operators.ordering import number_rows
from weftloom.session import materialize, scratch_path
from weftloom.sources import files, sinks
from weftloom.streaming import load as streaming_load
from workloads.base import Registry, table

query = Registry()


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""")
def shard_scan_first_wins(spark, sf):
    """Orders as shard rows: the customer is the file name, of which the first row counts."""
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return files.first_rows(rows, ["o_custkey"], ["o_orderkey"])


@query("""
WITH rows AS (
  SELECT o_orderpriority AS keyword, o_custkey, o_orderkey, o_orderkey % 7 AS batch,
         row_number() OVER (PARTITION BY o_orderpriority, o_orderkey % 7 ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders),
firsts AS (SELECT * FROM rows QUALIFY row_number() OVER (PARTITION BY keyword, o_custkey ORDER BY batch, place) = 1)
SELECT keyword, o_custkey::VARCHAR AS filename, o_orderkey::VARCHAR AS content,
       row_number() OVER (PARTITION BY keyword ORDER BY batch, place) AS image_id FROM firsts""")
def shard_order(spark, sf):
    """Orders stored as shards, seven a priority, newest first; the customer is the file name. Images in the order of shard, then row."""
    root = scratch_path(spark)
    rows = table(spark, sf, "orders").select(
        F.encode(F.col("o_orderkey").cast("string"), "UTF-8").alias("image_bytes"), F.col("o_custkey").cast("string").alias("filename"),
        F.col("o_orderpriority").alias("keyword"), F.pmod("o_orderkey", F.lit(7)).cast("int").alias("batch_id"), "o_orderdate", "o_orderkey",
    )
    placed = rows.repartition("keyword", "batch_id").sortWithinPartitions("keyword", "batch_id", F.desc("o_orderdate"), "o_orderkey")
    placed.drop("o_orderdate", "o_orderkey").write.partitionBy("keyword", "batch_id").parquet(root)
    shards = files.scan_shards(spark, root, places=True)
    ordered = materialize(files.shard_order(shards))
    wanted = shards.join(ordered, ["keyword", "filename", "shard", "row"])
    return wanted.select("keyword", "filename", F.decode("image_bytes", "UTF-8").alias("content"), "image_id")


@query("SELECT source AS keyword, sum(octet_length(encode(text)) + 1)::BIGINT AS bytes, sum(octet_length(encode(text)) + 1)::BIGINT AS length FROM documents GROUP BY 1")
def scan_images(spark, sf):
    """Documents written as files in a folder for each source, and scanned like images, contents included."""
    root = scratch_path(spark)
    written = table(spark, sf, "documents").select(F.col("source").alias("keyword"), "text")
    written.write.partitionBy("keyword").text(root)
    return files.scan_images(spark, root, ("txt",)).groupBy("keyword").agg(
        F.sum(F.octet_length("image_bytes")).alias("bytes"), F.sum("length").alias("length")
    )


def _listing(spark, sf):
    """Orders as image files: priority is the keyword; some have a suffix that is no image's."""
    endings = F.array(*map(F.lit, [".jpg", ".PNG", ".webp", ".jpeg", ".txt"]))
    key = F.col("o_orderkey")
    name = F.concat(F.format_string("img_%08d", key), F.element_at(endings, (F.pmod(key, F.lit(5)) + 1).cast("int")))
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("keyword"), name.alias("filename"), "o_orderstatus", "o_orderdate"
    )


def _ledger(spark, sf):
    """Orders of status F count as shipped, in batches of 300."""
    done = _listing(spark, sf).where("o_orderstatus = 'F'")
    numbered = number_rows(done, ["keyword"], [F.col("filename")], "n")
    return numbered.select(
        "keyword", "filename", (F.floor((F.col("n") - 1) / 300) + 1).cast("int").alias("batch_id"),
        F.col("o_orderdate").cast("timestamp").alias("committed_at"),
    )


LISTING_SQL = """
listing AS MATERIALIZED (
  SELECT o_orderpriority AS keyword,
         'img_' || lpad(o_orderkey::VARCHAR, 8, '0') || (['.jpg', '.PNG', '.webp', '.jpeg', '.txt'])[o_orderkey % 5 + 1] AS filename,
         o_orderstatus, o_orderdate FROM orders),
ledger AS MATERIALIZED (
  SELECT keyword, filename, ((row_number() OVER (PARTITION BY keyword ORDER BY filename) - 1) // 300 + 1)::INTEGER AS batch_id,
         o_orderdate AS committed_at FROM listing WHERE o_orderstatus = 'F'),
pending AS MATERIALIZED (
  SELECT keyword, filename FROM listing
  WHERE regexp_matches(filename, '(?i)\\.(jpg|jpeg|png|webp)$') AND o_orderstatus <> 'F'),
assigned AS MATERIALIZED (
  SELECT p.keyword, filename, (coalesce(batch_count, 0) + 1
         + (row_number() OVER (PARTITION BY p.keyword ORDER BY filename) - 1) // 300)::INTEGER AS batch_id
  FROM pending p LEFT JOIN (SELECT keyword, max(batch_id) AS batch_count FROM ledger GROUP BY 1) c ON c.keyword = p.keyword)"""


def _pending(spark, sf, ledger):
    return loader.pending_images(_listing(spark, sf).select("keyword", "filename"), ledger)


@query(f"WITH {LISTING_SQL} SELECT keyword, filename FROM pending")
def pending_images(spark, sf):
    return _pending(spark, sf, _ledger(spark, sf))


@query(f"WITH {LISTING_SQL} SELECT keyword, filename, batch_id FROM assigned")
def batch_assignment(spark, sf):
    ledger = materialize(_ledger(spark, sf))
    return loader.assign_batches(_pending(spark, sf, ledger), loader.batch_counts(ledger))


@query(f"""
WITH {LISTING_SQL}
SELECT keyword, batch_id, count(*) AS images FROM assigned GROUP BY 1, 2
HAVING NOT bool_or(filename LIKE '%77.webp')""")
def verify_batches(spark, sf):
    """The target lacks the files ending in 77.webp, so their batches do not pass."""
    assigned = materialize(batch_assignment(spark, sf))
    return loader.verified_batches(assigned, assigned.where("filename not like '%77.webp'"))


@query(f"""
WITH {LISTING_SQL}
SELECT keyword, batch_id, string_agg(filename, ',' ORDER BY filename) AS uploaded,
       (SELECT max(batch_id) FROM ledger h WHERE h.keyword = l.keyword) AS batch_count,
       (SELECT count(*) FROM ledger h WHERE h.keyword = l.keyword) AS total_count,
       (SELECT strftime(max(committed_at), '%Y-%m-%d') FROM ledger h WHERE h.keyword = l.keyword) AS last_updated
FROM ledger l GROUP BY 1, 2""")
def manifest_rollup(spark, sf):
    rolled = loader.manifest_rollup(materialize(_ledger(spark, sf)))
    return rolled.withColumn("uploaded", F.array_join("uploaded", ",")).withColumn(
        "last_updated", F.date_format("last_updated", "yyyy-MM-dd")
    )


@query(f"""
WITH {LISTING_SQL}
SELECT keyword, filename, max(batch_id) OVER (PARTITION BY keyword) AS batch_count, (count(*) OVER (PARTITION BY keyword))::INTEGER AS total_count,
       strftime(max(committed_at) OVER (PARTITION BY keyword), '%Y-%m-%d') AS last_updated
FROM ledger""")
def manifest_roundtrip(spark, sf):
    """Manifests written as JSON and read back, a row for each name."""
    root = scratch_path(spark)
    ledger = materialize(_ledger(spark, sf))
    sinks.write_manifests(loader.manifest_rollup(ledger), root)
    stored = files.read_manifests(spark, root, ledger.select("keyword").distinct())
    return stored.select("keyword", F.explode("uploaded").alias("filename"), "batch_count", "total_count", F.date_format("last_updated", "yyyy-MM-dd").alias("last_updated"))


@query("""
WITH n AS (SELECT o_orderpriority AS keyword, o_clerk_key AS url, n FROM (
  SELECT o_orderpriority, 'http://shop.example/' || o_orderkey AS o_clerk_key, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS n FROM orders))
SELECT keyword, (n // 1000)::INTEGER AS batch, (n % 1000)::INTEGER AS pos, url FROM n""")
def string_list_roundtrip(spark, sf):
    """URLs of orders written as JSON lists of 1000, and read back in order."""
    root = scratch_path(spark)
    pool = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("keyword"), F.col("o_orderkey").alias("pos"), F.concat(F.lit("http://shop.example/"), "o_orderkey").alias("url")
    )
    lists = scoring.score_batches(pool, 1000).groupBy("keyword", "batch").agg(
        F.array_sort(F.collect_list(F.struct("place", "url"))).alias("urls")
    )
    text = F.to_json(F.transform("urls", lambda u: u["url"]))
    lists.select(text.alias("value"), "keyword", "batch").repartition("keyword", "batch").write.partitionBy("keyword", "batch").text(root)
    place = F.regexp_extract(F.url_decode("path"), r"keyword=([^/]*)/batch=(\d+)/", 1)
    number = F.regexp_extract("path", r"batch=(\d+)/", 1).cast("int")
    read = files.read_string_list(spark, root)
    return read.select(F.url_decode(place).alias("keyword"), number.alias("batch"), "pos", "url")


def _text_images(documents):
    return documents.select(
        F.col("source").alias("keyword"),
        F.format_string("doc_%09d.jpg", "doc_id").alias("filename"),
        F.encode("text", "UTF-8").alias("image_bytes"),
    )


SHIPPED_SQL = """
WITH n AS (
  SELECT source AS keyword, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 40 + 1 AS batch_id,
         octet_length(encode(text)) AS bytes FROM documents)
SELECT keyword, batch_id::INTEGER AS batch_id, count(*) AS images, sum(bytes)::BIGINT AS bytes FROM n GROUP BY 1, 2"""


def _shipped(spark, target, ledger):
    stored = spark.read.schema(files.SHARD_SCHEMA).parquet(target)
    committed = loader.read_ledger(spark, ledger).select("keyword", "filename", "batch_id")
    return stored.join(committed, ["keyword", "filename", "batch_id"]).groupBy("keyword", "batch_id").agg(
        F.count("*").alias("images"), F.sum(F.octet_length("image_bytes")).alias("bytes")
    )


@query(SHIPPED_SQL)
def batch_roundtrip(spark, sf):
    """All documents shipped in batches of 40, committed, and read back."""
    root = scratch_path(spark)
    loader.load_batches(spark, _text_images(table(spark, sf, "documents")), f"{root}/ledger", f"{root}/data", 40)
    return _shipped(spark, f"{root}/data", f"{root}/ledger")


@query(SHIPPED_SQL)
def stream_load(spark, sf):
    """The same through Structured Streaming, which runs until the table is used up."""
    root = scratch_path(spark)
    schema = table(spark, sf, "documents").schema
    # a pattern, as it fits a file as well as a folder of files; a plain path has to be a folder for a stream
    stream = spark.readStream.schema(schema).parquet(f"{sf}/documents.parque[t]")
    streaming_load.stream_load(_text_images(stream), f"{root}/ledger", f"{root}/data", f"{root}/stream", 40).awaitTermination()
    return _shipped(spark, f"{root}/data", f"{root}/ledger")
