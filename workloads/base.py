"""Shared pieces of the registered queries: tables as image corpora, and SQL fragments."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftloom.functions import urls
from weftloom.session import ship_package


class Registry:
    """Decorator that files a query under its name, with the SQL that gives the same rows if there is any."""

    def __init__(self):
        self.queries, self.oracles = {}, {}

    def __call__(self, sql: str | None = None, name: str | None = None):
        def register(fn):
            @functools.wraps(fn)
            def shipped(spark, sf):
                ship_package(spark)
                return fn(spark, sf)

            self.queries[name or fn.__name__] = shipped
            if sql is not None:
                self.oracles[name or fn.__name__] = sql
            return fn

        return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as images: the label is the keyword."""
    return table(spark, sf, "embeddings").select(
        F.col("label").cast("string").alias("keyword"), F.col("vec_id").alias("image_id"), "embedding"
    )


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as images: the source is the keyword, the UTF-8 bytes are the pixels."""
    return table(spark, sf, "documents").select(
        F.col("source").alias("keyword"), F.col("doc_id").alias("image_id"), F.encode("text", "UTF-8").alias("content")
    )


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "url", "html")


def page_language():
    """First path segment of a page's URL, used as its keyword."""
    return F.regexp_extract("url", r"^[a-z]+://[^/]*/([a-z]+)", 1)


def normalized():
    return urls.normalize(F.col("url"))


# --- SQL fragments ---

SCHEME_SQL = "lower(regexp_extract(url, '^([a-zA-Z]+)://', 1))"
HOST_SQL = "regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)"
PATH_SQL = "regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"
ORIGIN_SQL = f"({SCHEME_SQL} || '://' || {HOST_SQL})"
NORMAL_SQL = f"({ORIGIN_SQL} || CASE WHEN rtrim({PATH_SQL}, '/') = '' THEN '/' ELSE rtrim({PATH_SQL}, '/') END)"
LANGUAGE_SQL = "regexp_extract(url, '^[a-z]+://[^/]*/([a-z]+)', 1)"

VECTORS_SQL = """
vectors AS MATERIALIZED (
  SELECT label::VARCHAR AS keyword, vec_id AS image_id, embedding::DOUBLE[] AS v FROM embeddings)"""

HIST_SQL = """
bytes AS (
  SELECT source AS keyword, doc_id AS image_id,
         unnest(regexp_extract_all(hex(encode(text)), '..')) AS byte
  FROM documents),
counts AS MATERIALIZED (
  SELECT keyword, image_id, ('0x' || byte)::INTEGER AS bin, count(*)::DOUBLE AS n FROM bytes GROUP BY ALL),
bins AS MATERIALIZED (
  SELECT keyword, image_id, bin, n / sqrt(sum(n * n) OVER (PARTITION BY image_id)) AS w FROM counts),
hists AS MATERIALIZED (
  SELECT d.source AS keyword, d.doc_id AS image_id, list(coalesce(b.w, 0.0) ORDER BY r.bin) AS v
  FROM documents d CROSS JOIN range(256) r(bin) LEFT JOIN bins b ON b.image_id = d.doc_id AND b.bin = r.bin
  GROUP BY ALL)"""


def unit_sql(source: str, name: str, centred: bool = False) -> str:
    """CTE ``name(keyword, image_id, v)`` of unit vectors."""
    value = "list_transform(v, lambda x: x - list_avg(v))" if centred else "v"
    return f"""
{name}_c AS MATERIALIZED (SELECT keyword, image_id, {value} AS v FROM {source}),
{name} AS MATERIALIZED (
  SELECT keyword, image_id, list_transform(v, lambda x: x / greatest(sqrt(list_dot_product(v, v)), 1e-12)) AS v
  FROM {name}_c)"""


def cosine_edges_sql(units: str, name: str, condition: str) -> str:
    """CTE ``name(keyword, a, b, score)``."""
    return f"""
{name} AS MATERIALIZED (
  SELECT x.keyword, x.image_id AS a, y.image_id AS b, list_dot_product(x.v, y.v) AS score
  FROM {units} x JOIN {units} y ON x.keyword = y.keyword AND x.image_id < y.image_id
  WHERE list_dot_product(x.v, y.v) {condition})"""


def greedy_sql(nodes: str, edges: str, name: str) -> str:
    """CTE ``name(keyword, image_id, kept, removed_by)``: the sequential first-wins loop.

    Ids are unique over all keywords and edges stay inside one, so one pass does for all.
    """
    return f"""
{name}_n AS MATERIALIZED (
  SELECT n.keyword, n.image_id, row_number() OVER (ORDER BY n.image_id) AS rn,
         coalesce(list(e.a) FILTER (WHERE e.a IS NOT NULL), []) AS earlier
  FROM {nodes} n LEFT JOIN {edges} e ON e.keyword = n.keyword AND e.b = n.image_id
  GROUP BY n.keyword, n.image_id),
{name}_r(i, kept) AS (
  SELECT 0::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT r.i + 1, CASE WHEN list_has_any(r.kept, n.earlier) THEN r.kept ELSE list_append(r.kept, n.image_id) END
  FROM {name}_r r JOIN {name}_n n ON n.rn = r.i + 1),
{name}_k AS MATERIALIZED (
  SELECT unnest(kept) AS image_id FROM (SELECT kept FROM {name}_r ORDER BY i DESC LIMIT 1)),
{name} AS MATERIALIZED (
  SELECT n.keyword, n.image_id, n.image_id IN (SELECT image_id FROM {name}_k) AS kept,
         (SELECT min(e.a) FROM {edges} e WHERE e.b = n.image_id AND e.a IN (SELECT image_id FROM {name}_k)) AS removed_by
  FROM {name}_n n)"""
