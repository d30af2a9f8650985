"""Relevance scoring around an external scorer: requests out, replies in."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftloom.functions.text import trimmed
from weftloom.operators.ordering import number_rows
from weftloom.params import CODE_FENCE_PATTERN
from weftloom.session import materialize

REPLY_SCHEMA = "array<struct<url: string, score: double>>"


def score_batches(pool: DataFrame, batch_size: int = 50) -> DataFrame:
    """Add ``batch`` and ``place`` (from 0 in each batch) to ``pool(keyword, pos, url)``, in list order."""
    numbered = number_rows(pool.select("keyword", "pos", "url"), ["keyword"], [F.col("pos")], "n")
    return numbered.select(
        "keyword",
        F.floor((F.col("n") - 1) / batch_size).cast("int").alias("batch"),
        F.pmod(F.col("n") - 1, F.lit(batch_size)).cast("int").alias("place"),
        "pos",
        "url",
    )


def score_requests(batches: DataFrame) -> DataFrame:
    """One request text per batch: a line ``place. url`` per URL. A batch bounds what is gathered."""
    lines = F.array_sort(F.collect_list(F.struct("place", "url")))
    text = F.array_join(F.transform(lines, lambda r: F.concat(r["place"].cast("string"), F.lit(". "), r["url"])), "\n")
    return batches.groupBy("keyword", "batch").agg(F.count("*").alias("urls"), text.alias("request"))


def parse_score_replies(replies: DataFrame) -> DataFrame:
    """``replies(keyword, batch, reply)`` to ``(keyword, batch, usable, item, url, score)``.

    The reply is a JSON array, perhaps in a code fence. An item without a score has 0. A reply
    that is no such array gives one row that is not ``usable``; an empty array one without item.
    """
    bare = trimmed(F.regexp_replace("reply", CODE_FENCE_PATTERN, ""))
    is_array = bare.rlike(r"(?s)^\[.*\]$")
    parsed = replies.withColumn("items", F.when(is_array, F.from_json(bare, REPLY_SCHEMA)))
    exploded = parsed.select(
        "keyword", "batch", F.col("items").isNotNull().alias("usable"), F.posexplode_outer("items").alias("item", "r")
    )
    return exploded.select(
        "keyword", "batch", "usable", "item", "r.url", F.when(F.col("item").isNotNull(), F.coalesce("r.score", F.lit(0.0))).alias("score")
    )


def with_failed_batches(parsed: DataFrame, batches: DataFrame) -> DataFrame:
    """Scores of all answered URLs, plus 0 for every URL of a batch that has no usable reply.

    A URL that a good reply leaves out is simply absent.
    """
    answered = parsed.where("item is not null")
    good = parsed.where("usable").select("keyword", "batch").distinct()
    failed = batches.join(good, ["keyword", "batch"], "left_anti").select(
        "keyword", "batch", F.col("place").alias("item"), "url", F.lit(0.0).alias("score")
    )
    return answered.select("keyword", "batch", "item", "url", "score").unionByName(failed)


def last_scores(scores: DataFrame, pool: DataFrame) -> DataFrame:
    """One score per URL: the last one given, at the place where the URL first appeared.

    ``requested`` tells whether the URL was asked for at all; answers to others are kept too.
    """
    order = F.struct("batch", "item")
    merged = scores.groupBy("keyword", "url").agg(F.max_by("score", order).alias("score"), F.min(order).alias("first"))
    asked = pool.select("keyword", "url").distinct().withColumn("requested", F.lit(True))
    return merged.join(asked, ["keyword", "url"], "left").select(
        "keyword", "url", "score", F.col("first.batch").alias("batch"), F.col("first.item").alias("item"),
        F.coalesce("requested", F.lit(False)).alias("requested"),
    )


def relevant_urls(scores: DataFrame, minimum: float = 0.6) -> DataFrame:
    """URLs of at least ``minimum``, ranked by falling score, equal scores by first appearance."""
    kept = scores.where(F.col("score") >= minimum)
    order = [F.col("score").desc(), F.col("batch"), F.col("item")]
    kept = materialize(kept.select("keyword", "url", "score", "batch", "item"))
    return number_rows(kept, ["keyword"], order, "rank").select(
        "keyword", "url", "score", "rank"
    )


def relevant_counts(pool: DataFrame, relevant: DataFrame) -> DataFrame:
    """Relevant and scored URLs per keyword."""
    total = pool.groupBy("keyword").agg(F.count("*").alias("total"))
    kept = relevant.groupBy("keyword").agg(F.count("*").alias("relevant"))
    return total.join(kept, "keyword", "left").fillna(0, ["relevant"])
