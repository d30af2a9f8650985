"""Ranking against an anchor image, bands, verdicts and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from weftloom.functions.text import three_decimals, trimmed
from weftloom.functions.vectors import as_double, cosine
from weftloom.operators.ordering import number_rows
from weftloom.params import PERSON_QUESTION
from weftloom.session import broadcast_if_small, materialize


def anchor_lookup(items: DataFrame, anchors: DataFrame) -> DataFrame:
    """Items of keywords that have an anchor, with its embedding as ``anchor``. Anchors: one per keyword."""
    one = anchors.select("keyword", F.col("embedding").alias("anchor"))
    return items.join(broadcast_if_small(one, 10_000), "keyword")


def keywords_without_anchor(keywords: DataFrame, anchors: DataFrame) -> DataFrame:
    return keywords.select("keyword").join(anchors.select("keyword"), "keyword", "left_anti")


def score_against_anchor(items: DataFrame, anchors: DataFrame) -> DataFrame:
    """Add ``score``; NULL where the item has no embedding."""
    joined = anchor_lookup(items, anchors)
    score = cosine(as_double(F.col("embedding")), as_double(F.col("anchor")))
    # exploding a one-element array keeps a filter on the score from computing it a second time
    return joined.select("*", F.explode(F.array(score)).alias("score")).drop("anchor", "embedding")


def reference_sort(items: DataFrame, anchors: DataFrame, minimum: float) -> DataFrame:
    """Scored items of at least ``minimum``; those without an embedding drop out. Ranking is ``with_ranks``."""
    return score_against_anchor(items.where("embedding is not null"), anchors).where(F.col("score") >= minimum)


def with_ranks(scored: DataFrame) -> DataFrame:
    """Rank from 1 by falling score within the keyword; equal scores keep image order.

    ``scored`` is read twice, so give a materialized table if it is costly.
    """
    return number_rows(scored, ["keyword"], [F.col("score").desc(), F.col("image_id")], "rank")


def with_output_names(ranked: DataFrame, ending: str = ".jpg") -> DataFrame:
    """Add ``output_name``; the suffix comes from column ``suffix`` if there is one."""
    tail = F.col("suffix") if "suffix" in ranked.columns else F.lit(ending)
    name = F.concat(
        F.lit("rank"), F.format_string("%04d", "rank"), F.lit("_sim"), three_decimals("score"), tail
    )
    return ranked.withColumn("output_name", name)


def review_names(review: DataFrame) -> DataFrame:
    """Add ``output_name`` to ``review(keyword, a_stem, b_stem, score, suffix)``."""
    name = F.concat(
        F.lit("review_"), F.col("a_stem"), F.lit("_vs_"), F.col("b_stem"), F.lit("_"), three_decimals("score"), F.col("suffix")
    )
    return review.withColumn("output_name", name)


def person_bands(scored: DataFrame, keep_min: float = 0.75, review_min: float = 0.50) -> DataFrame:
    """Add ``band``: keep, review or exclude; no score means exclude."""
    band = F.when(F.col("score") >= keep_min, "keep").when(F.col("score") >= review_min, "review").otherwise("exclude")
    return scored.withColumn("band", band)


def media_type(content: Column) -> Column:
    """By the first bytes: PNG, WebP, otherwise JPEG."""
    start = F.hex(F.substring(content, 1, 12))
    return (
        F.when(F.startswith(start, F.lit("89504E470D0A1A0A")), "image/png")
        .when(F.startswith(start, F.lit("52494646")) & F.endswith(start, F.lit("57454250")), "image/webp")
        .otherwise("image/jpeg")
    )


def verdict_requests(banded: DataFrame, images: DataFrame) -> DataFrame:
    """Request bodies for the review band only; bytes are sent as they are stored."""
    wanted = banded.where("band = 'review'").select("keyword", "image_id")
    picture = F.concat(F.lit("data:"), media_type(F.col("image_bytes")), F.lit(";base64,"), F.base64("image_bytes"))
    body = F.to_json(F.struct(F.lit(PERSON_QUESTION).alias("text"), picture.alias("image_url")))
    return images.join(wanted, ["keyword", "image_id"], "left_semi").select("keyword", "image_id", body.alias("request"))


def parse_verdicts(replies: DataFrame) -> DataFrame:
    """Add ``has_person``: the reply begins with YES in any case. No reply counts as no person."""
    answer = F.startswith(F.upper(trimmed(F.col("reply"))), F.lit("YES"))
    return replies.withColumn("has_person", F.coalesce(answer, F.lit(False)))


def with_outcome(banded: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Add ``final``: in the keep band, or in review without a person in the picture."""
    answers = verdicts.select("keyword", "image_id", "has_person")
    joined = banded.join(answers, ["keyword", "image_id"], "left")
    passed = (F.col("band") == "keep") | ((F.col("band") == "review") & ~F.coalesce("has_person", F.lit(False)))
    return joined.withColumn("final", passed).drop("has_person")


def final_output(outcome: DataFrame) -> DataFrame:
    """The final images, ranked anew."""
    return with_ranks(materialize(outcome.where("final").select("keyword", "image_id", "score")))


def filter_counts(outcome: DataFrame) -> DataFrame:
    """Kept, excluded and reviewed images; reviewed ones are also in one of the other two."""
    return outcome.groupBy("keyword").agg(
        F.count_if("final").alias("kept"),
        F.count_if(~F.col("final")).alias("excluded"),
        F.count_if(F.col("band") == "review").alias("reviewed"),
    )


def run_summary(keywords: DataFrame, final: DataFrame) -> DataFrame:
    """Images per keyword at the end of a run, 0 included."""
    counts = final.groupBy("keyword").agg(F.count("*").alias("images"))
    return keywords.select("keyword").join(counts, "keyword", "left").fillna(0, ["images"])


def top_per_keyword(ranked: DataFrame, k: int = 6) -> DataFrame:
    """The first ``k`` by score; each task passes on at most ``k`` rows of a keyword."""
    order = W.partitionBy("keyword").orderBy(F.col("score").desc(), "image_id")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
