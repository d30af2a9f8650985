"""HTML reports of ranked images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftloom.functions.text import three_decimals

PAGE_IMAGES = 500

# A plain table, one row an image; every page is a whole document.
OPENING = '<!DOCTYPE html><meta charset="utf-8"><title>'
STYLE = "</title><style>table{border-collapse:collapse}td{padding:2px 1em;border-top:1px solid}</style>"
COLUMNS = "</caption><tr><th>Rank<th>Image<th>Similarity<th>Per cent\n"
CLOSING = "</table>\n"


def report_cards(named: DataFrame) -> DataFrame:
    """What a card shows: rank, file, score to three places and whole percent, cut off."""
    return named.select(
        "keyword",
        "rank",
        "output_name",
        three_decimals("score").alias("score_text"),
        (F.col("score") * 100).cast("int").alias("percent"),
    )


def _row() -> Column:
    text = lambda name: F.col(name).cast("string")
    return F.concat(
        F.lit("<tr><td>"), text("rank"), F.lit('<td><a href="'), "output_name", F.lit('">'), "output_name",
        F.lit("</a><td>"), "score_text", F.lit("<td>"), text("percent"), F.lit("\n"),
    )


def _head(page_images: int) -> Column:
    first = F.col("part") * page_images + 1
    last = F.least((F.col("part") + 1) * page_images, F.col("images"))
    return F.concat(
        F.lit(OPENING), "keyword", F.lit(f"{STYLE}<table><caption>Keyword "), "keyword", F.lit(', ranked against <a href="'), "anchor_path",
        F.lit('">its anchor</a>: images '), first.cast("string"), F.lit(" to "), last.cast("string"), F.lit(" of "),
        F.col("images").cast("string"), F.lit(", page "), (F.col("part") + 1).cast("string"), F.lit(" of "), F.col("pages").cast("string"),
        F.lit(COLUMNS),
    )


def report_html(cards: DataFrame, anchors: DataFrame, page_images: int = PAGE_IMAGES) -> DataFrame:
    """Report pages as ``(keyword, part, html)``; ``anchors(keyword, anchor_path)`` gives the keywords to report.

    A report grows with its keyword, so it has a page for each ``page_images`` images, and one page if there are none. Every
    page is a document of its own.
    """
    drawn = cards.select("keyword", "rank", F.floor((F.col("rank") - 1) / page_images).cast("int").alias("part"), _row().alias("row"))
    in_order = F.array_sort(F.collect_list(F.struct("rank", "row")))
    bodies = drawn.groupBy("keyword", "part").agg(
        F.array_join(F.transform(in_order, lambda c: c["row"]), "").alias("body")
    )
    heads = anchors.select("keyword", "anchor_path").join(
        cards.groupBy("keyword").agg(F.count("*").alias("images")), "keyword", "left"
    ).fillna(0, ["images"])
    pages = heads.withColumn("pages", F.greatest(F.ceil(F.col("images") / page_images).cast("int"), F.lit(1)))
    frames = pages.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
    return frames.join(bodies, ["keyword", "part"], "left").select(
        "keyword", "part", F.concat(_head(page_images), F.coalesce("body", F.lit("")), F.lit(CLOSING)).alias("html")
    )
