"""The stages put together: what to crawl next, what to ship, what to keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftloom.functions import urls
from weftloom.operators import crawl, html, ranking, reporting, scoring
from weftloom.operators.dedup import Layer, deduplicate, standard_layers
from weftloom.params import SCRIPT_PRESET, CurationParams
from weftloom.session import materialize


def acquire(
    pages: DataFrame, seeds: DataFrame, robots: DataFrame, keywords: DataFrame, params: CurationParams = SCRIPT_PRESET
) -> DataFrame:
    """From stored pages to the scoring requests of every keyword.

    ``seeds(url)`` start the shared crawl; with a ``keyword`` column, seeds that name one start a crawl of that keyword's
    own, which replaces the shared one for it. ``pages`` may have ``final_url`` and ``content_type``: links belong to the URL that was
    asked for, and only pages answered as HTML are expanded. Whatever robots rules forbid, seeds included, is visited but not
    expanded.
    """
    if "keyword" not in seeds.columns:
        seeds = seeds.withColumn("keyword", F.lit(None).cast("string"))
    own = urls.normalize(F.col("url")).alias("url")
    readable = crawl.expandable(pages) if "content_type" in pages.columns else pages
    links = materialize(html.page_links(readable).select(own, "link").distinct())
    starts = materialize(seeds.select("keyword", own).distinct())
    asked = links.select("url").unionByName(starts.select("url")).distinct()
    closed = materialize(crawl.robots_allowed(asked, robots).where("not allowed").select("url"))

    # the shared crawl and those of keywords with seeds run together
    starts_of = starts.select(F.struct(F.col("keyword").alias("own")).alias("crawl"), "url")
    sites = starts_of.select("crawl", urls.host(F.col("url")).alias("host"))
    found = materialize(crawl.crawl_reachable(starts_of, links, closed, sites).select(F.col("crawl.own").alias("keyword"), "url"))
    shared, mine = found.where("keyword is null").select("url"), found.where("keyword is not null")
    pool = crawl.keyword_url_pool(keywords, starts, mine, shared)
    numbered = pool.withColumn("pos", F.col("url"))
    return scoring.score_requests(scoring.score_batches(numbered, params.score_batch_size))


def curate(
    items: DataFrame, anchors: DataFrame, layers: list[Layer] | None = None, params: CurationParams = SCRIPT_PRESET
) -> DataFrame:
    """Remove duplicates, score the survivors against their anchor, rank and band them.

    ``items(keyword, image_id, embedding, <features of the layers>)``; returns
    ``(keyword, image_id, score, rank, band)``.
    """
    survivors, _ = deduplicate(items, layers if layers is not None else standard_layers(params))
    vectors = items.select("keyword", "image_id", "embedding").join(survivors, ["keyword", "image_id"], "left_semi")
    scored = materialize(ranking.reference_sort(vectors, anchors, params.rank_min))
    return ranking.person_bands(ranking.with_ranks(scored), params.keep_min, params.review_min)


def report(curated: DataFrame, anchors: DataFrame) -> DataFrame:
    """HTML parts for curated images; ``anchors(keyword, anchor_path)``."""
    return reporting.report_html(reporting.report_cards(ranking.with_output_names(curated)), anchors)
