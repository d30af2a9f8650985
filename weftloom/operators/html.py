"""Links and image URLs out of stored pages.

The parser runs on Arrow batches and returns trimmed attribute values; resolving, filtering and
distinct are column work in the JVM.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftloom.functions import urls
from weftloom.params import IMG_ATTRIBUTES


# The parser gives up a page at marked sections that are neither CDATA nor conditional; they are read as text.
_BROKEN_DECLARATION = re.compile(r"<!\[(?!CDATA\[|(?:if|else|endif)\b[^>]*\]>)", re.I)


class _Attributes(HTMLParser):
    """Collects attribute values of the wanted tags, in document order."""

    def __init__(self, wanted: dict[str, tuple[str, ...]]):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted
        self.found: list[tuple[str, str]] = []

    def handle_starttag(self, tag, attrs):
        names = self.wanted.get(tag)
        if names:
            seen = set()
            for name, value in attrs:
                if name in names and name not in seen:  # the first of repeated attributes counts
                    seen.add(name)
                    self.found.append((name, (value or "").strip()))


def _attribute_values(pages: DataFrame, wanted: dict[str, tuple[str, ...]]) -> DataFrame:
    """``(page_id, url, found array<struct<name, value>>)`` of the pages that have such a tag at all."""

    def parse(batches):
        for batch in batches:
            rows = []
            for html in batch.column("html").to_pylist():
                parser = _Attributes(wanted)
                parser.feed(_BROKEN_DECLARATION.sub("&lt;![", html))
                parser.close()
                rows.append([{"name": n, "value": v} for n, v in parser.found])
            kind = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(rows, kind)], ["page_id", "url", "found"]
            )

    tags = "|".join(wanted)
    candidates = pages.select("page_id", "url", "html").where(F.col("html").rlike(rf"(?i)<({tags})[\s/]"))
    return candidates.mapInArrow(parse, "page_id long, url string, found array<struct<name: string, value: string>>")


def page_hrefs(pages: DataFrame) -> DataFrame:
    """Every ``<a href>`` as ``(page_id, url, pos, href)``, trimmed, duplicates kept."""
    found = _attribute_values(pages, {"a": ("href",)})
    return found.select("page_id", "url", F.posexplode("found").alias("pos", "f")).select(
        "page_id", "url", "pos", F.col("f.value").alias("href")
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Web links of every page, resolved and normalised: ``(page_id, url, pos, link)``.

    ``url`` is the one that was asked for; links are resolved against ``final_url`` where a page was redirected.
    """
    base = F.coalesce(F.col("final_url"), F.col("url")) if "final_url" in pages.columns else F.col("url")
    both = F.to_json(F.struct(base.alias("base"), F.col("url").alias("asked")))
    found = page_hrefs(pages.withColumn("url", both)).where(urls.navigates(F.col("href")))
    hrefs = found.withColumn("base", F.get_json_object("url", "$.base")).withColumn("url", F.get_json_object("url", "$.asked"))
    # exploding a one-element array keeps the filter from repeating the expression
    resolved = F.explode(F.array(urls.resolve(F.col("base"), F.col("href"))))
    full = hrefs.select("page_id", "url", "pos", resolved.alias("full")).where(urls.is_web(F.col("full")))
    return full.select("page_id", "url", "pos", urls.normalize(F.col("full")).alias("link"))


def page_image_urls(pages: DataFrame) -> DataFrame:
    """Image candidates of every page, each once: ``(page_id, url, image_url)``."""
    found = _attribute_values(pages, {"img": (*IMG_ATTRIBUTES, "srcset"), "source": ("srcset",)})
    values = found.select("page_id", "url", F.explode("found").alias("f")).select(
        "page_id", "url", "f.name", "f.value"
    )
    single = F.when((F.col("value") != "") & ~F.startswith("value", F.lit("data:")), F.array("value"))
    candidates = F.when(F.col("name") == "srcset", urls.srcset_urls(F.col("value"))).otherwise(single)
    resolved = values.select("page_id", "url", F.explode(candidates).alias("candidate")).select(
        "page_id", "url", F.explode(F.array(urls.resolve(F.col("url"), F.col("candidate")))).alias("image_url")
    )
    return resolved.where(urls.is_image(F.col("image_url"))).dropDuplicates(["page_id", "image_url"])


def links_per_page(pages: DataFrame, found: DataFrame) -> DataFrame:
    """Candidates per page, 0 included: the report of a dry run."""
    counts = found.groupBy("page_id").agg(F.count("*").alias("candidates"))
    return pages.select("page_id").join(counts, "page_id", "left").fillna(0, ["candidates"])
