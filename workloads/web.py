"""URL, HTML, crawl and scoring queries over ``pages``, ``customer`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftloom.functions import urls
from weftloom.functions.headers import image_size
from weftloom.operators import crawl, html, scoring
from weftloom.operators.ordering import number_rows
from weftloom.plans import curate
from weftloom.session import materialize
from workloads.base import (
    HOST_SQL, LANGUAGE_SQL, NORMAL_SQL, ORIGIN_SQL, PATH_SQL, SCHEME_SQL, Registry, normalized, page_language, pages, table,
)

query = Registry()


HREFS_SQL = """
found AS MATERIALIZED (
  SELECT page_id, url, regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1) AS hrefs FROM pages),
hrefs AS MATERIALIZED (
  SELECT page_id, url, unnest(hrefs) AS href, unnest(range(len(hrefs)))::INTEGER AS pos FROM found)"""
LINKS_SQL = f"""{HREFS_SQL},
links AS MATERIALIZED (
  SELECT page_id, {HOST_SQL} AS host, {SCHEME_SQL} || '://' || {HOST_SQL} ||
         CASE WHEN rtrim(regexp_extract(href, '^[^?#]*'), '/') = '' THEN '/'
              ELSE rtrim(regexp_replace(regexp_extract(href, '^[^?#]*'), ';[^/]*$', ''), '/') END AS link
  FROM hrefs WHERE NOT regexp_matches(href, '^(javascript:|mailto:|tel:|#|data:)'))"""


@query(f"SELECT page_id, {NORMAL_SQL} AS normal FROM pages")
def url_normalize(spark, sf):
    return table(spark, sf, "pages").select("page_id", normalized().alias("normal"))


@query(f"""
SELECT page_id, {SCHEME_SQL} AS scheme, {HOST_SQL} AS host, {ORIGIN_SQL} AS origin,
       regexp_extract(rtrim({PATH_SQL}, '/'), '([^/]*)$', 1) AS base_name
FROM pages""")
def url_parts(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", urls.scheme(url).alias("scheme"), urls.host(url).alias("host"),
        urls.origin(url).alias("origin"), urls.base_name(url).alias("base_name"),
    )


@query(f"""
WITH {HREFS_SQL},
refs AS (
  SELECT page_id, pos, url, CASE pos % 4 WHEN 0 THEN href WHEN 1 THEN substr(href, 2)
         WHEN 2 THEN '//cdn.example.com' || href ELSE '?from=' || pos END AS ref FROM hrefs)
SELECT page_id, pos, ref,
       CASE pos % 4 WHEN 0 THEN {ORIGIN_SQL} || ref
            WHEN 1 THEN {ORIGIN_SQL} || regexp_extract(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '^(.*/)', 1) || ref
            WHEN 2 THEN {SCHEME_SQL} || ':' || ref
            ELSE {ORIGIN_SQL} || regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) || ref END AS resolved
FROM refs""")
def url_resolve(spark, sf):
    """Every link of every page, respelt as a root, folder, host or query reference."""
    kind = F.pmod("pos", F.lit(4))
    href = F.col("href")
    ref = (
        F.when(kind == 0, href).when(kind == 1, F.substr(href, F.lit(2)))
        .when(kind == 2, F.concat(F.lit("//cdn.example.com"), href)).otherwise(F.concat(F.lit("?from="), F.col("pos")))
    )
    found = html.page_hrefs(pages(spark, sf)).withColumn("ref", ref)
    return found.select("page_id", "pos", "ref", urls.resolve(F.col("url"), F.col("ref")).alias("resolved"))


@query(f"WITH {LINKS_SQL} SELECT page_id, link FROM links")
def page_links(spark, sf):
    return html.page_links(pages(spark, sf)).select("page_id", "link")


@query(f"""
WITH {LINKS_SQL}, seeds AS (SELECT DISTINCT {HOST_SQL} AS host FROM pages WHERE {LANGUAGE_SQL} = 'en')
SELECT page_id, link FROM links WHERE host IN (SELECT host FROM seeds)""")
def internal_links(spark, sf):
    seeds = table(spark, sf, "pages").where(page_language() == "en").select("url")
    return crawl.internal_links(html.page_links(pages(spark, sf)), seeds).select("page_id", "link")


def _robots(spark, sf):
    """Rules of every site in ``pages``; the kind of answer and the delay follow from the host name."""
    host = urls.host(F.col("url"))
    hosts = table(spark, sf, "pages").select(host.alias("host")).distinct()
    kind = F.pmod(F.length("host"), F.lit(6))
    policy = F.when(kind == 0, "deny_all").when(kind == 1, "allow_all").when(kind == 2, "unread").otherwise("rules")
    rules = F.array(
        F.struct(F.lit(0).alias("pos"), F.lit(False).alias("allow"), F.lit("/en/8").alias("prefix")),
        F.struct(F.lit(1).alias("pos"), F.lit(True).alias("allow"), F.lit("/en").alias("prefix")),
        F.struct(F.lit(2).alias("pos"), F.lit(False).alias("allow"), F.lit("/e").alias("prefix")),
    )
    delay = F.when(kind == 3, 0.0).when(kind == 4, 2.5).when(kind == 5, 0.25)
    return hosts.where(~F.startswith("host", F.lit("m."))).select(
        "host", policy.alias("policy"), delay.alias("crawl_delay"), F.explode(rules).alias("r")
    ).select("host", "policy", "crawl_delay", "r.*")


@query(f"""
WITH p AS (
  SELECT page_id, {HOST_SQL} AS host, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^#]*)', 1) AS local FROM pages)
SELECT page_id,
       CASE WHEN host LIKE 'm.%' THEN TRUE
            WHEN length(host) % 6 IN (0, 2) THEN FALSE
            WHEN length(host) % 6 = 1 THEN TRUE
            WHEN local LIKE '/en/8%' THEN FALSE WHEN local LIKE '/en%' THEN TRUE
            WHEN local LIKE '/e%' THEN FALSE ELSE TRUE END AS allowed
FROM p""")
def robots_allowed(spark, sf):
    targets = table(spark, sf, "pages").select("page_id", "url")
    return crawl.robots_allowed(targets, _robots(spark, sf)).select("page_id", "allowed")


@query(f"""
WITH d AS (
  SELECT page_id, CASE WHEN {HOST_SQL} LIKE 'm.%' THEN 1.0 WHEN length({HOST_SQL}) % 6 = 4 THEN 2.5
                       WHEN length({HOST_SQL}) % 6 = 5 THEN 0.25 ELSE 1.0 END::DOUBLE AS delay FROM pages)
SELECT page_id, delay, greatest(delay, 1.0)::DOUBLE AS crawl_wait, greatest(delay, 0.5)::DOUBLE AS scrape_wait FROM d""")
def crawl_delay(spark, sf):
    targets = table(spark, sf, "pages").select("page_id", "url")
    return crawl.crawl_delays(targets, _robots(spark, sf)).select("page_id", "delay", "crawl_wait", "scrape_wait")


ALLOWED_SQL = f"""CASE WHEN {HOST_SQL} LIKE 'm.%' THEN TRUE
            WHEN length({HOST_SQL}) % 6 IN (0, 2) THEN FALSE
            WHEN length({HOST_SQL}) % 6 = 1 THEN TRUE
            WHEN {PATH_SQL} LIKE '/en/8%' THEN FALSE WHEN {PATH_SQL} LIKE '/en%' THEN TRUE
            WHEN {PATH_SQL} LIKE '/e%' THEN FALSE ELSE TRUE END"""


def _reach_sql(name: str, language: str) -> str:
    return f"""
{name}(url) AS (
  SELECT DISTINCT {NORMAL_SQL} FROM pages WHERE {LANGUAGE_SQL} = '{language}'
  UNION
  SELECT link FROM (SELECT e.link FROM edges e JOIN {name} USING (url) WHERE e.open)
  WHERE regexp_extract(link, '^[a-zA-Z]+://([^/?#]*)', 1) IN (SELECT {HOST_SQL} FROM pages WHERE {LANGUAGE_SQL} = '{language}'))"""


@query(f"""
WITH RECURSIVE {HREFS_SQL},
paths AS (
  SELECT page_id, url, CASE WHEN page_id % 5 = 0 THEN 'http://moved.example' ELSE {ORIGIN_SQL} END AS origin,
         regexp_extract(href, '^[^?#]*') AS path
  FROM hrefs WHERE NOT regexp_matches(href, '^(javascript:|mailto:|tel:|#|data:)') AND page_id % 7 <> 0),
asked AS (
  SELECT {NORMAL_SQL} AS url, origin || CASE WHEN rtrim(path, '/') = '' THEN '/' ELSE rtrim(regexp_replace(path, ';[^/]*$', ''), '/') END AS link
  FROM paths),
edges AS MATERIALIZED (SELECT DISTINCT url, link, {ALLOWED_SQL} AS open FROM asked),
{_reach_sql('shared', 'en')}, {_reach_sql('french', 'fr')},
pool AS (
  SELECT keyword, url FROM (SELECT DISTINCT {LANGUAGE_SQL} AS keyword FROM pages) CROSS JOIN shared WHERE keyword <> 'fr'
  UNION ALL SELECT 'fr', url FROM french),
numbered AS (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY url) - 1 AS n FROM pool)
SELECT keyword, (n // 50)::INTEGER AS batch, count(*) AS urls, string_agg((n % 50) || '. ' || url, chr(10) ORDER BY n) AS request
FROM numbered GROUP BY 1, 2""")
def acquire(spark, sf):
    """Crawls over the stored pages: English pages start the shared one, French pages their own.

    Every fifth page was redirected to another site, every seventh is no HTML.
    """
    number = F.col("page_id")
    stored = (
        pages(spark, sf)
        .withColumn("final_url", F.when(number % 5 == 0, "http://moved.example/x"))
        .withColumn("content_type", F.when(number % 7 == 0, "image/png").otherwise("text/html; charset=utf-8"))
    )
    language = page_language()
    seeds = stored.where(language.isin("en", "fr")).select(F.when(language == "fr", "fr").alias("keyword"), "url")
    keywords = stored.select(language.alias("keyword")).distinct()
    return curate.acquire(stored, seeds, _robots(spark, sf), keywords)


@query("""
WITH RECURSIVE n AS (SELECT count(*) AS n FROM customer),
links AS MATERIALIZED (
  SELECT c_custkey AS k, (7 * c_custkey + 3) % n AS t FROM customer, n WHERE c_mktsegment <> 'MACHINERY'
  UNION ALL SELECT c_custkey, (11 * c_custkey + 5) % n FROM customer, n WHERE c_mktsegment <> 'MACHINERY'),
reach(k) AS (SELECT c_custkey FROM customer WHERE c_custkey % 10 = 0 UNION SELECT t FROM links JOIN reach USING (k))
SELECT 'http://shop.example/' || k AS url FROM reach""")
def crawl_reachable(spark, sf):
    """Customers as pages of a site with two links each; one market segment is visited but not expanded."""
    customers = table(spark, sf, "customer")
    n = customers.count()
    address = lambda key: F.concat(F.lit("http://shop.example/"), key.cast("string"))
    key = F.col("c_custkey")
    targets = F.array(F.pmod(key * 7 + 3, F.lit(n)), F.pmod(key * 11 + 5, F.lit(n)))
    links = materialize(
        customers.select(address(key).alias("url"), F.explode(targets).alias("t")).select("url", address(F.col("t")).alias("link"))
    )
    closed = customers.where("c_mktsegment = 'MACHINERY'").select(address(key).alias("url"))
    seeds = customers.where("c_custkey % 10 = 0").select(address(key).alias("url"))
    return crawl.crawl_reachable(seeds, links, closed).select("url")


def _pages_with_images(spark, sf):
    """The stored pages with every link preceded by a picture of the same name."""
    picture = r'<img src="$1.jpg" data-src="data:image/gif;base64,R0" srcset="$1-2.webp 1x, $1.gif 2x"><a href="$1"'
    return pages(spark, sf).withColumn("html", F.regexp_replace("html", r'<a href="([^"]*)"', picture))


IMAGES_SQL = f"""{HREFS_SQL},
parts AS (
  SELECT page_id, url, href || '.jpg' AS c FROM hrefs
  UNION ALL
  SELECT page_id, url, split_part(trim(unnest(string_split(href || '-2.webp 1x, ' || href || '.gif 2x', ','))), ' ', 1)
  FROM hrefs),
image_urls AS MATERIALIZED (
  SELECT DISTINCT page_id, CASE WHEN c LIKE '/%' THEN {ORIGIN_SQL} || c
         ELSE {ORIGIN_SQL} || regexp_extract({PATH_SQL}, '^(.*/)', 1) || c END AS image_url
  FROM parts WHERE c <> '' AND regexp_matches(c, '(?i)\\.(jpe?g|png|webp)(\\?|$)'))"""


@query(f"WITH {IMAGES_SQL} SELECT page_id, image_url FROM image_urls")
def image_urls(spark, sf):
    return html.page_image_urls(_pages_with_images(spark, sf)).select("page_id", "image_url")


@query(f"""
WITH {IMAGES_SQL}
SELECT p.page_id, count(i.image_url) AS candidates FROM pages p LEFT JOIN image_urls i USING (page_id) GROUP BY 1""")
def links_per_page(spark, sf):
    stored = _pages_with_images(spark, sf)
    return html.links_per_page(stored, html.page_image_urls(stored))


@query("""
WITH s AS (SELECT page_id, string_split(url || ' 1x,/small/' || page_id || '.jpg   480w, ' || url || ',2 2x, ,', ',') AS parts FROM pages),
t AS (SELECT page_id, unnest(list_filter(list_transform(parts, lambda p: regexp_extract(p, '^\\s*(\\S*)', 1)), lambda p: p <> '')) AS candidate FROM s)
SELECT page_id, candidate FROM t""")
def srcset_candidates(spark, sf):
    url, page = F.col("url"), F.col("page_id")
    srcset = F.concat(url, F.lit(" 1x,/small/"), page, F.lit(".jpg   480w, "), url, F.lit(",2 2x, ,"))
    return table(spark, sf, "pages").select("page_id", F.explode(urls.srcset_urls(srcset)).alias("candidate"))


ENDINGS = [".JPG", ".jpeg?v=1", ".webp", ".gif", ".jpgx", ".png/b"]


@query(f"""
WITH u AS (SELECT page_id, {NORMAL_SQL} || (['.JPG', '.jpeg?v=1', '.webp', '.gif', '.jpgx', '.png/b'])[page_id % 6 + 1] AS image_url FROM pages)
SELECT page_id, image_url FROM u WHERE regexp_matches(image_url, '(?i)\\.(jpe?g|png|webp)(\\?|$)')""")
def image_ext_filter(spark, sf):
    ending = F.element_at(F.array(*map(F.lit, ENDINGS)), (F.pmod("page_id", F.lit(6)) + 1).cast("int"))
    named = table(spark, sf, "pages").select("page_id", F.concat(normalized(), ending).alias("image_url"))
    return named.where(urls.is_image(F.col("image_url")))


@query("""
WITH d AS (
  SELECT doc_id, CASE WHEN lang = 'es' THEN 404 ELSE 200 END AS status,
         CASE WHEN source = 'src3' THEN -1 ELSE n_chars END AS width,
         CASE WHEN source = 'src3' THEN -1 ELSE n_chars * 3 // 4 END AS height FROM documents)
SELECT doc_id, width, height FROM d WHERE status = 200 AND width >= 500 AND height >= 500""")
def min_dims(spark, sf):
    """Documents as downloads whose sizes are their lengths; one source cannot be decoded."""
    broken = F.col("source") == "src3"
    downloads = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "es", 404).otherwise(200).alias("status"),
        F.when(broken, F.lit(-1)).otherwise(F.col("n_chars")).cast("long").alias("width"),
        F.when(broken, F.lit(-1)).otherwise(F.floor(F.col("n_chars") * 3 / 4)).cast("long").alias("height"),
    )
    return crawl.accepted_downloads(downloads).select("doc_id", "width", "height")


@query(f"""
SELECT page_id, CASE WHEN contains(regexp_extract(rtrim({PATH_SQL}, '/'), '([^/]*)$', 1), '.')
                     THEN regexp_extract(rtrim({PATH_SQL}, '/'), '([^/]*)$', 1) ELSE 'img_########.jpg' END AS name
FROM pages""")
def target_name(spark, sf):
    """Names made from a hash are shown as a pattern, since SQL has another hash."""
    name = F.regexp_replace(urls.target_name(F.col("url")), r"^img_\d{8}\.jpg$", "img_########.jpg")
    return table(spark, sf, "pages").select("page_id", name.alias("name"))


@query("""
WITH n AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) - 1 AS k FROM documents)
SELECT doc_id, CASE WHEN k = 0 THEN source || '.jpg' ELSE source || '_' || k || '.jpg' END AS stored_name FROM n""")
def collision_names(spark, sf):
    arrivals = table(spark, sf, "documents").select(
        F.col("lang").alias("keyword"), F.col("doc_id").alias("pos"), F.concat("source", F.lit(".jpg")).alias("name")
    )
    return crawl.collision_names(arrivals).select(F.col("pos").alias("doc_id"), "stored_name")


@query("""
WITH d AS (
  SELECT doc_id, lang, source, doc_id % 3 = 0 AS earlier,
         row_number() OVER (PARTITION BY lang, source, doc_id % 3 = 0 ORDER BY doc_id) - 1 AS k FROM documents),
forms AS (SELECT lang, source, unnest(range(0, count(*)::BIGINT)) AS k FROM d GROUP BY lang, source),
free AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY k) - 1 AS o FROM forms f
  WHERE NOT EXISTS (FROM d WHERE earlier AND d.k % 2 = 0 AND d.lang = f.lang AND d.source = f.source AND d.k = f.k))
SELECT doc_id, CASE WHEN f.k = 0 THEN d.source || '.jpg' ELSE d.source || '_' || f.k || '.jpg' END AS stored_name
FROM d JOIN free f ON d.lang = f.lang AND d.source = f.source AND d.k = f.o WHERE NOT earlier""")
def collision_names_stored(spark, sf):
    """A third of the documents are images of an earlier run, of which every second one is still stored."""
    docs = table(spark, sf, "documents").select(
        F.col("lang").alias("keyword"), F.col("doc_id").alias("pos"), F.concat("source", F.lit(".jpg")).alias("name"), "source"
    )
    earlier = number_rows(docs.where("pos % 3 = 0"), ["keyword", "source"], [F.col("pos")], "n").where("n % 2 = 1")
    ending = F.when(F.col("n") == 1, "").otherwise(F.concat(F.lit("_"), F.col("n") - 1))
    stored = earlier.select("keyword", F.concat("source", ending, F.lit(".jpg")).alias("name"))
    named = crawl.collision_names(docs.where("pos % 3 <> 0").drop("source"), stored)
    return named.select(F.col("pos").alias("doc_id"), "stored_name")


@query("SELECT doc_id, (n_chars % 4000 + 1)::INTEGER AS width, (doc_id % 3000 + 1)::INTEGER AS height FROM documents")
def header_dimensions(spark, sf):
    """Headers of five kinds, made from documents: PNG, three of WebP, and JPEG behind a segment that depends on the text."""
    w, h = F.pmod("n_chars", F.lit(4000)) + 1, F.pmod("doc_id", F.lit(3000)) + 1
    big = lambda n, size: F.lpad(F.hex(n), 2 * size, "0")
    little = lambda n, size: F.concat(*[F.lpad(F.hex(F.shiftright(n, 8 * i).bitwiseAND(255)), 2, "0") for i in range(size)])
    text = lambda raw: F.lit(raw.encode().hex())
    webp = lambda kind, *rest: F.concat(text("RIFF"), F.lit("00" * 4), text("WEBP"), text(kind), F.lit("00" * 4), *rest)
    kind = F.pmod("doc_id", F.lit(5))
    header = (
        F.when(kind == 0, F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), big(w, 4), big(h, 4)))
        .when(kind == 1, webp("VP8 ", F.lit("3001009D012A"), little(w, 2), little(h, 2)))
        .when(kind == 2, webp("VP8L", F.lit("2F"), little(w - 1 + (h - 1) * 16384, 4), F.lit("00" * 5)))
        .when(kind == 3, webp("VP8X", F.lit("00" * 4), little(w - 1, 3), little(h - 1, 3)))
        .otherwise(F.concat(F.lit("FFD8FFE00012"), F.md5(F.coalesce("text", F.lit(""))), F.lit("FFC0001108"), big(h, 2), big(w, 2), F.lit("03")))
    )
    made = table(spark, sf, "documents").select("doc_id", F.unhex(header).alias("content"))
    return made.select("doc_id", image_size("content").alias("size")).select("doc_id", "size.width", "size.height")


@query(f"""
WITH k AS (SELECT DISTINCT {LANGUAGE_SQL} AS keyword FROM pages),
own AS (SELECT DISTINCT {LANGUAGE_SQL} AS keyword, {NORMAL_SQL} AS url FROM pages)
SELECT keyword, url FROM own WHERE keyword IN ('en', 'fr')
UNION ALL
SELECT k.keyword, u.url FROM k CROSS JOIN (SELECT DISTINCT url FROM own) u WHERE k.keyword NOT IN ('en', 'fr')""")
def keyword_url_pool(spark, sf):
    """Languages as keywords: English and French have seeds of their own, the others share the whole crawl."""
    own = table(spark, sf, "pages").select(page_language().alias("keyword"), normalized().alias("url")).distinct()
    keywords = own.select("keyword").distinct()
    seeds = own.where(F.col("keyword").isin("en", "fr"))
    return crawl.keyword_url_pool(keywords, seeds, seeds, own.select("url").distinct())


@query(f"""
WITH s AS (SELECT {LANGUAGE_SQL} AS keyword, url, row_number() OVER (PARTITION BY {LANGUAGE_SQL} ORDER BY page_id) AS rank FROM pages),
c AS (SELECT keyword, url, rank + 1000 AS rank FROM s WHERE keyword = 'fr')
SELECT keyword, url, rank::INTEGER AS rank FROM c
UNION ALL SELECT keyword, url, rank::INTEGER FROM s WHERE keyword NOT IN ('fr', 'de')""")
def cached_override(spark, sf):
    """French has a cached list, German an empty one, which leaves it without URLs."""
    listed = table(spark, sf, "pages").select(page_language().alias("keyword"), "page_id", "url")
    scored = number_rows(listed, ["keyword"], [F.col("page_id")], "rank").select("keyword", "url", "rank")
    cached = scored.where("keyword = 'fr'").select("keyword", "url", (F.col("rank") + 1000).alias("rank"))
    have_cache = scored.where("keyword in ('fr', 'de')").select("keyword").distinct()
    return crawl.cached_override(cached, scored, have_cache)


# --- relevance scoring: requests from the pages, replies spelt from them as a scorer would ---

BATCH = 10


def _pool(spark, sf):
    return table(spark, sf, "pages").groupBy(page_language().alias("keyword"), normalized().alias("url")).agg(
        F.min("page_id").alias("pos")
    )


def _batches(spark, sf):
    return scoring.score_batches(_pool(spark, sf), BATCH)


def _replies(batches):
    """A reply per batch: some fenced, some broken, some missing; items without score, repeated and unasked items."""
    pos = F.col("pos")
    score = F.when(F.pmod(pos, F.lit(13)) != 0, F.pmod(pos * 37, F.lit(101)) / 100)
    item = F.struct("url", score.alias("score"))
    again = F.struct(F.col("url"), F.lit(0.6).alias("score"))
    extra = F.struct(F.concat(F.lit("http://extra.example/"), F.col("pos")).alias("url"), F.lit(0.9).alias("score"))
    items = F.concat(
        F.array(item), F.when(F.pmod(pos, F.lit(7)) == 0, F.array(again)).otherwise(F.array(item)),
        F.when(F.pmod(pos, F.lit(11)) == 0, F.array(extra)).otherwise(F.slice(F.array(extra), 1, 0)),
    )
    listed = F.array_sort(F.collect_list(F.struct("place", items.alias("items"))))
    text = F.to_json(F.flatten(F.transform(listed, lambda r: r["items"])))
    b = F.col("batch")
    reply = (
        F.when(F.pmod(b, F.lit(5)) == 1, F.concat(F.lit("```json\n"), F.col("text"), F.lit("\n```")))
        .when(F.pmod(b, F.lit(5)) == 2, F.substr("text", F.lit(2)))
        .when(F.pmod(b, F.lit(5)) == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("  "), F.col("text")))
    )
    return batches.groupBy("keyword", "batch").agg(text.alias("text")).select("keyword", "batch", reply.alias("reply"))


BATCHES_SQL = f"""
pool AS (SELECT {LANGUAGE_SQL} AS keyword, {NORMAL_SQL} AS url, min(page_id) AS pos FROM pages GROUP BY 1, 2),
numbered AS (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY pos) - 1 AS n FROM pool),
batches AS MATERIALIZED (SELECT keyword, (n // {BATCH})::INTEGER AS batch, (n % {BATCH})::INTEGER AS place, pos, url FROM numbered)"""
SCORES_SQL = f"""{BATCHES_SQL},
items AS (
  SELECT keyword, batch, place, k, CASE WHEN k = 2 THEN 'http://extra.example/' || pos ELSE url END AS url,
         CASE WHEN k = 2 THEN 0.9 WHEN k = 1 AND pos % 7 = 0 THEN 0.6
              WHEN pos % 13 = 0 THEN 0.0 ELSE (pos * 37 % 101) / 100.0 END::DOUBLE AS score
  FROM batches CROSS JOIN range(3) r(k)
  WHERE batch % 5 NOT IN (2, 3) AND (k < 2 OR pos % 11 = 0)),
replies AS MATERIALIZED (
  SELECT keyword, batch, (row_number() OVER (PARTITION BY keyword, batch ORDER BY place, k) - 1)::INTEGER AS item, url, score FROM items),
scores AS MATERIALIZED (
  SELECT keyword, batch, item, url, score FROM replies
  UNION ALL SELECT keyword, batch, place, url, 0.0 FROM batches WHERE batch % 5 IN (2, 3)),
merged AS MATERIALIZED (
  SELECT keyword, url, arg_max(score, batch * 1000 + item) AS score, min(batch * 1000 + item) AS first FROM scores GROUP BY 1, 2),
last AS MATERIALIZED (
  SELECT keyword, url, score, (first // 1000)::INTEGER AS batch, (first % 1000)::INTEGER AS item,
         EXISTS (SELECT 1 FROM pool p WHERE p.keyword = m.keyword AND p.url = m.url) AS requested FROM merged m)"""


@query(f"""
WITH {BATCHES_SQL}
SELECT keyword, batch, count(*) AS urls, string_agg(place || '. ' || url, chr(10) ORDER BY place) AS request
FROM batches GROUP BY 1, 2""")
def score_requests(spark, sf):
    return scoring.score_requests(_batches(spark, sf))


@query(f"WITH {SCORES_SQL} SELECT keyword, batch, item, url, score FROM replies")
def score_replies(spark, sf):
    parsed = scoring.parse_score_replies(_replies(_batches(spark, sf)))
    return parsed.where("item is not null").select("keyword", "batch", "item", "url", "score")


def _scores(spark, sf):
    batches = materialize(_batches(spark, sf))
    return batches, scoring.with_failed_batches(scoring.parse_score_replies(_replies(batches)), batches)


@query(f"WITH {SCORES_SQL} SELECT keyword, batch, item, url, score FROM scores")
def score_failed_batches(spark, sf):
    return _scores(spark, sf)[1]


@query(f"WITH {SCORES_SQL} SELECT keyword, url, score, batch, item, requested FROM last")
def score_last_wins(spark, sf):
    batches, scores = _scores(spark, sf)
    return scoring.last_scores(scores, batches)


RELEVANT_SQL = f"""{SCORES_SQL},
relevant AS (
  SELECT keyword, url, score, (row_number() OVER (PARTITION BY keyword ORDER BY score DESC, batch, item))::INTEGER AS rank
  FROM last WHERE score >= 0.6)"""


@query(f"WITH {RELEVANT_SQL} SELECT keyword, url, score, rank FROM relevant")
def relevant_ranked(spark, sf):
    batches, scores = _scores(spark, sf)
    return scoring.relevant_urls(scoring.last_scores(scores, batches))


@query(f"""
WITH {RELEVANT_SQL}
SELECT p.keyword, count(*) AS total, (SELECT count(*) FROM relevant r WHERE r.keyword = p.keyword) AS relevant
FROM pool p GROUP BY 1""")
def relevant_counts(spark, sf):
    batches, scores = _scores(spark, sf)
    return scoring.relevant_counts(batches, scoring.relevant_urls(scoring.last_scores(scores, batches)))
